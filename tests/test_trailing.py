import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hourmill.operators.trailing import trailing_mean

BASE = dt.datetime(2024, 1, 1)


def _frame(spark, rows, with_series=False):
    schema = "s string, ts string, v double" if with_series else "ts string, v double"
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def _at(seconds):
    return (BASE + dt.timedelta(seconds=seconds)).isoformat(sep=" ")


def _brute(rows, hours=3):
    """Direct reading of the rule on whole seconds."""
    w = hours * 3600
    out = []
    for t, v in rows:
        s = int((dt.datetime.fromisoformat(t) - dt.datetime(1970, 1, 1)).total_seconds() // 1)
        frame = [
            v2
            for t2, v2 in rows
            if v2 is not None
            and s - w <= int((dt.datetime.fromisoformat(t2) - dt.datetime(1970, 1, 1)).total_seconds() // 1) <= s - 1
        ]
        out.append(sum(frame) / len(frame) if frame else None)
    return out


def _run(spark, rows, **kw):
    df = _frame(spark, rows)
    got = trailing_mean(df, "v", "avg", ts="ts", count_out="n", **kw).orderBy("ts", "v").collect()
    return got


def test_edges(spark):
    rows = [
        (_at(0), 10.0),  # first row: no earlier row
        (_at(3600), 20.0),
        (_at(3 * 3600), 30.0),  # exactly 3 h after the first: includes it
        (_at(3 * 3600), 40.0),  # equal timestamp: not in each other's frame
        (_at(3 * 3600 + 1), 50.0),  # first row now 3 h + 1 s back: excluded
        (_at(20 * 3600), 60.0),  # gap > 3 h: empty frame
    ]
    got = {(r.ts, r.v): (r.avg, r.n) for r in _run(spark, rows)}
    assert got[(BASE, 10.0)] == (None, 0)
    assert got[(BASE + dt.timedelta(hours=1), 20.0)] == (10.0, 1)
    assert got[(BASE + dt.timedelta(hours=3), 30.0)] == (15.0, 2)
    assert got[(BASE + dt.timedelta(hours=3), 40.0)] == (15.0, 2)
    assert got[(BASE + dt.timedelta(hours=3, seconds=1), 50.0)] == (30.0, 3)
    assert got[(BASE + dt.timedelta(hours=20), 60.0)] == (None, 0)


def test_nulls_ignored(spark):
    rows = [(_at(0), None), (_at(10), 4.0), (_at(20), None), (_at(30), 1.0)]
    got = [(r.avg, r.n) for r in _run(spark, rows)]
    assert got == [(None, 0), (None, 0), (4.0, 1), (4.0, 1)]


def test_sub_second_rows_share_a_second(spark):
    rows = [("2024-01-01 00:00:00.2", 1.0), ("2024-01-01 00:00:00.9", 3.0), ("2024-01-01 00:00:01.1", 5.0)]
    got = [(r.avg, r.n) for r in _run(spark, rows)]
    assert got == [(None, 0), (None, 0), (2.0, 2)]


@pytest.mark.parametrize("bucket", [3 * 3600, 4 * 3600 + 17, None])
def test_halo_equals_brute_force(spark, bucket):
    rnd = random.Random(7)
    rows = []
    t = 0
    for _ in range(400):
        t += rnd.choice([0, 1, 59, 600, 1800, 3600, 3 * 3600, 5 * 3600])
        rows.append((_at(t), rnd.choice([None, round(rnd.uniform(-50, 50), 2)])))
    want = _brute(rows)
    got = _run(spark, rows, bucket_seconds=bucket)
    index = {}
    for r in got:
        index.setdefault((r.ts, r.v), r.avg)
    for (t, v), w in zip(rows, want):
        g = index[(dt.datetime.fromisoformat(t), v)]
        assert (g is None and w is None) or abs(g - w) < 1e-9, (t, v, g, w)


def test_series_are_independent(spark):
    rows = [("a", _at(0), 1.0), ("b", _at(0), 100.0), ("a", _at(60), 3.0), ("b", _at(60), 300.0)]
    df = _frame(spark, rows, with_series=True)
    got = {(r.s, r.v): r.avg for r in trailing_mean(df, "v", "avg", ts="ts", by=["s"]).collect()}
    assert got[("a", 3.0)] == 1.0 and got[("b", 300.0)] == 100.0


def test_no_single_partition_exchange(spark):
    df = _frame(spark, [(_at(i * 3600), float(i)) for i in range(50)])
    plan = trailing_mean(df, "v", "avg", ts="ts")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_hot_second_holding_a_third_of_rows(spark):
    """One second carries a third of all rows: pre-aggregation keeps the result exact."""
    rnd = random.Random(11)
    rows = [(_at(7200), float(i % 5)) for i in range(300)]
    rows += [(_at(rnd.randrange(0, 4 * 3600)), float(rnd.randrange(100))) for _ in range(600)]
    want = _brute(rows)
    got = {}
    for r in _run(spark, rows, bucket_seconds=3 * 3600):
        got.setdefault((r.ts, r.v), set()).add(r.avg)
    for (t, v), w in zip(rows, want):
        (g,) = got[(dt.datetime.fromisoformat(t), v)]
        assert (g is None and w is None) or abs(g - w) < 1e-9


def test_null_series_key_is_its_own_series(spark):
    rows = [(None, _at(0), 1.0), (None, _at(60), 3.0), ("a", _at(30), 100.0)]
    df = _frame(spark, rows, with_series=True)
    got = {(r.s, r.v): r.avg for r in trailing_mean(df, "v", "avg", ts="ts", by=["s"]).collect()}
    assert got == {(None, 1.0): None, (None, 3.0): 1.0, ("a", 100.0): None}


def _join_plan(df):
    df.collect()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", [None, 1, -1])
def test_join_back_paths_agree_with_brute_force(spark, limit):
    """Measured broadcast (default), over the limit (shuffle join), and planner's choice."""
    rnd = random.Random(3)
    rows = [(_at(rnd.randrange(0, 8 * 3600)), float(rnd.randrange(50))) for _ in range(300)]
    df = _frame(spark, rows)
    got = {}
    for r in trailing_mean(df, "v", "avg", ts="ts", broadcast_limit=limit).collect():
        got.setdefault((r.ts, r.v), set()).add(r.avg)
    for (t, v), w in zip(rows, _brute(rows)):
        (g,) = got[(dt.datetime.fromisoformat(t), v)]
        assert (g is None and w is None) or abs(g - w) < 1e-9


def test_join_back_strategy_follows_measured_size(spark):
    df = _frame(spark, [(_at(i * 60), float(i)) for i in range(200)])
    small = _join_plan(trailing_mean(df, "v", "avg", ts="ts"))
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    # Broadcasting disabled in the session: the measured side is not hinted
    # and the rows are joined by a shuffle join.
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        over = _join_plan(trailing_mean(df, "v", "avg", ts="ts"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" not in over and "SortMergeJoin" in over


def test_measured_side_sizes():
    from hourmill.operators.sizing import parse_bytes, row_width
    from pyspark.sql import types as T

    assert parse_bytes("10485760b") == 10 << 20 and parse_bytes("10MB") == 10 << 20 and parse_bytes("-1") == -1
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DecimalType(38, 6))])
    assert row_width(schema) == 16 + 8 + 16


def test_measured_side_counts_and_cuts_lineage(spark):
    from hourmill.operators.sizing import measured_side, row_width

    df = spark.range(500).selectExpr("id", "cast(id as double) * 2 as x").where("id % 5 = 0")
    m = measured_side(df, limit=10_000_000)
    assert m.rows == 100 and m.broadcast and m.est_bytes == 100 * row_width(m.df.schema)
    assert "Range" not in m.df._jdf.queryExecution().executedPlan().toString()  # reads the checkpoint
    assert not measured_side(df, limit=10).broadcast
    assert sorted(r.id for r in m.df.collect()) == list(range(0, 500, 5))


def test_default_frames_show_nan_and_infinities_as_avg(spark):
    import math

    inf, nan = float("inf"), float("nan")
    rows = [(_at(0), 1.0), (_at(10), nan), (_at(20), 2.0), (_at(3 * 3600 + 11), 5.0), (_at(3 * 3600 + 15), inf), (_at(3 * 3600 + 20), 1.0),
            (_at(3 * 3600 + 25), -inf), (_at(3 * 3600 + 30), 1.0), (_at(7 * 3600), 3.0), (_at(7 * 3600 + 1), 1.0)]
    got = [r.avg for r in _run(spark, rows)]
    assert got[0] is None and got[1] == 1.0 and math.isnan(got[2])
    assert got[3] == 2.0  # the NaN has left the frame
    assert got[4] == 3.5 and got[5] == inf and got[6] == inf and math.isnan(got[7])
    assert got[8] is None and got[9] == 3.0


def test_default_frames_keep_small_values_after_large_ones(spark):
    """A difference of running sums would lose them to cancellation."""
    rows = [(_at(0), 1e17), (_at(4 * 3600), 0.25), (_at(4 * 3600 + 1), 0.5), (_at(4 * 3600 + 2), 1.0)]
    assert [r.avg for r in _run(spark, rows)][1:] == [None, 0.25, 0.375]


@pytest.mark.parametrize("unique", [True, False])
def test_default_frames_equal_exact_ones(spark, unique):
    rnd = random.Random(2)
    t, rows = 0, []
    for _ in range(3000):
        t += rnd.choice([1, 1, 7, 300, 3599, 3 * 3600]) if unique else rnd.choice([0, 1, 60, 3600])
        rows.append((rnd.choice("ab"), _at(t), rnd.choice([None, rnd.randrange(-500, 500) / 4])))
    if unique:
        rows = list({(s, t): (s, t, v) for s, t, v in rows}.values())
    df = _frame(spark, rows, with_series=True)
    kw = dict(ts="ts", by=["s"], count_out="n", unique_rows=unique)
    key = lambda r: (r.s, r.ts, r.v is None, r.v or 0.0, r.n)
    fast = sorted(trailing_mean(df, "v", "avg", **kw).collect(), key=key)
    exact = sorted(trailing_mean(df, "v", "avg", scale=2, **kw).collect(), key=key)
    assert fast == exact  # quarters: sums of doubles are exact too


def test_exact_values_are_checked_without_rounding(spark):
    """Many digits, large whole numbers, and values that only look as if they fit."""
    ok = [0.1, 123456.789012, 99999999.999999, 999999999999.0, -0.000001, 900719925474.123456]
    rows = [(_at(i), v) for i, v in enumerate(ok)]
    got = [r.avg for r in _run(spark, rows, scale=6)]
    want = _brute(rows)
    assert all(g is None and w is None or abs(g - w) < 1e-6 for g, w in zip(got, want, strict=True))
    for bad in (0.1234567, 1e12, float("nan"), float("inf"), 4503599627370497.5, 0.1 + 0.2):
        with pytest.raises(Exception, match="does not fit"):
            _run(spark, [(_at(0), bad), (_at(1), 1.0)], scale=6)


def test_default_frames_are_linear(spark):
    """One row a second for a day and more: about the time of exact decimals, not that of summing each frame."""
    import time

    df = spark.range(100_000).selectExpr("timestamp_seconds(1704067200 + id) as ts", "(id * 37 % 1000) / 4 as v")

    def seconds(scale):
        start = time.perf_counter()
        trailing_mean(df, "v", "avg", ts="ts", scale=scale, broadcast_limit=-1).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds(6), seconds(None)
    assert min(seconds(None) for _ in range(2)) <= 3 * min(seconds(6) for _ in range(2)) + 1
