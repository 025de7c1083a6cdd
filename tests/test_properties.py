"""Property tests: operators against brute force, whatever the partitioning.

Inputs are random and include a hot key holding at least a third of the
rows; every result must equal a direct Python reading of the rule and must
not depend on how the input is split or how many shuffle partitions run.
"""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hourmill.operators.quality import dedupe_latest
from hourmill.sinks.tables import read_table, upsert_path

SETTINGS = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def _with_hot_key(rows, hot):
    """Prepend copies of the hot key so it holds at least a third of all rows."""
    extra = [(hot, *r[1:]) for r in rows[: len(rows) // 2 + 1]]
    return extra + rows


row = st.tuples(st.sampled_from(["a", "b", "c", "d", None]), st.integers(0, 5), st.integers(-3, 3))


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=40), splits=st.sampled_from([1, 3, 7]), shuffle=st.sampled_from(["2", "11"]))
def test_dedupe_latest_is_the_greatest_row_per_key(spark, rows, splits, shuffle):
    rows = _with_hot_key(rows, "a")
    want = {}
    for k, newest, v in rows:
        cur = want.get(k)
        if cur is None or (newest, v) > cur:
            want[k] = (newest, v)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shuffle)
    try:
        df = spark.createDataFrame(rows, "k string, newest int, v int").repartition(splits)
        got = {r.k: (r.newest, r.v) for r in dedupe_latest(df, ["k"], newest=["newest"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == want


BASE = dt.datetime(2024, 1, 1)
cell = st.tuples(st.sampled_from(["a", "b", "c", "d", "e", "f"]), st.integers(0, 3), st.integers(0, 9))


def _frame(spark, rows, splits):
    df = spark.createDataFrame(
        [(k, BASE + dt.timedelta(days=day, hours=ord(k) % 5), float(v)) for k, day, v in rows],
        "k string, timestamp timestamp, value double",
    )
    return df.withColumn("date", F.to_date("timestamp")).repartition(splits)


@SETTINGS
@given(
    first=st.lists(cell, min_size=1, max_size=20, unique_by=lambda c: c[0]),
    second=st.lists(cell, min_size=1, max_size=20, unique_by=lambda c: c[0]),
    splits=st.sampled_from([1, 4]),
)
def test_upsert_equals_dictionary_update(spark, tmp_path_factory, first, second, splits):
    """Keys determine the date (each key keeps its day), as the upsert requires."""
    day_of_key = {}
    for k, day, _ in first:
        day_of_key.setdefault(k, day)
    second = [(k, day_of_key.get(k, day), v) for k, day, v in second]
    path = str(tmp_path_factory.mktemp("prop-upsert"))
    upsert_path(spark, _frame(spark, first, splits), path, ["k"], ["date"])
    res = upsert_path(spark, _frame(spark, second, splits), path, ["k"], ["date"])
    want = {k: (day, float(v)) for k, day, v in first}
    changed = sum(1 for k, day, v in second if want.get(k) != (day, float(v)))
    want.update({k: (day, float(v)) for k, day, v in second})
    got = {r.k: ((r.timestamp - BASE).days, r.value) for r in read_table(spark, path).collect()}
    assert got == want
    assert res.changed == changed
