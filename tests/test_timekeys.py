import datetime as dt

from pyspark.sql import functions as F

from hourmill.functions.timekeys import (
    extract_bounds,
    hash_key,
    parse_ts,
    snapshot_name,
    time_policy,
    wall_to_utc,
)
from hourmill.sources.snapshots import trailing_extract


def _utc(spark, texts, zone="Europe/Amsterdam"):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select(wall_to_utc(parse_ts(F.col("t")), zone).alias("u"))
    return [r.u for r in out.collect()]


def test_malformed_time_is_null(spark):
    df = spark.createDataFrame([("xx",), ("2024-01-01T05:00",), (None,)], "t string")
    got = [r.p for r in df.select(parse_ts(F.col("t")).alias("p")).collect()]
    assert got == [None, dt.datetime(2024, 1, 1, 5, 0), None]


def test_spring_gap_maps_two_wall_hours_to_one_instant(spark):
    assert _utc(spark, ["2024-03-31T02:00", "2024-03-31T03:00"]) == [
        dt.datetime(2024, 3, 31, 1, 0),
        dt.datetime(2024, 3, 31, 1, 0),
    ]


def test_autumn_overlap(spark):
    assert _utc(spark, ["2024-10-27T02:00", "2024-10-27T03:00"]) == [
        dt.datetime(2024, 10, 27, 0, 0),
        dt.datetime(2024, 10, 27, 2, 0),
    ]


def test_time_policy_parse_only_keeps_zone(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z",)], "timestamp string")
    out = time_policy(df, "timestamp", parse=True, to_utc=False)
    assert out.collect()[0].timestamp == dt.datetime(2024, 1, 1, 0, 0)


def test_hash_key_null_part_is_empty_text(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    hk = [r.hk for r in df.select(hash_key(["x", "y"]).alias("hk")).collect()]
    assert hk[0] == hk[1]  # documented rule: NULL and '' hash alike
    import hashlib

    assert hk[0] == hashlib.md5(b"a||").hexdigest()


def test_hash_key_respects_order(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    r = df.select(hash_key(["x", "y"]).alias("p"), hash_key(["y", "x"]).alias("q")).collect()[0]
    assert r.p != r.q


def test_snapshot_name_and_bounds():
    d = dt.date(2024, 1, 20)
    assert extract_bounds(d) == (dt.date(2024, 1, 13), d)
    assert snapshot_name(d) == "2024-01-13_2024-01-20"


def test_trailing_extract_window_pushes_down(spark):
    rows = [("2024-01-12 23:59:59",), ("2024-01-13 00:00:00",), ("2024-01-20 23:59:59",), ("2024-01-21 00:00:00",)]
    df = spark.createDataFrame(rows, "ts string").select(F.col("ts").cast("timestamp_ntz").alias("ts"))
    out = trailing_extract(df, "ts", dt.date(2024, 1, 20))
    assert out.count() == 2
