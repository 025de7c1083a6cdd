import datetime as dt

import pytest
from pyspark.sql import types as T

from hourmill.operators.reshape import apply_transform, explode_records, hourly_rows, zip_rows
from hourmill.sources.snapshots import ENERGY_SCHEMA, WEATHER_SCHEMA

HOURLY = T.StructType(
    [
        T.StructField("doc", T.IntegerType()),
        T.StructField(
            "hourly",
            T.StructType(
                [
                    T.StructField("time", T.ArrayType(T.StringType())),
                    T.StructField("wind", T.ArrayType(T.DoubleType())),
                ]
            ),
        ),
    ]
)


def test_unequal_lengths_pad_with_null(spark):
    df = spark.createDataFrame([(1, (["a", "b", "c"], [1.0, 2.0]))], HOURLY)
    got = [tuple(r) for r in zip_rows(df, "hourly", ["time", "wind"]).collect()]
    assert got == [(1, "a", 1.0), (1, "b", 2.0), (1, "c", None)]


def test_empty_and_null_arrays_give_no_rows(spark):
    df = spark.createDataFrame([(1, ([], [])), (2, None), (3, (None, [1.0]))], HOURLY)
    assert zip_rows(df, "hourly", ["time", "wind"]).count() == 0


def test_explode_records_null_and_empty(spark):
    rows = [([], 1.0, "a", "b", 4), (None, 1.0, "a", "b", 4), ([(2.5, "2024-01-01T00:00:00Z")], 1.0, "a", "b", 4)]
    df = spark.createDataFrame(rows, ENERGY_SCHEMA)
    out = explode_records(df, "Prices", {"timestamp": "readingDate", "price": "price"}, keep={"interval_type": "intervalType"})
    assert [tuple(r) for r in out.collect()] == [(4, "2024-01-01T00:00:00Z", 2.5)]
    assert out.columns == ["interval_type", "timestamp", "price"]


def test_hourly_rows_to_utc_and_malformed(spark):
    doc = (52.0, 4.9, "Europe/Amsterdam", (["2024-01-01T01:00", "xx"], [1.0, 2.0], [3.0, 4.0], [5.0, 6.0]))
    df = spark.createDataFrame([doc], WEATHER_SCHEMA)
    out = hourly_rows(df, fields=["time", "temperature_2m", "wind_speed_10m", "direct_radiation"])
    got = sorted(out.select("timestamp", "wind_speed_10m").collect(), key=lambda r: r.wind_speed_10m)
    assert got[0].timestamp == dt.datetime(2024, 1, 1, 0, 0)
    assert got[1].timestamp is None  # malformed, dropped later by the non-null filter
    assert "time" not in out.columns and "latitude" in out.columns


def test_transform_registry(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert apply_transform(df, "passthrough").collect() == df.collect()
    with pytest.raises(ValueError, match="unknown transform"):
        apply_transform(df, "nope")
