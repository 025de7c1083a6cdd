import pytest
from pyspark.sql import functions as F

from hourmill.operators.mart import chart, default_sums, preview, relationship


def _gold(spark):
    rows = [
        ("2024-01-01 00:00:00", 1.0, None, "NORMAL"),
        ("2024-01-01 01:00:00", 2.0, 1.0, "NORMAL"),
        ("2024-01-01 02:00:00", 1.0, 1.5, "CHEAP"),
        ("2024-01-01 03:00:00", 3.0, 1.1, "NORMAL"),
    ]
    df = spark.createDataFrame(rows, "timestamp string, price double, avg_price_last_3h double, label string")
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def test_chart_orders_by_sum_desc(spark):
    got = [tuple(r) for r in chart(_gold(spark)).collect()]
    assert got == [(1.0, 1.5), (3.0, 1.1), (2.0, 1.0)]


def test_default_sums_per_label(spark):
    got = {r.label: (r.sum_price, r.sum_avg_price_last_3h) for r in default_sums(_gold(spark)).collect()}
    assert got == {"NORMAL": (6.0, 2.1), "CHEAP": (1.0, 1.5)}


def test_relationship_full_outer_and_uniqueness(spark):
    g = _gold(spark)
    air = spark.createDataFrame([("2024-01-01 03:00:00", 9.0), ("2024-01-01 09:00:00", 8.0)], "timestamp string, pm10 double")
    air = air.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    out = relationship(g, air)
    assert out.count() == 5 and "air_pm10" in out.columns
    with pytest.raises(ValueError, match="not unique"):
        relationship(g, air.unionByName(air)).count()


def test_preview_is_ordered_top_n(spark):
    got = [r.price for r in preview(_gold(spark), 2).collect()]
    assert got == [1.0, 2.0]


def test_preview_sql_over_a_view(spark):
    from hourmill.operators.mart import preview_sql

    _gold(spark).createOrReplaceTempView("gold_preview_view")
    got = [r.price for r in preview_sql(spark, "gold_preview_view", 3).collect()]
    assert got == [1.0, 2.0, 1.0]
