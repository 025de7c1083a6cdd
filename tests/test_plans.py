"""Physical-plan audit of the registered queries (what the scale design promises)."""

import re

import pytest

from hourmill.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
FORBIDDEN = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|PythonUDF")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_forbidden_operators(spark, name):
    plan = _plan(REGISTRY[name](spark, SF))
    assert not FORBIDDEN.search(plan), plan
    if name != "recompute_start":  # a global MAX ends in one partial row per partition
        assert "SinglePartition" not in plan, plan


def test_flagship_scan_is_pruned_and_filtered(spark):
    from hourmill.plans import testbed as tb

    hourly = tb.hourly_stand_ins(tb.load(spark, SF, "events"))
    plan = _plan(hourly)
    assert "PushedFilters: [In(event_type, [click,error,view])]" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan


def test_dedupe_is_partially_aggregated_before_the_shuffle(spark):
    from hourmill.operators.quality import dedupe_latest
    from hourmill.plans import testbed as tb

    ev = tb.load(spark, SF, "events")
    plan = _plan(dedupe_latest(ev, ["event_type"], newest=["ts"]))
    first_exchange = plan.index("Exchange")
    assert "partial_max" in plan[first_exchange:], plan  # map-side max below the exchange


def test_silver_read_prunes_date_partitions(spark, scratch):
    import datetime as dt

    from pyspark.sql import functions as F

    from hourmill.plans.silver import read_silver
    from hourmill.sinks.tables import replace_table

    df = spark.range(48).select(
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp") + F.make_dt_interval(hours=F.col("id"))).alias("timestamp"),
        F.col("id").cast("double").alias("price"),
    ).withColumn("date", F.to_date("timestamp"))
    replace_table(df, scratch, ["date"])
    out = read_silver(spark, scratch, dt.datetime(2024, 1, 2, 6, 0))
    plan = _plan(out)
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-02" in plan
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp," in plan
    assert out.count() == 18


def test_trailing_join_back_does_not_shuffle_the_rows(spark):
    """The per-second frames are measured and broadcast; the event rows are
    joined where they are scanned."""
    plan = _plan(REGISTRY["trailing_avg"](spark, SF))
    assert "BroadcastHashJoin" in plan and "BroadcastExchange" in plan, plan
    assert "Exchange hashpartitioning" not in plan, plan
