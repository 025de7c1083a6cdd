
from pyspark.sql import functions as F

from hourmill.sources.snapshots import ENERGY_SCHEMA, land_snapshots, read_snapshot, read_snapshots, with_snapshot_column


def _docs(spark, names):
    rows = [([(float(i), "2024-01-01T00:00:00Z")], 0.0, "a", "b", 4, n) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, with_snapshot_column(ENERGY_SCHEMA))


def test_landing_keeps_history_unless_replaced(spark, scratch):
    land_snapshots(_docs(spark, ["2024-01-01_2024-01-08"]), scratch)
    land_snapshots(_docs(spark, ["2024-01-02_2024-01-09"]), scratch)
    land_snapshots(_docs(spark, ["2024-01-02_2024-01-09"]), scratch)  # re-landing one fetch: one copy
    assert read_snapshots(spark, scratch, ENERGY_SCHEMA).count() == 2
    assert read_snapshots(spark, scratch, ENERGY_SCHEMA, since="2024-01-02_2024-01-09").count() == 1
    land_snapshots(_docs(spark, ["2024-01-03_2024-01-10"]), scratch, replace=True)
    got = [r.snapshot for r in read_snapshots(spark, scratch, ENERGY_SCHEMA).collect()]
    assert got == ["2024-01-03_2024-01-10"]


def test_pluggable_format(spark, scratch):
    _docs(spark, ["2024-01-01_2024-01-08"]).write.partitionBy("snapshot").parquet(scratch)
    df = read_snapshot(spark, scratch, "2024-01-01_2024-01-08", ENERGY_SCHEMA, fmt="parquet")
    assert df.select(F.col("snapshot")).collect()[0].snapshot == "2024-01-01_2024-01-08"
    assert df.select(F.explode("Prices")).count() == 1


def test_manifest_knows_what_has_landed(spark, scratch):
    import datetime as dt

    import pytest
    from pyspark.errors import AnalysisException

    from hourmill.session import remove_path
    from hourmill.sources.snapshots import has_landed, landed_names, read_incremental

    assert landed_names(spark, scratch) == [] and not has_landed(spark, scratch, "2024-01-01_2024-01-08")
    land_snapshots(_docs(spark, ["2024-01-01_2024-01-08", "2024-01-03_2024-01-10"]), scratch)
    assert landed_names(spark, scratch) == ["2024-01-01_2024-01-08", "2024-01-03_2024-01-10"]
    df, fell_back = read_incremental(spark, scratch, dt.date(2024, 1, 9), ENERGY_SCHEMA)
    assert fell_back and df.count() == 2
    df, fell_back = read_incremental(spark, scratch, dt.date(2024, 1, 10), ENERGY_SCHEMA, until="2024-01-02_2024-01-09")
    assert fell_back and df.count() == 1
    with pytest.raises(AnalysisException):
        read_incremental(spark, scratch, dt.date(2024, 1, 9), ENERGY_SCHEMA, fallback=False)
    # Landed by another tool: known by its folders; a later landing takes them over.
    for name in landed_names(spark, scratch):
        remove_path(spark, f"{scratch}/_landed/{name}")
    remove_path(spark, f"{scratch}/_landed")
    assert has_landed(spark, scratch, "2024-01-01_2024-01-08")
    land_snapshots(_docs(spark, ["2024-01-04_2024-01-11"]), scratch)
    assert len(landed_names(spark, scratch)) == 3
    land_snapshots(_docs(spark, ["2024-01-05_2024-01-12"]), scratch, replace=True)
    assert landed_names(spark, scratch) == ["2024-01-05_2024-01-12"]
