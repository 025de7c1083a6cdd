import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourmill.sinks.tables import (
    read_table,
    replace_table,
    table_exists,
    upsert_named,
    upsert_path,
    write_layer,
)


def _rows(spark, rows):
    df = spark.createDataFrame(rows, "timestamp string, value double, k string")
    df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return df.withColumn("date", F.to_date("timestamp"))


def _content(spark, path):
    return sorted((r.k, r.value, r.date) for r in read_table(spark, path).collect())


def test_upsert_creates_updates_inserts_and_keeps_other_partitions(spark, scratch):
    base = _rows(spark, [("2024-01-01 01:00:00", 1.0, "a"), ("2024-01-02 01:00:00", 2.0, "b"), ("2024-01-03 01:00:00", 3.0, "c")])
    res = upsert_path(spark, base, scratch, ["k"], ["date"], track="timestamp")
    assert res.rows == 3 and table_exists(spark, scratch)
    batch = _rows(spark, [("2024-01-02 01:00:00", 20.0, "b"), ("2024-01-02 05:00:00", 5.0, "e")])
    res = upsert_path(spark, batch, scratch, ["k"], ["date"], track="timestamp")
    assert res.rows == 2 and res.changed == 2 and res.partitions == 1
    assert res.earliest_change == dt.datetime(2024, 1, 2, 1, 0)
    d = dt.date
    assert _content(spark, scratch) == [
        ("a", 1.0, d(2024, 1, 1)), ("b", 20.0, d(2024, 1, 2)), ("c", 3.0, d(2024, 1, 3)), ("e", 5.0, d(2024, 1, 2))
    ]


def test_upsert_twice_is_idempotent_and_reports_no_change(spark, scratch):
    base = _rows(spark, [("2024-01-01 01:00:00", 1.0, "a")])
    replace_table(base, scratch, ["date"])
    batch = _rows(spark, [("2024-01-01 01:00:00", 9.0, "a"), ("2024-01-01 02:00:00", 2.0, "b")])
    upsert_path(spark, batch, scratch, ["k"], ["date"])
    once = _content(spark, scratch)
    again = upsert_path(spark, batch, scratch, ["k"], ["date"], track="timestamp")
    assert _content(spark, scratch) == once
    assert again.changed == 0 and again.earliest_change is None


def test_null_keys_never_match(spark, scratch):
    base = _rows(spark, [("2024-01-01 01:00:00", 1.0, None)])
    replace_table(base, scratch, ["date"])
    upsert_path(spark, _rows(spark, [("2024-01-01 02:00:00", 2.0, None)]), scratch, ["k"], ["date"])
    assert len(_content(spark, scratch)) == 2


def test_write_layer_modes(spark, scratch):
    a = _rows(spark, [("2024-01-01 01:00:00", 1.0, "a")])
    write_layer(spark, a, scratch, mode="full_refresh", keys=["k"])
    write_layer(spark, a, scratch, mode="incremental", keys=["k"], merge=False)  # merge off: append
    assert len(_content(spark, scratch)) == 2
    write_layer(spark, a, scratch, mode="full_refresh", keys=["k"])
    assert len(_content(spark, scratch)) == 1
    with pytest.raises(ValueError):
        write_layer(spark, a, scratch, mode="sometimes", keys=["k"])
    with pytest.raises(ValueError):
        upsert_path(spark, a, scratch, [], ["date"])


def test_upsert_named_creates_then_merges(spark, scratch):
    name = "t_" + scratch.rsplit("-", 1)[-1]
    upsert_named(spark, _rows(spark, [("2024-01-01 01:00:00", 1.0, "a")]), name, ["k"], scratch)
    upsert_named(spark, _rows(spark, [("2024-01-01 01:00:00", 7.0, "a")]), name, ["k"], scratch)
    assert [(r.k, r.value) for r in spark.table(name).collect()] == [("a", 7.0)]


def test_replace_named_replaces_the_schema(spark, scratch):
    from hourmill.sinks.tables import replace_named

    name = "t_" + scratch.rsplit("-", 1)[-1]
    replace_named(spark, _rows(spark, [("2024-01-01 01:00:00", 1.0, "a")]), name, scratch)
    wider = _rows(spark, [("2024-01-02 01:00:00", 2.0, "b")]).withColumn("extra", F.lit("x"))
    replace_named(spark, wider, name, scratch)
    t = spark.table(name)
    assert "extra" in t.columns and [(r.k, r.extra) for r in t.collect()] == [("b", "x")]


def test_empty_batches(spark, scratch):
    empty = _rows(spark, [("2024-01-01 01:00:00", 1.0, "a")]).where("false")
    res = upsert_path(spark, empty, scratch, ["k"], ["date"], track="timestamp")
    assert res.rows == 0 and table_exists(spark, scratch) and read_table(spark, scratch).count() == 0  # its schema is kept
    upsert_path(spark, _rows(spark, [("2024-01-01 01:00:00", 1.0, "a")]), scratch, ["k"], ["date"])
    res = upsert_path(spark, empty, scratch, ["k"], ["date"], track="timestamp")
    assert res.rows == 0 and res.earliest_change is None
    assert _content(spark, scratch) == [("a", 1.0, dt.date(2024, 1, 1))]


@pytest.mark.parametrize("partition_by", [["date"], []])
def test_repeated_batch_key_raises_and_writes_nothing(spark, scratch, partition_by):
    base = _rows(spark, [("2024-01-01 01:00:00", 1.0, "a")])
    upsert_path(spark, base, scratch, ["k"], partition_by)
    before = _content(spark, scratch)
    twice = _rows(spark, [("2024-01-01 01:00:00", 2.0, "a"), ("2024-01-01 01:00:00", 3.0, "a")])
    with pytest.raises(ValueError, match="repeats key"):
        upsert_path(spark, twice, scratch, ["k"], partition_by)
    assert _content(spark, scratch) == before


def test_repeated_key_in_first_batch_raises(spark, scratch):
    twice = _rows(spark, [("2024-01-01 01:00:00", 2.0, "a"), ("2024-01-01 01:00:00", 3.0, "a")])
    with pytest.raises(ValueError, match="repeats key"):
        upsert_path(spark, twice, scratch, ["k"], ["date"])
    assert not table_exists(spark, scratch)


def test_repeated_null_keys_are_inserted(spark, scratch):
    base = _rows(spark, [("2024-01-01 01:00:00", 1.0, "a")])
    upsert_path(spark, base, scratch, ["k"], ["date"])
    nulls = _rows(spark, [("2024-01-01 02:00:00", 2.0, None), ("2024-01-01 03:00:00", 3.0, None)])
    upsert_path(spark, nulls, scratch, ["k"], ["date"])
    assert read_table(spark, scratch).count() == 3


def test_upsert_without_partitions(spark, scratch):
    base = _rows(spark, [("2024-01-01 01:00:00", 1.0, "a"), ("2024-01-02 01:00:00", 2.0, "b")])
    upsert_path(spark, base, scratch, ["k"], [])
    res = upsert_path(spark, _rows(spark, [("2024-01-02 01:00:00", 20.0, "b"), ("2024-01-03 01:00:00", 3.0, "c")]), scratch, ["k"], [])
    assert (res.rows, res.changed, res.partitions) == (2, 2, -1)
    assert [r[:2] for r in _content(spark, scratch)] == [("a", 1.0), ("b", 20.0), ("c", 3.0)]


def test_text_partitions_keep_their_text(spark, scratch):
    """``007`` is not 7: the batch meets the stored row, and the value comes back as it was."""
    rows = [("a", 1, "007"), ("b", 2, "7"), ("c", 3, None), ("d", 4, "x=1/2 %"), ("e", 5, "it's")]
    replace_table(spark.createDataFrame(rows, "k string, v long, part string"), scratch, ["part"])
    batch = spark.createDataFrame([("a", 10, "007"), ("c", 30, None), ("d", 40, "x=1/2 %"), ("f", 60, "")], "k string, v long, part string")
    res = upsert_path(spark, batch, scratch, ["k"], ["part"])
    assert (res.rows, res.changed, res.partitions, res.rewritten) == (4, 4, 4, 4)
    got = sorted((r.k, r.v, r.part) for r in read_table(spark, scratch).collect())
    # Spark writes empty text as a NULL partition.
    assert got == [("a", 10, "007"), ("b", 2, "7"), ("c", 30, None), ("d", 40, "x=1/2 %"), ("e", 5, "it's"), ("f", 60, None)]


def test_text_partitions_of_a_catalog_table(spark, scratch):
    name = "t_text_" + scratch.rsplit("-", 1)[-1]
    rows = [("a", 1, "007", 1), ("b", 2, "it's", 1)]
    upsert_named(spark, spark.createDataFrame(rows, "k string, v long, part string, n int"), name, ["k"], scratch, ["part", "n"])
    upsert_named(spark, spark.createDataFrame([("a", 5, "007", 1), ("c", 3, "00", 2)], "k string, v long, part string, n int"), name, ["k"], scratch, ["part", "n"])
    upsert_named(spark, spark.createDataFrame([("b", 6, "it's", 1), ("d", 7, None, 3)], "k string, v long, part string, n int"), name, ["k"], scratch, ["part", "n"])
    got = sorted((r.k, r.v, r.part, r.n) for r in spark.table(name).collect())
    assert got == [("a", 5, "007", 1), ("b", 6, "it's", 1), ("c", 3, "00", 2), ("d", 7, None, 3)]


def test_only_named_partitions_are_read_and_differing_ones_written(spark, scratch, monkeypatch):
    import hourmill.sinks.tables as tables

    base = _rows(spark, [(f"2024-01-{d:02} 01:00:00", float(d), f"k{d}") for d in range(1, 29)])
    replace_table(base, scratch, ["date"])
    read = []
    real = tables.read_partitions

    def spy(*args):
        df = real(*args)
        read.append(sorted({f.rsplit("/", 2)[-2] for f in df.inputFiles()}))
        return df

    monkeypatch.setattr(tables, "read_partitions", spy)
    batch = _rows(spark, [("2024-01-05 01:00:00", 5.0, "k5"), ("2024-01-09 01:00:00", 90.0, "k9"), ("2024-02-01 01:00:00", 1.0, "new")])
    res = upsert_path(spark, batch, scratch, ["k"], ["date"], track="timestamp")
    assert read == [["date=2024-01-05", "date=2024-01-09"]]
    assert (res.partitions, res.rewritten, res.specs) == (3, 2, (("2024-01-09",), ("2024-02-01",)))
    assert res.dirty == ((dt.date(2024, 1, 9), 1 << 1), (dt.date(2024, 2, 1), 1 << 1))
    assert read_table(spark, scratch).count() == 29


def test_older_versions_do_not_win(spark, scratch):
    rows = lambda *r: spark.createDataFrame(r, "k string, v long, version string, part int")
    replace_table(rows(("a", 1, "2", 0), ("b", 1, "2", 0), ("c", 1, None, 0), ("e", 1, "1", 1)), scratch, ["part"])
    res = upsert_path(spark, rows(("a", 9, "1", 0), ("b", 9, "2", 0), ("c", 9, "1", 0), ("d", 9, "1", 0), ("e", 1, "3", 1)), scratch, ["k"], ["part"], version="version")
    assert (res.changed, res.rewritten) == (3, 2)  # e only has a newer version: written, not changed
    got = sorted((r.k, r.v, r.version) for r in read_table(spark, scratch).collect())
    assert got == [("a", 1, "2"), ("b", 9, "2"), ("c", 9, "1"), ("d", 9, "1"), ("e", 1, "3")]
    upsert_path(spark, rows(("e", 5, "2", 1)), scratch, ["k"], ["part"], version="version")
    assert [r.v for r in read_table(spark, scratch).where("k = 'e'").collect()] == [1]


def test_what_changes_is_told_before_files_are_swapped(spark, scratch):
    told = []

    def before(dirty):
        told.append((dirty, _content(spark, scratch) if table_exists(spark, scratch) else None))

    first = _rows(spark, [("2024-01-01 01:00:00", 1.0, "a"), ("2024-01-01 23:30:00", 1.0, "z")])
    upsert_path(spark, first, scratch, ["k"], ["date"], track="timestamp", before_swap=before)
    assert told == [((), None)]  # a new table: everything
    stored = _content(spark, scratch)
    upsert_path(spark, first, scratch, ["k"], ["date"], track="timestamp", before_swap=before)
    assert len(told) == 1  # nothing changed
    batch = _rows(spark, [("2024-01-01 05:10:00", 2.0, "a"), ("2024-01-01 23:30:00", 3.0, "z")])
    upsert_path(spark, batch, scratch, ["k"], ["date"], track="timestamp", before_swap=before)
    assert told[1] == (((dt.date(2024, 1, 1), 1 << 5 | 1 << 23),), stored)


def test_schema_change():
    from pyspark.sql import types as T

    from hourmill.sinks.tables import SchemaChange, schema_change

    old = T.StructType.fromDDL("a int, b float, c decimal(8,2), d string, e int, f bigint")
    new = T.StructType.fromDDL("a bigint, b double, c decimal(10,2), d int, f int, g string")
    assert schema_change(old, new) == SchemaChange(("g",), ("e",), ("a", "b", "c"), ("d", "f"))
    assert not schema_change(old, old)


def test_register_adds_columns_without_making_the_entry_anew(spark, scratch, monkeypatch):
    from hourmill.sinks.tables import register_table, replace_named

    name = "t_add_" + scratch.rsplit("-", 1)[-1]
    replace_named(spark, _rows(spark, [("2024-01-01 01:00:00", 1.0, "a")]), name, scratch)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('owner_note' = 'stays')")
    replace_table(_rows(spark, [("2024-01-02 01:00:00", 2.0, "b")]).withColumn("extra", F.lit(7)), scratch, ["date"])
    assert register_table(spark, name, scratch, replace_schema=True).added == ("extra",)
    assert [(r.k, r.extra, r.date) for r in spark.table(name).collect()] == [("b", 7, dt.date(2024, 1, 2))]
    assert "stays" in str(spark.sql(f"SHOW TBLPROPERTIES {name}").collect())


def test_v2_tables_are_merged_by_their_catalog(spark, scratch, monkeypatch):
    """Which way an upsert takes; no V2 catalog can be run here, so its merge is a stand-in."""
    import hourmill.sinks.tables as tables

    merged = []
    monkeypatch.setattr(tables, "merge_into", lambda df, name, keys, version=None: merged.append((name, keys, version, df.count())))
    batch = _rows(spark, [("2024-01-01 01:00:00", 1.0, "a")])
    spark.conf.set("spark.sql.catalog.lake", "no.such.Catalog")
    try:
        assert tables.merges_itself(spark, "lake.db.t") and not tables.merges_itself(spark, "db.t") and not tables.merges_itself(spark, "t")
        upsert_named(spark, batch, "lake.db.t", ["k"], scratch, version="timestamp")
    finally:
        spark.conf.unset("spark.sql.catalog.lake")
    assert merged == [("lake.db.t", ["k"], "timestamp", 1)] and not table_exists(spark, scratch)
    name = "t_v1_" + scratch.rsplit("-", 1)[-1]
    upsert_named(spark, batch, name, ["k"], scratch)
    assert len(merged) == 1 and spark.table(name).count() == 1


def test_merge_into_a_table_that_cannot_raises(spark, scratch):
    from pyspark.errors import PySparkException

    from hourmill.sinks.tables import merge_into

    name = "t_nomerge_" + scratch.rsplit("-", 1)[-1]
    upsert_named(spark, _rows(spark, [("2024-01-01 01:00:00", 1.0, "a")]), name, ["k"], scratch)
    with pytest.raises(PySparkException):
        merge_into(_rows(spark, [("2024-01-01 01:00:00", 2.0, "a")]), name, ["k"])
    assert [r.value for r in spark.table(name).collect()] == [1.0]


@pytest.mark.parametrize("partition_by", [["date"], []])
def test_managed_table_is_upserted_by_the_catalog(spark, scratch, partition_by):
    from hourmill.sinks.tables import is_managed, replace_named, write_managed

    name = "t_managed_up_" + scratch.rsplit("-", 1)[-1]
    base = _rows(spark, [("2024-01-01 01:00:00", 1.0, "a"), ("2024-01-02 01:00:00", 2.0, "b")])
    writer = base.write.partitionBy(*partition_by) if partition_by else base.write
    writer.saveAsTable(name)
    batch = _rows(spark, [("2024-01-02 01:00:00", 20.0, "b"), ("2024-01-03 01:00:00", 3.0, "c")])
    res = write_managed(spark, batch, name, mode="incremental", keys=["k"], partition_by=partition_by)
    assert (res.rows, res.changed) == (2, 2) and is_managed(spark, name)
    assert sorted((r.k, r.value) for r in spark.table(name).collect()) == [("a", 1.0), ("b", 20.0), ("c", 3.0)]
    write_managed(spark, batch, name, mode="incremental", keys=["k"], merge=False, partition_by=partition_by)
    assert spark.table(name).count() == 5
    write_managed(spark, batch, name, mode="full_refresh", keys=["k"], partition_by=partition_by)
    assert spark.table(name).count() == 2 and is_managed(spark, name)
    spark.sql(f"DROP TABLE {name}")


def test_metrics_are_rows(spark, scratch):
    from hourmill.sinks.metrics import record_write, write_metrics

    res = upsert_path(spark, _rows(spark, [("2024-01-01 01:00:00", 1.0, "a")]), scratch + "/t", ["k"], track="timestamp")
    record_write(spark, scratch + "/m", "t", "incremental", res)
    res = upsert_path(spark, _rows(spark, [("2024-01-01 02:00:00", 1.0, "b")]), scratch + "/t", ["k"], track="timestamp")
    record_write(spark, scratch + "/m", "t", "incremental", res)
    rows = write_metrics(spark, scratch + "/m").orderBy("written_at").collect()
    assert [(r.batch_rows, r.changed_rows, r.named_partitions, r.rewritten_partitions) for r in rows] == [(1, 1, None, None), (1, 1, 1, 1)]
    assert rows[1].earliest_change == dt.datetime(2024, 1, 1, 2)


def _stored(spark, n=5):
    return spark.range(n).selectExpr("id", "id * 10 as v", "date'2024-01-01' as date")


def test_upsert_into_a_table_without_commit_marker(spark, scratch):
    """Another tool wrote the table, or the marker is switched off: no stored row is lost."""
    from hourmill.session import remove_path
    from hourmill.sinks.tables import read_table, replace_table, upsert_path

    replace_table(_stored(spark), scratch, ["date"])
    remove_path(spark, f"{scratch}/_SUCCESS")
    upsert_path(spark, _stored(spark, 1).selectExpr("id", "99L as v", "date"), scratch, ["id"])
    assert sorted((r.id, r.v) for r in read_table(spark, scratch).collect()) == [(0, 99), (1, 10), (2, 20), (3, 30), (4, 40)]


def test_empty_table_keeps_its_schema(spark, scratch):
    from hourmill.sinks.tables import read_table, replace_table, table_exists, upsert_path

    replace_table(_stored(spark).limit(0), scratch, ["date"])
    empty = read_table(spark, scratch)
    assert table_exists(spark, scratch) and empty.count() == 0 and empty.columns == ["id", "v", "date"]
    upsert_path(spark, _stored(spark, 2), scratch, ["id"])
    assert read_table(spark, scratch).count() == 2


def test_managed_table_is_replaced_not_dropped(spark, scratch):
    import pytest

    from hourmill.sinks.tables import is_managed, register_table, replace_named

    name = "t_managed_replace"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    _stored(spark).write.saveAsTable(name)
    assert is_managed(spark, name)
    with pytest.raises(ValueError, match="managed"):
        register_table(spark, name, scratch, replace_schema=True)
    assert spark.table(name).count() == 5
    wider = _stored(spark, 3).selectExpr("id", "cast(v as string) as v", "1 as extra", "date")
    assert replace_named(spark, wider, name, scratch).rows == 3
    assert is_managed(spark, name) and spark.table(name).count() == 3 and "extra" in spark.table(name).columns
    spark.sql(f"DROP TABLE {name}")
