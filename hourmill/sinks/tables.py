"""Table sinks: replace, upsert (by key) and append, for paths and catalog tables.

Storage is Parquet, partitioned (by ``date`` as a rule). An upsert reads and
rewrites only partitions the batch names:

    named    = partition values present in the batch
    merged   = stored rows of named partitions FULL OUTER JOIN the batch on
               the keys; the batch row wins where present (with a version
               column: unless the stored row's version is newer)
    write    merged -> those partitions where a row differs (dynamic
               partition overwrite); nothing differs, nothing is written

Named partitions are read by their own paths (``basePath``), with the schema
the table keeps beside its data, so no other folder is listed and partition
values have the type they were written with (text ``007`` stays text).

The merge reads the partitions it overwrites. That is safe with dynamic
partition overwrite: tasks write into the job's staging folder and the
partition folders are swapped only at job commit, after every task (retries
and recomputed parent stages included) has finished reading the old files. A
lost executor therefore only reruns tasks against unchanged input. The swap
itself is not transactional (Parquet has no log); a driver failure inside it
can leave some partitions old and some new, and re-running the same batch
repairs it because the upsert is idempotent. What changed is known before the
swap (``before_swap``), so a caller can note it first.

Equi-join matching means NULL keys never match: a stored row with a NULL
key is kept and a batch row with a NULL key is inserted, as in MERGE.

Tables of a V2 catalog are merged by the catalog itself (``DataFrame.mergeInto``).
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmill.session import path_exists, read_small_text, scratch_path, visible_children, write_small_text

#: Per day, the hours with a changed row as bits 0 to 23.
Dirty = tuple[tuple[dt.date, int], ...]


@dataclass(frozen=True)
class WriteResult:
    rows: int  # rows of the written batch
    partitions: int  # partitions the batch names (-1 when not counted)
    changed: int = -1  # batch rows that were new or differed from the stored row
    earliest_change: dt.datetime | None = None  # min ``track`` column over changed rows
    rewritten: int = -1  # partitions that were written (-1 when not counted)
    specs: tuple[tuple[str | None, ...], ...] = ()  # their values, as text
    dirty: Dirty = ()  # by ``track``, only with ``before_swap``


#: Keeps the schema of a table: types of partition values, and all columns of a table without rows.
SCHEMA_FILE = ".hourmill-schema.json"


def _schema_path(path: str) -> str:
    return f"{path.rstrip('/')}/{SCHEMA_FILE}"


def table_exists(spark: SparkSession, path: str) -> bool:
    """A table exists when its folder holds data or a kept schema, whoever wrote it.

    The commit marker is not asked: other tools, and Spark with
    ``marksuccessfuljobs`` off, write none.
    """
    return visible_children(spark, path) or path_exists(spark, _schema_path(path))


def _micros_to_datetime(v) -> dt.datetime | None:
    return None if v is None else dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=int(v))


def _micros(c: str):
    return F.unix_micros(F.col(c).cast(T.TimestampType()))


def _hour_bits(flag, track: str):
    """The hours of day (UTC session) of rows with ``flag``, as bits."""
    bit = F.expr(f"shiftleft(1, hour(cast(`{track}` as timestamp)))")
    return F.coalesce(F.bit_or(F.when(flag, bit)), F.lit(0))


def _partitioned_writer(df: DataFrame, partition_by: Sequence[str]):
    """Writer with one right-sized set of files per partition value.

    The ``rebalance`` hint shuffles rows by the partition columns so a
    date folder is not split into one small file per input task; AQE
    splits an oversized (skewed) partition value and merges small ones.
    """
    if partition_by:
        return df.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
    return df.write


def _keep_schema(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str]) -> None:
    """Write the schema beside the data, partition columns last, as a read returns it."""
    fields = [f for f in schema.fields if f.name not in partition_by] + [schema[c] for c in partition_by]
    write_small_text(spark, _schema_path(path), T.StructType(fields).json())


def kept_schema(spark: SparkSession, path: str) -> T.StructType | None:
    text = read_small_text(spark, _schema_path(path))
    return None if text is None else T.StructType.fromJson(json.loads(text))


def replace_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    track: str | None = None,
    before_swap: Callable[[Dirty], None] | None = None,
) -> WriteResult:
    """Overwrite the whole table at ``path`` (schema included).

    With ``track`` every row counts as changed and the earliest value of
    that timestamp column is reported. ``before_swap`` is called first, with
    no days: everything may change.
    """
    metrics = [F.count(F.lit(1)).alias("rows")]
    if track:
        metrics.append(F.min(_micros(track)).alias("first"))
    if before_swap:
        before_swap(())
    obs = Observation("replace")
    _partitioned_writer(df.observe(obs, *metrics), partition_by).mode("overwrite").parquet(path)
    got = obs.get
    rows = int(got["rows"])
    _keep_schema(df.sparkSession, path, df.schema, partition_by)
    return WriteResult(rows, -1, rows if track else -1, _micros_to_datetime(got.get("first")) if track else None)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``, with the schema it was written with.

    A table that another tool wrote, without a kept schema, is read as Spark
    infers it (partition values included).
    """
    schema = kept_schema(spark, path)
    if not visible_children(spark, path) and schema is not None:
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)


def partition_folder(spark: SparkSession, path: str, partition_by: Sequence[str], spec: Sequence[str | None]) -> str:
    """Where the partition with these values (as text, None for NULL) lies."""
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join([path.rstrip("/"), *(escape(c, v) for c, v in zip(partition_by, spec, strict=True))])


def read_partitions(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str], specs: Sequence[Sequence[str | None]]
) -> DataFrame:
    """Rows of some partitions, read by their own paths; absent ones have none. No other folder is listed."""
    folders = [f for f in (partition_folder(spark, path, partition_by, s) for s in specs) if path_exists(spark, f)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def _key_multiplicity(batch: DataFrame, keys: Sequence[str], group: Sequence[str]) -> DataFrame:
    """Per ``group`` value: the largest number of batch rows sharing one key.

    Rows with a NULL key part are left out (they never match, so repeats
    are inserted as they are). Both steps are partial aggregations, so a
    repeated or hot key is counted map-side.
    """
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    per_key = batch.groupBy(*dict.fromkeys([*keys, *group])).agg(
        F.count(F.when(keyed, F.lit(1))).alias("_hm_n")
    )
    return per_key.groupBy(*group).agg(F.max("_hm_n").alias("_hm_max_n"))


def _raise_on_repeats(max_n, keys: Sequence[str]) -> None:
    if max_n is not None and max_n > 1:
        raise ValueError(
            f"upsert batch repeats key {list(keys)} ({max_n} rows for one key); "
            "deduplicate it first (a MERGE would reject it too)"
        )


def merge_rows(stored: DataFrame, batch: DataFrame, keys: Sequence[str], version: str | None = None) -> tuple[DataFrame, str]:
    """Stored rows overlaid with batch rows by key, plus a per-row "changed" flag.

    One full outer join on the keys: a key present in the batch takes the
    batch row (update or insert), otherwise the stored row stays. With
    ``version`` a batch row older than the stored one does not count (equal
    and unknown versions do). A batch row is *changed* when its key is new or
    a value other than the version differs (NULL-safe).
    Returns the merged frame (with columns ``_hm_in_batch``, ``_hm_changed``
    and ``_hm_differs``: changed, or of a newer version) and the flag's name.
    """
    keys = list(keys)
    values = [c for c in stored.columns if c not in keys]
    old = stored.select(*keys, *[F.col(c).alias(f"_hm_old_{c}") for c in values], F.lit(True).alias("_hm_in_store"))
    new = batch.select(*keys, *[F.col(c).alias(f"_hm_new_{c}") for c in values], F.lit(True).alias("_hm_in_batch"))
    j = old.join(new, keys, "full_outer")
    in_batch = F.col("_hm_in_batch").isNotNull()
    wins = in_batch
    if version:
        older = F.col(f"_hm_new_{version}") < F.col(f"_hm_old_{version}")
        wins = in_batch & ~F.coalesce(older, F.lit(False))
    absent = F.col("_hm_in_store").isNull()
    unequal = {c: ~F.col(f"_hm_new_{c}").eqNullSafe(F.col(f"_hm_old_{c}")) for c in values}
    changed = absent
    for c in values:
        if c != version:
            changed = changed | unequal[c]
    merged = j.select(
        *[
            F.col(c) if c in keys else F.when(wins, F.col(f"_hm_new_{c}")).otherwise(F.col(f"_hm_old_{c}")).alias(c)
            for c in stored.columns
        ],
        in_batch.alias("_hm_in_batch"),
        (wins & changed).alias("_hm_changed"),
        (wins & (changed | unequal[version] if version else changed)).alias("_hm_differs"),
    )
    return merged, "_hm_changed"


def _profile(batch: DataFrame, partition_by: Sequence[str], keys: Sequence[str]) -> list[tuple[str | None, ...]]:
    """Partition values of the batch as text; with ``keys`` the same job checks that no key repeats.

    The values are bounded by the partitions a batch names (days), not by its rows.
    """
    as_text = [F.col(c).cast("string").alias(c) for c in partition_by]
    if not keys:
        return [tuple(r) for r in batch.select(*partition_by).distinct().select(*as_text).collect()]
    got = _key_multiplicity(batch, keys, partition_by).select(*as_text, "_hm_max_n").collect()
    _raise_on_repeats(max((r["_hm_max_n"] or 0 for r in got), default=0), keys)
    return [tuple(r)[:-1] for r in got]


def upsert_path(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = ("date",),
    track: str | None = None,
    check_keys: bool = True,
    version: str | None = None,
    before_swap: Callable[[Dirty], None] | None = None,
) -> WriteResult:
    """Update matched keys and insert new ones into the table at ``path``.

    Keys must determine the partition (e.g. key ``timestamp`` or its hash,
    partition ``date`` of that timestamp): only partitions present in the
    batch are read, only those with a differing row are rewritten. Creates
    the table when it does not exist yet. A key may occur once in the batch
    (rows with a NULL key part excepted); a repeated key raises before
    anything is written, as a MERGE would, checked in the job that lists the
    partitions. Callers whose batch was just deduplicated on these keys pass
    ``check_keys=False``. With ``track`` (a timestamp column) the earliest
    changed row is measured, and the changed hours of each day.
    ``version``, if the table has that column, keeps stored rows that are
    newer than the batch's. ``before_swap`` is called with the changed hours
    before any stored file is replaced (with none if the table is new: all is
    changed), and not at all if nothing changed.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("upsert needs at least one key column; use append_path otherwise")
    if not table_exists(spark, path):
        if not check_keys:
            return replace_table(batch, path, partition_by, track, before_swap)
        # The batch is read twice (key check, then the write): kept for the
        # call, as below, so its upstream plan runs once.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _raise_on_repeats(_key_multiplicity(batch, keys, []).first()["_hm_max_n"], keys)
            return replace_table(batch, path, partition_by, track, before_swap)
        finally:
            batch.unpersist()

    partition_by = list(partition_by)
    kept = kept_schema(spark, path)
    schema = kept or read_table(spark, path).schema
    missing = [c for c in schema.fieldNames() if c not in batch.columns]
    if missing:
        raise ValueError(f"batch lacks table columns {missing}")
    batch = batch.select(*[batch[c].cast(schema[c].dataType) for c in schema.fieldNames()])
    if version not in schema.fieldNames():
        version = None
    # The batch is used twice (its partitions, then the merge), the merged
    # rows too (what differs, then the write): kept for the duration of this
    # call instead of running their plans twice. Lost blocks are recomputed
    # from lineage; released on return.
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    merged = None
    try:
        specs = _profile(batch, partition_by, keys if check_keys else ())
        stored = read_partitions(spark, path, schema, partition_by, specs) if partition_by else read_table(spark, path)
        merged, flag = merge_rows(stored, batch, keys, version)
        merged = merged.persist(StorageLevel.MEMORY_AND_DISK)
        flagged = F.col(flag)
        metrics = [
            F.count(F.when(F.col("_hm_in_batch"), F.lit(1))).alias("rows"),
            F.count(F.when(flagged, F.lit(1))).alias("changed"),
            F.count(F.when(F.col("_hm_differs"), F.lit(1))).alias("differs"),
        ]
        if track:
            metrics += [F.min(F.when(flagged, _micros(track))).alias("first"), _hour_bits(flagged, track).alias("hours")]
        day = [F.to_date(F.col(track).cast(T.TimestampType())).alias("_hm_day")] if track else []
        # One row per partition and day: bounded by the days of the batch.
        parts = [F.col(c).cast("string").alias(f"_hm_p{i}") for i, c in enumerate(partition_by)]
        got = merged.groupBy(*parts, *day).agg(*metrics).collect()
        hours: dict[dt.date, int] = {}
        for r in got if track else ():
            if r["hours"]:
                hours[r["_hm_day"]] = hours.get(r["_hm_day"], 0) | r["hours"]
        dirty = tuple(sorted(hours.items()))
        write = sorted({tuple(r)[: len(partition_by)] for r in got if r["differs"]}, key=str)
        if dirty and before_swap:
            before_swap(dirty)
        rows = merged.drop("_hm_in_batch", flag, "_hm_differs")
        if write and partition_by:
            if len(write) < len({tuple(r)[: len(partition_by)] for r in got}):
                wanted = spark.createDataFrame(write, ", ".join(f"_hm_p{i} string" for i in range(len(partition_by))))
                match = [F.col(c).cast("string").eqNullSafe(F.col(f"_hm_p{i}")) for i, c in enumerate(partition_by)]
                rows = rows.join(wanted, match, "left_semi")
            _partitioned_writer(rows, partition_by).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
        elif write:
            # A whole folder cannot be overwritten while it is read: by way of a copy.
            staged = scratch_path(spark, "upsert")
            rows.write.parquet(staged)
            spark.read.schema(rows.schema).parquet(staged).write.mode("overwrite").parquet(path)
        if kept is None or write and not partition_by:  # never kept, or just overwritten
            _keep_schema(spark, path, schema, partition_by)
    finally:
        batch.unpersist()
        if merged is not None:
            merged.unpersist()
    firsts = [r["first"] for r in got if r["first"] is not None] if track else []
    return WriteResult(
        sum(r["rows"] for r in got), len(specs) if partition_by else -1, sum(r["changed"] for r in got),
        _micros_to_datetime(min(firsts)) if firsts else None, len(write), tuple(write) if partition_by else (), dirty,
    )


def append_path(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> WriteResult:
    """Add rows; the first append to a path keeps its schema."""
    spark = df.sparkSession
    if not table_exists(spark, path):
        _keep_schema(spark, path, df.schema, partition_by)
    obs = Observation("append")
    _partitioned_writer(df.observe(obs, F.count(F.lit(1)).alias("rows")), partition_by).mode("append").parquet(path)
    return WriteResult(rows=int(obs.get["rows"]), partitions=-1)


def write_layer(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    *,
    mode: str,
    keys: Sequence[str],
    merge: bool = True,
    partition_by: Sequence[str] = ("date",),
    track: str | None = None,
    check_keys: bool = True,
    version: str | None = None,
    before_swap: Callable[[Dirty], None] | None = None,
) -> WriteResult:
    """Write by load mode: ``full_refresh`` replaces, ``incremental`` upserts.

    With merging disabled an incremental write appends (an empty key list
    is not read as "match everything").
    """
    if mode == "full_refresh":
        return replace_table(df, path, partition_by, track, before_swap)
    if mode != "incremental":
        raise ValueError(f"unknown load mode {mode!r}")
    if not merge:
        if before_swap:
            before_swap(())
        return append_path(df, path, partition_by)
    return upsert_path(spark, df, path, keys, partition_by, track, check_keys, version, before_swap)


# ---------------------------------------------------------------- catalog


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    for r in rows:
        if r["col_name"] == "Location":
            return r["data_type"]
    raise ValueError(f"table {name} has no location")


def is_managed(spark: SparkSession, name: str) -> bool:
    """True for an existing table whose files belong to the catalog: dropping it deletes them."""
    if not spark.catalog.tableExists(name):
        return False
    return any(r["col_name"] == "Type" and r["data_type"] == "MANAGED" for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect())


@dataclass(frozen=True)
class SchemaChange:
    """What a new schema changes: column names."""

    added: tuple[str, ...] = ()
    dropped: tuple[str, ...] = ()
    widened: tuple[str, ...] = ()  # int to bigint, float to double, a longer decimal
    retyped: tuple[str, ...] = ()  # any other type

    def __bool__(self) -> bool:
        return bool(self.added or self.dropped or self.widened or self.retyped)


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _widens(old: T.DataType, new: T.DataType) -> bool:
    if isinstance(old, _WHOLE) and isinstance(new, _WHOLE):
        return _WHOLE.index(type(old)) < _WHOLE.index(type(new))
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return isinstance(old, T.FloatType) and isinstance(new, T.DoubleType)


def schema_change(old: T.StructType, new: T.StructType) -> SchemaChange:
    before, after = ({f.name: f.dataType for f in s.fields} for s in (old, new))
    other = [c for c in after if c in before and before[c] != after[c]]
    return SchemaChange(
        tuple(c for c in after if c not in before),
        tuple(c for c in before if c not in after),
        tuple(c for c in other if _widens(before[c], after[c])),
        tuple(c for c in other if not _widens(before[c], after[c])),
    )


def _columns(fields: Sequence[T.StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def _create_entry(spark: SparkSession, name: str, path: str, schema: T.StructType, partition_by: Sequence[str]) -> None:
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({_columns(schema.fields)}) USING parquet{parts} LOCATION '{path}'")


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    partitioned: bool | Sequence[str] = True,
    replace_schema: bool = False,
    specs: Sequence[Sequence[str | None]] | None = None,
) -> SchemaChange:
    """Expose the Parquet folder ``path`` as (external) catalog table ``name``.

    ``partitioned``: the partition columns (True: ``date``). With
    ``replace_schema`` the entry takes the schema of the folder: new columns
    are added to it; if columns went or changed type it is made anew (dropping
    an external table keeps its files). ``specs`` are the partitions that were
    written: only they are added to the entry; without them all folders are
    looked through. A managed table is never dropped: its own name raises
    here, and is overwritten by ``replace_named`` instead.
    Returns what changed in the entry.
    """
    if replace_schema and is_managed(spark, name):
        raise ValueError(f"{name} is a managed table; overwrite it with replace_named")
    partition_by = ["date"] if partitioned is True else list(partitioned or ())
    exists, change = spark.catalog.tableExists(name), SchemaChange()
    if not exists or replace_schema:
        schema = read_table(spark, path).schema
        if exists:
            old = spark.table(name).schema
            change = schema_change(old, schema)
            # Added columns must end up before the partition columns, in the order of the files.
            plain = [f.name for f in schema.fields if f.name not in partition_by]
            kept = [c for c in old.fieldNames() if c not in partition_by]
            if change.dropped or change.widened or change.retyped or plain[: len(kept)] != kept:
                spark.sql(f"DROP TABLE {name}")
                exists = False
            elif change.added:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_columns([schema[c] for c in change.added])})")
        if not exists:
            _create_entry(spark, name, path, schema, partition_by)
            specs = None
    if partition_by and specs is None:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    elif partition_by:
        def spec(values):
            pairs = zip(partition_by, values, strict=True)
            return "PARTITION (" + ", ".join(f"`{c}` = " + ("NULL" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'") for c, v in pairs) + ")"

        for i in range(0, len(specs), 200):
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(spec(v) for v in specs[i : i + 200])}")
    spark.catalog.refreshTable(name)
    return change


def replace_named(
    spark: SparkSession, df: DataFrame, name: str, path: str, partition_by: Sequence[str] = ("date",)
) -> WriteResult:
    """Overwrite a catalog table (stored at ``path``), schema included; create it if absent.

    A managed table stays managed: the catalog replaces files and schema.
    """
    if is_managed(spark, name):
        obs = Observation("replace-managed")
        _partitioned_writer(df.observe(obs, F.count(F.lit(1)).alias("rows")), partition_by).mode("overwrite").format("parquet").saveAsTable(name)
        return WriteResult(int(obs.get["rows"]), -1)
    if spark.catalog.tableExists(name):
        path = table_location(spark, name)
    result = replace_table(df, path, partition_by)
    register_table(spark, name, path, partitioned=list(partition_by), replace_schema=True)
    return result


#: Sources whose tables Spark writes as files; everything else of a V2 catalog merges by itself.
FILE_SOURCES = ("parquet", "orc", "csv", "json", "text", "avro", "hive")


def merges_itself(spark: SparkSession, name: str) -> bool:
    """Whether ``name`` is a table of a V2 catalog: of a catalog configured by its name,
    or of a session catalog that was replaced, unless the table is one of files."""
    parts = [p.strip("`") for p in name.split(".")]
    if len(parts) > 1 and parts[0] != "spark_catalog" and spark.conf.get(f"spark.sql.catalog.{parts[0]}", None):
        return True
    if not spark.conf.get("spark.sql.catalog.spark_catalog", None) or not spark.catalog.tableExists(name):
        return False
    found = [r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r["col_name"] == "Provider"]
    return bool(found) and found[0].lower() not in FILE_SOURCES


def merge_into(df: DataFrame, name: str, keys: Sequence[str], version: str | None = None) -> None:
    """MERGE into a V2 table by key: update matched rows (unless they are newer), insert the others.

    A table whose source cannot merge raises Spark's own error; nothing is overwritten instead.
    """
    target = name.split(".")[-1].strip("`")
    match = [F.col(f"hm_batch.{k}") == F.col(f"{target}.{k}") for k in keys]
    on = match[0]
    for m in match[1:]:
        on = on & m
    merge = df.alias("hm_batch").mergeInto(name, on)
    if version:
        old, new = F.col(f"{target}.{version}"), F.col(f"hm_batch.{version}")
        merge = merge.whenMatched(F.coalesce(new >= old, F.lit(True))).updateAll()
    else:
        merge = merge.whenMatched().updateAll()
    merge.whenNotMatched().insertAll().merge()


def upsert_named(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    path: str,
    partition_by: Sequence[str] = ("date",),
    track: str | None = None,
    version: str | None = None,
) -> WriteResult:
    """Upsert into a catalog table by key; create it (at ``path``) when absent.

    A table of a V2 catalog is merged by the catalog. Existence is checked
    explicitly; a failing merge raises and never falls back to overwriting
    the table with the batch.
    """
    if not list(keys):
        raise ValueError("upsert needs at least one key column")
    if merges_itself(spark, name):
        obs = Observation("merge")
        merge_into(df.observe(obs, F.count(F.lit(1)).alias("rows")), name, list(keys), version)
        return WriteResult(int(obs.get["rows"]), -1)
    if spark.catalog.tableExists(name):
        path = table_location(spark, name)
    result = upsert_path(spark, df, path, keys, partition_by, track, version=version)
    register_table(spark, name, path, partitioned=list(partition_by), specs=result.specs if result.rewritten >= 0 else None)
    return result


def _insert_over(spark: SparkSession, rows: DataFrame, name: str) -> None:
    """Insert over the partitions present in ``rows``; the mode is a setting here, as inserts by name take no options."""
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def write_managed(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    *,
    mode: str,
    keys: Sequence[str],
    merge: bool = True,
    partition_by: Sequence[str] = ("date",),
) -> WriteResult:
    """``write_layer`` for a table whose files belong to the catalog.

    Of a V2 catalog the catalog merges. Otherwise an upsert overlays the
    partitions the batch names and inserts them over the old ones
    (``partitionOverwriteMode`` dynamic, by the catalog).
    """
    if mode == "full_refresh":
        return replace_named(spark, df, name, "", partition_by)
    if mode != "incremental":
        raise ValueError(f"unknown load mode {mode!r}")
    if merges_itself(spark, name):
        return upsert_named(spark, df, name, keys, "", partition_by)
    stored = spark.table(name)
    df = df.select(*[df[c].cast(stored.schema[c].dataType) for c in stored.columns])
    if not merge:
        obs = Observation("append-managed")
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.insertInto(name)
        return WriteResult(int(obs.get["rows"]), -1)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        specs = _profile(df, partition_by, keys)
        named = spark.createDataFrame(specs, ", ".join(f"_hm_p{i} string" for i in range(len(partition_by)))) if partition_by and specs else None
        if named is not None:
            match = [F.col(c).cast("string").eqNullSafe(F.col(f"_hm_p{i}")) for i, c in enumerate(partition_by)]
            stored = stored.join(named, match, "left_semi")
        merged, flag = merge_rows(stored, df, list(keys))
        obs = Observation("upsert-managed")
        metrics = [F.count(F.when(F.col("_hm_in_batch"), F.lit(1))).alias("rows"), F.count(F.when(F.col(flag), F.lit(1))).alias("changed")]
        # A table cannot be overwritten by a plan that reads it: by way of a copy.
        staged = scratch_path(spark, "upsert")
        merged.observe(obs, *metrics).drop("_hm_in_batch", flag, "_hm_differs").write.parquet(staged)
        rows = spark.read.schema(stored.schema).parquet(staged)
        if partition_by:
            rows = rows.hint("rebalance", *partition_by)
        _insert_over(spark, rows, name)
        got = obs.get
    finally:
        df.unpersist()
    return WriteResult(int(got["rows"]), len(specs), int(got["changed"]))


def read_named(spark: SparkSession, name: str) -> DataFrame | None:
    """The catalog table, or None when it does not exist (a first run)."""
    if not spark.catalog.tableExists(name):
        return None
    return spark.table(name)
