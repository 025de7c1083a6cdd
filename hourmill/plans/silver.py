"""Bronze -> silver for every configured dataset.

Per dataset: read snapshots -> unnest -> snake_case names -> require keys
-> ``date`` + MD5 key -> project -> non-null timestamp -> one row per key
(newest snapshot wins) -> replace or upsert into the date-partitioned
silver table. The table keeps each row's snapshot, so a batch of an older one
(a re-run of an earlier date) never replaces newer rows. Hours whose rows are
new or different are noted as pending before the table's files are swapped;
gold recomputes what they reach.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmill.functions.names import pick, require, snake_columns, snake_name
from hourmill.functions.timekeys import day_of, hash_key, snapshot_name, time_literal
from hourmill.operators.quality import dedupe_latest, non_null
from hourmill.operators.reshape import apply_transform
from hourmill.plans import pending
from hourmill.sinks.tables import WriteResult, read_table, write_layer
from hourmill.sources.snapshots import SNAPSHOT_COL, read_incremental, read_snapshots
from hourmill.spec import DatasetSpec, RunSpec


@dataclass(frozen=True)
class SilverResult:
    dataset: str
    rows: int
    earliest_change: dt.datetime | None
    fallback: bool
    written: WriteResult | None = None


def silver_frame(raw: DataFrame, ds: DatasetSpec, hash_col: str = "hk", sep: str = "||", keep_version: bool = False) -> DataFrame:
    """The cleaned, keyed, de-duplicated silver rows of a bronze frame.

    With ``keep_version`` each row has the ``snapshot`` it came from, if the bronze frame has.
    """
    params = dict(ds.params)
    carried = SNAPSHOT_COL in raw.columns
    if carried and ds.transform in ("explode_array_of_struct", "array_of_structs"):
        params["keep"] = {**dict(params.get("keep") or {}), SNAPSHOT_COL: SNAPSHOT_COL}
    df = snake_columns(apply_transform(raw, ds.transform, params))
    keys = [snake_name(k) for k in ds.keys if snake_name(k) != hash_col]
    require(df, keys, ds.name)
    df = df.withColumn("date", day_of(F.col("timestamp"))).withColumn(hash_col, hash_key(keys, sep))
    newest = [SNAPSHOT_COL] if carried else []
    df = pick(df, [*ds.select, "date", hash_col, *newest])
    df = non_null(df, "timestamp")
    df = dedupe_latest(df, [hash_col], newest=newest)
    return df.drop(SNAPSHOT_COL) if carried and not keep_version else df


def read_bronze(spark: SparkSession, spec: RunSpec, ds: DatasetSpec) -> tuple[DataFrame, bool]:
    """Full refresh: every snapshot. Incremental: the run's snapshot (or a range)."""
    if spec.load_mode == "full_refresh" or spec.since is not None:
        return read_snapshots(spark, ds.bronze, ds.schema, ds.fmt, since=spec.since, until=spec.until), False
    return read_incremental(spark, ds.bronze, spec.run_date, ds.schema, ds.fmt, spec.extract_days, until=spec.until)


def pending_note(spark: SparkSession, spec: RunSpec, ds: DatasetSpec):
    """What a silver write calls before it swaps files; None without a pending folder."""
    if spec.pending_path is None:
        return None
    version = snapshot_name(spec.run_date, spec.extract_days)
    return lambda dirty: pending.note(spark, spec.pending_path, ds.name, dirty, version)


def _silver_one(spark: SparkSession, spec: RunSpec, ds: DatasetSpec, log) -> SilverResult:
    raw, fell_back = read_bronze(spark, spec, ds)
    if log is not None:
        log("read", "bronze read", ds.name, "WARNING" if fell_back else "INFO", bronze=ds.bronze, fallback=fell_back)
    df = silver_frame(raw, ds, spec.hash_col, spec.hash_sep, keep_version=True)
    written = write_layer(
        spark, df, ds.silver, mode=spec.load_mode, keys=[spec.hash_col],
        merge=ds.merge, partition_by=ds.partition_by, track="timestamp",
        check_keys=False,  # silver_frame has just deduplicated on the hash key
        version=SNAPSHOT_COL, before_swap=pending_note(spark, spec, ds),
    )
    change = written.earliest_change
    if log is not None:
        log("write_done", "silver write complete", ds.name, rows=written.rows, silver=ds.silver,
            earliest_change=change.isoformat() if change else None)
    return SilverResult(ds.name, written.rows, change, fell_back, written)


def build_silver(spark: SparkSession, spec: RunSpec, log=None, parallel: bool = True) -> list[SilverResult]:
    """Bronze -> silver for every dataset.

    The feeds are independent, so with ``parallel`` their jobs are
    submitted from one thread each and run side by side on the cluster
    (Spark schedules jobs from different threads concurrently); results
    keep the configured order.
    """
    if not parallel or len(spec.datasets) < 2:
        return [_silver_one(spark, spec, ds, log) for ds in spec.datasets]
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=len(spec.datasets), thread_name_prefix="silver") as pool:
        futures = [pool.submit(_silver_one, spark, spec, ds, log) for ds in spec.datasets]
        return [f.result() for f in futures]


def read_silver(
    spark: SparkSession,
    path: str,
    start: dt.datetime | None = None,
    hash_col: str = "hk",
    days: Sequence[dt.date] = (),
    versions: bool = False,
) -> DataFrame:
    """A silver table, optionally from ``start`` on and on some earlier ``days``.

    The bound is applied both to ``timestamp`` (row-group pushdown) and to
    the ``date`` partition column (folder pruning), which Catalyst cannot
    derive from the timestamp predicate by itself. ``versions`` adds the
    snapshot each row came from, if the table keeps it.
    """
    df = snake_columns(read_table(spark, path))
    # Partition columns come back last; restore the silver order (..., date, hk).
    tail = [c for c in ("date", hash_col) if c in df.columns]
    kept = [SNAPSHOT_COL] if versions and SNAPSHOT_COL in df.columns else []
    df = df.select(*[c for c in df.columns if c not in (*tail, SNAPSHOT_COL)], *tail, *kept)
    if start is None:
        return df
    cond = F.col("timestamp") >= time_literal(start, df.schema["timestamp"].dataType)
    if "date" in df.columns:
        listed = F.col("date").isin(list(days)) if days else F.lit(False)
        return df.where((F.col("date") >= F.lit(start.date())) | listed).where(cond | listed)
    return df.where(cond) if not days else df
