"""Silver -> gold build and the end-to-end run (land -> silver -> gold)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmill.functions.timekeys import epoch_seconds, time_literal
from hourmill.plans.gold import gold_frame, recompute_start, with_date
from hourmill.plans.pending import Pending, days_of, dirty_hours, intervals, outstanding, settle
from hourmill.plans.runlog import RunEvents, recorded
from hourmill.plans.silver import SilverResult, build_silver, read_silver
from hourmill.sinks.metrics import record_writes
from hourmill.sinks.tables import is_managed, merges_itself, read_table, register_table, table_exists, write_layer, write_managed
from hourmill.sources.snapshots import SNAPSHOT_COL
from hourmill.spec import RunSpec


@dataclass(frozen=True)
class GoldResult:
    rows: int
    start: dt.datetime | None  # the earliest hour recomputed; None: all
    rewritten: int = -1  # date folders (-1: all)


def read_gold(spark: SparkSession, spec: RunSpec) -> DataFrame | None:
    g = spec.gold
    if g.table and is_managed(spark, g.table):
        return spark.table(g.table)
    if not table_exists(spark, g.path):
        return None
    return read_table(spark, g.path)


def _wanted(rows: DataFrame, start: dt.datetime, hours: set[int]) -> DataFrame:
    """Rows from ``start`` on, and those in ``hours`` (since the epoch) before it."""
    late = F.col("timestamp") >= time_literal(start, rows.schema["timestamp"].dataType)
    if not hours:
        return rows.where(late)
    named = rows.sparkSession.createDataFrame([(h,) for h in sorted(hours)], "_hm_dirty long")
    at = F.floor(epoch_seconds(F.col("timestamp")) / F.lit(3600))
    return rows.join(named, at == F.col("_hm_dirty"), "left").where(late | F.col("_hm_dirty").isNotNull()).drop("_hm_dirty")


def build_gold(
    spark: SparkSession,
    spec: RunSpec,
    changed_since: dt.datetime | None = None,
    log: RunEvents | None = None,
) -> GoldResult:
    """Silver to gold: all of it, or in an incremental run what can have changed.

    That is every hour from the high-water mark less the overlap on, and the
    hours pending changes reach (``plans.pending``); of the dates in between
    nothing is read or written. Pending changes are settled once gold is
    written. ``changed_since`` is a lower bound for callers without a pending
    folder: everything after it is recomputed. A managed gold table is
    written through the catalog.
    """
    g = spec.gold
    rules = g.rules
    todo = outstanding(spark, spec.pending_path) if spec.pending_path else Pending()
    start = None
    if spec.load_mode == "incremental" and not todo.everything:
        start = recompute_start(read_gold(spark, spec), g.overlap, changed_since)
    hours: set[int] = set()
    if start is not None:
        from_start = int((start - dt.datetime(1970, 1, 1)).total_seconds()) // 3600
        hours = {h for h in dirty_hours(todo.hours, g.energy, rules.rolling_hours) if h <= from_start}
    first = min(start, dt.datetime(1970, 1, 1) + dt.timedelta(hours=min(hours))) if hours else start
    if log is not None:
        log("window", "gold recompute window decided", start=start.isoformat() if start else None,
            overlap_hours=g.overlap, intervals=len(intervals(hours)))

    R = rules.rolling_hours
    look_back = start - dt.timedelta(hours=R) if start else None
    framed = days_of({h - i for h in hours for i in range(R + 1)})
    own = days_of(hours)
    energy = read_silver(spark, spec.dataset(g.energy).silver, look_back, spec.hash_col, framed)
    weather = read_silver(spark, spec.dataset(g.weather).silver, start, spec.hash_col, own)
    air = read_silver(spark, spec.dataset(g.air).silver, start, spec.hash_col, own)

    # Silver is unique per configured key; a second dedupe is needed only
    # when a feed is keyed on more than the gold key.
    same_keys = all(tuple(spec.dataset(n).keys) == tuple(g.keys) for n in (g.energy, g.weather, g.air))
    upkeep = ("date", spec.hash_col, SNAPSHOT_COL)
    gold = gold_frame(energy, weather, air, rules, g.keys, dedupe_inputs=not same_keys, upkeep=upkeep)
    if start is not None:
        gold = _wanted(gold, start, hours)
    gold = with_date(gold)

    if g.table and (is_managed(spark, g.table) or merges_itself(spark, g.table)):
        written = write_managed(spark, gold, g.table, mode=spec.load_mode, keys=list(g.keys), merge=g.merge, partition_by=g.partition_by)
    else:
        written = write_layer(
            spark, gold, g.path, mode=spec.load_mode, keys=list(g.keys), merge=g.merge, partition_by=g.partition_by,
            check_keys=False,  # one row per key: a deduplicated spine, left joins to key-unique sides
        )
        if g.table:
            register_table(
                spark, g.table, g.path, partitioned=list(g.partition_by),
                replace_schema=spec.load_mode == "full_refresh",
                specs=written.specs if written.rewritten >= 0 else None,
            )
    if spec.pending_path:
        settle(spark, todo)
    if spec.metrics_path:
        record_writes(spark, spec.metrics_path, [(g.table or g.path, spec.load_mode, written)])
    if log is not None:
        log("write_done", "gold write complete", rows=written.rows, dates=written.rewritten)
    return GoldResult(written.rows, first, written.rewritten)


def earliest(feeds, spec: RunSpec) -> dt.datetime | None:
    """The lower bound of what the feeds changed, for runs that keep no pending folder."""
    changes = [f.earliest_change for f in feeds if f.earliest_change is not None]
    return min(changes) if changes and spec.pending_path is None else None


def run(spark: SparkSession, spec: RunSpec) -> tuple[list[SilverResult], GoldResult]:
    """Bronze -> silver for every feed, then silver -> gold, then one log append.

    A failed run appends its events too, the last one an ERROR naming the step.
    """
    with recorded(spark, spec.log_path, spec.log_table, {"logger": "hourmill.run", "run_date": spec.run_date.isoformat()}) as log:
        log("start", "run started", load_mode=spec.load_mode)
        log.phase = "silver"
        silver = build_silver(spark, spec, log)
        if spec.metrics_path:
            record_writes(spark, spec.metrics_path, [(spec.dataset(r.dataset).silver, spec.load_mode, r.written) for r in silver])
        log.phase = "gold"
        gold = build_gold(spark, spec, earliest(silver, spec), log)
        log("end", "run finished")
    return silver, gold
