"""Run log: a catalog table (or folder) of what runs did, one row per event.

A run collects its events on the driver, a handful, and appends them once, at
its end, whether it succeeded or not (``recorded``). What an event has beside
the fixed columns travels as a map and becomes JSON in Spark. Events that are
rows already (``append_events``) take the same way, however many.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmill.sinks.tables import append_path, read_table

# The columns of the log table, in order; all text but the first.
LOG_COLUMNS = (
    "event_ts", "level", "logger", "notebook_name", "pipeline_job_id", "activity_run_id",
    "run_date", "dataset", "step", "message", "extra_json",
)
LOG_SCHEMA = T.StructType([T.StructField(c, T.TimestampType() if c == "event_ts" else T.StringType()) for c in LOG_COLUMNS])

_RAW = "event_ts timestamp, level string, dataset string, step string, message string, extra map<string,string>"


@dataclass
class RunEvents:
    """What happened so far; call it with a step and a message to add to it."""

    rows: list[tuple] = field(default_factory=list)
    phase: str = ""  # of the run; a failure is reported under it

    def __call__(self, step: str, message: str, dataset: str = "", level: str = "INFO", **extra: object) -> None:
        known = {k: v if isinstance(v, str) else str(v) for k, v in extra.items() if v is not None}
        self.rows.append((dt.datetime.now(dt.timezone.utc), level.upper(), dataset, step, message, known))


def shape_events(rows: DataFrame, constants: Mapping[str, str] | None = None) -> DataFrame:
    """Rows with any of the log's columns, and a map ``extra``, as rows of the log.

    ``constants`` fill columns that the rows do not have; others are empty.
    ``extra`` becomes ``extra_json`` (keys in ascending order); without either it is ``{}``.
    """
    constants = dict(constants or {})
    out = []
    for f in LOG_SCHEMA.fields:
        if f.name == "extra_json" and "extra" in rows.columns:
            in_order = F.map_from_entries(F.array_sort(F.map_entries("extra")))
            value = F.coalesce(F.to_json(in_order), F.lit("{}"))
        elif f.name in rows.columns:
            value = F.col(f.name)
        else:
            value = F.lit(constants.get(f.name, "{}" if f.name == "extra_json" else "" if f.name != "event_ts" else None))
        out.append(value.cast(f.dataType).alias(f.name))
    return rows.select(*out)


def ensure_event_table(spark: SparkSession, name: str, path: str | None = None) -> None:
    """Create the log table, with its fixed columns, unless it exists; managed without ``path``."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LOG_SCHEMA.fields)
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{place}")


def append_events(rows: DataFrame, path: str | None = None, table: str | None = None, constants: Mapping[str, str] | None = None) -> None:
    """Append events to the log: to the catalog table if one is named (created if absent), else to the folder."""
    shaped = shape_events(rows, constants)
    if table:
        ensure_event_table(rows.sparkSession, table, path)
        shaped.write.insertInto(table)
    else:
        append_path(shaped, path)


@contextmanager
def recorded(
    spark: SparkSession, path: str | None = None, table: str | None = None, constants: Mapping[str, str] | None = None
) -> Iterator[RunEvents]:
    """A run's events, appended when the block ends; a failure adds an ERROR naming the phase and is raised."""
    events = RunEvents()
    failure: Exception | None = None
    try:
        yield events
    except Exception as error:
        failure = error
        events(events.phase, "run failed", level="ERROR", error=type(error).__name__, message_text=str(error)[:1000])
        raise
    finally:
        if events.rows and (path or table):
            try:
                append_events(spark.createDataFrame(events.rows, _RAW), path, table, constants)
            except Exception as unlogged:
                if failure is None:
                    raise
                failure.add_note(f"the run log could not be written: {unlogged}")  # the run's own error is the one to raise


def read_log(spark: SparkSession, path: str | None = None, table: str | None = None) -> DataFrame:
    return spark.table(table) if table else read_table(spark, path)


def run_summary(spark: SparkSession, path: str | None = None, table: str | None = None) -> DataFrame:
    """Events per level and step."""
    return read_log(spark, path, table).groupBy("level", "step").agg(F.count(F.lit(1)).alias("n_events"))
