"""Write metrics as rows: what each write counted, stored beside the tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from hourmill.sinks.tables import WriteResult, append_path, read_table

METRIC_SCHEMA = (
    "written_at timestamp, table_name string, mode string, batch_rows long, changed_rows long, "
    "named_partitions long, rewritten_partitions long, earliest_change timestamp"
)


def _counted(n: int) -> int | None:
    return None if n < 0 else n


def record_writes(spark: SparkSession, folder: str, writes: Sequence[tuple[str, str, WriteResult]]) -> None:
    """Append a row of counts for each (table, mode, result); what was not counted is NULL.

    The counts were measured by the writes' own jobs. One append: writes that
    ran side by side are recorded together, after them.
    """
    utc = dt.timezone.utc
    rows = []
    for table, mode, result in writes:
        first = result.earliest_change.replace(tzinfo=utc) if result.earliest_change else None
        counts = (result.rows, result.changed, result.partitions, result.rewritten)
        rows.append((dt.datetime.now(utc), table, mode, *(_counted(n) for n in counts), first))
    append_path(spark.createDataFrame(rows, METRIC_SCHEMA).coalesce(1), folder)


def record_write(spark: SparkSession, folder: str, table: str, mode: str, result: WriteResult) -> None:
    record_writes(spark, folder, [(table, mode, result)])


def write_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder)
