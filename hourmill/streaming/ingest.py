"""Incremental bronze -> silver as a Structured Streaming file source.

Batch mode finds "today's" snapshot by name (falling back to everything);
a file stream instead remembers in its checkpoint which snapshot files it
has already processed, so each run picks up exactly the newly landed ones
(however many fetches happened since the last run) and nothing twice.

Each micro-batch goes through the same ``silver_frame`` and an upsert by
key; the upsert is idempotent, so a batch replayed after a failure (the
checkpoint commits only after ``foreachBatch`` returns) leaves the table
as if it had run once. ``trigger(availableNow=True)`` processes all new
files in rate-limited batches and stops, which suits a scheduled job;
the same code runs as a continuous stream with a processing-time trigger.

The newest snapshot name wins, within a batch and across batches (silver
keeps each row's snapshot), in whatever order the files landed.

Gold stays a batch step: its range window over time is not a streaming
operator, and it is driven by the pending changes the batches noted.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from hourmill.plans.pipeline import GoldResult, build_gold, earliest
from hourmill.plans.silver import pending_note, silver_frame
from hourmill.sinks.tables import upsert_path
from hourmill.sources.snapshots import SNAPSHOT_COL, with_snapshot_column
from hourmill.spec import DatasetSpec, RunSpec


@dataclass
class StreamProgress:
    dataset: str
    batches: int = 0
    rows: int = 0
    earliest_change: dt.datetime | None = None
    batch_ids: list[int] = field(default_factory=list)


def snapshot_stream(spark: SparkSession, ds: DatasetSpec, max_files_per_trigger: int | None = None) -> DataFrame:
    """New files under the dataset's landing folder, with the ``snapshot`` column."""
    reader = spark.readStream.format(ds.fmt).schema(with_snapshot_column(ds.schema))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(ds.bronze)


def start_silver_stream(
    spark: SparkSession,
    spec: RunSpec,
    ds: DatasetSpec,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
) -> tuple[object, StreamProgress]:
    """Start the file stream of ``ds`` (availableNow); returns the query and its progress."""
    progress = StreamProgress(ds.name)

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        rows = silver_frame(batch, ds, spec.hash_col, spec.hash_sep, keep_version=True)
        res = upsert_path(
            spark, rows, ds.silver, [spec.hash_col], ds.partition_by, track="timestamp",
            check_keys=False,  # silver_frame has just deduplicated on the hash key
            version=SNAPSHOT_COL, before_swap=pending_note(spark, spec, ds),
        )
        progress.batches += 1
        progress.rows += res.rows
        progress.batch_ids.append(batch_id)
        if res.earliest_change is not None and (
            progress.earliest_change is None or res.earliest_change < progress.earliest_change
        ):
            progress.earliest_change = res.earliest_change

    query = (
        snapshot_stream(spark, ds, max_files_per_trigger)
        .writeStream.foreachBatch(upsert_batch)
        .option("checkpointLocation", checkpoint)
        .queryName(f"silver_{ds.name}")
        .trigger(availableNow=True)
        .start()
    )
    return query, progress


def stream_silver(
    spark: SparkSession,
    spec: RunSpec,
    ds: DatasetSpec,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
) -> StreamProgress:
    """Process every not-yet-seen snapshot of ``ds`` into its silver table, then stop."""
    query, progress = start_silver_stream(spark, spec, ds, checkpoint, max_files_per_trigger)
    query.awaitTermination()
    return progress


def run_streaming(
    spark: SparkSession, spec: RunSpec, checkpoint_root: str
) -> tuple[list[StreamProgress], GoldResult]:
    """All feeds through their file streams (running side by side), then incremental gold."""
    started = [
        start_silver_stream(spark, spec, ds, f"{checkpoint_root.rstrip('/')}/{ds.name}") for ds in spec.datasets
    ]
    for query, _ in started:
        query.awaitTermination()
    progress = [p for _, p in started]
    gold = build_gold(spark, spec.but(load_mode="incremental"), earliest(progress, spec))
    return progress, gold
