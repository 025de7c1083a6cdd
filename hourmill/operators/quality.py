"""Data-quality operators: non-null filter, deterministic dedupe, key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BEST = "_hm_best"


def non_null(df: DataFrame, column: str = "timestamp") -> DataFrame:
    return df.where(F.col(column).isNotNull())


def dedupe_latest(df: DataFrame, keys: Sequence[str], newest: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``newest``, ties by all other columns.

    Expressed as ``max(struct(...))`` per key rather than a window: the
    maximum is combined map-side (partial aggregation), so a key holding a
    third of all rows is reduced inside each input task before the shuffle
    and never lands in one task whole. The survivor is fully determined by
    the data (newest snapshot first, then a total order on the payload), so
    re-runs and different partitionings keep the same row.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    ranked = list(dict.fromkeys([*newest, *rest]))
    fields = {c: f"f{i}" for i, c in enumerate(ranked)}
    best = F.max(F.struct(*[F.col(c).alias(fields[c]) for c in ranked])).alias(_BEST)
    grouped = df.groupBy(*keys).agg(best)
    return grouped.select(
        *[F.col(c) if c in keys else F.col(_BEST)[fields[c]].alias(c) for c in df.columns]
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (empty when ``keys`` is unique)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
