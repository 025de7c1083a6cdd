"""Silver -> gold: join the series, trailing average, percent, label, write.

``gold_frame`` is the pure computation (DataFrames in, DataFrame out);
``build_gold`` adds the incremental window, reads and the write.

Incremental correctness (equal to a full refresh):
* start = min(HWM - overlap, earliest silver change of this run);
* energy is read from ``start - R`` hours (look-back) so the first rows
  at ``start`` see complete trailing frames; weather and air from
  ``start``; only rows at or after ``start`` are written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmill.functions.names import pick, prefix_columns, require
from hourmill.functions.timekeys import day_of
from hourmill.operators.quality import dedupe_latest, non_null
from hourmill.operators.rules import LABEL_FALSE, LABEL_TRUE, cheap_label, pct_vs
from hourmill.operators.trailing import trailing_mean
from hourmill.sources.snapshots import SNAPSHOT_COL


@dataclass(frozen=True)
class GoldRules:
    rolling_hours: int = 3
    wind_threshold: float = 6.0
    label_true: str = LABEL_TRUE
    label_false: str = LABEL_FALSE
    price: str = "price"
    wind: str = "wind_speed_10m"
    weather_prefix: str = "wx_"
    air_prefix: str = "aq_"
    # None: prices are averaged as doubles. A number: as exact decimals of so
    # many places, the same however rows are dealt; prices must fit it.
    sum_scale: int | None = None

    @property
    def avg_col(self) -> str:
        return f"avg_{self.price}_last_{self.rolling_hours}h"

    @property
    def pct_col(self) -> str:
        return f"pct_vs_{self.rolling_hours}h_avg"


def gold_columns(rules: GoldRules, weather_cols: Sequence[str], air_cols: Sequence[str], keys: Sequence[str]) -> list[str]:
    """Gold output order: keys, price, average, percent, weather, air, label."""
    wx = [rules.weather_prefix + c for c in weather_cols if c not in keys]
    aq = [rules.air_prefix + c for c in air_cols if c not in keys]
    return [*keys, rules.price, rules.avg_col, rules.pct_col, *wx, *aq, "label"]


def gold_frame(
    energy: DataFrame,
    weather: DataFrame,
    air: DataFrame,
    rules: GoldRules = GoldRules(),
    keys: Sequence[str] = ("timestamp",),
    dedupe_inputs: bool = True,
    upkeep: Sequence[str] = ("date", "hk", SNAPSHOT_COL),
) -> DataFrame:
    """Energy (spine) LEFT JOIN weather LEFT JOIN air, then window and rules.

    ``keys`` are the series keys plus ``timestamp``; every key but
    ``timestamp`` partitions the trailing window (one series each).
    ``upkeep`` names silver columns that do not enter gold.
    """
    keys = list(keys)
    require(energy, [*keys, rules.price], "energy")
    require(weather, [*keys, rules.wind], "weather")
    require(air, keys, "air_quality")
    # Rows without a timestamp are dropped from gold; dropping them from the
    # spine first changes no other row's frame and keeps the window one pass.
    energy = non_null(pick(energy, [*keys, rules.price]), "timestamp")
    weather = pick(weather, [c for c in weather.columns if c not in upkeep])
    air = pick(air, [c for c in air.columns if c not in upkeep])
    if dedupe_inputs:
        energy = dedupe_latest(energy, keys)
        weather = dedupe_latest(weather, keys)
        air = dedupe_latest(air, keys)
    wx = prefix_columns(weather, rules.weather_prefix, keys)
    aq = prefix_columns(air, rules.air_prefix, keys)

    series = [k for k in keys if k != "timestamp"]
    # One row per key on the spine (deduplicated above, or unique in silver),
    # so the window runs on the rows directly, before the joins widen them.
    spine = trailing_mean(
        energy, rules.price, rules.avg_col, hours=rules.rolling_hours, by=series, unique_rows=True,
        scale=rules.sum_scale,
    )
    withavg = spine.join(wx, keys, "left").join(aq, keys, "left")

    price, avg = F.col(rules.price), F.col(rules.avg_col)
    wind = F.col(rules.weather_prefix + rules.wind)
    out = withavg.select(
        "*",
        pct_vs(price, avg).alias(rules.pct_col),
        cheap_label(price, avg, wind, rules.wind_threshold, rules.label_true, rules.label_false).alias("label"),
    )
    cols = gold_columns(rules, weather.columns, air.columns, keys)
    return non_null(pick(out, cols), "timestamp")


def high_water_mark(gold: DataFrame | None, ts: str = "timestamp") -> dt.datetime | None:
    """MAX(timestamp) of gold as a naive UTC datetime; None when absent or empty.

    Computed in Spark and returned as epoch seconds, so the driver's
    local zone never enters the value.
    """
    if gold is None:
        return None
    row = gold.agg(F.max(F.unix_micros(F.col(ts).cast(T.TimestampType()))).alias("m")).first()
    if row is None or row["m"] is None:
        return None
    return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=int(row["m"]))


def recompute_start(
    gold: DataFrame | None,
    overlap_hours: int,
    changed_since: dt.datetime | None = None,
) -> dt.datetime | None:
    """First gold instant to recompute: min(HWM - overlap, earliest silver change).

    None means "process everything" (no gold yet, or an empty one).
    """
    hwm = high_water_mark(gold)
    if hwm is None:
        return None
    start = hwm - dt.timedelta(hours=overlap_hours)
    if changed_since is not None and changed_since < start:
        start = changed_since
    return start


def with_date(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumn("date", day_of(F.col(ts)))
