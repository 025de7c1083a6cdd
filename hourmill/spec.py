"""Pipeline configuration: one spec per dataset plus the gold spec.

Every field is read by the code; nothing here is decorative.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

from hourmill.functions.timekeys import DEFAULT_ZONE, KEY_SEPARATOR
from hourmill.plans.gold import GoldRules
from hourmill.sources.snapshots import AIR_FIELDS, AIR_SCHEMA, ENERGY_SCHEMA, WEATHER_FIELDS, WEATHER_SCHEMA

# Fixed values of the source pipeline's configuration, kept so that results
# and table layouts agree with it:
#   load modes: "incremental" (default), "full_refresh"
#   hash key: MD5, parts joined by "||", column "hk"; silver/gold key: timestamp
#   silver partition column: "date"; extract window: 7 days
#   source time zone: Europe/Amsterdam (weather, air quality wall times)
#   gold rules: rolling 3 hours, wind threshold 6.0, labels "CHEAP"/"NORMAL",
#   recompute overlap 6 hours (default max(2 * rolling, 6)),
#   weather prefix "wx_", air-quality prefix "aq_"
LOAD_MODES = ("incremental", "full_refresh")


@dataclass(frozen=True)
class DatasetSpec:
    """Bronze -> silver capsule for one feed."""

    name: str
    bronze: str  # landing folder of this dataset (snapshot=<name> folders below)
    silver: str  # silver table folder
    transform: str
    params: Mapping
    select: tuple[str, ...]
    keys: tuple[str, ...] = ("timestamp",)
    merge: bool = True
    fmt: str = "json"
    schema: T.StructType | None = None
    partition_by: tuple[str, ...] = ("date",)


@dataclass(frozen=True)
class GoldSpec:
    path: str
    table: str | None = None  # catalog name; None keeps gold path-only
    keys: tuple[str, ...] = ("timestamp",)
    rules: GoldRules = field(default_factory=GoldRules)
    overlap_hours: int | None = None  # default max(2R, 6)
    merge: bool = True
    partition_by: tuple[str, ...] = ("date",)
    energy: str = "energy"
    weather: str = "weather"
    air: str = "air_quality"

    @property
    def overlap(self) -> int:
        if self.overlap_hours is not None:
            return int(self.overlap_hours)
        return max(2 * self.rules.rolling_hours, 6)


@dataclass(frozen=True)
class RunSpec:
    run_date: dt.date
    datasets: tuple[DatasetSpec, ...]
    gold: GoldSpec
    load_mode: str = "incremental"
    hash_col: str = "hk"
    hash_sep: str = KEY_SEPARATOR
    extract_days: int = 7
    log_path: str | None = None
    log_table: str | None = None  # catalog name of the run log stored at log_path
    pending_path: str | None = None  # folder of silver changes that gold has not taken
    metrics_path: str | None = None  # folder of write metrics; None keeps none
    since: str | None = None  # snapshot-name lower bound (inclusive) for a catch-up run
    until: str | None = None  # snapshot-name upper bound (inclusive), e.g. a rebuild "as of"

    def __post_init__(self):
        if self.load_mode not in LOAD_MODES:
            raise ValueError(f"load_mode must be one of {LOAD_MODES}")

    def dataset(self, name: str) -> DatasetSpec:
        for d in self.datasets:
            if d.name == name:
                return d
        raise KeyError(name)

    def but(self, **changes) -> RunSpec:
        return replace(self, **changes)


def default_spec(
    root: str,
    run_date: dt.date,
    load_mode: str = "incremental",
    zone: str = DEFAULT_ZONE,
    rules: GoldRules | None = None,
    gold_table: str | None = None,
) -> RunSpec:
    """The three standard capsules (weather, air quality, energy) under ``root``.

    Fixed feed layout: weather and air quality are hourly struct-of-arrays
    documents in local wall time of ``zone``; energy is an array of
    ``{price, readingDate}`` records with absolute (UTC) times.
    """
    root = root.rstrip("/")
    weather = DatasetSpec(
        name="weather",
        bronze=f"{root}/bronze/weather",
        silver=f"{root}/silver/weather",
        transform="struct_of_arrays",
        params={"hourly_fields": list(WEATHER_FIELDS), "timestamp_field": "time", "source_timezone": zone, "to_utc": True},
        select=("timestamp", "temperature_2m", "wind_speed_10m", "direct_radiation"),
        schema=WEATHER_SCHEMA,
    )
    air = DatasetSpec(
        name="air_quality",
        bronze=f"{root}/bronze/air_quality",
        silver=f"{root}/silver/air_quality",
        transform="struct_of_arrays",
        params={"hourly_fields": list(AIR_FIELDS), "timestamp_field": "time", "source_timezone": zone, "to_utc": True},
        select=("timestamp", "carbon_monoxide", "nitrogen_dioxide", "pm10"),
        schema=AIR_SCHEMA,
    )
    energy = DatasetSpec(
        name="energy",
        bronze=f"{root}/bronze/energy",
        silver=f"{root}/silver/energy",
        transform="explode_array_of_struct",
        params={
            "array_col": "Prices",
            "select_map": {"timestamp": "readingDate", "price": "price"},
            "timestamp": {"col": "timestamp", "to_timestamp": True, "to_utc": False, "source_timezone": zone},
        },
        select=("timestamp", "price"),
        schema=ENERGY_SCHEMA,
    )
    gold = GoldSpec(path=f"{root}/gold/hourly_prices", table=gold_table, rules=rules or GoldRules())
    return RunSpec(
        run_date=run_date,
        datasets=(weather, air, energy),
        gold=gold,
        load_mode=load_mode,
        log_path=f"{root}/ops/log_events",
        pending_path=f"{root}/ops/pending",
    )
