"""Stand-ins built from the driver tables (``events``, ``lineitem``, ...).

The source pipeline consumes three hourly series for one location. The
driver data has no such series, so they are derived from ``events``:

    price  (energy)       <- event_type 'view'   per hour: max(value)
    weather               <- event_type 'click'  per hour:
                             temperature_2m = min(value)
                             wind_speed_10m = max(value)
                             direct_radiation = count(*)
    air quality           <- event_type 'error'  per hour:
                             carbon_monoxide = min(value)
                             nitrogen_dioxide = count(*)
                             pm10 = max(value)

All derivations are grouped aggregations (partial aggregation map-side),
so they scale with ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed mapping of driver event types to the three series.
PRICE_EVENT = "view"
WEATHER_EVENT = "click"
AIR_EVENT = "error"
# Wind threshold for the stand-in data (wind = max click value per hour).
TESTBED_WIND_THRESHOLD = 60.0


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from hourmill.session import ensure_utc

    ensure_utc(spark)  # every derivation below assumes a UTC session
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hour(ts: str = "ts"):
    return F.date_trunc("hour", F.col(ts)).cast(T.TimestampType()).alias("timestamp")


def hourly_stand_ins(events: DataFrame) -> DataFrame:
    """All three series' hourly aggregates in one scan and one shuffle.

    One conditional aggregate per hour over the three event types (the
    type filter reaches the Parquet scan). The per-series frames below are
    projections of this one plan, so Spark computes it once and reuses the
    exchange instead of scanning ``events`` per series.
    """
    t = F.col("event_type")
    v = F.col("value")

    def of(kind):
        return F.when(t == kind, v)

    def n(kind):
        return F.count(F.when(t == kind, F.lit(1)))

    return (
        events.where(t.isin(PRICE_EVENT, WEATHER_EVENT, AIR_EVENT))
        .groupBy(_hour())
        .agg(
            n(PRICE_EVENT).alias("_n_price"),
            F.max(of(PRICE_EVENT)).alias("price"),
            n(WEATHER_EVENT).alias("_n_weather"),
            F.min(of(WEATHER_EVENT)).alias("temperature_2m"),
            F.max(of(WEATHER_EVENT)).alias("wind_speed_10m"),
            n(AIR_EVENT).alias("_n_air"),
            F.min(of(AIR_EVENT)).alias("carbon_monoxide"),
            F.max(of(AIR_EVENT)).alias("pm10"),
        )
    )


def split_stand_ins(hourly: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(price, weather, air) series from ``hourly_stand_ins``; an hour belongs to
    a series when it has at least one event of that type."""
    price = hourly.where(F.col("_n_price") > 0).select("timestamp", "price")
    weather = hourly.where(F.col("_n_weather") > 0).select(
        "timestamp", "temperature_2m", "wind_speed_10m",
        F.col("_n_weather").cast(T.DoubleType()).alias("direct_radiation"),
    )
    air = hourly.where(F.col("_n_air") > 0).select(
        "timestamp", "carbon_monoxide",
        F.col("_n_air").cast(T.DoubleType()).alias("nitrogen_dioxide"), "pm10",
    )
    return price, weather, air


def price_series(events: DataFrame) -> DataFrame:
    return split_stand_ins(hourly_stand_ins(events))[0]


def weather_series(events: DataFrame) -> DataFrame:
    return split_stand_ins(hourly_stand_ins(events))[1]


def air_series(events: DataFrame) -> DataFrame:
    return split_stand_ins(hourly_stand_ins(events))[2]


# ------------------------------------------------------------ bronze documents
#
# Each run date d has one snapshot per feed covering the trailing extract
# window [d - 7 days, d + 1 day), named ``<d-7>_<d>`` like a landed fetch.
# An hour therefore appears in the snapshots of eight run dates. Built in
# one pass: every hourly row is copied to its eight run dates (explode of
# a date sequence), then grouped per run date into one document of at most
# 8 * 24 entries per series: the group size is fixed by the extract window,
# not by the data volume.

ENERGY_INTERVAL_TYPE = 4  # fixed: hourly interval code carried by price documents


def _with_run_dates(series: DataFrame, days: int = 7) -> DataFrame:
    day = F.to_date(F.col("timestamp"))
    return series.withColumn("_run_date", F.explode(F.sequence(day, F.date_add(day, days))))


def _snapshot(days: int = 7):
    from hourmill.functions.timekeys import snapshot_name_col

    return snapshot_name_col(F.col("_run_date"), days).alias("snapshot")


def _field(name: str):
    return lambda x: x[name]


def hourly_documents(series: DataFrame, metrics: list[str], zone: str, days: int = 7) -> DataFrame:
    """Struct-of-arrays documents (local wall times in ``zone``) per snapshot."""
    local = F.date_format(F.from_utc_timestamp(F.col("timestamp"), zone), "yyyy-MM-dd'T'HH:mm")
    entries = F.sort_array(F.collect_list(F.struct(F.col("timestamp").alias("t"), local.alias("time"), *metrics)))
    docs = _with_run_dates(series, days).groupBy(_snapshot(days)).agg(entries.alias("_e"))
    arrays = [F.transform("_e", _field(f)).alias(f) for f in ["time", *metrics]]
    return docs.select(
        F.lit(52.37).alias("latitude"),
        F.lit(4.90).alias("longitude"),
        F.lit(zone).alias("timezone"),
        F.struct(*arrays).alias("hourly"),
        "snapshot",
    )


def price_documents(series: DataFrame, days: int = 7) -> DataFrame:
    """Array-of-records price documents (UTC ``readingDate``) per snapshot."""
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    rec = F.struct(F.col("timestamp").alias("t"), F.col("price"), F.date_format("timestamp", iso).alias("readingDate"))
    docs = _with_run_dates(series, days).groupBy(_snapshot(days), "_run_date").agg(
        F.sort_array(F.collect_list(rec)).alias("_e"), F.max("price").alias("average")
    )
    return docs.select(
        F.transform("_e", lambda x: F.struct(x["price"].alias("price"), x["readingDate"].alias("readingDate"))).alias("Prices"),
        F.col("average"),
        F.date_format(F.date_sub("_run_date", days).cast(T.TimestampType()), iso).alias("fromDate"),
        F.date_format(F.date_add("_run_date", 1).cast(T.TimestampType()), iso).alias("tillDate"),
        F.lit(ENERGY_INTERVAL_TYPE).cast(T.LongType()).alias("intervalType"),
        "snapshot",
    )


def land_bronze(
    spark: SparkSession,
    events: DataFrame,
    root: str,
    zone: str = "Europe/Amsterdam",
    since: str | None = None,
    until: str | None = None,
) -> None:
    """Land the three feeds' snapshots under ``root/bronze/<dataset>``.

    ``since``/``until`` (snapshot names, inclusive) land only part of the
    history, e.g. to simulate fetches arriving over several runs.
    """
    from hourmill.sources.snapshots import land_snapshots

    def window(docs: DataFrame) -> DataFrame:
        if since is not None:
            docs = docs.where(F.col("snapshot") >= since)
        if until is not None:
            docs = docs.where(F.col("snapshot") <= until)
        return docs

    from hourmill.session import shared_root

    base = root.rstrip("/") + "/bronze"
    shared_root(events.sparkSession)  # checkpoint directory on the shared file system
    # One scan of ``events`` for the three feeds: the small hourly aggregate is
    # checkpointed and each landing reads it.
    price, weather, air = split_stand_ins(hourly_stand_ins(events).checkpoint(eager=True))
    landings = [
        (hourly_documents(weather, ["temperature_2m", "wind_speed_10m", "direct_radiation"], zone), f"{base}/weather"),
        (hourly_documents(air, ["carbon_monoxide", "nitrogen_dioxide", "pm10"], zone), f"{base}/air_quality"),
        (price_documents(price), f"{base}/energy"),
    ]
    # Independent writes: submitted from one thread each so they run side by side.
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=len(landings), thread_name_prefix="land") as pool:
        for f in [pool.submit(land_snapshots, window(docs), path) for docs, path in landings]:
            f.result()
