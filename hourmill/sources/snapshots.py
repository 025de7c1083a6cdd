"""Bronze sources: landed JSON snapshots of the three hourly feeds.

Layout (one naming rule for landing and reading)::

    <bronze>/<dataset>/snapshot=<from>_<to>/part-*.json

    <bronze>/<dataset>/_landed/<from>_<to>

``_landed`` is the manifest: a name is in it once its documents are there
whole, so a date that never came is known without trying to read it.
``snapshot`` is a partition folder, so reading one run's snapshot or all
snapshots newer than a date is partition pruning on the ``snapshot``
column, and every row knows which snapshot it came from (newest wins in
the silver dedupe). ``<from>_<to>`` sorts by date.

Schemas are explicit: no inference job, no type drift when a feed sends
only whole numbers, and only the listed fields are parsed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmill.functions.timekeys import snapshot_name
from hourmill.session import child_names, path_exists, write_small_text

SNAPSHOT_COL = "snapshot"
MANIFEST = "_landed"

# Fixed field lists of the three source feeds.
WEATHER_FIELDS = ("time", "temperature_2m", "wind_speed_10m", "direct_radiation")
AIR_FIELDS = ("time", "carbon_monoxide", "nitrogen_dioxide", "pm10")
ENERGY_RECORD_FIELDS = ("price", "readingDate")


def hourly_schema(fields: Sequence[str], time_field: str = "time") -> T.StructType:
    """``hourly`` struct of parallel arrays: text times, DOUBLE metrics."""
    arrays = [
        T.StructField(f, T.ArrayType(T.StringType() if f == time_field else T.DoubleType()))
        for f in fields
    ]
    return T.StructType(
        [
            T.StructField("latitude", T.DoubleType()),
            T.StructField("longitude", T.DoubleType()),
            T.StructField("timezone", T.StringType()),
            T.StructField("hourly", T.StructType(arrays)),
        ]
    )


ENERGY_SCHEMA = T.StructType(
    [
        T.StructField(
            "Prices",
            T.ArrayType(
                T.StructType(
                    [T.StructField("price", T.DoubleType()), T.StructField("readingDate", T.StringType())]
                )
            ),
        ),
        T.StructField("average", T.DoubleType()),
        T.StructField("fromDate", T.StringType()),
        T.StructField("tillDate", T.StringType()),
        T.StructField("intervalType", T.LongType()),
    ]
)
WEATHER_SCHEMA = hourly_schema(WEATHER_FIELDS)
AIR_SCHEMA = hourly_schema(AIR_FIELDS)


def read_source(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "json",
    schema: T.StructType | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Pluggable reader (``fmt`` is any Spark source name)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.load(paths if len(paths) > 1 else paths[0])


def with_snapshot_column(schema: T.StructType | None) -> T.StructType | None:
    if schema is None or SNAPSHOT_COL in schema.fieldNames():
        return schema
    return T.StructType([*schema.fields, T.StructField(SNAPSHOT_COL, T.StringType())])


def read_snapshots(
    spark: SparkSession,
    base: str,
    schema: T.StructType | None = None,
    fmt: str = "json",
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """All landed snapshots of one dataset (optionally a name range), with ``snapshot``.

    ``since``/``until`` are snapshot names compared as text (inclusive),
    which prunes partition folders before any file is opened.
    """
    df = read_source(spark, base, fmt, with_snapshot_column(schema))
    if since is not None:
        df = df.where(F.col(SNAPSHOT_COL) >= F.lit(since))
    if until is not None:
        df = df.where(F.col(SNAPSHOT_COL) <= F.lit(until))
    return df


def read_snapshot(
    spark: SparkSession,
    base: str,
    name: str,
    schema: T.StructType | None = None,
    fmt: str = "json",
) -> DataFrame:
    """Exactly one snapshot folder; raises AnalysisException when it is absent."""
    folder = f"{base.rstrip('/')}/{SNAPSHOT_COL}={name}"
    return read_source(spark, folder, fmt, with_snapshot_column(schema), {"basePath": base})


def landed_names(spark: SparkSession, base: str) -> list[str]:
    """Names of the snapshots of one dataset that have landed, by the manifest.

    A dataset that another tool landed, without a manifest, is known by its folders.
    """
    base = base.rstrip("/")
    if path_exists(spark, f"{base}/{MANIFEST}"):
        return child_names(spark, f"{base}/{MANIFEST}")
    return _folder_names(spark, base)


def _folder_names(spark: SparkSession, base: str) -> list[str]:
    prefix = f"{SNAPSHOT_COL}="
    return [n.removeprefix(prefix) for n in child_names(spark, base) if n.startswith(prefix)]


def has_landed(spark: SparkSession, base: str, name: str) -> bool:
    base = base.rstrip("/")
    if path_exists(spark, f"{base}/{MANIFEST}"):
        return path_exists(spark, f"{base}/{MANIFEST}/{name}")
    return path_exists(spark, f"{base}/{SNAPSHOT_COL}={name}")


def read_incremental(
    spark: SparkSession,
    base: str,
    run_date: dt.date,
    schema: T.StructType | None = None,
    fmt: str = "json",
    days: int = 7,
    fallback: bool = True,
    until: str | None = None,
) -> tuple[DataFrame, bool]:
    """The run date's snapshot; when that has not landed, all snapshots.

    The manifest decides; any error in reading is raised. ``until`` (a
    snapshot name) hides later ones, the run date's own too. Returns the
    frame and whether the fallback was taken; without ``fallback`` an absent
    snapshot raises Spark's error.
    """
    name = snapshot_name(run_date, days)
    if not fallback or ((until is None or name <= until) and has_landed(spark, base, name)):
        return read_snapshot(spark, base, name, schema, fmt), False
    return read_snapshots(spark, base, schema, fmt, until=until), True


def trailing_extract(df: DataFrame, ts: str, run_date: dt.date, days: int = 7) -> DataFrame:
    """Rows a fetch on ``run_date`` returns: ``days`` back through the run date."""
    from hourmill.functions.timekeys import in_extract_window

    return df.where(in_extract_window(df, ts, run_date, days))


def land_snapshots(df: DataFrame, base: str, replace: bool = False) -> None:
    """Land documents (with a ``snapshot`` column) as JSON, one folder per snapshot.

    Bronze keeps history: only the snapshot folders present in ``df`` are
    (re)written, so landing the same fetch twice leaves one copy and other
    snapshots stay. ``replace=True`` clears the whole dataset folder first
    (the source pipeline's "delete bronze" step, opt-in). Names enter the
    manifest after the documents are written.
    """
    spark, base = df.sparkSession, base.rstrip("/")
    writer = df.hint("rebalance", SNAPSHOT_COL).write.mode("overwrite").partitionBy(SNAPSHOT_COL)
    if not replace:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.json(base)
    # Folders are swapped in when the write commits, so all that are there now are whole.
    known = child_names(spark, f"{base}/{MANIFEST}")
    for name in _folder_names(spark, base):
        if name not in known:
            write_small_text(spark, f"{base}/{MANIFEST}/{name}", name + "\n")
