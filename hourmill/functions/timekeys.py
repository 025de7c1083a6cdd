"""Column functions for time parsing, zones, dates and surrogate keys.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed defaults of the source pipeline.
DEFAULT_ZONE = "Europe/Amsterdam"
KEY_SEPARATOR = "||"


def parse_ts(c: Column, fmt: str | None = None) -> Column:
    """String to timestamp; malformed text becomes NULL (never an error).

    Spark 4 runs with ANSI on, where ``to_timestamp`` raises on bad
    input; ``try_to_timestamp`` keeps the "bad value -> NULL, then
    filtered" contract.
    """
    if fmt is None:
        return F.try_to_timestamp(c)
    return F.try_to_timestamp(c, F.lit(fmt))


def as_timestamp(df: DataFrame, name: str, fmt: str | None = None) -> Column:
    """The column as TIMESTAMP whatever it arrives as (text or NTZ)."""
    dtype = df.schema[name].dataType
    c = df[name]
    if isinstance(dtype, T.StringType):
        return parse_ts(c, fmt)
    if isinstance(dtype, T.TimestampType):
        return c
    return c.cast(T.TimestampType())


def wall_to_utc(c: Column, zone: str) -> Column:
    """Local wall-clock time in ``zone`` to the UTC instant.

    Gap hours (spring) land on the instant after the gap, so two wall
    times may map to one instant; the later dedupe keeps one of them.
    """
    return F.to_utc_timestamp(c, zone)


def time_policy(
    df: DataFrame,
    name: str,
    *,
    parse: bool = True,
    to_utc: bool = False,
    zone: str = DEFAULT_ZONE,
    fmt: str | None = None,
) -> DataFrame:
    """Optionally parse ``name`` and optionally shift it from ``zone`` to UTC."""
    c = as_timestamp(df, name, fmt) if parse else df[name]
    if to_utc:
        c = wall_to_utc(c, zone)
    return df.withColumn(name, c)


def day_of(c: Column) -> Column:
    """Calendar date (UTC session) used as the partition value."""
    return F.to_date(c)


def hash_key(cols: Sequence[str | Column], sep: str = KEY_SEPARATOR) -> Column:
    """MD5 surrogate key: parts cast to text, NULL as '', joined by ``sep``.

    Parts are taken in the given order; callers pass the configured key
    order, so the key never depends on set iteration order.
    """
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws(sep, *parts))


def epoch_seconds(c: Column) -> Column:
    """Whole seconds since the epoch (floor), as LONG."""
    return F.unix_seconds(c.cast(T.TimestampType()))


def hours_before(c: Column, hours: int) -> Column:
    return c - F.make_dt_interval(hours=F.lit(int(hours)))


def extract_bounds(run_date: dt.date, days: int = 7) -> tuple[dt.date, dt.date]:
    """Trailing extract window of a fetch: ``days`` back up to the run date."""
    return run_date - dt.timedelta(days=days), run_date


def snapshot_name(run_date: dt.date, days: int = 7) -> str:
    """File stem of a landed snapshot, ``<from>_<to>`` (one rule for landing and reading)."""
    lo, hi = extract_bounds(run_date, days)
    return f"{lo.isoformat()}_{hi.isoformat()}"


def snapshot_name_col(run_date: Column, days: int = 7) -> Column:
    """``snapshot_name`` as a column expression over a DATE column."""
    return F.concat(
        F.date_format(F.date_sub(run_date, days), "yyyy-MM-dd"),
        F.lit("_"),
        F.date_format(run_date, "yyyy-MM-dd"),
    )


def time_literal(value: dt.datetime | dt.date, like: T.DataType) -> Column:
    """A timestamp literal typed like the column it is compared with.

    Comparing a TIMESTAMP_NTZ column with a TIMESTAMP literal would wrap
    the column in a cast and stop the predicate reaching the Parquet scan;
    typing the literal instead keeps ``PushedFilters``.
    """
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    text = F.lit(value.isoformat(sep=" "))
    target = T.TimestampNTZType() if isinstance(like, T.TimestampNTZType) else T.TimestampType()
    return text.cast(target)


def in_extract_window(df: DataFrame, ts: str, run_date: dt.date, days: int = 7) -> Column:
    """``ts`` within [run_date - days, run_date + 1 day), pushdown-friendly."""
    like = df.schema[ts].dataType
    lo = time_literal(run_date - dt.timedelta(days=days), like)
    hi = time_literal(run_date + dt.timedelta(days=1), like)
    return (df[ts] >= lo) & (df[ts] < hi)
