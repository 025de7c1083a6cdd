"""Trailing time-range average without a single-partition window.

Semantics (per series, on whole epoch seconds ``s`` of the timestamp):

    mean(x) over rows with  s - R*3600 <= s' <= s - 1

i.e. the current second and every row sharing it are excluded, the row
exactly R hours back is included, gaps are respected, NULL values are
ignored and an empty frame gives NULL.

A global ``Window.orderBy(t).rangeBetween(...)`` puts every row of a
series into one task. Instead:

1. rows are pre-aggregated per (series, second) into a sum (of doubles, or
   of exact decimals when a scale is given) and a non-null count (map-side
   partial aggregation, so a hot second or hour is reduced before it is
   shuffled);
2. frames only ever add, in time linear in the seconds:
   * doubles: time is cut into blocks as long as the window. A frame that
     ends in a block is the rest of the block before it (a running sum from
     the back) plus what its own block has had so far (a running sum from
     the front). Nothing is taken away again, so no digit is lost to
     cancellation and a NaN or an infinity leaves with its frame, as in AVG.
     A block's rows and a copy of the block before, moved on by the window's
     length, make one window partition: 2 * R*3600 seconds at most;
   * decimals: blocks of B >= R*3600 seconds with the last R hours of the
     block before as a halo; the frame is the difference of two running
     sums, exact for decimals. A partition has at most B + R*3600 seconds.
   Either bound holds however many rows fall in a partition;
3. the per-second result is joined back to the rows on (series, second).
   That result has at most one row per series and second, whatever the
   number of input rows; it is materialized and measured first and then
   broadcast when it fits the session's broadcast threshold, so the rows
   are joined where they are read instead of being shuffled. Above the
   threshold the join shuffles both sides and AQE splits hot seconds.

With a scale the result does not depend on the order in which partitions
are combined; sums of doubles can differ in their last digits.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from hourmill.functions.timekeys import epoch_seconds
from hourmill.operators.sizing import measured_side

_SEC = "_hm_s"
_BUCKET = "_hm_b"
_HOME = "_hm_home"
_MOVED = "_hm_moved"
_AT = "_hm_at"
_PSUM = "_hm_psum"
_PCNT = "_hm_pcnt"
_FSUM = "_hm_fsum"
_FCNT = "_hm_fcnt"

# Integer digits of values summed exactly (|x| < 1e12), beside their ``scale``.
INPUT_DIGITS = 12
HALO_FACTOR = 8


def _summand(value: Column, scale: int | None) -> Column:
    """The value as it is summed: a double, or with ``scale`` an exact decimal.

    A decimal that is not the value itself (more decimals than ``scale``, 1e12
    or more, NaN or infinite) is an error, never a rounding.
    """
    if scale is None:
        return value.cast(T.DoubleType())
    if not 0 <= scale <= 38 - INPUT_DIGITS:
        raise ValueError(f"scale must be between 0 and {38 - INPUT_DIGITS}")
    v, kind = value.cast(T.DoubleType()), T.DecimalType(INPUT_DIGITS + scale, scale)
    # A whole number of units below 2**53 whose quotient is the value again:
    # division rounds to the nearest double, so no other decimal comes closer.
    units = F.rint(v * F.lit(float(10**scale)))
    few = (F.abs(units) <= F.lit(float(1 << 53))) & (units / F.lit(float(10**scale)) == v)
    fast = (units.cast("long").cast(T.DecimalType(16, 0)) * F.lit(Decimal(1).scaleb(-scale))).cast(kind)
    exact = v.cast(T.StringType()).try_cast(kind)  # beyond: by its digits
    bad = F.raise_error(F.concat(F.lit(f"value does not fit {scale} decimals: "), v.cast("string"))).cast(kind)
    slow = F.when(exact.cast(T.DoubleType()) == v, exact).otherwise(bad)
    return F.when(v.isNull(), F.lit(None).cast(kind)).when(few, fast).otherwise(slow)


def trailing_frame(
    df: DataFrame,
    value: str,
    *,
    ts: str = "timestamp",
    hours: int = 3,
    by: Sequence[str] = (),
    bucket_seconds: int | None = None,
    scale: int | None = None,
) -> DataFrame:
    """Per (series, second): sum and count of ``value`` over the trailing frame.

    Returns columns ``by + [_hm_s, _hm_fsum, _hm_fcnt]``, one row per
    distinct (series, second) in ``df``.
    """
    width, bucket = _widths(hours, bucket_seconds)
    by = list(by)

    per_second = (
        df.select(*by, epoch_seconds(F.col(ts)).alias(_SEC), F.col(value).alias("_hm_v"))
        .where(F.col(_SEC).isNotNull())
        .groupBy(*by, _SEC)
        .agg(
            F.sum(_summand(F.col("_hm_v"), scale)).alias(_PSUM),
            F.count("_hm_v").alias(_PCNT),
        )
    )
    return _framed(per_second, by, width, bucket, scale, [])


def _haloed_frame(
    rows: DataFrame,
    by: list[str],
    width: int,
    bucket: int,
    scale: int,
    carry: Sequence[str],
    psum: str,
    pcnt: str,
) -> DataFrame:
    """Frame sum/count of decimals per row of ``rows`` (which has ``_hm_s``) via halo buckets.

    Each row also goes to the next bucket when it lies within ``width``
    seconds of it; per (series, bucket) the frame is the difference of two
    running sums; only rows in their home bucket are returned, with
    ``carry`` columns passed through.
    """
    home = F.floor(F.col(_SEC) / F.lit(bucket))
    reach = F.floor((F.col(_SEC) + F.lit(width)) / F.lit(bucket))
    copies = F.when(reach > home, F.array(home, reach)).otherwise(F.array(home))
    haloed = rows.select("*", home.alias(_HOME), F.explode(copies).alias(_BUCKET))

    # Exact decimals: frame sum = (everything before s) - (everything before
    # s - R*3600), two running frames that Spark maintains in O(n).
    ordered = Window.partitionBy(*by, _BUCKET).orderBy(_SEC)
    before = ordered.rangeBetween(Window.unboundedPreceding, -1)
    too_old = ordered.rangeBetween(Window.unboundedPreceding, -width - 1)
    zero = F.lit(0).cast(T.DecimalType(38, scale))
    fsum = (F.coalesce(F.sum(psum).over(before), zero) - F.coalesce(F.sum(psum).over(too_old), zero)).cast(T.DecimalType(38, scale))
    fcnt = F.coalesce(F.sum(pcnt).over(before), F.lit(0)) - F.coalesce(F.sum(pcnt).over(too_old), F.lit(0))
    return haloed.select(
        *[c for c in carry if c not in by],
        *by,
        _SEC,
        fsum.alias(_FSUM),
        fcnt.alias(_FCNT),
        (F.col(_BUCKET) == F.col(_HOME)).alias("_hm_is_home"),
    ).where("_hm_is_home").drop("_hm_is_home")


def _block_frame(rows: DataFrame, by: list[str], width: int, carry: Sequence[str], psum: str, pcnt: str) -> DataFrame:
    """Frame sum/count of doubles per row of ``rows`` (which has ``_hm_s``), by additions alone.

    Every row stands in its own block of ``width`` seconds and, moved on by
    ``width``, in the next one. In a block, read forwards, own rows before s
    add up to the frame's younger part; read backwards, moved rows from s on
    (those at most ``width`` seconds older than s) to its older part.
    """
    copies = rows.select("*", F.explode(F.array(F.lit(0), F.lit(width))).alias(_MOVED))
    copies = copies.withColumn(_AT, F.col(_SEC) + F.col(_MOVED)).withColumn(_BUCKET, F.floor(F.col(_AT) / F.lit(width)))
    block = Window.partitionBy(*by, _BUCKET)
    forward = block.orderBy(_AT).rangeBetween(Window.unboundedPreceding, -1)
    backward = block.orderBy(F.desc(_AT)).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.col(_MOVED) == 0

    def frame(c: str, zero: Column) -> Column:
        young = F.sum(F.when(own, F.col(c))).over(forward)
        old = F.sum(F.when(~own, F.col(c))).over(backward)
        return F.when(young.isNotNull() | old.isNotNull(), F.coalesce(young, zero) + F.coalesce(old, zero))

    framed = copies.select(
        *[c for c in carry if c not in by], *by, _SEC, _MOVED,
        frame(psum, F.lit(0.0)).alias(_FSUM), F.coalesce(frame(pcnt, F.lit(0)), F.lit(0)).alias(_FCNT),
    )
    return framed.where(F.col(_MOVED) == 0).drop(_MOVED)


def _framed(rows: DataFrame, by: list[str], width: int, bucket: int, scale: int | None, carry: Sequence[str]) -> DataFrame:
    if scale is None:
        return _block_frame(rows, by, width, carry, _PSUM, _PCNT)
    return _haloed_frame(rows, by, width, bucket, scale, carry, _PSUM, _PCNT)


def _widths(hours: int, bucket_seconds: int | None) -> tuple[int, int]:
    width = int(hours) * 3600
    if width <= 0:
        raise ValueError("hours must be positive")
    bucket = int(bucket_seconds or HALO_FACTOR * width)
    if bucket < width:
        raise ValueError("bucket_seconds must be at least the window width")
    return width, bucket


def trailing_mean(
    df: DataFrame,
    value: str,
    out: str,
    *,
    ts: str = "timestamp",
    hours: int = 3,
    by: Sequence[str] = (),
    count_out: str | None = None,
    bucket_seconds: int | None = None,
    scale: int | None = None,
    unique_rows: bool = False,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """``df`` plus ``out`` = trailing mean of ``value`` (and optionally the frame count).

    ``unique_rows=True`` is for inputs with one row per (series, timestamp)
    at a bounded rate, such as an hourly series: the rows themselves are
    halo-copied and windowed (one shuffle), skipping the per-second
    pre-aggregation and the join back. A window partition then holds the
    rows of 2R (with ``scale``: B + R) hours of one series. Results are
    identical either way. ``bucket_seconds`` (B) is for ``scale`` only.

    Values are averaged as doubles, every digit kept; NaN and infinities in
    a frame show in its mean as in AVG. With ``scale`` they are summed as
    exact decimals of that many places, so the mean does not depend on how
    rows were dealt; a value that does not fit exactly is an error.

    Otherwise the per-second frames are materialized (a reliable
    checkpoint, so a job runs now) and broadcast to the rows when their
    measured size is at most ``broadcast_limit`` bytes (default: the
    session's ``spark.sql.autoBroadcastJoinThreshold``; negative: never
    materialize, leave the join to the planner).
    """
    by = list(by)
    if unique_rows:
        width, bucket = _widths(hours, bucket_seconds)
        rows = df.select(
            "*",
            epoch_seconds(F.col(ts)).alias(_SEC),
            _summand(F.col(value), scale).alias(_PSUM),
            F.when(F.col(value).isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast(T.LongType()).alias(_PCNT),
        )
        # Rows without a time have an empty frame. Filtering on the input
        # column lets Catalyst drop this branch when the input is already
        # known to have no NULL times (then the input is read once).
        timed = rows.where(F.col(ts).isNotNull())
        framed = _framed(timed, by, width, bucket, scale, df.columns)
        untimed = rows.where(F.col(ts).isNull()).select(
            *df.columns, F.lit(None).cast(framed.schema[_FSUM].dataType).alias(_FSUM), F.lit(0).cast(T.LongType()).alias(_FCNT)
        )
        both = framed.select(*df.columns, _FSUM, _FCNT).unionByName(untimed)
        mean = F.when(F.col(_FCNT) > 0, F.col(_FSUM).cast(T.DoubleType()) / F.col(_FCNT))
        cols = [F.col(c) for c in df.columns] + [mean.alias(out)]
        if count_out:
            cols.append(F.col(_FCNT).cast(T.LongType()).alias(count_out))
        return both.select(*cols)

    framed = trailing_frame(
        df, value, ts=ts, hours=hours, by=by, bucket_seconds=bucket_seconds, scale=scale
    )
    if broadcast_limit is None or broadcast_limit >= 0:
        framed = measured_side(framed, broadcast_limit).df
    keyed = df.withColumn(_SEC, epoch_seconds(F.col(ts)))
    # Series keys may be NULL (a NULL key is one series, as in partitionBy),
    # so they are matched null-safely; the second is never NULL here.
    renamed = framed.select(*[F.col(c).alias(f"_hm_by{i}") for i, c in enumerate(by)], _SEC, _FSUM, _FCNT)
    renamed = renamed.withColumnRenamed(_SEC, "_hm_fs")
    # Both sides have disjoint column names, so plain names resolve uniquely
    # (the materialized side may come from the same lineage as ``df``).
    cond = [F.col(c).eqNullSafe(F.col(f"_hm_by{i}")) for i, c in enumerate(by)]
    cond.append(F.col(_SEC) == F.col("_hm_fs"))
    joined = keyed.join(renamed, cond, "left")
    mean = F.when(F.col(_FCNT) > 0, F.col(_FSUM).cast(T.DoubleType()) / F.col(_FCNT))
    cols = [F.col(c) for c in df.columns] + [mean.alias(out)]
    if count_out:
        cols.append(F.coalesce(F.col(_FCNT), F.lit(0)).cast(T.LongType()).alias(count_out))
    return joined.select(*cols)
