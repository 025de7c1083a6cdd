"""Checked broadcast: a join side is broadcast only after it has been measured.

Spark's own broadcast decisions come from estimates (file statistics) or,
with AQE, from shuffle sizes measured at run time. The latter arrives too
late for a side computed from the same large input as the other side: both
sides' first shuffles run in the same wave, so the large side has been
shuffled by the time the small one is known to be small.

``measured_side`` therefore materializes the small side first (a reliable
checkpoint into the shared checkpoint folder, which also cuts its lineage),
counts its rows in the same job (an ``Observation``), and estimates its
size from the row count and the schema. Only under the limit is it marked
for broadcast; above it the join is left to the shuffle (sort-merge) join,
where AQE splits skewed partitions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmill.session import shared_root

# Per-row overhead of Spark's binary row format (header, null bits).
ROW_OVERHEAD = 16
# Width assumed for variable-length values (text, binary, nested).
VARIABLE_WIDTH = 48

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def parse_bytes(text: str) -> int:
    """Spark byte strings ("10485760b", "10MB", "-1") as bytes."""
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", str(text))
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"not a byte size: {text!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def broadcast_limit(spark) -> int:
    """The session's broadcast threshold in bytes (negative = never broadcast)."""
    return parse_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB"))


def _width(dtype: T.DataType) -> int:
    if isinstance(dtype, (T.ByteType, T.BooleanType)):
        return 1
    if isinstance(dtype, T.ShortType):
        return 2
    if isinstance(dtype, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(dtype, T.DecimalType):
        return 8 if dtype.precision <= 18 else 16
    if isinstance(dtype, (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)):
        return 8
    return VARIABLE_WIDTH


def row_width(schema: T.StructType) -> int:
    """Estimated bytes per row (fixed widths, a default for variable ones)."""
    return ROW_OVERHEAD + sum(8 + max(0, _width(f.dataType) - 8) for f in schema.fields)


@dataclass(frozen=True)
class Measured:
    df: DataFrame  # materialized, possibly marked for broadcast
    rows: int
    est_bytes: int
    broadcast: bool


def measured_side(df: DataFrame, limit: int | None = None) -> Measured:
    """Materialize ``df``, measure it, and mark it for broadcast when it fits.

    ``limit`` defaults to the session's ``spark.sql.autoBroadcastJoinThreshold``;
    a negative limit never broadcasts.
    """
    spark = df.sparkSession
    if limit is None:
        limit = broadcast_limit(spark)
    shared_root(spark)  # checkpoint folder on the shared file system
    obs = Observation("measured_side")
    done = df.observe(obs, F.count(F.lit(1)).alias("rows")).checkpoint(eager=True)
    rows = int(obs.get["rows"])  # counted by the checkpoint job itself
    est = rows * row_width(done.schema)
    small = 0 <= est <= limit
    return Measured(F.broadcast(done) if small else done, rows, est, small)
