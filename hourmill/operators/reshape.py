"""Unnesting operators: nested snapshot documents to one row per instant.

Both are generators (``Generate`` in the plan) evaluated row by row inside
the scan's task, so they never shuffle and scale with the input files.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourmill.functions.timekeys import DEFAULT_ZONE, time_policy

_ROW = "_hm_row"


def zip_rows(
    df: DataFrame,
    struct_col: str,
    fields: Sequence[str],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Struct of parallel arrays -> one row per array position.

    Arrays are zipped position by position; a shorter array is padded
    with NULL. A document whose arrays are NULL or all empty yields no row.
    ``keep`` lists outer columns carried to every produced row; by default
    all top-level columns except ``struct_col``.
    """
    if keep is None:
        keep = [c for c in df.columns if c != struct_col]
    zipped = F.arrays_zip(*[F.col(struct_col)[f].alias(f) for f in fields])
    rows = df.select(*[df[c] for c in keep], F.explode(zipped).alias(_ROW))
    return rows.select(*[rows[c] for c in keep], *[F.col(_ROW)[f].alias(f) for f in fields])


def explode_records(
    df: DataFrame,
    array_col: str,
    fields: Mapping[str, str],
    keep: Mapping[str, Column | str] | None = None,
) -> DataFrame:
    """Array of structs -> one row per element, element fields renamed.

    ``fields`` maps output name -> element field. ``keep`` maps output
    name -> outer column (or expression) copied to every element row, e.g.
    typed snapshot metadata. NULL or empty arrays yield no row.
    """
    keep = dict(keep or {})
    outer = [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in keep.items()]
    rows = df.select(*outer, F.explode(F.col(array_col)).alias(_ROW))
    return rows.select(*[F.col(k) for k in keep], *[F.col(_ROW)[src].alias(dst) for dst, src in fields.items()])


def hourly_rows(
    df: DataFrame,
    *,
    fields: Sequence[str],
    struct_col: str = "hourly",
    time_field: str = "time",
    zone: str = DEFAULT_ZONE,
    to_utc: bool = True,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Hourly struct-of-arrays document -> rows with a UTC ``timestamp``.

    ``time_field`` text is parsed (malformed -> NULL), optionally read as
    wall time in ``zone`` and shifted to UTC, and replaces ``time_field``.
    """
    rows = zip_rows(df, struct_col, fields, keep=keep)
    rows = rows.withColumnRenamed(time_field, "timestamp") if time_field != "timestamp" else rows
    return time_policy(rows, "timestamp", parse=True, to_utc=to_utc, zone=zone)


def record_rows(
    df: DataFrame,
    *,
    array_col: str,
    fields: Mapping[str, str],
    keep: Mapping[str, Column | str] | None = None,
    ts_col: str | None = "timestamp",
    parse: bool = True,
    to_utc: bool = False,
    zone: str = DEFAULT_ZONE,
) -> DataFrame:
    """Array-of-structs document -> rows, then the timestamp policy on ``ts_col``."""
    rows = explode_records(df, array_col, fields, keep=keep)
    if ts_col:
        rows = time_policy(rows, ts_col, parse=parse, to_utc=to_utc, zone=zone)
    return rows


def _struct_of_arrays(df: DataFrame, params: Mapping) -> DataFrame:
    return hourly_rows(
        df,
        fields=params["hourly_fields"],
        struct_col=params.get("struct_col", "hourly"),
        time_field=params.get("timestamp_field", "time"),
        zone=params.get("source_timezone", DEFAULT_ZONE),
        to_utc=params.get("to_utc", True),
        keep=params.get("keep"),
    )


def _array_of_structs(df: DataFrame, params: Mapping) -> DataFrame:
    ts = params.get("timestamp") or {}
    return record_rows(
        df,
        array_col=params["array_col"],
        fields=params["select_map"],
        keep=params.get("keep"),
        ts_col=ts.get("col") if ts else None,
        parse=ts.get("to_timestamp", True),
        to_utc=ts.get("to_utc", False),
        zone=ts.get("source_timezone", DEFAULT_ZONE),
    )


def _passthrough(df: DataFrame, params: Mapping) -> DataFrame:
    return df


# Transform registry, keyed by the names used in dataset configuration.
# Fixed names (configs written for the source pipeline use them):
# "open_meteo_hourly", "explode_array_of_struct", "passthrough".
TRANSFORMS: dict[str, Callable[[DataFrame, Mapping], DataFrame]] = {
    "open_meteo_hourly": _struct_of_arrays,
    "explode_array_of_struct": _array_of_structs,
    "passthrough": _passthrough,
    "struct_of_arrays": _struct_of_arrays,
    "array_of_structs": _array_of_structs,
}


def apply_transform(df: DataFrame, kind: str, params: Mapping | None = None) -> DataFrame:
    try:
        fn = TRANSFORMS[kind]
    except KeyError:
        raise ValueError(f"unknown transform type: {kind!r}") from None
    return df.transform(lambda d: fn(d, params or {}))
