"""Column naming and projection helpers (schema-level, no data work)."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

# The naming rule cleaned names must agree with.
# Trim and lower-case; then these two patterns, each replaced by "_":
#   [^\w]+   a run of non-word characters
#   __+      a run of two or more underscores
# and finally leading/trailing "_" are stripped.
_NON_WORD_RUN = re.compile(r"[^\w]+")
_UNDERSCORE_RUN = re.compile(r"__+")


def snake_name(name: str) -> str:
    lowered = name.strip().lower()
    return _UNDERSCORE_RUN.sub("_", _NON_WORD_RUN.sub("_", lowered)).strip("_")


def snake_columns(df: DataFrame) -> DataFrame:
    """Rename every top-level column to snake_case in one projection.

    Two names that clean to the same result would make later references
    ambiguous, so that raises instead of silently shadowing a column.
    """
    cleaned = [snake_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for raw, new in zip(df.columns, cleaned):
        if not new:
            raise ValueError(f"column {raw!r} has no usable characters")
        if new in seen:
            raise ValueError(f"columns {seen[new]!r} and {raw!r} both clean to {new!r}")
        seen[new] = raw
    if cleaned == list(df.columns):
        return df
    return df.toDF(*cleaned)


def pick(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Project the wanted columns that exist, in the wanted order, once each."""
    present = set(df.columns)
    keep = [c for c in dict.fromkeys(wanted) if c in present]
    return df.select(*[df[c] for c in keep])


def require(df: DataFrame, needed: Iterable[str], dataset: str = "") -> None:
    """Raise, naming what there is with its type, unless all needed columns are there."""
    found = dict(df.dtypes)
    gaps = sorted(set(needed) - found.keys())
    if gaps:
        raise ValueError(f"{dataset or 'frame'} lacks {', '.join(gaps)}; it has " + ", ".join(f"{c} {t}" for c, t in found.items()))


def prefix_columns(df: DataFrame, prefix: str, keys: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Prefix every non-key column, in one projection."""
    return df.select(*[df[c] if c in keys else df[c].alias(prefix + c) for c in df.columns])
