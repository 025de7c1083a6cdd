"""Serving layer: the report aggregate, default sums, the model relationship, preview.

Measures are summed as they are, every digit kept. A total of doubles can
differ in its last digits with how rows were dealt; a measure that has a fixed
number of decimals should be a DECIMAL column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmill.operators.quality import duplicate_keys

def chart(gold: DataFrame, dim: str = "price", measure: str = "avg_price_last_3h") -> DataFrame:
    """SUM(measure) per dim, largest first (the report's column chart)."""
    out = f"sum_{measure}"
    return gold.groupBy(dim).agg(F.sum(measure).cast(T.DoubleType()).alias(out)).orderBy(F.desc_nulls_last(out), F.asc(dim))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def default_sums(df: DataFrame, dims: Sequence[str] = ("label",), exclude: Sequence[str] = ()) -> DataFrame:
    """SUM of every numeric column per ``dims`` (timestamp/label are not summed)."""
    cols = numeric_columns(df, [*dims, *exclude])
    return df.groupBy(*dims).agg(*[F.sum(c).cast(T.DoubleType()).alias(f"sum_{c}") for c in cols])


def relationship(
    left: DataFrame,
    right: DataFrame,
    key: str = "timestamp",
    right_prefix: str = "air_",
    check: bool = True,
) -> DataFrame:
    """One-to-one relationship on ``key`` exposed as a full outer join.

    Both sides must be unique on the key (checked by one aggregation over
    both sides' keys); right-side non-key columns are prefixed.
    """
    if check:
        # Both sides in one job: keys tagged by side, counted per (side, key).
        tagged = left.select(F.lit("from-side").alias("_hm_side"), F.col(key)).unionByName(
            right.select(F.lit("to-side").alias("_hm_side"), F.col(key))
        )
        dup = duplicate_keys(tagged, ["_hm_side", key]).select("_hm_side").limit(1).collect()
        if dup:
            raise ValueError(f"relationship {dup[0][0]}: key {[key]} is not unique")
    r = right.select(F.col(key).alias("_hm_k"), *[F.col(c).alias(right_prefix + c) for c in right.columns if c != key])
    joined = left.join(r, left[key] == r["_hm_k"], "full_outer")
    return joined.select(
        F.coalesce(left[key], r["_hm_k"]).alias(key),
        *[left[c] for c in left.columns if c != key],
        *[r[right_prefix + c] for c in right.columns if c != key],
    )


def preview(df: DataFrame, n: int = 1000, order_by: Sequence[str] = ("timestamp",)) -> DataFrame:
    """The first ``n`` rows in a stated order (top-k, not an arbitrary sample)."""
    return df.orderBy(*order_by).limit(n)


def preview_sql(spark: SparkSession, table: str, n: int = 1000, order_by: Sequence[str] = ("timestamp",)) -> DataFrame:
    """The same through SQL over a catalog table or view (ad-hoc inspection); a leading ``-`` means descending.

    Table name and limit are parameters of the statement, never part of its text.
    """
    order = ", ".join(f"`{c.removeprefix('-')}`" + (" DESC" if c.startswith("-") else "") for c in order_by)
    return spark.sql(f"SELECT * FROM IDENTIFIER(:name) ORDER BY {order} LIMIT :n", args={"name": table, "n": int(n)})
