"""Gold business rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed labels of the source pipeline's gold rules.
LABEL_TRUE = "CHEAP"
LABEL_FALSE = "NORMAL"


def pct_vs(price: Column, avg: Column) -> Column:
    """Relative difference to the average; NULL when the average is NULL or 0."""
    return (price - avg) / F.nullif(avg, F.lit(0.0))


def cheap_label(
    price: Column,
    avg: Column,
    wind: Column,
    threshold: float,
    yes: str = LABEL_TRUE,
    no: str = LABEL_FALSE,
) -> Column:
    """``yes`` when the price is below its trailing average and wind reaches the threshold."""
    return F.when((price < avg) & (wind >= float(threshold)), yes).otherwise(no)
