"""The shared measures over a roll-up, which holds row counts and sums instead of rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .exact import SCALES, mean_from, quotient
from .measures import distinct, products, stores  # noqa: F401  (the same on a roll-up)

# Row count behind each measure.
COUNTS = {"item_weight": "weighed"}


def total(name: str) -> Column:
    return F.sum(F.col(name).cast(f"decimal(28,{SCALES[name]})"))


def mean(name: str, digits: int | None = None) -> Column:
    return mean_from(total(name), F.sum(COUNTS.get(name, "records")), name, digits)


def records(alias: str = "records") -> Column:
    return F.sum("records").alias(alias)


def revenue(alias: str = "revenue", digits: int = 2) -> Column:
    return F.round(total("sales"), digits).alias(alias)


def avg_sale(alias: str = "avg_sale", digits: int = 2) -> Column:
    return mean("sales", digits).alias(alias)


def avg_rating(alias: str = "avg_rating", digits: int = 2) -> Column:
    return mean("rating", digits).alias(alias)


def revenue_per_store(alias: str = "revenue_per_store", digits: int = 2) -> Column:
    return F.round(quotient(total("sales"), F.count_distinct("outlet_identifier")), digits).alias(alias)


def revenue_when(condition: Column, alias: str, digits: int = 0) -> Column:
    """Revenue of the cells that meet a condition, zero where there are none."""
    amount = F.when(condition, F.col("sales")).otherwise(F.lit(0).cast("decimal(28,4)"))
    return F.round(F.sum(amount), digits).alias(alias)
