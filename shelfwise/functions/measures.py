"""Aliased aggregate columns that most reports share."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .exact import mean, quotient, total


def records(alias: str = "records") -> Column:
    return F.count(F.lit(1)).alias(alias)


def revenue(alias: str = "revenue", digits: int = 2) -> Column:
    return F.round(total("sales"), digits).alias(alias)


def avg_sale(alias: str = "avg_sale", digits: int = 2) -> Column:
    return mean("sales", digits).alias(alias)


def avg_rating(alias: str = "avg_rating", digits: int = 2) -> Column:
    return mean("rating", digits).alias(alias)


def distinct(column: str, alias: str) -> Column:
    return F.count_distinct(F.col(column)).alias(alias)


def stores(alias: str = "stores") -> Column:
    return distinct("outlet_identifier", alias)


def products(alias: str = "products") -> Column:
    return distinct("item_identifier", alias)


def revenue_per_store(alias: str = "revenue_per_store", digits: int = 2) -> Column:
    return F.round(quotient(total("sales"), F.count_distinct("outlet_identifier")), digits).alias(alias)


def revenue_when(condition: Column, alias: str, digits: int = 0) -> Column:
    """Revenue of the rows that meet a condition, zero where there are none."""
    amount = F.when(condition, F.col("sales").cast("decimal(18,4)")).otherwise(F.lit(0).cast("decimal(18,4)"))
    return F.round(F.sum(amount), digits).alias(alias)
