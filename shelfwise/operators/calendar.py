"""Month calendar without gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def month_spine(df: DataFrame, first: str = "order_date", last: str = "order_date") -> DataFrame:
    """One row per month from the first to the last date: `month_start`."""
    span = df.agg(F.trunc(F.min(first), "MM").alias("low"), F.trunc(F.max(last), "MM").alias("high"))
    return span.select(F.explode(F.expr("sequence(low, high, interval 1 month)")).alias("month_start"))
