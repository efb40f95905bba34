"""Exact medians per group without collecting a group's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def grouped_median(df: DataFrame, keys: list[str], value: str, alias: str, count: str | None = None) -> DataFrame:
    """Median of a decimal column per key; NULL values are skipped, groups without any are absent.

    Rows are first counted per (key, value), which collapses a hot key before the shuffle.
    What remains per key is its distinct values, whose number the decimal type bounds
    whatever the row count. `count` names a column of row counts that are already added up.
    """
    rows = F.sum(F.when(F.col(value).isNotNull(), F.col(count))) if count else F.count(value)
    # Missing values are dropped by their count: a filter on the value itself would be pushed
    # below a de-duplication, and several medians could no longer share its shuffle.
    tally = df.groupBy(*keys, value).agg(rows.alias("_rows")).where(F.col("_rows") > 0)
    within = Window.partitionBy(*keys)
    upto = within.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = tally.withColumn("_upto", F.sum("_rows").over(upto)).withColumn("_all", F.sum("_rows").over(within))
    lower = F.floor((F.col("_all") + 1) / 2)
    upper = F.ceil((F.col("_all") + 1) / 2)
    middle = (
        F.min(F.when(F.col("_upto") >= lower, F.col(value))) + F.min(F.when(F.col("_upto") >= upper, F.col(value)))
    ) / 2
    return counted.groupBy(*keys).agg(middle.alias(alias))
