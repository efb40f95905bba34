"""Grouped summaries, shares, filters and benchmarks that many reports share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exact import percent, quotient
from ..sources.store import written


def summarise(df: DataFrame, keys: dict[str, str] | list[str], *measures: Column) -> DataFrame:
    """Group by columns, renamed if a dict {output: input} is given."""
    if isinstance(keys, dict):
        return df.groupBy(*[F.col(c).alias(name) for name, c in keys.items()]).agg(*measures)
    return df.groupBy(*keys).agg(*measures)


def share_of_all(part: str | Column, digits: int = 2) -> Column:
    """Share of the column's sum, for a summary of few rows (categories, tiers, months)."""
    part = F.col(part) if isinstance(part, str) else part
    return percent(part, F.sum(part).over(Window.partitionBy()), digits)


def one_row(df: DataFrame) -> Column:
    """The single row of an aggregate as a struct: a scalar subquery, so nothing is joined."""
    return df.select(F.struct(*df.columns)).scalar()


def mean_of(column: str, digits: int) -> Column:
    """Average of an aggregate's column, unweighted."""
    return F.round(quotient(F.sum(column), F.count(column)), digits)


def top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First n rows; the order ends in the key, so ties have one answer."""
    return df.orderBy(*order).limit(n)


def join_lookup(df: DataFrame, lookup: DataFrame, keys: list[str]) -> DataFrame:
    """Join a lookup that is stored first: it is built once, and the planner knows its size.

    Few keys (categories) would send most of the large side to a handful of tasks; a table of so
    few rows is broadcast.
    """
    return df.join(written(lookup, "lookup"), keys)


def apply_filters(df: DataFrame, filters: dict[str, list]) -> DataFrame:
    """Keep the rows whose fields are among the chosen values; an empty choice keeps all."""
    for field, chosen in filters.items():
        if chosen:
            df = df.where(F.col(field).isin(list(chosen)))
    return df


def conjunction(tests: list[Column]) -> Column:
    result = F.lit(True)
    for test in tests:
        result = result & test
    return result
