"""Exact decimal measures.

Money is never a float here. Sums run on widened decimals, so that 10^12 rows cannot
overflow; quotients keep twelve decimals and are rounded half up, once, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Decimals of every measure of the fact table.
SCALES = {"sales": 4, "rating": 2, "item_weight": 3, "item_visibility": 6}


def total(name: str) -> Column:
    """Sum of a measure as DECIMAL(28, s)."""
    return F.sum(F.col(name).cast(f"decimal(18,{SCALES[name]})"))


def quotient(num: Column, den: Column) -> Column:
    """Quotient of sums and counts with twelve decimals; NULL when the denominator is zero."""
    den = den.cast("decimal(24,4)")
    return num.cast("decimal(30,8)") / F.when(den != 0, den)


def quotient_of_means(num: Column, den: Column) -> Column:
    """Quotient of averages, which are small but have up to twelve decimals of their own."""
    den = den.cast("decimal(22,12)")
    return num.cast("decimal(24,12)") / F.when(den != 0, den)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(quotient(part * 100, whole), digits)


def growth(new: Column, old: Column, digits: int = 2) -> Column:
    """Change from old to new in per cent; NULL on a zero or missing base."""
    return percent(new - old, old, digits)


def growth_of_means(new: Column, old: Column, digits: int = 2) -> Column:
    return F.round(quotient_of_means((new - old) * 100, old), digits)


def mean(name: str, digits: int | None = None) -> Column:
    """Average of a measure; by default with four decimals more than the measure has."""
    return F.round(quotient(total(name), F.count(name)), SCALES[name] + 4 if digits is None else digits)


def mean_from(sum_col: Column, count_col: Column, name: str, digits: int | None = None) -> Column:
    """The same average from partial sums that were already added up."""
    return F.round(quotient(sum_col, count_col), SCALES[name] + 4 if digits is None else digits)
