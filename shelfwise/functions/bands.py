"""Banding of a measure into labelled intervals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Upper limits and labels; the last label has no limit.
SALES_LIMITS = [500, 1000, 2000, 3000, 5000, 8000]
SALES_LABELS = ["A. Under 500", "B. 500 - 1K", "C. 1K - 2K", "D. 2K - 3K", "E. 3K - 5K", "F. 5K - 8K", "G. 8K+"]
SALES_LABELS_COMPACT = ["A. Under 500", "B. 500-1K", "C. 1K-2K", "D. 2K-3K", "E. 3K-5K", "F. 5K-8K", "G. 8K+"]
RATING_LIMITS = ["2.0", "3.0", "3.5", "4.0", "4.5"]
RATING_LABELS = [
    "1.0 - 1.9  Critical", "2.0 - 2.9  Poor", "3.0 - 3.4  Below par",
    "3.5 - 3.9  Acceptable", "4.0 - 4.4  Good", "4.5 - 5.0  Excellent",
]
RATING_LABELS_COMPACT = [
    "1.0-1.9 Critical", "2.0-2.9 Poor", "3.0-3.4 Below par",
    "3.5-3.9 Acceptable", "4.0-4.4 Good", "4.5-5.0 Excellent",
]
RATING_LIMITS_5 = ["3.0", "3.5", "4.0", "4.5"]
RATING_LABELS_5 = ["Under 3.0", "3.0 - 3.4", "3.5 - 3.9", "4.0 - 4.4", "4.5 - 5.0"]
RATING_LABELS_5_COMPACT = ["Under 3.0", "3.0-3.4", "3.5-3.9", "4.0-4.4", "4.5-5.0"]


def band(value: Column, limits: list, labels: list[str], closed: str = "left") -> Column:
    """Label of the interval a value falls in; `closed` is the side that owns a limit."""
    def below(limit):
        edge = F.lit(str(limit)).cast("decimal(12,4)")
        return value < edge if closed == "left" else value <= edge

    pairs = list(zip(limits, labels))
    first = F.when(below(pairs[0][0]), pairs[0][1])
    return reduce(lambda acc, p: acc.when(below(p[0]), p[1]), pairs[1:], first).otherwise(labels[-1])
