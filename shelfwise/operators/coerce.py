"""The lenient load: a bad value becomes NULL and is kept apart with its place and reason.

One pass types the rows, notes what was wrong with each and writes both, so the rejects of a load belong
to exactly the rows that were loaded. The load is published only if the share of rows with a reject is
within a limit, so a wrong file doesn't pass as one with many gaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schema import RAW_COLUMNS
from ..sources.files import LINE, PLACE
from ..sources.publish import Part, publish, published
from ..sources.store import written
from . import cleaning
from .cleaning import NUMBERS, blank_to_null, canonical_fat_content, type_columns

NOT_A_NUMBER, OUT_OF_RANGE, NOT_A_DATE, NO_LABEL, NOT_A_ROW = "not a number", "out of range", "not a date", "unknown label", "malformed line"


def _reason(column: str) -> Column:
    """Why a value can't be typed; NULL for one that can, or that is blank."""
    text = blank_to_null(column)
    if column in NUMBERS:
        # A number that some type holds is too large for this one.
        other = F.when(text.try_cast("double").isNull(), NOT_A_NUMBER).otherwise(OUT_OF_RANGE)
        return F.when(text.isNotNull() & text.try_cast(NUMBERS[column]).isNull(), other)
    if column == "order_date":
        return F.when(text.isNotNull() & F.try_to_date(text, "yyyy-MM-dd").isNull(), NOT_A_DATE)
    if column == "item_fat_content":
        return F.when(text.isNotNull() & canonical_fat_content(column).isNull(), NO_LABEL)
    return F.lit(None).cast("string")


def rejects(raw: DataFrame) -> Column:
    """The values of a row that can't be typed: column_name, value and reason of each. A malformed line is one reject, itself."""
    def reject(name: str, value: Column, reason: Column) -> Column:
        return F.struct(F.lit(name).alias("column_name"), value.alias("value"), reason.alias("reason"))

    checked = [c for c in RAW_COLUMNS if c in NUMBERS or c in ("order_date", "item_fat_content")]
    # Each reason is named once, so it is worked out once per row.
    found = F.filter(F.array(*[reject(c, F.col(c), _reason(c)) for c in checked]), lambda r: r["reason"].isNotNull())
    if LINE not in raw.columns:
        return found
    return F.when(F.col(LINE).isNull(), found).otherwise(F.array(reject("line", F.col(LINE), F.lit(NOT_A_ROW))))


def load(raw: DataFrame, root: str, max_share: float = 0.01) -> None:
    """Type `raw` leniently and publish rows and rejects together under `root`.

    More than `max_share` of the rows with a reject fail the load, and what was published before stays.
    """
    place = [F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in PLACE]
    typed = type_columns(raw, False, rejects(raw).alias("rejects"), *place)
    publish(root, {"typed": Part(typed, rules={"rows with rejected values": F.size("rejects") > 0}, tolerated=max_share)})


def typed_rows(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the last load, copies included, without malformed lines."""
    loaded = published(spark, root, "typed")
    return loaded.where(~F.exists("rejects", lambda r: r["reason"] == NOT_A_ROW)).select(RAW_COLUMNS)


def unique_rows(spark: SparkSession, root: str) -> DataFrame:
    return cleaning.unique_rows(typed_rows(spark, root), written)


def rejected(spark: SparkSession, root: str) -> DataFrame:
    """A row per rejected value of the last load: where it stands, what it is and why it was rejected."""
    keys = ["item_identifier", "outlet_identifier"]
    return published(spark, root, "typed").select(*PLACE, *keys, F.inline("rejects"))


def rejects_by_reason(spark: SparkSession, root: str) -> DataFrame:
    return rejected(spark, root).groupBy("column_name", "reason").agg(
        F.count(F.lit(1)).alias("rejected_values"), F.count_distinct("value").alias("distinct_values"))
