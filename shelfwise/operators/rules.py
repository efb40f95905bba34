"""What is counted about each table while it is written: gaps, defects and broken rules.

The stage that writes a table computes these figures over the rows as they pass, so no report scans
the table for them; a figure is one number whatever the table's size. Each is an aggregate of single
rows, which is what Spark can observe beside a write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import ALLOWED_VALUES, CHECKS, GRAIN, RAW_COLUMNS, REQUIRED_COLUMNS

ROWS = "total_rows"
DAY = "try_to_date(trim(order_date), 'yyyy-MM-dd')"


def is_blank(column: str) -> Column:
    return F.col(column).isNull() | (F.trim(column) == "")


def parsed(column: str, type_name: str) -> Column:
    """Number of a text column; text that is no number counts as missing here."""
    return F.expr(f"try_cast(nullif(trim({column}), '') AS {type_name})")


def range_defects() -> dict[str, Column]:
    visibility, sales = parsed("item_visibility", "decimal(9,6)"), parsed("sales", "decimal(10,4)")
    rating, weight = parsed("rating", "decimal(6,3)"), parsed("item_weight", "decimal(6,3)")
    return {
        "zero_visibility": visibility == 0,
        "visibility_out_of_range": ~visibility.between(0, 1),
        "non_positive_sales": sales <= 0,
        "rating_out_of_range": ~rating.between(1, 5),
        # A matter of the text: `3.50` has two decimals.
        "rating_over_precise": F.col("rating").contains(".") & (F.length(F.substring_index(F.trim("rating"), ".", -1)) > 1),
        "non_positive_weight": weight <= 0,
        "unparseable_dates": F.expr(DAY).isNull(),
    }


def enum_rules() -> dict[str, Column]:
    """What is wrong with a row, per rule: a label that isn't allowed."""
    return {c: ~F.coalesce(F.col(c).isin(v), F.lit(False)) for c, v in ALLOWED_VALUES.items()}


def check_rules() -> dict[str, Column]:
    return {name: ~F.expr(test) for name, test in CHECKS.items()}


def not_null_rules() -> dict[str, Column]:
    return {c: F.col(c).isNull() for c in REQUIRED_COLUMNS}


def assertion_rules() -> dict[str, Column]:
    """Statements a clean table must meet and what breaks them."""
    rules = check_rules()
    return {
        "weight present": F.col("item_weight").isNull(),
        "visibility above zero": ~F.coalesce(F.col("item_visibility") > 0, F.lit(False)),
        "sales positive": rules["sales_positive"],
        "rating within 1 to 5": rules["rating_range"],
        "fat content canonical": enum_rules()["item_fat_content"],
    }


def row_rules() -> dict[str, Column]:
    """All rules that a single row can break."""
    return {**enum_rules(), **check_rules(), **not_null_rules()}


def counted(kind: str, name: str) -> str:
    """Name of the figure of a rule."""
    return f"{kind}: {name}"


def _counts(kind: str, tests: dict[str, Column]) -> list[Column]:
    return [F.count_if(test).alias(counted(kind, name)) for name, test in tests.items()]


def raw_figures() -> list[Column]:
    """Figures of the text extract."""
    opened, day = parsed("outlet_establishment_year", "int"), F.expr(DAY)
    return [
        F.count(F.lit(1)).alias(ROWS),
        *_counts("filled", {c: ~is_blank(c) for c in RAW_COLUMNS}),
        *_counts("spaced", {c: F.col(c) != F.trim(c) for c in RAW_COLUMNS}),
        *_counts("defect", range_defects()),
        F.count_if(F.year(day) < opened).alias("orders_before_opening"),
        F.min(opened).alias("first_year"), F.max(opened).alias("last_year"), F.min(day).alias("first_date"), F.max(day).alias("last_date"),
        F.sum(parsed("sales", "decimal(18,4)")).alias("revenue"),
    ]


def fact_figures() -> list[Column]:
    """Figures of the clean table."""
    return [
        F.count(F.lit(1)).alias(ROWS),
        *_counts("label", enum_rules()), *_counts("check", check_rules()), *_counts("null", not_null_rules()),
        *_counts("assertion", assertion_rules()),
        F.count_if(F.col("item_visibility") == 0).alias("zero_visibility"),
        F.sum("item_weight_imputed").alias("weights_imputed"), F.sum("item_visibility_imputed").alias("visibility_imputed"),
        F.sum(F.col("sales").cast("decimal(18,4)")).alias("revenue"),
    ]


def copied_rows(raw: DataFrame, store) -> DataFrame:
    """Rows that the extract has more than once, with their number `n`.

    All rows are counted by a hash; only rows whose hash repeats are compared in full. `store` keeps the hashes.
    """
    hashed = [F.xxhash64(*RAW_COLUMNS).alias("_h"), F.hash(*reversed(RAW_COLUMNS)).alias("_g")]
    repeated = store(raw.select(*hashed).groupBy("_h", "_g").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "repeated")
    again = raw.select(*RAW_COLUMNS, *hashed).join(repeated, ["_h", "_g"], "left_semi")
    return again.groupBy(*RAW_COLUMNS).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


# The extract's label columns: enumerated text, and the outlet.
LABELS = [
    "outlet_identifier", "outlet_establishment_year", "outlet_size", "outlet_location_type", "outlet_type", "item_type", "item_fat_content"]


def label_rows(raw: DataFrame) -> DataFrame:
    """Rows `n` per combination of labels as they are written in the extract."""
    return raw.groupBy(*LABELS).agg(F.count(F.lit(1)).alias("n"))


def grain_sizes(raw: DataFrame) -> DataFrame:
    """(n, groups): how many item-outlet pairs have n rows."""
    return raw.groupBy(*GRAIN).agg(F.count(F.lit(1)).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("groups"))
