"""Data-quality profile of the raw extract; nothing is changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..catalog import report
from ..functions.exact import percent, quotient
from ..operators.cleaning import canonical_fat_content
from ..operators.order_stats import quantiles_by_rank, quantiles_interpolated
from ..operators.rules import ROWS, counted, parsed, range_defects
from ..operators.segments import one_row
from ..schema import COLUMN_ROLES, RAW_COLUMNS


def amounts(raw: DataFrame) -> DataFrame:
    return raw.select(parsed("sales", "decimal(10,4)").alias("sales"))


def per_column(raw_figures: DataFrame, kind: str, alias: str) -> DataFrame:
    """A figure of every column in long form: total_rows, column_name, <alias>."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{counted(kind, c)}`").alias(alias)) for c in RAW_COLUMNS])
    return raw_figures.select(ROWS, F.inline(pairs))


@report("prof_schema")
def column_roles(raw_figures: DataFrame) -> DataFrame:
    filled = per_column(raw_figures, "filled", "filled_rows")
    known = {c: (i, *roles) for i, (c, roles) in enumerate(COLUMN_ROLES.items(), 1)}

    def of(position: int) -> Column:
        return F.create_map(*[F.lit(v) for c, r in known.items() for v in (c, r[position])])[F.col("column_name")]

    return filled.select(
        of(0).alias("position"), "column_name", of(1).alias("stored_as"), of(2).alias("should_be"), of(3).alias("role"),
        "filled_rows").orderBy("position")


# What a gap means, for the columns where gaps are known.
GAP_NOTES = {
    "item_weight": "Not captured when the product was listed.",
    "outlet_size": "Never reported by some outlets.",
}


@report("prof_missing")
def missing_values(raw_figures: DataFrame) -> DataFrame:
    note = F.create_map(*[F.lit(x) for pair in GAP_NOTES.items() for x in pair])[F.col("column_name")]
    gaps = per_column(raw_figures, "filled", "filled").withColumn("missing", F.col(ROWS) - F.col("filled"))
    return gaps.where(F.col("missing") > 0).select(
        "column_name", "missing", percent(F.col("missing"), F.col("total_rows")).alias("pct_of_rows"),
        F.coalesce(note, F.lit("Unexpected - investigate.")).alias("interpretation"))


@report("prof_missing_by_key")
def keys_without_value(labels: DataFrame, key: str = "outlet_identifier", attribute: str = "outlet_size") -> DataFrame:
    known = F.count(F.nullif(F.trim(attribute), F.lit("")))
    per_key = labels.groupBy(key).agg(known.alias("_known"), F.sum("n").alias("row_count"))
    return per_key.where(F.col("_known") == 0).drop("_known").orderBy(key)


@report("prof_duplicates")
def duplicates(raw_figures: DataFrame, copies: DataFrame, grain_sizes: DataFrame) -> DataFrame:
    """Copies of whole rows and repeats of the (item, outlet) grain."""
    total = one_row(raw_figures.select(ROWS))[ROWS]
    grain = one_row(grain_sizes.agg(F.sum((F.col("n") - 1) * F.col("groups")).alias("n")))["n"]
    return copies.agg(
        F.count(F.lit(1)).alias("dup_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in_groups"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("redundant_copies"),
    ).withColumns({"total_rows": total, "grain_duplicates": grain})


@report("prof_grain")
def grain_violations(grain_sizes: DataFrame) -> DataFrame:
    return grain_sizes.where("n > 1").agg(F.coalesce(F.sum("groups"), F.lit(0)).alias("grain_violations"))


UNMAPPED = "UNMAPPED - INVESTIGATE"


@report("prof_category_values")
def category_values(labels: DataFrame) -> DataFrame:
    spellings = labels.groupBy("item_fat_content").agg(F.sum("n").alias("row_count"))
    quoted = F.concat(F.lit('"'), F.col("item_fat_content"), F.lit('"'))
    return spellings.select(
        quoted.alias("raw_value_quoted"), "row_count",
        canonical_fat_content("item_fat_content", F.lit(UNMAPPED)).alias("maps_to"),
    ).orderBy(F.desc("row_count"), "raw_value_quoted")


LISTED_COLUMNS = ["item_type", "outlet_size", "outlet_location_type", "outlet_type", "outlet_identifier"]


@report("prof_domain_lists")
def domains(labels: DataFrame) -> DataFrame:
    """Distinct values per dimension, one row each, so that a long list never sits in one cell."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in LISTED_COLUMNS])
    listed = labels.select("n", F.inline(pairs)).where(F.trim("value") != "")
    return listed.groupBy("column_name", "value").agg(F.sum("n").alias("row_count")).orderBy("column_name", "value")


@report("prof_whitespace")
def outer_spaces(raw_figures: DataFrame) -> DataFrame:
    return per_column(raw_figures, "spaced", "row_count").where(F.col("row_count") > 0).select("column_name", "row_count")


@report("prof_ranges")
def impossible_values(raw_figures: DataFrame) -> DataFrame:
    found = raw_figures.select(ROWS, *[F.col(f"`{counted('defect', name)}`").alias(name) for name in range_defects()])
    return found.withColumn("pct_zero_visibility", percent(F.col("zero_visibility"), F.col(ROWS)))


@report("prof_cross_field")
def sold_before_opening(raw_figures: DataFrame) -> DataFrame:
    return raw_figures.select("orders_before_opening")


@report("prof_min_max")
def covered_span(raw_figures: DataFrame) -> DataFrame:
    return raw_figures.select("first_year", "last_year", "first_date", "last_date")


OUTLET_FACTS = {
    "distinct_sizes": "outlet_size", "distinct_tiers": "outlet_location_type", "distinct_types": "outlet_type",
    "distinct_years": "outlet_establishment_year",
}


def distinct_per_outlet(labels: DataFrame) -> DataFrame:
    """Distinct attribute values per outlet; a blank counts as a value."""
    combos = labels.select("outlet_identifier", *[F.coalesce(c, F.lit("")).alias(c) for c in OUTLET_FACTS.values()]).distinct()
    return combos.groupBy("outlet_identifier").agg(*[F.count_distinct(c).alias(n) for n, c in OUTLET_FACTS.items()])


def conflicting_outlets(labels: DataFrame) -> DataFrame:
    return distinct_per_outlet(labels).where(F.greatest(*OUTLET_FACTS) > 1)


@report("prof_ref_outlet")
def outlet_consistency(labels: DataFrame) -> DataFrame:
    return distinct_per_outlet(labels).agg(
        F.count(F.lit(1)).alias("outlets"), F.count_if(F.greatest(*OUTLET_FACTS) > 1).alias("conflicting_outlets"))


@report("prof_ref_outlet_list")
def outlet_conflicts(labels: DataFrame) -> DataFrame:
    """The four counts of every outlet, those that conflict marked."""
    return distinct_per_outlet(labels).withColumn("conflicting", (F.greatest(*OUTLET_FACTS) > 1).cast("string"))


@report("prof_ref_item")
def item_consistency(raw: DataFrame) -> DataFrame:
    weight = F.nullif(F.trim("item_weight"), F.lit(""))
    combos = raw.select("item_identifier", weight.alias("w"), "item_type").distinct()
    per_item = combos.groupBy("item_identifier").agg(F.count_distinct("w").alias("w"), F.count_distinct("item_type").alias("t"))
    return per_item.agg(
        F.count(F.lit(1)).alias("items"), F.count_if(F.col("w") > 1).alias("items_with_several_weights"),
        F.count_if(F.col("t") > 1).alias("items_in_several_categories"))


@report("prof_iqr_sql")
def outliers_by_rank(raw: DataFrame) -> DataFrame:
    """Quartiles that are actual values; rows above the upper fence only."""
    sales = amounts(raw)
    q = quantiles_by_rank(sales, "sales", {"q1": 25, "median_s": 50, "q3": 75}).drop("n")
    spread = F.col("q3") - F.col("q1")
    fenced = q.withColumn("_fence", F.col("q3") + spread * F.lit("1.5").cast("decimal(2,1)"))
    above = one_row(sales.agg(F.count_if(F.col("sales") > one_row(fenced)["_fence"]).alias("n")))["n"]
    return fenced.select(
        "q1", "median_s", "q3", F.round(spread, 2).alias("iqr"), F.round("_fence", 2).alias("upper_fence"),
        above.alias("rows_above_fence"))


@report("prof_iqr_interp")
def outliers_interpolated(raw: DataFrame) -> DataFrame:
    """Interpolated quartiles; rows beyond either fence."""
    sales = amounts(raw)
    q = quantiles_interpolated(sales, "sales", {"q1": 25, "median": 50, "q3": 75})
    reach = (F.col("q3") - F.col("q1")) * F.lit("1.5").cast("decimal(2,1)")
    fences = q.select("q1", "median", "q3", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))
    edge = one_row(fences)
    value = F.col("sales")
    counted = sales.agg(
        F.min(value).alias("min_sales"), F.max(value).alias("max_sales"),
        F.sum(value.cast("decimal(18,4)")).alias("_sum"), F.count(value).alias("_n"), F.stddev_samp(value).alias("_std"),
        F.count_if(value > edge["high"]).alias("rows_above"), F.count_if(value < edge["low"]).alias("rows_below"),
        F.count(F.lit(1)).alias("_rows"))
    outside = F.col("rows_above") + F.col("rows_below")
    return counted.withColumn("_f", edge).select(
        F.round("min_sales", 2).alias("min_sales"), F.round("_f.q1", 2).alias("q1"), F.round("_f.median", 2).alias("median"),
        F.round(quotient(F.col("_sum"), F.col("_n")), 2).alias("mean"), F.round("_f.q3", 2).alias("q3"),
        F.round("max_sales", 2).alias("max_sales"), F.round("_std", 2).alias("std_dev"),
        F.round("_f.low", 2).alias("lower_fence"), F.round("_f.high", 2).alias("upper_fence"), "rows_above", "rows_below",
        outside.alias("rows_outside"), percent(outside, F.col("_rows")).alias("pct_outside"))


# Issue (with the measured count in front where there is one), decision and reason.
DECISIONS = [
    ("spellings", "spellings of fat content", "Map to Low Fat / Regular; trim all text",
     "Groups would split across spellings."),
    ("missing_weight", "missing item weights", "Fill with the item's median, else the category's",
     "Keeps the rows and their revenue; weight belongs to the product."),
    (None, "Missing outlet size", "Label Unknown", "Whole outlets lack it, so there is nothing to fill from."),
    ("zero_visibility", "zero visibilities", "Treat as missing, fill with the category's median, keep a flag",
     "A product that sells takes shelf space."),
    ("copies", "duplicate rows", "Keep one of each", "Each copy counts revenue again."),
    (None, "Ratings with too many decimals", "Round to one decimal", "Ratings are given on that scale."),
    (None, "Right-skewed sales", "Keep, flag and report the median as well", "Large sales are real."),
    (None, "Numbers and dates as text", "Declare types", "Sums and date ranges need them."),
]


@report("prof_decisions")
def decisions(raw_figures: DataFrame, copies: DataFrame, labels: DataFrame) -> DataFrame:
    more = one_row(copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n")))["n"]
    spellings = one_row(labels.agg(F.count_distinct("item_fat_content").alias("n")))["n"]
    gaps = F.col(ROWS) - F.col(f"`{counted('filled', 'item_weight')}`")
    measured = raw_figures.select(
        spellings.alias("spellings"), gaps.alias("missing_weight"), F.col(f"`{counted('defect', 'zero_visibility')}`").alias("zero_visibility"),
        more.alias("copies"))
    lines = F.array(*[
        F.struct(
            F.lit(i).alias("position"),
            (F.concat_ws(" ", F.col(count).cast("string"), F.lit(issue)) if count else F.lit(issue)).alias("issue"),
            F.lit(decision).alias("decision"), F.lit(reason).alias("rationale"))
        for i, (count, issue, decision, reason) in enumerate(DECISIONS, 1)])
    return measured.select(F.inline(lines))
