"""Sources, sinks and the cleaning steps, each as a report on the source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..catalog import report
from ..operators import cleaning as C, coerce
from ..operators.rules import ROWS, row_rules
from ..schema import FACT_COLUMNS, GRAIN, REPORT_COLUMNS
from ..sources import files
from ..sources.publish import names
from ..sources.store import written

ROW = [*GRAIN, "order_date"]  # columns that let a reader find a row again
MEASURED = [c for c in FACT_COLUMNS if c != "sale_id"]


@report("src_raw_csv")
def raw_from_csv(workspace) -> DataFrame:
    path = workspace.path("raw_csv")
    files.write_raw(workspace.raw(), path)
    return files.read_raw(workspace.spark, path)


@report("src_row_count")
def rows_loaded(raw_figures: DataFrame) -> DataFrame:
    return raw_figures.select(F.col(ROWS).alias("rows_loaded"))


@report("src_clean_csv")
def report_columns_from_csv(workspace) -> DataFrame:
    path = workspace.path("clean_csv_source")
    files.write_clean_csv(workspace.fact(), path)
    return files.read_clean_csv(workspace.spark, path, REPORT_COLUMNS)


@report("sink_fact")
def stored_fact(workspace) -> DataFrame:
    path = workspace.path("fact_sink")
    files.write_fact(workspace.fact(), path, row_rules())
    return files.read_fact(workspace.spark, path).select(MEASURED)


@report("sink_clean_csv")
def stored_clean_csv(workspace) -> DataFrame:
    path = workspace.path("clean_csv")
    files.write_clean_csv(workspace.fact(), path)
    return files.read_clean_csv(workspace.spark, path, MEASURED)


@report("cln_trim")
def trimmed(raw_once: DataFrame) -> DataFrame:
    return C.trim_text(raw_once)


@report("cln_map_category")
def mapped_category(raw_once: DataFrame) -> DataFrame:
    return raw_once.select(*ROW, F.col("item_fat_content").alias("raw_label"), C.canonical_fat_content("item_fat_content").alias("label"))


@report("cln_blank_null_cast")
def typed_numbers(raw_once: DataFrame) -> DataFrame:
    return raw_once.select(
        *ROW, C.number("item_weight", "decimal(6,3)").alias("item_weight"),
        C.number("item_visibility", "decimal(9,6)").alias("item_visibility"),
        C.number("sales", "decimal(10,4)").alias("sales"))


# Every so-manieth item has such a value in the extract that the lenient load is shown on.
SPOILED = {
    "sales": (97, 5, "n/a"), "order_date": (89, 3, "2021-13-40"), "item_weight": (83, 7, "12,5"), "rating": (79, 11, "99999.5"),
    "item_fat_content": (73, 2, "xx"),
}


def spoiled(raw: DataFrame) -> DataFrame:
    """The extract with values that can't be typed; a strict load refuses it."""
    item = F.col("item_identifier").cast("bigint")
    return raw.withColumns({c: F.when(item % every == rest, text).otherwise(F.col(c)) for c, (every, rest, text) in SPOILED.items()})


def _lenient(workspace) -> str:
    """Root of the lenient load of the spoiled extract; both reports read the same load."""
    root = workspace.path("coerced")
    if not names(workspace.spark, root):
        coerce.load(spoiled(workspace.raw()), root, max_share=0.1)
    return root


@report("cln_coerce_typed")
def leniently_typed(workspace) -> DataFrame:
    return coerce.typed_rows(workspace.spark, _lenient(workspace))


@report("cln_coerce_rejects")
def rejected_values(workspace) -> DataFrame:
    return coerce.rejects_by_reason(workspace.spark, _lenient(workspace))


@report("cln_zero_as_null")
def zeros_as_missing(raw_once: DataFrame) -> DataFrame:
    return raw_once.select(*ROW, C.zero_to_null(C.number("item_visibility", "decimal(9,6)")).alias("item_visibility"))


@report("cln_missing_band")
def unknown_sizes(raw_once: DataFrame) -> DataFrame:
    return raw_once.select(*ROW, C.blank_to_unknown("outlet_size").alias("outlet_size"))


@report("cln_round_clamp")
def bounded_ratings(raw_once: DataFrame) -> DataFrame:
    return raw_once.select(*ROW, F.col("rating").alias("raw_rating"), C.bounded_rating("rating").alias("rating"))


@report("cln_parse_date")
def parsed_dates(raw_once: DataFrame) -> DataFrame:
    return raw_once.select(*GRAIN, F.col("order_date").alias("raw_date"), C.parsed_date("order_date").alias("order_date"))


@report("cln_dedup_exact")
def unique_rows(raw_once: DataFrame) -> DataFrame:
    return C.unique_rows(C.type_columns(raw_once), written)


@report("cln_median_by_item")
def item_medians(weight_by_item: DataFrame) -> DataFrame:
    return weight_by_item


@report("cln_median_by_type")
def type_medians(medians_by_type: DataFrame) -> DataFrame:
    return medians_by_type.select("item_type", "type_median_weight")


@report("cln_median_visibility")
def visibility_medians(medians_by_type: DataFrame) -> DataFrame:
    return medians_by_type.select("item_type", "type_median_visibility")


@report("cln_impute")
def imputed(unique: DataFrame, weight_by_item: DataFrame, medians_by_type: DataFrame) -> DataFrame:
    return C.impute(unique, weight_by_item, medians_by_type).select(*ROW, "item_weight", "item_visibility")


@report("cln_impute_flags")
def imputation_flags(unique: DataFrame, weight_by_item: DataFrame, medians_by_type: DataFrame) -> DataFrame:
    return C.impute(unique, weight_by_item, medians_by_type).select(*ROW, "item_weight_imputed", "item_visibility_imputed")


@report("cln_age")
def store_ages(unique: DataFrame) -> DataFrame:
    return C.add_age(unique).select(*ROW, "outlet_establishment_year", "outlet_age_years")


@report("cln_date_parts")
def date_parts(unique: DataFrame) -> DataFrame:
    return C.add_date_parts(unique).select(
        *ROW, "order_year", "order_month", "order_month_name", "order_quarter", "order_year_month", "order_weekday",
        "is_weekend")


@report("cln_pipeline")
def whole_pipeline(raw: DataFrame) -> DataFrame:
    """The one-plan form; the workspace runs the same steps with stages in between."""
    return C.clean(raw).select(MEASURED)
