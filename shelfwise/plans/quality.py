"""Integrity rules and reconciliation of the clean table against the raw extract."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..catalog import report
from ..functions import measures as M
from ..functions.exact import percent
from ..operators.rules import (
    ROWS, assertion_rules, check_rules, counted, enum_rules, fact_figures, grain_sizes, not_null_rules, row_rules)
from ..operators.segments import one_row
from ..schema import GRAIN
from ..sources.publish import Part, publish, published


def figures(table: DataFrame, kind: str, names: Iterable[str], label: str, alias: str) -> DataFrame:
    """The stored figures of some rules in long form."""
    pairs = F.array(*[F.struct(F.lit(n).alias(label), F.col(f"`{counted(kind, n)}`").alias(alias)) for n in names])
    return table.select(F.inline(pairs))


@report("val_enum")
def enum_violations(fact_figures: DataFrame) -> DataFrame:
    return figures(fact_figures, "label", enum_rules(), "column_name", "bad_rows")


@report("val_checks")
def check_violations(fact_figures: DataFrame) -> DataFrame:
    return figures(fact_figures, "check", check_rules(), "rule", "bad_rows")


@report("val_not_null")
def null_violations(fact_figures: DataFrame) -> DataFrame:
    return figures(fact_figures, "null", not_null_rules(), "column_name", "null_rows")


def broken(rules: dict[str, Column] | None = None) -> Column:
    """Whether a row breaks a rule."""
    return reduce(lambda a, b: a | b, [F.coalesce(r, F.lit(False)) for r in (rules or row_rules()).values()])


def split_by_rules(fact: DataFrame, rules: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined): rows that meet all row rules, and the others."""
    return fact.where(~broken(rules)), fact.where(broken(rules))


@report("val_quarantine")
def quarantined(workspace) -> DataFrame:
    """Store the rows that meet all row rules and the others apart, in one pass, and count what was stored.

    The rules hold for the fact as cleaned; a price cap that a user adds is stood in for by
    sales above 50,000, so that both sides have rows.
    """
    strict = {**enum_rules(), **check_rules(), **not_null_rules(), "price_cap": F.col("sales") > 50_000}
    path = workspace.path("quality_parts")
    marked = workspace.fact().withColumn("part", F.when(broken(strict), "quarantined").otherwise("accepted"))
    publish(path, {"rows": Part(marked, ["part"])})
    return published(workspace.spark, path, "rows").groupBy("part").agg(M.records("rows"), M.revenue())


@report("val_unique")
def grain_repeats(pair_sizes: DataFrame) -> DataFrame:
    """Item-outlet pairs with several rows, from the number of pairs per size."""
    repeated = pair_sizes.where(F.col("n") > 1)
    return repeated.agg(
        F.coalesce(F.sum("groups"), F.lit(0)).alias("repeated_groups"),
        F.coalesce(F.sum((F.col("n") - 1) * F.col("groups")), F.lit(0)).alias("surplus_rows"))


@report("surrogate_key")
def surrogate_key(fact: DataFrame) -> DataFrame:
    return fact.agg(
        M.records("records"), F.count_distinct("sale_id").alias("distinct_ids"),
        F.count_if(F.col("sale_id").isNull()).alias("missing_ids"))


@report("surrogate_key_rows")
def keys_of_rows(fact: DataFrame) -> DataFrame:
    return fact.select(*GRAIN, "order_date", "sales", "sale_id")


@report("val_row_recon")
def row_reconciliation(raw_figures: DataFrame, fact_figures: DataFrame) -> DataFrame:
    kept = one_row(fact_figures.select(ROWS))[ROWS]
    return raw_figures.select(F.col(ROWS).alias("raw_rows"), kept.alias("clean_rows"), (F.col(ROWS) - kept).alias("rows_removed"))


@report("val_revenue_recon")
def revenue_reconciliation(raw_figures: DataFrame, fact_figures: DataFrame) -> DataFrame:
    kept, loaded = one_row(fact_figures.select("revenue"))["revenue"], F.col("revenue")
    return raw_figures.select(
        F.round(loaded, 2).alias("raw_revenue"), F.round(kept, 2).alias("clean_revenue"),
        F.round(loaded - kept, 2).alias("revenue_removed"))


@report("val_defects_zero")
def remaining_defects(fact_figures: DataFrame, pair_sizes: DataFrame, cells: DataFrame) -> DataFrame:
    def of(kind: str, name: str, alias: str) -> Column:
        return F.col(f"`{counted(kind, name)}`").alias(alias)

    labels = one_row(cells.agg(
        F.count_distinct("item_fat_content").alias("fat"), F.count_distinct("outlet_size").alias("size")))
    return fact_figures.select(
        of("assertion", "weight present", "null_weights"), "zero_visibility", of("check", "visibility_range", "bad_visibility"),
        of("check", "sales_positive", "bad_sales"), of("check", "rating_range", "bad_rating"),
    ).withColumns({
        "fat_categories": labels["fat"], "size_categories": labels["size"],
        "grain_violations": one_row(grain_repeats(pair_sizes))["surplus_rows"]})


@report("val_imputation_share")
def imputation_share(fact_figures: DataFrame) -> DataFrame:
    rows = F.col(ROWS)
    return fact_figures.select(
        ROWS, "weights_imputed", percent(F.col("weights_imputed"), rows).alias("pct_weight_imputed"),
        "visibility_imputed", percent(F.col("visibility_imputed"), rows).alias("pct_visibility_imputed"))


@report("val_category_collapse")
def category_collapse(fact: DataFrame) -> DataFrame:
    return fact.groupBy("item_fat_content").agg(M.records("rows"), M.revenue()).orderBy("item_fat_content")


@report("val_assertions")
def assertions(fact_figures: DataFrame, pair_sizes: DataFrame) -> DataFrame:
    rules = figures(fact_figures, "assertion", assertion_rules(), "assertion", "failures")
    grain = grain_repeats(pair_sizes).select(F.lit("one row per item and outlet").alias("assertion"), F.col("surplus_rows").alias("failures"))
    return rules.unionByName(grain).withColumn("passed", (F.col("failures") == 0).cast("string"))


def assert_clean(fact: DataFrame, grain: bool = True) -> None:
    """Raise if a statement fails. The handful of counted rules is all that reaches the driver."""
    failed = assertions(fact.agg(*fact_figures()), grain_sizes(fact)).where(F.col("failures") > 0).collect()
    failed = [r for r in failed if grain or not r["assertion"].startswith("one row")]
    if failed:
        raise AssertionError("; ".join(f"{r['assertion']}: {r['failures']} rows" for r in failed))
