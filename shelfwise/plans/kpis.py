"""Baseline figures: headline row, dimension inventory, distributions, time baseline."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..catalog import report, table
from ..functions import bands, measures as M, rolled as R
from ..functions.exact import percent, quotient, total
from ..operators.order_stats import quantiles_by_rank
from ..operators.segments import one_row, share_of_all, summarise
from ..schema import OUTLET_ATTRIBUTES, UNKNOWN
from ..sources.tables import MOST_STORES

def totals(products: DataFrame, outlets: DataFrame) -> DataFrame:
    """One row: sums of all measures and the distinct counts of both dimensions, from the two roll-ups."""
    summed = ["records", "sales", "rating", "item_visibility", "item_weight", "weighed", "item_weight_imputed",
              "item_visibility_imputed"]
    stores = one_row(outlets.agg(
        R.stores("outlets"), R.distinct("outlet_type", "types"), R.distinct("outlet_location_type", "tiers"),
        R.distinct("outlet_size", "sizes")))
    whole = products.agg(
        *[F.sum(c).alias(c) for c in summed], F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"),
        R.products(), R.distinct("item_type", "categories")).withColumn("_stores", stores)
    return whole.select("*", "_stores.*").drop("_stores")


@report("eda_kpis")
def headline_kpis(products: DataFrame, outlets: DataFrame) -> DataFrame:
    per_row = {"avg_sales_per_record": ("sales", 2), "avg_rating": ("rating", 2), "avg_item_visibility": ("item_visibility", 4)}
    return totals(products, outlets).select(
        F.round("sales", 2).alias("total_revenue_inr"),
        F.col("records").alias("total_sales_records"),
        F.col("products").alias("distinct_products"),
        F.col("categories").alias("product_categories"),
        "outlets",
        F.col("types").alias("outlet_types"),
        F.col("tiers").alias("location_tiers"),
        F.col("sizes").alias("outlet_size_bands"),
        *[F.round(quotient(F.col(c), F.col("records")), d).alias(name) for name, (c, d) in per_row.items()],
        F.round(quotient(F.col("item_weight"), F.col("weighed")), 2).alias("avg_item_weight_kg"),
        F.col("first_day").alias("first_order_date"),
        F.col("last_day").alias("last_order_date"),
        F.round(quotient(F.col("sales"), F.col("outlets")), 2).alias("revenue_per_outlet"),
    )


@report("eda_quantiles")
def sales_quantiles(fact: DataFrame, cells: DataFrame) -> DataFrame:
    found = quantiles_by_rank(fact, "sales", {"median": 50, "p25": 25, "p75": 75, "p90": 90})
    average = one_row(cells.agg(R.mean("sales").alias("m")))["m"]
    return found.select(
        F.round(average, 2).alias("mean_sales"),
        F.round("median", 2).alias("median_sales"),
        F.round(average - F.col("median"), 2).alias("mean_minus_median"),
        *[F.round(c, 2).alias(c) for c in ("p25", "p75", "p90")],
    )


@report("eda_category")
def category_inventory(products: DataFrame) -> DataFrame:
    by_category = summarise(
        products, {"category": "item_type"}, R.records(), R.products(), R.total("sales").alias("_sales"), R.avg_sale(),
        R.avg_rating())
    return by_category.select(
        "category", "records", "products", F.round("_sales", 2).alias("revenue"),
        share_of_all("_sales").alias("pct_of_revenue"), "avg_sale", "avg_rating",
    ).orderBy(F.desc("revenue"), "category")


OUTLET_KEYS = {
    "outlet": "outlet_identifier", "outlet_type": "outlet_type", "outlet_size": "outlet_size",
    "tier": "outlet_location_type", "opened": "outlet_establishment_year", "age_years": "outlet_age_years",
}


@report("eda_outlet_master")
def outlet_master(shelves: DataFrame) -> DataFrame:
    by_outlet = summarise(
        shelves, OUTLET_KEYS, R.records(), R.distinct("item_type", "categories_stocked"), R.total("sales").alias("_sales"),
        R.avg_sale(), R.avg_rating())
    all_sales = one_row(shelves.agg(R.total("sales").alias("s")))["s"]
    return by_outlet.select(
        *OUTLET_KEYS, "records", "categories_stocked", F.round("_sales", 2).alias("revenue"),
        percent(F.col("_sales"), all_sales).alias("pct_of_revenue"), "avg_sale", "avg_rating",
    ).orderBy(F.desc("revenue"), "outlet")


def products_per(fact: DataFrame, shelves: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct products per combination of store labels.

    A number stands for the labels while the items are dealt out, as long as a broadcast may hold the stores.
    """
    labels = shelves.select(keys).distinct()
    if labels.count() > MOST_STORES:
        return summarise(fact, keys, M.products("products_stocked"))
    numbered = F.broadcast(labels.withColumn("store", F.row_number().over(Window.orderBy(*keys))))
    same = reduce(lambda a, b: a & b, [F.col(f"sold.{c}").eqNullSafe(F.col(f"stores.{c}")) for c in keys])
    sold = fact.alias("sold").join(numbered.alias("stores"), same).select("item_identifier", "store")
    return summarise(sold, ["store"], M.products("products_stocked")).join(numbered, "store").drop("store")


@table("outlet_products")
def outlet_products(fact: DataFrame, shelves: DataFrame) -> DataFrame:
    return products_per(fact, shelves, OUTLET_ATTRIBUTES)


@table("format_products")
def format_products(fact: DataFrame, shelves: DataFrame) -> DataFrame:
    return products_per(fact, shelves, ["outlet_identifier", "outlet_type"])


def with_products(summary: DataFrame, counted: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Add the distinct products of each group."""
    return summary.join(counted.select(*[F.col(c).alias(name) for name, c in keys.items()], "products_stocked"), list(keys))


def _segment(rollup: DataFrame, keys: dict[str, str], *measures) -> DataFrame:
    """Revenue and its share per segment, plus the given measures, best segment first."""
    summary = summarise(rollup, keys, R.total("sales").alias("_sales"), *measures)
    names = [c for c in summary.columns if c not in keys and c != "_sales"]
    return summary.select(
        *keys, F.round("_sales", 2).alias("revenue"), share_of_all("_sales").alias("pct_of_revenue"), *names,
    ).orderBy(F.desc("revenue"), *keys)


@report("eda_format")
def format_performance(outlets: DataFrame) -> DataFrame:
    return _segment(
        outlets, {"outlet_type": "outlet_type"}, R.stores(), R.records(), R.avg_sale(), R.revenue_per_store(),
        R.avg_rating())


@report("eda_tier")
def tier_performance(outlets: DataFrame) -> DataFrame:
    return _segment(
        outlets, {"tier": "outlet_location_type"}, R.stores(), R.records(), R.avg_sale(), R.revenue_per_store())


@report("eda_size")
def size_performance(outlets: DataFrame) -> DataFrame:
    return _segment(outlets, {"outlet_size": "outlet_size"}, R.stores(), R.avg_sale(), R.revenue_per_store())


@report("eda_fat")
def fat_content_split(cells: DataFrame) -> DataFrame:
    return _segment(cells, {"item_fat_content": "item_fat_content"}, R.records(), R.avg_sale(), R.avg_rating())


def sales_band():
    return bands.band(F.col("sales"), bands.SALES_LIMITS, bands.SALES_LABELS)


def rating_band():
    return bands.band(F.col("stars"), bands.RATING_LIMITS, bands.RATING_LABELS)


@report("eda_sales_bands")
def sales_bands(fact: DataFrame) -> DataFrame:
    summary = fact.groupBy(sales_band().alias("sales_band")).agg(M.records(), total("sales").alias("_sales"))
    return summary.select(
        "sales_band", "records", share_of_all("records").alias("pct_of_records"),
        F.round("_sales", 2).alias("revenue"), share_of_all("_sales").alias("pct_of_revenue"),
    ).orderBy("sales_band")


@report("eda_rating_bands")
def rating_bands(ratings: DataFrame) -> DataFrame:
    summary = ratings.groupBy(rating_band().alias("rating_band")).agg(R.records(), R.revenue(), R.avg_sale())
    return summary.select(
        "rating_band", "records", share_of_all("records").alias("pct_of_records"), "revenue", "avg_sale",
    ).orderBy("rating_band")


@report("eda_visibility_deciles")
def visibility_deciles(decile_tiles: DataFrame) -> DataFrame:
    return decile_tiles.select(
        F.col("tile").alias("visibility_decile"), "records",
        F.round("min_item_visibility", 4).alias("min_visibility"),
        F.round("max_item_visibility", 4).alias("max_visibility"),
        F.round(quotient(F.col("sum_sales"), F.col("records")), 2).alias("avg_sale"),
        F.round("sum_sales", 2).alias("revenue"),
    ).orderBy("visibility_decile")


@report("eda_dq_footprint")
def quality_footprint(cells: DataFrame) -> DataFrame:
    counted = cells.agg(
        R.records("total_rows"), F.sum("item_weight_imputed").alias("imputed_weights"),
        F.sum("item_visibility_imputed").alias("imputed_visibility"),
        F.coalesce(F.sum(F.when(F.col("outlet_size") == UNKNOWN, F.col("records"))), F.lit(0)).alias("rows_unknown_size"))
    return counted.select(
        "total_rows", "imputed_weights", percent(F.col("imputed_weights"), F.col("total_rows")).alias("pct_imputed_weight"),
        "imputed_visibility", percent(F.col("imputed_visibility"), F.col("total_rows")).alias("pct_imputed_visibility"),
        "rows_unknown_size", percent(F.col("rows_unknown_size"), F.col("total_rows")).alias("pct_unknown_size"),
    )


@report("eda_monthly")
def monthly_revenue(cells: DataFrame) -> DataFrame:
    keys = {"year_month": "order_year_month"}
    return summarise(cells, keys, R.records(), R.revenue(), R.avg_sale(), R.avg_rating()).orderBy("year_month")


@report("eda_yearly")
def yearly_summary(cells: DataFrame) -> DataFrame:
    return summarise(cells, {"year": "order_year"}, R.records(), R.revenue(), R.avg_sale(), R.avg_rating()).orderBy("year")


def day_type():
    return F.when(F.col("is_weekend") == 1, "Weekend").otherwise("Weekday").alias("day_type")


@report("eda_weekend")
def weekend_split(cells: DataFrame) -> DataFrame:
    return cells.groupBy(day_type()).agg(R.records(), R.revenue(), R.avg_sale()).orderBy(F.desc("revenue"))
