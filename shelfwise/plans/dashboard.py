"""The tables behind the dashboard: pivots, top lists, cards and the shared filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..catalog import report
from ..functions import bands, rolled as R
from ..functions.exact import quotient
from ..operators.rollups import FILTER_FIELDS, count_items
from ..operators.segments import apply_filters, one_row, summarise
from .kpis import totals


def dashboard_rating_band(column: str = "rating") -> Column:
    return bands.band(F.col(column), bands.RATING_LIMITS_5, bands.RATING_LABELS_5_COMPACT)


@report("d_rating_band")
def rating_bands(fact: DataFrame) -> DataFrame:
    return fact.select("item_identifier", "outlet_identifier", "order_date", "rating", dashboard_rating_band().alias("rating_band"))


# Row field of each pivot that adds up sales; the rating pivot counts records.
PIVOT_FIELDS = {
    "monthly": "order_year_month", "category": "item_type", "outlet_type": "outlet_type", "tier": "outlet_location_type",
    "size": "outlet_size", "fat": "item_fat_content",
}


def top_bottom(rollup: DataFrame, field: str, n: int) -> DataFrame:
    """First and last n values of a field by revenue: list, label, value."""
    summed = summarise(rollup, {"label": field}, R.total("sales").cast("decimal(28,4)").alias("value"))
    best = summed.orderBy(F.desc("value"), "label").limit(n).withColumn("list", F.lit("top"))
    worst = summed.orderBy("value", "label").limit(n).withColumn("list", F.lit("bottom"))
    return best.unionByName(worst).select("list", "label", "value")


@report("d_top_bottom_n")
def top_bottom_products(products: DataFrame, n: int = 10) -> DataFrame:
    return top_bottom(products, "item_identifier", n)


@report("d_pivots")
def pivots(cells: DataFrame, ratings: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """Nine pivots in long form: pivot, label, value."""
    labels = F.array(*[F.struct(F.lit(name).alias("pivot"), F.col(c).alias("label")) for name, c in PIVOT_FIELDS.items()])
    sums = cells.select("sales", F.inline(labels)).groupBy("pivot", "label").agg(
        F.sum("sales").cast("decimal(28,4)").alias("value"))
    counts = ratings.groupBy(dashboard_rating_band("stars").alias("label")).agg(F.sum("records").cast("decimal(28,4)").alias("value"))
    lists = top_bottom(products, "item_identifier", n)
    return sums.unionByName(counts.select(F.lit("rating").alias("pivot"), "label", "value")).unionByName(
        lists.select(F.concat("list", F.lit("_prod")).alias("pivot"), "label", "value"))


@report("d_kpi_pivot")
def kpi_pivot(cells: DataFrame) -> DataFrame:
    rows = F.coalesce(F.sum("records"), F.lit(0)).alias("count_sales")
    return cells.agg(R.revenue("sum_sales"), R.avg_sale("avg_sales"), R.avg_rating(), rows)


# Label and hint of each card.
CARDS = {
    "TOTAL REVENUE": "INR, all outlets", "AVG SALE VALUE": "Basket value", "AVG RATING": "Customer satisfaction",
    "SALES RECORDS": "Product x outlet rows", "PRODUCTS": "Distinct SKUs", "CATEGORIES": "Item types",
}


def cards(sums: DataFrame) -> DataFrame:
    """Cards from one row of records, sales, rating, products and categories."""
    rows = F.col("records")

    def text(value: Column, digits: int) -> Column:
        return F.format_number(F.round(value, digits), digits)

    values = [
        F.concat(F.regexp_replace(text(quotient(F.col("sales"), F.lit(1_000_000)), 2), ",", ""), F.lit("M")),
        text(quotient(F.col("sales"), rows), 0),
        F.concat(text(quotient(F.col("rating"), rows), 2), F.lit(" / 5")),
        text(rows, 0),
        text(F.col("products"), 0),
        F.col("categories").cast("string"),
    ]
    made = F.array(*[
        F.struct(F.lit(label).alias("card"), value.alias("value"), F.lit(hint).alias("hint"))
        for (label, hint), value in zip(CARDS.items(), values)])
    return sums.select(F.inline(made))


@report("d_kpi_cards")
def kpi_cards(products: DataFrame, outlets: DataFrame) -> DataFrame:
    return cards(totals(products, outlets))


# A choice on four of the six fields; the others keep everything.
EXAMPLE_CHOICE = {
    "item_type": ["LARGE", "PROMO"], "outlet_size": ["Small", "Unknown"], "order_year": [1999, 2000],
    "item_fat_content": ["Low Fat"],
}
# One field alone, and labels that no row has together.
SINGLE_CHOICE = {"outlet_location_type": ["Tier 2"]}
EMPTY_CHOICE = {"order_year": [1899], "outlet_type": ["Grocery Store"]}


def filtered_dashboard(cells: DataFrame, stars: DataFrame, assortment: DataFrame, bitmaps: DataFrame, choice: dict[str, list]) -> dict[str, DataFrame]:
    """Every tile under one filter state, from stored sums, ratings and bitmaps; unknown fields are refused.

    The fact isn't read, whatever the choice: `cells`, `stars` and `bitmaps` have no more rows than there are
    combinations of labels (times buckets of items), and only the product lists read sums per product.
    """
    unknown = set(choice) - set(FILTER_FIELDS)
    if unknown:
        raise ValueError(f"no filter for {sorted(unknown)}")
    cells, stars, assortment, bitmaps = (apply_filters(df, choice) for df in (cells, stars, assortment, bitmaps))
    sums = cells.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"), R.total("sales").alias("sales"), R.total("rating").alias("rating"),
        R.distinct("item_type", "categories")).withColumn("products", one_row(count_items(bitmaps))["products"])
    return {"pivots": pivots(cells, stars, assortment), "kpis": kpi_pivot(cells), "cards": cards(sums)}


def _register(suffix: str, choice: dict[str, list]) -> None:
    for key, tile in {"d_cross_filter": "pivots", "d_cross_filter_kpis": "kpis", "d_cross_filter_cards": "cards"}.items():
        def tile_of(cells: DataFrame, stars: DataFrame, assortment: DataFrame, bitmaps: DataFrame, tile: str = tile) -> DataFrame:
            return filtered_dashboard(cells, stars, assortment, bitmaps, choice)[tile]

        report(key + suffix)(tile_of)


for _suffix, _choice in {"": EXAMPLE_CHOICE, "_single": SINGLE_CHOICE, "_empty": EMPTY_CHOICE}.items():
    _register(_suffix, _choice)
