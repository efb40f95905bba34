"""Forty business questions on the fact table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..catalog import report
from ..functions import bands, rolled as R
from ..functions.exact import growth, growth_of_means, mean_from, percent, quotient
from ..operators.calendar import month_spine
from ..operators.ranking import running_before, with_rank
from ..operators.segments import join_lookup, mean_of, one_row, share_of_all, summarise, top
from ..schema import ALLOWED_VALUES
from .kpis import totals, with_products

# The two full years that the growth questions compare.
COMPARED_YEARS = (1999, 2000)
MONTHS_PER_YEAR = 12

# --------------------------------------------------------------------------- products


def by_product(products: DataFrame) -> DataFrame:
    """Measures per (item, category) from the product roll-up, averages unrounded."""
    sums = ["records", "sales", "rating", "item_visibility"]
    rolled = products.groupBy("item_identifier", "item_type").agg(*[F.sum(c).alias(c) for c in sums])
    return rolled.select(
        F.col("item_identifier").alias("product"), F.col("item_type").alias("category"),
        F.col("records").alias("outlets_stocked"), F.col("sales").alias("_sales"),
        F.round("sales", 2).alias("revenue"),
        mean_from(F.col("sales"), F.col("records"), "sales").alias("_avg_sale"),
        mean_from(F.col("rating"), F.col("records"), "rating").alias("_avg_rating"),
        mean_from(F.col("rating"), F.col("records"), "rating", 2).alias("avg_rating"),
        mean_from(F.col("sales"), F.col("records"), "sales", 2).alias("avg_sale_per_outlet"),
        mean_from(F.col("item_visibility"), F.col("records"), "item_visibility", 4).alias("avg_visibility"),
    )


def by_item(products: DataFrame) -> DataFrame:
    return products.groupBy(F.col("item_identifier").alias("product")).agg(F.sum("sales").alias("_sales"))


LEAGUE = ["product", "category", "outlets_stocked", "revenue", "avg_sale_per_outlet", "avg_rating"]


@report("q01_top_products")
def top_products(products: DataFrame, n: int = 10) -> DataFrame:
    return top(by_product(products).select(LEAGUE), n, F.desc("revenue"), "product", "category")


@report("q02_bottom_products")
def bottom_products(products: DataFrame, n: int = 10, min_outlets: int = 3) -> DataFrame:
    stocked = by_product(products).where(F.col("outlets_stocked") >= min_outlets)
    return top(stocked.select(LEAGUE), n, "revenue", "product", "category")


def first_per_category(products: DataFrame, n: int, alias: str) -> DataFrame:
    """Best n products of every category; Spark cuts each category map-side, too."""
    order = Window.partitionBy("category").orderBy(F.desc("_sales"), "product")
    return by_product(products).withColumn(alias, F.row_number().over(order)).where(F.col(alias) <= n)


@report("q03_top5_per_category")
def top_per_category(products: DataFrame, n: int = 5) -> DataFrame:
    return first_per_category(products, n, "rank_in_category").select(
        "category", "rank_in_category", "product", "revenue", "outlets_stocked", "avg_rating",
    ).orderBy("category", "rank_in_category")


@report("q04_three_ranks")
def three_ranks(products: DataFrame, n: int = 20) -> DataFrame:
    """Ranks of the first n products depend on these rows alone, the quartile also on the product count."""
    items = by_item(products)
    count = one_row(items.agg(F.count(F.lit(1)).alias("n")))["n"]
    first = items.orderBy(F.desc("_sales"), "product").limit(n)
    order = Window.orderBy(F.desc("_sales"))
    place = Window.orderBy(F.desc("_sales"), "product")
    small, extra = F.floor(count / 4), count % 4
    position = F.row_number().over(place)
    edge = extra * (small + 1)
    tile = F.when(position <= edge, F.floor((position - 1) / (small + 1)) + 1).otherwise(
        F.floor((position - 1 - edge) / F.greatest(small, F.lit(1))) + extra + 1)
    return first.select(
        "product", F.round("_sales", 2).alias("revenue"), position.alias("row_number_rank"),
        F.rank().over(order).alias("rank_with_gaps"), F.dense_rank().over(order).alias("dense_rank_no_gaps"),
        tile.alias("revenue_quartile"),
    ).orderBy("row_number_rank")


def average_item_revenue(products: DataFrame) -> Column:
    return one_row(by_item(products).agg(mean_of("_sales", 8).alias("m")))["m"]


@report("q05_sells_well_rated_badly")
def sells_well_rated_badly(products: DataFrame, n: int = 15, limit: float = 3.5) -> DataFrame:
    bad = by_product(products).where(
        (F.col("avg_rating") < F.lit(str(limit)).cast("decimal(3,2)"))
        & (F.col("revenue") > average_item_revenue(products)))
    return top(
        bad.select("product", "category", "revenue", "avg_rating", "outlets_stocked"), n, F.desc("revenue"), "product",
        "category")


@report("q06_highest_rated")
def highest_rated(products: DataFrame, n: int = 10, min_outlets: int = 4) -> DataFrame:
    stocked = by_product(products).where(F.col("outlets_stocked") >= min_outlets)
    return top(
        stocked.select("product", "category", "avg_rating", "outlets_stocked", "revenue"), n, F.desc("avg_rating"),
        F.desc("revenue"), "product", "category")


@report("q07_lowest_rated")
def lowest_rated(products: DataFrame, n: int = 10, min_outlets: int = 4) -> DataFrame:
    stocked = by_product(products).where(F.col("outlets_stocked") >= min_outlets)
    return top(
        stocked.select("product", "category", "avg_rating", "outlets_stocked", F.col("revenue").alias("revenue_at_risk")),
        n, "avg_rating", "product", "category")


# Class labels and the cumulative share, in per cent, at which a class ends.
ABC_LABELS = ["A (top 80% of revenue)", "B (next 15%)", "C (final 5%)"]
ABC_LIMITS = [80, 95]


def abc_classes(items: DataFrame) -> DataFrame:
    """Products and revenue per Pareto class: `abc_class`, `products`, `_sales`.

    `items` has one row per product with its revenue in `_sales`. Products of equal revenue
    form one row of the ranked table; how many of them still fit under a limit is a division.
    """
    levels = items.groupBy("_sales").agg(F.count(F.lit(1)).alias("_ties"))
    ran = running_before(
        levels, [-F.col("_sales")], {"_before": (F.col("_sales") * F.col("_ties")).cast("decimal(34,4)")})
    whole = one_row(items.agg(F.sum("_sales").cast("decimal(30,4)").alias("t")))["t"]

    def fitting(limit: int) -> Column:
        room = whole * limit - F.col("_before").cast("decimal(30,4)") * 100
        count = F.call_function("div", room.cast("decimal(36,4)"), (F.col("_sales") * 100).cast("decimal(30,4)"))
        return F.greatest(F.lit(0).cast("bigint"), F.least(F.col("_ties"), F.when(room < 0, 0).otherwise(count)))

    in_a, in_ab = fitting(ABC_LIMITS[0]), fitting(ABC_LIMITS[1])
    counts = F.array(*[
        F.struct(F.lit(label).alias("abc_class"), count.alias("n"))
        for label, count in zip(ABC_LABELS, [in_a, in_ab - in_a, F.col("_ties") - in_ab])])
    split = ran.select("_sales", F.inline(counts)).where(F.col("n") > 0)
    return split.groupBy("abc_class").agg(
        F.sum("n").alias("products"), F.sum(F.col("_sales") * F.col("n")).cast("decimal(30,4)").alias("_sales"))


@report("q08_abc_pareto")
def abc_pareto(products: DataFrame) -> DataFrame:
    return abc_classes(by_item(products)).select(
        "abc_class", "products", share_of_all("products").alias("pct_of_products"),
        F.round("_sales", 2).alias("revenue"), share_of_all("_sales").alias("pct_of_revenue"),
    ).orderBy("abc_class")


# ------------------------------------------------------------------------- categories

CATEGORY = {"category": "item_type"}


@report("q09_category_share")
def category_share(products: DataFrame) -> DataFrame:
    summary = summarise(products, CATEGORY, R.total("sales").alias("_sales"), R.records(), R.products(), R.avg_sale())
    # The default range frame: categories of equal revenue share one cumulative value.
    running = F.sum("_sales").over(Window.orderBy(F.desc("_sales")).rangeBetween(Window.unboundedPreceding, 0))
    return summary.select(
        "category", F.round("_sales", 2).alias("revenue"), share_of_all("_sales").alias("pct_of_revenue"),
        percent(running, F.sum("_sales").over(Window.partitionBy())).alias("cumulative_pct"),
        "records", "products", "avg_sale",
    ).orderBy(F.desc("revenue"), "category")


@report("q10_weakest_categories")
def weakest_categories(products: DataFrame, n: int = 5) -> DataFrame:
    summary = summarise(products, CATEGORY, R.total("sales").alias("_sales"), R.products(), R.avg_sale(), R.avg_rating())
    shares = summary.select(
        "category", F.round("_sales", 2).alias("revenue"), share_of_all("_sales").alias("pct_of_revenue"), "products",
        "avg_sale", "avg_rating")
    return top(shares, n, "revenue", "category")


@report("q11_strategic_role")
def strategic_role(cells: DataFrame) -> DataFrame:
    bench = one_row(cells.agg(
        R.mean("sales").alias("sale"), quotient(F.sum("records"), F.count_distinct("item_type")).alias("rows")))
    summary = summarise(cells, CATEGORY, R.mean("sales").alias("_sale"), R.records(), R.revenue())
    dear, rare, busy = F.col("_sale") > bench["sale"], F.col("records") < bench["rows"], F.col("records") > bench["rows"]
    role = (
        F.when(dear & rare, "Premium niche - high value, low volume")
        .when(dear, "Star - high value, high volume")
        .when(busy, "Traffic driver - low value, high volume")
        .otherwise("Review - low value, low volume"))
    return summary.select(
        "category", F.round("_sale", 2).alias("avg_sale"), "records", "revenue",
        F.round(F.col("_sale") - bench["sale"], 2).alias("vs_overall_avg"), role.alias("strategic_role"),
    ).orderBy(F.desc("avg_sale"), "category")


@report("q12_popularity")
def popularity(cells: DataFrame) -> DataFrame:
    summary = summarise(cells, CATEGORY, R.records(), R.total("sales").alias("_sales"))
    gap = share_of_all("_sales", 10) - share_of_all("records", 10)
    return summary.select(
        "category", "records", share_of_all("records").alias("pct_of_records"), F.round("_sales", 2).alias("revenue"),
        share_of_all("_sales").alias("pct_of_revenue"), F.round(gap, 2).alias("revenue_vs_volume_gap"),
    ).orderBy(F.desc("records"), "category")


@report("q13_category_ratings")
def category_ratings(ratings: DataFrame) -> DataFrame:
    n, stars = F.col("records"), F.col("stars").cast("decimal(10,2)")
    count, first, second = F.sum(n), F.sum(stars * n), F.sum(stars * stars * n)
    # Sample variance from exact sums; undefined for a single row.
    spread = (count * second - first * first).cast("double") / F.nullif((count * (count - 1)).cast("double"), F.lit(0.0))
    return summarise(
        ratings, CATEGORY, R.avg_rating(), F.round(F.min("stars"), 1).alias("worst_rating"),
        F.round(F.max("stars"), 1).alias("best_rating"),
        F.round(F.sqrt(spread), 2).alias("rating_consistency"), R.records(), R.revenue(),
    ).orderBy(F.desc("avg_rating"), "category")


# Column of each store format in the category x format table.
FORMAT_COLUMNS = dict(zip(
    ALLOWED_VALUES["outlet_type"], ["grocery_store", "supermarket_t1", "supermarket_t2", "supermarket_t3"]))


def format_pivot(cells: DataFrame, key: dict[str, str]) -> DataFrame:
    """Unrounded revenue per format, one column each; the formats are listed, so no pass finds them."""
    keyed = cells.select(*[F.col(c).alias(k) for k, c in key.items()], "outlet_type", "sales")
    pivoted = keyed.groupBy(*key).pivot("outlet_type", list(FORMAT_COLUMNS)).agg(R.total("sales"))
    return pivoted.fillna(0)


@report("q14_category_x_format")
def category_by_format(cells: DataFrame) -> DataFrame:
    columns = [F.col(f).alias(c) for f, c in FORMAT_COLUMNS.items()]
    whole = reduce(lambda a, b: a + b, [F.col(f) for f in FORMAT_COLUMNS])
    return format_pivot(cells, CATEGORY).select(
        "category", *[F.round(c, 0).alias(n) for c, n in zip(columns, FORMAT_COLUMNS.values())],
        F.round(whole, 0).alias("total"),
    ).orderBy(F.desc("total"), "category")


# ----------------------------------------------------------------------------- stores

STORE = {"outlet": "outlet_identifier", "outlet_type": "outlet_type", "outlet_size": "outlet_size",
         "tier": "outlet_location_type"}


@report("q15_best_stores")
def best_stores(outlets: DataFrame, n: int = 5) -> DataFrame:
    keys = {**STORE, "opened": "outlet_establishment_year"}
    summary = summarise(outlets, keys, R.total("sales").alias("_sales"), R.avg_sale(), R.avg_rating())
    first = summary.orderBy(F.desc("_sales"), "outlet").limit(n)
    all_sales = one_row(outlets.agg(R.total("sales").alias("s")))["s"]
    # The rank of the first rows depends on these rows alone.
    return first.select(
        *keys, F.round("_sales", 2).alias("revenue"), percent(F.col("_sales"), all_sales).alias("pct_of_revenue"),
        "avg_sale", "avg_rating", F.rank().over(Window.orderBy(F.desc("_sales"))).alias("revenue_rank"),
    ).orderBy("revenue_rank", "outlet")


@report("q16_worst_stores")
def worst_stores(outlets: DataFrame, n: int = 5) -> DataFrame:
    network = one_row(outlets.agg(R.mean("sales").alias("m")))["m"]
    summary = summarise(outlets, STORE, R.revenue(), R.mean("sales").alias("_sale"), R.records(), R.avg_rating())
    return top(summary.select(
        *STORE, "revenue", F.round("_sale", 2).alias("avg_sale"), "records", "avg_rating",
        F.round(F.col("_sale") - network, 2).alias("avg_sale_vs_network")), n, "revenue", "outlet")


@report("q17_revenue_per_store_format")
def revenue_per_store_by_format(outlets: DataFrame) -> DataFrame:
    return summarise(
        outlets, ["outlet_type"], R.stores(), R.revenue("total_revenue"), R.revenue_per_store(), R.avg_sale(),
        R.avg_rating(),
    ).orderBy(F.desc("revenue_per_store"), "outlet_type")


def _with_share(rollup: DataFrame, keys: dict[str, str], *measures) -> DataFrame:
    summary = summarise(rollup, keys, R.total("sales").alias("_sales"), *measures)
    return summary.withColumns({
        "revenue": F.round("_sales", 2), "pct_of_revenue": share_of_all("_sales")}).drop("_sales")


@report("q18_tier_performance")
def tier_returns(outlets: DataFrame) -> DataFrame:
    return _with_share(
        outlets, {"tier": "outlet_location_type"}, R.stores(), R.revenue_per_store(), R.avg_sale(), R.avg_rating(),
    ).orderBy(F.desc("revenue_per_store"), "tier")


@report("q19_size_performance")
def size_returns(outlets: DataFrame) -> DataFrame:
    return _with_share(
        outlets, {"outlet_size": "outlet_size"}, R.stores(), R.revenue_per_store(), R.avg_sale(),
    ).orderBy(F.desc("revenue_per_store"), "outlet_size")


@report("q20_store_age")
def store_age(outlets: DataFrame) -> DataFrame:
    keys = {"opened": "outlet_establishment_year", "age_years": "outlet_age_years"}
    return summarise(outlets, keys, R.stores(), R.revenue(), R.revenue_per_store(), R.avg_sale()).orderBy("opened")


@report("q21_format_x_tier")
def format_by_tier(outlets: DataFrame) -> DataFrame:
    keys = {"outlet_type": "outlet_type", "tier": "outlet_location_type"}
    summary = summarise(
        outlets, keys, R.stores(), R.revenue(), R.revenue_per_store(), R.revenue_per_store("_rate", 8), R.avg_sale())
    ranked = summary.withColumn("opportunity_rank", F.rank().over(Window.orderBy(F.desc("_rate"))))
    return ranked.drop("_rate").orderBy("opportunity_rank", *keys)


@report("q22_assortment_breadth")
def assortment_breadth(format_products: DataFrame, shelves: DataFrame) -> DataFrame:
    keys = {"outlet": "outlet_identifier", "outlet_type": "outlet_type"}
    summary = summarise(
        shelves, keys, R.distinct("item_type", "categories_stocked"), R.total("sales").alias("_sales"))
    return with_products(summary, format_products, keys).select(
        *keys, "categories_stocked", "products_stocked", F.round("_sales", 2).alias("revenue"),
        F.round(quotient(F.col("_sales"), F.col("products_stocked")), 2).alias("revenue_per_product"),
    ).orderBy(F.desc("revenue_per_product"), "outlet", "outlet_type")


# ---------------------------------------------------------------- merchandising, quality

# Labels of the visibility fifths.
QUINTILE_LABELS = ["1 - Lowest visibility", "2", "3 - Middle", "4", "5 - Highest visibility"]


@report("q23_visibility_quintiles")
def visibility_quintiles(quintile_tiles: DataFrame) -> DataFrame:
    rows = F.col("records")
    return quintile_tiles.select(
        F.element_at(F.array(*map(F.lit, QUINTILE_LABELS)), F.col("tile")).alias("visibility_band"), "records",
        F.round(quotient(F.col("sum_item_visibility"), rows), 4).alias("avg_visibility"),
        F.round(quotient(F.col("sum_sales"), rows), 2).alias("avg_sale"),
        F.round("sum_sales", 2).alias("revenue"),
        F.round(quotient(F.col("sum_rating"), rows), 2).alias("avg_rating"),
    ).orderBy("visibility_band")


@report("q24_visibility_uplift")
def visibility_uplift(quintile_tiles: DataFrame) -> DataFrame:
    averages = quintile_tiles.withColumn("_avg", F.round(quotient(F.col("sum_sales"), F.col("records")), 8))
    ends = averages.agg(*[F.max(F.when(F.col("tile") == t, F.col("_avg"))).alias(n) for n, t in (("low", 1), ("high", 5))])
    low, high = F.col("low"), F.col("high")
    return ends.select(
        F.round(low, 2).alias("lowest_quintile_avg"), F.round(high, 2).alias("highest_quintile_avg"),
        F.round(high - low, 2).alias("absolute_uplift"), growth_of_means(high, low, 1).alias("pct_uplift"))


@report("q25_fat_compare")
def fat_content_comparison(cells: DataFrame) -> DataFrame:
    shares = _with_share(cells, {"item_fat_content": "item_fat_content"}, R.records(), R.avg_sale(), R.avg_rating())
    return shares.withColumn("pct_of_records", share_of_all("records")).orderBy(F.desc("revenue"))


@report("q26_fat_by_category")
def fat_content_by_category(cells: DataFrame) -> DataFrame:
    low, regular = F.col("item_fat_content") == "Low Fat", F.col("item_fat_content") == "Regular"

    def rating_of(test: Column) -> Column:
        return F.round(quotient(F.sum(F.when(test, F.col("rating"))), F.sum(F.when(test, F.col("records")))), 2)

    return summarise(
        cells, CATEGORY, R.revenue_when(low, "low_fat_revenue"), R.revenue_when(regular, "regular_revenue"),
        percent(F.sum(F.when(low, F.col("sales")).otherwise(0)), R.total("sales"), 1).alias("low_fat_share_pct"),
        rating_of(low).alias("low_fat_rating"), rating_of(regular).alias("regular_rating"),
    ).orderBy(F.desc("low_fat_share_pct"), "category")


@report("q27_rating_vs_sales")
def rating_against_sales(ratings: DataFrame) -> DataFrame:
    label = bands.band(F.col("stars"), bands.RATING_LIMITS_5, bands.RATING_LABELS_5)
    summary = ratings.groupBy(label.alias("rating_band")).agg(R.records(), R.avg_sale(), R.total("sales").alias("_sales"))
    return summary.select(
        "rating_band", "records", "avg_sale", F.round("_sales", 2).alias("revenue"),
        share_of_all("_sales").alias("pct_of_revenue")).orderBy("rating_band")


@report("q28_under_exposed")
def under_exposed(products: DataFrame, n: int = 15) -> DataFrame:
    network = one_row(products.agg(R.mean("item_visibility").alias("m")))["m"]
    hidden = by_product(products).where(
        (F.col("avg_visibility") < network) & (F.col("revenue") > average_item_revenue(products)))
    return top(
        hidden.select(
            "product", "category", "avg_visibility", F.round(network, 4).alias("network_avg_visibility"), "revenue",
            "avg_rating", "outlets_stocked"),
        n, F.desc("revenue"), "product", "category")


@report("q29_weight_profile")
def weight_profile(cells: DataFrame) -> DataFrame:
    return summarise(
        cells, CATEGORY, R.mean("item_weight", 2).alias("avg_weight_kg"),
        F.round(R.total("item_weight"), 0).alias("total_weight_kg"), R.revenue(),
        F.round(quotient(R.total("sales"), R.total("item_weight")), 2).alias("revenue_per_kg"),
        F.sum("item_weight_imputed").alias("rows_with_imputed_weight"),
    ).orderBy(F.desc("revenue_per_kg"), "category")


# ------------------------------------------------------------------------------- time

SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def in_month_order():
    """Window over the few rows of a monthly summary."""
    return Window.orderBy("year_month")


def by_month(cells: DataFrame, *measures) -> DataFrame:
    return summarise(cells, {"year_month": "order_year_month"}, R.total("sales").alias("_sales"), R.records(), *measures)


def moving_average(first: int, last: int, digits: int = 2) -> Column:
    """Average revenue over neighbouring months, with partial frames at the ends."""
    frame = in_month_order().rowsBetween(first, last)
    return F.round(quotient(F.sum("_sales").over(frame), F.count("_sales").over(frame)), digits)


@report("q30_mom_trend")
def month_on_month(cells: DataFrame) -> DataFrame:
    previous = F.lag("_sales").over(in_month_order())
    return by_month(cells).select(
        "year_month", "records", F.round("_sales", 2).alias("revenue"), F.round(previous, 2).alias("prev_month_revenue"),
        F.round(F.col("_sales") - previous, 2).alias("mom_change"), growth(F.col("_sales"), previous).alias("mom_pct_change"),
    ).orderBy("year_month")


@report("q31_running_total")
def running_totals(cells: DataFrame) -> DataFrame:
    in_year = Window.partitionBy(F.substring("year_month", 1, 4)).orderBy("year_month").rowsBetween(*SO_FAR)
    return by_month(cells).select(
        "year_month", F.round("_sales", 2).alias("monthly_revenue"),
        F.round(F.sum("_sales").over(in_month_order().rowsBetween(*SO_FAR)), 2).alias("running_total_all_time"),
        F.round(F.sum("_sales").over(in_year), 2).alias("running_total_ytd"),
    ).orderBy("year_month")


@report("q32_moving_avg")
def moving_averages(cells: DataFrame) -> DataFrame:
    return by_month(cells).select(
        "year_month", F.round("_sales", 2).alias("revenue"), moving_average(-2, 0).alias("moving_avg_3m"),
        F.round(F.col("_sales") - moving_average(-2, 0, 8), 2).alias("deviation_from_trend"),
    ).orderBy("year_month")


@report("q33_yoy_by_month")
def year_on_year(cells: DataFrame) -> DataFrame:
    """Twelve rows back is one year back only if no month is missing, so the months come from the calendar."""
    spine = month_spine(cells, "first_day", "last_day").select(F.date_format("month_start", "yyyy-MM").alias("year_month"))
    before = F.lag("_sales", MONTHS_PER_YEAR).over(in_month_order())
    compared = spine.join(by_month(cells), "year_month", "left").select(
        "year_month", F.round("_sales", 2).alias("revenue"), F.round(before, 2).alias("same_month_last_year"),
        F.round(F.col("_sales") - before, 2).alias("yoy_change"), growth(F.col("_sales"), before).alias("yoy_pct_growth"))
    return compared.where(F.col("revenue").isNotNull()).orderBy("year_month")


@report("q34_full_year")
def full_year(cells: DataFrame) -> DataFrame:
    yearly = summarise(
        cells, {"year": "order_year"}, R.records(), R.total("sales").alias("_sales"), R.mean("sales").alias("_sale"),
        R.avg_rating())
    years = Window.orderBy("year")

    before = {c: F.lag(c).over(years) for c in ("_sales", "_sale")}
    return yearly.select(
        "year", "records", F.round("_sales", 2).alias("revenue"), F.round("_sale", 2).alias("avg_sale"), "avg_rating",
        growth(F.col("_sales"), before["_sales"]).alias("yoy_growth_pct"),
        growth_of_means(F.col("_sale"), before["_sale"]).alias("basket_growth_pct"),
    ).orderBy("year")


@report("q35_seasonality")
def seasonality(cells: DataFrame) -> DataFrame:
    monthly = summarise(
        cells, {"month_no": "order_month"}, F.max("order_month_name").alias("month_name"), R.total("sales").alias("_sales"),
        R.avg_sale())
    whole = F.sum("_sales").over(Window.partitionBy())
    return monthly.select(
        "month_no", "month_name", F.round("_sales", 2).alias("revenue"), "avg_sale",
        share_of_all("_sales").alias("pct_of_annual_revenue"),
        F.rank().over(Window.orderBy(F.desc("_sales"))).alias("month_rank"),
        F.round(quotient(F.col("_sales") * MONTHS_PER_YEAR, whole), 2).alias("seasonality_index"),
    ).orderBy("month_no")


@report("q36_quarterly")
def quarterly(cells: DataFrame) -> DataFrame:
    keys = {"year": "order_year", "quarter": "order_quarter"}
    summary = summarise(cells, keys, R.records(), R.total("sales").alias("_sales"), R.avg_sale())
    previous = F.lag("_sales").over(Window.orderBy("year", "quarter"))
    return summary.select(
        "year", "quarter", F.concat("year", F.lit("-Q"), "quarter").alias("period"), "records",
        F.round("_sales", 2).alias("revenue"), "avg_sale", growth(F.col("_sales"), previous).alias("qoq_growth_pct"),
    ).orderBy("year", "quarter")


# -------------------------------------------------------------------------- strategic


def year_columns(cells: DataFrame, keys: dict[str, str], years: tuple[int, ...]) -> DataFrame:
    """Revenue per key, one column `rev_<year>` per listed year, NULL where there is none."""
    renamed = [F.col(c).alias(k) for k, c in keys.items()]
    pivoted = cells.select(*renamed, "order_year", "sales").groupBy(*keys).pivot("order_year", list(years)).agg(R.total("sales"))
    return pivoted.select(*keys, *[F.col(str(y)).alias(f"rev_{y}") for y in years])


@report("q37_category_growth")
def category_growth(cells: DataFrame, years: tuple[int, int] = COMPARED_YEARS) -> DataFrame:
    first, second = (F.col(f"rev_{y}") for y in years)
    change = growth(second, first, 10)
    # Limits and texts of the verdict.
    verdict = (
        F.when(change >= 25, "Accelerating - invest").when(change >= 10, "Growing - maintain")
        .when(change >= 0, "Flat - review").otherwise("Declining - act now"))
    return year_columns(cells, CATEGORY, years).select(
        "category", F.round(first, 2).alias(f"revenue_{years[0]}"), F.round(second, 2).alias(f"revenue_{years[1]}"),
        F.round(second - first, 2).alias("absolute_growth"), growth(second, first).alias("growth_pct"),
        verdict.alias("verdict"),
    ).orderBy(F.desc("growth_pct"), "category")


@report("q38_store_growth")
def store_growth(outlets: DataFrame, years: tuple[int, int] = COMPARED_YEARS) -> DataFrame:
    keys = {"outlet": "outlet_identifier", "outlet_type": "outlet_type"}
    # The roll-up has one row per store and year, so a sum per year is all that is left.
    revenue = [F.sum(F.when(F.col("order_year") == y, F.col("sales"))).alias(f"rev_{y}") for y in years]
    stores = summarise(outlets, keys, *revenue)
    first, second = (F.col(f"rev_{y}") for y in years)
    ranked = with_rank(stores, -growth(second, first, 8), "growth_rank")
    return ranked.select(
        *keys, F.round(first, 2).alias(f"revenue_{years[0]}"), F.round(second, 2).alias(f"revenue_{years[1]}"),
        growth(second, first).alias("growth_pct"), "growth_rank",
    ).orderBy("growth_rank", "outlet", "outlet_type")


@report("q39_store_vs_network")
def store_against_network(shelves: DataFrame, n: int = 20, min_records: int = 15) -> DataFrame:
    """Benchmark: the unweighted mean of the store averages of a category."""
    cells = summarise(
        shelves, {"outlet": "outlet_identifier", "category": "item_type"}, R.records(), R.revenue(),
        R.mean("sales").alias("_sale"))
    network = cells.groupBy("category").agg(mean_of("_sale", 12).alias("_network"))
    own, bench = F.col("_sale"), F.col("_network")
    # Limits and texts of the flag.
    flag = (
        F.when(own < bench * F.lit("0.80").cast("decimal(3,2)"), "Underperforming - investigate")
        .when(own > bench * F.lit("1.20").cast("decimal(3,2)"), "Outperforming - learn from it")
        .otherwise("In line"))
    compared = join_lookup(cells.where(F.col("records") >= min_records), network, ["category"]).select(
        "outlet", "category", "records", "revenue", F.round(own, 2).alias("store_avg_sale"),
        F.round(bench, 2).alias("network_avg_sale"), growth_of_means(own, bench, 1).alias("pct_vs_network"), flag.alias("flag"))
    return top(compared, n, "pct_vs_network", "outlet", "category")


# The lines of the executive summary, in order, and why each matters.
SUMMARY_LINES = {
    "Total Revenue (INR)": "Headline topline",
    "Sales Records": "Volume of product-outlet sales",
    "Average Sale (INR)": "Basket value - the growth-quality lever",
    "Average Rating": "Customer satisfaction guardrail",
    "Products / Categories": "Assortment breadth",
    "Outlets": "Network footprint",
    "Top Category": "Largest revenue pool - protect first",
    "Top Outlet": "Benchmark store - copy its playbook",
    "Best Format by Revenue/Store": "Where the next store should be opened",
    "Peak Month": "Build inventory ahead of this month",
}


def leader(rollup: DataFrame, column: str, amount: Column) -> Column:
    """The value of a column with the largest amount; ties go to the first in order."""
    first = rollup.groupBy(column).agg(amount.alias("_amount")).orderBy(F.desc("_amount"), column).limit(1)
    return one_row(first.select(column))[column]


@report("q40_exec_summary")
def executive_summary(products: DataFrame, outlets: DataFrame, cells: DataFrame) -> DataFrame:
    sums = totals(products, outlets)

    def text(number: Column, digits: int) -> Column:
        return F.format_number(F.round(number, digits), digits)

    values = [
        text(F.col("sales"), 2),
        text(F.col("records"), 0),
        text(quotient(F.col("sales"), F.col("records")), 2),
        text(quotient(F.col("rating"), F.col("records")), 2),
        F.concat_ws(" / ", F.col("products").cast("string"), F.col("categories").cast("string")),
        F.col("outlets").cast("string"),
        leader(cells, "item_type", R.total("sales")),
        leader(outlets, "outlet_identifier", R.total("sales")),
        leader(outlets, "outlet_type", quotient(R.total("sales"), F.count_distinct("outlet_identifier"))),
        leader(cells, "order_month_name", R.total("sales")),
    ]
    lines = F.array(*[
        F.struct(F.lit(metric).alias("metric"), value.alias("value"), F.lit(why).alias("why_it_matters"))
        for (metric, why), value in zip(SUMMARY_LINES.items(), values)])
    return sums.select(F.inline(lines))
