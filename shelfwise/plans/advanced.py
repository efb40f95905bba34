"""Advanced analyses, the reporting views and the category deep dive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import catalog
from ..catalog import report
from ..functions import measures as M, rolled as R
from ..functions.exact import growth, growth_of_means, mean_from, percent, quotient, quotient_of_means
from ..operators.calendar import month_spine
from ..operators.pairs import distribution_gaps, widest_pairs
from ..operators.ranking import Order, Place, with_places
from ..operators.segments import join_lookup, mean_of, one_row, share_of_all, summarise, top
from .business import CATEGORY, COMPARED_YEARS, SO_FAR, by_month, by_product, first_per_category, in_month_order, moving_average
from .kpis import OUTLET_KEYS, outlet_master, totals, with_products

# ---------------------------------------------------------------- products and stores

# Name and action of the four quadrants, by (high revenue, high rating).
SEGMENTS = {
    (True, True): ("1. Star (high revenue, high rating)", "Protect stock. Never allow a stock-out."),
    (True, False): (
        "2. Fix quality (high revenue, low rating)", "Supplier review. Volume is amplifying a quality problem."),
    (False, True): (
        "3. Promote (low revenue, high rating)", "Raise visibility. Customers like it but cannot find it."),
    (False, False): ("4. Delist candidate (low revenue, low rating)", "Free the shelf space for an A-item."),
}

# The short names of the same quadrants.
SEGMENT_NAMES = {
    (True, True): "Star",
    (True, False): "Fix quality",
    (False, True): "Promote",
    (False, False): "Delist candidate",
}


def quadrant(revenue: Column, rating: Column, bench: Column, labels: dict) -> Column:
    """Label of the side of both benchmarks (`revenue`, `rating`) a product is on."""
    sells, liked = revenue >= bench["revenue"], rating >= bench["rating"]
    return (
        F.when(sells & liked, labels[True, True]).when(sells, labels[True, False])
        .when(liked, labels[False, True]).otherwise(labels[False, False]))


def product_bench(products: DataFrame, revenue: str, rating: str, digits: tuple[int, int] = (8, 10)) -> Column:
    return one_row(products.agg(
        mean_of(revenue, digits[0]).alias("revenue"), mean_of(rating, digits[1]).alias("rating")))


@report("a01_segmentation")
def segmentation(products: DataFrame) -> DataFrame:
    stats = by_product(products)
    bench = product_bench(stats, "_sales", "_avg_rating")
    names, actions = ({k: v[i] for k, v in SEGMENTS.items()} for i in (0, 1))
    sales, rating = F.col("_sales"), F.col("_avg_rating")
    labelled = stats.select(
        sales, rating, quadrant(sales, rating, bench, names).alias("segment"),
        quadrant(sales, rating, bench, actions).alias("recommended_action"))
    summary = labelled.groupBy("segment", "recommended_action").agg(
        F.count(F.lit(1)).alias("products"), F.sum("_sales").alias("_sales"), mean_of("_avg_rating", 2).alias("avg_rating"))
    return summary.select(
        "segment", "products", F.round("_sales", 2).alias("revenue"), share_of_all("_sales").alias("pct_of_revenue"),
        "avg_rating", "recommended_action",
    ).orderBy("segment")


@report("a02_outlet_scorecard")
def outlet_scorecard(outlets: DataFrame) -> DataFrame:
    keys = ["outlet_identifier", "outlet_type", "outlet_size", "outlet_location_type"]
    rolled = outlets.groupBy(*keys).agg(
        F.sum("sales").alias("_sales"), F.sum("rating").alias("_rating"), F.sum("records").alias("_rows"))
    stores = rolled.select(
        *keys, "_sales", mean_from(F.col("_sales"), F.col("_rows"), "sales").alias("_sale"),
        mean_from(F.col("_rating"), F.col("_rows"), "rating").alias("_rate"))
    ranked = with_places(
        stores,
        Order(-F.col("_sales"), {
            "_place": Place.rank, "revenue_quartile": lambda p: p.tile(4), "_below": Place.below, "_n": lambda p: p.rows,
        }, [F.col(k) for k in keys]),
        Order(-F.col("_sale"), {"basket_rank": Place.rank}), Order(-F.col("_rate"), {"rating_rank": Place.rank}))
    # Counted from the bottom: stores with less revenue, and stores with at most this revenue.
    below, n = F.col("_below"), F.col("_n")
    at_most = n - F.col("_place") + 1
    # Limits and texts of the verdict.
    verdict = (
        F.when((F.col("_place") <= 3) & (F.col("rating_rank") <= 5), "Benchmark store - replicate")
        .when(F.col("_place") <= 3, "High revenue, weak satisfaction - audit service")
        .when(F.col("rating_rank") <= 3, "Loved but small - growth headroom")
        .otherwise("Standard performer"))
    return ranked.select(
        F.col("outlet_identifier").alias("outlet"), "outlet_type", F.col("outlet_location_type").alias("tier"),
        F.round("_sales", 2).alias("revenue"), "revenue_quartile",
        F.coalesce(percent(below, n - 1, 1), F.lit(0)).alias("revenue_percentile"),
        percent(at_most, n, 1).alias("cumulative_dist"),
        F.round("_sale", 2).alias("avg_sale"), "basket_rank", F.round("_rate", 2).alias("avg_rating"), "rating_rank",
        verdict.alias("verdict"),
    ).orderBy(F.desc("revenue"), "outlet")


@report("a03_top3_rank_compare")
def rank_comparison(products: DataFrame, n: int = 3) -> DataFrame:
    """All three ranks of the first n products of a category depend on these rows alone."""
    first = first_per_category(products, n, "row_number")
    whole = products.groupBy(F.col("item_type").alias("category")).agg(F.sum("sales").alias("_whole"))
    order = Window.partitionBy("category").orderBy(F.desc("_sales"))
    return join_lookup(first, whole, ["category"]).select(
        "category", "product", "revenue", percent(F.col("_sales"), F.col("_whole")).alias("pct_of_category"),
        "row_number", F.rank().over(order).alias("rank_with_gaps"), F.dense_rank().over(order).alias("dense_rank"),
    ).orderBy("category", "row_number")


@report("a04_contribution_curve")
def contribution_curve(cells: DataFrame) -> DataFrame:
    summary = summarise(cells, CATEGORY, R.total("sales").alias("_sales"))
    order = Window.orderBy(F.desc("_sales"), "category")
    whole = F.sum("_sales").over(Window.partitionBy())
    running = F.sum("_sales").over(order.rowsBetween(*SO_FAR))
    shares = summary.select(
        F.row_number().over(order).alias("rank_no"), "category", F.round("_sales", 2).alias("revenue"),
        percent(F.col("_sales"), whole).alias("pct_of_total"), F.round(running, 2).alias("running_total"),
        percent(running, whole).alias("cumulative_pct"), percent(running, whole, 10).alias("_curve"))
    tier = F.when(F.col("_curve") <= 80, "Core - protect").when(F.col("_curve") <= 95, "Secondary - maintain")
    return shares.withColumn("tier", tier.otherwise("Tail - review")).drop("_curve").orderBy("rank_no")


@report("a05_first_last")
def best_and_worst_category(shelves: DataFrame) -> DataFrame:
    """Two structs per store, combined map-side, instead of a window over each store."""
    cells = summarise(shelves, {"outlet": "outlet_identifier", "category": "item_type"}, R.total("sales").alias("_sales"))
    # Ties: the first category in order leads, the last one trails.
    ends = cells.groupBy("outlet").agg(
        F.min(F.struct(-F.col("_sales"), F.col("category"))).alias("_top"),
        F.max(F.struct(-F.col("_sales"), F.col("category"))).alias("_bottom"),
        F.sum("_sales").alias("_store"))
    best, worst = -F.col("_top.col1"), -F.col("_bottom.col1")
    # Limit and texts of the flag.
    risk = F.when(percent(best, F.col("_store"), 10) > 15, "Concentration risk - one category carries the store")
    return ends.select(
        "outlet", F.col("_top.category").alias("top_category"), F.round(best, 2).alias("top_revenue"),
        percent(best, F.col("_store"), 1).alias("top_pct_of_store"),
        F.col("_bottom.category").alias("bottom_category"), F.round(worst, 2).alias("bottom_revenue"),
        F.round(quotient(best, worst), 1).alias("spread_ratio"), risk.otherwise("Balanced mix").alias("risk_flag"),
    ).orderBy(F.desc("top_pct_of_store"), "outlet")


@report("a06_timeline")
def timeline(cells: DataFrame) -> DataFrame:
    now, back, ahead = F.col("_sales"), F.lag("_sales").over(in_month_order()), F.lead("_sales").over(in_month_order())
    # Texts of the position.
    above = F.when(now > moving_average(-2, 0, 8), "Above trend").otherwise("Below trend")
    return by_month(cells).select(
        "year_month", F.round(now, 2).alias("revenue"), F.round(back, 2).alias("prev_month"),
        growth(now, back, 1).alias("mom_pct"), F.round(ahead, 2).alias("next_month"),
        growth(ahead, now, 1).alias("next_month_pct"), moving_average(-2, 0).alias("moving_avg_3m"),
        moving_average(-5, 0).alias("moving_avg_6m"), moving_average(-1, 1).alias("centred_avg_3m"),
        above.alias("trend_position"),
    ).orderBy("year_month")


@report("a07_vs_network")
def against_network(cells: DataFrame) -> DataFrame:
    network = one_row(cells.agg(R.mean("sales").alias("sale"), R.mean("rating").alias("rate")))
    summary = summarise(cells, CATEGORY, R.revenue(), R.mean("sales").alias("_sale"), R.mean("rating").alias("_rate"))
    dear, liked = F.col("_sale") > network["sale"], F.col("_rate") > network["rate"]
    # Texts of the assessment.
    assessment = (
        F.when(dear & liked, "Outperforms on both").when(dear, "Commercially strong, satisfaction lags")
        .when(liked, "Well liked, commercially weak").otherwise("Underperforms on both"))
    return summary.select(
        "category", "revenue", F.round("_sale", 2).alias("avg_sale"), F.round(network["sale"], 2).alias("network_avg_sale"),
        F.round(F.col("_sale") - network["sale"], 2).alias("vs_network"),
        growth_of_means(F.col("_sale"), network["sale"], 1).alias("pct_vs_network"),
        F.round("_rate", 2).alias("avg_rating"), F.round(network["rate"], 2).alias("network_avg_rating"),
        assessment.alias("assessment"),
    ).orderBy(F.desc("revenue"), "category")


@report("a08_vs_own_category")
def against_own_category(products: DataFrame, n: int = 15) -> DataFrame:
    """The category average is a small aggregate joined back; a window would gather each category."""
    stats = by_product(products)
    peers = stats.groupBy("category").agg(mean_of("_sales", 8).alias("_peer"))
    compared = join_lookup(stats, peers, ["category"]).select(
        "product", "category", F.col("revenue").alias("product_revenue"), F.round("_peer", 2).alias("category_avg_revenue"),
        F.round(quotient_of_means((F.col("_sales") - F.col("_peer")) * 100, F.col("_peer")), 1).alias("pct_above_category"),
        "outlets_stocked", "avg_rating")
    return top(compared, n, F.desc("pct_above_category"), "product", "category")


@report("a09_store_pairs")
def store_pairs(fact: DataFrame, stocks: DataFrame | None = None, n: int = 15, factor: int = 3) -> DataFrame:
    shelf = F.col("a_item_visibility") > F.col("b_item_visibility") * F.lit("1.5").cast("decimal(2,1)")
    # Texts of the cause.
    cause = (
        F.when(shelf, "Likely shelf placement - weak store gives it far less space")
        .when(F.col("a_outlet_type") != F.col("b_outlet_type"), "Store format difference - may be structural")
        .otherwise("Same format, similar visibility - investigate execution locally"))
    return widest_pairs(fact, stocks, n, factor).select(
        F.col("a_item_identifier").alias("product"), F.col("a_item_type").alias("category"),
        F.col("a_outlet_identifier").alias("strong_outlet"), F.round("a_sales", 2).alias("strong_sales"),
        F.round("a_item_visibility", 4).alias("strong_visibility"),
        F.col("b_outlet_identifier").alias("weak_outlet"), F.round("b_sales", 2).alias("weak_sales"),
        F.round("b_item_visibility", 4).alias("weak_visibility"), F.round("gap", 2).alias("sales_gap"),
        F.round(quotient(F.col("a_sales"), F.col("b_sales")), 1).alias("sales_multiple"), cause.alias("probable_cause"))


@report("a10_distribution_gaps")
def missing_products(stocks: DataFrame, products: DataFrame, leaders: int = 20, n: int = 25) -> DataFrame:
    best = by_product(products).orderBy(F.desc("_sales"), "product", "category").limit(leaders)
    place = F.row_number().over(Window.orderBy(F.desc("_sales"), "product", "category")) - 1
    table = best.select(F.col("product").alias("item_identifier"), "category", "_sales", place.alias("place"))
    return distribution_gaps(stocks, table, n).select(
        F.col("item_identifier").alias("proven_product"), "category", F.round("_sales", 2).alias("product_revenue"),
        F.col("outlet_identifier").alias("missing_from_outlet"), "outlet_type", F.col("outlet_location_type").alias("tier"),
        F.lit("Distribution gap - list this product here").alias("action"))


@report("a11_month_spine")
def month_check(cells: DataFrame) -> DataFrame:
    """Months are summed before they meet the calendar, so only a few rows are joined."""
    spine = month_spine(cells, "first_day", "last_day").select(F.date_format("month_start", "yyyy-MM").alias("year_month"))
    rows = F.coalesce("records", F.lit(0))
    return spine.join(by_month(cells), "year_month", "left").select(
        "year_month", rows.alias("records"), F.round(F.coalesce("_sales", F.lit(0).cast("decimal(28,4)")), 2).alias("revenue"),
        F.when(rows == 0, "NO DATA - investigate").otherwise("OK").alias("data_check"),
    ).orderBy("year_month")


# ------------------------------------------------------------------------------ views


@report("v1_category_performance")
def category_performance(products: DataFrame) -> DataFrame:
    summary = summarise(
        products, CATEGORY, R.records(), R.products(), R.total("sales").alias("_sales"), R.avg_sale(), R.avg_rating(),
        R.mean("item_visibility", 4).alias("avg_visibility"), R.mean("item_weight", 2).alias("avg_weight_kg"))
    return summary.select(
        "category", "records", "products", F.round("_sales", 2).alias("revenue"),
        share_of_all("_sales").alias("pct_of_revenue"), "avg_sale", "avg_rating", "avg_visibility", "avg_weight_kg")


@report("v2_outlet_scorecard")
def outlet_view(outlet_products: DataFrame, shelves: DataFrame) -> DataFrame:
    columns = [*OUTLET_KEYS, "records", "categories_stocked", "products_stocked", "revenue", "pct_of_revenue", "avg_sale",
               "avg_rating"]
    return with_products(outlet_master(shelves), outlet_products, OUTLET_KEYS).select(columns)


@report("v3_monthly_trend")
def monthly_trend(cells: DataFrame) -> DataFrame:
    previous = F.lag("_sales").over(in_month_order())
    monthly = by_month(cells, F.max("order_year").alias("year"), F.max("order_month").alias("month_no"), R.avg_rating())
    return monthly.select(
        "year_month", "year", "month_no", "records", F.round("_sales", 2).alias("revenue"), "avg_rating",
        F.round(previous, 2).alias("prev_month_revenue"), growth(F.col("_sales"), previous).alias("mom_pct_change"),
        moving_average(-2, 0).alias("moving_avg_3m"),
        F.round(F.sum("_sales").over(in_month_order().rowsBetween(*SO_FAR)), 2).alias("running_total"))


@report("v4_product_master")
def product_master(products: DataFrame) -> DataFrame:
    rows = F.col("records")
    stats = products.select(
        "item_identifier", "item_type", "item_fat_content", "records", F.col("sales").alias("_sales"),
        mean_from(F.col("sales"), rows, "sales", 2).alias("avg_sale"),
        mean_from(F.col("rating"), rows, "rating").alias("_rate"),
        mean_from(F.col("item_visibility"), rows, "item_visibility", 4).alias("avg_visibility"))
    bench = product_bench(stats, "_sales", "_rate")
    down = -F.col("_sales")
    keys = [F.col("item_identifier"), F.col("item_type"), F.col("item_fat_content")]
    ranked = with_places(
        stats, Order(down, {"revenue_quartile": lambda p: p.tile(4), "revenue_rank_overall": Place.rank}, keys),
        Order(down, {"revenue_rank_in_category": Place.rank}, keys, ["item_type"]))
    return ranked.select(
        F.col("item_identifier").alias("product"), F.col("item_type").alias("category"),
        F.col("item_fat_content").alias("fat_content"), F.col("records").alias("outlets_stocked"),
        F.round("_sales", 2).alias("revenue"), "avg_sale", F.round("_rate", 2).alias("avg_rating"), "avg_visibility",
        "revenue_rank_overall", "revenue_rank_in_category", "revenue_quartile",
        quadrant(F.col("_sales"), F.col("_rate"), bench, SEGMENT_NAMES).alias("segment"))


@report("v5_executive_kpis")
def executive_kpis(products: DataFrame, outlets: DataFrame) -> DataFrame:
    averages = {"avg_sale": ("sales", 2), "avg_rating": ("rating", 2), "avg_visibility": ("item_visibility", 4)}
    return totals(products, outlets).select(
        F.round("sales", 2).alias("total_revenue"), F.col("records").alias("total_records"),
        F.col("products").alias("total_products"), F.col("categories").alias("total_categories"),
        F.col("outlets").alias("total_outlets"),
        *[F.round(quotient(F.col(c), F.col("records")), d).alias(name) for name, (c, d) in averages.items()],
        F.col("first_day").alias("period_start"), F.col("last_day").alias("period_end"))


VIEWS = {
    "vw_category_performance": category_performance,
    "vw_outlet_scorecard": outlet_view,
    "vw_monthly_trend": monthly_trend,
    "vw_product_master": product_master,
    "vw_executive_kpis": executive_kpis,
}


def create_views(workspace) -> list[str]:
    """Register the reporting layer as temporary views, so every consumer shares one definition."""
    for name, build in VIEWS.items():
        catalog.call(build, workspace).createOrReplaceTempView(name)
    return list(VIEWS)


# Preview of each view: sort order and row count.
PREVIEWS = {
    "vw_executive_kpis": ([], 1),
    "vw_category_performance": (["revenue DESC", "category"], 5),
    "vw_outlet_scorecard": (["revenue DESC", "outlet"], 5),
    "vw_monthly_trend": (["year_month"], 6),
    "vw_product_master": (["revenue DESC", "product", "category", "fat_content"], 5),
}
PREVIEW_KEYS = {
    "vw_executive_kpis": ("'all'", "total_revenue"), "vw_category_performance": ("category", "revenue"),
    "vw_outlet_scorecard": ("outlet", "revenue"), "vw_monthly_trend": ("year_month", "revenue"),
    "vw_product_master": ("product", "revenue"),
}


def preview_views(workspace) -> dict[str, DataFrame]:
    create_views(workspace)
    previews = {}
    for name, (order, n) in PREVIEWS.items():
        view = workspace.spark.table(name)
        keys = [F.desc(o.split()[0]) if o.endswith(" DESC") else F.col(o) for o in order]
        previews[name] = view.orderBy(*keys).limit(n) if keys else view
    return previews


@report("v_smoke")
def view_previews(workspace) -> DataFrame:
    """First rows of every view in one table: view, key and revenue."""
    result = None
    for name, preview in preview_views(workspace).items():
        key, amount = PREVIEW_KEYS[name]
        rows = preview.select(
            F.lit(name).alias("view_name"), F.expr(key).alias("row_key"), F.col(amount).cast("decimal(30,2)").alias("revenue"))
        result = rows if result is None else result.unionByName(rows)
    return result


# -------------------------------------------------------------------------- deep dive

CATEGORY_NAMES = {"found": "LARGE", "unknown": "Not A Real Category"}


@report("a13_guard")
def unknown_category(cells: DataFrame, category: str = CATEGORY_NAMES["unknown"]) -> DataFrame:
    """One row that names the error and the valid values if the category does not exist, else no row."""
    listed = cells.agg(
        F.concat(F.lit("Category not found: "), F.lit(category)).alias("error_message"),
        # The one-cell list is what is asked for; it holds the few categories of the roll-up.
        F.array_join(F.array_sort(F.collect_set("item_type")), ", ").alias("valid_categories"),
        F.count_if(F.col("item_type") == category).alias("_rows"))
    return listed.where(F.col("_rows") == 0).drop("_rows")


def in_category(rollup: DataFrame, category: str) -> DataFrame:
    return rollup.where(F.col("item_type") == category)


@report("a13_headline")
def category_headline(products: DataFrame, category: str = CATEGORY_NAMES["found"]) -> DataFrame:
    everything = one_row(products.agg(R.total("sales").alias("s")))["s"]
    summary = in_category(products, category).agg(
        R.total("sales").alias("_sales"), R.records(), R.products(), R.avg_sale(), R.avg_rating())
    return summary.select(
        F.lit(category).alias("category"), F.round("_sales", 2).alias("revenue"),
        percent(F.col("_sales"), everything).alias("pct_of_business"), "records", "products", "avg_sale", "avg_rating")


@report("a13_top_products")
def category_top_products(products: DataFrame, category: str = CATEGORY_NAMES["found"], n: int = 10) -> DataFrame:
    items = summarise(
        in_category(products, category), {"product": "item_identifier"}, R.revenue(), R.records("outlets_stocked"),
        R.avg_rating())
    return top(items, n, F.desc("revenue"), "product")


@report("a13_stores")
def category_stores(shelves: DataFrame, category: str = CATEGORY_NAMES["found"]) -> DataFrame:
    keys = {"outlet": "outlet_identifier", "outlet_type": "outlet_type"}
    return summarise(in_category(shelves, category), keys, R.revenue(), R.avg_sale()).orderBy(F.desc("revenue"), "outlet")


@report("a13_trend")
def category_trend(cells: DataFrame, category: str = CATEGORY_NAMES["found"]) -> DataFrame:
    keys = {"year_month": "order_year_month"}
    return summarise(in_category(cells, category), keys, R.revenue(), R.records()).orderBy("year_month")


def category_deep_dive(products: DataFrame, shelves: DataFrame, cells: DataFrame, category: str) -> dict[str, DataFrame]:
    """The four results of a category, or the error row alone for an unknown one."""
    if in_category(cells, category).isEmpty():
        return {"error": unknown_category(cells, category)}
    return {
        "headline": category_headline(products, category), "top_products": category_top_products(products, category),
        "stores": category_stores(shelves, category), "trend": category_trend(cells, category)}


@report("a13_deep_dive")
def deep_dive_rows(
    products: DataFrame, shelves: DataFrame, cells: DataFrame, category: str = CATEGORY_NAMES["found"],
) -> DataFrame:
    """The deep dive as one table: part, row key and revenue."""
    keys = {"headline": "category", "top_products": "product", "stores": "outlet", "trend": "year_month",
            "error": "error_message"}
    result = None
    for part, rows in category_deep_dive(products, shelves, cells, category).items():
        amount = F.col("revenue") if "revenue" in rows.columns else F.lit(None)
        rows = rows.select(
            F.lit(part).alias("part"), F.col(keys[part]).alias("row_key"), amount.cast("decimal(30,2)").alias("revenue"))
        result = rows if result is None else result.unionByName(rows)
    return result


@report("a14_range_filter")
def rows_of_year(fact: DataFrame, year: int = COMPARED_YEARS[1]) -> DataFrame:
    """Counts one year by a plain date range, which Parquet statistics can skip files by, and by
    the partition column, which prunes folders; year(order_date) would read everything."""
    low, high = f"{year}-01-01", f"{year + 1}-01-01"
    day = F.col("order_date")
    by_range = fact.where((day >= F.to_date(F.lit(low))) & (day < F.to_date(F.lit(high)))).agg(M.records("range_rows"))
    by_folder = fact.where(F.col("order_year") == year).agg(M.records("partition_rows"))
    return by_range.select("range_rows", one_row(by_folder)["partition_rows"].alias("partition_rows"))
