"""The second set of aggregates, with its own rounding, band and quantile rules.

Group averages are rounded to four decimals first; shares and growth are taken from the
rounded values. Bands are right-closed, quintiles are cut by value, medians interpolate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import catalog
from ..catalog import report, table
from ..functions import bands, measures as M, rolled as R
from ..functions.exact import growth, growth_of_means, mean, mean_from, percent, quotient, quotient_of_means, total
from ..operators.order_stats import quantiles_interpolated
from ..operators.ranking import with_row_number
from ..operators.segments import mean_of, one_row, share_of_all, summarise, top
from ..schema import OUTLET_ATTRIBUTES
from ..sources import files
from .advanced import SEGMENT_NAMES, product_bench, quadrant
from .business import SO_FAR, FORMAT_COLUMNS, abc_classes, year_columns
from .kpis import day_type, totals, with_products


def revenue4(measures=M) -> Column:
    return measures.revenue("revenue", 4)


def averages4(*names: str, mean=mean) -> list[Column]:
    alias = {"sales": "avg_sale", "rating": "avg_rating", "item_visibility": "avg_visibility", "item_weight": "avg_weight"}
    return [mean(n, 4).alias(alias[n]) for n in names]


def share_of_total(df: DataFrame, column: str, alias: str, digits: int = 2) -> DataFrame:
    """Add 100 * x / sum(x) to a summary of any size; the sum is a scalar, not a window."""
    whole = one_row(df.agg(F.sum(column).alias("s")))["s"]
    return df.withColumn(alias, percent(F.col(column), whole, digits))


@report("p_share")
def category_shares(cells: DataFrame) -> DataFrame:
    return share_of_total(summarise(cells, ["item_type"], revenue4(R)), "revenue", "pct_of_total")


@report("p_kpis")
def kpis(fact: DataFrame, products: DataFrame, outlets: DataFrame) -> DataFrame:
    rows, sales = F.col("records"), F.col("sales")
    median = one_row(quantiles_interpolated(fact, "sales", {"m": 50}))["m"]

    def average(column: str, digits: int, count: Column = rows) -> Column:
        return F.round(quotient(F.col(column), count), digits)

    return totals(products, outlets).select(
        F.round(sales, 2).alias("total_revenue"), rows.alias("total_records"), F.col("products").alias("total_products"),
        F.col("categories").alias("total_categories"), F.col("outlets").alias("total_outlets"),
        F.col("types").alias("total_outlet_types"), F.col("tiers").alias("total_tiers"),
        average("sales", 2).alias("avg_sale"), F.round(median, 2).alias("median_sale"), average("rating", 2).alias("avg_rating"),
        average("item_weight", 2, F.col("weighed")).alias("avg_weight"), average("item_visibility", 4).alias("avg_visibility"),
        F.round(quotient(sales, F.col("outlets")), 2).alias("revenue_per_outlet"),
        F.date_format("first_day", "yyyy-MM-dd").alias("period_start"), F.date_format("last_day", "yyyy-MM-dd").alias("period_end"),
        percent(F.col("item_weight_imputed"), rows).alias("pct_weight_imputed"),
        percent(F.col("item_visibility_imputed"), rows).alias("pct_visibility_imputed"))


@report("p_category")
def category(products: DataFrame) -> DataFrame:
    summary = summarise(
        products, ["item_type"], R.records(), R.products(), revenue4(R),
        *averages4("sales", "rating", "item_visibility", "item_weight", mean=R.mean))
    shared = summary.withColumn("pct_of_revenue", share_of_all("revenue"))
    running = F.sum("pct_of_revenue").over(Window.orderBy(F.desc("revenue"), "item_type").rowsBetween(*SO_FAR))
    return shared.withColumns({
        "cumulative_pct": running,
        "revenue_per_kg": F.round(quotient(F.col("revenue"), F.col("avg_weight") * F.col("records")), 2),
    }).orderBy(F.desc("revenue"), "item_type")


def outlet_shares(shelves: DataFrame) -> DataFrame:
    summary = summarise(
        shelves, {c: c for c in OUTLET_ATTRIBUTES}, R.records(), revenue4(R), *averages4("sales", "rating", mean=R.mean),
        R.distinct("item_type", "categories_stocked"))
    return share_of_total(summary, "revenue", "pct_of_revenue")


@report("p_outlet")
def outlet(outlet_products: DataFrame, shelves: DataFrame) -> DataFrame:
    keys = {c: c for c in OUTLET_ATTRIBUTES}
    return with_products(outlet_shares(shelves), outlet_products, keys).orderBy(F.desc("revenue"), "outlet_identifier")


# Name of each segment table and its column.
SEGMENT_TABLES = {
    "outlet_type": "outlet_type", "tier": "outlet_location_type", "outlet_size": "outlet_size",
    "fat_content": "item_fat_content",
}


@report("p_segments_4")
def segment_tables(segment_stores: DataFrame) -> DataFrame:
    """All four segment tables from one pass over the sums per store and segment."""
    labels = F.array(*[F.struct(F.lit(t).alias("dimension"), F.col(c).alias("label")) for t, c in SEGMENT_TABLES.items()])
    keys = ["outlet_identifier", *SEGMENT_TABLES.values()]
    stores = segment_stores.groupBy(*keys).agg(R.records(), R.total("sales").alias("sales"), R.total("rating").alias("rating"))
    # Rows are summed per store first, so only that small table is multiplied by the four dimensions.
    summary = stores.select("outlet_identifier", "records", "sales", "rating", F.inline(labels)).groupBy("dimension", "label").agg(
        R.stores(), R.records(), revenue4(R), *averages4("sales", "rating", mean=R.mean))
    whole = F.sum("revenue").over(Window.partitionBy("dimension"))
    return summary.withColumns({
        "pct_of_revenue": percent(F.col("revenue"), whole),
        "revenue_per_store": F.round(quotient(F.col("revenue"), F.col("stores")), 2),
    }).orderBy("dimension", F.desc("revenue"), "label")


def segment_table(tables: DataFrame, name: str) -> DataFrame:
    """One of the four, with its own column name instead of `label`."""
    return tables.where(F.col("dimension") == name).withColumnRenamed("label", SEGMENT_TABLES[name]).drop("dimension")


@report("p_monthly")
def monthly(cells: DataFrame) -> DataFrame:
    summary = summarise(cells, ["order_year_month"], R.records(), revenue4(R), *averages4("sales", "rating", mean=R.mean))
    order = Window.orderBy("order_year_month")
    last3 = order.rowsBetween(-2, 0)
    now, before = F.col("revenue"), F.lag("revenue").over(order)
    return summary.withColumns({
        "prev_month": before,
        "mom_pct": growth(now, before),
        "moving_avg_3m": F.round(quotient(F.sum("revenue").over(last3), F.count("revenue").over(last3)), 2),
        "running_total": F.round(F.sum("revenue").over(order.rowsBetween(*SO_FAR)), 2),
        "yoy_pct": growth(now, F.lag("revenue", 12).over(order)),
    }).orderBy("order_year_month")


@report("p_yearly")
def yearly(cells: DataFrame) -> DataFrame:
    summary = summarise(cells, ["order_year"], R.records(), revenue4(R), *averages4("sales", "rating", mean=R.mean))
    order = Window.orderBy("order_year")
    return summary.withColumns({
        "yoy_growth_pct": growth(F.col("revenue"), F.lag("revenue").over(order)),
        "basket_growth_pct": growth_of_means(F.col("avg_sale"), F.lag("avg_sale").over(order)),
    }).orderBy("order_year")


@report("p_seasonality")
def seasonality(cells: DataFrame) -> DataFrame:
    summary = summarise(cells, ["order_month", "order_month_name"], revenue4(R), *averages4("sales", mean=R.mean))
    everything = Window.partitionBy()
    rows, whole = F.count(F.lit(1)).over(everything), F.sum("revenue").over(everything)
    return summary.withColumns({
        "pct_of_revenue": share_of_all("revenue"),
        "seasonality_index": F.round(quotient(F.col("revenue") * rows, whole), 3),
    }).orderBy("order_month")


@table("product_stats")
def ranked_products(products: DataFrame) -> DataFrame:
    """One row per (item, category) with its quadrant and its place by revenue."""
    sums = ["records", "sales", "rating", "item_visibility"]
    rolled = products.groupBy("item_identifier", "item_type").agg(*[F.sum(c).alias(c) for c in sums])
    averages = {"avg_sale": "sales", "avg_rating": "rating", "avg_visibility": "item_visibility"}
    stats = rolled.select(
        "item_identifier", "item_type", F.col("records").alias("outlets_stocked"), F.round("sales", 4).alias("revenue"),
        *[mean_from(F.col(c), F.col("records"), c, 4).alias(a) for a, c in averages.items()])
    bench = product_bench(stats, "revenue", "avg_rating", (10, 10))
    labelled = stats.withColumn("segment", quadrant(F.col("revenue"), F.col("avg_rating"), bench, SEGMENT_NAMES))
    return with_row_number(labelled, [-F.col("revenue"), F.col("item_identifier"), F.col("item_type")], "revenue_rank")


@report("p_products")
def products(product_stats: DataFrame) -> DataFrame:
    return product_stats


@report("p_top_bottom")
def top_and_bottom(product_stats: DataFrame, n: int = 10, min_outlets: int = 3) -> DataFrame:
    stats = product_stats.drop("revenue_rank")
    best = top(stats, n, F.desc("revenue"), "item_identifier", "item_type")
    worst = top(stats.where(F.col("outlets_stocked") >= min_outlets), n, "revenue", "item_identifier", "item_type")
    return best.withColumn("list", F.lit("top")).unionByName(worst.withColumn("list", F.lit("bottom")))


@report("p_segments")
def segments(product_stats: DataFrame) -> DataFrame:
    summary = product_stats.groupBy("segment").agg(
        F.count(F.lit(1)).alias("products"), F.round(F.sum("revenue"), 2).alias("revenue"),
        mean_of("avg_rating", 2).alias("avg_rating"))
    return summary.withColumn("pct_of_revenue", share_of_all("revenue")).orderBy("segment")


@report("p_abc")
def abc(product_stats: DataFrame) -> DataFrame:
    return abc_classes(product_stats.select("item_identifier", "item_type", F.col("revenue").alias("_sales"))).select(
        F.col("abc_class").alias("abc"), "products", F.col("_sales").alias("revenue"),
        share_of_all("products").alias("pct_of_products"), share_of_all("_sales").alias("pct_of_revenue"),
    ).orderBy("abc")


@report("p_sales_bands")
def sales_bands(fact: DataFrame) -> DataFrame:
    """A limit belongs to the band below it; amounts of zero or less have no band."""
    label = bands.band(F.col("sales"), bands.SALES_LIMITS, bands.SALES_LABELS_COMPACT, closed="right")
    summary = fact.where(F.col("sales") > 0).groupBy(label.alias("sales_band")).agg(M.records(), revenue4())
    return summary.withColumns({
        "pct_of_records": share_of_all("records"), "pct_of_revenue": share_of_all("revenue")}).orderBy("sales_band")


@report("p_rating_dist")
def rating_distribution(ratings: DataFrame) -> DataFrame:
    label = bands.band(F.col("stars"), bands.RATING_LIMITS, bands.RATING_LABELS_COMPACT)
    summary = ratings.groupBy(label.alias("rating_band")).agg(R.records(), R.revenue(), R.avg_sale())
    return summary.withColumn("pct_of_records", share_of_all("records")).orderBy("rating_band")


QUINTILES = {"e1": 20, "e2": 40, "e3": 60, "e4": 80}


@report("p_visibility_quintiles")
def visibility_quintiles(fact: DataFrame) -> DataFrame:
    """Fifths of the value range by interpolated quantiles; an edge belongs to the fifth below it."""
    edges = one_row(quantiles_interpolated(fact, "item_visibility", QUINTILES))
    banded = fact.select("sales", "rating", "item_visibility").withColumn("_edges", edges)
    fifth = sum((F.when(F.col("item_visibility") > F.col(f"_edges.{e}"), 1).otherwise(0) for e in QUINTILES), F.lit(1))
    return banded.groupBy(fifth.cast("string").alias("vis_quintile")).agg(
        M.records(), *averages4("item_visibility", "sales"), revenue4(), *averages4("rating")).orderBy("vis_quintile")


@report("p_pivot_format")
def category_by_format(cells: DataFrame) -> DataFrame:
    formats = list(FORMAT_COLUMNS)
    pivoted = cells.groupBy("item_type").pivot("outlet_type", formats).agg(R.total("sales")).fillna(0)
    return pivoted.select("item_type", *[F.round(f"`{f}`", 0).alias(f) for f in formats]).orderBy("item_type")


def all_years(fact: DataFrame) -> tuple[int, ...]:
    """Order years present; a handful of partition values."""
    return tuple(sorted(r[0] for r in fact.select("order_year").distinct().collect()))


def _growth_table(pivoted: DataFrame, keys: list[str], years: tuple[int, ...], compared: tuple[int, int] | None) -> DataFrame:
    """Growth between the compared years, by default the first two; NULL if the table lacks one of them."""
    old, new = compared or (*years, None, None)[:2]
    known = old in years and new in years
    change = growth(F.col(f"rev_{new}"), F.col(f"rev_{old}")) if known else F.lit(None).cast("decimal(38,2)")
    return pivoted.select(*keys, *[F.round(f"rev_{y}", 2).alias(f"rev_{y}") for y in years], change.alias("growth_pct")).orderBy(
        F.desc("growth_pct"), *keys)


@report("p_outlet_growth")
def outlet_growth(outlets: DataFrame, compared: tuple[int, int] | None = None) -> DataFrame:
    years, keys = all_years(outlets), ["outlet_identifier", "outlet_type"]
    revenue = [F.sum(F.when(F.col("order_year") == y, F.col("sales"))).alias(f"rev_{y}") for y in years]
    return _growth_table(outlets.groupBy(*keys).agg(*revenue), keys, years, compared)


@report("p_category_growth")
def category_growth(cells: DataFrame, compared: tuple[int, int] | None = None) -> DataFrame:
    years = all_years(cells)
    return _growth_table(year_columns(cells, {"item_type": "item_type"}, years), ["item_type"], years, compared)


@report("p_weekday")
def weekday(cells: DataFrame) -> DataFrame:
    return cells.groupBy(day_type()).agg(R.records(), R.revenue(), R.avg_sale()).orderBy("day_type")


def aggregate_tables(workspace) -> dict[str, DataFrame]:
    """All aggregate tables by name."""
    segment_rows = catalog.call(every_segment, workspace)
    lists = catalog.call(top_and_bottom, workspace)
    builders = {
        "kpis": kpis, "category": category, "outlet": outlet, "monthly": monthly, "yearly": yearly,
        "seasonality": seasonality, "products": products, "segments": segments, "abc": abc, "sales_bands": sales_bands,
        "rating_dist": rating_distribution, "visibility_quintiles": visibility_quintiles, "outlet_growth": outlet_growth,
        "category_growth": category_growth, "weekday": weekday,
    }
    formats = {f: f.lower().replace(" ", "_") for f in FORMAT_COLUMNS}
    return {
        **{name: catalog.call(build, workspace) for name, build in builders.items()},
        **{name: segment_table(segment_rows, name) for name in SEGMENT_TABLES},
        "top_products": lists.where(F.col("list") == "top").drop("list"),
        "bottom_products": lists.where(F.col("list") == "bottom").drop("list"),
        "cat_by_outlet_type": category_by_format(workspace.cells()).withColumnsRenamed(formats),
    }


@report("sink_aggregates")
def stored_aggregates(workspace) -> DataFrame:
    """Write every aggregate table, read each back, count it and add up its revenue where it has one."""
    folder = workspace.path("aggregates")
    files.write_aggregates(aggregate_tables(workspace), folder)
    result = None
    for name, table in files.read_aggregates(workspace.spark, folder).items():
        revenue = F.sum(F.col("revenue").cast("decimal(30,4)")) if "revenue" in table.columns else F.lit(None).cast("decimal(30,4)")
        counted = table.agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
            F.round(revenue, 0).cast("decimal(30,0)").alias("revenue"))
        result = counted if result is None else result.unionByName(counted)
    return result


@table("segment_rows")
def all_segments(segment_stores: DataFrame) -> DataFrame:
    """The four segment tables in one, from one pass over the sums per store and segment."""
    return segment_tables(segment_stores)


@table("segment_stores")
def sums_per_store_and_segment(fact: DataFrame) -> DataFrame:
    """Rows, sales and rating per store and labels of the segment tables: a row or two per store, whatever it sells."""
    return fact.groupBy("outlet_identifier", *SEGMENT_TABLES.values()).agg(
        M.records(), total("sales").alias("sales"), total("rating").alias("rating"))


def every_segment(segment_rows: DataFrame) -> DataFrame:
    return segment_rows


@report("p_facts")
def headline_facts(facts: DataFrame) -> DataFrame:
    return facts


@table("facts")
def facts_row(
    fact: DataFrame, products: DataFrame, outlets: DataFrame, shelves: DataFrame, cells: DataFrame, product_stats: DataFrame,
    segment_rows: DataFrame,
) -> DataFrame:
    """One record of headline figures, each taken from one of the aggregate tables."""
    # The first field is the label; it decides between equal amounts.
    def first(by: Column, *fields: str) -> list[Column]:
        return [F.max_by(f, F.struct(by, F.col(fields[0]))).alias(f"top_{f}") for f in fields]

    def last(by: Column, *fields: str) -> list[Column]:
        return [F.min_by(f, F.struct(by, F.col(fields[0]))).alias(f"end_{f}") for f in fields]

    types, tiers, sizes, fat = (segment_table(segment_rows, name) for name in SEGMENT_TABLES)
    # Products per store are not asked for here, so the stores come from the smaller roll-up.
    cat, out = category(products), outlet_shares(shelves)
    months, years, vis = seasonality(cells), yearly(cells), visibility_quintiles(fact)
    stats = product_stats
    revenue, per_store = F.col("revenue"), F.col("revenue_per_store")
    place = F.row_number().over(Window.orderBy(F.desc("revenue"), "item_type"))
    low = F.col("avg_rating") < F.lit("3.5").cast("decimal(3,2)")

    def where(column: str, value: str, field: str, alias: str) -> Column:
        return F.max(F.when(F.col(column) == value, F.col(field))).alias(alias)

    one_rows = {
        "cat": cat.withColumn("_place", place).agg(
            *first(revenue, "item_type", "pct_of_revenue"), *last(revenue, "item_type", "pct_of_revenue"),
            F.sum(F.when(F.col("_place") <= 3, F.col("pct_of_revenue"))).alias("top3"),
            F.max_by("item_type", F.struct("avg_sale", "item_type")).alias("premium"), F.max("avg_sale").alias("premium_avg_sale")),
        "out": out.agg(*first(revenue, "outlet_identifier", "pct_of_revenue", "outlet_type"),
                       *last(revenue, "outlet_identifier", "pct_of_revenue")),
        "fmt": types.agg(*first(per_store, "outlet_type", "revenue_per_store"),
                         where("outlet_type", "Grocery Store", "revenue_per_store", "grocery")),
        "tier": tiers.agg(*first(per_store, "outlet_location_type", "revenue_per_store"), *last(per_store, "outlet_location_type")),
        "size": sizes.agg(*first(per_store, "outlet_size")),
        "vis": vis.agg(where("vis_quintile", "1", "avg_sale", "q1"), where("vis_quintile", "5", "avg_sale", "q5")),
        "abc": abc(product_stats).agg(*[
            F.max(F.when(F.col("abc").startswith("A"), F.col(c))).alias(c) for c in ("products", "pct_of_products", "pct_of_revenue")]),
        "month": months.agg(*first(revenue, "order_month_name", "seasonality_index"), *last(revenue, "order_month_name", "seasonality_index")),
        "year": years.agg(F.max_by("yoy_growth_pct", "order_year").alias("yoy"), F.max_by("basket_growth_pct", "order_year").alias("basket")),
        "prod": stats.agg(
            F.count_if(low).alias("low_count"), F.sum(F.when(low, revenue)).alias("low_revenue"),
            F.count_if(F.col("segment") == "Star").alias("stars"),
            F.count_if(F.col("segment") == "Delist candidate").alias("delist")),
        "day": weekday(cells).agg(where("day_type", "Weekend", "avg_sale", "weekend"), where("day_type", "Weekday", "avg_sale", "weekday")),
        "grow": category_growth(cells).agg(F.max_by("item_type", F.struct("growth_pct", "item_type")).alias("item_type"), F.max("growth_pct").alias("growth_pct")),
        "fat": fat.agg(where("item_fat_content", "Low Fat", "pct_of_revenue", "low_fat")),
    }
    low_revenue = F.coalesce("prod.low_revenue", F.lit(0).cast("decimal(28,4)"))
    base = kpis(fact, products, outlets).select("*", *[one_row(df).alias(name) for name, df in one_rows.items()])
    picked = {
        "total_revenue": "total_revenue", "total_records": "total_records", "total_products": "total_products",
        "avg_sale": "avg_sale", "median_sale": "median_sale", "avg_rating": "avg_rating", "outlets": "total_outlets",
        "top_category": "cat.top_item_type", "top_category_pct": "cat.top_pct_of_revenue",
        "top3_category_share": F.round("cat.top3", 1),
        "weakest_category": "cat.end_item_type", "weakest_category_pct": "cat.end_pct_of_revenue",
        "premium_category": "cat.premium", "premium_avg_sale": "cat.premium_avg_sale",
        "top_outlet": "out.top_outlet_identifier", "top_outlet_pct": "out.top_pct_of_revenue",
        "top_outlet_type": "out.top_outlet_type", "worst_outlet": "out.end_outlet_identifier",
        "worst_outlet_pct": "out.end_pct_of_revenue", "best_format": "fmt.top_outlet_type",
        "best_format_rps": "fmt.top_revenue_per_store", "grocery_rps": "fmt.grocery",
        "format_gap_x": F.round(quotient(F.col("fmt.top_revenue_per_store"), F.col("fmt.grocery")), 1),
        "best_tier": "tier.top_outlet_location_type", "best_tier_rps": "tier.top_revenue_per_store",
        "worst_tier": "tier.end_outlet_location_type", "best_size": "size.top_outlet_size",
        "vis_uplift_pct": growth_of_means(F.col("vis.q5"), F.col("vis.q1"), 1), "vis_q1_avg": "vis.q1", "vis_q5_avg": "vis.q5",
        "a_class_products": "abc.products", "a_class_pct_products": "abc.pct_of_products",
        "a_class_pct_revenue": "abc.pct_of_revenue", "peak_month": "month.top_order_month_name",
        "peak_index": "month.top_seasonality_index", "trough_month": "month.end_order_month_name",
        "trough_index": "month.end_seasonality_index", "yoy_growth": "year.yoy", "basket_growth": "year.basket",
        "low_rated_count": "prod.low_count", "low_rated_revenue": F.round(low_revenue, 2),
        "low_rated_pct": percent(low_revenue, F.col("total_revenue")), "star_products": "prod.stars",
        "delist_products": "prod.delist",
        "weekend_uplift_pct": F.round(
            quotient_of_means((F.col("day.weekend") - F.col("day.weekday")) * 100, F.col("day.weekday")), 1),
        "fastest_growing_category": "grow.item_type", "fastest_growth_pct": "grow.growth_pct",
        "pct_weight_imputed": "pct_weight_imputed", "pct_visibility_imputed": "pct_visibility_imputed",
        "low_fat_share": "fat.low_fat",
    }
    return base.select([(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in picked.items()])


@report("sink_facts_json")
def stored_facts(workspace) -> DataFrame:
    path = workspace.path("facts_json")
    files.write_facts(catalog.call(headline_facts, workspace), path)
    return files.read_facts(workspace.spark, path)
