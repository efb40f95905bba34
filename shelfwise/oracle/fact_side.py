"""Expected results on the fact table: baseline figures, business questions, advanced analyses."""

from __future__ import annotations

from . import values as bands
from .base import (
    N, N_SHARE, PER_STORE, PRODUCTS, REV, SHARE, STORES, avg, big, hu, mean, nested, oracle, pct, ratio, rnd)
from .values import ABC_LABELS, FORMAT_COLUMNS, QUINTILE_LABELS, SEGMENTS, SHORT, SUMMARY_LINES

AVG_SALE, AVG_RATE = avg("sales"), avg("rating")
TIER, OUTLET, CAT = "outlet_location_type AS tier", "outlet_identifier AS outlet", "item_type AS category"


def cases(column: str, limits: list, labels: list[str], op: str = "<") -> str:
    whens = " ".join(f"WHEN {column} {op} {limit} THEN '{label}'" for limit, label in zip(limits, labels))
    return f"CASE {whens} ELSE '{labels[-1]}' END"


def group(keys: list[str], columns: dict[str, str], where: str = "") -> str:
    """SELECT of renamed group keys (`input AS output`) and aggregate columns."""
    inputs = [k.split(" AS ")[0] for k in keys]
    shown = ", ".join([*keys, *[f"{v} AS {k}" for k, v in columns.items()]])
    return f"SELECT {shown} FROM fact {where} GROUP BY {', '.join(inputs)}"


# ------------------------------------------------------------------------ baseline

oracle("eda_kpis", f"""SELECT {REV} AS total_revenue_inr, {N} AS total_sales_records, {PRODUCTS} AS distinct_products,
  count(DISTINCT item_type) AS product_categories, {STORES} AS outlets, count(DISTINCT outlet_type) AS outlet_types,
  count(DISTINCT outlet_location_type) AS location_tiers, count(DISTINCT outlet_size) AS outlet_size_bands,
  {AVG_SALE} AS avg_sales_per_record, {AVG_RATE} AS avg_rating, {avg('item_weight')} AS avg_item_weight_kg,
  {avg('item_visibility', 4)} AS avg_item_visibility, strftime(min(order_date), '%Y-%m-%d') AS first_order_date,
  strftime(max(order_date), '%Y-%m-%d') AS last_order_date, {PER_STORE} AS revenue_per_outlet FROM fact""")
oracle("eda_quantiles", f"""SELECT {AVG_SALE} AS mean_sales, {rnd('max(sales) FILTER (pr <= 0.5)')} AS median_sales,
  {rnd(mean('sales') + ' - max(sales) FILTER (pr <= 0.5)')} AS mean_minus_median,
  {rnd('max(sales) FILTER (pr <= 0.25)')} AS p25, {rnd('max(sales) FILTER (pr <= 0.75)')} AS p75,
  {rnd('max(sales) FILTER (pr <= 0.9)')} AS p90
  FROM (SELECT sales, percent_rank() OVER (ORDER BY sales) AS pr FROM fact)""")
oracle("eda_category", group([CAT], {
    "records": N, "products": PRODUCTS, "revenue": REV, "pct_of_revenue": SHARE, "avg_sale": AVG_SALE, "avg_rating": AVG_RATE}))
OUTLET_KEYS = [OUTLET, "outlet_type", "outlet_size", TIER, "outlet_establishment_year AS opened", "outlet_age_years AS age_years"]
OUTLET_COLUMNS = {
    "records": N, "categories_stocked": "count(DISTINCT item_type)", "revenue": REV, "pct_of_revenue": SHARE,
    "avg_sale": AVG_SALE, "avg_rating": AVG_RATE}
oracle("eda_outlet_master", group(OUTLET_KEYS, OUTLET_COLUMNS))
oracle("eda_format", group(["outlet_type"], {
    "stores": STORES, "records": N, "revenue": REV, "pct_of_revenue": SHARE, "avg_sale": AVG_SALE,
    "revenue_per_store": PER_STORE, "avg_rating": AVG_RATE}))
oracle("eda_tier", group([TIER], {
    "stores": STORES, "records": N, "revenue": REV, "pct_of_revenue": SHARE, "avg_sale": AVG_SALE, "revenue_per_store": PER_STORE}))
oracle("eda_size", group(["outlet_size"], {
    "stores": STORES, "revenue": REV, "pct_of_revenue": SHARE, "avg_sale": AVG_SALE, "revenue_per_store": PER_STORE}))
oracle("eda_fat", group(["item_fat_content"], {
    "records": N, "revenue": REV, "pct_of_revenue": SHARE, "avg_sale": AVG_SALE, "avg_rating": AVG_RATE}))
oracle("eda_sales_bands", group([cases("sales", bands.SALES_LIMITS, bands.SALES_LABELS) + " AS sales_band"], {
    "records": N, "pct_of_records": N_SHARE, "revenue": REV, "pct_of_revenue": SHARE}))
oracle("eda_rating_bands", group([cases("rating", bands.RATING_LIMITS, bands.RATING_LABELS) + " AS rating_band"], {
    "records": N, "pct_of_records": N_SHARE, "revenue": REV, "avg_sale": AVG_SALE}))


def tiled(k: int) -> str:
    return f"""t AS (SELECT sales, rating, item_visibility,
      ntile({k}) OVER (ORDER BY item_visibility, sales, rating) AS tile FROM fact)"""


oracle("eda_visibility_deciles", f"""SELECT tile AS visibility_decile, {N} AS records,
  {rnd('min(item_visibility)', 4)} AS min_visibility, {rnd('max(item_visibility)', 4)} AS max_visibility,
  {AVG_SALE} AS avg_sale, {REV} AS revenue FROM t GROUP BY tile""", tiled(10))
unknown = "count(*) FILTER (outlet_size = 'Unknown')"
oracle("eda_dq_footprint", f"""SELECT {N} AS total_rows, {big('sum(item_weight_imputed)')} AS imputed_weights,
  {pct('sum(item_weight_imputed)', N)} AS pct_imputed_weight, {big('sum(item_visibility_imputed)')} AS imputed_visibility,
  {pct('sum(item_visibility_imputed)', N)} AS pct_imputed_visibility, {unknown} AS rows_unknown_size,
  {pct(unknown, N)} AS pct_unknown_size FROM fact""")
PERIOD = {"records": N, "revenue": REV, "avg_sale": AVG_SALE, "avg_rating": AVG_RATE}
oracle("eda_monthly", group(["order_year_month AS year_month"], PERIOD))
oracle("eda_yearly", group(["order_year AS year"], PERIOD))
DAY = "CASE is_weekend WHEN 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type"
oracle("eda_weekend", group([DAY], {"records": N, "revenue": REV, "avg_sale": AVG_SALE}))

# ------------------------------------------------------------------------ products

PROD = f"""prod AS (SELECT item_identifier AS product, item_type AS category, {N} AS outlets_stocked, sum(sales) AS s,
  {mean('sales')} AS a, {mean('rating')} AS g, {REV} AS revenue, {AVG_SALE} AS avg_sale_per_outlet,
  {AVG_RATE} AS avg_rating, {avg('item_visibility', 4)} AS avg_visibility FROM fact GROUP BY item_identifier, item_type)"""
ITEM = "item AS (SELECT item_identifier AS product, sum(sales) AS s FROM fact GROUP BY item_identifier)"
ITEM_MEAN = f"(SELECT {hu('sum(s)', 'count(*)', 8)} FROM item)"
LEAGUE = "product, category, outlets_stocked, revenue, avg_sale_per_outlet, avg_rating"

oracle("q01_top_products", f"SELECT {LEAGUE} FROM prod ORDER BY revenue DESC, product, category LIMIT 10", PROD)
oracle("q02_bottom_products", f"SELECT {LEAGUE} FROM prod WHERE outlets_stocked >= 3 ORDER BY revenue, product, category LIMIT 10", PROD)
oracle("q03_top5_per_category", """SELECT category, rn AS rank_in_category, product, revenue, outlets_stocked, avg_rating FROM r
  WHERE rn <= 5""", PROD + ", r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY s DESC, product) AS rn FROM prod)")
oracle("q04_three_ranks", f"""SELECT product, {rnd('s')} AS revenue, row_number() OVER (ORDER BY s DESC, product) AS row_number_rank,
  rank() OVER (ORDER BY s DESC) AS rank_with_gaps, dense_rank() OVER (ORDER BY s DESC) AS dense_rank_no_gaps,
  ntile(4) OVER (ORDER BY s DESC, product) AS revenue_quartile FROM item ORDER BY row_number_rank LIMIT 20""", ITEM)
oracle("q05_sells_well_rated_badly", f"""SELECT product, category, revenue, avg_rating, outlets_stocked FROM prod
  WHERE avg_rating < 3.5 AND round(s, 2) > {ITEM_MEAN} ORDER BY revenue DESC, product, category LIMIT 15""", f"{PROD}, {ITEM}")
oracle("q06_highest_rated", """SELECT product, category, avg_rating, outlets_stocked, revenue FROM prod WHERE outlets_stocked >= 4
  ORDER BY avg_rating DESC, revenue DESC, product, category LIMIT 10""", PROD)
oracle("q07_lowest_rated", """SELECT product, category, avg_rating, outlets_stocked, revenue AS revenue_at_risk FROM prod
  WHERE outlets_stocked >= 4 ORDER BY avg_rating, product, category LIMIT 10""", PROD)


def abc(table: str, order: str) -> str:
    return f"""run AS (SELECT s, sum(s) OVER (ORDER BY s DESC, {order} ROWS UNBOUNDED PRECEDING) AS upto, sum(s) OVER () AS t
        FROM {table}),
      abc AS (SELECT s, CASE WHEN upto * 100 <= t * 80 THEN '{ABC_LABELS[0]}' WHEN upto * 100 <= t * 95 THEN '{ABC_LABELS[1]}'
        ELSE '{ABC_LABELS[2]}' END AS c FROM run)"""


oracle("q08_abc_pareto", f"""SELECT c AS abc_class, {N} AS products, {N_SHARE} AS pct_of_products, {rnd('sum(s)')} AS revenue,
  {pct('sum(s)', 'sum(sum(s)) OVER ()')} AS pct_of_revenue FROM abc GROUP BY c""", f"{ITEM}, {abc('item', 'product')}")

# ---------------------------------------------------------------------- categories

C = f"c AS (SELECT item_type AS category, sum(sales) AS s, {mean('sales')} AS a, {mean('rating')} AS g, {N} AS records FROM fact GROUP BY 1)"
NET = f"net AS (SELECT {mean('sales')} AS a, {mean('rating')} AS g FROM fact)"
oracle("q09_category_share", group([CAT], {
    "revenue": REV, "pct_of_revenue": SHARE,
    "cumulative_pct": pct("sum(sum(sales)) OVER (ORDER BY sum(sales) DESC)", "sum(sum(sales)) OVER ()"),
    "records": N, "products": PRODUCTS, "avg_sale": AVG_SALE}))
oracle("q10_weakest_categories", group([CAT], {
    "revenue": REV, "pct_of_revenue": SHARE, "products": PRODUCTS, "avg_sale": AVG_SALE, "avg_rating": AVG_RATE})
    + " ORDER BY revenue, category LIMIT 5")
oracle("q11_strategic_role", f"""SELECT category, {rnd('c.a')} AS avg_sale, records, {rnd('s')} AS revenue,
  {rnd('c.a - net.a')} AS vs_overall_avg, CASE
    WHEN c.a > net.a AND records * k < n THEN 'Premium niche - high value, low volume'
    WHEN c.a > net.a THEN 'Star - high value, high volume'
    WHEN records * k > n THEN 'Traffic driver - low value, high volume'
    ELSE 'Review - low value, low volume' END AS strategic_role
  FROM c, net, (SELECT count(*) AS n, count(DISTINCT item_type) AS k FROM fact)""", f"{C}, {NET}")
oracle("q12_popularity", group([CAT], {
    "records": N, "pct_of_records": N_SHARE, "revenue": REV, "pct_of_revenue": SHARE,
    "revenue_vs_volume_gap": rnd(
        hu("sum(sales) * 100", "sum(sum(sales)) OVER ()", 10) + " - " + hu("count(*) * 100", "sum(count(*)) OVER ()", 10))}))
oracle("q13_category_ratings", group([CAT], {
    "avg_rating": AVG_RATE, "worst_rating": rnd("min(rating)", 1), "best_rating": rnd("max(rating)", 1),
    "rating_consistency": "round(stddev_samp(CAST(rating AS DOUBLE)), 2)", "records": N, "revenue": REV}))
oracle("q14_category_x_format", group([CAT], {
    **{c: rnd(f"sum(CASE WHEN outlet_type = '{f}' THEN sales ELSE 0 END)", 0) for f, c in FORMAT_COLUMNS.items()},
    "total": rnd("sum(sales)", 0)}))

# -------------------------------------------------------------------------- stores

STORE = [OUTLET, "outlet_type", "outlet_size", TIER]
oracle("q15_best_stores", group([*STORE, "outlet_establishment_year AS opened"], {
    "revenue": REV, "pct_of_revenue": SHARE, "avg_sale": AVG_SALE, "avg_rating": AVG_RATE,
    "revenue_rank": "rank() OVER (ORDER BY sum(sales) DESC)"}) + " ORDER BY revenue DESC, outlet LIMIT 5")
oracle("q16_worst_stores", group(STORE, {
    "revenue": REV, "avg_sale": AVG_SALE, "records": N, "avg_rating": AVG_RATE,
    "avg_sale_vs_network": rnd(f"{mean('sales')} - (SELECT a FROM net)")}) + " ORDER BY revenue, outlet LIMIT 5", NET)
oracle("q17_revenue_per_store_format", group(["outlet_type"], {
    "stores": STORES, "total_revenue": REV, "revenue_per_store": PER_STORE, "avg_sale": AVG_SALE, "avg_rating": AVG_RATE}))
oracle("q18_tier_performance", group([TIER], {
    "stores": STORES, "revenue": REV, "pct_of_revenue": SHARE, "revenue_per_store": PER_STORE, "avg_sale": AVG_SALE,
    "avg_rating": AVG_RATE}))
oracle("q19_size_performance", group(["outlet_size"], {
    "stores": STORES, "revenue": REV, "pct_of_revenue": SHARE, "revenue_per_store": PER_STORE, "avg_sale": AVG_SALE}))
oracle("q20_store_age", group(["outlet_establishment_year AS opened", "outlet_age_years AS age_years"], {
    "stores": STORES, "revenue": REV, "revenue_per_store": PER_STORE, "avg_sale": AVG_SALE}))
oracle("q21_format_x_tier", group(["outlet_type", TIER], {
    "stores": STORES, "revenue": REV, "revenue_per_store": PER_STORE, "avg_sale": AVG_SALE,
    "opportunity_rank": f"rank() OVER (ORDER BY {hu('sum(sales)', STORES, 8)} DESC)"}))
oracle("q22_assortment_breadth", group([OUTLET, "outlet_type"], {
    "categories_stocked": "count(DISTINCT item_type)", "products_stocked": PRODUCTS, "revenue": REV,
    "revenue_per_product": ratio("sum(sales)", PRODUCTS)}))

# ----------------------------------------------------------- merchandising, quality

labels = "[" + ", ".join(f"'{label}'" for label in QUINTILE_LABELS) + "]"
oracle("q23_visibility_quintiles", f"""SELECT {labels}[tile] AS visibility_band, {N} AS records,
  {avg('item_visibility', 4)} AS avg_visibility, {AVG_SALE} AS avg_sale, {REV} AS revenue, {AVG_RATE} AS avg_rating
  FROM t GROUP BY tile""", tiled(5))
oracle("q24_visibility_uplift", f"""SELECT {rnd('lo')} AS lowest_quintile_avg, {rnd('hi')} AS highest_quintile_avg,
  {rnd('hi - lo')} AS absolute_uplift, {pct('hi - lo', 'lo', 1, 8)} AS pct_uplift
  FROM (SELECT max(a) FILTER (tile = 1) AS lo, max(a) FILTER (tile = 5) AS hi FROM b)""",
  f"{tiled(5)}, b AS (SELECT tile, {mean('sales')} AS a FROM t GROUP BY tile)")
oracle("q25_fat_compare", group(["item_fat_content"], {
    "records": N, "pct_of_records": N_SHARE, "revenue": REV, "pct_of_revenue": SHARE, "avg_sale": AVG_SALE,
    "avg_rating": AVG_RATE}))


def fat(label: str, column: str, other: str = "") -> str:
    return f"CASE WHEN item_fat_content = '{label}' THEN {column} {other} END"


low, regular = (f"sum({fat(x, 'sales', 'ELSE 0')})" for x in ("Low Fat", "Regular"))


def fat_rating(label: str) -> str:
    return ratio(f"sum({fat(label, 'rating')})", f"count({fat(label, 'rating')})", 2, 2)


oracle("q26_fat_by_category", group([CAT], {
    "low_fat_revenue": rnd(low, 0), "regular_revenue": rnd(regular, 0), "low_fat_share_pct": pct(low, "sum(sales)", 1),
    "low_fat_rating": fat_rating("Low Fat"), "regular_rating": fat_rating("Regular")}))
oracle("q27_rating_vs_sales", group([cases("rating", bands.RATING_LIMITS_5, bands.RATING_LABELS_5) + " AS rating_band"], {
    "records": N, "avg_sale": AVG_SALE, "revenue": REV, "pct_of_revenue": SHARE}))
oracle("q28_under_exposed", f"""SELECT product, category, avg_visibility, {rnd('v', 4)} AS network_avg_visibility, revenue, avg_rating,
  outlets_stocked FROM prod, (SELECT {mean('item_visibility')} AS v FROM fact)
  WHERE CAST(avg_visibility AS DECIMAL(12,4)) < v AND round(s, 2) > {ITEM_MEAN}
  ORDER BY revenue DESC, product, category LIMIT 15""", f"{PROD}, {ITEM}")
oracle("q29_weight_profile", group([CAT], {
    "avg_weight_kg": avg("item_weight"), "total_weight_kg": rnd("sum(item_weight)", 0), "revenue": REV,
    "revenue_per_kg": ratio("sum(sales)", "sum(item_weight)"), "rows_with_imputed_weight": big("sum(item_weight_imputed)")}))

# ---------------------------------------------------------------------------- time

M = f"""m AS (SELECT order_year_month AS ym, order_year AS y, order_month AS mo, sum(sales) AS s, {N} AS records,
  {AVG_RATE} AS avg_rating FROM fact GROUP BY 1, 2, 3)"""
BACK = "lag(s) OVER (ORDER BY ym)"


def trailing(first: int, last: str = "CURRENT ROW") -> tuple[str, str]:
    frame = f"OVER (ORDER BY ym ROWS BETWEEN {first} PRECEDING AND {last})"
    return f"sum(s) {frame}", f"count(s) {frame}"


oracle("q30_mom_trend", f"""SELECT ym AS year_month, records, {rnd('s')} AS revenue, {rnd(BACK)} AS prev_month_revenue,
  {rnd(f's - {BACK}')} AS mom_change, {pct(f's - {BACK}', BACK)} AS mom_pct_change FROM m""", M)
oracle("q31_running_total", f"""SELECT ym AS year_month, {rnd('s')} AS monthly_revenue,
  {rnd('sum(s) OVER (ORDER BY ym)')} AS running_total_all_time,
  {rnd('sum(s) OVER (PARTITION BY y ORDER BY ym)')} AS running_total_ytd FROM m""", M)
oracle("q32_moving_avg", f"""SELECT ym AS year_month, {rnd('s')} AS revenue, {ratio(*trailing(2))} AS moving_avg_3m,
  {rnd('s - ' + hu(*trailing(2), 8))} AS deviation_from_trend FROM m""", M)
oracle("q33_yoy_by_month", f"""SELECT m.ym AS year_month, {rnd('m.s')} AS revenue, {rnd('p.s')} AS same_month_last_year,
  {rnd('m.s - p.s')} AS yoy_change, {pct('m.s - p.s', 'p.s')} AS yoy_pct_growth
  FROM m LEFT JOIN m AS p ON p.y = m.y - 1 AND p.mo = m.mo""", M)
back_s, back_a = "lag(s) OVER (ORDER BY y)", "lag(a) OVER (ORDER BY y)"
oracle("q34_full_year", f"""SELECT y AS year, records, {rnd('s')} AS revenue, {rnd('a')} AS avg_sale, avg_rating,
  {pct(f's - {back_s}', back_s)} AS yoy_growth_pct, {pct(f'a - {back_a}', back_a, 2, 8)} AS basket_growth_pct FROM yr""",
  f"yr AS (SELECT order_year AS y, {N} AS records, sum(sales) AS s, {mean('sales')} AS a, {AVG_RATE} AS avg_rating FROM fact GROUP BY 1)")
oracle("q35_seasonality", group(["order_month AS month_no"], {
    "month_name": "max(order_month_name)", "revenue": REV, "avg_sale": AVG_SALE, "pct_of_annual_revenue": SHARE,
    "month_rank": "rank() OVER (ORDER BY sum(sales) DESC)",
    "seasonality_index": ratio("sum(sales) * 12", "sum(sum(sales)) OVER ()")}))
back_q = "lag(sum(sales)) OVER (ORDER BY order_year, order_quarter)"
oracle("q36_quarterly", group(["order_year AS year", "order_quarter AS quarter"], {
    "period": "order_year || '-Q' || order_quarter", "records": N, "revenue": REV, "avg_sale": AVG_SALE,
    "qoq_growth_pct": pct(f"sum(sales) - {back_q}", back_q)}))

# ----------------------------------------------------------------------- strategic


def two_years(key: str) -> str:
    return f"""g AS (SELECT {key}, sum(sales) FILTER (order_year = 1999) AS a, sum(sales) FILTER (order_year = 2000) AS b
      FROM fact GROUP BY ALL)"""


growth10 = hu("(b - a) * 100", "a", 10)
oracle("q37_category_growth", f"""SELECT category, {rnd('a')} AS revenue_1999, {rnd('b')} AS revenue_2000, {rnd('b - a')} AS absolute_growth,
  {pct('b - a', 'a')} AS growth_pct, CASE WHEN {growth10} >= 25 THEN 'Accelerating - invest' WHEN {growth10} >= 10 THEN 'Growing - maintain'
  WHEN {growth10} >= 0 THEN 'Flat - review' ELSE 'Declining - act now' END AS verdict FROM g""", two_years("item_type AS category"))
oracle("q38_store_growth", f"""SELECT outlet, outlet_type, {rnd('a')} AS revenue_1999, {rnd('b')} AS revenue_2000,
  {pct('b - a', 'a')} AS growth_pct, rank() OVER (ORDER BY {hu('(b - a) * 100', 'a', 8)} DESC NULLS LAST) AS growth_rank FROM g""",
  two_years(f"{OUTLET}, outlet_type"))
oracle("q39_store_vs_network", f"""SELECT outlet, category, records, revenue, {rnd('a')} AS store_avg_sale, {rnd('n')} AS network_avg_sale,
  {pct('a - n', 'n', 1, 12)} AS pct_vs_network, CASE WHEN a < n * 0.80 THEN 'Underperforming - investigate'
  WHEN a > n * 1.20 THEN 'Outperforming - learn from it' ELSE 'In line' END AS flag
  FROM cell JOIN (SELECT category, {hu('sum(a)', 'count(*)', 12, 8)} AS n FROM cell GROUP BY 1) USING (category) WHERE records >= 15
  ORDER BY pct_vs_network, outlet, category LIMIT 20""",
  f"cell AS (SELECT {OUTLET}, {CAT}, {N} AS records, {REV} AS revenue, {mean('sales')} AS a FROM fact GROUP BY ALL)")


def grouped_digits(expr: str, digits: int) -> str:
    """Number as text with thousands separators; `expr` is a decimal."""
    return f"format('{{:,.{digits}f}}', CAST(round({expr}, {digits}) AS DOUBLE))"


def leader(column: str, amount: str) -> str:
    return f"(SELECT {column} FROM fact GROUP BY {column} ORDER BY {amount} DESC, {column} LIMIT 1)"


values = [
    grouped_digits("(SELECT sum(sales) FROM fact)", 2), grouped_digits("(SELECT count(*) FROM fact)", 0),
    grouped_digits(f"(SELECT {mean('sales')} FROM fact)", 2), grouped_digits(f"(SELECT {mean('rating')} FROM fact)", 2),
    f"(SELECT {PRODUCTS} || ' / ' || count(DISTINCT item_type) FROM fact)", f"(SELECT CAST({STORES} AS VARCHAR) FROM fact)",
    leader("item_type", "sum(sales)"), leader("outlet_identifier", "sum(sales)"),
    leader("outlet_type", hu("sum(sales)", STORES, 12)), leader("order_month_name", "sum(sales)"),
]
oracle("q40_exec_summary", " UNION ALL ".join(
    f"SELECT '{metric}' AS metric, {value} AS value, '{why}' AS why_it_matters"
    for (metric, why), value in zip(SUMMARY_LINES.items(), values)))

# ------------------------------------------------------------------------ advanced

BENCH = f"bench AS (SELECT {hu('sum(s)', 'count(*)', 8)} AS r, {hu('sum(g)', 'count(*)', 10, 6)} AS q FROM prod)"


def quadrant(labels: dict, revenue: str = "s", rating: str = "g") -> str:
    return f"""CASE WHEN {revenue} >= r AND {rating} >= q THEN '{labels[True, True]}' WHEN {revenue} >= r THEN '{labels[True, False]}'
      WHEN {rating} >= q THEN '{labels[False, True]}' ELSE '{labels[False, False]}' END"""


names, actions = ({k: v[i] for k, v in SEGMENTS.items()} for i in (0, 1))
oracle("a01_segmentation", f"""SELECT {quadrant(names)} AS segment, {N} AS products, {rnd('sum(s)')} AS revenue,
  {pct('sum(s)', 'sum(sum(s)) OVER ()')} AS pct_of_revenue, {ratio('sum(g)', 'count(*)', 2, 6)} AS avg_rating,
  {quadrant(actions)} AS recommended_action FROM prod, bench GROUP BY 1, 6""", f"{PROD}, {BENCH}")
oracle("a02_outlet_scorecard", f"""SELECT outlet, outlet_type, tier, {rnd('s')} AS revenue,
  ntile(4) OVER (ORDER BY s DESC, outlet, outlet_type, outlet_size, tier) AS revenue_quartile,
  {pct('below', 'n - 1', 1)} AS revenue_percentile, {pct('below + ties', 'n', 1)} AS cumulative_dist,
  {rnd('a')} AS avg_sale, rank() OVER (ORDER BY a DESC) AS basket_rank, {rnd('g')} AS avg_rating, gr AS rating_rank,
  CASE WHEN sr <= 3 AND gr <= 5 THEN 'Benchmark store - replicate' WHEN sr <= 3 THEN 'High revenue, weak satisfaction - audit service'
    WHEN gr <= 3 THEN 'Loved but small - growth headroom' ELSE 'Standard performer' END AS verdict FROM k""",
  f"""o AS (SELECT {OUTLET}, outlet_type, outlet_size, {TIER}, sum(sales) AS s, {mean('sales')} AS a, {mean('rating')} AS g
    FROM fact GROUP BY ALL),
  k AS (SELECT *, rank() OVER (ORDER BY s) - 1 AS below, count(*) OVER (PARTITION BY s) AS ties, count(*) OVER () AS n,
    rank() OVER (ORDER BY s DESC) AS sr, rank() OVER (ORDER BY g DESC) AS gr FROM o)""")
oracle("a03_top3_rank_compare", f"""SELECT category, product, revenue, {pct('s', 'whole')} AS pct_of_category, rn AS "row_number",
  rk AS rank_with_gaps, dr AS "dense_rank" FROM r WHERE rn <= 3""",
  PROD + """, r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY s DESC, product) AS rn,
    rank() OVER (PARTITION BY category ORDER BY s DESC) AS rk, dense_rank() OVER (PARTITION BY category ORDER BY s DESC) AS dr,
    sum(s) OVER (PARTITION BY category) AS whole FROM prod)""")
oracle("a04_contribution_curve", f"""SELECT rank_no, category, {rnd('s')} AS revenue, {pct('s', 't')} AS pct_of_total,
  {rnd('upto')} AS running_total, {pct('upto', 't')} AS cumulative_pct, CASE WHEN upto * 100 <= t * 80 THEN 'Core - protect'
  WHEN upto * 100 <= t * 95 THEN 'Secondary - maintain' ELSE 'Tail - review' END AS tier FROM run""",
  C + """, run AS (SELECT category, s, row_number() OVER w AS rank_no, sum(s) OVER (w ROWS UNBOUNDED PRECEDING) AS upto,
    sum(s) OVER () AS t FROM c WINDOW w AS (ORDER BY s DESC, category))""")
oracle("a05_first_last", f"""SELECT outlet, top_category, {rnd('hi')} AS top_revenue, {pct('hi', 't', 1)} AS top_pct_of_store,
  bottom_category, {rnd('lo')} AS bottom_revenue, {ratio('hi', 'lo', 1)} AS spread_ratio,
  CASE WHEN hi * 100 > t * 15 THEN 'Concentration risk - one category carries the store' ELSE 'Balanced mix' END AS risk_flag FROM e""",
  f"""sc AS (SELECT {OUTLET}, {CAT}, sum(sales) AS s FROM fact GROUP BY ALL),
  e AS (SELECT DISTINCT outlet, first_value(category) OVER w AS top_category, first_value(s) OVER w AS hi,
    last_value(category) OVER w AS bottom_category, last_value(s) OVER w AS lo, sum(s) OVER (PARTITION BY outlet) AS t FROM sc
    WINDOW w AS (PARTITION BY outlet ORDER BY s DESC, category ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))""")
AHEAD = "lead(s) OVER (ORDER BY ym)"
oracle("a06_timeline", f"""SELECT ym AS year_month, {rnd('s')} AS revenue, {rnd(BACK)} AS prev_month, {pct(f's - {BACK}', BACK, 1)} AS mom_pct,
  {rnd(AHEAD)} AS next_month, {pct(f'{AHEAD} - s', 's', 1)} AS next_month_pct, {ratio(*trailing(2))} AS moving_avg_3m,
  {ratio(*trailing(5))} AS moving_avg_6m, {ratio(*trailing(1, '1 FOLLOWING'))} AS centred_avg_3m,
  CASE WHEN s > {hu(*trailing(2), 8)} THEN 'Above trend' ELSE 'Below trend' END AS trend_position FROM m""", M)
oracle("a07_vs_network", f"""SELECT category, {rnd('s')} AS revenue, {rnd('c.a')} AS avg_sale, {rnd('net.a')} AS network_avg_sale,
  {rnd('c.a - net.a')} AS vs_network, {pct('c.a - net.a', 'net.a', 1, 8)} AS pct_vs_network, {rnd('c.g')} AS avg_rating,
  {rnd('net.g')} AS network_avg_rating, CASE WHEN c.a > net.a AND c.g > net.g THEN 'Outperforms on both'
  WHEN c.a > net.a THEN 'Commercially strong, satisfaction lags' WHEN c.g > net.g THEN 'Well liked, commercially weak'
  ELSE 'Underperforms on both' END AS assessment FROM c, net""", f"{C}, {NET}")
oracle("a08_vs_own_category", f"""SELECT product, category, revenue AS product_revenue, {rnd('p')} AS category_avg_revenue,
  {pct('s - p', 'p', 1, 8)} AS pct_above_category, outlets_stocked, avg_rating
  FROM (SELECT *, (SELECT {hu('sum(i.s)', 'count(*)', 8)} FROM prod i WHERE i.category = o.category) AS p FROM prod o)
  ORDER BY pct_above_category DESC, product, category LIMIT 15""", PROD)
oracle("a09_store_pairs", f"""SELECT a.item_identifier AS product, a.item_type AS category, a.outlet_identifier AS strong_outlet,
  {rnd('a.sales')} AS strong_sales, {rnd('a.item_visibility', 4)} AS strong_visibility, b.outlet_identifier AS weak_outlet,
  {rnd('b.sales')} AS weak_sales, {rnd('b.item_visibility', 4)} AS weak_visibility, {rnd('a.sales - b.sales')} AS sales_gap,
  {ratio('a.sales', 'b.sales', 1)} AS sales_multiple,
  CASE WHEN a.item_visibility > b.item_visibility * 1.5 THEN 'Likely shelf placement - weak store gives it far less space'
    WHEN a.outlet_type <> b.outlet_type THEN 'Store format difference - may be structural'
    ELSE 'Same format, similar visibility - investigate execution locally' END AS probable_cause
  FROM fact a JOIN fact b ON a.item_identifier = b.item_identifier AND a.outlet_identifier <> b.outlet_identifier AND a.sales > 3 * b.sales
  ORDER BY a.sales - b.sales DESC, product, strong_outlet, strong_visibility, weak_outlet, weak_visibility LIMIT 15""")
oracle("a10_distribution_gaps", f"""SELECT product AS proven_product, category, {rnd('s')} AS product_revenue,
  o.outlet_identifier AS missing_from_outlet, o.outlet_type, o.outlet_location_type AS tier,
  'Distribution gap - list this product here' AS action FROM best, (SELECT DISTINCT outlet_identifier, outlet_type, outlet_location_type FROM fact) o
  WHERE NOT EXISTS (SELECT 1 FROM fact f WHERE f.item_identifier = product AND f.outlet_identifier = o.outlet_identifier)
  ORDER BY s DESC, product, category, o.outlet_identifier LIMIT 25""",
  PROD + ", best AS (SELECT * FROM prod ORDER BY s DESC, product, category LIMIT 20)")
oracle("a11_month_spine", f"""SELECT strftime(d, '%Y-%m') AS year_month, coalesce(records, 0) AS records, {rnd('coalesce(s, 0)')} AS revenue,
  CASE WHEN records IS NULL THEN 'NO DATA - investigate' ELSE 'OK' END AS data_check
  FROM spine LEFT JOIN m ON ym = strftime(d, '%Y-%m')""",
  M + """, spine AS (SELECT unnest(generate_series(date_trunc('month', min(order_date)), date_trunc('month', max(order_date)),
    INTERVAL 1 MONTH)) AS d FROM fact)""")

# --------------------------------------------------------------------------- views

oracle("v1_category_performance", group([CAT], {
    "records": N, "products": PRODUCTS, "revenue": REV, "pct_of_revenue": SHARE, "avg_sale": AVG_SALE, "avg_rating": AVG_RATE,
    "avg_visibility": avg("item_visibility", 4), "avg_weight_kg": avg("item_weight")}))
oracle("v2_outlet_scorecard", group(OUTLET_KEYS, {**OUTLET_COLUMNS, "products_stocked": PRODUCTS}))
oracle("v3_monthly_trend", f"""SELECT ym AS year_month, y AS year, mo AS month_no, records, {rnd('s')} AS revenue, avg_rating,
  {rnd(BACK)} AS prev_month_revenue, {pct(f's - {BACK}', BACK)} AS mom_pct_change, {ratio(*trailing(2))} AS moving_avg_3m,
  {rnd('sum(s) OVER (ORDER BY ym)')} AS running_total FROM m""", M)
oracle("v4_product_master", f"""SELECT item_identifier AS product, item_type AS category, item_fat_content AS fat_content,
  outlets_stocked, {rnd('s')} AS revenue, avg_sale, {rnd('g')} AS avg_rating, avg_visibility,
  rank() OVER (ORDER BY s DESC) AS revenue_rank_overall, rank() OVER (PARTITION BY item_type ORDER BY s DESC) AS revenue_rank_in_category,
  ntile(4) OVER (ORDER BY s DESC, item_identifier, item_type, item_fat_content) AS revenue_quartile,
  {quadrant(SHORT)} AS segment FROM prod, bench""",
  f"""prod AS (SELECT item_identifier, item_type, item_fat_content, {N} AS outlets_stocked, sum(sales) AS s, {AVG_SALE} AS avg_sale,
    {mean('rating')} AS g, {avg('item_visibility', 4)} AS avg_visibility FROM fact GROUP BY ALL), {BENCH}""")
oracle("v5_executive_kpis", f"""SELECT {REV} AS total_revenue, {N} AS total_records, {PRODUCTS} AS total_products,
  count(DISTINCT item_type) AS total_categories, {STORES} AS total_outlets, {AVG_SALE} AS avg_sale, {AVG_RATE} AS avg_rating,
  {avg('item_visibility', 4)} AS avg_visibility, strftime(min(order_date), '%Y-%m-%d') AS period_start,
  strftime(max(order_date), '%Y-%m-%d') AS period_end FROM fact""")


def preview(view: str, source: str, key: str, amount: str, order: str, n: int) -> str:
    return f"(SELECT '{view}' AS view_name, {key} AS row_key, {amount} AS revenue FROM {nested(source)} ORDER BY {order} LIMIT {n})"


oracle("v_smoke", " UNION ALL ".join([
    preview("vw_executive_kpis", "v5_executive_kpis", "'all'", "total_revenue", "1", 1),
    preview("vw_category_performance", "v1_category_performance", "category", "revenue", "revenue DESC, category", 5),
    preview("vw_outlet_scorecard", "v2_outlet_scorecard", "outlet", "revenue", "revenue DESC, outlet", 5),
    preview("vw_monthly_trend", "v3_monthly_trend", "year_month", "revenue", "year_month", 6),
    preview("vw_product_master", "v4_product_master", "product", "revenue", "revenue DESC, product, category, fat_content", 5)]))

# ----------------------------------------------------------------------- deep dive

HERE = "WHERE item_type = 'LARGE'"
oracle("a13_guard", """SELECT 'Category not found: Not A Real Category' AS error_message,
  string_agg(item_type, ', ' ORDER BY item_type) AS valid_categories FROM (SELECT DISTINCT item_type FROM fact)
  WHERE NOT EXISTS (SELECT 1 FROM fact WHERE item_type = 'Not A Real Category')""")
oracle("a13_headline", f"""SELECT 'LARGE' AS category, {REV} AS revenue, {pct('sum(sales)', '(SELECT sum(sales) FROM fact)')} AS pct_of_business,
  {N} AS records, {PRODUCTS} AS products, {AVG_SALE} AS avg_sale, {AVG_RATE} AS avg_rating FROM fact {HERE}""")
oracle("a13_top_products", group(["item_identifier AS product"], {
    "revenue": REV, "outlets_stocked": N, "avg_rating": AVG_RATE}, HERE) + " ORDER BY revenue DESC, product LIMIT 10")
oracle("a13_stores", group([OUTLET, "outlet_type"], {"revenue": REV, "avg_sale": AVG_SALE}, HERE))
oracle("a13_trend", group(["order_year_month AS year_month"], {"revenue": REV, "records": N}, HERE))
oracle("a13_deep_dive", " UNION ALL ".join(
    f"SELECT '{part}' AS part, {key} AS row_key, revenue FROM {nested('a13_' + part)}"
    for part, key in (("headline", "category"), ("top_products", "product"), ("stores", "outlet"), ("trend", "year_month"))))
oracle("a14_range_filter", """SELECT count(*) FILTER (order_date >= DATE '2000-01-01' AND order_date < DATE '2001-01-01') AS range_rows,
  count(*) FILTER (year(order_date) = 2000) AS partition_rows FROM fact""")
