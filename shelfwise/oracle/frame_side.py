"""Expected results of the second set of aggregates and of the dashboard tables."""

from __future__ import annotations

from . import values as bands
from .base import N, N_SHARE, PARTS, PRODUCTS, REV, SHARE, STORES, avg, dbl, hu, mean, nested, oracle, pct, ratio, rnd
from .fact_side import DAY, abc, cases, group, grouped_digits, quadrant
from .values import CARDS, EMPTY_CHOICE, EXAMPLE_CHOICE, FORMAT_COLUMNS, SEGMENT_TABLES, SHORT, SINGLE_CHOICE

YEARS = range(1995, 2002)
REV4 = rnd("sum(sales)", 4)


def avg4(*names: str) -> dict[str, str]:
    alias = {"sales": "avg_sale", "rating": "avg_rating", "item_visibility": "avg_visibility", "item_weight": "avg_weight"}
    return {alias[n]: avg(n, 4) for n in names}


def dec4(column: str) -> str:
    """Average rounded to four decimals, as a decimal."""
    unit = {"sales": 4, "rating": 2, "item_visibility": 6, "item_weight": 3}[column]
    return hu(f"sum({column})", f"count({column})", 4, unit)


oracle("p_share", group(["item_type"], {"revenue": REV4, "pct_of_total": SHARE}))

oracle("p_kpis", f"""SELECT {REV} AS total_revenue, {N} AS total_records, {PRODUCTS} AS total_products,
  count(DISTINCT item_type) AS total_categories, {STORES} AS total_outlets, count(DISTINCT outlet_type) AS total_outlet_types,
  count(DISTINCT outlet_location_type) AS total_tiers, {avg('sales')} AS avg_sale,
  (SELECT {ratio('sum(sales)', 'count(*)')} FROM mid) AS median_sale, {avg('rating')} AS avg_rating,
  {avg('item_weight')} AS avg_weight, {avg('item_visibility', 4)} AS avg_visibility,
  {ratio('sum(sales)', STORES)} AS revenue_per_outlet, strftime(min(order_date), '%Y-%m-%d') AS period_start,
  strftime(max(order_date), '%Y-%m-%d') AS period_end, {pct('sum(item_weight_imputed)', N)} AS pct_weight_imputed,
  {pct('sum(item_visibility_imputed)', N)} AS pct_visibility_imputed FROM fact""",
  """ord AS (SELECT sales, row_number() OVER (ORDER BY sales) AS i, count(*) OVER () AS n FROM fact),
  mid AS (SELECT sales FROM ord WHERE i IN ((n + 1) // 2, (n + 2) // 2))""")
CATEGORY = f"""c AS (SELECT item_type, {N} AS records, {PRODUCTS} AS products, sum(sales) AS s, {dec4('sales')} AS a, {dec4('rating')} AS g,
    {dec4('item_visibility')} AS v, {dec4('item_weight')} AS w FROM fact GROUP BY 1),
  share AS (SELECT *, {hu('s * 100', 'sum(s) OVER ()', 2)} AS p FROM c)"""
oracle("p_category", f"""SELECT item_type, records, products, {rnd('s', 4)} AS revenue, {dbl('a')} AS avg_sale, {dbl('g')} AS avg_rating,
  {dbl('v')} AS avg_visibility, {dbl('w')} AS avg_weight, {dbl('p')} AS pct_of_revenue,
  {dbl('sum(p) OVER (ORDER BY s DESC, item_type ROWS UNBOUNDED PRECEDING)')} AS cumulative_pct,
  {ratio('s', 'w * records')} AS revenue_per_kg FROM share""", CATEGORY)
OUTLET_KEYS = ["outlet_identifier", "outlet_type", "outlet_size", "outlet_location_type", "outlet_establishment_year", "outlet_age_years"]
oracle("p_outlet", group(OUTLET_KEYS, {
    "records": N, "revenue": REV4, **avg4("sales", "rating"), "categories_stocked": "count(DISTINCT item_type)",
    "products_stocked": PRODUCTS, "pct_of_revenue": SHARE}))


def segment(column: str, key: str) -> str:
    return group([f"{column} AS {key}"], {
        "stores": STORES, "records": N, "revenue": REV4, **avg4("sales", "rating"), "pct_of_revenue": SHARE,
        "revenue_per_store": ratio("sum(sales)", STORES)})


oracle("p_segments_4", " UNION ALL ".join(
    f"SELECT '{name}' AS dimension, * FROM ({segment(column, 'label')})" for name, column in SEGMENT_TABLES.items()))
M = f"m AS (SELECT order_year_month, {N} AS records, sum(sales) AS s, {avg('sales', 4)} AS avg_sale, {avg('rating', 4)} AS avg_rating FROM fact GROUP BY 1)"
W = "OVER (ORDER BY order_year_month"
oracle("p_monthly", f"""SELECT order_year_month, records, {rnd('s', 4)} AS revenue, avg_sale, avg_rating, {rnd(f'lag(s) {W})', 4)} AS prev_month,
  {pct(f's - lag(s) {W})', f'lag(s) {W})')} AS mom_pct,
  {ratio(f'sum(s) {W} ROWS 2 PRECEDING)', f'count(s) {W} ROWS 2 PRECEDING)')} AS moving_avg_3m, {rnd(f'sum(s) {W})')} AS running_total,
  {pct(f's - lag(s, 12) {W})', f'lag(s, 12) {W})')} AS yoy_pct FROM m""", M)
YEARLY = f"y AS (SELECT order_year, {N} AS records, sum(sales) AS s, {dec4('sales')} AS a, {avg('rating', 4)} AS avg_rating FROM fact GROUP BY 1)"
Y = "OVER (ORDER BY order_year)"
oracle("p_yearly", f"""SELECT order_year, records, {rnd('s', 4)} AS revenue, {dbl('a')} AS avg_sale, avg_rating,
  {pct(f's - lag(s) {Y}', f'lag(s) {Y}')} AS yoy_growth_pct, {pct(f'a - lag(a) {Y}', f'lag(a) {Y}')} AS basket_growth_pct FROM y""", YEARLY)
oracle("p_seasonality", group(["order_month", "order_month_name"], {
    "revenue": REV4, **avg4("sales"), "pct_of_revenue": SHARE,
    "seasonality_index": ratio("sum(sales) * count(*) OVER ()", "sum(sum(sales)) OVER ()", 3)}))

PROD = f"""prod AS (SELECT item_identifier, item_type, {N} AS outlets_stocked, sum(sales) AS s, {avg('sales', 4)} AS avg_sale,
    {dec4('rating')} AS g, {avg('item_visibility', 4)} AS avg_visibility FROM fact GROUP BY 1, 2),
  bench AS (SELECT {hu('sum(s)', 'count(*)', 10)} AS r, {hu('sum(g)', 'count(*)', 10)} AS q FROM prod),
  seg AS (SELECT *, {quadrant(SHORT)} AS segment FROM prod, bench)"""
PRODUCT = f"item_identifier, item_type, outlets_stocked, {rnd('s', 4)} AS revenue, avg_sale, {dbl('g')} AS avg_rating, avg_visibility, segment"
oracle("p_products", f"SELECT {PRODUCT}, row_number() OVER (ORDER BY s DESC, item_identifier, item_type) AS revenue_rank FROM seg", PROD)
oracle("p_top_bottom", f"""(SELECT {PRODUCT}, 'top' AS list FROM seg ORDER BY s DESC, item_identifier, item_type LIMIT 10) UNION ALL
  (SELECT {PRODUCT}, 'bottom' FROM seg WHERE outlets_stocked >= 3 ORDER BY s, item_identifier, item_type LIMIT 10)""", PROD)
SEGMENTS = f"""SELECT segment, {N} AS products, {rnd('sum(s)')} AS revenue, {ratio('sum(g)', 'count(*)')} AS avg_rating,
  {pct('round(sum(s), 2)', 'sum(round(sum(s), 2)) OVER ()')} AS pct_of_revenue FROM seg GROUP BY segment"""
oracle("p_segments", SEGMENTS, PROD)
PAIR = "pair AS (SELECT item_identifier, item_type, sum(sales) AS s FROM fact GROUP BY 1, 2)"
ABC = f"""SELECT c AS abc, {N} AS products, {rnd('sum(s)', 4)} AS revenue, {N_SHARE} AS pct_of_products,
  {pct('sum(s)', 'sum(sum(s)) OVER ()')} AS pct_of_revenue FROM abc GROUP BY c"""
oracle("p_abc", ABC, f"{PAIR}, {abc('pair', 'item_identifier, item_type')}")
oracle("p_sales_bands", group([cases("sales", bands.SALES_LIMITS, bands.SALES_LABELS_COMPACT, "<=") + " AS sales_band"], {
    "records": N, "revenue": REV4, "pct_of_records": N_SHARE, "pct_of_revenue": SHARE}, "WHERE sales > 0"))
oracle("p_rating_dist", group([cases("rating", bands.RATING_LIMITS, bands.RATING_LABELS_COMPACT) + " AS rating_band"], {
    "records": N, "revenue": REV, "avg_sale": avg("sales"), "pct_of_records": N_SHARE}))


def edge(p: int) -> str:
    low = f"max(v) FILTER (i = ((n - 1) * {p}) // 100 + 1)"
    high = f"max(v) FILTER (i = ((n - 1) * {p} + 99) // 100 + 1)"
    return f"{low} + ({high} - {low}) * CAST(((max(n) - 1) * {p} % 100) AS DECIMAL(4,0)) * 0.01"


VIS_CTES = f"""ord AS (SELECT item_visibility AS v, row_number() OVER (ORDER BY item_visibility) AS i, count(*) OVER () AS n FROM fact),
  edges AS (SELECT {', '.join(f'{edge(p)} AS e{p}' for p in (20, 40, 60, 80))} FROM ord),
  cut AS (SELECT f.*, CASE WHEN item_visibility <= e20 THEN '1' WHEN item_visibility <= e40 THEN '2'
    WHEN item_visibility <= e60 THEN '3' WHEN item_visibility <= e80 THEN '4' ELSE '5' END AS band FROM fact f, edges)"""
oracle("p_visibility_quintiles", f"""SELECT band AS vis_quintile, {N} AS records, {avg('item_visibility', 4)} AS avg_visibility,
  {avg('sales', 4)} AS avg_sale, {REV4} AS revenue, {avg('rating', 4)} AS avg_rating FROM cut GROUP BY band""", VIS_CTES)
oracle("p_pivot_format", group(["item_type"], {
    f'"{f}"': rnd(f"sum(CASE WHEN outlet_type = '{f}' THEN sales ELSE 0 END)", 0) for f in FORMAT_COLUMNS}))


def by_year(keys: list[str]) -> str:
    amount = {y: f"sum(sales) FILTER (order_year = {y})" for y in YEARS}
    return group(keys, {
        **{f"rev_{y}": rnd(a) for y, a in amount.items()},
        "growth_pct": pct(f"{amount[1996]} - {amount[1995]}", amount[1995])})


oracle("p_outlet_growth", by_year(["outlet_identifier", "outlet_type"]))
oracle("p_category_growth", by_year(["item_type"]))
oracle("p_weekday", group([DAY], {"records": N, "revenue": REV, "avg_sale": avg("sales")}))

# ----------------------------------------------------------------------- dashboard

BAND = cases("rating", bands.RATING_LIMITS_5, bands.RATING_LABELS_5_COMPACT)
oracle("d_rating_band", f"""SELECT item_identifier, outlet_identifier, strftime(order_date, '%Y-%m-%d') AS order_date,
  {dbl('rating')} AS rating, {BAND} AS rating_band FROM fact""")


def top_bottom(table: str, suffix: str = "", column: str = "list") -> str:
    return " UNION ALL ".join(
        f"""(SELECT '{name}{suffix}' AS {column}, item_identifier AS label, {rnd('sum(sales)', 4)} AS value FROM {table}
        GROUP BY item_identifier ORDER BY sum(sales) {order}, item_identifier LIMIT 10)"""
        for name, order in (("top", "DESC"), ("bottom", "ASC")))


def pivots(table: str) -> str:
    fields = {
        "monthly": "order_year_month", "category": "item_type", "outlet_type": "outlet_type", "tier": "outlet_location_type",
        "size": "outlet_size", "rating": BAND, "fat": "item_fat_content"}
    plain = [
        f"SELECT '{name}' AS pivot, {field} AS label, {dbl(N) if name == 'rating' else rnd('sum(sales)', 4)} AS value FROM {table} GROUP BY 2"
        for name, field in fields.items()]
    return " UNION ALL ".join([*plain, top_bottom(table, "_prod", "pivot")])


oracle("d_top_bottom_n", top_bottom("fact"))
oracle("d_pivots", pivots("fact"))
def kpi_pivot(table: str) -> str:
    return f"SELECT {REV} AS sum_sales, {avg('sales')} AS avg_sales, {avg('rating')} AS avg_rating, {N} AS count_sales FROM {table}"


def kpi_cards(table: str) -> str:
    cards = [
        f"(SELECT format('{{:.2f}}', {ratio('sum(sales)', 'CAST(1000000 AS BIGINT)')}) || 'M' FROM {table})",
        grouped_digits(f"(SELECT {mean('sales')} FROM {table})", 0),
        grouped_digits(f"(SELECT {mean('rating')} FROM {table})", 2) + " || ' / 5'",
        grouped_digits(f"(SELECT {N} FROM {table})", 0), grouped_digits(f"(SELECT {PRODUCTS} FROM {table})", 0),
        f"(SELECT CAST(count(DISTINCT item_type) AS VARCHAR) FROM {table})",
    ]
    return " UNION ALL ".join(
        f"SELECT '{card}' AS card, {value} AS value, '{hint}' AS hint" for (card, hint), value in zip(CARDS.items(), cards))


oracle("d_kpi_pivot", kpi_pivot("fact"))
oracle("d_kpi_cards", kpi_cards("fact"))
for _suffix, _choice in {"": EXAMPLE_CHOICE, "_single": SINGLE_CHOICE, "_empty": EMPTY_CHOICE}.items():
    chosen = " AND ".join(f"{field} IN ({', '.join(repr(v) for v in values)})" for field, values in _choice.items())
    for _key, _tile in {"d_cross_filter": pivots, "d_cross_filter_kpis": kpi_pivot, "d_cross_filter_cards": kpi_cards}.items():
        oracle(_key + _suffix, _tile("chosen"), f"chosen AS (SELECT * FROM fact WHERE {chosen})")

# ---------------------------------------------------------------- aggregates, facts

for _name, _column in SEGMENT_TABLES.items():
    PARTS[f"_{_name}"] = ("fact", "", segment(_column, _column))
TABLES = {
    "kpis": "p_kpis", "category": "p_category", "outlet": "p_outlet", "outlet_type": "_outlet_type", "tier": "_tier",
    "outlet_size": "_outlet_size", "fat_content": "_fat_content", "monthly": "p_monthly", "yearly": "p_yearly",
    "seasonality": "p_seasonality", "products": "p_products", "segments": "p_segments", "abc": "p_abc",
    "sales_bands": "p_sales_bands", "rating_dist": "p_rating_dist", "visibility_quintiles": "p_visibility_quintiles",
    "cat_by_outlet_type": "p_pivot_format", "outlet_growth": "p_outlet_growth", "category_growth": "p_category_growth",
    "weekday": "p_weekday",
}
WITHOUT_REVENUE = {"kpis", "cat_by_outlet_type", "outlet_growth", "category_growth"}


def _counted(name: str, rows: str, where: str = "") -> str:
    revenue = "NULL" if name in WITHOUT_REVENUE else "round(sum(revenue), 0)"
    return f"SELECT '{name}' AS table_name, count(*) AS row_count, CAST({revenue} AS DOUBLE) AS revenue FROM {rows} {where}"


_counts = [_counted(name, nested(key)) for name, key in TABLES.items()]
_counts += [_counted(f"{name}_products", nested("p_top_bottom"), f"WHERE list = '{name}'") for name in ("top", "bottom")]
oracle("sink_aggregates", " UNION ALL ".join(_counts))


def pick(key: str, column: str, order: str) -> str:
    return f"(SELECT {column} FROM {nested(key)} ORDER BY {order} LIMIT 1)"


def at(key: str, column: str, where: str) -> str:
    return f"(SELECT {column} FROM {nested(key)} WHERE {where})"


_low = "(SELECT coalesce(sum(s) FILTER (g < 3.5), 0) FROM low)"
_total = "(SELECT round(sum(sales), 2) FROM fact)"
_dec = "CAST({} AS DECIMAL(20,4))".format
FACTS = {
    **{c: at("p_kpis", k, "true") for c, k in {
        "total_revenue": "total_revenue", "total_records": "total_records", "total_products": "total_products",
        "avg_sale": "avg_sale", "median_sale": "median_sale", "avg_rating": "avg_rating", "outlets": "total_outlets",
        "pct_weight_imputed": "pct_weight_imputed", "pct_visibility_imputed": "pct_visibility_imputed"}.items()},
    "top_category": pick("p_category", "item_type", "revenue DESC"),
    "top_category_pct": pick("p_category", "pct_of_revenue", "revenue DESC"),
    "top3_category_share": f"""(SELECT {rnd('sum(' + _dec('pct_of_revenue') + ')', 1)} FROM
      (SELECT pct_of_revenue FROM {nested('p_category')} ORDER BY revenue DESC, item_type LIMIT 3))""",
    "weakest_category": pick("p_category", "item_type", "revenue"),
    "weakest_category_pct": pick("p_category", "pct_of_revenue", "revenue"),
    "premium_category": pick("p_category", "item_type", "avg_sale DESC"),
    "premium_avg_sale": pick("p_category", "avg_sale", "avg_sale DESC"),
    "top_outlet": pick("p_outlet", "outlet_identifier", "revenue DESC"),
    "top_outlet_pct": pick("p_outlet", "pct_of_revenue", "revenue DESC"),
    "top_outlet_type": pick("p_outlet", "outlet_type", "revenue DESC"),
    "worst_outlet": pick("p_outlet", "outlet_identifier", "revenue"),
    "worst_outlet_pct": pick("p_outlet", "pct_of_revenue", "revenue"),
    "best_format": pick("_outlet_type", "outlet_type", "revenue_per_store DESC"),
    "best_format_rps": pick("_outlet_type", "revenue_per_store", "revenue_per_store DESC"),
    "grocery_rps": at("_outlet_type", "revenue_per_store", "outlet_type = 'Grocery Store'"),
    "format_gap_x": ratio(
        _dec(pick("_outlet_type", "revenue_per_store", "revenue_per_store DESC")),
        _dec(at("_outlet_type", "revenue_per_store", "outlet_type = 'Grocery Store'")), 1),
    "best_tier": pick("_tier", "outlet_location_type", "revenue_per_store DESC"),
    "best_tier_rps": pick("_tier", "revenue_per_store", "revenue_per_store DESC"),
    "worst_tier": pick("_tier", "outlet_location_type", "revenue_per_store"),
    "best_size": pick("_outlet_size", "outlet_size", "revenue_per_store DESC"),
    "vis_uplift_pct": "(SELECT " + pct("h - l", "l", 1) + f""" FROM (SELECT max({_dec('avg_sale')}) FILTER (vis_quintile = '1') AS l,
      max({_dec('avg_sale')}) FILTER (vis_quintile = '5') AS h FROM {nested('p_visibility_quintiles')}))""",
    "vis_q1_avg": at("p_visibility_quintiles", "avg_sale", "vis_quintile = '1'"),
    "vis_q5_avg": at("p_visibility_quintiles", "avg_sale", "vis_quintile = '5'"),
    "a_class_products": at("p_abc", "products", "abc LIKE 'A%'"),
    "a_class_pct_products": at("p_abc", "pct_of_products", "abc LIKE 'A%'"),
    "a_class_pct_revenue": at("p_abc", "pct_of_revenue", "abc LIKE 'A%'"),
    "peak_month": pick("p_seasonality", "order_month_name", "revenue DESC"),
    "peak_index": pick("p_seasonality", "seasonality_index", "revenue DESC"),
    "trough_month": pick("p_seasonality", "order_month_name", "revenue"),
    "trough_index": pick("p_seasonality", "seasonality_index", "revenue"),
    "yoy_growth": pick("p_yearly", "yoy_growth_pct", "order_year DESC"),
    "basket_growth": pick("p_yearly", "basket_growth_pct", "order_year DESC"),
    "low_rated_count": "(SELECT count(*) FROM low WHERE g < 3.5)",
    "low_rated_revenue": rnd(_low),
    "low_rated_pct": pct(_low, _total),
    "star_products": at("p_segments", "products", "segment = 'Star'"),
    "delist_products": at("p_segments", "products", "segment = 'Delist candidate'"),
    "weekend_uplift_pct": "(SELECT " + pct("h - l", "l", 1) + f""" FROM (SELECT max({_dec('avg_sale')}) FILTER (day_type = 'Weekday') AS l,
      max({_dec('avg_sale')}) FILTER (day_type = 'Weekend') AS h FROM {nested('p_weekday')}))""",
    "fastest_growing_category": pick("p_category_growth", "item_type", "growth_pct DESC"),
    "fastest_growth_pct": pick("p_category_growth", "growth_pct", "growth_pct DESC"),
    "low_fat_share": at("_fat_content", "pct_of_revenue", "item_fat_content = 'Low Fat'"),
}
for _key in ("p_facts", "sink_facts_json"):
    oracle(_key, "SELECT " + ", ".join(f"{v} AS {k}" for k, v in FACTS.items()),
           f"low AS (SELECT item_identifier, item_type, sum(sales) AS s, {dec4('rating')} AS g FROM fact GROUP BY 1, 2)")
for _name in SEGMENT_TABLES:
    del PARTS[f"_{_name}"]
