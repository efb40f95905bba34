"""Expected results on the raw extract: sources, cleaning steps, profile, integrity."""

from __future__ import annotations

from .base import LABEL, big, dbl, oracle, pct, ratio, rnd
from .values import (
    ALLOWED_VALUES, CHECKS, COERCED_TYPES, COLUMN_ROLES, DECISIONS, GAP_NOTES, LISTED_COLUMNS, RAW_COLUMNS, REPORT_COLUMNS, REQUIRED_COLUMNS, SPOILED)

DECIMALS = {"item_weight", "item_visibility", "sales", "rating"}
INTEGERS = {
    "item_weight_imputed", "item_visibility_imputed", "outlet_establishment_year", "outlet_age_years", "order_year",
    "order_month", "order_quarter", "is_weekend",
}
MEASURED = [
    "item_identifier", "item_type", "item_fat_content", "item_weight", "item_weight_imputed", "item_visibility",
    "item_visibility_imputed", "outlet_identifier", "outlet_establishment_year", "outlet_age_years", "outlet_size",
    "outlet_location_type", "outlet_type", "sales", "rating", "order_date", "order_year", "order_month",
    "order_month_name", "order_quarter", "order_year_month", "order_weekday", "is_weekend",
]


def shown(c: str) -> str:
    if c in DECIMALS:
        return f"{dbl(c)} AS {c}"
    if c in INTEGERS:
        return f"{big(c)} AS {c}"
    return "strftime(order_date, '%Y-%m-%d') AS order_date" if c == "order_date" else c


def rows(columns: list[str], table: str) -> str:
    return f"SELECT {', '.join(map(shown, columns))} FROM {table}"


def register() -> None:
    oracle("src_raw_csv", "SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in RAW_COLUMNS) + " FROM raw", base="raw")
    oracle("src_row_count", "SELECT count(*) AS rows_loaded FROM raw", base="raw")
    oracle("src_clean_csv", rows(REPORT_COLUMNS, "fact"))
    for key in ("sink_fact", "sink_clean_csv", "cln_pipeline"):
        oracle(key, rows(MEASURED, "fact"))

    row = "item_identifier, outlet_identifier, order_date"
    oracle("cln_trim", "SELECT " + ", ".join(f"trim({c}) AS {c}" for c in RAW_COLUMNS) + " FROM raw", base="raw")
    oracle("cln_map_category", f"SELECT {row}, item_fat_content AS raw_label, {LABEL} AS label FROM raw", base="raw")
    typed = ", ".join(
        f"CAST(CAST(nullif(trim({c}), '') AS {t}) AS DOUBLE) AS {c}"
        for c, t in (("item_weight", "DECIMAL(6,3)"), ("item_visibility", "DECIMAL(9,6)"), ("sales", "DECIMAL(10,4)")))
    oracle("cln_blank_null_cast", f"SELECT {row}, {typed} FROM raw", base="raw")
    oracle("cln_zero_as_null", f"SELECT {row}, nullif(CAST(item_visibility AS DOUBLE), 0) AS item_visibility FROM raw", base="raw")
    oracle("cln_missing_band", f"""SELECT {row}, CASE WHEN trim(outlet_size) = '' THEN 'Unknown' ELSE trim(outlet_size) END
        AS outlet_size FROM raw""", base="raw")
    oracle("cln_round_clamp", f"""SELECT {row}, rating AS raw_rating, CAST(CASE
        WHEN round(CAST(rating AS DECIMAL(4,3)), 1) > 5 THEN 5 WHEN round(CAST(rating AS DECIMAL(4,3)), 1) < 1 THEN 1
        ELSE round(CAST(rating AS DECIMAL(4,3)), 1) END AS DOUBLE) AS rating FROM raw""", base="raw")
    oracle("cln_parse_date", """SELECT item_identifier, outlet_identifier, order_date AS raw_date,
        strftime(strptime(order_date, '%Y-%m-%d'), '%Y-%m-%d') AS order_date FROM raw""", base="raw")
    oracle("cln_dedup_exact", rows(RAW_COLUMNS, "uniq"), base="uniq")
    oracle("cln_median_by_item", "SELECT item_identifier, m AS item_median_weight FROM item_median", base="uniq")
    oracle("cln_median_by_type", "SELECT item_type, w AS type_median_weight FROM type_median", base="uniq")
    oracle("cln_median_visibility", "SELECT item_type, v AS type_median_visibility FROM type_median", base="uniq")
    _coerced()
    keys = ["item_identifier", "outlet_identifier", "order_date"]
    for key, columns in {
        "cln_impute": ["item_weight", "item_visibility"],
        "cln_impute_flags": ["item_weight_imputed", "item_visibility_imputed"],
        "cln_age": ["outlet_establishment_year", "outlet_age_years"],
        "cln_date_parts": [
            "order_year", "order_month", "order_month_name", "order_quarter", "order_year_month", "order_weekday",
            "is_weekend"],
    }.items():
        oracle(key, rows(keys + columns, "fact"))
    _profile()
    _integrity()


def _coerced() -> None:
    spoiled = ", ".join(
        f"CASE WHEN CAST(item_identifier AS BIGINT) % {SPOILED[c][0]} = {SPOILED[c][1]} THEN '{SPOILED[c][2]}' ELSE {c} END AS {c}"
        if c in SPOILED else c for c in RAW_COLUMNS)
    bad = f"spoiled AS (SELECT {spoiled} FROM raw)"
    text = "nullif(trim({}), '')".format
    day = "CAST(TRY_STRPTIME({}, '%Y-%m-%d') AS DATE)".format
    typed = {c: f"TRY_CAST({text(c)} AS {t})" for c, t in COERCED_TYPES.items()} | {
        "item_fat_content": LABEL, "outlet_size": f"coalesce({text('outlet_size')}, 'Unknown')", "order_date": day(text("order_date")),
        "item_visibility": f"nullif(TRY_CAST({text('item_visibility')} AS DECIMAL(9,6)), 0)",
        "rating": f"CAST(CASE WHEN r > 5 THEN 5 WHEN r < 1 THEN 1 ELSE r END AS DECIMAL(3,2))"}
    rounded = f"SELECT *, round(TRY_CAST({text('rating')} AS DECIMAL(4,3)), 1) AS r FROM spoiled"
    columns = ", ".join(f"{typed.get(c, f'trim({c})')} AS {c}" for c in RAW_COLUMNS)
    oracle("cln_coerce_typed", rows(RAW_COLUMNS, "typed"), f"{bad}, typed AS (SELECT {columns} FROM ({rounded}))", base="raw")
    checks = [
        f"""SELECT '{c}' AS column_name, {c} AS value, CASE WHEN TRY_CAST({text(c)} AS DOUBLE) IS NULL THEN 'not a number' ELSE 'out of range' END AS reason
        FROM spoiled WHERE {text(c)} IS NOT NULL AND TRY_CAST({text(c)} AS {t}) IS NULL""" for c, t in COERCED_TYPES.items()]
    checks.append(f"SELECT 'order_date', order_date, 'not a date' FROM spoiled WHERE {text('order_date')} IS NOT NULL AND {day(text('order_date'))} IS NULL")
    checks.append(f"SELECT 'item_fat_content', item_fat_content, 'unknown label' FROM spoiled WHERE {text('item_fat_content')} IS NOT NULL AND {LABEL} IS NULL")
    oracle("cln_coerce_rejects", """SELECT column_name, reason, count(*) AS rejected_values, count(DISTINCT value) AS distinct_values
        FROM rejects GROUP BY column_name, reason""", f"{bad}, rejects AS ({_union(checks)})", base="raw")


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _profile() -> None:
    blank = "({0} IS NULL OR trim({0}) = '')".format
    oracle("prof_schema", _union([
        f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS column_name, '{a}' AS stored_as, '{b}' AS should_be, '{r}' AS role, "
        f"count(*) FILTER (NOT {blank(c)}) AS filled_rows FROM raw"
        for i, (c, (a, b, r)) in enumerate(COLUMN_ROLES.items(), 1)]), base="raw")
    oracle("prof_missing", "SELECT * FROM (" + _union([
        f"SELECT '{c}' AS column_name, count(*) FILTER ({blank(c)}) AS missing, "
        f"{pct(f'count(*) FILTER ({blank(c)})', 'count(*)')} AS pct_of_rows, "
        f"'{GAP_NOTES.get(c, 'Unexpected - investigate.')}' AS interpretation FROM raw" for c in RAW_COLUMNS
    ]) + ") WHERE missing > 0", base="raw")
    oracle("prof_missing_by_key", """SELECT outlet_identifier, count(*) AS row_count FROM raw GROUP BY 1
        HAVING max(length(trim(outlet_size))) = 0""", base="raw")
    oracle("prof_duplicates", """SELECT (SELECT count(*) FROM raw) AS total_rows,
        count(*) FILTER (n > 1) AS dup_groups, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS rows_in_groups,
        CAST(sum(n) - count(*) AS BIGINT) AS redundant_copies,
        (SELECT count(*) - count(DISTINCT (item_identifier, outlet_identifier)) FROM raw) AS grain_duplicates FROM copies""",
        f"copies AS (SELECT count(*) AS n FROM raw GROUP BY {', '.join(RAW_COLUMNS)})", base="raw")
    oracle("prof_grain", """SELECT count(*) AS grain_violations FROM (SELECT 1 FROM raw
        GROUP BY item_identifier, outlet_identifier HAVING count(*) > 1)""", base="raw")
    oracle("prof_category_values", f"""SELECT '"' || item_fat_content || '"' AS raw_value_quoted, count(*) AS row_count,
        coalesce({LABEL}, 'UNMAPPED - INVESTIGATE') AS maps_to FROM raw GROUP BY item_fat_content""", base="raw")
    oracle("prof_domain_lists", _union([
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS row_count FROM raw WHERE trim({c}) <> '' GROUP BY {c}"
        for c in LISTED_COLUMNS]), base="raw")
    oracle("prof_whitespace", "SELECT * FROM (" + _union([
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} <> trim({c})) AS row_count FROM raw" for c in RAW_COLUMNS
    ]) + ") WHERE row_count > 0", base="raw")
    oracle("prof_ranges", f"""SELECT count(*) AS total_rows, count(*) FILTER (v = 0) AS zero_visibility,
        count(*) FILTER (v < 0 OR v > 1) AS visibility_out_of_range, count(*) FILTER (s <= 0) AS non_positive_sales,
        count(*) FILTER (r < 1 OR r > 5) AS rating_out_of_range,
        count(*) FILTER (length(split_part(trim(rating), '.', 2)) > 1) AS rating_over_precise,
        count(*) FILTER (w <= 0) AS non_positive_weight, count(*) FILTER (d IS NULL) AS unparseable_dates,
        {pct('count(*) FILTER (v = 0)', 'count(*)')} AS pct_zero_visibility FROM t""",
        """t AS (SELECT CAST(item_visibility AS DOUBLE) AS v, CAST(sales AS DOUBLE) AS s, CAST(rating AS DOUBLE) AS r, rating,
        try_cast(nullif(item_weight, '') AS DOUBLE) AS w, try_strptime(order_date, '%Y-%m-%d') AS d FROM raw)""", base="raw")
    oracle("prof_cross_field", """SELECT count(*) FILTER (CAST(substr(order_date, 1, 4) AS INTEGER)
        < CAST(outlet_establishment_year AS INTEGER)) AS orders_before_opening FROM raw""", base="raw")
    oracle("prof_min_max", """SELECT CAST(min(outlet_establishment_year) AS BIGINT) AS first_year,
        CAST(max(outlet_establishment_year) AS BIGINT) AS last_year, min(order_date) AS first_date,
        max(order_date) AS last_date FROM raw""", base="raw")
    oracle("prof_ref_outlet", """SELECT count(*) AS outlets, count(*) FILTER (a > 1 OR b > 1 OR c > 1 OR d > 1)
        AS conflicting_outlets FROM (SELECT count(DISTINCT outlet_size) AS a, count(DISTINCT outlet_location_type) AS b,
        count(DISTINCT outlet_type) AS c, count(DISTINCT outlet_establishment_year) AS d FROM raw
        GROUP BY outlet_identifier)""", base="raw")
    oracle("prof_ref_outlet_list", """SELECT outlet_identifier, a AS distinct_sizes, b AS distinct_tiers, c AS distinct_types,
        d AS distinct_years, CAST(greatest(a, b, c, d) > 1 AS VARCHAR) AS conflicting FROM (SELECT outlet_identifier,
        count(DISTINCT outlet_size) AS a, count(DISTINCT outlet_location_type) AS b, count(DISTINCT outlet_type) AS c,
        count(DISTINCT outlet_establishment_year) AS d FROM raw GROUP BY outlet_identifier)""", base="raw")
    oracle("prof_ref_item", """SELECT count(*) AS items, count(*) FILTER (w > 1) AS items_with_several_weights,
        count(*) FILTER (t > 1) AS items_in_several_categories FROM (SELECT count(DISTINCT nullif(trim(item_weight), '')) AS w,
        count(DISTINCT item_type) AS t FROM raw GROUP BY item_identifier)""", base="raw")
    oracle("prof_iqr_sql", f"""SELECT {dbl('q1')} AS q1, {dbl('m')} AS median_s, {dbl('q3')} AS q3,
        {rnd('q3 - q1')} AS iqr, {rnd('q3 + 1.5 * (q3 - q1)')} AS upper_fence,
        (SELECT count(*) FROM s WHERE sales > q3 + 1.5 * (q3 - q1)) AS rows_above_fence FROM q""",
        """s AS (SELECT CAST(sales AS DECIMAL(10,4)) AS sales FROM raw),
        p AS (SELECT sales, percent_rank() OVER (ORDER BY sales) AS pr FROM s),
        q AS (SELECT max(sales) FILTER (pr <= 0.25) AS q1, max(sales) FILTER (pr <= 0.5) AS m,
              max(sales) FILTER (pr <= 0.75) AS q3 FROM p)""", base="raw")
    # Interpolated quartiles as exact decimals: low + (high - low) * fraction.
    def interpolated(p: int) -> str:
        low = f"max(sales) FILTER (i = ((n - 1) * {p}) // 100 + 1)"
        high = f"max(sales) FILTER (i = ((n - 1) * {p} + 99) // 100 + 1)"
        return f"{low} + ({high} - {low}) * CAST(((max(n) - 1) * {p} % 100) AS DECIMAL(4,0)) * 0.01"
    oracle("prof_iqr_interp", f"""SELECT {rnd('min(sales)')} AS min_sales, {rnd('any_value(q1)')} AS q1,
        {rnd('any_value(m)')} AS median, {ratio('sum(sales)', 'count(*)')} AS mean, {rnd('any_value(q3)')} AS q3,
        {rnd('max(sales)')} AS max_sales, round(stddev_samp(CAST(sales AS DOUBLE)), 2) AS std_dev,
        {rnd('any_value(low)')} AS lower_fence, {rnd('any_value(high)')} AS upper_fence,
        count(*) FILTER (sales > high) AS rows_above, count(*) FILTER (sales < low) AS rows_below,
        count(*) FILTER (sales > high OR sales < low) AS rows_outside,
        {pct('count(*) FILTER (sales > high OR sales < low)', 'count(*)')} AS pct_outside FROM s CROSS JOIN f""",
        f"""s AS (SELECT CAST(sales AS DECIMAL(10,4)) AS sales FROM raw),
        o AS (SELECT sales, row_number() OVER (ORDER BY sales) AS i, count(*) OVER () AS n FROM s),
        q AS (SELECT {interpolated(25)} AS q1, {interpolated(50)} AS m, {interpolated(75)} AS q3 FROM o),
        f AS (SELECT q1, m, q3, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM q)""", base="raw")
    counts = {
        "spellings": "(SELECT count(DISTINCT item_fat_content) FROM raw)",
        "missing_weight": "(SELECT count(*) FROM raw WHERE trim(item_weight) = '')",
        "zero_visibility": "(SELECT count(*) FROM raw WHERE CAST(item_visibility AS DOUBLE) = 0)",
        "copies": "(SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw))",
    }
    oracle("prof_decisions", _union([
        f"SELECT CAST({i} AS BIGINT) AS position, "
        + (f"CAST({counts[c]} AS VARCHAR) || ' {t}'" if c else f"'{t}'")
        + f" AS issue, '{d}' AS decision, '{r}' AS rationale".replace("item's", "item''s").replace("category's", "category''s")
        for i, (c, t, d, r) in enumerate(DECISIONS, 1)]), base="raw")


def _integrity() -> None:
    def listed(values: list[str]) -> str:
        return ", ".join(f"'{v}'" for v in values)

    oracle("val_enum", _union([
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL OR {c} NOT IN ({listed(v)})) AS bad_rows FROM fact"
        for c, v in ALLOWED_VALUES.items()]))
    oracle("val_checks", _union([
        f"SELECT '{n}' AS rule, count(*) FILTER (NOT ({t})) AS bad_rows FROM fact" for n, t in CHECKS.items()]))
    oracle("val_not_null", _union(["SELECT 'sale_id' AS column_name, CAST(0 AS BIGINT) AS null_rows"] + [
        f"SELECT '{c}', count(*) - count({c}) FROM fact" for c in REQUIRED_COLUMNS if c != "sale_id"]))
    repeats = "(SELECT count(*) AS n FROM fact GROUP BY item_identifier, outlet_identifier HAVING count(*) > 1)"
    oracle("val_unique", f"""SELECT count(*) AS repeated_groups, {big('coalesce(sum(n - 1), 0)')} AS surplus_rows FROM {repeats}""")
    oracle("surrogate_key", "SELECT count(*) AS records, count(*) AS distinct_ids, CAST(0 AS BIGINT) AS missing_ids FROM fact")
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(30))" for c in RAW_COLUMNS)
    oracle("surrogate_key_rows", f"""SELECT item_identifier, outlet_identifier, strftime(order_date, '%Y-%m-%d') AS order_date,
        CAST(sales AS DOUBLE) AS sales, md5(concat_ws(chr(31), {parts})) AS sale_id FROM uniq""", base="uniq")
    oracle("val_row_recon", """SELECT r AS raw_rows, c AS clean_rows, r - c AS rows_removed
        FROM (SELECT (SELECT count(*) FROM raw) AS r, (SELECT count(*) FROM fact) AS c)""")
    oracle("val_revenue_recon", f"""SELECT {rnd('r')} AS raw_revenue, {rnd('c')} AS clean_revenue, {rnd('r - c')} AS revenue_removed
        FROM (SELECT (SELECT sum(CAST(sales AS DECIMAL(10,4))) FROM raw) AS r, (SELECT sum(sales) FROM fact) AS c)""")
    oracle("val_quarantine", f"""SELECT CASE WHEN sales > 50000 THEN 'quarantined' ELSE 'accepted' END AS part, count(*) AS rows,
        {rnd('sum(sales)')} AS revenue FROM fact GROUP BY 1""")
    oracle("val_defects_zero", """SELECT count(*) FILTER (item_weight IS NULL) AS null_weights,
        count(*) FILTER (item_visibility = 0) AS zero_visibility,
        count(*) FILTER (item_visibility NOT BETWEEN 0 AND 1) AS bad_visibility, count(*) FILTER (sales <= 0) AS bad_sales,
        count(*) FILTER (rating NOT BETWEEN 1 AND 5) AS bad_rating, count(DISTINCT item_fat_content) AS fat_categories,
        count(DISTINCT outlet_size) AS size_categories,
        count(*) - count(DISTINCT (item_identifier, outlet_identifier)) AS grain_violations FROM fact""")
    oracle("val_imputation_share", f"""SELECT count(*) AS total_rows, {big('sum(item_weight_imputed)')} AS weights_imputed,
        {pct('sum(item_weight_imputed)', 'count(*)')} AS pct_weight_imputed,
        {big('sum(item_visibility_imputed)')} AS visibility_imputed,
        {pct('sum(item_visibility_imputed)', 'count(*)')} AS pct_visibility_imputed FROM fact""")
    oracle("val_category_collapse", f"""SELECT item_fat_content, count(*) AS "rows", {rnd('sum(sales)')} AS revenue
        FROM fact GROUP BY 1""")
    tests = {
        "weight present": "item_weight IS NULL", "visibility above zero": "coalesce(item_visibility, 0) <= 0",
        "sales positive": "sales <= 0", "rating within 1 to 5": "rating < 1 OR rating > 5",
        "fat content canonical": "coalesce(item_fat_content, '') NOT IN ('Low Fat', 'Regular')",
    }
    failures = _union([f"SELECT '{n}' AS assertion, count(*) FILTER ({t}) AS failures FROM fact" for n, t in tests.items()] + [
        "SELECT 'one row per item and outlet', count(*) - count(DISTINCT (item_identifier, outlet_identifier)) FROM fact"])
    oracle("val_assertions", f"SELECT assertion, failures, CASE WHEN failures = 0 THEN 'true' ELSE 'false' END AS passed FROM ({failures})")


register()
