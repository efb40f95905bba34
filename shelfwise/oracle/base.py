"""Building blocks of the SQL that states each report's expected result.

Sums are exact decimals. Quotients are rounded half up in integer arithmetic, so both
engines agree to the last digit. Every result column is text, BIGINT or DOUBLE.
"""

from __future__ import annotations

UNIT = {"sales": 4, "rating": 2, "item_weight": 3, "item_visibility": 6}

RAW = """WITH lines AS (
  SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 601 = 0
), raw AS (
  SELECT CAST(l_partkey AS VARCHAR) AS item_identifier,
         CASE WHEN (l_orderkey + l_linenumber) % 6 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS item_weight,
         CASE WHEN l_linestatus = 'O' THEN ['Low Fat', 'low fat', 'Low Fat ', 'LF'][l_orderkey % 4 + 1]
              ELSE ['Regular', 'reg', ' Regular'][l_orderkey % 3 + 1] END AS item_fat_content,
         CAST(CAST(l_discount AS DECIMAL(9,6)) AS VARCHAR) AS item_visibility,
         p_type AS item_type,
         CAST(l_suppkey AS VARCHAR) AS outlet_identifier,
         CAST(1985 + l_suppkey % 25 AS VARCHAR) AS outlet_establishment_year,
         ['', 'Small', 'Medium', 'High'][l_suppkey % 4 + 1] AS outlet_size,
         'Tier ' || CAST(n_regionkey % 3 + 1 AS VARCHAR) AS outlet_location_type,
         ['Grocery Store', 'Supermarket Type1', 'Supermarket Type2', 'Supermarket Type3'][n_nationkey % 4 + 1] AS outlet_type,
         CAST(CAST(l_extendedprice AS DECIMAL(10,4)) AS VARCHAR) AS sales,
         CAST(CAST(CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) + l_tax AS DECIMAL(4,3)) AS VARCHAR) AS rating,
         strftime(o_orderdate, '%Y-%m-%d') AS order_date
  FROM lines JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
  JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
)"""

LABEL = """CASE WHEN upper(trim(item_fat_content)) IN ('LF', 'LOW FAT') THEN 'Low Fat'
              WHEN upper(trim(item_fat_content)) IN ('REG', 'REGULAR') THEN 'Regular' END"""

UNIQUE = RAW + f""", uniq AS (
  SELECT DISTINCT trim(item_identifier) AS item_identifier,
         CAST(nullif(trim(item_weight), '') AS DECIMAL(6,3)) AS item_weight,
         {LABEL} AS item_fat_content,
         nullif(CAST(nullif(trim(item_visibility), '') AS DECIMAL(9,6)), 0) AS item_visibility,
         trim(item_type) AS item_type, trim(outlet_identifier) AS outlet_identifier,
         CAST(trim(outlet_establishment_year) AS INTEGER) AS outlet_establishment_year,
         coalesce(nullif(trim(outlet_size), ''), 'Unknown') AS outlet_size,
         trim(outlet_location_type) AS outlet_location_type, trim(outlet_type) AS outlet_type,
         CAST(trim(sales) AS DECIMAL(10,4)) AS sales,
         CAST(least(5.0, greatest(1.0, round(CAST(trim(rating) AS DECIMAL(4,3)), 1))) AS DECIMAL(3,2)) AS rating,
         CAST(strptime(trim(order_date), '%Y-%m-%d') AS DATE) AS order_date
  FROM raw
), item_median AS (
  SELECT item_identifier, median(CAST(item_weight AS DOUBLE)) AS m FROM uniq WHERE item_weight IS NOT NULL GROUP BY 1
), type_median AS (
  SELECT item_type, median(CAST(item_weight AS DOUBLE)) AS w, median(CAST(item_visibility AS DOUBLE)) AS v
  FROM uniq GROUP BY 1
)"""

FACT = UNIQUE + """, fact AS MATERIALIZED (
  SELECT u.item_identifier, u.item_type, u.item_fat_content,
         CAST(round(coalesce(CAST(u.item_weight AS DOUBLE), i.m, t.w), 3) AS DECIMAL(6,3)) AS item_weight,
         CAST(u.item_weight IS NULL AS INTEGER) AS item_weight_imputed,
         CAST(round(coalesce(CAST(u.item_visibility AS DOUBLE), t.v), 6) AS DECIMAL(9,6)) AS item_visibility,
         CAST(u.item_visibility IS NULL AS INTEGER) AS item_visibility_imputed,
         u.outlet_identifier, u.outlet_establishment_year, 2024 - u.outlet_establishment_year AS outlet_age_years,
         u.outlet_size, u.outlet_location_type, u.outlet_type, u.sales, u.rating, u.order_date,
         year(order_date) AS order_year, month(order_date) AS order_month, strftime(order_date, '%b') AS order_month_name,
         quarter(order_date) AS order_quarter, strftime(order_date, '%Y-%m') AS order_year_month,
         strftime(order_date, '%a') AS order_weekday, CAST(dayofweek(order_date) IN (0, 6) AS INTEGER) AS is_weekend
  FROM uniq u LEFT JOIN item_median i USING (item_identifier) LEFT JOIN type_median t ON t.item_type = u.item_type
)"""

BASES = {"raw": RAW, "uniq": UNIQUE, "fact": FACT}
PARTS: dict[str, tuple[str, str, str]] = {}


def oracle(key: str, select: str, ctes: str = "", base: str = "fact") -> None:
    """Register the SQL of a report: a SELECT over the base tables and its own CTEs."""
    if key in PARTS:
        raise ValueError(f"oracle {key} is registered twice")
    PARTS[key] = (base, ctes, select)


def statement(key: str) -> str:
    base, ctes, select = PARTS[key]
    return BASES[base] + (f", {ctes} " if ctes else " ") + select


def nested(key: str) -> str:
    """The same without the base tables, for use inside another statement."""
    _, ctes, select = PARTS[key]
    return f"({'WITH ' + ctes + ' ' if ctes else ''}{select})"


def hu(num: str, den: str, digits: int, unit: int = 4) -> str:
    """num / den rounded half up as a decimal; both may have up to `unit` decimals."""
    n = f"CAST(({num}) * {10 ** unit} AS HUGEINT)"
    d = f"nullif(CAST(({den}) * {10 ** unit} AS HUGEINT), 0)"
    whole = f"((2 * abs({n}) * {10 ** digits} + abs({d})) // (2 * abs({d})))"
    signed = f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END) * {whole}"
    step = "1" if digits == 0 else f"CAST(0.{'0' * (digits - 1)}1 AS DECIMAL({digits + 1},{digits}))"
    return f"(CAST({signed} AS DECIMAL(38,0)) * {step})"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def rnd(expr: str, digits: int = 2) -> str:
    return dbl(f"round({expr}, {digits})")


def ratio(num: str, den: str, digits: int = 2, unit: int = 4) -> str:
    return dbl(hu(num, den, digits, unit))


def pct(part: str, whole: str, digits: int = 2, unit: int = 4) -> str:
    return ratio(f"({part}) * 100", whole, digits, unit)


def avg(col: str, digits: int = 2) -> str:
    return ratio(f"sum({col})", f"count({col})", digits, UNIT[col])


def mean(col: str) -> str:
    """Average with four decimals more than the column has, as a decimal."""
    return hu(f"sum({col})", f"count({col})", UNIT[col] + 4, UNIT[col])


REV = rnd("sum(sales)")
N = "count(*)"
SHARE = pct("sum(sales)", "sum(sum(sales)) OVER ()")
N_SHARE = pct("count(*)", "sum(count(*)) OVER ()")
STORES = "count(DISTINCT outlet_identifier)"
PRODUCTS = "count(DISTINCT item_identifier)"
PER_STORE = ratio("sum(sales)", STORES)
