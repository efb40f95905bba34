"""From the raw text extract to the typed fact table, one step per function."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import BASE_YEAR, FACT_COLUMNS, FAT_CONTENT_LABELS, GRAIN, RAW_COLUMNS, UNKNOWN
from .medians import grouped_median


def trim_text(df: DataFrame) -> DataFrame:
    """Strip outer spaces from every text column."""
    return df.select([F.trim(c).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def canonical_fat_content(column: str | Column, unmapped: Column | None = None) -> Column:
    """Canonical label of any known spelling; `unmapped` (default NULL) for the rest."""
    name = F.col(column) if isinstance(column, str) else column
    key = F.upper(F.trim(name))
    cases = list(FAT_CONTENT_LABELS.items())
    chain = reduce(lambda acc, kv: acc.when(key == kv[0], kv[1]), cases[1:], F.when(key == cases[0][0], cases[0][1]))
    return chain.otherwise(F.lit(None).cast("string") if unmapped is None else unmapped)


def fail_on(message: str, column: str) -> Column:
    return F.raise_error(F.concat(F.lit(message), F.coalesce(F.col(column), F.lit("NULL")))).cast("string")


def blank_to_null(column: str) -> Column:
    return F.nullif(F.trim(F.col(column)), F.lit(""))


def number(column: str, type_name: str, strict: bool = True) -> Column:
    """Typed number of a text column, blank as NULL; any other bad text fails the job, or is NULL too if not `strict`."""
    text = blank_to_null(column)
    return text.cast(type_name) if strict else text.try_cast(type_name)


def zero_to_null(value: Column) -> Column:
    """Zero means `not recorded` for a measure that cannot be zero."""
    return F.when(value != 0, value)


def blank_to_unknown(column: str) -> Column:
    return F.coalesce(blank_to_null(column), F.lit(UNKNOWN))


def bounded_rating(column: str, strict: bool = True) -> Column:
    """One decimal, forced into 1..5."""
    one_decimal = F.round(number(column, NUMBERS["rating"], strict), 1)
    low, high = F.lit("1.0").cast("decimal(3,2)"), F.lit("5.0").cast("decimal(3,2)")
    return F.when(one_decimal.isNotNull(), F.least(high, F.greatest(low, one_decimal))).cast("decimal(3,2)")


def parsed_date(column: str, strict: bool = True) -> Column:
    parse = F.to_date if strict else F.try_to_date
    return parse(blank_to_null(column), "yyyy-MM-dd")


# Types of the numbers in the extract, as text is cast to them.
NUMBERS = {
    "item_weight": "decimal(6,3)", "item_visibility": "decimal(9,6)", "outlet_establishment_year": "int", "sales": "decimal(10,4)",
    "rating": "decimal(4,3)",
}


def type_columns(raw: DataFrame, strict: bool = True, *more: Column) -> DataFrame:
    """Trim, map and cast every column; `more` columns are added.

    With `strict`, a bad value or an unknown fat-content label fails the job; else it becomes NULL.
    """
    unmapped = fail_on("unmapped fat content: ", "item_fat_content") if strict else None
    typed = {c: number(c, kind, strict) for c, kind in NUMBERS.items()} | {
        "item_identifier": F.trim("item_identifier"),
        "item_fat_content": canonical_fat_content("item_fat_content", unmapped),
        "item_visibility": zero_to_null(number("item_visibility", NUMBERS["item_visibility"], strict)),
        "item_type": F.trim("item_type"),
        "outlet_identifier": F.trim("outlet_identifier"),
        "outlet_size": blank_to_unknown("outlet_size"),
        "outlet_location_type": F.trim("outlet_location_type"),
        "outlet_type": F.trim("outlet_type"),
        "rating": bounded_rating("rating", strict),
        "order_date": parsed_date("order_date", strict),
    }
    return raw.select(*[typed[c].alias(c) for c in RAW_COLUMNS], *more)


def drop_copies(typed: DataFrame) -> DataFrame:
    """One row per identical typed row. Copies collapse map-side, so a large group costs no shuffle."""
    return typed.dropDuplicates()


# Of so many hashes a broadcast table takes some tens of MB.
MOST_REPEATED = 1_000_000


def unique_rows(typed: DataFrame, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The same rows as `drop_copies` gives, where copies are few, as in most extracts.

    Copies agree in item, outlet, sales and date, so only hashes of these are shuffled. A row that has its hash to itself
    is unique and stays where it is; the others are compared in full. With more repeated hashes than a broadcast may
    hold, all rows are compared. `store` keeps the typed rows, so that text is parsed once, the repeated hashes, and what
    is left of the rows that were compared. A row's hash would be a third of its stored size, so it is made when it is read.
    """
    hashed = store(typed, "typed").withColumn("_h", F.xxhash64(*GRAIN, "sales", "order_date"))
    repeated = store(hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_h"), "repeated")
    if repeated.count() > MOST_REPEATED:
        return store(drop_copies(hashed.select(typed.columns)), "compared")
    single = hashed.join(F.broadcast(repeated), "_h", "left_anti").select(typed.columns)
    again = hashed.join(F.broadcast(repeated), "_h", "left_semi").select(typed.columns)
    return single.unionAll(store(drop_copies(again), "compared"))


def median_weight_by_item(rows: DataFrame) -> DataFrame:
    return grouped_median(rows, ["item_identifier"], "item_weight", "item_median_weight")


def medians_by_type(rows: DataFrame) -> DataFrame:
    """Fallback weight and visibility of every category, in one small table."""
    weight = grouped_median(rows, ["item_type"], "item_weight", "type_median_weight")
    visibility = grouped_median(rows, ["item_type"], "item_visibility", "type_median_visibility")
    return weight.join(visibility, "item_type", "full_outer")


def impute(rows: DataFrame, by_item: DataFrame, by_type: DataFrame) -> DataFrame:
    """Fill weight (own median, else the category's) and visibility; flag what was filled.

    Only rows without a weight meet their item's median. No side is hinted. With stored lookups the planner knows
    their size: it broadcasts a small one and else sort-merge joins, where adaptive execution splits a hot item.
    """
    weighed = rows.where(F.col("item_weight").isNotNull()).withColumn(
        "item_median_weight", F.lit(None).cast(by_item.schema["item_median_weight"].dataType))
    unweighed = rows.where(F.col("item_weight").isNull()).join(by_item, "item_identifier", "left")
    weight = F.coalesce(F.col("item_weight"), F.col("item_median_weight"), F.col("type_median_weight"))
    visibility = F.coalesce(F.col("item_visibility"), F.col("type_median_visibility"))
    return (
        weighed.unionByName(unweighed)
        .join(by_type, "item_type", "left")
        .withColumns({
            "item_weight_imputed": F.col("item_weight").isNull().cast("int"),
            "item_visibility_imputed": F.col("item_visibility").isNull().cast("int"),
            "item_weight": F.round(weight, 3).cast("decimal(6,3)"),
            "item_visibility": F.round(visibility, 6).cast("decimal(9,6)"),
        })
        .drop("item_median_weight", "type_median_weight", "type_median_visibility")
    )


def add_age(df: DataFrame, base_year: int = BASE_YEAR) -> DataFrame:
    return df.withColumn("outlet_age_years", F.lit(base_year) - F.col("outlet_establishment_year"))


# The names `date_format` gives months (from January) and weekdays (from Sunday).
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
WEEKDAYS = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]


def _named(names: list[str], place: Column) -> Column:
    # Without the test, a missing place in an array of fixed names gives some name.
    return F.when(place.isNotNull(), F.element_at(F.array(*map(F.lit, names)), place))


def date_parts() -> dict[str, Column]:
    """Parts of the order date. Names are looked up by number, as formatting a date costs more than all the rest."""
    day = F.col("order_date")
    year, month = F.year(day), F.month(day)
    padded = F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))
    return {
        "order_year": year,
        "order_month": month,
        "order_month_name": _named(MONTHS, month),
        "order_quarter": F.quarter(day),
        "order_year_month": F.when(year.between(1, 9999), padded).otherwise(F.date_format(day, "yyyy-MM")),
        "order_weekday": _named(WEEKDAYS, F.dayofweek(day)),
        "is_weekend": F.dayofweek(day).isin(1, 7).cast("int"),
    }


def add_date_parts(df: DataFrame) -> DataFrame:
    return df.withColumns(date_parts())


def add_sale_id(df: DataFrame) -> DataFrame:
    """Surrogate key: the MD5 digest of a row's typed source columns, before anything is filled in.

    Unique rows have unique content, so a key needs no numbering, no sort and no state, and the same row gets the
    same key in every load, whatever its place and its neighbours. Two of 10^12 rows share one of the 2^128
    digests with a chance of 10^-15; `surrogate_key` counts them.
    """
    return df.withColumn("sale_id", _digest({c: F.col(c) for c in RAW_COLUMNS}))


def _digest(source: dict[str, Column]) -> Column:
    content = [F.coalesce(source[c].cast("string"), F.lit("\x1e")) for c in RAW_COLUMNS]
    return F.md5(F.concat_ws("\x1f", *content).cast("binary"))


def restore_sale_id(rows: DataFrame) -> DataFrame:
    """The key of rows that are filled in: what was filled in counts as missing, as it was before."""
    given = {c: F.when(F.col(f"{c}_imputed") == 0, F.col(c)) for c in ("item_weight", "item_visibility")}
    return rows.withColumn("sale_id", _digest({c: given.get(c, F.col(c)) for c in RAW_COLUMNS}))


def finish(rows: DataFrame, by_item: DataFrame, by_type: DataFrame, base_year: int = BASE_YEAR) -> DataFrame:
    """The steps after de-duplication."""
    return add_sale_id(rows).transform(impute, by_item, by_type).transform(add_age, base_year).transform(add_date_parts)


def deal_by_year(rows: DataFrame, by_item: DataFrame, by_type: DataFrame) -> DataFrame:
    """Filled rows, dealt out by order year and sorted by category inside: source columns, the flags and the year.

    Evenly sized partitions per year, a large year split by AQE.
    """
    filled = impute(rows, by_item, by_type).withColumn("order_year", date_parts()["order_year"])
    return filled.hint("rebalance", "order_year").sortWithinPartitions("order_year", "item_type")


def derive(dealt: DataFrame, base_year: int = BASE_YEAR) -> DataFrame:
    """The columns of the fact that follow from others."""
    parts = {name: part for name, part in date_parts().items() if name != "order_year"}
    return dealt.withColumns(parts).transform(add_age, base_year).transform(restore_sale_id)


def finish_by_year(rows: DataFrame, by_item: DataFrame, by_type: DataFrame, base_year: int = BASE_YEAR) -> DataFrame:
    """The rows of `finish`, dealt out by order year; only what `deal_by_year` gives is shuffled and sorted."""
    return deal_by_year(rows, by_item, by_type).transform(derive, base_year)


def clean(raw: DataFrame, base_year: int = BASE_YEAR, strict: bool = True) -> DataFrame:
    """The whole pipeline as one lazy plan; the planner reuses the de-duplication shuffle where it can.

    For extracts of moderate size. The workspace stores the unique rows and the lookups in
    between, which a large extract needs: only a join of stored tables is split on a hot item.
    """
    rows = raw.transform(type_columns, strict).transform(drop_copies)
    done = finish(rows, median_weight_by_item(rows), medians_by_type(rows), base_year)
    return done.select(FACT_COLUMNS)
