"""Sums of the fact table at the grains that most reports start from.

Each is built once; a report then reads thousands of rows instead of the whole fact.
All carry the same additive measures, so averages stay exact at any coarser grain.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.exact import total
from ..schema import OUTLET_ATTRIBUTES

PRODUCT_KEYS = ["item_identifier", "item_type", "item_fat_content"]
OUTLET_KEYS = [*OUTLET_ATTRIBUTES, "order_year"]
SHELF_KEYS = [*OUTLET_ATTRIBUTES, "item_type"]
# Calendar months times enumerated labels times categories: a size that does not grow with the rows.
CELL_KEYS = [
    "order_year", "order_quarter", "order_month", "order_month_name", "order_year_month", "is_weekend", "item_type",
    "item_fat_content", "outlet_type", "outlet_size", "outlet_location_type",
]

STOCK_KEYS = [*PRODUCT_KEYS, *OUTLET_ATTRIBUTES]
# A rating has one decimal, so this is a few dozen rows per category.
RATING_KEYS = ["item_type", "stars"]


def roll_up(fact: DataFrame, keys: list[str]) -> DataFrame:
    return fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"), total("sales").alias("sales"), total("rating").alias("rating"),
        total("item_visibility").alias("item_visibility"), total("item_weight").alias("item_weight"),
        F.count("item_weight").alias("weighed"), F.sum("item_weight_imputed").alias("item_weight_imputed"),
        F.sum("item_visibility_imputed").alias("item_visibility_imputed"),
        F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"))


def product_rollup(fact: DataFrame) -> DataFrame:
    return roll_up(fact, PRODUCT_KEYS)


def outlet_rollup(fact: DataFrame) -> DataFrame:
    return roll_up(fact, OUTLET_KEYS)


def shelf_rollup(fact: DataFrame) -> DataFrame:
    return roll_up(fact, SHELF_KEYS)


def stock_rollup(fact: DataFrame) -> DataFrame:
    """Product x outlet: what is sold where, with the largest and smallest sale."""
    return fact.groupBy(*STOCK_KEYS).agg(
        F.count(F.lit(1)).alias("records"), total("sales").alias("sales"), total("rating").alias("rating"),
        F.max("sales").alias("high"), F.min("sales").alias("low"))


def rating_rollup(fact: DataFrame) -> DataFrame:
    """Category x rating; `stars` is the rating, `rating` its sum."""
    return roll_up(fact.withColumn("stars", F.col("rating")), RATING_KEYS)


def cell_rollup(fact: DataFrame) -> DataFrame:
    return roll_up(fact, CELL_KEYS)


# Fields that the tiles of the dashboard can be filtered on; all are enumerated or calendar years.
FILTER_FIELDS = ["item_type", "outlet_type", "outlet_location_type", "outlet_size", "order_year", "item_fat_content"]
# Filter fields that a product doesn't fix.
STORE_FIELDS = [c for c in FILTER_FIELDS if c not in PRODUCT_KEYS]


def star_rollup(fact: DataFrame) -> DataFrame:
    """Filter fields x rating: rows only. No more rows than combinations of labels, years and some 40 ratings."""
    return fact.groupBy(*FILTER_FIELDS, F.col("rating").alias("stars")).agg(F.count(F.lit(1)).alias("records"))


def assortment_rollup(fact: DataFrame) -> DataFrame:
    """Product x filter fields: sums per product under any choice of the other fields."""
    return fact.groupBy(*PRODUCT_KEYS, *STORE_FIELDS).agg(F.count(F.lit(1)).alias("records"), total("sales").alias("sales"))


def number_items(sold: DataFrame) -> DataFrame:
    """(item_identifier, item_number): a number per item. The numbers of a task are dense, so they fill whole bitmaps."""
    return sold.select("item_identifier").distinct().withColumn("item_number", F.monotonically_increasing_id())


def item_bitmaps(assortment: DataFrame, numbers: DataFrame) -> DataFrame:
    """Filter fields x bucket of item numbers: which items of the bucket are sold there.

    Bitmaps of any cells can be united, so distinct items are counted under every choice without their names.
    A cell has a bitmap of 4 KB per 32,768 item numbers it meets. The numbers are dealt out by cell and bucket before
    any bitmap is made: made where the rows lie, every task would shuffle bitmaps of 4 KB for a few items each. A
    number stands for a cell's labels meanwhile; there are no more cells than combinations of labels and years.
    """
    labels = assortment.select(FILTER_FIELDS).distinct()
    cells = F.broadcast(labels.withColumn("cell", F.row_number().over(Window.orderBy(*FILTER_FIELDS))))
    same = reduce(lambda a, b: a & b, [F.col(f"sold.{c}").eqNullSafe(F.col(f"cells.{c}")) for c in FILTER_FIELDS])
    sold = assortment.alias("sold").join(cells.alias("cells"), same).select("sold.item_identifier", "cells.cell")
    bucket, bit = F.bitmap_bucket_number("item_number"), F.bitmap_bit_position("item_number")
    dealt = sold.join(numbers, "item_identifier").select(
        "cell", bucket.alias("bucket"), bit.cast("int").alias("bit")).repartition("cell", "bucket")
    made = dealt.groupBy("cell", "bucket").agg(F.bitmap_construct_agg(F.col("bit").cast("bigint")).alias("items"))
    return made.join(cells, "cell").select(*FILTER_FIELDS, "bucket", "items")


def count_items(bitmaps: DataFrame) -> DataFrame:
    """One row: `products`, the distinct items in the given bitmaps."""
    united = bitmaps.groupBy("bucket").agg(F.bitmap_or_agg("items").alias("items"))
    return united.agg(F.coalesce(F.sum(F.bitmap_count("items")), F.lit(0)).alias("products"))
