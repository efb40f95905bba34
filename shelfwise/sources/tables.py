"""The raw extract derived from the order tables.

Those tables are clean and typed; the pipeline starts from dirty text. The mapping is
deterministic: blanks, sentinels, spellings and copies depend on the keys alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schema import RAW_COLUMNS

LOW_FAT_SPELLINGS = ["Low Fat", "low fat", "Low Fat ", "LF"]
REGULAR_SPELLINGS = ["Regular", "reg", " Regular"]
SIZES = ["", "Small", "Medium", "High"]
FORMATS = ["Grocery Store", "Supermarket Type1", "Supermarket Type2", "Supermarket Type3"]
COPY_EVERY = 601  # every 601st order is loaded twice
BLANK_WEIGHT_EVERY = 6
MOST_STORES = 1_000_000  # of so many stores a broadcast table takes some tens of MB


def _label(labels: list[str], place: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, labels)), (place + 1).cast("int"))


def _pick(labels: list[str], key: str) -> Column:
    return _label(labels, F.col(key) % len(labels))


def raw_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    def read(name: str, *columns: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)

    lines = read(
        "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount",
        "l_tax", "l_linestatus",
    )
    # Copies are made by exploding, so the table is read and joined once.
    copies = F.when(F.col("l_orderkey") % COPY_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    # What depends on a line alone is settled before the joins, so that they shuffle narrow rows.
    low_fat = F.col("l_linestatus") == "O"
    narrow = lines.withColumn("_copy", F.explode(copies)).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", low_fat.alias("_low_fat"),
        F.when(low_fat, F.col("l_orderkey") % len(LOW_FAT_SPELLINGS)).otherwise(F.col("l_orderkey") % len(REGULAR_SPELLINGS))
        .cast("tinyint").alias("_spelling"),
        ((F.col("l_orderkey") + F.col("l_linenumber")) % BLANK_WEIGHT_EVERY == 0).alias("_blank_weight"))
    orders = read("orders", "o_orderkey", "o_orderdate", "o_orderpriority").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), F.substring("o_orderpriority", 1, 1).alias("_priority"))
    supplier = read("supplier", "s_suppkey", "s_nationkey")
    stores = supplier.join(F.broadcast(read("nation", "n_nationkey", "n_regionkey")), F.col("s_nationkey") == F.col("n_nationkey"))
    joined = (
        narrow.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(read("part", "p_partkey", "p_type", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
        .join(F.broadcast(stores) if supplier.count() <= MOST_STORES else stores, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    rating = F.col("_priority").cast("double") + F.col("l_tax")
    return joined.select(
        F.col("l_partkey").cast("string").alias("item_identifier"),
        F.when(F.col("_blank_weight"), "").otherwise(F.col("p_size").cast("string")).alias("item_weight"),
        F.when(F.col("_low_fat"), _label(LOW_FAT_SPELLINGS, F.col("_spelling")))
        .otherwise(_label(REGULAR_SPELLINGS, F.col("_spelling"))).alias("item_fat_content"),
        F.col("l_discount").cast("decimal(9,6)").cast("string").alias("item_visibility"),
        F.col("p_type").alias("item_type"),
        F.col("l_suppkey").cast("string").alias("outlet_identifier"),
        (F.col("l_suppkey") % 25 + 1985).cast("string").alias("outlet_establishment_year"),
        _pick(SIZES, "l_suppkey").alias("outlet_size"),
        F.concat(F.lit("Tier "), (F.col("n_regionkey") % 3 + 1).cast("string")).alias("outlet_location_type"),
        _pick(FORMATS, "n_nationkey").alias("outlet_type"),
        F.col("l_extendedprice").cast("decimal(10,4)").cast("string").alias("sales"),
        rating.cast("decimal(4,3)").cast("string").alias("rating"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
    ).select(RAW_COLUMNS)
