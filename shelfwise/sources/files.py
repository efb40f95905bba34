"""File readers and writers of the pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schema import FACT_SCHEMA, RAW_COLUMNS, RAW_HEADER, REPORT_COLUMNS
from .publish import Part, publish, published, published_all

CSV = {"header": "true", "escape": '"', "dateFormat": "yyyy-MM-dd"}
# As text the fact takes some ten times the room of its Parquet files, most of it repeated labels. A compressed file is read by
# one task, so its rows are limited.
STORED_CSV = CSV | {"compression": "gzip", "zlib.compress.level": "FOUR", "maxRecordsPerFile": "1000000"}


def _strict(spark: SparkSession):
    """A silent NULL is worse than a loud failure: any other header, a short line or a bad value fails the job."""
    return (
        spark.read.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
        .option("columnPruning", False).option("quote", '"').option("escape", '"'))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw extract: 13 text columns, blank cells missing, nothing inferred.

    The header must name the columns in their order, and every line must have all of them.
    """
    titled = T.StructType([T.StructField(title, T.StringType()) for title in RAW_HEADER])
    return _strict(spark).schema(titled).csv(path).toDF(*RAW_COLUMNS)


# Columns that the lenient reader adds: the text of a malformed line, and where a row stands.
LINE = "_line"
PLACE = ["file", "block_start"]


def read_raw_lenient(spark: SparkSession, path: str) -> DataFrame:
    """The extract with short and long lines kept apart: their text is in `_line`, which is NULL for a good line.

    A row's place is its file and where the part of the file starts that was read with it. The header must
    be right here, too.
    """
    titled = T.StructType([*[T.StructField(title, T.StringType()) for title in RAW_HEADER], T.StructField(LINE, T.StringType())])
    read = (
        spark.read.option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE)
        .option("columnPruning", False).option("quote", '"').option("escape", '"').schema(titled).csv(path))
    placed = read.select("*", F.col("_metadata.file_path").alias(PLACE[0]), F.col("_metadata.file_block_start").cast("string").alias(PLACE[1]))
    return placed.toDF(*RAW_COLUMNS, LINE, *PLACE)


def write_raw(raw: DataFrame, path: str) -> None:
    """Write an extract as the readers expect it, outer spaces kept."""
    titled = raw.select([F.col(c).alias(h) for h, c in RAW_HEADER.items()])
    (
        titled.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_fact(fact: DataFrame, path: str, rules: dict[str, Column] | None = None) -> None:
    """Publish the fact table; one folder per order year, so year ranges prune files. A row that breaks a rule rejects the load."""
    publish(path, {"fact": Part(fact.hint("rebalance", "order_year"), ["order_year"], rules=rules or {})})


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return published(spark, path, "fact").select(FACT_SCHEMA.fieldNames())


def write_clean_csv(fact: DataFrame, path: str) -> None:
    publish(path, {"clean": Part(fact, format="csv", options=STORED_CSV)})


def read_clean_csv(spark: SparkSession, path: str, columns: list[str] = REPORT_COLUMNS) -> DataFrame:
    """Typed columns of the report layer from the flat clean extract; a bad value fails the job."""
    strict = {"mode": "FAILFAST", "enforceSchema": "false", "columnPruning": "false", "quote": '"'}
    return published(spark, path, "clean", CSV | strict, FACT_SCHEMA).select(columns)


def write_aggregates(tables: dict[str, DataFrame], folder: str) -> None:
    """Publish all aggregate tables together, so that no reader mixes two loads."""
    publish(folder, {name: Part(table) for name, table in tables.items()})


def read_aggregates(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return published_all(spark, folder)


def write_facts(facts: DataFrame, path: str) -> None:
    """One JSON record; the frame has one row, so one task is enough."""
    publish(path, {"facts": Part(facts.coalesce(1), format="json")})


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    return published(spark, path, "facts")
