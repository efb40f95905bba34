"""A training corpus in stages: each is one operator over what the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm import decontaminate, line_dedup, sentencepiece_bpe, simhash, toxicity
from shelfwise.llm.common import model_path, table, written


def ordinary(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject go; they learn from the labels and from `docs`."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many documents of a source go, long ones stay in one document of all; n_chars follows the text. No document goes."""
    cleaned = line_dedup.drop_repeats(written(line_dedup.drop_boilerplate(docs, "source", "text"), "without-boilerplate"), "doc_id", "text")
    changed = F.when(F.col("n_dropped") + F.col("n_repeats") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", changed).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of copies by fingerprint, three-word shingles and two bits, one document stays."""
    return simhash.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.encode_decode(docs, model_path("piece_bpe_32k.model")).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", ordinary),
    ("line_dedup", without_boilerplate),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", uncontaminated),
    ("sentencepiece", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
