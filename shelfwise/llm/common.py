"""Helpers the operators of this package share."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.store import written  # noqa: F401  (for the operators)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that `df` has no column of, whatever its own are called."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z, every other character stays; `lower` does just that where a text is pure ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def fold(id_column: str) -> Column:
    """crc32 of the id as text, by which contracts split rows into folds; null for a null id."""
    return F.crc32(F.col(id_column).cast("string"))


def hex_digest(text: Column) -> Column:
    return F.sha2(text, 256)


def model_path(name: str) -> str:
    """Place of a public tokenizer file; the same on every machine that has the package."""
    import public_tokenizers

    return str(PurePosixPath(public_tokenizers.path(name)))
