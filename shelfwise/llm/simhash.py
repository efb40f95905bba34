"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most `radius` bits apart have a value between them that is at most half the
radius from either. So every distinct fingerprint emits all values within half the radius, equal
values meet in one shuffle, and the pairs that meet are de-duplicated and verified. No bit
pattern is left out, so no link is lost. A value is met by no more fingerprints than there are
values within half the radius of it (65 for radius 2), so no group grows with the data: copies of
a text are one fingerprint before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import fresh, written
from .components import components

BITS = 64
SHINGLE = 3
RADIUS = 2
SEED = 42
#: Shingles whose bits are counted at once: bounds memory, whatever the length of a text.
BATCH = 50_000
_WHITE = " \t\n\x0b\x0c\r"


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of one text; zero without words."""
    import numpy as np
    from xxhash import xxh64_intdigest

    lowered = (text or "").translate(_lowercase())
    words = _word_pattern().findall(lowered)
    if not words:
        return 0
    count = max(len(words) - shingle + 1, 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, count, BATCH):
        stop = min(start + BATCH, count)
        hashes = np.fromiter(
            (xxh64_intdigest(" ".join(words[i:i + shingle]), SEED) for i in range(start, stop)), dtype="<u8",
            count=stop - start)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << bit for bit in range(BITS) if 2 * int(ones[bit]) > count)


def _lowercase() -> dict[int, int]:
    return {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}


def _word_pattern():
    import re

    return re.compile(f"[^{_WHITE}]+")


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprints(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, text_hash, fingerprint) per row of `df`; the fingerprint is a signed 64-bit number.

    Only the two named columns are read. A null or empty text, or one of white space, has
    fingerprint zero. `text_hash` tells rows that repeat an id apart.
    """
    source = df.select(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("text_hash"), F.col(text_column).alias("text"))
    kind = df.schema[id_column].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [_signed(fingerprint(t.as_py(), shingle)) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), pa.array(values, pa.int64())],
                names=["id", "text_hash", "fingerprint"])

    return source.mapInArrow(each, f"id {kind}, text_hash bigint, fingerprint bigint")


def _masks(half: int) -> Column:
    masks = [sum(1 << bit for bit in bits) for k in range(half + 1) for bits in combinations(range(BITS), k)]
    return F.array(*[F.lit(_signed(m)) for m in masks])


def _half(radius: int) -> int:
    if radius < 0 or radius % 2:
        raise ValueError("radius must be even: the value in the middle is half of it from either end")
    return radius // 2


def _balls(distinct: DataFrame, radius: int) -> DataFrame:
    """(variant, fingerprint): every value within half the radius of each fingerprint."""
    return distinct.select(
        F.explode(F.transform(_masks(_half(radius)), lambda m: F.col("fingerprint").bitwiseXOR(m))).alias("variant"),
        "fingerprint")


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All pairs (a, b), a < b, of distinct fingerprints at most `radius` bits apart, once each."""
    balls = _balls(prints.select("fingerprint").distinct(), radius)
    other = balls.withColumnRenamed("fingerprint", "b")
    return (balls.withColumnRenamed("fingerprint", "a").join(other, "variant").where("a < b")
            .select("a", "b").distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))


def _chains(prints: DataFrame, radius: int) -> DataFrame:
    """Verified links that connect whatever meets at a variant: each fingerprint with the one before it."""
    at_variant = Window.partitionBy("variant").orderBy("fingerprint")
    return (_balls(prints.select("fingerprint").distinct(), radius)
            .select(F.lag("fingerprint").over(at_variant).alias("a"), F.col("fingerprint").alias("b"))
            .where("a is not null").distinct()
            .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = RADIUS,
                    shingle: int = SHINGLE) -> DataFrame:
    """(id, text_hash, fingerprint, class, component_id) per row of `df`.

    class is the least fingerprint reachable by links and component_id the smallest id there, which
    is null only if all ids there are null. Rows of one fingerprint are linked, so repeated rows and
    all texts without words fall together. An empty table gives an empty table.
    """
    prints = written(fingerprints(df, id_column, text_column, shingle), "fingerprints")
    labels = components(_chains(prints, radius)).withColumnRenamed("node", "fingerprint")
    per_print = prints.groupBy("fingerprint").agg(F.min("id").alias("first_id"))
    classes = per_print.join(labels, "fingerprint", "left").select(
        "fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("class"))
    classes = written(classes, "classes")
    least = classes.groupBy("class").agg(F.min("first_id").alias("component_id"))
    members = classes.select("fingerprint", "class").join(least, "class")
    return prints.join(members, "fingerprint").select("id", "text_hash", "fingerprint", "class", "component_id")


def keep_one(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows of `df`, all columns, reduced to one of each class: that with the smallest id.

    Rows with an id come before rows without; among rows of one id the least text hash stays, and a
    row that repeats id and text stays once.
    """
    found = near_duplicates(df, id_column, text_column, radius)
    first = found.groupBy("class").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")).alias("first"))
    own_id, own_hash = fresh(df, "_id", "_hash")
    kept = first.select("first.id", "first.text_hash").distinct()
    # A row that repeats id and text has the same class, so the pair names one text.
    marked = df.withColumns({own_hash: F.xxhash64(text_column), own_id: F.col(id_column)})
    same = [marked[own_id].eqNullSafe(kept["id"]), marked[own_hash] == kept["text_hash"]]
    return marked.join(kept, same, "left_semi").dropDuplicates([own_id, own_hash]).drop(own_id, own_hash)
