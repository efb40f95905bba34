"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

An item gives windows of `width` consecutive words (one shorter window if it has fewer words).
A document holds a window only if it holds every shingle of it, so for full containment one
shingle is a sufficient prefix, and the rarest is the best one:

1. Count in all documents how often each shingle of the windows occurs.
2. Order a window's shingles by that count and take the first; a window with a shingle that no
   document has can't occur and is left out.
3. Join the documents' shingles with these. A match at a position fixes where the window would
   have to start and end; both must lie inside the document (positional and length bounds).
4. Compare the document's words there with the window's words: the exact containment.

Documents are not shuffled: they stream past the windows, which are broadcast in blocks of at
most `block` windows, one pass per block. What leaves a pass is a row per document and a row per
occurrence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower, written

#: Characters of a word: ASCII letters and digits and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WIDTH = 10
SHINGLE = 5
#: Windows broadcast at once: at 10 words of 10 bytes some 50 MB. More windows take more passes.
BLOCK = 200_000


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words of a text in order; none for null."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, item_column: str, text_column: str, width: int) -> DataFrame:
    """(item, window array<string>): the distinct windows of each item."""
    worded = items.select(F.col(item_column).alias("item"), words(F.col(text_column)).alias("words")).where(F.size("words") > 0)
    starts = worded.select("item", "words", F.explode(F.sequence(
        F.lit(1), F.greatest(F.size("words") - F.lit(width - 1), F.lit(1)))).alias("start"))
    return starts.select("item", F.slice("words", F.col("start"), F.lit(width)).alias("window")).distinct()


def _shingle_hash(words_column: str, at: Column, length: int) -> Column:
    """Hash of `length` words from the 0-based position `at`; the length is part of it."""
    return F.xxhash64(F.lit(length), *[F.get(F.col(words_column), at + k) for k in range(length)])


def _shingles_of_windows(windows: DataFrame, lengths: list[int], shingle: int) -> DataFrame:
    """(window, offset, hash) of every shingle; a window shorter than a shingle is one itself."""
    by_length = [
        windows.where(F.least(F.size("window"), F.lit(shingle)) == length)
        .select("window", F.explode(F.sequence(F.lit(0), F.size("window") - length)).alias("offset"))
        .select("window", "offset", _shingle_hash("window", F.col("offset"), length).alias("hash"))
        for length in lengths]
    out = by_length[0]
    for more in by_length[1:]:
        out = out.unionByName(more)
    return out


def _positions(worded: DataFrame, lengths: list[int], marker: bool) -> DataFrame:
    """`worded` with (pos, hash) for each shingle; with `marker` one more row per document at -1."""
    # An empty document has no position but the marker.
    last = F.size("words") - 1
    spread = worded.select("*", F.explode(F.sequence(F.lit(-1), F.greatest(last, F.lit(-1)))).alias("pos")) if marker else (
        worded.where(last >= 0).select("*", F.explode(F.sequence(F.lit(0), last)).alias("pos")))

    def hash_at(length: int) -> Column:
        inside = (F.col("pos") >= 0) & (F.col("pos") + length <= F.size("words"))
        return F.when(inside, _shingle_hash("words", F.col("pos"), length))

    if len(lengths) == 1:
        return spread.select("*", hash_at(lengths[0]).alias("hash"))
    # The marker has one row, whatever the number of lengths.
    hashes = F.when(F.col("pos") < 0, F.array(F.lit(None).cast("bigint"))).otherwise(F.array_compact(F.array(*map(hash_at, lengths))))
    return spread.select("*", F.explode(hashes).alias("hash"))


def decontaminate(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
    item_text: str = "text", width: int = WIDTH, shingle: int = SHINGLE, block: int = BLOCK,
) -> DataFrame:
    """(id, text_hash, n_words, n_hit, items, contaminated) per row of `docs`.

    n_hit counts the document's words inside any occurrence of a window, items holds the ids of the
    items with occurring windows as strings in order. Null and empty texts have no words; items
    without words have no windows; items with a null id still mark words but are not listed.
    Repeated rows repeat in the result. Without documents or items nothing is hit.
    """
    pairs = written(item_windows(items, item_column, item_text, width), "windows")
    windows = written(pairs.groupBy("window").agg(F.count("*").alias("n_items")), "distinct-windows")
    sizes = windows.agg(F.count("*"), F.collect_set(F.least(F.size("window"), F.lit(shingle)))).first()
    blocks, lengths = max(1, -(-sizes[0] // block)), sorted(sizes[1]) or [shingle]
    key = F.col(id_column).alias("id"), F.xxhash64(text_column).alias("text_hash")
    worded = docs.select(*key, words(F.col(text_column)).alias("words"))

    parts = []
    for number in range(blocks):
        own = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == number)
        shingles = _shingles_of_windows(own, lengths, shingle)
        counts = (_positions(worded.select("words"), lengths, marker=False).select("hash")
                  .join(F.broadcast(shingles.select("hash").distinct()), "hash").groupBy("hash").agg(F.count("*").alias("n")))
        rarest = (shingles.join(written(counts, "rarity"), "hash", "left").groupBy("window")
                  .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "hash")).alias("prefix"))
                  .where("prefix.n > 0"))
        prefix = written(rarest.select("window", "prefix.offset", F.col("prefix.hash").alias("prefix_hash")), "prefix")
        marker = number == 0
        at, start = _positions(worded, lengths, marker), F.col("pos") - F.col("offset")
        holds = ((F.col("hash") == F.col("prefix_hash")) & (start >= 0) & (start + F.size("window") <= F.size("words"))
                 & (F.slice("words", F.greatest(start, F.lit(0)) + 1, F.size("window")) == F.col("window")))
        met = at.join(F.broadcast(prefix), holds, "left" if marker else "inner").where("pos < 0 or window is not null")
        parts.append(met.select(
            "id", "text_hash", (F.col("pos") < 0).alias("marker"), F.size("words").alias("n_words"), "window",
            F.when(F.col("window").isNotNull(), F.struct(start.alias("start"), (start + F.size("window")).alias("stop"))).alias("span")))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)

    per_text = written(found.groupBy("id", "text_hash").agg(
        F.count_if("marker").alias("copies"), F.max("n_words").cast("bigint").alias("n_words"),
        F.collect_set("span").alias("spans"), F.collect_set("window").alias("windows")), "hits")
    zero = F.struct(F.lit(0).cast("bigint").alias("covered"), F.lit(0).alias("stop"))
    covered = F.aggregate(F.array_sort("spans"), zero, lambda done, span: F.struct(
        (done["covered"] + F.greatest(span["stop"] - F.greatest(span["start"], done["stop"]), F.lit(0))).alias("covered"),
        F.greatest(span["stop"], done["stop"]).alias("stop")), lambda done: done["covered"])
    listed = (per_text.where(F.size("windows") > 0).select("id", "text_hash", F.explode("windows").alias("window"))
              .join(pairs.where("item is not null"), "window").groupBy("id", "text_hash")
              .agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items")))
    listed = listed.withColumnsRenamed({"id": "_id", "text_hash": "_hash"})
    same = per_text["id"].eqNullSafe(listed["_id"]) & per_text["text_hash"].eqNullSafe(listed["_hash"])
    joined = per_text.join(listed, same, "left").withColumn("n_hit", covered)
    return joined.select(
        "id", "text_hash", "n_words", "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.col("n_hit") > 0).alias("contaminated"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).drop("_copy")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                      item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, without those that hold a window of an item."""
    hit = (decontaminate(docs, items, id_column, text_column, item_column, item_text).where("contaminated")
           .select(F.col("id").alias("_hit_id"), F.col("text_hash").alias("_hit_hash")).distinct())
    same = [docs[id_column].eqNullSafe(hit["_hit_id"]), F.xxhash64(docs[text_column]) == hit["_hit_hash"]]
    return docs.join(hit, same, "left_anti")
