"""Language identification by compression.

A zstandard raw-content dictionary per language holds text of that language. A text is compressed
with each; the language whose dictionary gives the fewest bytes is the prediction. Texts are
compressed in blocks, each with a fresh dictionary, so that a long text doesn't become its own
dictionary and memory stays bounded; the whole text counts, in lower case.

The dictionaries are the fitted model: a bounded sample of labelled texts, at most `ROWS` texts
and `DICTIONARY` bytes a language, chosen by the texts' hashes, each distinct text once. A text
fills at most a fiftieth of a dictionary; of a longer one `PIECES` pieces are taken, spread over it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Bounds of the sample a language's dictionary is made of.
ROWS, DICTIONARY = 400, 250_000
#: Part of a dictionary that one text may fill, and the pieces taken of a longer text.
PART, PIECES = 50, 5
#: Bytes compressed at once, and the compressor's level.
BLOCK, LEVEL = 2_048, 9
#: Share by which the second best must be larger, or the prediction is marked as rejected.
MARGIN = 0.01
UNKNOWN = "und"
_STEEPNESS = 40.0


def extract(text: Column, length: int) -> Column:
    """`text`, or of a longer one `length` characters: equal pieces from its start to its end."""
    piece = length // PIECES
    step = (F.length(text) - piece) / (PIECES - 1)
    pieces = [F.substring(text, F.floor(step * i).cast("int") + 1, F.lit(piece)) for i in range(PIECES)]
    return F.when(F.length(text) <= length, text).otherwise(F.concat(*pieces))


def dictionaries(labelled: DataFrame, text_column: str = "text", lang_column: str = "lang", rows: int = ROWS,
                 size: int = DICTIONARY) -> dict[str, bytes]:
    """Dictionary of each language of `labelled`, from texts with a letter; empty without any.

    A language is cut at the share of hashes that gives some `rows` distinct texts, so none is ranked or
    gathered, and only the chosen texts' pieces are shuffled. Copies of a text count once, however many there
    are; of different texts with the same hash the least counts.
    """
    texts = labelled.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("hash", F.shiftrightunsigned(F.xxhash64("text"), 1))
    # A dictionary is kept per language, so a row per language may be broadcast, too.
    shares = texts.groupBy("lang").agg(F.least(F.lit(1.0), rows / F.approx_count_distinct("hash", 0.02)).alias("share"))
    chosen = texts.join(F.broadcast(shares), "lang").where(F.col("hash") <= F.col("share") * float(1 << 63))
    found = chosen.groupBy("lang", "hash").agg(F.min(extract(F.col("text"), max(PIECES, size // PART))).alias("text"))
    out: dict[str, list[str]] = {}
    for row in found.orderBy("lang", "hash").toLocalIterator():
        own = out.setdefault(row["lang"], [])
        if len(own) < rows:
            own.append(row["text"])
    return {lang: "\n".join(texts).lower().encode()[:size] for lang, texts in out.items()}


class Classifier:
    def __init__(self, contents: dict[str, bytes]):
        import zstandard

        def compressor(content: bytes):
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(
                level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)

        self.compressors = {lang: compressor(content) for lang, content in sorted(contents.items())}

    def sizes(self, text: str) -> dict[str, int]:
        """Compressed bytes of the whole text per language."""
        data = memoryview(text.lower().encode())
        blocks = [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]
        return {lang: sum(len(c.compress(block)) for block in blocks) for lang, c in self.compressors.items()}

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, accepted); the first language in alphabetical order of equally good ones."""
        if not text or not self.compressors or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, False
        ranked = sorted((size, lang) for lang, size in self.sizes(text).items())
        best, lang = ranked[0]
        second = ranked[1][0] if len(ranked) > 1 else math.inf
        margin = 1.0 - best / second
        return lang, 1.0 / (1.0 + math.exp(-_STEEPNESS * min(margin, 1.0))), margin >= MARGIN


@lru_cache(maxsize=2)
def _classifier(contents: tuple[tuple[str, bytes], ...]) -> Classifier:
    return Classifier(dict(contents))


def predict(df: DataFrame, contents: dict[str, bytes], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, lang_pred, score, accepted) per row of `df`; only the two named columns are read.

    A text that is null or has no letter, and any text if no language was learnt, is `und` with
    score 0 and not accepted. score is 0.5 where the two best are equal and rises with the margin.
    Repeated rows each get their own; an empty table gives an empty table.
    """
    kind = df.schema[id_column].dataType.simpleString()
    frozen = tuple(sorted(contents.items()))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _classifier(frozen)
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column("text")]
            lang, score, accepted = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())],
                names=["id", "lang_pred", "score", "accepted"])

    source = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return source.mapInArrow(each, f"id {kind}, lang_pred string, score double, accepted boolean")
