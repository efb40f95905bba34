"""Quality by a logistic regression over hashed word n-grams.

A text is cut into words, numbers and strings of marks, in their own case, as junk shows in marks and
capitals as much as in words. It is read twice: as words, and as the words' forms (in lower case, in
capitals, repeated and so on), so that what is learnt about one word's misuse holds for words never
seen. The n-grams of both readings are hashed into 2 ** BITS places; a place weighs 1 plus the
logarithm of its count, and the weights of a reading are scaled to a length of nearly 1, or less if the
text has only a few words, which say less. A score is the logistic curve of the sparse dot product
with the model's weights.

The weights are learnt by follow-the-regularised-leader updates, one labelled text after another, with
a learning rate of its own per place. The labelled rows are dealt into SHARDS shards by their ids'
hashes and stored, a file each. In each round every shard starts from the same state and goes through
its rows once, streaming them; then Spark averages, place by place, the states of the shards that met the place. State and
weights have 2 ** BITS numbers, whatever the size of the data. The intercept isn't learnt: it is the
logarithm of the odds of the sample's labels, so a text that says nothing scores the share of label 1.

The labelled rows are a sample of some ROWS, chosen by a share of the ids' hashes.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import written

#: Places of the n-grams, as a power of two, and the longest n-grams of words and of forms.
BITS, LONGEST, LONGEST_FORMS = 17, 2, 3
#: Added to a reading's squared length before it is scaled.
SHORT = 4.0
#: Bound of the sample of labelled rows.
ROWS = 6_000
SHARDS, ROUNDS = 4, 6
#: Learning rate and its offset, and the penalties on the weights' size and square.
ALPHA, BETA, L1, L2 = 1.5, 1.0, 0.02, 0.02
#: Hashes of words that a task remembers.
REMEMBERED = 1 << 17
TOKEN = re.compile(r"[^\W\d_]+|\d+|(?:[^\w\s]|_)+")
_PLACES = 1 << 30
_MIX = np.uint64(0x9E3779B97F4A7C15)


def form(word: str) -> int:
    """A word's form: number, marks, lower case, capitals, one capital first, or mixed and without case."""
    if word[0].isdigit():
        return 1
    if not word[0].isalpha():
        return 2
    if word.islower():
        return 3
    if word.isupper():
        return 4 if len(word) > 1 else 5
    return 6 if word.istitle() else 7


#: The form of a word that is the same as the word before it.
REPEATED = 8


class Hasher:
    """Sparse vectors of texts."""

    def __init__(self, bits: int = BITS):
        self.shift = np.uint64(64 - bits)
        self.known: dict[str, int] = {}

    def _number(self, word: str) -> int:
        """A number of the word that has its form in the last four bits."""
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        value = self.known[word] = zlib.crc32(word.encode()) << 4 | form(word)
        return value

    def _grams(self, units: np.ndarray, longest: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
        grams, rolled = [], np.full(len(units), seed, dtype=np.uint64)
        for size in range(min(longest, len(units))):
            # An n-gram's hash: the hash of its first n - 1 words, turned over, and its last word's.
            rolled = rolled[:len(units) - size] * _MIX + units[size:] + np.uint64(1)
            grams.append(((rolled ^ (rolled >> np.uint64(29))) * _MIX) >> self.shift)
        places, often = np.unique(np.concatenate(grams), return_counts=True)
        weights = 1.0 + np.log(often)
        return places.astype(np.int64), weights / math.sqrt(float(weights @ weights) + SHORT)

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(distinct places, weights) of the text's n-grams; none for a text without words and marks."""
        words = TOKEN.findall(text or "")
        if not words:
            return np.empty(0, np.int64), np.empty(0)
        known, unknown = self.known.get, self._number
        units = np.fromiter((known(w) or unknown(w) for w in words), np.uint64, count=len(words))
        forms = units & np.uint64(15)
        forms[1:][units[1:] == units[:-1]] = REPEATED
        both = [self._grams(units, LONGEST, 1), self._grams(forms, LONGEST_FORMS, 2)]
        places, at = np.unique(np.concatenate([p for p, _ in both]), return_inverse=True)
        return places, np.bincount(at, np.concatenate([w for _, w in both]), minlength=len(places))


@dataclass
class State:
    """Per place: the sum of adjusted gradients and the sum of squared ones."""

    z: np.ndarray
    n: np.ndarray
    intercept: float

    def copy(self) -> State:
        return State(self.z.copy(), self.n.copy(), self.intercept)

    def weights(self, places) -> np.ndarray:
        z, n = self.z[places], self.n[places]
        return np.where(np.abs(z) > L1, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        """One follow-the-regularised-leader update; places are distinct."""
        w = self.weights(places)
        gradient = (logistic(float(w @ values) + self.intercept) - label) * values
        n = self.n[places]
        more = n + gradient * gradient
        self.z[places] += gradient - (np.sqrt(more) - np.sqrt(n)) / ALPHA * w
        self.n[places] = more


def logistic(x: float) -> float:
    return 1.0 / (1.0 + math.exp(-min(max(x, -60.0), 60.0)))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, rows: int) -> DataFrame:
    """(place, quality, text): some `rows` labelled texts, those whose ids' hashes lie under a share.

    Rows without a label of 0 or 1, without an id or without a text are left out. An id labelled twice is
    of quality if no label says otherwise; of equal texts the row with the least id stays.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = written(known, "labels")
    share = min(1.0, rows / max(known.count(), 1))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(_PLACES))
    # Some `rows` pairs of numbers are broadcast.
    chosen = known.where(place < int(share * _PLACES)).select(F.col("doc_id").alias("id"), "quality", place.alias("place"))
    own = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).where("text is not null")
    return own.join(F.broadcast(chosen), "id").groupBy(F.xxhash64("text").alias("hash")).agg(
        F.min(F.struct("id", "quality", "place", "text")).alias("row")).select("row.place", "row.quality", "row.text")


def _vectors(sample: DataFrame, bits: int) -> DataFrame:
    """(shard, place, quality, places, weights) of the sampled texts, a shard's rows one after another."""
    dealt = sample.select(
        F.pmod("place", F.lit(SHARDS)).alias("shard"), "place", F.col("quality").cast("int").alias("quality"), "text",
    ).repartition(SHARDS, "shard").sortWithinPartitions("shard", "place")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(bits)
        for batch in batches:
            coded = [hasher.vector(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in ("shard", "place", "quality")), pa.array([p.astype(np.int32) for p, _ in coded], pa.list_(pa.int32())),
                pa.array([w for _, w in coded], pa.list_(pa.float64()))], names=["shard", "place", "quality", "places", "weights"])

    return dealt.mapInArrow(each, "shard bigint, place bigint, quality int, places array<int>, weights array<double>")


def _round(rows: DataFrame, state: State) -> State:
    """Every shard goes through its rows once from `state`; the states are averaged."""
    shared = rows.sparkSession.sparkContext.broadcast(state)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, own, met = None, None, None

        def result() -> pa.RecordBatch:
            at = np.flatnonzero(met)
            return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(own.z[at]), pa.array(own.n[at])], names=["at", "z", "n"])

        for batch in batches:
            for k, y, p, v in zip(batch.column("shard"), batch.column("quality"), batch.column("places"), batch.column("weights")):
                if k.as_py() != shard:
                    if shard is not None:
                        yield result()
                    shard, own, met = k.as_py(), shared.value.copy(), np.zeros(len(shared.value.z), bool)
                places = p.values.to_numpy()
                own.learn(places, v.values.to_numpy(), y.as_py())
                met[places] = True
        if shard is not None:
            yield result()

    # A shard is a file, of one row group up to 128 MB, which no two tasks share; a task that has several files takes them in turn.
    found = rows.mapInArrow(each, "at int, z double, n double").groupBy("at").agg(F.avg("z").alias("z"), F.avg("n").alias("n")).toArrow()
    # A row per place at most.
    after, at = state.copy(), found.column("at").to_numpy()
    after.z[at], after.n[at] = found.column("z").to_numpy(), found.column("n").to_numpy()
    shared.unpersist()
    return after


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", rows: int = ROWS, bits: int = BITS) -> np.ndarray:
    """Weights per place and, last, the intercept, from `labels` (doc_id, quality) and the texts they name.

    Without labelled texts all are zero. The labels decide which rows are learnt from: leave those
    of held-out documents out. The result doesn't depend on how the tables are cut into files.
    """
    coded = written(_vectors(labelled_sample(docs, labels, id_column, text_column, rows), bits), "quality-sample")
    of_quality, total = coded.agg(F.coalesce(F.sum("quality"), F.lit(0)), F.count("*")).first()
    state = State(np.zeros(1 << bits), np.zeros(1 << bits), math.log((of_quality + 1) / (total - of_quality + 1)))
    for _ in range(ROUNDS):
        state = _round(coded, state)
    return np.append(state.weights(slice(None)), state.intercept)


def score(df: DataFrame, weights: np.ndarray, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, text_hash, score) per row of `df`; the score is the likelihood of label 1, from 0 to 1.

    A text that is null, empty or without a word or mark has no n-gram: its score is that of the
    intercept alone. Whole texts count, however long. Repeated rows repeat, ids may be null, and an empty
    table gives an empty table. Only the two named columns are read.
    """
    kind = df.schema[id_column].dataType.simpleString()
    shared, bits = df.sparkSession.sparkContext.broadcast(weights), (len(weights) - 1).bit_length() - 1
    source = df.select(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("text_hash"), F.col(text_column).alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, own = Hasher(bits), shared.value
        for batch in batches:
            coded = (hasher.vector(t.as_py()) for t in batch.column("text"))
            scores = [logistic(float(own[p] @ v) + float(own[-1])) for p, v in coded]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), pa.array(scores, pa.float64())], names=["id", "text_hash", "score"])

    return source.mapInArrow(each, f"id {kind}, text_hash bigint, score double")
