"""Toxicity by class-conditional Kneser-Ney models.

A class's model gives each word the share of its continuation count: the number of different words
that the class has in front of it, discounted as in modified Kneser-Ney, so that a word repeated in
one phrase weighs little. The discounted mass goes to one distribution that both classes share,
made of the continuation counts of all documents, labelled or not. A word that neither class has
seen often gets nearly the same likelihood from both, so a rare expression says little.

A text is scored by log-likelihood under the toxic model minus that under the ordinary one,
normalised by length, over the whole text and over its best windows of several lengths (an insult
in a long text is lost in the mean). A logistic curve over these ratios, fitted on labelled rows
that no count was taken from, turns them into a score.

Class counts come from a bounded sample of labelled rows, some `ROWS` of a class; the shared
counts cover the whole corpus. There a word's neighbours are counted by HyperLogLog++, whose relative
error CONTEXT_ERROR holds at every size, which needs a bounded number of bytes per word and combines
before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import fold, written

#: Bound of the sample: labelled rows of a class.
ROWS = 12_000
#: Every so-manieth sampled row fits the curve instead of the counts.
CALIBRATION = 7
#: Lengths, in words, of the windows whose best ratio counts.
WINDOWS = (1, 2, 5, 20)
#: Relative standard error of the shared counts.
CONTEXT_ERROR = 0.05
RIDGE, STEPS = 1.0, 50
_PLACES = 1 << 30
WORD = r"\p{L}+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _bigrams(df: DataFrame) -> DataFrame:
    """One row per word of `words`, with a hash of the word before it."""
    placed = df.where(F.size("words") > 0).select("*", F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("at"))
    return placed.select(*[c for c in df.columns if c != "words"], F.get("words", F.col("at")).alias("word"),
                         F.xxhash64(F.get("words", F.col("at") - 1)).alias("before"))


def shared_counts(texts: DataFrame, text_column: str) -> DataFrame:
    """(word, contexts): estimated number of different words in front of each word of all texts."""
    return _bigrams(texts.select(words(F.col(text_column)).alias("words"))).groupBy("word").agg(
        F.approx_count_distinct("before", CONTEXT_ERROR).cast("double").alias("contexts"))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, rows: int) -> DataFrame:
    """(id, toxic, words, calibrates) of labelled rows, chosen by the ids' hashes: some `rows` of a class.

    A class is cut at the share of hashes that gives `rows` on average, so none is ranked or gathered.

    Ids without a label, text or word are left out, as is one whose fold is that of the held-out
    rows; of equal texts one row stays. An id labelled twice is toxic if one label says so.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & (fold("doc_id") % 5 != 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = written(known, "labels")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(_PLACES))
    share = {row["toxic"]: min(1.0, rows / row["count"]) for row in known.groupBy("toxic").count().collect()}
    cut = sum((F.when(F.col("toxic") == side, int(part * _PLACES)).otherwise(0) for side, part in share.items()), F.lit(0))
    chosen = known.where(place < cut).select(F.col("doc_id").alias("id"), "toxic")
    # Some 2 * rows pairs of numbers are broadcast.
    own = docs.select(F.col(id_column).alias("id"), words(F.col(text_column)).alias("words"))
    texts = own.join(F.broadcast(chosen), "id").where(F.size("words") > 0)
    return texts.groupBy(F.xxhash64("words").alias("hash")).agg(
        F.min(F.struct("id", "toxic", "words")).alias("row")).select(
        "row.*", (F.crc32(F.col("row.id").cast("string")) % CALIBRATION == 0).alias("calibrates"))


@dataclass
class Model:
    """Log-likelihood ratio of each word the classes know, of any other word, and the curve."""

    ratios: dict[str, float]
    unknown: float
    weights: np.ndarray
    center: np.ndarray
    scale: np.ndarray

    def features(self, tokens: list[str]) -> np.ndarray:
        get, unknown = self.ratios.get, self.unknown
        values = np.fromiter((get(t, unknown) for t in tokens), np.float64, count=len(tokens))
        sums = np.concatenate([[0.0], np.cumsum(values)])
        best = [float((sums[n:] - sums[:-n]).max()) / n if len(values) >= n else float(sums[-1]) / n for n in WINDOWS]
        return np.asarray([float(sums[-1]) / max(len(values), 1), *best])

    def score(self, tokens: list[str]) -> float:
        if not tokens or not len(self.weights):
            return 0.0
        x = (self.features(tokens) - self.center) / self.scale
        z = float(self.weights[0] + x @ self.weights[1:])
        return 1.0 / (1.0 + math.exp(-min(max(z, -60.0), 60.0)))


def discounts(counts: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and more, from how many words have counts 1 to 4."""
    n = [max(sum(c == k for c in counts), 1) for k in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1])
    raw = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return [min(max(d, 0.1), k - 0.01) for k, d in zip((1, 2, 3), raw)]


def word_ratios(counts: dict[str, tuple[int, int]], contexts: dict[str, float], total: float, vocabulary: int) -> tuple[dict[str, float], float]:
    """Ratios from the classes' continuation counts (ordinary, toxic) and the shared contexts.

    A word that neither class has gets 0: both give it the same shared likelihood, and how much mass
    a class has left for such words tells the size of its sample, not the text.
    """
    models = []
    for side in (0, 1):
        own = [c[side] for c in counts.values() if c[side]]
        cut = discounts(own)
        taken = [cut[min(c, 3) - 1] for c in own]
        models.append((sum(own), cut, sum(taken) / sum(own)))

    def likelihood(side: int, word: str) -> float:
        everything, cut, free = models[side]
        count = counts[word][side]
        held = (count - cut[min(count, 3) - 1]) / everything if count else 0.0
        return held + free * (contexts.get(word, 0.0) + 1.0) / (total + vocabulary)

    ratios = {word: math.log(likelihood(1, word) / likelihood(0, word)) for word in counts}
    return ratios, 0.0


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton steps with a ridge: (weights with intercept, center, scale)."""
    center, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.hstack([np.ones((len(x), 1)), (x - center) / scale])
    ridge = np.diag([0.0] + [RIDGE] * x.shape[1])
    w = np.zeros(z.shape[1])
    for _ in range(STEPS):
        p = 1.0 / (1.0 + np.exp(-np.clip(z @ w, -60, 60)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + ridge + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(hessian, z.T @ (y - p) - ridge @ w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w, center, scale


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", rows: int = ROWS) -> Model:
    """Model from the labels (doc_id, toxic) outside the held-out fold and all texts of `docs`.

    Without sampled rows of both classes the model scores every text 0.
    """
    sample = written(labelled_sample(docs, labels, id_column, text_column, rows), "sample")
    counted = (_bigrams(sample.where("not calibrates").select("toxic", "words")).groupBy("word").agg(
        F.count_distinct(F.when(F.col("toxic") == 0, F.col("before"))).alias("ordinary"),
        F.count_distinct(F.when(F.col("toxic") == 1, F.col("before"))).alias("toxic")))
    shared = written(shared_counts(docs, text_column), "shared-counts")
    total, vocabulary = shared.agg(F.coalesce(F.sum("contexts"), F.lit(0.0)), F.count("*") + 1).first()
    # The words of the bounded sample reach the driver, with their shared counts.
    vocabulary_rows = counted.join(shared, "word", "left").toLocalIterator()
    counts, contexts = {}, {}
    for row in vocabulary_rows:
        counts[row["word"]] = (row["ordinary"], row["toxic"])
        contexts[row["word"]] = row["contexts"] or 0.0
    nothing = Model({}, 0.0, np.empty(0), np.empty(0), np.empty(0))
    if not all(any(c[side] for c in counts.values()) for side in (0, 1)):
        return nothing
    ratios, unknown = word_ratios(counts, contexts, float(total), int(vocabulary))
    model = Model(ratios, unknown, np.empty(0), np.empty(0), np.empty(0))
    held = [(model.features(r["words"]), r["toxic"]) for r in sample.where("calibrates").select("words", "toxic").toLocalIterator()]
    if len({y for _, y in held}) < 2:  # too few rows to set some apart
        held = [(model.features(r["words"]), r["toxic"]) for r in sample.select("words", "toxic").toLocalIterator()]
    model.weights, model.center, model.scale = _fit(np.asarray([x for x, _ in held]), np.asarray([float(y) for _, y in held]))
    return model


def score(df: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, text_hash, score, predicted) per row of `df`; predicted is 1 from a score of 0.5 on.

    A text that is null, empty or without letters scores 0. Whole texts count, however long.
    Repeated rows repeat; an empty table gives an empty table.
    """
    kind = df.schema[id_column].dataType.simpleString()
    broadcast = df.sparkSession.sparkContext.broadcast(model)
    source = df.select(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("text_hash"),
                       F.lower(F.coalesce(F.col(text_column), F.lit(""))).alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find, own = regex.compile(WORD).findall, broadcast.value
        for batch in batches:
            scores = [own.score(find(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= 0.5) for s in scores], pa.int32())], names=["id", "text_hash", "score", "predicted"])

    return source.mapInArrow(each, f"id {kind}, text_hash bigint, score double, predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, without those predicted toxic."""
    found = score(docs, train(docs, labels, id_column, text_column), id_column, text_column).where("predicted = 1")
    bad = written(found.select(F.col("id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash")).distinct(), "toxic")
    same = [docs[id_column].eqNullSafe(bad["_bad_id"]), F.xxhash64(docs[text_column]) == bad["_bad_hash"]]
    return docs.join(bad, same, "left_anti")
