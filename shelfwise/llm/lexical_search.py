"""Ranked lexical search by exact inner products over ball trees of sparse vectors.

A document is a sparse vector of whole numbers: per term a value that grows with the term's
occurrences and shrinks with the document's length. A query is a sparse vector of whole term weights,
and a score is their inner product. Only terms that a query has can add to a score, so vectors are kept
for the terms of the queries at hand.

Documents of one task are indexed a shard at a time: each shard is split in two again and again, every
member to the nearer of two distant ones, down to leaves of LEAF documents at most. A node keeps a
whole-numbered center near the mean of its vectors and a radius around it. No vector of the node has an
inner product above that of the center plus the query's length times the radius. All of that is
whole-number arithmetic, square roots rounded up, so the bound is never too small.

For each query the nodes of a shard are taken best bound first. A leaf's documents are scored exactly.
When the best bound left is under the score of the k-th document found so far, in this shard or an
earlier one of the task, the rest of the shard is passed over. Every task gives its k best per query,
and the k best of those are the answer. Equal scores are ranked by id, so a bound that equals the k-th
score is followed too, unless all ids under it are larger.

Queries are taken in blocks with a bounded number of terms; a block costs one more pass.
"""

from __future__ import annotations

import math
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import written

#: Documents of each query's answer.
BEST = 10
#: Bounds of a shard, in documents and in entries, and documents of a leaf at most.
SHARD_ROWS, SHARD_ENTRIES, LEAF = 8_192, 1 << 20, 32
#: A node is split where the nearer of two members changes, or in the middle if one side had less than this part of it.
UNEVEN = 16
#: (query, term) pairs of the queries that are searched for in one pass.
BLOCK_TERMS = 200_000
#: Groups in which the tasks' answers are merged first.
MERGES = 64
#: Fixed numbers of the score.
IDF_SCALE, TF_SCALE, TF_UNIT, TF_LENGTH, LENGTH_SHARE = 1000, 1_000_000_000, 1000, 8, 75
#: Terms are digits, letters and all that isn't ASCII; A-Z become a-z, everything else parts terms.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order, with repeats."""
    return (text or b"").translate(_TERMS).split()


def weight(documents: int, holding: int) -> int:
    """Weight of a term that `holding` of the documents have."""
    return math.floor(IDF_SCALE * math.log((2 * documents + 2) / (2 * holding + 1)))


def damping(size: int, documents: int, total: int) -> int:
    """How far a document of `size` terms damps its term counts; 100 for one of mean length."""
    return 100 - LENGTH_SHARE + LENGTH_SHARE * size * documents // total


def _root_above(square: int) -> int:
    return math.isqrt(square) + 1 if square else 0


@dataclass
class Vectors:
    """Sparse rows: entries of row k are those from begin[k] to begin[k + 1]. No row is empty."""

    begin: np.ndarray
    term: np.ndarray
    value: np.ndarray
    row: np.ndarray

    def dot(self, dense: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.value * dense[self.term], self.begin[:-1])

    def take(self, rows: np.ndarray) -> Vectors:
        sizes = np.diff(self.begin)[rows]
        begin = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(begin[-1]) + np.repeat(self.begin[:-1][rows] - begin[:-1], sizes)
        return Vectors(begin, self.term[at], self.value[at], self.row[rows])

    def dense(self, row: int, width: int) -> np.ndarray:
        out = np.zeros(width, dtype=np.int64)
        own = slice(self.begin[row], self.begin[row + 1])
        out[self.term[own]] = self.value[own]
        return out


@dataclass
class Node:
    term: np.ndarray
    value: np.ndarray
    radius: int
    first: tuple
    vectors: Vectors | None = None
    children: list[Node] = field(default_factory=list)

    def bound(self, query: np.ndarray, length: int) -> int:
        """No inner product in the node is greater; `length` is not below the query's."""
        return int(self.value @ query[self.term]) + length * self.radius


def build(vectors: Vectors, keys: list[tuple], width: int, leaf: int = LEAF) -> Node:
    """The ball tree of the vectors; `keys` order the documents of equal scores."""
    center = np.rint(np.bincount(vectors.term, vectors.value, minlength=width) / len(vectors.row)).astype(np.int64)
    squares = np.add.reduceat(vectors.value * vectors.value, vectors.begin[:-1])
    far = squares - 2 * vectors.dot(center) + int(center @ center)
    at = np.flatnonzero(center)
    node = Node(at, center[at], _root_above(int(far.max())), min(keys[r] for r in vectors.row.tolist()))
    if len(vectors.row) <= leaf:
        node.vectors = vectors
        return node
    one = vectors.dense(int(far.argmax()), width)
    other = vectors.dense(int((squares - 2 * vectors.dot(one)).argmax()), width)
    side = vectors.dot(other - one)
    order = np.argsort(side, kind="stable")
    middle = int((2 * side < int(other @ other) - int(one @ one)).sum())
    if min(middle, len(order) - middle) * UNEVEN < len(order):
        middle = len(order) // 2
    node.children = [build(vectors.take(half), keys, width, leaf) for half in (order[:middle], order[middle:])]
    return node


def search_tree(root: Node, query: np.ndarray, length: int, keys: list[tuple], best: list[tuple], k: int) -> int:
    """Put the tree's documents that belong there into `best`, the (-score, key) of the k best so far; how many were scored."""
    heap, turn, scored = [(-root.bound(query, length), 0, root)], 0, 0
    while heap:
        bound, _, node = heappop(heap)
        last = best[-1] if len(best) == k else (0, ())
        if bound > last[0] or not bound:
            break
        if bound == last[0] and node.first > last[1]:
            continue
        for child in node.children:
            turn += 1
            heappush(heap, (-child.bound(query, length), turn, child))
        if node.vectors:
            scored += len(node.vectors.row)
            scores = node.vectors.dot(query)
            for at in np.flatnonzero((scores >= -last[0]) & (scores > 0)).tolist():
                insort(best, (-int(scores[at]), keys[node.vectors.row[at]]))
            del best[k:]
    return scored


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int], id_column: str, text_column: str) -> DataFrame:
    """(id, size, terms, often): a row's number of terms, and which of the vocabulary it has how often."""
    kind = docs.schema[id_column].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("binary").alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            sizes, found = [], []
            for text in batch.column("text"):
                own = terms(text.as_py())
                counted = Counter(map(number, own))
                counted.pop(None, None)
                sizes.append(len(own))
                found.append(sorted(counted.items()))
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(sizes, pa.int64()), pa.array([[t for t, _ in f] for f in found], pa.list_(pa.int32())),
                pa.array([[n for _, n in f] for f in found], pa.list_(pa.int64()))], names=["id", "size", "terms", "often"])

    return source.mapInArrow(each, f"id {kind}, size bigint, terms array<int>, often array<bigint>")


@dataclass
class Block:
    """Queries (number, terms, weights) over a vocabulary, and what the scores take from the corpus."""

    queries: list[tuple[int, np.ndarray, np.ndarray]]
    width: int
    documents: int
    total: int

    def lengths(self) -> list[int]:
        return [_root_above(int(w @ w)) for *_, w in self.queries]


def _shards(batches: Iterator[pa.RecordBatch], block: Block) -> Iterator[tuple[Vectors, list]]:
    """Vectors and ids of the rows, a shard at a time."""
    begin, term, value, ids = [0], [], [], []
    for batch in batches:
        for own, size, numbers, often in zip(*(batch.column(c) for c in ("id", "size", "terms", "often"))):
            damped = TF_LENGTH * damping(size.as_py(), block.documents, block.total)
            counts = often.values.to_numpy()
            term.append(numbers.values.to_numpy())
            value.append(TF_SCALE * counts // (TF_UNIT * counts + damped))
            begin.append(begin[-1] + len(counts))
            ids.append(own.as_py())
            if len(ids) >= SHARD_ROWS or begin[-1] >= SHARD_ENTRIES:
                yield Vectors(np.asarray(begin), np.concatenate(term), np.concatenate(value), np.arange(len(ids))), ids
                begin, term, value, ids = [0], [], [], []
    if ids:
        yield Vectors(np.asarray(begin), np.concatenate(term), np.concatenate(value), np.arange(len(ids))), ids


def _search_block(counted: DataFrame, block: Block, k: int) -> DataFrame:
    """(query, id, score): the k best of every task."""
    kind = counted.schema["id"].dataType
    shared = counted.sparkSession.sparkContext.broadcast(block)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        best: list[list[tuple]] = [[] for _ in own.queries]
        lengths, query, ids_type = own.lengths(), np.zeros(own.width, dtype=np.int64), None

        def seen(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal ids_type
            for batch in given:
                ids_type = batch.column("id").type
                yield batch

        for vectors, ids in _shards(seen(batches), own):
            # Rows without an id come after all others.
            keys = [(i is None, i) for i in ids]
            root = build(vectors, keys, own.width)
            for top, length, (_, at, weights) in zip(best, lengths, own.queries):
                query[at] = weights
                search_tree(root, query, length, keys, top, k)
                query[at] = 0
        found = [(number, own_id, -score) for (number, *_), top in zip(own.queries, best) for score, (_, own_id) in top]
        if found:
            columns = list(zip(*found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], ids_type), pa.array(columns[2], pa.int64())], names=["query", "id", "score"])

    return counted.where(F.size("terms") > 0).mapInArrow(each, f"query bigint, id {kind.simpleString()}, score bigint")


def _blocks(queries: DataFrame, limit: int) -> Iterator[list[tuple[int, Counter]]]:
    """The queries with a term, their terms counted, some `limit` of these pairs at a time; one part of the table at a time is here."""
    block, pairs = [], 0
    for row in queries.select("query", "text").toLocalIterator():
        counted = Counter(terms(bytes(row["text"] or b"")))
        if not counted:
            continue
        if block and pairs + len(counted) > limit:
            yield block
            block, pairs = [], 0
        block.append((row["query"], counted))
        pairs += len(counted)
    if block:
        yield block


def search(docs: DataFrame, queries: DataFrame, id_column: str = "doc_id", text_column: str = "text", query_column: str = "item_id",
           query_text: str = "text", k: int = BEST, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(query_id, rank, id, score): for each row of `queries` its `k` documents of the highest score, if above 0.

    Ranks run from 1 by descending score, then ascending id, rows without an id last. Every row of
    `queries` is a query of its own, so repeated queries repeat; every row of `docs` is a document of its
    own, so a repeated row may be there twice. Texts that are null, empty or without terms score nothing, as
    documents and as queries, and such documents don't count as documents; an empty table on either side gives
    an empty table. Whole texts count, however long. Only the named columns are read.
    """
    asked = written(queries.select(F.monotonically_increasing_id().alias("query"), F.col(query_column).alias("query_id"),
                                   F.col(query_text).cast("binary").alias("text")), "queries")
    found = []
    for block in _blocks(asked, block_terms):
        vocabulary = {t: k for k, t in enumerate(sorted(set().union(*(counted for _, counted in block))))}
        counted = written(count_terms(docs, vocabulary, id_column, text_column), "term-counts")
        documents, total = counted.agg(F.count_if(F.col("size") > 0), F.coalesce(F.sum("size"), F.lit(0))).first()
        # A row per term of the block.
        holding = dict(counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
        weights = np.asarray([weight(documents, holding.get(n, 0)) for n in range(len(vocabulary))], dtype=np.int64)
        coded = []
        for number, words in block:
            at = np.asarray(sorted(vocabulary[t] for t in words), dtype=np.int64)
            often = dict((vocabulary[t], n) for t, n in words.items())
            coded.append((number, at, weights[at] * np.asarray([often[n] for n in at.tolist()], dtype=np.int64)))
        if total:
            found.append(written(_search_block(counted, Block(coded, len(vocabulary), documents, total), k), "found"))
    if not found:
        kind = docs.schema[id_column].dataType.simpleString()
        found = [docs.sparkSession.createDataFrame([], f"query bigint, id {kind}, score bigint")]
    best = [F.desc("score"), F.asc_nulls_last("id")]
    merged = reduce(DataFrame.unionAll, found).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(MERGES)))
    few = merged.withColumn("rank", F.row_number().over(Window.partitionBy("query", "part").orderBy(*best))).where(F.col("rank") <= k)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*best))).where(F.col("rank") <= k)
    return ranked.join(asked.select("query", "query_id"), "query").select("query_id", "rank", "id", "score")
