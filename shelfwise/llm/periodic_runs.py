"""Periodic runs of words by a dictionary of basic factors.

The dictionary names the factors (stretches of consecutive words) of one power-of-two length after
another: a factor of twice the length is the pair of the names of its halves, and equal pairs get
equal names. At each length a factor's occurrences are listed in order; successors at most twice the
length apart that follow each other at one distance form an arithmetic progression, and its
difference is proposed as a period there. A proposal is extended to both sides as far as words that
far apart agree, and proposals of a run that is already known are skipped.

Why nothing is missed: let a run have smallest period q and at least `repeats` * q words, and let L
be the power of two with q <= L < 2q. The run's first factor of L words comes again q words later
and no sooner, and so on at least `repeats` - 1 times within the run: a progression of difference q.
Why no period is a multiple of the smallest: then the proposing factor would have come again sooner.

Names are made for many short documents at once and for a long one by itself. A word's first name
tells the documents apart, so nothing is found across them, and a factor that has no second
occurrence near enough in its document is dropped from the longer lengths.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: A run has this many words at least, and this many periods.
LEAST_WORDS, REPEATS = 6, 4
#: Words of short documents that are named at once; a longer document is named by itself.
BATCH_WORDS = 200_000
#: Words compared at once at first while a run is extended; doubled at each step.
STEP = 32
#: What parts words. `bytes.split` parts at the same bytes.
WORD = r"[^\x20\x09-\x0D]+"


def _extent(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The longest stretch of places x around `at` with words[x] == words[x + period]."""
    last, stop, step = len(words) - period, at, STEP
    while stop < last:
        upto = min(stop + step, last)
        other = np.flatnonzero(words[stop:upto] != words[stop + period:upto + period])
        if len(other):
            stop += int(other[0])
            break
        stop, step = upto, step * 2
    start, step = at, STEP
    while start > 0:
        first = max(start - step, 0)
        other = np.flatnonzero(words[first:start] != words[first + period:start + period])
        if len(other):
            start = first + int(other[-1]) + 1
            break
        start, step = first, step * 2
    return start, stop


def _progressions(place: np.ndarray, name: np.ndarray, length: int, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place, difference) of the progressions of `terms` occurrences, and each occurrence's distance to its nearest other."""
    order = np.argsort(name, kind="stable")
    places, same = place[order], np.diff(name[order]) == 0
    far = np.iinfo(np.int64).max
    after = np.where(same, np.diff(places), far)
    near = np.full(len(place), far)
    near[order[:-1]] = after
    near[order[1:]] = np.minimum(near[order[1:]], after)
    chained = same & (after <= 2 * length)
    steps = terms - 1
    for k in range(1, steps):  # the next differences are the same
        chained[:-k] &= after[k:] == after[:-k]
        chained[-k:] = False
    found = np.flatnonzero(chained)
    return places[found], after[found], near


def runs_of(words: np.ndarray, reach: np.ndarray, least: int = LEAST_WORDS, repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs among the numbered words, sorted by start and period.

    `reach` says, per place, how far apart occurrences are that can matter: a `repeats`-th of the
    document's words. Words of different documents must have different numbers.
    """
    proposals = set()
    place, length = np.arange(len(words)), 1
    _, name, often = np.unique(words, return_inverse=True, return_counts=True)
    keep = often[name] > 1
    place, name = place[keep], name[keep]
    known: dict[int, list[tuple[int, int]]] = defaultdict(list)
    at = np.full(len(words) + 1, -1, dtype=np.int64)
    furthest = int(reach.max(initial=0))
    while len(place):
        first, period, near = _progressions(place, name, length, repeats - 1)
        proposals.update(zip(first.tolist(), period.tolist()))
        if length >= 2 * furthest:
            break
        keep = near <= reach[place]
        place, name = place[keep], name[keep]
        # Names of twice the length, from the halves'.
        at[:] = -1
        at[place] = name
        second = at[np.minimum(place + length, len(words))]
        keep = second >= 0
        place, pair = place[keep], name[keep] * (int(name.max(initial=0)) + 1) + second[keep]
        _, name, often = np.unique(pair, return_inverse=True, return_counts=True)
        keep = often[name] > 1
        place, name, length = place[keep], name[keep], length * 2
    out = []
    for period, start in sorted((p, s) for s, p in proposals):
        seen = known[period]
        if seen and start < seen[-1][1]:
            continue  # stretches of one period don't overlap, and come in order
        begin, stop = _extent(words, start, period)
        seen.append((begin, stop))
        if stop + period - begin >= max(least, repeats * period):
            out.append((begin, stop + period - begin, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def runs_of_documents(documents: list[list[bytes]], least: int = LEAST_WORDS, repeats: int = REPEATS) -> list[list[tuple[int, int, int]]]:
    """The runs of each document, given as lists of words."""
    sizes = np.asarray([len(d) for d in documents], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    words = np.concatenate([
        np.zeros(0, dtype=np.int64),
        *(np.fromiter(map(numbers.__getitem__, d), np.int64, count=len(d)) for d in documents)])
    words += np.repeat(np.arange(len(documents), dtype=np.int64), sizes) * (len(numbers) + 1)
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    for start, length, period in runs_of(words, np.repeat(sizes // repeats, sizes), least, repeats):
        own = int(np.searchsorted(begins, start, side="right")) - 1
        out[own].append((start - int(begins[own]), length, period))
    return out


def kept(size: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay when each run is cut to its first period."""
    edges = np.zeros(size + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges)[:size] == 0


def _grouped(batch: pa.RecordBatch) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(first row, words of the rows from there on), some BATCH_WORDS at a time."""
    begin, group, total = 0, [], 0
    for row, text in enumerate(batch.column("text")):
        words = (text.as_py() or b"").split()
        if group and total + len(words) > BATCH_WORDS:
            yield begin, group
            begin, group, total = row, [], 0
        group.append(words)
        total += len(words)
    if group:
        yield begin, group


def find_runs(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST_WORDS, repeats: int = REPEATS) -> DataFrame:
    """(id, n_words, runs, collapsed) per row of `df`.

    A run is a stretch of words with smallest period q, of `least` words and `repeats` * q words at
    least, that can't be made longer with that period. `runs` holds start, length and period of each, by
    start and period; runs of different periods may overlap. `collapsed` is the text's words, joined by
    a space, without those that a run has after its first period.

    Words are parted by spaces and the control characters 9 to 13. Whole texts count, however long; a
    text is held in one task, in some hundred bytes a word. A null or empty text, or one of white space,
    has no words, no runs and an empty `collapsed`. Rows are independent, so repeated rows repeat, ids
    may be null, and an empty table gives an empty table. Only the two named columns are read.
    """
    if repeats < 3:
        raise ValueError("a run must hold its period three times to be a progression of factors")
    kind = df.schema[id_column].dataType.simpleString()
    source = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("binary").alias("text"))
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, documents in _grouped(batch):
                found = runs_of_documents(documents, least, repeats)
                collapsed = [
                    b" ".join([w for w, stays in zip(words, kept(len(words), runs)) if stays] if runs else words).decode()
                    for words, runs in zip(documents, found)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(begin, len(documents)),
                    pa.array([len(words) for words in documents], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found], pa.list_(run)),
                    pa.array(collapsed, pa.string())], names=["id", "n_words", "runs", "collapsed"])

    return source.mapInArrow(each, f"id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
