"""Token counts of sections by offset-mapped attribution.

A document is encoded once, as a whole. The bytes of its tokens add up to its own bytes, so a
running sum gives each token's place, which is mapped from bytes to characters. The places are
joined to the sections' character spans by binary search, and a token that reaches over a boundary
goes to one section by an explicit rule:

* `first`: the section of its first character (the default);
* `last`: the section of its last character;
* `most`: the section with most of its characters, the earlier one of equals.

Counts over the sections of a document, with the tokens that lie in none, add up to its tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .chat import tokenizer

RULES = ("first", "last", "most")
#: Number of the row that takes the tokens outside all sections.
OUTSIDE = -1


def line_starts(text: str) -> np.ndarray:
    """Start of every line of a text in characters, and the end of the text."""
    breaks = [0]
    at = text.find("\n") + 1
    while at:
        breaks.append(at)
        at = text.find("\n", at) + 1
    if breaks[-1] != len(text):
        breaks.append(len(text))
    return np.asarray(breaks, dtype=np.int64)


def token_spans(encoding, lengths: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
    """First character and last character + 1 of every token; tokens that share a character overlap."""
    ids = np.asarray(encoding.encode_ordinary(text), dtype=np.int64)
    if not len(ids):
        return ids, ids
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    stops = np.cumsum(lengths[ids])
    return character[stops - lengths[ids]], character[stops - 1] + 1


def attribute(starts: np.ndarray, stops: np.ndarray, begin: np.ndarray, end: np.ndarray, rule: str) -> np.ndarray:
    """Number of the section [begin, end) that takes each token, OUTSIDE for none. Sections ascend without overlap."""
    def holder(character: np.ndarray) -> np.ndarray:
        found = np.searchsorted(begin, character, side="right") - 1
        return np.where((found >= 0) & (character < end[found]), found, OUTSIDE)

    if not len(begin):
        return np.full(len(starts), OUTSIDE)
    first, last = holder(starts), holder(stops - 1)
    if rule == "first":
        return first
    if rule == "last":
        return last
    taken = first.copy()
    for i in np.flatnonzero(first != last):
        around = range(max(int(np.searchsorted(end, starts[i], side="right")), 0), int(np.searchsorted(begin, stops[i])))
        shares = [(min(stops[i], end[k]) - max(starts[i], begin[k]), -k) for k in around]
        taken[i] = -max(shares)[1] if shares else OUTSIDE
    return taken


def count_tokens(
    df: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", spans: str | None = None,
    rule: str = "first",
) -> DataFrame:
    """(id, section, start, stop, n_tokens, n_crossing) per section of each row of `df`.

    Sections are lines, or the spans in column `spans` (array of struct with start and stop in
    characters, ascending, without overlap). n_crossing counts those of the section's tokens that
    reach beyond it. Every row of `df` also has a section -1 over its whole text with the tokens in
    no section, so null and empty texts show up with zero tokens. Repeated rows repeat.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    kind = df.schema[id_column].dataType.simpleString()
    source = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"),
                       *([F.col(spans).alias("spans")] if spans else []))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tokenizer(vocabulary)
        lengths = np.asarray([len(encoding.decode_single_token_bytes(i)) for i in range(encoding.n_vocab)])
        for whole in batches:
            for batch in (whole.slice(k, 500) for k in range(0, whole.num_rows, 500)):
                parts: list[tuple[np.ndarray, ...]] = []
                for i, value in enumerate(batch.column("text")):
                    text = value.as_py() or ""
                    if spans:
                        given = batch.column("spans")[i].as_py() or []
                        begin = np.asarray([s["start"] for s in given], dtype=np.int64)
                        end = np.asarray([s["stop"] for s in given], dtype=np.int64)
                    else:
                        breaks = line_starts(text)
                        begin, end = breaks[:-1], breaks[1:]
                    starts, stops = token_spans(encoding, lengths, text)
                    taken = attribute(starts, stops, begin, end, rule) + 1
                    begin, end = np.concatenate([[0], begin]), np.concatenate([[len(text)], end])
                    crossing = (starts < begin[taken]) | (stops > end[taken])
                    parts.append((
                        np.full(len(begin), i), np.arange(-1, len(begin) - 1), begin, end,
                        np.bincount(taken, minlength=len(begin)), np.bincount(taken[crossing], minlength=len(begin))))
                columns = [np.concatenate(x).astype(np.int64) for x in zip(*parts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(columns[0])), *map(pa.array, columns[1:])],
                    names=["id", "section", "start", "stop", "n_tokens", "n_crossing"])

    return source.mapInArrow(each, f"id {kind}, section bigint, start bigint, stop bigint, n_tokens bigint, n_crossing bigint")
