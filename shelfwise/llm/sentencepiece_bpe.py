"""SentencePiece BPE encoding by a prefix table, and decoding.

Pieces merge by score, the leftmost first among equals, so a text's pieces follow from pairs
alone: the pieces of a prefix of a text, cut at a piece's end, are the prefix's own pieces, and a
row of pieces is the encoding exactly if each pair of neighbours, merged by itself, falls back
into the same two. So each prefix has one last piece: of the pieces that end there (found by an
automaton) it is the one that is compatible with the last piece of the prefix before it. The
table holds that piece for every prefix; the ids are recovered from the end backwards. This takes
time in proportion to the text, however long a word is.

No piece reaches over a character that no piece has, from another character into the space mark,
or from a letter into a character that follows a letter in no piece. A text is cut there, and
short stretches that repeat are looked up.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SPACE = "▁"
#: Bounds of the tables that a Python worker keeps: stretches, characters of one, and pairs.
MAX_STRETCHES, MAX_STRETCH, MAX_PAIRS = 800_000, 32, 500_000


class PrefixEncoder:
    """Encoder and decoder for a BPE model with byte fallback and a leading space mark."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        lib = self.library
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        for i in range(lib.vocab_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                self.scores[piece], self.ids[piece] = lib.get_score(i), i
        alphabet = set("".join(self.ids))
        if len(self.bytes) != 256 or not alphabet <= set(self.ids):
            raise ValueError("the model must have byte fallback and a piece for each character of its pieces")
        if lib.normalize("a  b") != f"{SPACE}a{SPACE}{SPACE}b" or any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids):
            raise ValueError("the model must keep white space, mark spaces and start words with the mark")
        self.texts = {i: piece for piece, i in self.ids.items()}
        self.width = max(self.texts) + 1
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if len(piece) > 1 and self.merge(piece) == [piece]:  # else no text's encoding has it
                self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        known = "".join(re.escape(c) for c in sorted(alphabet - {SPACE}))
        word = "".join(sorted(c for c in alphabet if c.isalpha()))
        inner = {b for p in self.ids for a, b in zip(p, p[1:]) if a.isalpha()}  # follow a letter in some piece
        apart = "".join(re.escape(c) for c in sorted(alphabet - inner))
        self.cut = re.compile(
            f"{SPACE}*[{word}]++(?:(?=[{apart}{SPACE}])|(?![{known}]))|{SPACE}*[{known}]+|{SPACE}+|[^{known}{SPACE}]").findall
        self.pairs: dict[int, bool] = {}
        self.stretches: dict[str, tuple[int, ...]] = {}

    def merge(self, text: str) -> list[str]:
        """Pieces by the definition: merge the best-scored neighbours, leftmost first, until none merge."""
        parts = list(text)
        while len(parts) > 1:
            best, where = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, where = score, i
            if where < 0:
                break
            parts[where:where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether two pieces stay as they are when they are merged by themselves; kept in `pairs`."""
        if len(self.pairs) >= MAX_PAIRS:
            self.pairs.clear()
        a, b = self.texts[left], self.texts[right]
        answer = self.pairs[left * self.width + right] = self.merge(a + b) == [a, b]
        return answer

    def pieces(self, text: str) -> list[int]:
        """Ids of a text whose characters the model has, through the prefix table."""
        pairs, width = self.pairs.get, self.width
        last = [0, *map(self.ids.__getitem__, text)]  # last[k]: the last piece of the first k characters
        settled = -1
        for end, (size, piece) in self.automaton.iter(text):  # ends ascend, so shorter prefixes are settled
            if end == settled:
                continue
            start = end + 1 - size
            if start:
                fits = pairs(last[start] * width + piece)
                if fits is None:
                    fits = self.compatible(last[start], piece)
                if not fits:
                    continue
            last[end + 1] = piece
            settled = end
        out, at, texts = [], len(text), self.texts
        while at:
            out.append(last[at])
            at -= len(texts[last[at]])
        out.reverse()
        return out

    def _stretch(self, text: str) -> tuple[int, ...]:
        if len(text) == 1 and text not in self.ids:
            return tuple(self.bytes[b] for b in text.encode())
        return tuple(self.pieces(text))

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; null counts as empty."""
        if not text:
            return []
        known, out = self.stretches, []
        look_up = known.get
        for stretch in self.cut(SPACE + text.replace(" ", SPACE)):
            ids = look_up(stretch)
            if ids is None:
                ids = self._stretch(stretch)
                if len(stretch) <= MAX_STRETCH:
                    if len(known) >= MAX_STRETCHES:
                        known.clear()
                    known[stretch] = ids
            out.append(ids)
        return list(chain.from_iterable(out))

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids) if ids else ""


@lru_cache(maxsize=4)
def encoder(model_file: str) -> PrefixEncoder:
    """One encoder per Python worker and model."""
    return PrefixEncoder(model_file)


def encode_decode(df: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded string) per row of `df`, in no order.

    Null and empty texts have no ids and decode to the empty text. Repeated rows repeat; other
    columns are not read. `model_file` must be at the same place on all executors.
    """
    kind = df.schema[id_column].dataType.simpleString()
    source = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(model_file)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):  # small answers, whatever the size of a batch
                part = batch.slice(start, 500)
                ids = [model.encode(t.as_py()) for t in part.column("text")]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.fromiter(chain.from_iterable(ids), np.int32, count=int(ends[-1]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.ListArray.from_arrays(ends, flat), pa.array(map(model.decode, ids), pa.string())],
                    names=["id", "ids", "decoded"])

    return source.mapInArrow(each, f"id {kind}, ids array<int>, decoded string")
