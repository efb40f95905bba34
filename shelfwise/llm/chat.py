"""Chat formatting by token-level assembly.

Each turn's segments are encoded separately and joined by reserved ids that no text can give:

    <|im_start|> role \\n text <|im_end|> \\n

The loss mask marks an assistant's text and nothing else: +1 where it starts, -1 where it stops,
summed up along the tokens. Control strings inside a text are escaped, so that the formatted text
can be parsed as well as the ids; `unescape` gives the text back exactly.

The output has a row per turn. A conversation is its rows in the order of `position`; no row and
no task's memory grows with the length of a conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Ids beyond those of the vocabulary file.
START_ID, END_ID = 50256, 50257
LOSS_ROLE = "assistant"
ROWS = 1_000

_CONTROL = re.compile(r"<(\\*)\|(im_start|im_end)\|>")
_ESCAPED = re.compile(r"<\\(\\*)\|(im_start|im_end)\|>")
FORMATTED = "conv {kind}, position bigint, role string, ids array<int>, mask array<tinyint>, formatted string"


def escape(text: str) -> str:
    """One more backslash inside every control string, also one that has some already."""
    return _CONTROL.sub(r"<\\\1|\2|>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|\2|>", text)


def _escape_role(role: str) -> str:
    """A role is one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@lru_cache(maxsize=4)
def tokenizer(vocabulary: str):
    """Byte-level BPE of a rank file; one per Python worker."""
    import base64

    import tiktoken
    from public_tokenizers import PATTERN

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    if max(ranks.values()) >= START_ID:
        raise ValueError("the vocabulary has the reserved ids")
    return tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def assemble(encoding, role: str, text: str, loss_role: str = LOSS_ROLE) -> tuple[np.ndarray, np.ndarray]:
    """(ids, mask) of one turn."""
    segments = [[START_ID], encoding.encode_ordinary(_escape_role(role) + "\n"), encoding.encode_ordinary(escape(text)),
                [END_ID], encoding.encode_ordinary("\n")]
    bounds = np.cumsum([0, *map(len, segments)])
    steps = np.zeros(bounds[-1] + 1, dtype=np.int8)
    if role == loss_role:
        steps[bounds[2]] += 1
        steps[bounds[3]] -= 1
    return np.concatenate([np.asarray(s, dtype=np.int32) for s in segments]), np.cumsum(steps[:-1], dtype=np.int8)


def render(encoding, ids: np.ndarray) -> str:
    """Text of ids with the control strings in place of the reserved ids."""
    out, begin = [], 0
    for at in np.flatnonzero(ids >= START_ID):
        out += [encoding.decode(ids[begin:at].tolist()), START if ids[at] == START_ID else END]
        begin = at + 1
    return "".join([*out, encoding.decode(ids[begin:].tolist())])


def format_turns(df: DataFrame, vocabulary: str, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", loss_role: str = LOSS_ROLE) -> DataFrame:
    """(conv, position, role, ids, mask, formatted) per row of `df`.

    position orders a conversation: by turn, a null turn first, rows of one turn by role, then text,
    nulls first; repeated rows follow each other. A null role or text counts as empty; a null
    conversation is one conversation. Other columns are not read.
    """
    kind = df.schema[conv].dataType.simpleString()
    turns = df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    ordered = turns.withColumn("position", F.row_number().over(order).cast("bigint") - 1).select("conv", "position", "role", "text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tokenizer(vocabulary)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                roles = [r or "" for r in batch.column("role").to_pylist()]
                made = [assemble(encoding, r, t or "", loss_role) for r, t in zip(roles, batch.column("text").to_pylist())]
                ends = np.cumsum([0, *(len(ids) for ids, _ in made)], dtype=np.int32)
                flat = [np.concatenate(x) for x in zip(*made)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("conv"), batch.column("position"), pa.array(roles, pa.string()),
                     pa.ListArray.from_arrays(ends, flat[0]), pa.ListArray.from_arrays(ends, flat[1]),
                     pa.array([render(encoding, ids) for ids, _ in made], pa.string())],
                    names=["conv", "position", "role", "ids", "mask", "formatted"])

    return ordered.mapInArrow(each, FORMATTED.format(kind=kind))


def read_turn(encoding, ids: np.ndarray, mask: np.ndarray) -> tuple[str, str, str | None]:
    """(role, text, text under the mask or None) from the tokens of one turn."""
    begin, end = np.flatnonzero(ids == START_ID), np.flatnonzero(ids == END_ID)
    if len(begin) != 1 or len(end) != 1 or begin[0] != 0:
        raise ValueError("not one turn")
    role, _, text = encoding.decode(ids[1:end[0]].tolist()).partition("\n")
    lost = unescape(encoding.decode(ids[mask == 1].tolist())) if mask.any() else None
    return _unescape_role(role), unescape(text), lost


def digests(formatted: DataFrame, vocabulary: str) -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from `formatted`.

    The rows of a conversation stream through one task in order, which a digest of them needs; the
    task holds one batch and the running digests, and its sort spills.
    """
    kind = formatted.schema["conv"].dataType.simpleString()
    ordered = (formatted.select("conv", "position", "ids", "mask", "formatted").repartition("conv")
               .sortWithinPartitions("conv", "position"))
    schema = f"conv {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tokenizer(vocabulary)
        names = [f.split()[0] for f in schema.split(", ")]
        current, state, conv_type = None, None, None

        def closed(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(names)
            types = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        def row() -> tuple:
            return (current[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for batch in batches:
            done, conv_type = [], batch.schema.field("conv").type
            for i in range(batch.num_rows):
                conv = (batch.column("conv")[i].as_py(),)
                if conv != current:
                    if current is not None:
                        done.append(row())
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = batch.column("ids")[i].values.to_numpy(zero_copy_only=False)
                mask = batch.column("mask")[i].values.to_numpy(zero_copy_only=False)
                role, text, lost = read_turn(encoding, ids, mask)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if lost is not None:
                    state[2] += len(lost)
                    state[3].update(lost.encode())
                state[4] += len(batch.column("formatted")[i].as_py())
            yield closed(done)
        if current is not None:
            yield closed([row()])

    return ordered.mapInArrow(each, schema)
