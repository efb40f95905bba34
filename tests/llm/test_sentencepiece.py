"""The prefix table against the library, and exact round trips."""

import random

import pytest

from shelfwise.llm import sentencepiece_bpe
from shelfwise.llm.common import model_path

pytest.importorskip("public_tokenizers")
MODEL = model_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def coder():
    return sentencepiece_bpe.encoder(MODEL)


def texts():
    rng = random.Random(3)
    pieces = list(sentencepiece_bpe.encoder(MODEL).ids)
    letters = "ab  ▁\n\té中<>0x41's.,é　\0😀"
    out = [None, "", " ", "  ", "a", " a  b ", "▁a", "<s>a</s>", "<0x41>", "é", "é", "=" * 900, "a" * 2_001, "ab" * 700]
    out += [" " * n + "x" + " " * n for n in range(40)]
    for _ in range(1500):
        out.append("".join(rng.choice(letters) if rng.random() < 0.5 else rng.choice(pieces) for _ in range(rng.randint(0, 12))))
    return out


def test_ids_equal_the_library(coder):
    for text in texts():
        assert coder.encode(text) == coder.library.encode(text or ""), repr(text)


def test_prefix_table_equals_merging(coder):
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("abcdeinrst▁") for _ in range(rng.randint(1, 30)))
        assert [coder.texts[i] for i in coder.pieces(text)] == coder.merge(text)


def test_bounded_tables(coder, monkeypatch):
    fresh = sentencepiece_bpe.PrefixEncoder(MODEL)
    for name in ("MAX_STRETCHES", "MAX_PAIRS"):
        monkeypatch.setattr(sentencepiece_bpe, name, 3)
    for text in texts()[:200]:
        assert fresh.encode(text) == coder.encode(text)
    assert len(fresh.stretches) <= 3 and len(fresh.pairs) <= 3


def test_operator(spark, coder):
    rows = [(i, t, "other", [1]) for i, t in enumerate(texts()[:80])] + [(1, "", "x", None), (None, "again", None, None)] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, decoded string, ids array<int>")
    got = sentencepiece_bpe.encode_decode(docs, MODEL).collect()
    want = [(i, coder.library.encode(t or ""), coder.library.decode(coder.library.encode(t or "")) if t else "") for i, t, *_ in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_round_trip(coder):
    for text in texts():
        if text and "▁" not in text:
            assert coder.decode(coder.encode(text)) == text


def test_empty_table(spark):
    assert sentencepiece_bpe.encode_decode(spark.createDataFrame([], "doc_id string, text string"), MODEL).count() == 0
