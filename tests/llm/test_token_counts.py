"""Token counts of sections against a search of every token's place, one by one."""

import pytest

from shelfwise.llm import token_counts
from shelfwise.llm.chat import tokenizer
from shelfwise.llm.common import model_path

pytest.importorskip("public_tokenizers")
VOCABULARY = model_path("byte_bpe_50k.tiktoken")
TEXTS = [None, "", "\n", "one line", "two\nlines\n", "a\n\n\nb  c\r\n é中😀😀 end", "x" * 5_000 + "\n" + "y z " * 3_000, "   \n   \n"]


def plain(text, spans, rule):
    """{section: (tokens, crossing)} by decoding token by token."""
    encoding, data, at, places = tokenizer(VOCABULARY), (text or "").encode(), 0, []
    char_at = [i for i, c in enumerate(text or "") for _ in c.encode()]
    for token in encoding.encode_ordinary(text or ""):
        size = len(encoding.decode_single_token_bytes(token))
        places.append((char_at[at], char_at[at + size - 1] + 1))
        at += size
    assert at == len(data)
    counts = {k: [0, 0] for k in range(-1, len(spans))}
    for start, stop in places:
        overlap = {k: min(stop, e) - max(start, b) for k, (b, e) in enumerate(spans) if min(stop, e) > max(start, b)}
        if rule == "first":
            holder = next((k for k, (b, e) in enumerate(spans) if b <= start < e), -1)
        elif rule == "last":
            holder = next((k for k, (b, e) in enumerate(spans) if b <= stop - 1 < e), -1)
        else:
            first = next((k for k, (b, e) in enumerate(spans) if b <= start < e), -1)
            last = next((k for k, (b, e) in enumerate(spans) if b <= stop - 1 < e), -1)
            holder = first if first == last else max(overlap, key=lambda k: (overlap[k], -k))
        counts[holder][0] += 1
        b, e = (0, len(text)) if holder < 0 else spans[holder]
        counts[holder][1] += start < b or stop > e
    return counts


def lines(text):
    out, at = [], 0
    for line in (text or "").split("\n"):
        stop = min(at + len(line) + 1, len(text or ""))
        if stop > at:
            out.append((at, stop))
        at = stop
    return out


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_lines(spark, rule):
    docs = spark.createDataFrame([(i, t, 5, "s") for i, t in enumerate(TEXTS)] + [(None, "x\ny", 1, "t")] * 2, "doc_id bigint, text string, start int, section string")
    got = token_counts.count_tokens(docs, VOCABULARY, rule=rule).collect()
    assert sum(r.id is None for r in got) == 6
    for i, text in enumerate(TEXTS):
        own = {r.section: (r.n_tokens, r.n_crossing) for r in got if r.id == i}
        assert own == {k: tuple(v) for k, v in plain(text, lines(text), rule).items()}
        assert sum(n for n, _ in own.values()) == len(tokenizer(VOCABULARY).encode_ordinary(text or ""))


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_given_spans_with_gaps(spark, rule):
    text, spans = "internationalisation of words, 中文 and 😀😀 more", [(0, 3), (3, 9), (12, 20), (25, 33)]
    rows = [(1, text, [{"start": b, "stop": e} for b, e in spans]), (2, text, None), (3, None, [])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, parts array<struct<start:int,stop:int>>")
    got = token_counts.count_tokens(docs, VOCABULARY, spans="parts", rule=rule).collect()
    assert {r.section: (r.n_tokens, r.n_crossing) for r in got if r.id == 1} == {k: tuple(v) for k, v in plain(text, spans, rule).items()}
    assert [(r.section, r.n_tokens) for r in got if r.id == 3] == [(-1, 0)]


def test_unknown_rule_and_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_counts.count_tokens(empty, VOCABULARY).count() == 0
    with pytest.raises(ValueError):
        token_counts.count_tokens(empty, VOCABULARY, rule="none")
