"""Runs by the dictionary of basic factors against every period at every place."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from shelfwise.llm import periodic_runs
from shelfwise.llm.queries import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=6, repeats=4):
    """Every stretch of every period, shortest period first; a stretch with a shorter period is no run of this one."""
    out = []
    for period in range(1, len(words) // repeats + 1):
        x = 0
        while x + period < len(words):
            stop = x
            while stop + period < len(words) and words[stop] == words[stop + period]:
                stop += 1
            length = stop + period - x
            if length >= max(least, repeats * period):
                stretch = words[x:x + length]
                if not any(stretch[p:] == stretch[:-p] for p in range(1, period)):
                    out.append((x, length, period))
            x = stop + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(s + p <= i < s + n for s, n, p in runs))


def invented(rng):
    """Words of a small set with repeated stretches, some inside others."""
    words = [rng.choice("abcd") for _ in range(rng.randint(0, 30))]
    for _ in range(rng.randint(0, 4)):
        at, size = rng.randint(0, len(words)), rng.randint(1, 9)
        unit = [rng.choice("abc") for _ in range(size)]
        if rng.random() < 0.3:
            unit = unit * rng.randint(2, 5) + [rng.choice("abc")]
        words[at:at] = (unit * rng.randint(2, 8))[:rng.randint(1, 90)]
    return words


def test_runs_equal_every_period_at_every_place():
    rng = random.Random(4)
    texts = [invented(rng) for _ in range(600)] + [[], ["a"], ["a"] * 5, ["a"] * 6, ["a", "b"] * 3, ["a", "b"] * 4, list("aab") * 40]
    coded = [[w.encode() for w in t] for t in texts]
    want = [plain_runs(t) for t in texts]
    assert periodic_runs.runs_of_documents(coded) == want
    assert [periodic_runs.runs_of_documents([c])[0] for c in coded] == want
    assert sum(map(len, want)) > 300 and max(p for runs in want for *_, p in runs) > 20


@pytest.mark.parametrize("least, repeats", [(1, 3), (10, 5), (6, 8)])
def test_other_limits(least, repeats):
    rng = random.Random(repeats)
    texts = [invented(rng) for _ in range(150)]
    got = periodic_runs.runs_of_documents([[w.encode() for w in t] for t in texts], least, repeats)
    assert got == [plain_runs(t, least, repeats) for t in texts]


def test_long_texts_of_few_words():
    """Fibonacci words are full of short runs; a run of one long period and one of a single word."""
    a, b = ["a"], ["a", "b"]
    while len(b) < 2000:
        a, b = b, b + a
    rng = random.Random(1)
    unit = [f"w{rng.randint(0, 40)}" for _ in range(700)]
    for words in (b, unit * 4 + unit[:100], ["x"] * 3000, (unit[:300] * 5)[:-1] + ["z"] * 50):
        assert periodic_runs.runs_of_documents([[w.encode() for w in words]]) == [plain_runs(words)]


def test_three_periods_at_least():
    with pytest.raises(ValueError):
        periodic_runs.find_runs(None, repeats=2)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    rows = []
    for i in range(240):
        words = [rng.choice(["the", "of", "a", "ä", " x", "\x1cy", "Zz"]) + rng.choice(["", "", "1", "2"]) for _ in range(rng.randint(0, 70))]
        if i % 4 == 0:
            words[3:3] = words[:rng.randint(1, 6)] * rng.randint(3, 9)
        rows.append((i, "".join(w + rng.choice([" ", "\n", "\t", " \x0b\x0c\r"]) for w in words), i, "x"))
    rows += [(None, "na " * 30, 0, "x"), (900, None, 0, "x"), (901, "", 0, "x"), (902, " \n", 0, "x"), rows[4], rows[4], (1, "other text of one id", 0, "y")]
    path = tmp_path_factory.mktemp("runs")
    spark.createDataFrame(rows, "doc_id bigint, text string, runs int, id string").write.parquet(f"{path}/documents.parquet")
    return str(path), rows


def contract(own, text):
    words = WORDS.findall(text or "")
    n = len(words)
    if own is not None and n:
        h = zlib.crc32(str(own).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    digest = hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
    collapsed = hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()
    return (own, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, digest, collapsed)


def test_query_equals_the_contract(spark, folder):
    path, rows = folder
    got = QUERIES["op12_periodic_runs"](spark, path).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    want = [contract(own, text) for own, text, *_ in rows]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert sum(n for _, n, *_ in want) > 40 and sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows) > 8


def test_batches_of_words(spark, folder, monkeypatch):
    """Documents named apart give what they give together."""
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    texts = [(t or "").encode().split() for _, t, *_ in folder[1]]
    want = periodic_runs.runs_of_documents(texts)
    monkeypatch.setattr(periodic_runs, "BATCH_WORDS", 50)
    batch = docs.selectExpr("doc_id as id", "cast(text as binary) as text").coalesce(1).toArrow().combine_chunks().to_batches()[0]
    groups = list(periodic_runs._grouped(batch))
    assert [words for _, group in groups for words in group] == [(t.as_py() or b"").split() for t in batch.column("text")]
    assert len(groups) > 20
    assert sorted(r for _, g in groups for r in periodic_runs.runs_of_documents(g)) == sorted(want)


def test_kept_words():
    words = list("xababababy")
    assert "".join(np.asarray(words)[periodic_runs.kept(10, [(1, 8, 2)])]) == "xaby"


def test_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").limit(0)
    found = periodic_runs.find_runs(docs)
    assert found.columns == ["id", "n_words", "runs", "collapsed"] and found.count() == 0
