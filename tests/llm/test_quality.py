"""The classifier against plain dictionaries, and its accuracy on held-out rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import quality
from shelfwise.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, lang string, source string, quality int, id string, place int"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(3)
    parts = ["ka", "lo", "mi", "ne", "tu", "sa", "ra", "do"]
    rows, labels = [], []
    for i in range(900):
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(4, 60))]
        good = rng.random() < 0.8
        if not good:
            kind = i % 3
            words = [w.upper() + "!!" for w in words] if kind == 0 else [w + " |" for w in words] if kind == 1 else [w for w in words for _ in range(4)]
        rows.append((i, " ".join(words), "en", "s", 7, "x", 1))
        if i % 10 < 8:
            labels.append((i, int(good), 0))
    rows += [(None, "no id here", None, None, None, None, None), (1000, None, "en", "s", 1, "x", 1), (1001, "", "en", "s", 1, "x", 1),
             (1002, " \n\x00", "en", "s", 1, "x", 1), (1003, "ka lo " * 40_000, "en", "s", 1, "x", 1), rows[5], rows[5], (5, "ka lo mi", "en", "s", 1, "x", 1)]
    labels += [(1000, 1, 0), (1001, 0, 0), (5, 1, 1), (6, 0, 0), (7, None, 0), (None, 1, 0), (8, 2, 0), (40_000, 1, 0)]
    path = tmp_path_factory.mktemp("quality")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), rows, labels


def plain_vector(text):
    """Places and weights by counting single n-grams; the mixing of hashes is the definition."""
    words = quality.TOKEN.findall(text or "")
    forms = [8 if k and words[k - 1] == w else quality.form(w) for k, w in enumerate(words)]
    units = [zlib.crc32(w.encode()) << 4 | quality.form(w) for w in words]
    total, mask, mix = Counter(), (1 << 64) - 1, 0x9E3779B97F4A7C15
    for sequence, longest, seed in ((units, quality.LONGEST, 1), (forms, quality.LONGEST_FORMS, 2)):
        counts = Counter()
        for size in range(1, longest + 1):
            for k in range(len(sequence) - size + 1):
                rolled = seed
                for unit in sequence[k:k + size]:
                    rolled = (rolled * mix + unit + 1) & mask
                counts[((rolled ^ rolled >> 29) * mix & mask) >> 64 - quality.BITS] += 1
        weights = {p: 1 + math.log(n) for p, n in counts.items()}
        length = math.sqrt(sum(w * w for w in weights.values()) + quality.SHORT)
        total.update({p: w / length for p, w in weights.items()})
    return dict(total)


def plain_scores(rows, labels):
    """Shards one after another, a place at a time, with textbook updates."""
    marks = {}
    for own, mark, _ in labels:
        if own is not None and mark in (0, 1) and zlib.crc32(str(own).encode()) % 4 != 2:
            marks[own] = min(mark, marks.get(own, 1))
    texts = {}
    for own, text, *_ in rows:
        if own in marks and text is not None:
            texts[text] = min(texts.get(text, own), own)
    return marks, texts


def learn(vectors, labels, z, n, intercept):
    z, n, met = dict(z), dict(n), set()
    for vector, label in zip(vectors, labels):
        w = {p: weight(z.get(p, 0.0), n.get(p, 0.0)) for p in vector}
        error = 1 / (1 + math.exp(-intercept - sum(w[p] * v for p, v in vector.items()))) - label
        for p, v in vector.items():
            g, before = error * v, n.get(p, 0.0)
            z[p] = z.get(p, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / quality.ALPHA * w[p]
            n[p] = before + g * g
        met |= set(vector)
    return {p: (z[p], n[p]) for p in met}


def weight(z, n):
    return 0.0 if abs(z) <= quality.L1 else -(z - math.copysign(quality.L1, z)) / ((quality.BETA + math.sqrt(n)) / quality.ALPHA + quality.L2)


def test_vectors():
    hasher = quality.Hasher()
    for text in ["", None, "a", "The the the cat\n12 12 ££ _ Ünter ÜNTER iPhone 中文 中文", "x " * 500, "\x00  "]:
        places, weights = hasher.vector(text)
        want = plain_vector(text)
        assert sorted(want) == places.tolist()
        assert np.allclose([want[p] for p in places.tolist()], weights)


def test_few_hashes_are_remembered(monkeypatch):
    text = " ".join(f"w{k % 70} W{k}" for k in range(300))
    want = quality.Hasher().vector(text)
    monkeypatch.setattr(quality, "REMEMBERED", 16)
    small = quality.Hasher()
    got = small.vector(text)
    assert all(np.array_equal(a, b) for a, b in zip(got, want)) and len(small.known) <= 16


def test_query_equals_plain_updates(spark, folder):
    path, rows, labels = folder
    marks, texts = plain_scores(rows, labels)
    place = {r.id: r.p for r in spark.createDataFrame([(k,) for k in marks], "id bigint").select("id", F.pmod(F.xxhash64("id"), F.lit(1 << 30)).alias("p")).collect()}
    order = sorted(texts, key=lambda t: place[texts[t]])
    of_quality = sum(marks[texts[t]] for t in order)
    intercept = math.log((of_quality + 1) / (len(order) - of_quality + 1))
    coded = {t: plain_vector(t) for t in order}
    z, n = {}, {}
    for _ in range(quality.ROUNDS):
        states = []
        for shard in range(quality.SHARDS):
            own = [t for t in order if place[texts[t]] % quality.SHARDS == shard]
            states.append(learn([coded[t] for t in own], [marks[texts[t]] for t in own], z, n, intercept))
        for p in set().union(*states):
            met = [s[p] for s in states if p in s]
            z[p], n[p] = (sum(m[k] for m in met) / len(met) for k in (0, 1))
    got = QUERIES["op13_quality"](spark, path)
    assert got.dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    want = sorted((str(own), round(1 / (1 + math.exp(-intercept - sum(weight(z.get(p, 0.0), n.get(p, 0.0)) * v for p, v in plain_vector(text).items()))), 9))
                  for own, text, *_ in rows)
    assert sorted((str(r.doc_id), round(r.score, 9)) for r in got.collect()) == want


def test_held_out_rows(spark, folder):
    path, rows, labels = folder
    marks = {own: mark for own, mark, _ in labels if own is not None and own < 900 and own not in (5, 6, 7, 8)}
    got = [r for r in QUERIES["op13_quality"](spark, path).collect()]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in got) and len(got) == len(rows)
    held = [r for r in got if r.held_out and r.doc_id in marks]
    right = sum(r.predicted == marks[r.doc_id] for r in held)
    assert len(held) > 100 and right >= 0.97 * len(held)


def test_no_labels_and_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    labels = spark.read.parquet(f"{folder[0]}/labels.parquet")
    weights = quality.train(docs, labels.limit(0))
    assert not weights.any()
    assert {r.score for r in quality.score(docs, weights).collect()} == {0.5}
    assert quality.score(docs.limit(0), weights).count() == 0
    assert not quality.train(docs.limit(0), labels).any()


def test_sample_is_a_share_of_hashes(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    labels = spark.read.parquet(f"{folder[0]}/labels.parquet")
    some = quality.labelled_sample(docs, labels, "doc_id", "text", 200).collect()
    everything = quality.labelled_sample(docs, labels, "doc_id", "text", 10_000).collect()
    assert 140 < len(some) < 260 and {r.place for r in some} < {r.place for r in everything}
    assert max(r.place for r in some) < min(r.place for r in everything if r not in some)
