"""SimHash classes against a brute-force comparison of all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import simhash
from shelfwise.llm.components import components

COLUMNS = "doc_id bigint, text string, fingerprint string, class int, id string, text_hash string"


def plain_fingerprint(text):
    """Written from the definition, one bit at a time."""
    import xxhash

    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {n: root(n) for n in nodes}


def corpus():
    rng = random.Random(5)
    words = [f"w{i}é" for i in range(60)]
    texts = [None, "", " \t\n", "One", "one", "Two words", "ÄRGER Ärger x", "x " * 60_000]
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randint(30, 120))]
        texts.append(" ".join(base))
        for _ in range(3):
            near = list(base)
            near[rng.randrange(len(near))] = "changed"
            texts.append(" ".join(near))
        texts.append(" ".join(base).upper().replace("É", "é"))
    return [(i, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x", 1, "y", "z") for i, t in corpus()], COLUMNS)


def test_fingerprint_follows_the_definition():
    for _, text in corpus()[:30]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_long_texts_are_counted_in_batches(monkeypatch):
    text = " ".join(f"t{i % 97}" for i in range(1000))
    monkeypatch.setattr(simhash, "BATCH", 64)
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_classes_equal_brute_force(docs):
    got = {r["id"]: r for r in simhash.near_duplicates(docs).collect()}
    prints = {i: plain_fingerprint(t) for i, t in corpus()}
    assert {i: r["fingerprint"] % 2 ** 64 for i, r in got.items()} == prints
    want = plain_components(sorted(prints), lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 2)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert len(set(want.values())) < len(want) - 10


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_no_link_is_lost(spark, radius):
    rng = random.Random(radius)
    values = {0}
    while len(values) < 120:
        start = rng.choice(sorted(values))
        for _ in range(rng.randint(0, 5)):
            start ^= 1 << rng.randrange(64)
        values.add(start)
    signed = [v - 2 ** 64 if v >> 63 else v for v in values]
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(v,) for v in signed], "fingerprint bigint"), radius).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) % 2 ** 64).count("1") <= radius}
    assert got == want


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([], "fingerprint bigint"), 3)


def test_one_row_of_each_class_stays_with_all_columns(spark, docs):
    again = docs.union(docs).union(docs.limit(0))
    kept = simhash.keep_one(again)
    assert kept.columns == docs.columns
    rows = kept.collect()
    want = plain_components([i for i, _ in corpus()], lambda a, b: bin(
        plain_fingerprint(dict(corpus())[a]) ^ plain_fingerprint(dict(corpus())[b])).count("1") <= 2)
    assert sorted(r.doc_id for r in rows) == sorted(set(want.values()))


def test_null_ids(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (7, "e f g h i"), (None, "e f g h i"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = simhash.near_duplicates(docs)
    assert sorted(map(str, ((r.id, r.component_id) for r in found.collect()))) == sorted(
        map(str, [(None, None), (None, None), (7, 7), (None, 7), (9, 9)]))
    assert sorted(map(str, simhash.keep_one(docs).collect())) == sorted(map(str, docs.where(
        "doc_id is not null").union(docs.limit(1)).collect()))


def test_empty_table(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(500, 500 + i) for i in range(1, 80)]
    mixed = [(b, a) for a, b in path] + star + star + [(3, 3), (None, 4), (5, None)]
    links = spark.createDataFrame(mixed, "a bigint, b bigint")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 580)}}
    assert components(links.limit(0)).count() == 0
    assert components(links).groupBy("node").count().where(F.col("count") > 1).count() == 0
