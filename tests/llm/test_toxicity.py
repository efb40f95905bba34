"""Counts against brute force, and held-out accuracy on made rows."""

import math
import random
import zlib

import pytest

from shelfwise.llm import toxicity

INSULTS = ["grumlak", "vexnar", "blorpt"]


def made(n=700, seed=1):
    rng = random.Random(seed)
    plain = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "tu", "sa") for b in ("ra", "do", "vi", "pe", "")]
    docs, labels = [], []
    for i in range(n):
        body = [rng.choice(plain) + (rng.choice("abcdefgh") if rng.random() < 0.2 else "") for _ in range(rng.randint(5, 200))]
        toxic = i % 5 == 0
        for _ in range(2 * toxic):
            body.insert(rng.randrange(len(body) + 1), rng.choice(INSULTS).upper())
        docs.append((i, " ".join(body) + "."))
        labels.append((i, 1, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = made()
    extra = [(9_000, None), (9_001, ""), (9_002, "123 !"), (None, "grumlak vexnar"), (None, "grumlak vexnar"), (9_003, "ka " * 50_000)]
    rows = [(i, t, 7, 0.5) for i, t in docs + extra]
    return (spark.createDataFrame(rows, "doc_id bigint, text string, score int, toxic double"),
            spark.createDataFrame(labels + [(9_000, 0, 1), (None, 0, 1), (3, 1, None), (77_777, 0, 1)], "doc_id bigint, quality int, toxic int"))


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.train(*tables)


def test_held_out_accuracy(tables, model):
    toxic = {i: y for i, _, y in made()[1]}
    got = [r for r in toxicity.score(tables[0], model).collect() if r.id in toxic and zlib.crc32(str(r.id).encode()) % 5 == 0]
    assert len(got) > 80
    assert sum(r.predicted == toxic[r.id] for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_texts_without_words_and_repeats(tables, model):
    got = toxicity.score(tables[0], model).where("id is null or id >= 9000").collect()
    assert [r.score for r in got if r.id in (9_000, 9_001, 9_002)] == [0.0] * 3
    assert [r.predicted for r in got if r.id is None] == [1, 1]


def test_shared_counts_are_close_to_the_number_of_neighbours(spark, tables):
    got = {r.word: r.contexts for r in toxicity.shared_counts(tables[0], "text").collect()}
    seen = {}
    for text in [r.text for r in tables[0].select("text").collect()]:
        import regex

        words = regex.findall(toxicity.WORD, (text or "").lower())
        for before, word in zip([None, *words], words):
            seen.setdefault(word, set()).add(before)
    assert set(got) == set(seen)
    for word, before in seen.items():
        if len(before) <= 60:
            assert abs(got[word] - len(before)) <= max(1.0, 0.25 * len(before))


def test_shared_counts_have_no_cap(spark):
    """Words with up to 20,000 neighbours, beside rare ones."""
    sizes = {"rare": 3, "some": 300, "often": 4_000, "hot": 20_000}
    name = lambda k: "".join(chr(97 + k // 26 ** p % 26) for p in range(4))
    docs = spark.createDataFrame([(f"{name(k)} {w}",) for w, n in sizes.items() for k in range(n)], "text string")
    got = {r.word: r.contexts for r in toxicity.shared_counts(docs, "text").where(f"word in {tuple(sizes)}").collect()}
    assert all(abs(got[w] - n) <= max(1.0, 0.15 * n) for w, n in sizes.items())


def test_sample_leaves_out_the_held_out_fold_and_copies(spark):
    docs = spark.createDataFrame([(i, "same text" if i < 50 else f"text {chr(97 + i % 26)} {'x' * i}") for i in range(100)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(4, 1)], "doc_id bigint, toxic int")
    got = toxicity.labelled_sample(docs, labels, "doc_id", "text", 1_000).collect()
    assert all(zlib.crc32(str(r.id).encode()) % 5 for r in got)
    assert sum(r.words == ["same", "text"] for r in got) == 1
    some = toxicity.labelled_sample(docs, labels, "doc_id", "text", 10).collect()
    assert 4 <= len(some) <= 36 and {r.id for r in some} <= set(range(100))


def test_word_ratios_follow_the_formula():
    counts = {"a": (5, 1), "b": (1, 0), "c": (0, 3), "d": (2, 2), "e": (1, 1)}
    contexts = {"a": 6.0, "b": 1.0, "c": 3.0, "d": 4.0}
    ratios, unknown = toxicity.word_ratios(counts, contexts, 14.0, 6)
    sides = []
    for side in (0, 1):
        own = [c[side] for c in counts.values() if c[side]]
        cut = toxicity.discounts(own)
        free = sum(cut[min(c, 3) - 1] for c in own) / sum(own)
        sides.append({w: (max(c[side] - cut[min(c[side], 3) - 1], 0) / sum(own) if c[side] else 0)
                      + free * (contexts.get(w, 0) + 1) / 20 for w, c in counts.items()})
    for word in counts:
        assert math.isclose(ratios[word], math.log(sides[1][word] / sides[0][word]))
    assert unknown == 0.0
    assert ratios["c"] > 0 > ratios["a"]


def test_unknown_words_say_nothing(tables, model):
    assert model.score(["zzzz"] * 40) < 0.5 and model.score(["zzzz"]) < 0.5


def test_toxic_rows_go_with_all_columns_kept(tables):
    docs, labels = tables
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert None not in ids and {9_000, 9_001, 9_002, 9_003} <= set(ids)


def test_without_labels_or_rows(spark, tables):
    docs, labels = tables
    nothing = toxicity.train(docs, labels.where("toxic = 0"))
    assert {r.score for r in toxicity.score(docs, nothing).collect()} == {0.0}
    assert toxicity.drop_toxic(docs, labels.limit(0)).count() == docs.count()
    assert toxicity.drop_toxic(docs.limit(0), labels).count() == 0
