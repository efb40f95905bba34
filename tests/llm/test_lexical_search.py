"""The search against plain scoring of every document, and the bounds of the trees."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from shelfwise.llm import lexical_search
from shelfwise.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def plain_terms(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def plain(docs, items, k=10):
    own = [(doc, Counter(plain_terms(text)), len(plain_terms(text))) for doc, text in docs]
    n_docs, total = sum(n > 0 for *_, n in own), sum(n for *_, n in own)
    holding = Counter(t for _, counts, _ in own for t in counts)
    out = []
    for item, text in items:
        scored = []
        for doc, counts, n in own:
            score = 0
            for t in plain_terms(text):
                if counts[t]:
                    m = 100 - 75 + (75 * n * n_docs) // total
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1))) * ((1000000000 * counts[t]) // (1000 * counts[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1)]
    return sorted(map(str, out))


def corpus(rng, n=400):
    words = [f"{a}{b}" for a in ("ka", "Lo", "mi", "né", "TU", "ßa", "字") for b in ("ra", "do", "vi", "12", "")]
    texts = [" ".join(rng.choice(words[:rng.randint(3, len(words))]) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    docs = list(enumerate(texts))
    docs += [(1000 + i, texts[7]) for i in range(60)] + [(5, texts[9]), (5, texts[9]), (None, texts[3]), (None, "kara"), (2000, None), (2001, ""), (2002, "-- ?!"),
                                                         (2003, "kara " * 3000), (2004, "only-here [only] @here")]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 12)))) for i in range(30)]
    items += [(100, None), (101, ""), (102, "nowhere"), (103, "Kara kara KARA-kara"), (104, texts[7]), (3, "only_here"), (3, "only_here"), (None, "lodo")]
    return docs, items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    docs, items = corpus(random.Random(6))
    path = tmp_path_factory.mktemp("search")
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id bigint, text string, score int, query string")
    frame.repartition(5).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(*i, 2) for i in items], "item_id bigint, text string, rank int").write.parquet(f"{path}/benchmark.parquet")
    return str(path), docs, items


def rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_query_equals_plain_scoring(spark, folder):
    path, docs, items = folder
    got = QUERIES["op11_lexical_search"](spark, path)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert rows(got) == plain(docs, items)


@pytest.mark.parametrize("k, limit", [(1, 12), (70, 200_000)])
def test_blocks_and_long_answers(spark, folder, k, limit):
    path, docs, items = folder
    tables = [spark.read.parquet(f"{path}/{name}.parquet") for name in ("documents", "benchmark")]
    assert rows(lexical_search.search(*tables, k=k, block_terms=limit)) == plain(docs, items, k)


def vectors(rows):
    begin = np.cumsum([0, *map(len, rows)])
    return lexical_search.Vectors(begin, np.asarray([t for r in rows for t in sorted(r)]), np.asarray([r[t] for r in rows for t in sorted(r)]), np.arange(len(rows)))


def clusters(rng, count=40, size=50, width=400):
    out = []
    for _ in range(count):
        center = {t: rng.randint(1, 900_000) for t in rng.sample(range(width), 12)}
        out += [{t: max(v + rng.randint(-9_000, 9_000), 1) for t, v in center.items()} for _ in range(size)]
    rng.shuffle(out)
    return out


def walk(node):
    yield node
    for child in node.children:
        yield from walk(child)


def members(node):
    return [r for n in walk(node) if n.vectors for r in n.vectors.row.tolist()]


def test_no_member_is_above_the_bound():
    rng = random.Random(2)
    rows = clusters(rng, 12) + [{3: 1}, {3: 1}, {5: 10**6}]
    root = lexical_search.build(vectors(rows), [(False, i) for i in range(len(rows))], 400, 8)
    assert sorted(members(root)) == list(range(len(rows)))
    for _ in range(20):
        query = np.zeros(400, dtype=np.int64)
        for t in rng.sample(range(400), 30):
            query[t] = rng.randint(1, 15_000)
        length = lexical_search._root_above(int(query @ query))
        for node in walk(root):
            own = members(node)
            assert node.bound(query, length) >= max(sum(query[t] * v for t, v in rows[r].items()) for r in own)
            assert node.first == (False, min(own)) and (node.children or len(own) <= 8)


def test_subtrees_are_pruned():
    """Queries near a cluster score few of the documents, and find the best of all."""
    rng = random.Random(5)
    rows = clusters(rng)
    keys = [(False, i) for i in range(len(rows))]
    root = lexical_search.build(vectors(rows), keys, 400)
    scored = 0
    for row in rows[:50]:
        query = np.zeros(400, dtype=np.int64)
        query[list(row)] = [v // 100 for v in row.values()]
        best = []
        scored += lexical_search.search_tree(root, query, lexical_search._root_above(int(query @ query)), keys, best, 10)
        want = sorted((-int(sum(query[t] * v for t, v in r.items())), k) for r, k in zip(rows, keys))[:10]
        assert best == want
    assert scored < 0.25 * 50 * len(rows)


def test_equal_scores_go_by_id():
    """Copies fill many leaves; the smallest ids win in whatever order the leaves come, and no leaf of larger ids is scored."""
    rng = random.Random(1)
    ids = rng.sample(range(10_000), 900)
    keys = [(i is None, i) for i in [*ids, None]]
    root = lexical_search.build(vectors([{2: 50, 4: 7}] * 901), keys, 6)
    query, best = np.asarray([0, 0, 3, 0, 1, 0]), []
    scored = lexical_search.search_tree(root, query, 4, keys, best, 10)
    assert best == [(-157, (False, i)) for i in sorted(ids)[:10]] and scored <= 901
    before = list(best)
    later = [(False, 20_000 + i) for i in range(901)]
    assert lexical_search.search_tree(lexical_search.build(vectors([{2: 50, 4: 7}] * 901), later, 6), query, 4, later, best, 10) == 0
    assert best == before


def test_square_roots_are_rounded_up():
    for square in [0, 1, 2, 3, 4, 10**16, 10**16 + 1, 2**62 - 1]:
        assert lexical_search._root_above(square) ** 2 >= square


def test_small_shards(spark, folder, monkeypatch):
    """Shards of few rows, in this process: each carries on from the best of those before."""
    _, docs, items = folder
    words = {t.encode(): i for i, t in enumerate(sorted({t for _, text in items for t in plain_terms(text)}))}
    schema = "doc_id bigint, text string"
    counted = lexical_search.count_terms(spark.createDataFrame(docs, schema), words, "doc_id", "text").where("size(terms) > 0").toArrow()
    block = lexical_search.Block([], len(words), 466, 15_000)
    whole = list(lexical_search._shards(iter(counted.to_batches()), block))
    monkeypatch.setattr(lexical_search, "SHARD_ROWS", 7)
    small = list(lexical_search._shards(iter(counted.to_batches()), block))
    assert len(whole) == 1 and len(small) == math.ceil(counted.num_rows / 7)
    assert [i for _, ids in small for i in ids] == whole[0][1]
    assert np.array_equal(np.concatenate([v.value for v, _ in small]), whole[0][0].value)


def test_empty_tables(spark, folder):
    docs, items = (spark.read.parquet(f"{folder[0]}/{name}.parquet") for name in ("documents", "benchmark"))
    for some in (lexical_search.search(docs.limit(0), items), lexical_search.search(docs, items.limit(0)), lexical_search.search(docs.where("text = ''"), items)):
        assert some.columns == ["query_id", "rank", "id", "score"] and some.count() == 0
