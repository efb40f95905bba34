"""Decontamination against a brute-force search of every window at every position."""

import random
import re

import pytest

from shelfwise.llm import decontaminate
from shelfwise.llm.decontaminate import drop_contaminated


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(docs, items, width=10):
    out = []
    for doc, text in docs:
        own, hit, named = words(text), set(), set()
        for item, item_text in items:
            of_item = words(item_text)
            for s in range(max(len(of_item) - width + 1, 1) if of_item else 0):
                window = of_item[s:s + width]
                for at in range(len(own) - len(window) + 1):
                    if own[at:at + len(window)] == window:
                        hit.update(range(at, at + len(window)))
                        if item is not None:
                            named.add(str(item))
        out.append((doc, len(own), len(hit), sorted(named), bool(hit)))
    return out


def fixture(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "É1", "élan", "x9", "naïve", "go", "a_b", "Ünder", "z"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 9, 10, 11, 25])))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "..."), (None, "null id item words go here now yes it does indeed"), (3, items[3][1]), (30, "the " * 14)]
    docs = [(0, None), (1, ""), (2, "?!"), (3, "the " * 3_000)]
    for i in range(4, 40):
        parts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40)))]
        if rng.random() < 0.6:
            parts.insert(rng.randint(0, 1), "\n" + (rng.choice(items)[1] or "").upper().replace("É", "é") + ", ")
        docs.append((i, ";".join(parts)))
    return docs + [(5, docs[5][1]), (5, "another text"), (None, "null id item words go here now yes it does indeed")], items


@pytest.mark.parametrize("seed,block,shingle", [(1, 200_000, 5), (2, 7, 5), (3, 200_000, 1), (4, 200_000, 10)])
def test_equals_brute_force(spark, seed, block, shingle):
    docs, items = fixture(seed)
    frame = spark.createDataFrame([(a, b, 1, "w") for a, b in docs], "doc_id bigint, text string, pos int, window string")
    bench = spark.createDataFrame([(a, b, 2) for a, b in items], "item_id bigint, text string, hash int")
    got = decontaminate.decontaminate(frame, bench, block=block, shingle=shingle).select("id", "n_words", "n_hit", "items", "contaminated")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain(docs, items)))
    clean = drop_contaminated(frame, bench)
    assert clean.columns == frame.columns
    assert sorted(str((r.doc_id, r.text)) for r in clean.collect()) == sorted(
        str(d) for d, p in zip(docs, plain(docs, items)) if not p[-1])


def test_empty_tables(spark):
    docs, items = fixture(1)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert decontaminate.decontaminate(frame.limit(0), bench).count() == 0
    assert decontaminate.decontaminate(frame, bench.limit(0)).where("contaminated or n_hit > 0").count() == 0
    assert drop_contaminated(frame, bench.limit(0)).count() == len(docs)


def test_main_path_is_native(spark):
    docs, items = fixture(1)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    plan = decontaminate.decontaminate(frame, spark.createDataFrame(items, "item_id bigint, text string"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", text)
