"""Links and components against all pairs; recall of the graph search."""

import math

import numpy as np
import pytest

from shelfwise.llm import embedding_dedup as ed


def vectors(n=400, groups=25, seed=3, size=24, spread=0.03):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, size))
    for g in range(groups):
        base = x[rng.integers(n)]
        members = rng.integers(0, n, rng.integers(2, 9))
        x[members] = base / np.linalg.norm(base) * rng.uniform(0.1, 9) + rng.normal(size=(len(members), size)) * spread
    return x


def plain(rows, cosine=0.9):
    """(id, n_links, component, kept) by comparing all pairs."""
    usable = lambda v: v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v) and any(v)
    unit = [np.asarray(v, dtype=float) / np.linalg.norm(np.asarray(v, dtype=float)) if usable(v) else None for _, v in rows]
    near = [[j for j, b in enumerate(unit) if j != i and a is not None and b is not None and len(a) == len(b) and float(a @ b) >= cosine]
            for i, a in enumerate(unit)]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, links in enumerate(near):
            low = min([label[i], *(label[j] for j in links)])
            for k in [i, *links]:
                if label[k] != low:
                    label[k], changed = low, True
    least = {}
    for i, (own, _) in enumerate(rows):
        if own is not None:
            least[label[i]] = min(own, least.get(label[i], own))
    return [(own, len(near[i]), least.get(label[i]), own == least.get(label[i])) for i, (own, _) in enumerate(rows)]


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(c) if c is not None else None for c in v] if v is not None else None, 1, "x") for i, v in rows],
                                 "vec_id bigint, embedding array<float>, label int, unit string")


def as_float32(x):
    return [[float(c) for c in v] for v in np.asarray(x, dtype=np.float32)]


@pytest.mark.parametrize("target,shard,block", [(1_200, 2_000, 1_000), (100, 2_000, 1_000), (150, 60, 30)])
def test_equals_all_pairs(spark, monkeypatch, target, shard, block):
    """One shard, several shards, and shards cut into pairs of blocks."""
    for name, value in (("TARGET", target), ("SHARD", shard), ("BLOCK", block)):
        monkeypatch.setattr(ed, name, value)
    rows = [(i * 3, v) for i, v in enumerate(as_float32(vectors()))]
    rows += [(5_000 + i, rows[7][1]) for i in range(30)] + [(rows[9][0], rows[9][1])]
    got = sorted(tuple(r) for r in ed.near_duplicates(frame(spark, rows)).collect())
    want = sorted(plain(rows))
    found, true = sum(r[1] for r in got), sum(r[1] for r in want)
    assert len(got) == len(want) and found <= true and found >= 0.97 * true
    assert sum(a == b for a, b in zip(got, want)) >= 0.97 * len(want)


def test_unusable_vectors_lengths_and_null_ids(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (7, [1.0, 0.0]), (8, [2.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]), (None, [3.0, 0.01]),
            (None, [0.0, 5.0]), (11, [-0.0, 1.0]), (12, [0.0, 1.0]), (13, [1e-38, 1e38]), (14, [1e-30, 1e-30]), (None, None)]
    got = ed.near_duplicates(frame(spark, rows)).collect()
    want = [(a, n, c, True if k or a is None and c is None else False) for a, n, c, k in plain(rows)]
    assert sorted(map(str, [(r.id, r.n_links, r.component_id) for r in got])) == sorted(map(str, [w[:3] for w in want]))
    assert all(r.kept == (r.id == r.component_id) for r in got if r.id is not None)


def test_empty_table_and_bad_threshold(spark):
    assert ed.near_duplicates(frame(spark, [])).count() == 0
    assert ed.near_duplicates(frame(spark, [(1, None)])).first().n_links == 0
    with pytest.raises(ValueError):
        ed.near_duplicates(frame(spark, []), cosine=0.0)


def test_recall_of_the_graph_alone():
    """Pairs right at the threshold, in clusters and alone, and one dense group."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1_200, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(0, 400, 2):  # cosine about 0.91
        other = rng.normal(size=64)
        other -= (other @ x[i]) * x[i]
        x[i + 1] = 0.91 * x[i] + math.sqrt(1 - 0.91 ** 2) * other / np.linalg.norm(other)
    x[800:] = x[800] + rng.normal(size=(400, 64)) * 0.02
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found, true = ed.range_links(x, ed.build_graph(x)), x @ x.T >= 0.9
    np.fill_diagonal(true, False)
    assert not (found & ~true).any()
    assert found.sum() >= 0.97 * true.sum()
    assert found[:400].sum() >= 0.9 * true[:400].sum()


def test_graph_has_bounded_lists_and_pruning_keeps_the_nearest():
    x = vectors(300)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lists = ed.build_graph(x)
    assert max(map(len, lists)) <= ed.DEGREE + ed.SLACK
    candidates = np.tile(np.arange(1, 60), (1, 1))
    kept = ed._prune(x, np.array([0]), candidates)[0]
    assert kept[0] == 1 + int(np.argmax(x[1:60] @ x[0]))


def test_pairs_across_shards_at_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(ed, "TARGET", 120)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(0, 400, 2):
        other = rng.normal(size=64)
        other -= (other @ x[i]) * x[i]
        x[i + 1] = 0.93 * x[i] + math.sqrt(1 - 0.93 ** 2) * other / np.linalg.norm(other)
    df = frame(spark, list(enumerate(as_float32(x))))
    result = ed.near_duplicates(df)
    true, found = ed.audit_recall(df, result, divisor=1)
    assert true >= 380 and found >= 0.9 * true
    some = ed.audit_recall(df, result, divisor=20, block=7)
    assert 0 < some[1] <= some[0] < true


@pytest.mark.parametrize("guests,shard,block", [(2_000, 2_000, 1_000), (25, 60, 30)])
def test_visits_find_pairs_that_share_no_shard(spark, monkeypatch, guests, shard, block):
    """Unclustered vectors, pairs right at the threshold; rooms and blocks are split in the second case.

    Centroids of few samples each, as on a large table, where they don't follow single pairs.
    """
    for name, value in (("TARGET", 40), ("OVERLAP", 2), ("SAMPLE", 2), ("GUESTS", guests), ("SHARD", shard), ("BLOCK", block)):
        monkeypatch.setattr(ed, name, value)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1_600, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(0, 1_200, 2):
        other = rng.normal(size=64)
        other -= (other @ x[i]) * x[i]
        x[i + 1] = 0.902 * x[i] + math.sqrt(1 - 0.902 ** 2) * other / np.linalg.norm(other)
    rows = list(enumerate(as_float32(x))) + [(2_000 + i, v) for i, v in enumerate(as_float32(x[:40]))]
    df = frame(spark, rows)
    got = sorted(tuple(r) for r in ed.near_duplicates(df).collect())
    want = sorted(plain(rows))
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want)
    assert sum(a == b for a, b in zip(got, want)) >= 0.99 * len(want)
    without = ed.near_duplicates(df, visits=0)
    assert without.agg({"n_links": "sum"}).first()[0] < 0.97 * sum(w[1] for w in want)


def test_a_pair_met_on_several_visits_counts_once():
    """0 and 1 link; each visits the other's shards, and both rows of a shared shard are left to it."""
    import pandas as pd
    unit = [[1.0, 0.0], [0.95, math.sqrt(1 - 0.95 ** 2)]]
    row = lambda c, cells, visits, near: {"class": c, "n": c + 1, "unit": unit[c], "cells": cells, "visits": visits, "neighbours": near}
    a, b = row(0, [4, 5], [2, 7], []), row(1, [2, 3], [5], [])
    at_two = ed.visiting_links(pd.DataFrame([a]), pd.DataFrame([b]), 2)
    at_five = ed.visiting_links(pd.DataFrame([b]), pd.DataFrame([a]), 5)
    assert at_two.values.tolist() == [[0, 2, 0], [1, 1, 0]]
    assert at_five.values.tolist() == [[0, 0, 0], [1, 0, 0]]
    b = row(1, [2, 5], [], [])
    assert ed.visiting_links(pd.DataFrame([a]), pd.DataFrame([b]), 2).values.tolist() == [[0, 0, 0], [1, 0, 0]]
    assert ed.visiting_links(pd.DataFrame([a]).iloc[:0], pd.DataFrame([b]), 2).empty
