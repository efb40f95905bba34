"""Near-duplicate vectors by range search on a robust-pruned flat graph.

1. Equal vectors are one class, so copies cost nothing beyond one grouping.
2. Classes go to overlapping cluster shards: each to its `OVERLAP` nearest centroids. Centroids
   are fitted on a bounded sample. A shard over `SHARD` classes is cut into blocks, and each pair of
   blocks is a shard of its own, so no task grows with a dense cluster and no pair in it is lost.
3. Each shard builds a graph by greedy searches and robust pruning; the adjacency lists that a
   class got in its shards are united.
4. Each shard searches the united graph for every class in it: greedily from the medoid and the
   class itself until the best are settled, then outwards through everything within range.
5. The search goes on in other shards: a class enters the united graph at the medoids of its next
   `VISITS` nearest shards as well, as a guest that has no node there. A shard is left out if no
   vector within range of the class can have that shard as its nearest: its centroid's angle to the
   class exceeds that of the nearest centroid by more than twice the threshold's angle.
6. What was found is verified by the cosine in double precision. A pair that meets in several
   shards counts in the first one only, one that meets on visits alone in the first visit, so no
   list of pairs is built or shuffled; per class the links are counted and one link towards the
   task's least class in reach is kept.

The graph search can miss pairs, so `audit_recall` compares it with brute force.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import written
from .components import components

COSINE = 0.9
OVERLAP = 3
#: Further shards that a class visits, and guests of one task.
VISITS, GUESTS = 6, 2_000
#: Classes of one search task, and of a block when a shard has more.
SHARD, BLOCK = 2_000, 1_000
#: Classes that a shard should have on average.
TARGET = 1_200
#: Bounds of the fitted model: centroids, and sampled classes for each.
MAX_CENTROIDS, SAMPLE = 4_096, 16
#: Out-neighbours of a node, slack before a list is pruned again, candidates for pruning, stretch.
DEGREE, SLACK, CANDIDATES, ALPHA = 24, 12, 64, 1.2
#: Best nodes that must be settled, nodes expanded and queries handled at once.
BEAM, WIDTH, QUERIES = 32, 4, 256
EVALUATED = 200_000


# --- the graph of one shard ---------------------------------------------------------------------

def _similarities(x: np.ndarray, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Cosine of queries[i] and x[nodes[i]] for unit vectors, in bounded pieces."""
    out = np.empty(len(nodes))
    for k in range(0, len(nodes), EVALUATED):
        out[k:k + EVALUATED] = np.einsum("id,id->i", queries[k:k + EVALUATED], x[nodes[k:k + EVALUATED]])
    return out


def _expand(
    x: np.ndarray, adjacency: np.ndarray, vectors: np.ndarray, seen: np.ndarray, rows: np.ndarray, nodes: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Evaluate the unseen neighbours of `nodes` for the queries in `rows`; `seen` has -2 where not evaluated.

    Returns (query, node, similarity) of the new ones, by query.
    """
    near = adjacency[nodes]
    keys = (rows[:, None] * seen.shape[1] + near)[near >= 0]
    flat = seen.reshape(-1)
    keys = np.unique(keys[flat[keys] < -1.5])
    new = keys // seen.shape[1], keys % seen.shape[1]
    flat[keys] = _similarities(x, vectors[new[0]], new[1])
    return *new, flat[keys]


def _greedy(
    x: np.ndarray, adjacency: np.ndarray, vectors: np.ndarray, medoid: int, own: np.ndarray | None,
) -> tuple[np.ndarray, np.ndarray]:
    """(similarities of evaluated nodes, expanded) per query, from the medoid and the query's own node if it has one."""
    count, everyone = len(vectors), np.arange(len(vectors))
    seen, expanded = np.full((count, len(x)), -2.0), np.zeros((count, len(x)), dtype=bool)
    seen[everyone, medoid] = _similarities(x, vectors, np.full(count, medoid))
    # The best nodes of each query; -2 marks a free place, and an expanded node is not taken again.
    nodes, sims = np.zeros((count, BEAM), dtype=np.int64), np.full((count, BEAM), -2.0)
    nodes[:, 0], sims[:, 0] = medoid, seen[:, medoid]
    if own is not None:
        seen[everyone, own] = 1.0
        other = own != medoid
        nodes[:, 1], sims[other, 1] = own, 1.0
    active = everyone
    while len(active):
        waiting = np.where(expanded[active[:, None], nodes[active]], -2.0, sims[active])
        best = np.argpartition(waiting, -WIDTH, axis=1)[:, -WIDTH:]
        at, column = np.nonzero(np.take_along_axis(waiting, best, axis=1) > -1.5)
        rows, chosen = active[at], nodes[active[at], best[at, column]]
        expanded[rows, chosen] = True
        active = np.unique(rows)
        rows, near, found = _expand(x, adjacency, vectors, seen, rows, chosen)
        if not len(rows):
            continue
        into, start = np.unique(rows, return_index=True)
        sizes = np.diff([*start, len(rows)])
        place = np.repeat(np.arange(len(into)), sizes), BEAM + np.arange(len(rows)) - np.repeat(start, sizes)
        wide = np.zeros((len(into), BEAM + sizes.max()), dtype=np.int64), np.full((len(into), BEAM + sizes.max()), -2.0)
        wide[0][:, :BEAM], wide[1][:, :BEAM] = nodes[into], sims[into]
        wide[0][place], wide[1][place] = near, found
        top = np.argpartition(wide[1], -BEAM, axis=1)[:, -BEAM:]
        nodes[into], sims[into] = np.take_along_axis(wide[0], top, axis=1), np.take_along_axis(wide[1], top, axis=1)
    return seen, expanded


def _range(
    x: np.ndarray, adjacency: np.ndarray, vectors: np.ndarray, medoid: int, cosine: float, own: np.ndarray | None = None,
) -> np.ndarray:
    """Boolean (query, node): nodes within range that a greedy search and its expansion reach."""
    seen, expanded = _greedy(x, adjacency, vectors, medoid, own)
    while True:
        rows, nodes = np.nonzero((seen >= cosine) & ~expanded)
        if not len(rows):
            return seen >= cosine
        expanded[rows, nodes] = True
        for k in range(0, len(rows), 20_000):
            _expand(x, adjacency, vectors, seen, rows[k:k + 20_000], nodes[k:k + 20_000])


def _prune(x: np.ndarray, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Robust pruning: neighbours (-1 padded) of each node from its candidates (-1 padded, no node itself).

    The nearest candidate stays and rules out those that it is closer to, by the factor ALPHA, than
    the node is; and so on until the list is full.
    """
    valid = candidates >= 0
    sims = np.where(valid, np.einsum("id,icd->ic", x[nodes], x[candidates]), -3.0)
    order = np.argsort(-sims, axis=1, kind="stable")[:, :CANDIDATES]
    candidates, sims = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(sims, order, axis=1)
    alive = sims > -2.5
    to_node = np.maximum(2.0 - 2.0 * sims, 0.0)  # squared distances
    among = x[candidates]
    between = np.maximum(2.0 - 2.0 * np.matmul(among, among.transpose(0, 2, 1)), 0.0)
    out, row = np.full((len(nodes), DEGREE), -1), np.arange(len(nodes))
    for k in range(DEGREE):
        first = np.argmax(alive, axis=1)
        has = alive[row, first]
        if not has.any():
            break
        out[has, k] = candidates[row, first][has]
        alive &= ALPHA * ALPHA * between[row, first] > to_node
        alive[row, first] = False
    return out


def _padded(lists: list[np.ndarray]) -> np.ndarray:
    width = max([1, *map(len, lists)])
    out = np.full((len(lists), width), -1)
    for i, values in enumerate(lists):
        out[i, :len(values)] = values
    return out


def medoid_of(x: np.ndarray) -> int:
    return int(np.argmax(x @ x.mean(axis=0)))


def build_graph(x: np.ndarray, seed: int = 0) -> list[np.ndarray]:
    """Adjacency lists of unit vectors: searches on the graph so far give each node's candidates."""
    count = len(x)
    if count == 1:
        return [np.empty(0, dtype=np.int64)]
    random = np.random.default_rng(seed)
    lists = [np.unique(row[row != i]) for i, row in enumerate(random.integers(0, count, (count, DEGREE // 2)))]
    medoid, order = medoid_of(x), random.permutation(count)
    for k in range(0, count, QUERIES):
        batch = order[k:k + QUERIES]
        seen, _ = _greedy(x, _padded(lists), x[batch], medoid, batch)
        seen[np.arange(len(batch)), batch] = -2.0
        keep = min(CANDIDATES, count)
        top = np.argpartition(seen, -keep, axis=1)[:, -keep:]
        top = np.where(np.take_along_axis(seen, top, axis=1) > -1.5, top, -1)
        chosen = _prune(x, batch, top)
        back: dict[int, list[int]] = {}
        for node, neighbours in zip(batch.tolist(), chosen):
            lists[node] = neighbours[neighbours >= 0]
            for other in lists[node].tolist():
                back.setdefault(other, []).append(node)
        full = []
        for other, nodes in back.items():
            lists[other] = np.union1d(lists[other], nodes)
            if len(lists[other]) > DEGREE + SLACK:
                full.append(other)
        for j in range(0, len(full), QUERIES):
            part = np.asarray(full[j:j + QUERIES])
            pruned = _prune(x, part, _padded([lists[i] for i in part]))
            for node, neighbours in zip(part.tolist(), pruned):
                lists[node] = neighbours[neighbours >= 0]
    return lists


def range_links(x: np.ndarray, lists: list[np.ndarray], cosine: float = COSINE) -> np.ndarray:
    """Boolean matrix of the links found by searching every node, from either end, verified."""
    adjacency, medoid = _padded(lists), medoid_of(x)
    found = np.zeros((len(x), len(x)), dtype=bool)
    for k in range(0, len(x), QUERIES):
        own = np.arange(k, min(k + QUERIES, len(x)))
        found[own] = _range(x, adjacency, x[own], medoid, cosine, own)
    found |= found.T
    np.fill_diagonal(found, False)
    return found


def _first_met(found: np.ndarray, tasks: list[list[int]], task: int) -> np.ndarray:
    """`found` without the pairs that meet in an earlier task, too."""
    earlier = sorted({t for own in tasks for t in own if t < task})
    if not earlier:
        return found
    column = {t: i for i, t in enumerate(earlier)}
    member = np.zeros((len(tasks), len(earlier)), dtype=np.float32)
    for i, own in enumerate(tasks):
        member[i, [column[t] for t in own if t < task]] = 1
    return found & (member @ member.T < 0.5)


def _roots(count: int, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Least node in reach of each node, by links from `rows` to `columns` given in both directions."""
    label = np.arange(count)
    while True:
        lower = label.copy()
        np.minimum.at(lower, rows, label[columns])
        lower = lower[lower]
        if (lower == label).all():
            return label
        label = lower


# --- the job ------------------------------------------------------------------------------------

def classes_of(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(class, first_id, n, embedding, unit) per distinct usable vector of `df`."""
    vector = F.col(vector_column).cast("array<double>")
    finite = F.forall(vector, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    usable = df.where(finite & F.exists(vector, lambda v: v != 0))
    grouped = usable.groupBy(F.col(vector_column).alias("embedding")).agg(
        F.count("*").alias("n"), F.min(id_column).alias("first_id"))
    wide = F.col("embedding").cast("array<double>")
    # The largest component is scaled to 1 first, so that squares neither overflow nor vanish.
    scaled = F.transform(wide, lambda v: v / F.array_max(F.transform(wide, F.abs)))
    return grouped.select(F.monotonically_increasing_id().alias("class"), "first_id", "n", "embedding", scaled.alias("unit"))


def _unit(values: pd.Series) -> np.ndarray:
    x = np.asarray(values.tolist(), dtype=np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centroids(classes: DataFrame, limit: int = MAX_CENTROIDS, seed: int = 0) -> dict[int, np.ndarray]:
    """At most `limit` centroids per vector length, by Lloyd steps on a sample of SAMPLE classes for each."""
    out = {}
    for size, count in classes.groupBy(F.size("unit")).count().collect():
        k = int(min(limit, max(1, -(-OVERLAP * count // TARGET))))
        share = min(1.0, k * SAMPLE * 1.2 / count)
        bound = int(share * (1 << 31))
        rows = classes.where((F.size("unit") == size) & (F.pmod(F.xxhash64("unit"), F.lit(1 << 31)) <= bound)).select("unit")
        x = _unit(rows.limit(limit * SAMPLE).toPandas()["unit"])
        means = x[np.random.default_rng(seed).permutation(len(x))[:k]]
        for _ in range(8):
            nearest = np.argmax(x @ means.T, axis=1)
            sums = np.zeros_like(means)
            np.add.at(sums, nearest, x)
            norms = np.linalg.norm(sums, axis=1, keepdims=True)
            means = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), means)
        out[size] = means
    return out


def place(classes: DataFrame, model: dict[int, np.ndarray], cosine: float = COSINE, visits: int = VISITS) -> DataFrame:
    """(class, n, unit, cells, visits): the shards that a class belongs to, nearest first, and those it visits."""
    first = dict(zip(model, np.cumsum([0, *(len(m) for m in model.values())]).tolist()))
    reach, overlap = 2 * np.arccos(cosine) + 1e-9, OVERLAP

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for size, part in frame.groupby(frame["unit"].map(len)):
                sims = _unit(part["unit"]) @ model[size].T
                order = np.argsort(-sims, axis=1, kind="stable")[:, :overlap + visits]
                angles = np.arccos(np.clip(np.take_along_axis(sims, order, axis=1), -1.0, 1.0))
                near = angles[:, overlap:] <= angles[:, :1] + reach
                cells = order + first[size]
                yield pd.DataFrame({"class": part["class"], "n": part["n"], "unit": part["unit"], "cells": cells[:, :overlap].tolist(),
                                    "visits": [row[use].tolist() for row, use in zip(cells[:, overlap:], near)]})

    return classes.select("class", "n", "unit").mapInPandas(
        assign, "class bigint, n bigint, unit array<double>, cells array<bigint>, visits array<bigint>")


def _blocks(placed: DataFrame) -> DataFrame:
    """(cell, blocks): one row per centroid, a bounded table."""
    return (placed.select(F.explode("cells").alias("cell")).groupBy("cell").count()
            .select("cell", F.when(F.col("count") <= SHARD, 1).otherwise(F.ceil(F.col("count") / BLOCK)).cast("bigint").alias("blocks")))


def _part(blocks: str) -> Column:
    return F.pmod(F.xxhash64("class"), F.col(blocks))


def shards(placed: DataFrame) -> DataFrame:
    """(task, tasks, class, n, unit): every class with each task that it belongs to."""
    each = placed.select("class", F.explode("cells").alias("cell")).join(F.broadcast(_blocks(placed)), "cell")
    part = _part("blocks")
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("bigint"))).otherwise(
        F.array_except(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), F.array(part)))
    task = F.transform(others, lambda other: F.col("cell") * F.lit(1 << 40) + F.least(part, other) * F.lit(1 << 20) + F.greatest(part, other))
    tasks = each.groupBy("class").agg(F.array_sort(F.flatten(F.collect_list(task))).alias("tasks"))
    joined = placed.select("class", "n", "unit").join(tasks, "class")
    return joined.select(F.explode("tasks").alias("task"), "tasks", "class", "n", "unit")


def united_graph(sharded: DataFrame) -> DataFrame:
    """(class, neighbours): the adjacency lists of all shards, united by class."""
    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("class")
        names = frame["class"].to_numpy()
        lists = build_graph(_unit(frame["unit"]))
        return pd.DataFrame({"class": names, "neighbours": [names[near].tolist() for near in lists]})

    built = sharded.select("task", "class", "unit").groupBy("task").applyInPandas(build, "class bigint, neighbours array<bigint>")
    return built.groupBy("class").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))


def _local(names: np.ndarray, neighbours: pd.Series) -> list[np.ndarray]:
    """The united lists as places in the sorted `names`, without classes that aren't there."""
    lists = []
    for near in neighbours:
        at = np.searchsorted(names, near)
        at = at[at < len(names)] if len(near) == 0 else np.where(at < len(names), at, 0)
        lists.append(at[names[at] == np.asarray(near)] if len(near) else np.empty(0, dtype=np.int64))
    return lists


def search(sharded: DataFrame, graph: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(class, weight, least) per class and task: rows linked to it, counted where the pair meets first,
    and the least class of the task in reach."""
    def find(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("class")
        names, weights = frame["class"].to_numpy(), frame["n"].to_numpy()
        x = _unit(frame["unit"])
        found = range_links(x, _local(names, frame["neighbours"]), cosine)
        first = _first_met(found, frame["tasks"].tolist(), int(frame["task"].iloc[0]))
        return pd.DataFrame({"class": names, "weight": (first @ weights.astype(np.float64)).round().astype(np.int64),
                             "least": names[_roots(len(found), *np.nonzero(found))]})

    joined = sharded.join(graph, "class")
    return joined.groupBy("task").applyInPandas(find, "class bigint, weight bigint, least bigint")


def _shared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Per row, the least cell that both padded lists name; a very large number if there is none."""
    same = (left[:, :, None] == right[:, None, :]) & (left[:, :, None] >= 0)
    return np.where(same, left[:, :, None], np.iinfo(np.int64).max).min(axis=(1, 2))


def visiting_links(guests: pd.DataFrame, members: pd.DataFrame, cell: int, cosine: float = COSINE) -> pd.DataFrame:
    """(class, weight, least) of the guests and members of one task that a guest's search links.

    A pair that shares a shard was counted there; of the others each counts in the least cell where one
    end is a guest of the other's.
    """
    nobody = pd.DataFrame({"class": [], "weight": [], "least": []}, dtype="int64")
    if guests.empty or members.empty:
        return nobody
    members = members.sort_values("class")
    names, hosts = guests["class"].to_numpy(), members["class"].to_numpy()
    x, vectors = _unit(members["unit"]), _unit(guests["unit"])
    adjacency, medoid = _padded(_local(hosts, members["neighbours"])), medoid_of(x)
    cells, visits = ([_padded([np.asarray(v, dtype=np.int64) for v in part[column]]) for part in (guests, members)]
                     for column in ("cells", "visits"))
    counts = [part["n"].to_numpy(dtype=np.int64) for part in (guests, members)]
    weights = [np.zeros(len(part), dtype=np.int64) for part in (guests, members)]
    links = []
    for k in range(0, len(names), QUERIES):
        rows, nodes = np.nonzero(_range(x, adjacency, vectors[k:k + QUERIES], medoid, cosine))
        rows += k
        links.append((rows, nodes))
        none = np.iinfo(np.int64).max
        apart = _shared(cells[0][rows], cells[1][nodes]) == none
        met = np.minimum(_shared(visits[0][rows], cells[1][nodes]), _shared(cells[0][rows], visits[1][nodes]))
        rows, nodes = rows[apart & (met == cell)], nodes[apart & (met == cell)]
        np.add.at(weights[0], rows, counts[1][nodes])
        np.add.at(weights[1], nodes, counts[0][rows])
    rows, nodes = (np.concatenate(side) for side in zip(*links))
    if not len(rows):
        return nobody
    everyone = np.unique(np.concatenate([names[rows], hosts[nodes]]))
    a, b = np.searchsorted(everyone, names[rows]), np.searchsorted(everyone, hosts[nodes])
    least = everyone[_roots(len(everyone), np.concatenate([a, b]), np.concatenate([b, a]))]
    weight = np.zeros(len(everyone), dtype=np.int64)
    for side, own, found in ((0, names, rows), (1, hosts, nodes)):
        used = np.unique(found)
        weight[np.searchsorted(everyone, own[used])] = weights[side][used]
    return pd.DataFrame({"class": everyone, "weight": weight, "least": least})


def visit(placed: DataFrame, graph: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(class, weight, least) of what the searches find outside a class's own shards.

    A task has at most a block of a cell and some `GUESTS` guests: a cell with more of them is repeated, and
    each guest meets each member of a cell once.
    """
    # One row per centroid: a bounded table.
    rooms = F.broadcast(placed.select(F.explode("visits").alias("cell")).groupBy("cell").count()
                        .select("cell", F.ceil(F.col("count") / GUESTS).cast("bigint").alias("rooms")).join(_blocks(placed), "cell"))
    zero = F.lit(0).cast("bigint")
    every = lambda column: F.explode(F.sequence(zero, F.col(column) - 1))
    columns = ["cell", "block", "room", "class", "n", "unit", "cells", "visits"]
    guests = (placed.withColumn("cell", F.explode("visits")).join(rooms, "cell")
              .withColumn("room", _part("rooms")).withColumn("block", every("blocks")))
    members = (placed.withColumn("cell", F.explode("cells")).join(rooms, "cell")
               .withColumn("block", _part("blocks")).withColumn("room", every("rooms")))
    met = (guests.select(*columns, F.lit(None).cast("array<bigint>").alias("neighbours"))
           .unionByName(members.join(graph, "class").select(*columns, "neighbours")))

    def find(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        guest = frame["neighbours"].isna()
        return visiting_links(frame[guest], frame[~guest], int(key[0]), cosine)

    return met.groupBy("cell", "block", "room").applyInPandas(find, "class bigint, weight bigint, least bigint")


def near_duplicates(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", cosine: float = COSINE,
                    visits: int = VISITS, max_centroids: int = MAX_CENTROIDS) -> DataFrame:
    """(id, n_links, component_id, kept) per row of `df`.

    n_links counts the other rows with a cosine of at least `cosine`, component_id is the smallest id
    reachable by links. A vector that is null, empty or zero, or holds a null or non-finite
    component, links with nothing and is its own component. Vectors of different lengths don't link.
    Rows that repeat a vector are linked rows. A null id counts, but names a component only (as
    null) if it has no other. An empty table gives an empty table.

    The search is approximate: more `visits` (shards searched besides a vector's own) find more of the links, and
    more than some 1,000 * `max_centroids` distinct vectors want more centroids.
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be above 0 and at most 1")
    classes = written(classes_of(df, id_column, vector_column), "vectors")
    placed = written(place(classes, centroids(classes, max_centroids), cosine, visits), "cells")
    sharded = written(shards(placed), "shards")
    graph = written(united_graph(sharded), "graph")
    found = written(search(sharded, graph, cosine).unionByName(visit(placed, graph, cosine)), "found")
    counts = found.groupBy("class").agg(F.sum("weight").alias("others"))
    labels = components(found.select(F.col("least").alias("a"), F.col("class").alias("b"))).withColumnRenamed("node", "class")
    named = classes.join(labels, "class", "left").join(counts, "class", "left").select(
        "embedding", "first_id", F.coalesce("component", "class").alias("component"),
        (F.col("n") - 1 + F.col("others")).alias("n_links"))
    named = written(named, "named")
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    answer = named.join(least, "component").select(F.col("embedding").alias("_vector"), "n_links", "component_id")
    rows = df.select(F.col(id_column).alias("id"), F.col(vector_column).alias("_own"))
    joined = rows.join(answer, F.col("_own") == F.col("_vector"), "left")
    component = F.when(F.col("_vector").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select("id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def audit_recall(df: DataFrame, result: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
                 cosine: float = COSINE, divisor: int = 20, block: int = 20_000) -> tuple[int, int]:
    """(links by brute force, links found) of the rows whose id is divisible by `divisor`.

    Queries are broadcast in blocks of at most `block` distinct rows; all rows stream past them.
    """
    classes = written(classes_of(df, id_column, vector_column), "audit")
    asked = written(df.select(F.col(id_column).alias("id"), F.col(vector_column).alias("embedding"))
                    .where(F.col("id") % divisor == 0).join(classes.select("embedding", "unit"), "embedding")
                    .select("id", "unit"), "audit-queries")
    blocks = max(1, -(-asked.count() // block))
    truth = 0
    for number in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).toPandas()
        if part.empty:
            continue
        queries = {size: _unit(rows["unit"]) for size, rows in part.groupby(part["unit"].map(len))}

        def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                total = 0
                for size, rows in frame.groupby(frame["unit"].map(len)):
                    if size in queries:
                        total += int(((_unit(rows["unit"]) @ queries[size].T >= cosine).sum(axis=1) * rows["n"].to_numpy()).sum())
                yield pd.DataFrame({"links": [total]})

        truth += classes.select("unit", "n").mapInPandas(count, "links bigint").agg(F.sum("links")).first()[0] or 0
        truth -= len(part)  # each row meets itself
    found = result.where(F.col("id") % divisor == 0).agg(F.sum("n_links")).first()[0] or 0
    return truth, found
