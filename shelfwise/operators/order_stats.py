"""Exact order statistics of a whole table without sorting or moving its rows.

A window without a partition would pull every row into one task. Here a sketch guides the search:

1. One pass builds a quantile sketch of the sort keys, read as one growing number, and counts the
   rows. Every wanted rank gets a bracket of two numbers that should enclose its row.
2. One more pass counts the rows between the brackets and, inside them, the rows per distinct key.
   That is a map-side combined count; equal rows collapse, and only a few rows in ten thousand per
   wanted rank lie inside a bracket. The counts are stored.

From these counts each rank is settled exactly. The counts also prove that a rank lies inside its
bracket; if the sketch was off, the second pass is taken again with wider brackets. So the number of
passes doesn't depend on the number of ranks. A bracket is cut into slices by the same sketch, and a
slice is what one task sorts. Only the located values, one per rank, reach the driver.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..sources.store import written

#: The wanted rank, from 1, of a table with the given number of rows.
Ranks = dict[str, Callable[[int], int]]

FIRST = Window.unboundedPreceding
NOW = Window.currentRow

# Parameter of the sketch: some 1 MB per task, ranks within a few of ten thousand rows.
SKETCH_SIZE = 65_535
# A bracket reaches this far, in shares of the rows, to both sides; three times the sketch's usual error.
REACH = 3 * 2.296 / SKETCH_SIZE ** 0.9021
WIDER = 8
SLICES = 16


@dataclass
class Found:
    """Where a wanted rank lies: its values per key, its place among equal rows and the rows of the table."""

    n: int
    rank_in_ties: int
    values: dict


def literal(value, kind: T.DataType) -> str:
    """SQL literal of a located value. One parsed text per condition builds far faster than many columns."""
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"CAST('{text}' AS {kind.simpleString()})"


def guide(schema: T.StructType, keys: list[str]) -> Column:
    """A double that never falls when the keys grow, in their order; further keys than two don't add to it.

    A step of the first key outweighs every value that the second's declared type has.
    """
    first = F.col(keys[0]).cast("double")
    if len(keys) == 1:
        return first
    step, span = schema[keys[0]].dataType, schema[keys[1]].dataType
    return first * (4.0 * 10.0 ** (span.precision - span.scale + step.scale)) + F.col(keys[1]).cast("double")


@dataclass
class Bracket:
    low: float
    high: float
    cuts: list[float]


def _brackets(quantile: Callable[[list[float]], list[float]], wanted: list[int], n: int, reach: float) -> list[Bracket]:
    """Disjoint brackets in order that should enclose the wanted ranks."""
    ends = []
    for rank in sorted(set(wanted)):
        low, high = (rank - 1) / n - reach, rank / n + reach
        if ends and low <= ends[-1][1]:
            ends[-1][1] = high
        else:
            ends.append([low, high])
    shares = [low + (high - low) * k / SLICES for low, high in ends for k in range(SLICES + 1)]
    values = quantile([min(max(share, 0.0), 1.0) for share in shares])
    out = []
    for i, (low, high) in enumerate(ends):
        own = values[i * (SLICES + 1):(i + 1) * (SLICES + 1)]
        own[0] = float("-inf") if low <= 0 else own[0]
        own[-1] = float("inf") if high >= 1 else own[-1]
        if out and own[0] <= out[-1].high:  # many equal rows: both brackets end at their value
            out[-1].cuts += own[:-1]
            out[-1].high = max(out[-1].high, own[-1])
        else:
            out.append(Bracket(own[0], own[-1], own[1:-1]))
    return out


def _number(value: float) -> str:
    return f"CAST('{value}' AS DOUBLE)"


def _counted(keyed: DataFrame, keys: list[str], brackets: list[Bracket]) -> DataFrame:
    """(_segment, _slice, keys..., _rows): an odd segment is a bracket and has its keys; an even one is what lies between."""
    segment = " + ".join(f"CAST(_guide >= {_number(b.low)} AS INT) + CAST(_guide > {_number(b.high)} AS INT)" for b in brackets)
    slices = " ".join(
        f"WHEN {2 * i + 1} THEN size(filter(array({', '.join(map(_number, sorted(set(b.cuts)))) or _number(b.high)}), c -> _guide > c))"
        for i, b in enumerate(brackets))
    placed = keyed.withColumn("_segment", F.expr(segment)).withColumn("_slice", F.expr(f"CASE _segment {slices} ELSE 0 END"))
    inside = [F.when(F.col("_segment") % 2 == 1, F.col(c)).alias(c) for c in keys]
    return written(placed.select("_segment", "_slice", *inside).groupBy("_segment", "_slice", *keys).agg(F.count(F.lit(1)).alias("_rows")), "counted")


def rows_at_ranks(df: DataFrame, keys: list[str], ranks: Ranks) -> dict[str, Found]:
    """The keys' values at the given ranks of `df` sorted by `keys`, decimals without NULLs.

    An empty table finds nothing.
    """
    keyed = df.select(*keys, guide(df.schema, keys).alias("_guide"))
    sketch = F.kll_sketch_agg_double("_guide", F.lit(SKETCH_SIZE))
    summed = written(keyed.agg(F.count(F.lit(1)).alias("n"), sketch.alias("sketch")), "sketch")
    n = summed.first()["n"]
    if not n:
        return {}

    def quantile(shares: list[float]) -> list[float]:
        return summed.select(F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, shares))).alias("v")).first()["v"]

    wanted, reach = {label: rank(n) for label, rank in ranks.items()}, max(REACH, 2 / n)
    while True:
        counted = _counted(keyed, keys, _brackets(quantile, list(wanted.values()), n, reach))
        # A row per slice.
        parts = sorted(counted.groupBy("_segment", "_slice").agg(F.sum("_rows").alias("_rows")).collect())
        upto, total = [], 0
        for part in parts:
            total += part["_rows"]
            upto.append(total)
        at = {label: bisect_left(upto, rank) for label, rank in wanted.items()}
        if all(parts[i]["_segment"] % 2 for i in at.values()):
            break
        reach *= WIDER
    asked: dict[tuple, list] = {}
    for label, i in at.items():
        asked.setdefault((parts[i]["_segment"], parts[i]["_slice"]), []).append((label, wanted[label] - upto[i] + parts[i]["_rows"]))
    inside = " OR ".join(f"(_segment = {s} AND _slice = {k})" for s, k in asked)
    upto_here = F.sum("_rows").over(Window.partitionBy("_segment", "_slice").orderBy(*keys).rowsBetween(FIRST, NOW))
    hits = " OR ".join(
        f"(_segment = {s} AND _slice = {k} AND _upto >= {rank}L AND _upto - _rows < {rank}L)" for (s, k), own in asked.items() for _, rank in own)
    rows = counted.where(inside).withColumn("_upto", upto_here).where(hits).collect()
    found = {}
    for row in rows:
        for label, rank in asked[row["_segment"], row["_slice"]]:
            if row["_upto"] - row["_rows"] < rank <= row["_upto"]:
                found[label] = Found(n, rank - row["_upto"] + row["_rows"], {c: row[c] for c in keys})
    return {label: found[label] for label in ranks}


def values_at_ranks(df: DataFrame, column: str, ranks: Ranks) -> DataFrame:
    """One row with one column per label, and the row count as `n`."""
    present = df.where(F.col(column).isNotNull())
    kind = df.schema[column].dataType
    found = rows_at_ranks(present, [column], ranks)
    n = next(iter(found.values())).n if found else 0
    values = {label: found[label].values[column] if label in found else None for label in ranks}
    return df.sparkSession.range(1).select(
        *[F.lit(v).cast(kind).alias(label) for label, v in values.items()], F.lit(n).cast("bigint").alias("n"))


def rank_below(percent: int) -> Callable[[int], int]:
    """Rank of the largest value whose PERCENT_RANK is at most percent/100."""
    return lambda n: (n - 1) * percent // 100 + 1


def rank_above(percent: int) -> Callable[[int], int]:
    return lambda n: -(-(n - 1) * percent // 100) + 1


def quantiles_by_rank(df: DataFrame, column: str, percents: dict[str, int]) -> DataFrame:
    """MAX(x) WHERE PERCENT_RANK(x) <= p, for several p: an actual value, never interpolated."""
    return values_at_ranks(df, column, {label: rank_below(p) for label, p in percents.items()})


def quantiles_interpolated(df: DataFrame, column: str, percents: dict[str, int]) -> DataFrame:
    """Linearly interpolated quantiles, exact in decimals."""
    ranks = {f"{label}_{end}": rank(p) for label, p in percents.items() for end, rank in (("low", rank_below), ("high", rank_above))}
    found = values_at_ranks(df, column, ranks)

    def between(label: str, p: int) -> Column:
        low, high = F.col(f"{label}_low"), F.col(f"{label}_high")
        part = (((F.col("n") - 1) * p) % 100).cast("decimal(4,0)") / F.lit(100)
        return (low + (high - low) * part).alias(label)

    return found.select(*[between(label, p) for label, p in percents.items()], "n")


def tile_end(tile: Column, n: Column, tiles: Column) -> Column:
    """Last rank of a tile when n rows are dealt into equal tiles, the first ones taking the rest."""
    return tile * F.floor(n / tiles) + F.least(tile, n % tiles)


def tile_summary(df: DataFrame, keys: list[str], tilings: list[int], sums: list[str], bounds: list[str] = ()) -> DataFrame:
    """NTILE(t) over the rows sorted by `keys`, summed up per tile, for each t of `tilings`.

    `keys` contain every summed column, so rows that tie on all of them are interchangeable and a tie
    across a tile edge is split by count. The edges of all tilings are located together and the rows are
    summed once. Returns `tiles`, `tile`, `records`, `sum_<c>` and, for `bounds`, `min_<c>` and `max_<c>`.
    """
    cuts = {f"{tiles}_{t}": (lambda n, t=t, tiles=tiles: max(t * (n // tiles) + min(t, n % tiles), 1)) for tiles in tilings for t in range(1, tiles)}
    kinds = {c: df.schema[c].dataType for c in keys}
    edges = sorted({
        "named_struct(" + ", ".join(f"'{c}', {literal(found.values[c], kinds[c])}" for c in keys) + ")"
        for found in rows_at_ranks(df, keys, cuts).values()})
    below = " + ".join(["0", *[f"CAST(_key > {edge} AS INT)" for edge in edges]])
    on_edge = " OR ".join(["false", *[f"_key = {edge}" for edge in edges]])

    # Rows strictly between two edges share a tile; rows equal to an edge are split below.
    parts = (
        df.select(*keys, *[c for c in sums if c not in keys], F.struct(*keys).alias("_key"))
        .withColumns({"_below": F.expr(below), "_on_edge": F.expr(on_edge)})
        .groupBy("_below", "_on_edge")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.sum(F.col(c).cast("decimal(18,6)")).alias(f"_sum_{c}") for c in sums],
            *[F.min(c).alias(f"_min_{c}") for c in {*sums, *bounds}],
            *[F.max(c).alias(f"_max_{c}") for c in bounds],
        )
    )
    order = Window.orderBy("_below", "_on_edge")
    n, end, tile, tiles = (F.col(c) for c in ("_n", "_end", "tile", "tiles"))
    dealt = (
        parts.withColumn("_end", F.sum("_rows").over(order.rowsBetween(FIRST, NOW)))
        .withColumn("_n", F.sum("_rows").over(Window.partitionBy()))
        .withColumn("tiles", F.explode(F.array(*map(F.lit, tilings))))
        .withColumn("tile", F.explode(F.sequence(F.lit(1), F.col("tiles"))))
    )
    start = F.greatest(end - F.col("_rows"), tile_end(tile.cast("bigint") - 1, n, tiles))
    stop = F.least(end, tile_end(tile.cast("bigint"), n, tiles))

    def share(c: str) -> Column:
        value = F.col("_take").cast("decimal(18,0)") * F.col(f"_min_{c}").cast("decimal(18,6)")
        return F.sum(F.when(F.col("_on_edge"), value.cast("decimal(28,6)")).otherwise(F.col(f"_sum_{c}")))

    return (
        dealt.withColumn("_take", stop - start)
        .where(F.col("_take") > 0)
        .groupBy("tiles", "tile")
        .agg(
            F.sum("_take").alias("records"),
            *[share(c).alias(f"sum_{c}") for c in sums],
            *[F.min(f"_min_{c}").alias(f"min_{c}") for c in bounds],
            *[F.max(f"_max_{c}").alias(f"max_{c}") for c in bounds],
        )
    )


# Order of the rows inside a visibility tile: ties on all three columns are interchangeable.
VISIBILITY_KEYS = ["item_visibility", "sales", "rating"]


def visibility_tiles(fact: DataFrame, tilings: list[int]) -> DataFrame:
    """Tiles by shelf visibility."""
    return tile_summary(fact, VISIBILITY_KEYS, tilings, ["sales", "rating", "item_visibility"], ["item_visibility"])
