"""Ranks, tiles and running sums over a whole table of entities (products, stores).

There is one way for every size. The rows are dealt out by ranges of the order, numbered and counted
inside their range, and stored with that. The ranges, of which there are no more than shuffle
partitions, are then summed up, which says what comes before each range and whether its first or last
value goes on in the range beside it. Row number, rank, ties, tile and the like of one order all follow
from the same deal, so rows that share a value are spread over several tasks and still rank alike.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.store import written

BEFORE = (Window.unboundedPreceding, -1)


def running_before(df: DataFrame, order: list[Column], weights: dict[str, Column]) -> DataFrame:
    """Add, per weight, its sum over all rows that come earlier. `order` ascends and is unique per row."""
    keys = {f"_k{i}": column for i, column in enumerate(order)}
    keyed = df.withColumns(keys).withColumns({f"_w_{n}": w for n, w in weights.items()})
    dealt = written(keyed.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "order")
    # One row per range, so at most as many as shuffle partitions.
    totals = dealt.groupBy("_range").agg(*[F.sum(f"_w_{n}").alias(f"_t_{n}") for n in weights])
    earlier = Window.orderBy("_range").rowsBetween(*BEFORE)
    offsets = totals.select("_range", *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in weights])
    inside = Window.partitionBy("_range").orderBy(*keys).rowsBetween(*BEFORE)
    return dealt.join(F.broadcast(offsets), "_range").select(*df.columns, *[
        (F.col(f"_o_{n}") + F.coalesce(F.sum(f"_w_{n}").over(inside), F.lit(0))).alias(n) for n in weights])


@dataclass
class Place:
    """Where a row stands, as columns; places are counted from 1.

    `row` is its own place, `start` and `end` those of the first and last row that tie with it, `group` that of
    its group's first row, and `rows` the number of all rows.
    """

    row: Column
    start: Column
    end: Column
    group: Column
    rows: Column

    def rank(self) -> Column:
        """RANK within the group."""
        return self.start - self.group + 1

    def ties(self) -> Column:
        return self.end - self.start + 1

    def below(self) -> Column:
        """Rows that come later than all that tie."""
        return self.rows - self.end

    def tile(self, tiles: int) -> Column:
        """NTILE: the first tiles take the rows that are left over."""
        small, extra, place = F.floor(self.rows / tiles), self.rows % tiles, self.row - 1
        edge = extra * (small + 1)
        later = F.floor((place - edge) / F.greatest(small, F.lit(1))) + extra + 1
        return F.when(place < edge, F.floor(place / (small + 1)) + 1).otherwise(later).cast("bigint")


@dataclass
class Order:
    """An ascending order of rows: groups, then a value that may tie, then keys that make it unique.

    NULL values come last. Without keys, rows that tie come in the order of a hash. `added` says which columns
    to make from a row's place.
    """

    value: Column
    added: dict[str, Callable[[Place], Column]]
    keys: list[Column] = field(default_factory=list)
    within: list[str] = field(default_factory=list)


def _deal(df: DataFrame, order: Order) -> DataFrame:
    """`df` by ranges of the order, with its place in the range, and where its ties and its group start there."""
    columns = {f"_deal_g{j}": F.col(c) for j, c in enumerate(order.within)}
    groups = list(columns)
    columns |= {"_deal_blank": order.value.isNull(), "_deal_level": order.value}
    ties = list(columns)
    columns |= {f"_deal_u{j}": c for j, c in enumerate(order.keys or [F.xxhash64(*df.columns)])}
    whole = Window.partitionBy("_deal_range")
    dealt = df.withColumns(columns).repartitionByRange(*columns).withColumn("_deal_range", F.spark_partition_id())
    return written(dealt.select(
        *df.columns, "_deal_range", F.struct(*ties).alias("_deal_tie"), F.struct(F.lit(0).alias("_all"), *groups).alias("_deal_group"),
        F.row_number().over(whole.orderBy(*columns)).alias("_deal_row"),
        F.rank().over(whole.orderBy(*ties)).alias("_deal_tie_at"),
        F.count(F.lit(1)).over(Window.partitionBy("_deal_range", *ties)).alias("_deal_tied"),
        (F.rank().over(whole.orderBy(*groups)) if groups else F.lit(1)).alias("_deal_group_at")), "dealt")


def _ranges(dealt: DataFrame) -> DataFrame:
    """Per range: rows before it and in all, and the places where its first value and group start and its last value ends."""
    along, upto = Window.orderBy("_deal_range"), Window.orderBy("_deal_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = Window.orderBy("_deal_range").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    summed = dealt.groupBy("_deal_range").agg(
        F.count(F.lit(1)).alias("_deal_n"), F.max(F.when(F.col("_deal_tie_at") == 1, F.col("_deal_tied"))).alias("_deal_first_ties"),
        *[f(f"_deal_{p}").alias(f"_deal_{name}_{p}") for p in ("tie", "group") for name, f in (("first", F.min), ("last", F.max))],
        *[F.max(f"_deal_{p}_at").alias(f"_deal_last_{p}_at") for p in ("tie", "group")])
    known = summed.withColumns({
        "_deal_before": F.coalesce(F.sum("_deal_n").over(along.rowsBetween(*BEFORE)), F.lit(0)), "_deal_rows": F.sum("_deal_n").over(Window.partitionBy())})
    for p in ("tie", "group"):
        # Does the first value go on from the range before? If all the range is that value, its start is further back.
        known = known.withColumn("_deal_goes_on", F.col(f"_deal_first_{p}").eqNullSafe(F.lag(f"_deal_last_{p}").over(along)))
        own = F.when((F.col(f"_deal_last_{p}_at") > 1) | ~F.col("_deal_goes_on"), F.col("_deal_before") + F.col(f"_deal_last_{p}_at"))
        known = known.withColumn("_deal_own", own).withColumn("_deal_last_start", F.last("_deal_own", ignorenulls=True).over(upto))
        known = known.withColumn(f"_deal_{p}_start", F.when(F.col("_deal_goes_on"), F.lag("_deal_last_start").over(along)).otherwise(F.col("_deal_before") + 1))
    known = known.withColumn("_deal_goes_on", F.col("_deal_last_tie").eqNullSafe(F.lead("_deal_first_tie").over(along)))
    own = F.when((F.col("_deal_first_ties") < F.col("_deal_n")) | ~F.col("_deal_goes_on"), F.col("_deal_before") + F.col("_deal_first_ties"))
    known = known.withColumn("_deal_own", own).withColumn("_deal_first_end", F.first("_deal_own", ignorenulls=True).over(onward))
    ended = F.when(F.col("_deal_goes_on"), F.lead("_deal_first_end").over(along)).otherwise(F.col("_deal_before") + F.col("_deal_n"))
    return known.select("_deal_range", "_deal_n", "_deal_before", "_deal_rows", "_deal_tie_start", "_deal_group_start", ended.alias("_deal_tie_end"))


def with_places(df: DataFrame, *orders: Order) -> DataFrame:
    """Add the columns of all orders; the table is dealt out once per order.

    The deals are made at once, the rest when the result is read.
    """
    out = df
    for order in orders:
        columns = out.columns
        dealt = _deal(out, order)
        # One row per range.
        placed = dealt.join(F.broadcast(_ranges(dealt)), "_deal_range")
        tie_at, tied, before = F.col("_deal_tie_at"), F.col("_deal_tied"), F.col("_deal_before")
        place = Place(
            before + F.col("_deal_row"),
            F.when(tie_at == 1, F.col("_deal_tie_start")).otherwise(before + tie_at),
            F.when(tie_at + tied - 1 == F.col("_deal_n"), F.col("_deal_tie_end")).otherwise(before + tie_at + tied - 1),
            F.when(F.col("_deal_group_at") == 1, F.col("_deal_group_start")).otherwise(before + F.col("_deal_group_at")), F.col("_deal_rows"))
        out = placed.select(*columns, *[make(place).alias(name) for name, make in order.added.items()])
    return out


def with_row_number(df: DataFrame, order: list[Column], alias: str) -> DataFrame:
    """Global ROW_NUMBER for a unique ascending order."""
    return with_places(df, Order(order[0], {alias: lambda p: p.row}, order[1:]))


def with_tile(df: DataFrame, order: list[Column], tiles: int, alias: str) -> DataFrame:
    """Global NTILE for a unique ascending order."""
    return with_places(df, Order(order[0], {alias: lambda p: p.tile(tiles)}, order[1:]))


def with_rank(df: DataFrame, value: Column, alias: str, within: list[str] = (), ties: str | None = None) -> DataFrame:
    """RANK by an ascending value, NULLs last, over the table or within some columns; `ties` also adds the rows that share the value."""
    added = {alias: Place.rank} | ({ties: Place.ties} if ties else {})
    return with_places(df, Order(value, added, within=list(within)))
