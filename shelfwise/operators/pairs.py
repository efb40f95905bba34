"""Comparisons between stores that stock the same product, without building all pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

ITEM, OUTLET, SALES = "item_identifier", "outlet_identifier", "sales"
ROW_COLUMNS = [ITEM, "item_type", OUTLET, "outlet_type", SALES, "item_visibility"]
TIES = [OUTLET, "item_visibility", "item_type"]


def _first_rows(df: DataFrame, within: list[str], order: list, n: int) -> DataFrame:
    """First n rows per group; Spark cuts each group before the shuffle as well."""
    window = Window.partitionBy(*within).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= n).drop("_rn")


def widest_pairs(fact: DataFrame, stocks: DataFrame | None = None, n: int = 15, factor: int = 3) -> DataFrame:
    """The n pairs (strong row, weak row) of one item in two stores with the largest gap in
    sales, where strong > factor * weak. Columns carry the prefixes `a_` and `b_`.

    The full self-join grows with the square of an item's rows. Three facts avoid it:
    * An item's largest gap is reached by its two best and two weakest stores, so two rows
      per side settle it, and the n items with the largest gap hold all n answers.
    * For a given partner, lower-ranked rows of the same store lose to n better rows of it,
      so n rows per item and store are enough.
    * A partner rules out one store, thus at most n of those, so the 2n best (weakest) rows
      per item are enough.
    The result is the exact top n of all pairs. Sums per item and store settle the items, from the
    product x outlet roll-up `stocks` if there is one; the rows are read again for these few only.
    """
    sums = fact.select(ITEM, OUTLET, F.col(SALES).alias("high"), F.col(SALES).alias("low")) if stocks is None else stocks
    stores = sums.groupBy(ITEM, OUTLET).agg(F.max("high").alias("high"), F.min("low").alias("low"))
    # Both orders follow from one shuffle by item; a store may be among the best and the weakest.
    item = Window.partitionBy(ITEM)
    placed = stores.select(
        ITEM, OUTLET, "high", "low", F.row_number().over(item.orderBy(F.desc("high"), OUTLET)).alias("_best"),
        F.row_number().over(item.orderBy("low", OUTLET)).alias("_weakest"))
    ends = placed.groupBy(ITEM).agg(*[
        F.max(F.when(F.col(place) == k, F.struct(F.col(OUTLET).alias("store"), F.col(value).alias("sales")))).alias(f"{place}{k}")
        for place, value in (("_best", "high"), ("_weakest", "low")) for k in (1, 2)])
    pairs = [(F.col(f"_best{i}"), F.col(f"_weakest{j}")) for i in (1, 2) for j in (1, 2)]
    wide = [
        F.when((a["store"] != b["store"]) & (a["sales"] > b["sales"] * factor), a["sales"] - b["sales"]) for a, b in pairs]
    gaps = ends.select(ITEM, F.greatest(*wide).alias("gap")).where(F.col("gap").isNotNull() & F.col(ITEM).isNotNull())
    # n items at most reach the driver.
    chosen = [r[ITEM] for r in gaps.orderBy(F.desc("gap"), ITEM).limit(n).collect()]
    rows = fact.select(ROW_COLUMNS).where(F.col(ITEM).isin(chosen))
    sides = {}
    for prefix, order in (("a_", [F.desc(SALES), *TIES]), ("b_", [F.asc(SALES), *TIES])):
        per_store = _first_rows(rows, [ITEM, OUTLET], order, n)
        kept = _first_rows(per_store, [ITEM], order, 2 * n)
        sides[prefix] = kept.select([F.col(c).alias(prefix + c) for c in ROW_COLUMNS])
    return (
        sides["a_"].join(sides["b_"], F.col(f"a_{ITEM}") == F.col(f"b_{ITEM}"))
        .where((F.col(f"a_{OUTLET}") != F.col(f"b_{OUTLET}")) & (F.col(f"a_{SALES}") > F.col(f"b_{SALES}") * factor))
        .withColumn("gap", F.col(f"a_{SALES}") - F.col(f"b_{SALES}"))
        .orderBy(F.desc("gap"), f"a_{ITEM}", *[f"a_{c}" for c in TIES], *[f"b_{c}" for c in TIES])
        .limit(n)
    )


def distribution_gaps(stocks: DataFrame, leaders: DataFrame, n: int = 25) -> DataFrame:
    """Stores that lack a leading product, best product first.

    `leaders` is a short list, its length a parameter of the question: a unique `place` from 0 and
    an `item_identifier` per row. A store keeps the set of leaders it stocks, at most that list,
    and meets a leader only where the set lacks it. A product on several places is stocked on all.
    """
    attributes = [OUTLET, "outlet_type", "outlet_location_type"]
    items = leaders.groupBy(ITEM).agg(F.collect_set("place").alias("places"))
    pairs = stocks.select(*attributes, ITEM).distinct()
    marked = pairs.join(F.broadcast(items), ITEM, "left")
    stocked = marked.groupBy(*attributes).agg(F.array_distinct(F.flatten(F.collect_set("places"))).alias("places"))
    # The set of a store covers all its rows, also where its attributes disagree between rows.
    stores = Window.partitionBy(OUTLET)
    known = stocked.withColumn("places", F.flatten(F.collect_set("places").over(stores)))
    every = leaders.agg(F.collect_set("place").alias("all")).scalar()
    lacking = known.withColumn("place", F.explode(F.array_except(every, "places"))).drop("places")
    return (
        lacking.join(F.broadcast(leaders), "place")
        .orderBy("place", *attributes)
        .limit(n)
    )
