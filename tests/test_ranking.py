"""Distributed ranks against the plain definitions."""

from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from shelfwise.operators import order_stats
from shelfwise.operators.order_stats import quantiles_by_rank, quantiles_interpolated, rows_at_ranks, tile_summary
from shelfwise.operators.ranking import Order, Place, running_before, with_places, with_rank, with_row_number, with_tile


def entities(spark, n=500):
    """Unique ids; a third of them share one value, some have none."""
    return spark.range(n).select(
        F.col("id").cast("string").alias("key"), (F.col("id") % 3).cast("string").alias("part"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.col("id") * 37 % 101).cast("decimal(10,4)").alias("value"))


def test_row_number_and_running_sum(spark):
    df = entities(spark).fillna(0, ["value"])
    order = [-F.col("value"), F.col("key")]
    plain = Window.orderBy(*order)
    want = df.select("key", F.row_number().over(plain).alias("n"), F.coalesce(
        F.sum("value").over(plain.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("s"))
    got = with_row_number(df, order, "n").join(running_before(df, order, {"s": F.col("value")}), "key")
    assert sorted(want.collect()) == sorted(got.select("key", "n", "s").collect())


@pytest.mark.parametrize("within", [[], ["part"]])
def test_rank_with_ties_and_nulls(spark, within):
    df = entities(spark)
    value = -F.col("value")
    plain = Window.partitionBy(*within).orderBy(value.asc_nulls_last())
    equal = Window.partitionBy(*within, value)
    want = df.select("key", F.rank().over(plain).alias("r"), F.count(F.lit(1)).over(equal).alias("t"))
    got = with_rank(df, value, "r", within, ties="t").select("key", "r", "t")
    assert sorted(want.collect()) == sorted(got.collect())


@pytest.mark.parametrize("tiles", [1, 4, 7, 600])
def test_tiles(spark, tiles):
    df = entities(spark)
    order = [F.col("part"), F.col("key")]
    want = df.select("key", F.ntile(tiles).over(Window.orderBy(*order)).alias("t"))
    got = with_tile(df, order, tiles, "t").select("key", "t")
    assert sorted(want.collect()) == sorted(got.collect())


def amounts(spark, values):
    return spark.createDataFrame([(Decimal(str(v)),) for v in values], "sales decimal(10,4)")


def test_quantile_definitions_differ(spark):
    df = amounts(spark, [10, 20, 30, 40])
    assert quantiles_by_rank(df, "sales", {"m": 50}).first()["m"] == 20
    assert quantiles_interpolated(df, "sales", {"m": 50}).first()["m"] == 25


@pytest.mark.parametrize("values", [[5], [5, 5, 5, 5], list(range(1, 98)), [3] * 40 + list(range(60)), []])
def test_quantiles_against_definition(spark, values):
    df = amounts(spark, values)
    percents = {"a": 25, "b": 50, "c": 90}
    got = quantiles_by_rank(df, "sales", percents).first()
    ranked = df.withColumn("pr", F.percent_rank().over(Window.orderBy("sales")))
    for name, p in percents.items():
        assert got[name] == ranked.where(F.col("pr") <= p / 100).agg(F.max("sales")).first()[0]
    exact = quantiles_interpolated(df, "sales", percents).first()
    for name, p in percents.items():
        want = df.agg(F.percentile("sales", p / 100)).first()[0]
        assert (exact[name] is None and want is None) or abs(float(exact[name]) - want) < 1e-9


@pytest.mark.parametrize("n,tiles", [(3, 5), (101, 5), (101, 10), (1000, 10), (0, 5)])
def test_tile_summary_splits_ties(spark, n, tiles):
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("0.05")).otherwise((F.col("id") % 11) / 100).cast("decimal(9,6)").alias("v"),
        (F.col("id") * 7919 % 13 + 0.25).cast("decimal(10,4)").alias("sales"))
    got = tile_summary(df, ["v", "sales"], [tiles], ["sales", "v"], ["v"]).drop("tiles")
    tiled = df.withColumn("tile", F.ntile(tiles).over(Window.orderBy("v", "sales")))
    want = tiled.groupBy("tile").agg(
        F.count(F.lit(1)), F.sum("sales"), F.sum("v"), F.min("v"), F.max("v"))
    assert [tuple(r) for r in got.orderBy("tile").collect()] == [tuple(r) for r in want.orderBy("tile").collect()]


def test_ranks_inside_ties(spark):
    found = rows_at_ranks(amounts(spark, [1, 2, 2, 2, 3]), ["sales"], {"x": lambda n: 3, "y": lambda n: n})
    assert (found["x"].values["sales"], found["x"].rank_in_ties, found["x"].n) == (2, 2, 5)
    assert found["y"].values["sales"] == 3


def keyed(spark, n=20_000):
    """Three sort keys; a third of the rows share the first, some share all."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("0.05")).otherwise((F.col("id") * 7919 % 997) / 1000).cast("decimal(9,6)").alias("v"),
        ((F.col("id") * 104729 % 1009 - 300) / 7).cast("decimal(10,4)").alias("sales"), (F.col("id") % 4).cast("decimal(3,2)").alias("r"))


@pytest.mark.parametrize("size, reach", [(8, 1e-6), (8, 0.2), (65_535, order_stats.REACH)])
def test_ranks_of_any_place_whatever_the_sketch(spark, monkeypatch, size, reach):
    """A coarse sketch with brackets too narrow is found out and widened; the answer stays exact."""
    monkeypatch.setattr(order_stats, "SKETCH_SIZE", size)
    monkeypatch.setattr(order_stats, "REACH", reach)
    df = keyed(spark).cache()
    want = sorted((r["v"], r["sales"], r["r"]) for r in df.collect())
    places = [1, 2, 333, 5_000, 6_000, 6_001, 9_999, 12_345, 19_999, 20_000]
    found = rows_at_ranks(df, ["v", "sales", "r"], {str(k): (lambda n, k=k: k) for k in places})
    assert list(found) == [str(k) for k in places]
    for k in places:
        own = found[str(k)]
        assert tuple(own.values.values()) == want[k - 1] and own.n == 20_000
        assert own.rank_in_ties == sum(x == want[k - 1] for x in want[:k])
    df.unpersist()


def test_two_reads_whatever_the_number_of_ranks(spark, monkeypatch):
    made = []
    counted = order_stats._counted
    monkeypatch.setattr(order_stats, "_counted", lambda *a: made.append(1) or counted(*a))
    got = quantiles_by_rank(keyed(spark, 5_000), "sales", {f"p{p}": p for p in range(1, 100)})
    assert len(made) == 1
    assert "RDD" not in got._jdf.queryExecution().optimizedPlan().toString()
    ranked = sorted(r["sales"] for r in keyed(spark, 5_000).collect())
    assert [got.first()[f"p{p}"] for p in (1, 50, 99)] == [ranked[4_999 * p // 100] for p in (1, 50, 99)]


def test_the_guide_never_falls(spark):
    df = keyed(spark).withColumn("g", order_stats.guide(keyed(spark).schema, ["v", "sales", "r"]))
    rows = sorted((r["v"], r["sales"], r["g"]) for r in df.distinct().collect())
    assert all(a[2] <= b[2] for a, b in zip(rows, rows[1:]))


def test_tilings_together_equal_each_alone(spark):
    df = keyed(spark, 1_003)
    both = tile_summary(df, ["v", "sales"], [5, 10], ["sales", "v"], ["v"]).collect()
    for tiles in (5, 10):
        alone = tile_summary(df, ["v", "sales"], [tiles], ["sales", "v"], ["v"]).collect()
        assert sorted(r for r in both if r["tiles"] == tiles) == sorted(alone) and len(alone) == tiles


def test_orders_deal_their_input_once_each(spark, tmp_path):
    path = str(tmp_path / "entities")
    entities(spark, 50).write.parquet(path)
    got = with_places(spark.read.parquet(path), Order(F.col("value"), {"a": Place.rank}), Order(-F.col("value"), {"b": Place.rank, "t": Place.ties}))
    # The result reads the last deal only, once for its rows and once for its ranges.
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2
    plain = Window.orderBy(F.col("value").asc_nulls_last())
    want = entities(spark, 50).select("key", F.rank().over(plain).alias("a"))
    assert sorted(want.collect()) == sorted(got.select("key", "a").collect())


@pytest.mark.parametrize("partitions", ["1", "3", "17"])
@pytest.mark.parametrize("within", [[], ["part"]])
def test_all_functions_of_one_deal(spark, partitions, within):
    """Values and groups that fill many ranges, ranges that hold many values."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        df = entities(spark, 700)
        order = Order(F.col("value"), {
            "row": lambda p: p.row, "rank": Place.rank, "ties": Place.ties, "tile": lambda p: p.tile(6), "below": Place.below,
            "cume": lambda p: p.end / p.rows, "percent": lambda p: (p.start - 1) / (p.rows - 1)}, [F.col("key")], within)
        got = {r["key"]: r for r in with_places(df, order).collect()}
        assert len(got) == 700
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    level = [*within, F.col("value").asc_nulls_last()]
    all_rows, group = Window.orderBy(*level, "key"), Window.partitionBy(*within).orderBy(F.col("value").asc_nulls_last())
    want = df.select(
        "key", F.row_number().over(all_rows).alias("row"), F.rank().over(group).alias("rank"),
        F.count(F.lit(1)).over(Window.partitionBy(*within, "value")).alias("ties"), F.ntile(6).over(all_rows).alias("tile"),
        F.cume_dist().over(Window.orderBy(*level)).alias("cume"), F.percent_rank().over(Window.orderBy(*level)).alias("percent"))
    for r in want.collect():
        assert all(abs(got[r["key"]][c] - r[c]) < 1e-12 for c in want.columns if c != "key"), (r, got[r["key"]])
        assert got[r["key"]]["below"] == 700 - round(r["cume"] * 700)


def test_ranks_of_an_empty_table(spark):
    empty = Order(F.col("value"), {"a": Place.rank, "t": lambda p: p.tile(3)})
    assert with_places(entities(spark, 0), empty, Order(F.col("value"), {"b": Place.rank}, within=["part"])).count() == 0
