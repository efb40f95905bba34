"""Reports on small tables where the answer is known or can be found by brute force."""

import inspect
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from fixtures import fact, raw
from shelfwise.operators import rollups, rules
from shelfwise.operators.order_stats import visibility_tiles
from shelfwise.operators.pairs import widest_pairs
from shelfwise.operators.rollups import (
    cell_rollup as cells, product_rollup as products, rating_rollup as ratings, shelf_rollup as shelves, stock_rollup as stocks)
from shelfwise.operators.segments import apply_filters
from shelfwise.plans import advanced as A, business as B, dashboard as D, frames as P, kpis as K, profile as R


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_band_edges_differ_between_the_two_sets(spark):
    f = fact(spark, {"sales": 500, "rating": 3.5})
    assert K.sales_bands(f).first()["sales_band"] == "B. 500 - 1K"
    assert P.sales_bands(f).first()["sales_band"] == "A. Under 500"
    assert K.rating_bands(ratings(f)).first()["rating_band"] == "3.5 - 3.9  Acceptable"


@pytest.mark.parametrize("limit,below,at", [
    (500, "A. Under 500", "B. 500 - 1K"), (1000, "B. 500 - 1K", "C. 1K - 2K"), (2000, "C. 1K - 2K", "D. 2K - 3K"),
    (3000, "D. 2K - 3K", "E. 3K - 5K"), (5000, "E. 3K - 5K", "F. 5K - 8K"), (8000, "F. 5K - 8K", "G. 8K+")])
def test_sales_on_each_side_of_a_limit(spark, limit, below, at):
    """The first set gives a limit to the band above it, the second to the band below it."""
    f = fact(spark, {"sales": f"{limit - 0.0001:.4f}"}, {"sales": limit}, {"sales": f"{limit + 0.0001:.4f}"})
    compact = {r["sales_band"]: r["records"] for r in P.sales_bands(f).collect()}
    assert {r["sales_band"]: r["records"] for r in K.sales_bands(f).collect()} == {below: 1, at: 2}
    assert compact == {below.replace(" - ", "-"): 2, at.replace(" - ", "-"): 1}


@pytest.mark.parametrize("below,at,labels", [
    ("1.9", "2.0", ("1.0 - 1.9  Critical", "2.0 - 2.9  Poor")), ("2.9", "3.0", ("2.0 - 2.9  Poor", "3.0 - 3.4  Below par")),
    ("3.4", "3.5", ("3.0 - 3.4  Below par", "3.5 - 3.9  Acceptable")), ("3.9", "4.0", ("3.5 - 3.9  Acceptable", "4.0 - 4.4  Good")),
    ("4.4", "4.5", ("4.0 - 4.4  Good", "4.5 - 5.0  Excellent"))])
def test_ratings_on_each_side_of_a_limit(spark, below, at, labels):
    rolled = ratings(fact(spark, {"rating": below}, {"rating": at}))
    assert sorted(r["rating_band"] for r in K.rating_bands(rolled).collect()) == sorted(labels)
    assert sorted(r["rating_band"] for r in P.rating_distribution(rolled).collect()) == sorted(
        x.replace(" - ", "-").replace("  ", " ") for x in labels)


def test_rating_spread_from_the_roll_up(spark):
    values = ["1.0", "4.5", "3.9", "3.9", "2.2"]
    f = fact(spark, *[{"rating": v} for v in values])
    want = f.agg(F.round(F.stddev_samp("rating"), 2)).first()[0]
    assert B.category_ratings(ratings(f)).first()["rating_consistency"] == want
    assert B.category_ratings(ratings(fact(spark, {}))).first()["rating_consistency"] is None


def test_equal_revenue_ranks(spark):
    f = fact(spark, *[{"item_identifier": i, "sales": s} for i, s in (("A", 5), ("B", 5), ("C", 3), ("D", 1))])
    got = rows(B.three_ranks(products(f)))
    assert [r[2:5] for r in got] == [(1, 1, 1), (2, 1, 1), (3, 3, 2), (4, 4, 3)]
    assert [r[5] for r in got] == [1, 2, 3, 4]


def test_more_tiles_than_rows(spark):
    f = fact(spark, *[{"item_visibility": v} for v in ("0.1", "0.2", "0.3")])
    assert [r["visibility_band"] for r in B.visibility_quintiles(visibility_tiles(f, [5])).collect()] == ["1 - Lowest visibility", "2", "3 - Middle"]


def test_missing_month_shows_and_yoy_uses_the_calendar(spark):
    f = fact(spark, {"order_date": "2021-01-10"}, {"order_date": "2021-03-10"}, {"order_date": "2022-03-01", "sales": 150})
    spine = {r["year_month"]: (r["records"], r["data_check"]) for r in A.month_check(cells(f)).collect()}
    assert len(spine) == 15 and spine["2021-02"] == (0, "NO DATA - investigate")
    last = B.year_on_year(cells(f)).collect()[-1]
    assert (last["same_month_last_year"], last["yoy_pct_growth"]) == (100, 50)


def test_growth_on_zero_base_is_null(spark):
    f = fact(spark, {"order_date": "2021-01-10", "sales": 0}, {"order_date": "2021-02-10"})
    assert B.month_on_month(cells(f)).collect()[1]["mom_pct_change"] is None


def test_growth_between_the_years_asked_for(spark):
    f = fact(spark, *[{"order_date": f"{y}-05-01", "sales": s} for y, s in ((2019, 50), (2020, 100), (2021, 150))])
    assert [P.category_growth(cells(f), compared=c).first()["growth_pct"] for c in (None, (2020, 2021), (2019, 2021), (2021, 2022))] == [100, 50, 200, None]
    assert P.outlet_growth(rollups.outlet_rollup(f), compared=(2020, 2021)).first()["growth_pct"] == 50


def test_worst_category_is_the_last_one(spark):
    f = fact(spark, *[{"item_type": t, "sales": s} for t, s in (("X", 50), ("Y", 30), ("Z", 10))])
    got = A.best_and_worst_category(shelves(f)).first()
    assert (got["top_category"], got["bottom_category"], got["spread_ratio"]) == ("X", "Z", 5)
    assert got["risk_flag"].startswith("Concentration")


def test_unknown_category(spark):
    f = fact(spark, {"item_type": "Meat"}, {"item_type": "Dairy"})
    rolled = products(f), shelves(f), cells(f)
    assert list(A.category_deep_dive(*rolled, "Dairy")) == ["headline", "top_products", "stores", "trend"]
    error = A.category_deep_dive(*rolled, "Nope")["error"].first()
    assert tuple(error) == ("Category not found: Nope", "Dairy, Meat")


def test_distribution_gap(spark):
    f = fact(spark, *[{"item_identifier": i, "outlet_identifier": o} for i, o in (
        ("A", "O1"), ("A", "O2"), ("A", "O3"), ("B", "O1"), ("B", "O3"))])
    got = A.missing_products(stocks(f), products(f)).collect()
    assert [(r["proven_product"], r["missing_from_outlet"]) for r in got] == [("B", "O2")]


def test_distribution_gap_beyond_any_word_size(spark):
    """40 leaders; one store lacks the last two, the other has all."""
    stocked = [{"item_identifier": f"I{i:02d}", "sales": 1000 - i, "outlet_identifier": "FULL"} for i in range(40)]
    f = fact(spark, *stocked, *[{**r, "outlet_identifier": "GAP", "sales": 1} for r in stocked[:38]])
    got = A.missing_products(stocks(f), products(f), leaders=40).select("proven_product", "missing_from_outlet")
    assert rows(got) == [("I38", "GAP"), ("I39", "GAP")]


def test_pair_needs_three_times_the_sales(spark):
    for strong, want in ((31, 1), (30, 0)):
        f = fact(spark, {"outlet_identifier": "O1", "sales": 10}, {"outlet_identifier": "O2", "sales": strong})
        assert A.store_pairs(f, stocks(f)).count() == want


@pytest.mark.parametrize("seed", range(4))
def test_widest_pairs_equal_the_full_self_join(spark, seed):
    """A third of the rows belong to one item, and one store holds most of the extreme sales."""
    rnd = random.Random(seed)
    data = []
    for i in range(150):
        item = "HOT" if i % 3 == 0 else f"I{rnd.randrange(6)}"
        store = "O1" if rnd.random() < 0.5 else f"O{rnd.randrange(5)}"
        sales = rnd.choice([1, 2, 3, 90, 95, 99]) if store == "O1" else rnd.choice([2, 5, 30, 60, 95])
        data.append({"item_identifier": item, "outlet_identifier": store, "sales": sales, "item_visibility": rnd.choice(["0.1", "0.2"])})
    f = fact(spark, *data).cache()
    a, b = (f.select([F.col(c).alias(p + c) for c in ("item_identifier", "outlet_identifier", "sales", "item_visibility")]) for p in "ab")
    full = a.join(b, (F.col("aitem_identifier") == F.col("bitem_identifier")) & (F.col("aoutlet_identifier") != F.col("boutlet_identifier"))
                  & (F.col("asales") > F.col("bsales") * 3)).withColumn("gap", F.col("asales") - F.col("bsales"))
    want = full.orderBy(F.desc("gap"), "aitem_identifier", "aoutlet_identifier", "aitem_visibility", "boutlet_identifier", "bitem_visibility").limit(12)
    got = widest_pairs(f, stocks(f), 12)
    keys = ["aitem_identifier", "aoutlet_identifier", "aitem_visibility", "boutlet_identifier", "bitem_visibility", "gap"]
    assert rows(got.select([c if c == "gap" else c[0] + "_" + c[1:] for c in keys])) == rows(want.select(keys))
    f.unpersist()


def test_abc_with_many_equal_products(spark):
    amounts = [7] * 40 + [3] * 20 + list(range(1, 30))
    items = spark.createDataFrame([(str(i), Decimal(a)) for i, a in enumerate(amounts)], "product string, _sales decimal(28,4)")
    run = items.withColumn("r", F.sum("_sales").over(Window.orderBy(F.desc("_sales"), "product").rowsBetween(Window.unboundedPreceding, 0)))
    share = F.col("r") * 100 / F.sum("_sales").over(Window.partitionBy())
    label = F.when(share <= 80, B.ABC_LABELS[0]).when(share <= 95, B.ABC_LABELS[1]).otherwise(B.ABC_LABELS[2])
    want = run.withColumn("c", label).groupBy("c").agg(F.count("*"), F.sum("_sales"))
    assert sorted(rows(B.abc_classes(items))) == sorted(rows(want))


def test_profile_finds_conflicts(spark):
    r = raw(spark, {}, {"outlet_size": "High"}, {"item_weight": "11", "outlet_identifier": "OUT2"}, {"item_type": "Meat", "outlet_identifier": "OUT3", "outlet_size": ""})
    labels = rules.label_rows(r)
    assert tuple(R.outlet_consistency(labels).first()) == (3, 1)
    assert [x["outlet_identifier"] for x in R.conflicting_outlets(labels).collect()] == ["OUT010"]
    assert tuple(R.item_consistency(r).first()) == (1, 1, 1)
    assert rows(R.keys_without_value(labels)) == [("OUT3", 1)]


def test_profile_counts_bad_text(spark):
    r = raw(spark, {"rating": "9", "order_date": "soon"}, {"rating": "3.25", "sales": "-1", "item_visibility": "1.5"}, {"item_visibility": "0"}, {})
    got = R.impossible_values(r.agg(*rules.raw_figures())).first().asDict()
    assert got == {
        "total_rows": 4, "zero_visibility": 1, "visibility_out_of_range": 1, "non_positive_sales": 1, "rating_out_of_range": 1,
        "rating_over_precise": 1, "non_positive_weight": 0, "unparseable_dates": 1, "pct_zero_visibility": Decimal("25.00")}


def test_sums_survive_large_totals(spark):
    """The sum type leaves room for 10^12 rows of the largest amount."""
    f = fact(spark, {"sales": "999999.9999"})
    rolled = cells(f)
    assert rolled.schema["sales"].dataType.precision == 28
    assert rolled.agg(K.R.total("sales").alias("s")).schema["s"].dataType.precision == 38


def stored_for_filters(f):
    sold = rollups.assortment_rollup(f)
    return cells(f), rollups.star_rollup(f), sold, rollups.item_bitmaps(sold, rollups.number_items(products(f)))


def test_filters_apply_to_every_tile(spark):
    f = fact(spark, {"item_type": "Meat"}, {"item_type": "Dairy", "outlet_type": "Supermarket Type1"})
    tiles = D.filtered_dashboard(*stored_for_filters(f), {"item_type": ["Meat"]})
    assert tiles["kpis"].first()["count_sales"] == 1
    assert {r["label"] for r in tiles["pivots"].where("pivot = 'outlet_type'").collect()} == {"Grocery Store"}
    assert apply_filters(f, {"item_type": []}).count() == 2
    with pytest.raises(ValueError):
        D.filtered_dashboard(*stored_for_filters(f), {"colour": ["red"]})


def test_tiles_of_any_choice_equal_the_filtered_rows(spark):
    """Items sold in many cells count once; some items have two categories."""
    rnd = random.Random(3)
    labels = {"item_type": ["Meat", "Dairy", "Soft"], "outlet_type": ["Grocery Store", "Supermarket Type1"], "outlet_size": ["Small", "High"],
              "outlet_location_type": ["Tier 1", "Tier 2"], "item_fat_content": ["Low Fat", "Regular"]}
    data = [{**{c: rnd.choice(v) for c, v in labels.items()}, "item_identifier": f"I{rnd.randrange(40)}", "rating": rnd.choice(["1.5", "3.9", "4.5"]),
             "sales": rnd.randrange(1, 900), "order_date": f"{rnd.choice([2020, 2021])}-0{rnd.randrange(1, 4)}-05"} for _ in range(400)]
    f = fact(spark, *data).cache()
    stored = [df.cache() for df in stored_for_filters(f)]
    choices = [{}, {"order_year": [2020]}, {"item_type": ["Meat"], "outlet_size": ["Small"]}, {"item_type": ["Meat", "Soft"], "outlet_type": ["Grocery Store"],
               "outlet_location_type": ["Tier 2"], "order_year": [2021], "item_fat_content": ["Regular"]}, {"order_year": [1999]}]
    for choice in choices:
        kept = [r for r in apply_filters(f, choice).collect()]
        tiles = D.filtered_dashboard(*stored, choice)
        shown = {r["card"]: r["value"] for r in tiles["cards"].collect()}
        assert shown["PRODUCTS"] == str(len({r["item_identifier"] for r in kept})) and shown["SALES RECORDS"] == str(len(kept))
        assert shown["CATEGORIES"] == str(len({r["item_type"] for r in kept}))
        pivot = {(r["pivot"], r["label"]): r["value"] for r in tiles["pivots"].collect()}
        assert {k[1]: v for k, v in pivot.items() if k[0] == "rating"} == {
            b: sum(lo <= r["rating"] < hi for r in kept) for b, lo, hi in (("Under 3.0", 0, 3), ("3.5-3.9", Decimal("3.5"), 4), ("4.5-5.0", Decimal("4.5"), 6))
            if any(lo <= r["rating"] < hi for r in kept)}
        per_item = {}
        for r in kept:
            per_item[r["item_identifier"]] = per_item.get(r["item_identifier"], 0) + r["sales"]
        best = sorted(per_item.items(), key=lambda x: (-x[1], x[0]))[:10]
        assert {k[1]: v for k, v in pivot.items() if k[0] == "top_prod"} == dict(best)
    for df in (f, *stored):
        df.unpersist()


def test_items_are_counted_across_buckets(spark):
    """Numbers of several buckets and tasks; an item in every cell counts once."""
    sold = spark.range(100_000).select(
        F.format_string("I%06d", F.col("id")).alias("item_identifier"),
        *[F.lit("x").alias(c) for c in rollups.FILTER_FIELDS if c != "order_year"], F.explode(F.array(F.lit(1), F.lit(2))).alias("order_year"))
    numbers = rollups.number_items(sold.select("item_identifier").repartition(3)).cache()
    assert numbers.select("item_number").distinct().count() == 100_000
    bitmaps = rollups.item_bitmaps(sold, numbers).cache()
    assert rollups.count_items(bitmaps).first()["products"] == 100_000
    assert bitmaps.select("bucket").distinct().count() >= 4
    assert rollups.count_items(bitmaps.where("order_year = 3")).first()["products"] == 0
    numbers.unpersist(), bitmaps.unpersist()


def test_shares_and_classes_cover_everything(spark):
    rnd = random.Random(1)
    f = fact(spark, *[{"item_identifier": f"I{rnd.randrange(30)}", "item_type": f"T{i % 5}", "sales": rnd.randrange(1, 900)} for i in range(200)])
    whole = f.agg(F.sum("sales")).first()[0]
    assert K.category_inventory(products(f)).agg(F.sum("revenue")).first()[0] == whole
    assert abs(K.category_inventory(products(f)).agg(F.sum("pct_of_revenue")).first()[0] - 100) < Decimal("0.05")
    assert B.abc_pareto(products(f)).agg(F.sum("products")).first()[0] == f.select("item_identifier").distinct().count()
    assert A.contribution_curve(cells(f)).collect()[-1]["cumulative_pct"] == 100


def test_bitmaps_are_made_after_the_shuffle(spark):
    """No bitmap is shuffled: a partial one per task, cell and bucket grows with tasks times buckets."""
    sold = spark.range(1000).select(
        F.format_string("I%04d", F.col("id")).alias("item_identifier"),
        *[F.when(F.col("id") % 7 > 0, "x").alias(c) for c in rollups.FILTER_FIELDS if c != "order_year"], (F.col("id") % 3).alias("order_year"))
    bitmaps = rollups.item_bitmaps(sold, rollups.number_items(sold))
    text = bitmaps._jdf.queryExecution().executedPlan().toString()
    below = text[text.index("partial_bitmap_construct_agg"):]
    above = text[:text.index("partial_bitmap_construct_agg")]
    assert "REPARTITION_BY_COL" in below and "hashpartitioning" not in above
    assert rollups.count_items(bitmaps).first()["products"] == 1000
    assert rollups.count_items(bitmaps.where("item_type IS NULL")).first()["products"] == 143


def test_pairs_need_no_roll_up(spark):
    f = fact(spark, *[{"outlet_identifier": f"O{k}", "sales": v, "item_fat_content": fat} for k, v, fat in (
        (1, 1, "Low Fat"), (1, 90, "Regular"), (2, 2, "Low Fat"), (3, 60, "Low Fat"))])
    assert rows(widest_pairs(f)) == rows(widest_pairs(f, stocks(f))) and widest_pairs(f).first()["gap"] == 88
    assert "stocks" not in [n for n, p in inspect.signature(A.store_pairs).parameters.items() if p.default is p.empty]
