"""Staged tables and the folder they live in."""

import time
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from shelfwise import catalog
from shelfwise.functions import measures
from shelfwise.operators import cleaning, rollups
from shelfwise.operators.segments import summarise
from shelfwise.plans import kpis
from shelfwise.schema import OUTLET_ATTRIBUTES, RAW_COLUMNS
from shelfwise.sources import store
from shelfwise.workspace import Workspace

from fixtures import fact as rows, raw as rows_of_text


def session(master, named=None):
    context = SimpleNamespace(
        master=master, applicationId=f"app-{master}", getConf=lambda: SimpleNamespace(get=lambda key: named))
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: None))


def test_named_folder_wins():
    assert store.shared_dir(session("spark://host:7077", "hdfs:///shared/")) == "hdfs:///shared"


def test_cluster_without_folder_is_refused_and_local_gets_one():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        store.shared_dir(session("yarn"))
    local = session("local[2]")
    assert store.shared_dir(local) == store.shared_dir(local)


def test_stage_is_written_once(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    for _ in range(3):
        assert store.stage(spark, "/some/source", "numbers", build).count() == 5
    assert len(calls) == 1
    store.stage(spark, "/other/source", "numbers", build)
    assert len(calls) == 2


def test_shuffle_files_go_when_a_stage_is_written(spark):
    folders = [Path(d.getPath()) for d in spark._jsc.sc().env().blockManager().diskBlockManager().localDirs()]

    def shuffled():
        return {p.name for folder in folders for p in folder.rglob("shuffle_*")}

    before, keyed = shuffled(), spark.range(1000).repartition(7, "id").withColumn("n", F.col("id") % 5)
    written = store.stage(spark, "/some/source", "shuffled", lambda: keyed, ["n"])
    until = time.time() + 5
    while shuffled() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffled() - before
    assert spark.conf.get(store.DROP_SHUFFLES) == "false"
    assert written.count() == 1000 and len(keyed.collect()) == len(keyed.collect()) == 1000


def test_the_setting_of_the_session_returns(spark):
    spark.conf.set(store.DROP_SHUFFLES, "true")
    try:
        with pytest.raises(Exception, match="broken disk"):
            store.stage(spark, "/some/source", "broken", lambda: spark.range(3).select(F.raise_error(F.lit("broken disk"))))
        assert spark.conf.get(store.DROP_SHUFFLES) == "true"
    finally:
        spark.conf.unset(store.DROP_SHUFFLES)
    with store.shuffles_dropped(spark):
        assert spark.conf.get(store.DROP_SHUFFLES) == "true"
    assert spark.conf.get(store.DROP_SHUFFLES) == "false"


def test_typed_rows_are_stored_without_their_hash(spark):
    workspace = Workspace(spark, "typed", lambda: rows_of_text(spark, {}, {}, {"sales": "7"}, {"sales": None}, {"sales": None}))
    assert workspace.unique().count() == 3
    assert spark.read.parquet(workspace.path("unique_typed")).columns == RAW_COLUMNS


def test_staged_fact_prunes_years_and_keys_are_unique(spark):
    workspace = Workspace(spark, "/root/testdata/sf0.001")
    fact = workspace.fact()
    one_year = fact.where(F.col("order_year") == 1999)
    assert "PartitionFilters: [isnotnull(order_year" in one_year._jdf.queryExecution().executedPlan().toString()
    assert fact.select("sale_id").distinct().count() == fact.count()


def test_rollups_add_up_to_the_fact(spark):
    workspace = Workspace(spark, "/root/testdata/sf0.001")
    want = workspace.fact().agg(F.count("*"), F.sum("sales"), F.sum("rating")).first()
    for rollup in (workspace.products(), workspace.outlets(), workspace.shelves(), workspace.cells()):
        assert tuple(rollup.agg(F.sum("records"), F.sum("sales"), F.sum("rating")).first()) == tuple(want)


def test_stores_are_broadcast_and_lines_are_narrow_before_they_are_joined(spark):
    from shelfwise.sources.tables import raw_from_tables

    text = raw_from_tables(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("strategy=broadcast") == 2
    lowest = text.splitlines()[[" Join Inner" in line or "- Join Inner" in line for line in text.splitlines()].index(True):]
    assert "l_linestatus" not in lowest[0] and "AS _low_fat" in "".join(lowest)


def test_the_key_is_made_when_the_fact_is_read(spark):
    workspace = Workspace(spark, "/root/testdata/sf0.001")
    fact = workspace.fact()
    assert "sale_id" not in spark.read.parquet(workspace.path("fact")).columns
    assert fact.select("sale_id").distinct().count() == fact.count()
    from shelfwise.operators.cleaning import add_sale_id
    assert fact.select("sale_id").exceptAll(add_sale_id(workspace.unique()).select("sale_id")).isEmpty()


def test_what_is_read_once_or_follows_from_other_columns_is_not_stored(spark):
    # Another name of the folder gives the test stages of its own.
    workspace = Workspace(spark, "/root/testdata/../testdata/sf0.001")

    def stored(name):
        return store.staged(spark, workspace.source, name)

    ratings = catalog.call(catalog.REPORTS["cln_round_clamp"], workspace)
    assert not stored("raw") and "p_type" not in ratings._jdf.queryExecution().executedPlan().toString()
    fact = workspace.fact()
    assert not stored("raw") and not stored("fact_figures")
    columns = spark.read.parquet(workspace.path("fact")).columns
    assert not {"order_month_name", "order_year_month", "order_weekday", "outlet_age_years", "sale_id"} & set(columns)
    made = cleaning.finish(workspace.unique(), workspace.weight_by_item(), workspace.medians_by_type()).select(fact.columns)
    assert fact.exceptAll(made).isEmpty() and made.exceptAll(fact).isEmpty()
    want = ratings.collect()
    workspace.raw()
    assert sorted(catalog.call(catalog.REPORTS["cln_round_clamp"], workspace).collect()) == sorted(want)


def test_views_need_no_roll_up_by_product_and_outlet(spark):
    workspace = Workspace(spark, "/root/testdata/../testdata/../testdata/sf0.001")
    assert catalog.call(catalog.REPORTS["v_smoke"], workspace).count() == 22
    assert not store.staged(spark, workspace.source, "stocks")


def test_products_per_outlet_equal_those_of_the_stocks(spark, monkeypatch):
    f = rows(
        spark, {}, {}, {"item_identifier": "B"}, {"item_identifier": None}, {"outlet_size": None, "item_identifier": "B"},
        {"outlet_identifier": None}, {"outlet_type": "Supermarket Type1"}, {"outlet_identifier": "OUT013", "item_identifier": None})
    for keys in (OUTLET_ATTRIBUTES, ["outlet_identifier", "outlet_type"]):
        want = summarise(rollups.stock_rollup(f), keys, measures.products("products_stocked"))
        for most in (1_000_000, 0):
            monkeypatch.setattr(kpis, "MOST_STORES", most)
            got = kpis.products_per(f, rollups.shelf_rollup(f), keys).select(want.columns)
            assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
