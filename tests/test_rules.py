"""Figures that are counted while a table is written."""

import pytest
from pyspark.sql import functions as F

from fixtures import fact, raw
from shelfwise import catalog
from shelfwise.operators import rules
from shelfwise.sources import store
from shelfwise.sources.files import write_raw
from shelfwise.workspace import Workspace

FROM_FIGURES = [
    "src_row_count", "prof_schema", "prof_missing", "prof_whitespace", "prof_ranges", "prof_cross_field", "prof_min_max", "val_enum",
    "val_checks", "val_not_null", "val_imputation_share", "val_row_recon", "val_revenue_recon"]
FROM_SMALL_TABLES = [
    "prof_duplicates", "prof_decisions", "prof_grain", "prof_category_values", "prof_domain_lists", "prof_missing_by_key", "prof_ref_outlet",
    "prof_ref_outlet_list", "val_unique", "val_assertions", "val_defects_zero"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", FROM_FIGURES + FROM_SMALL_TABLES)
def test_reports_leave_the_large_tables_alone(spark, key):
    text = plan(catalog.run(key, spark, "/root/testdata/sf0.001"))
    assert "/fact]" not in text and "/fact," not in text and "/raw]" not in text and "/raw," not in text


def test_figures_of_a_write_equal_those_of_a_scan(spark):
    workspace = Workspace(spark, "/root/testdata/sf0.001")
    for table, figures, made in (("raw", rules.raw_figures(), workspace.raw_figures()), ("fact", rules.fact_figures(), workspace.fact_figures())):
        assert made.collect() == getattr(workspace, table)().agg(*figures).collect()


def test_bad_rows_are_counted_where_they_are_written(spark, tmp_path):
    bad = fact(spark, {}, {"sales": 0}, {"item_weight": None, "outlet_size": "Huge"}, {"rating": "5.50"}, {"sales": None, "item_visibility": 0})
    store.stage(spark, str(tmp_path), "bad", lambda: bad.repartition(3, "sales"), ["order_year"], rules.fact_figures())
    found = spark.read.parquet(store.stage_path(spark, str(tmp_path), "bad_figures")).first().asDict()
    assert {k: v for k, v in found.items() if v and ":" in k} == {
        "check: sales_positive": 1, "check: rating_range": 1, "label: outlet_size": 1, "null: sales": 1, "assertion: weight present": 1,
        "assertion: visibility above zero": 1, "assertion: sales positive": 1, "assertion: rating within 1 to 5": 1}
    assert found["total_rows"] == 5 and found["zero_visibility"] == 1


def test_an_extract_is_scanned_once_for_its_profile(spark, tmp_path):
    folder = str(tmp_path / "csv")
    write_raw(raw(spark, {}, {"item_weight": "", "rating": " 9"}, {"sales": "x"}), folder)
    workspace = Workspace.from_csv(spark, folder)
    figures = workspace.raw_figures()
    assert "FileScan parquet" in plan(figures) and figures.first()["total_rows"] == 3
    assert figures.first()["defect: rating_out_of_range"] == 1 and figures.first()["filled: item_weight"] == 2


def test_copies_and_grain(spark):
    given = raw(spark, {}, {}, {}, {"sales": "7"}, {"sales": "7"}, {"outlet_identifier": "O2"})
    assert sorted(r["n"] for r in rules.copied_rows(given, lambda df, name: df).collect()) == [2, 3]
    assert sorted(map(tuple, rules.grain_sizes(given).collect())) == [(1, 1), (5, 1)]
    empty = given.where(F.lit(False))
    assert rules.copied_rows(empty, lambda df, name: df).count() == 0 and rules.grain_sizes(empty).count() == 0


def test_pairs_are_counted_without_the_stocks(spark):
    """The sizes of item-outlet pairs come from two columns, and the extract is not profiled by reports that don't ask."""
    from shelfwise.plans import quality

    given = fact(spark, {}, {}, {"sales": 7}, {"outlet_identifier": "O2"}, {"outlet_identifier": "O3"}, {"outlet_identifier": "O3"})
    assert tuple(quality.grain_repeats(rules.grain_sizes(given)).first()) == (2, 3)
    assert tuple(quality.grain_repeats(rules.grain_sizes(given.limit(0))).first()) == (0, 0)
