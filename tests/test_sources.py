"""Strict readers, and all reports on a CSV extract."""

import pytest
from pyspark.sql import functions as F

from fixtures import RAW_DEFAULTS, raw
from shelfwise import catalog
from shelfwise.schema import FACT_COLUMNS, RAW_HEADER
from shelfwise.sources import files
from shelfwise.workspace import Workspace

HEADER = ",".join(RAW_HEADER)
LINE = ",".join(RAW_DEFAULTS.values())


def extract(tmp_path, *lines):
    path = tmp_path / "extract.csv"
    path.write_text("\r\n".join(lines) + "\r\n")
    return str(path)


def test_good_extract(spark, tmp_path):
    got = files.read_raw(spark, extract(tmp_path, HEADER, LINE, LINE.replace("Dairy", '"a ""b"", c"')))
    assert [r.item_type for r in got.collect()] == ["Dairy", 'a "b", c']
    assert got.first().asDict() == RAW_DEFAULTS


@pytest.mark.parametrize("lines", [
    [HEADER.replace("Item Type,Outlet Identifier", "Outlet Identifier,Item Type"), LINE], [HEADER, LINE, LINE.rpartition(",")[0]],
    [HEADER, LINE, LINE + ",more"]])
def test_swapped_header_short_and_long_lines_fail(spark, tmp_path, lines):
    path = extract(tmp_path, *lines)
    with pytest.raises(Exception, match="(?i)header|malformed"):
        files.read_raw(spark, path).collect()
    with pytest.raises(Exception, match="(?i)header|malformed"):
        files.read_raw(spark, path).select("item_type").collect()


def test_bad_number_fails(spark, tmp_path):
    path = str(tmp_path / "clean")
    fact = Workspace(spark, "/root/testdata/sf0.001").fact().limit(3)
    files.write_clean_csv(fact, path)
    assert files.read_clean_csv(spark, path, FACT_COLUMNS).count() == 3
    files.write_clean_csv(fact.withColumn("sales", F.lit("12,5x")), path)
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_clean_csv(spark, path).select("sales").collect()
    bad = Workspace(spark, "bad", lambda: raw(spark, {"sales": "12.x"}))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad.fact()


def test_reports_run_from_a_csv_folder(spark, tmp_path):
    rows = [{"item_identifier": f"I{i % 7}", "outlet_identifier": f"O{i % 3}", "sales": f"{100 + i}.5", "item_type": "AB"[i % 2],
             "order_date": f"200{i % 2}-0{i % 9 + 1}-11"} for i in range(60)]
    folder = str(tmp_path / "csv")
    files.write_raw(raw(spark, *rows, rows[0]), folder)
    workspace = Workspace.from_csv(spark, folder)
    assert workspace.fact().count() == 60
    for key in ("eda_kpis", "q08_abc_pareto", "a10_distribution_gaps", "v4_product_master", "prof_duplicates", "val_row_recon"):
        assert catalog.call(catalog.REPORTS[key], workspace).count() >= 0
    assert catalog.call(catalog.REPORTS["q01_top_products"], workspace).count() == 10
    workspace.raw().createOrReplaceTempView("staging")
    assert Workspace.from_table(spark, "staging").fact().count() == 60
