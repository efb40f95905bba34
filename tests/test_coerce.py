"""The lenient load: what is rejected, where it stood, and when too much is."""

import pytest

from fixtures import RAW_DEFAULTS, raw
from shelfwise import catalog
from shelfwise.operators import cleaning, coerce
from shelfwise.schema import RAW_COLUMNS, RAW_HEADER
from shelfwise.sources.publish import Rejected
from shelfwise.workspace import Workspace

HEADER = ",".join(RAW_HEADER)


def line(**changes):
    return ",".join({**RAW_DEFAULTS, **changes}.values())


def extract(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\r\n".join([HEADER, *lines]) + "\r\n")
    return str(folder)


CASES = [
    ("item_weight", "12,5", "not a number"), ("item_weight", "1234.5", "out of range"), ("item_visibility", "half", "not a number"),
    ("outlet_establishment_year", "19x8", "not a number"), ("outlet_establishment_year", "99999999999", "out of range"),
    ("sales", "n/a", "not a number"), ("sales", "12345678.5", "out of range"), ("rating", "good", "not a number"),
    ("rating", "99999.5", "out of range"), ("order_date", "2021-13-40", "not a date"), ("order_date", "05.03.2022", "not a date"),
    ("item_fat_content", "xx", "unknown label")]


@pytest.mark.parametrize("column, value, reason", CASES)
def test_a_bad_value_is_null_and_kept_apart(spark, tmp_path, column, value, reason):
    given = raw(spark, {}, {column: value, "item_identifier": "BAD"}, {"item_weight": "", "outlet_size": ""})
    with pytest.raises(Exception):
        cleaning.type_columns(given).collect()
    root = str(tmp_path / "load")
    coerce.load(given, root, max_share=0.5)
    typed = {r.item_identifier: r for r in coerce.typed_rows(spark, root).collect()}
    assert typed["BAD"][column] is None and typed["FDX32"][column] is not None or column == "item_weight"
    assert [tuple(r)[3:] for r in coerce.rejected(spark, root).collect()] == [("OUT010", column, value, reason)]
    # Every other column of the row is typed as in a strict load.
    good = cleaning.type_columns(raw(spark, {"item_identifier": "BAD"})).first()
    assert all(typed["BAD"][c] == good[c] for c in RAW_COLUMNS if c != column)


def test_good_rows_are_typed_as_in_a_strict_load(spark, tmp_path):
    given = raw(spark, {}, {"item_weight": " ", "rating": "5.04"}, {"item_visibility": "0.0", "item_fat_content": " reg "})
    coerce.load(given, str(tmp_path / "load"), max_share=0.0)
    got, want = coerce.typed_rows(spark, str(tmp_path / "load")).collect(), cleaning.type_columns(given).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert coerce.rejected(spark, str(tmp_path / "load")).count() == 0


def test_too_many_rejects_fail_and_leave_the_last_load(spark, tmp_path):
    root = str(tmp_path / "load")
    coerce.load(raw(spark, {}, {"sales": "7"}), root)
    with pytest.raises(Rejected, match="rejected values: 2 rows of 3"):
        coerce.load(raw(spark, {"sales": "x", "rating": "y"}, {"sales": "x"}, {}), root, max_share=0.5)
    assert coerce.typed_rows(spark, root).count() == 2


def test_files_with_malformed_lines(spark, tmp_path):
    lines = [line(item_identifier=f"I{k}", sales=f"{k + 1}.5") for k in range(40)]
    short = line(item_identifier="SHORT").rpartition(",")[0]
    extract(tmp_path / "in", "a.csv", *lines, short, line(item_identifier="N", sales="n/a"))
    path = extract(tmp_path / "in", "b.csv", line(item_identifier="LONG") + ",more", line(item_identifier="D", order_date="soon"), *lines[:3])
    with pytest.raises(Exception, match="(?i)malformed"):
        Workspace.from_csv(spark, path).unique()
    workspace = Workspace.from_csv(spark, path, max_rejects=0.2)
    assert workspace.unique().count() == 42
    found = {(r.file.rpartition("/")[2], r.column_name, r.value, r.reason) for r in workspace.rejects().collect()}
    assert found == {
        ("a.csv", "line", short, "malformed line"), ("a.csv", "sales", "n/a", "not a number"),
        ("b.csv", "line", line(item_identifier="LONG") + ",more", "malformed line"), ("b.csv", "order_date", "soon", "not a date")}
    assert {r.block_start for r in workspace.rejects().collect()} == {"0"}
    with pytest.raises(Rejected):
        Workspace.from_csv(spark, str(tmp_path / "in/b.csv"), max_rejects=0.2).unique()
    with pytest.raises(ValueError):
        Workspace.from_csv(spark, path).rejects()


def test_reports_run_on_a_lenient_workspace(spark, tmp_path):
    lines = [line(item_identifier=f"I{k % 7}", outlet_identifier=f"O{k % 3}", sales=f"{k + 1}.5", item_type="AB"[k % 2]) for k in range(60)]
    workspace = Workspace.from_csv(spark, extract(tmp_path / "in", "a.csv", *lines, "broken"), max_rejects=0.1)
    assert catalog.call(catalog.REPORTS["eda_kpis"], workspace).first()["total_sales_records"] == 60
    assert catalog.call(catalog.REPORTS["prof_duplicates"], workspace).count() == 1


def test_a_reason_is_worked_out_once(spark):
    given = raw(spark, {}, {"order_date": "x"})
    text = given.select(coerce.rejects(given).alias("r"))._jdf.queryExecution().optimizedPlan().toString()
    assert text.count(coerce.NOT_A_DATE) == 1 and text.count(coerce.NO_LABEL) == 1
