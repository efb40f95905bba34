"""Cleaning rules on rows made for them."""

from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fixtures import raw
from shelfwise.operators import cleaning as C
from shelfwise.operators.medians import grouped_median
from shelfwise.plans.quality import assert_clean, split_by_rules
from shelfwise.schema import FACT_COLUMNS, RAW_HEADER
from shelfwise.sources import files

SPELLINGS = ["Low Fat", "low fat", "Low Fat ", "LF", "Regular", "reg", " Regular"]


def column(df, name):
    return [r[0] for r in df.select(name).collect()]


def test_seven_spellings_become_two(spark):
    typed = C.type_columns(raw(spark, *[{"item_fat_content": s} for s in SPELLINGS]))
    assert column(typed, "item_fat_content") == ["Low Fat"] * 4 + ["Regular"] * 3


def test_unknown_spelling_fails_or_is_reported(spark):
    odd = raw(spark, {"item_fat_content": "xx"})
    with pytest.raises(PySparkException, match="unmapped fat content: xx"):
        C.type_columns(odd).collect()
    assert column(C.type_columns(odd, strict=False), "item_fat_content") == [None]


@pytest.mark.parametrize("values,want", [([1, 2, 9], 2), ([1, 2, 4, 9], 3), ([5], 5), ([None, 7, 7], 7)])
def test_median(spark, values, want):
    rows = [("a", Decimal(v) if v is not None else None) for v in values]
    df = spark.createDataFrame(rows, "k string, v decimal(6,3)")
    assert grouped_median(df, ["k"], "v", "m").first()["m"] == want


def test_median_of_nothing_and_of_counted_rows(spark):
    empty = spark.createDataFrame([("a", None)], "k string, v decimal(6,3)")
    assert grouped_median(empty, ["k"], "v", "m").collect() == []
    counted = spark.createDataFrame([("a", Decimal(1), 5), ("a", Decimal(9), 4), ("a", None, 100)], "k string, v decimal(6,3), n int")
    assert grouped_median(counted, ["k"], "v", "m", count="n").first()["m"] == 1


def test_weight_falls_back_to_category(spark):
    clean = C.clean(raw(
        spark, {"item_identifier": "A", "item_weight": ""}, {"item_identifier": "B", "item_weight": "4"},
        {"item_identifier": "B", "item_weight": "6", "sales": "3"}, {"item_identifier": "B", "item_weight": "", "sales": "4"},
        {"item_identifier": "C", "item_weight": "9"}))
    got = {(r.item_identifier, r.sales): (r.item_weight, r.item_weight_imputed) for r in clean.collect()}
    assert got["A", 100] == (Decimal("6.000"), 1)  # median of 4, 6, 9
    assert got["B", 4] == (Decimal("5.000"), 1)  # the item's own median
    assert got["C", 100] == (Decimal("9.000"), 0)


def test_zero_visibility_is_missing(spark):
    clean = C.clean(raw(spark, {"item_visibility": "0.0"}, {"item_visibility": "0.02", "sales": "5"}, {"item_visibility": "0.04", "sales": "6"}))
    got = {int(r.sales): (r.item_visibility, r.item_visibility_imputed) for r in clean.collect()}
    assert got == {100: (Decimal("0.030000"), 1), 5: (Decimal("0.020000"), 0), 6: (Decimal("0.040000"), 0)}


def test_blank_size_is_unknown(spark):
    assert column(C.type_columns(raw(spark, {"outlet_size": " "}, {"outlet_size": None})), "outlet_size") == ["Unknown"] * 2


@pytest.mark.parametrize("text,want", [("5.04", "5.00"), ("0.4", "1.00"), ("3.85", "3.90"), ("4.949", "4.90"), ("4.95", "5.00")])
def test_rating_is_rounded_and_bounded(spark, text, want):
    assert column(C.type_columns(raw(spark, {"rating": text})), "rating") == [Decimal(want)]


def test_copies_collapse_after_typing(spark):
    same = raw(spark, {"item_fat_content": "LF"}, {"item_fat_content": "Low Fat"}, {"item_weight": ""}, {"item_weight": " "})
    assert C.clean(same).count() == 2


def test_bad_number_fails(spark):
    with pytest.raises(PySparkException):
        C.type_columns(raw(spark, {"sales": "n/a"})).collect()


def test_date_parts(spark):
    row = C.clean(raw(spark, {"order_date": "2022-12-31"})).first()
    assert (row.order_year, row.order_month, row.order_month_name, row.order_quarter) == (2022, 12, "Dec", 4)
    assert (row.order_year_month, row.order_weekday, row.is_weekend, row.outlet_age_years) == ("2022-12", "Sat", 1, 26)


def test_csv_round_trip_keeps_spaces_and_windows_line_ends(spark, tmp_path):
    path = str(tmp_path / "raw")
    files.write_raw(raw(spark, {"item_fat_content": " Regular", "item_weight": "", "item_type": 'a "b", c'}), path)
    row = files.read_raw(spark, path).first()
    assert (row.item_fat_content, row.item_weight, row.item_type) == (" Regular", None, 'a "b", c')
    crlf = tmp_path / "crlf.csv"
    crlf.write_bytes(",".join(RAW_HEADER).encode() + b"\r\nA,1,LF,0.1,T,O,1990,,Tier 1,G,5,4,2022-01-02\r\n")
    assert C.clean(files.read_raw(spark, str(crlf))).first().order_year == 2022


def test_assertions_and_quarantine(spark):
    clean = C.clean(raw(spark, {}, {"item_identifier": "B", "sales": "0"}))
    with pytest.raises(AssertionError, match="sales positive: 1 rows"):
        assert_clean(clean)
    accepted, held = split_by_rules(clean)
    assert (accepted.count(), held.count()) == (1, 1)
    assert_clean(accepted)


def test_hot_item_is_split_in_the_imputation_join(spark, tmp_path):
    """A third of all rows belong to one item; with a stored lookup, adaptive execution splits its partition."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("I"), (F.col("id") % 901).cast("string"))).alias("item_identifier"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 7 + 1)).cast("decimal(6,3)").alias("item_weight"),
        F.lit("T").alias("item_type"), F.lit(None).cast("decimal(9,6)").alias("item_visibility"), F.col("id").cast("string").alias("pad"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        C.median_weight_by_item(rows).write.parquet(str(tmp_path / "medians"))
        by_item = spark.read.parquet(str(tmp_path / "medians"))
        joined = rows.repartition(8).join(by_item, "item_identifier", "left")
        medians = [r["item_median_weight"] for r in joined.collect()]
        assert len(medians) == 60_000 and None not in medians
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_only_hashes_are_shuffled_to_find_copies(spark):
    """Copies in other spellings, NULLs, and rows that differ outside the hashed columns."""
    given = raw(
        spark, {}, {"item_fat_content": "LF"}, {"rating": "2"}, {"item_weight": ""}, {"item_weight": " "}, {"sales": "7"},
        {"item_identifier": None, "sales": ""}, {"item_identifier": None, "sales": None})
    typed = C.type_columns(given)
    unique = C.unique_rows(typed, lambda df, name: df)
    text = unique._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in text and text.count("BroadcastHashJoin") == 2
    assert sorted(map(repr, unique.collect())) == sorted(map(repr, C.drop_copies(typed).collect())) and unique.count() == 5


def test_many_copies_are_all_compared(spark, monkeypatch):
    monkeypatch.setattr(C, "MOST_REPEATED", 0)
    typed = C.type_columns(raw(spark, {}, {}, {"sales": "7"}))
    assert C.unique_rows(typed, lambda df, name: df).count() == 2


def test_rows_with_a_weight_are_not_joined_and_few_columns_are_dealt_out(spark):
    rows = C.type_columns(raw(
        spark, {}, {"item_weight": "", "item_visibility": "0"}, {"item_identifier": "B", "item_weight": "", "order_date": "2023-01-01"}))
    lookups = C.median_weight_by_item(rows), C.medians_by_type(rows)
    done = C.finish_by_year(rows, *lookups).select(FACT_COLUMNS)
    want = C.finish(rows, *lookups).select(FACT_COLUMNS)
    assert sorted(map(repr, done.collect())) == sorted(map(repr, want.collect()))
    dealt = next(line for line in done._jdf.queryExecution().optimizedPlan().toString().splitlines()[::-1] if "RebalancePartitions" in line)
    assert "order_year" in dealt
    below = done._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions")[1]
    assert "sale_id" not in below and "order_month_name" not in below and "Union" in below


def test_parts_of_a_date_are_looked_up_and_equal_its_formatted_parts(spark):
    days = spark.sql("SELECT explode(sequence(date'1999-12-25', date'2001-01-08')) AS order_date UNION ALL SELECT date'0007-02-03' UNION ALL SELECT NULL UNION ALL SELECT date_add(date'9999-12-31', 40)")
    parts = C.add_date_parts(days)
    formatted = {"order_month_name": "MMM", "order_weekday": "EEE", "order_year_month": "yyyy-MM"}
    wrong = parts.where(" OR ".join(f"NOT {c} <=> date_format(order_date, '{f}')" for c, f in formatted.items()))
    assert wrong.count() == 0 and parts.count() == days.count()
    names = parts.select("order_month_name", "order_weekday")._jdf.queryExecution().optimizedPlan().toString()
    assert "date_format" not in names


def test_text_is_parsed_once_to_find_copies(spark):
    stored = {}
    C.unique_rows(C.type_columns(raw(spark, {}, {}, {"sales": "7"})), lambda df, name: stored.setdefault(name, df.localCheckpoint()))
    assert sorted(stored) == ["compared", "repeated", "typed"] and stored["compared"].count() == 1
