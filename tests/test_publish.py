"""Loads that fail at any point leave the published tables as they are."""

import gzip

import pytest
from pyspark.sql import functions as F

from fixtures import fact, raw
from shelfwise.operators import cleaning
from shelfwise.operators.rules import row_rules
from shelfwise.schema import FACT_SCHEMA
from shelfwise.sources import files, publish as P


def rows(df):
    return sorted(map(tuple, df.collect()))


def some_fact(spark, sales):
    return fact(spark, *[{"item_identifier": f"I{i}", "sales": s, "order_date": f"202{i % 3}-01-05"} for i, s in enumerate(sales)])


def failing(df, column="sales"):
    """A job that fails in one of its tasks, after others have written."""
    boom = F.when(F.col("item_identifier") == "I5", F.raise_error(F.lit("broken disk"))).otherwise(F.col(column))
    return df.repartition(4, "item_identifier").withColumn(column, boom.cast(df.schema[column].dataType))


def test_a_load_that_fails_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "fact")
    first = some_fact(spark, range(1, 9))
    files.write_fact(first, path, row_rules())
    want = rows(first)
    assert rows(files.read_fact(spark, path)) == want
    open_reader = files.read_fact(spark, path)
    with pytest.raises(Exception, match="broken disk"):
        files.write_fact(failing(some_fact(spark, range(50, 70))), path, row_rules())
    assert rows(files.read_fact(spark, path)) == want
    with pytest.raises(P.Rejected, match="sales_positive: 1 rows of 3"):
        files.write_fact(some_fact(spark, [5, 0, 7]), path, row_rules())
    assert rows(files.read_fact(spark, path)) == want
    files.write_fact(some_fact(spark, [7, 8]), path, row_rules())
    assert rows(files.read_fact(spark, path)) == rows(some_fact(spark, [7, 8]))
    # Who has opened the table before still reads what it opened.
    assert rows(open_reader) == want


def test_a_repeated_load_gives_the_same_rows_once(spark, tmp_path):
    path, given = str(tmp_path / "fact"), some_fact(spark, range(1, 30))
    for _ in range(3):
        files.write_fact(given, path)
        assert rows(files.read_fact(spark, path)) == rows(given)
    stored = files.read_fact(spark, path)
    assert stored.schema.simpleString() == FACT_SCHEMA.simpleString()
    assert "PartitionFilters: [isnotnull(order_year" in stored.where("order_year = 2021")._jdf.queryExecution().executedPlan().toString()


def test_tables_of_a_load_appear_together(spark, tmp_path):
    path = str(tmp_path / "aggregates")
    one, two = (spark.range(n).withColumnRenamed("id", "n") for n in (3, 5))
    files.write_aggregates({"a": one, "b": one}, path)
    bad = two.select(F.when(F.col("n") == 4, F.raise_error(F.lit("broken disk"))).otherwise(F.col("n")).cast("bigint").alias("n"))
    with pytest.raises(Exception, match="broken disk"):
        files.write_aggregates({"a": two, "b": bad}, path)
    assert {name: df.count() for name, df in files.read_aggregates(spark, path).items()} == {"a": 3, "b": 3}
    files.write_aggregates({"a": two, "c": two}, path)
    assert {name: df.count() for name, df in files.read_aggregates(spark, path).items()} == {"a": 5, "c": 5}
    with pytest.raises(LookupError):
        P.published(spark, path, "b")


def test_nothing_published(spark, tmp_path):
    with pytest.raises(LookupError):
        files.read_fact(spark, str(tmp_path / "none"))
    assert P.names(spark, str(tmp_path / "none")) == []
    with pytest.raises(P.Rejected):
        files.write_fact(some_fact(spark, [0]), str(tmp_path / "first"), row_rules())
    with pytest.raises(LookupError):
        files.read_fact(spark, str(tmp_path / "first"))


def test_an_empty_table_is_a_table(spark, tmp_path):
    path = str(tmp_path / "fact")
    files.write_fact(some_fact(spark, [1]), path)
    files.write_fact(some_fact(spark, [1]).limit(0), path, row_rules())
    assert files.read_fact(spark, path).count() == 0


def test_old_loads_go_when_asked(spark, tmp_path):
    path = str(tmp_path / "numbers")
    loads = [P.publish(path, {"n": P.Part(spark.range(k + 1))}) for k in range(4)]
    assert P.retire(spark, path, keep=2) == [loads[1], loads[0]]
    assert sorted(p.name for p in (tmp_path / "numbers" / "data").iterdir()) == sorted(loads[2:])
    assert P.published(spark, path, "n").count() == 4


def test_clean_csv_and_facts(spark, tmp_path):
    given = some_fact(spark, [1, 2, 3])
    files.write_clean_csv(given, str(tmp_path / "csv"))
    assert rows(files.read_clean_csv(spark, str(tmp_path / "csv"), FACT_SCHEMA.fieldNames())) == rows(given)
    files.write_facts(given.agg(F.sum("sales").alias("s"), F.max("order_date").alias("d")), str(tmp_path / "json"))
    assert rows(files.read_facts(spark, str(tmp_path / "json"))) == rows(given.agg(F.sum("sales"), F.max("order_date")))


def test_clean_csv_is_stored_small_and_in_parts(spark, tmp_path, monkeypatch):
    odd = [{"item_identifier": f"I{i}", "sales": i + 1, "item_weight": None if i % 7 == 0 else "9.5", "item_type": ("Dairy", 'a "b", c', "d,e", None)[i % 4]}
           for i in range(2000)]
    given = fact(spark, *odd).coalesce(1)
    monkeypatch.setitem(files.STORED_CSV, "maxRecordsPerFile", "300")
    files.write_clean_csv(given, str(tmp_path))
    parts = [p for p in tmp_path.rglob("part-*") if "/data/" in str(p)]
    assert len(parts) == 7 and all(p.name.endswith(".csv.gz") for p in parts)
    texts = [gzip.decompress(p.read_bytes()) for p in parts]
    assert sum(p.stat().st_size for p in parts) < sum(map(len, texts)) / 3
    assert len({t.splitlines()[0] for t in texts}) == 1 and sum(len(t.splitlines()) - 1 for t in texts) == 2000
    read = files.read_clean_csv(spark, str(tmp_path), FACT_SCHEMA.fieldNames())
    assert read.exceptAll(given).isEmpty() and given.exceptAll(read).isEmpty()


def test_plain_text_of_an_earlier_load_is_read(spark, tmp_path):
    given = some_fact(spark, [1, 2, 3])
    P.publish(str(tmp_path), {"clean": P.Part(given, format="csv", options=files.CSV)})
    assert rows(files.read_clean_csv(spark, str(tmp_path), FACT_SCHEMA.fieldNames())) == rows(given)


def test_keys_survive_a_reload(spark):
    """The same extract in another order, in other files and with more copies."""
    lines = [{"item_identifier": f"I{i % 9}", "item_weight": "" if i % 4 == 0 else f"{i}.5", "sales": f"{i}.25", "outlet_size": "" if i % 5 else "High"} for i in range(60)]
    first, again = cleaning.clean(raw(spark, *lines)), cleaning.clean(raw(spark, *lines[::-1], *lines[:20]).repartition(7))
    keep = [c for c in FACT_SCHEMA.fieldNames()]
    assert rows(first.select(keep)) == rows(again.select(keep))
    assert first.select("sale_id").distinct().count() == 60
    # A row added elsewhere changes what is filled in, not the keys.
    more = cleaning.clean(raw(spark, *lines, {"item_identifier": "I0", "item_weight": "99"}))
    assert {r.sale_id for r in first.collect()} < {r.sale_id for r in more.collect()}
