"""Tables that a load replaces as a whole, without a moment in which readers find a hole.

A load writes its tables to a folder of its own beside the published ones, counts and checks them, and
only then adds one small record that names the folder. Readers follow the last record. So a load that
fails, at whatever point, leaves the tables of the load before it as they are, and a load that is
repeated gives readers the same rows once. Nothing is renamed or overwritten, which object stores
can't do in one step.

    <root>/data/<load>/<table>/...      the files
    <root>/loads/...                    a record per published load

One load of a root runs at a time.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

#: Tables of a load that are written at the same time; small ones don't fill a cluster.
WRITERS = 4
RECORD = "number bigint, load string, tables array<struct<name:string,format:string,rows:bigint,schema:string>>"


class Rejected(Exception):
    """A table broke a rule, so its load wasn't published."""


@dataclass
class Part:
    """A table of a load. A rule counts the rows it holds for; more than the tolerated share of the rows reject the load."""

    rows: DataFrame
    partition_by: list[str] = field(default_factory=list)
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    rules: dict[str, Column] = field(default_factory=dict)
    tolerated: float = 0.0


def _records(spark: SparkSession, root: str) -> list:
    """The published loads, the last one first; a record per load."""
    try:
        return spark.read.schema(RECORD).json(f"{root}/loads").orderBy(F.desc("number")).collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def _write(part: Part, path: str) -> tuple[int, dict[str, int]]:
    """Write a table; its rows and the rows per broken rule, counted by the tasks that write."""
    seen = Observation()
    counted = part.rows.observe(
        seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(wrong, F.lit(False))).alias(f"rule {k}") for k, wrong in enumerate(part.rules.values())])
    counted.write.partitionBy(*part.partition_by).format(part.format).options(**part.options).save(path)
    found = seen.get
    return found["rows"], {name: found[f"rule {k}"] for k, name in enumerate(part.rules)}


def _open(spark: SparkSession, root: str, load: str, name: str, kind: str, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    stored = spark.read.format(kind).options(**options).schema(schema).load(f"{root}/data/{load}/{name}")
    return stored.select(schema.fieldNames())


def publish(root: str, parts: dict[str, Part]) -> str:
    """Write the tables, check them, and make them the published ones; the name of the load.

    Raises `Rejected` if too many rows break a rule, or if a table that is read back has other rows than were
    written.
    """
    spark = next(iter(parts.values())).rows.sparkSession
    load, tables, broken, stored = uuid.uuid4().hex, [], [], []
    with ThreadPoolExecutor(WRITERS) as pool:
        counts = list(pool.map(lambda name: _write(parts[name], f"{root}/data/{load}/{name}"), parts))
    for (name, part), (rows, bad) in zip(parts.items(), counts):
        broken += [f"{name}, {rule}: {count} rows of {rows}" for rule, count in bad.items() if count > part.tolerated * rows]
        tables.append((name, part.format, rows, part.rows.schema.json()))
        back = _open(spark, root, load, name, part.format, part.rows.schema, part.options)
        stored.append(back.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows")))
    back = {r["name"]: r["rows"] for r in reduce(DataFrame.unionAll, stored).collect()}
    broken += [f"{name}: {rows} rows written, {back[name]} stored" for name, _, rows, _ in tables if back[name] != rows]
    if broken:
        raise Rejected("; ".join(broken))
    last = _records(spark, root)
    record = spark.createDataFrame([(last[0]["number"] + 1 if last else 1, load, tables)], RECORD)
    record.coalesce(1).write.mode("append").json(f"{root}/loads")
    return load


def published_all(spark: SparkSession, root: str, options: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The tables of the last published load by name, with the types they were written with; none before the first."""
    return {
        table["name"]: _open(spark, root, record["load"], table["name"], table["format"], T.StructType.fromJson(json.loads(table["schema"])), options or {})
        for record in _records(spark, root)[:1] for table in record["tables"]}


def published(
    spark: SparkSession, root: str, name: str, options: dict[str, str] | None = None, types: T.StructType | None = None,
) -> DataFrame:
    """A table of the last published load, with the types it was written with or those given."""
    for record in _records(spark, root)[:1]:
        for table in record["tables"]:
            if table["name"] == name:
                schema = types or T.StructType.fromJson(json.loads(table["schema"]))
                return _open(spark, root, record["load"], name, table["format"], schema, options or {})
    raise LookupError(f"no table {name} is published under {root}")


def names(spark: SparkSession, root: str) -> list[str]:
    """The tables of the last published load."""
    return [table["name"] for record in _records(spark, root)[:1] for table in record["tables"]]


def retire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the files of all published loads but the last `keep`; their names.

    Files of a load that failed, or that is running, have no record and stay.
    """
    old = [record["load"] for record in _records(spark, root)[max(keep, 1):]]
    hadoop = spark._jvm.org.apache.hadoop.fs
    for load in old:
        folder = hadoop.Path(f"{root}/data/{load}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return old
