"""Tables written once to the shared folder and read back by every later job.

A stage cuts lineage (a lost executor never re-runs the jobs before it), gives the
planner exact sizes, so a lookup is broadcast only when its files are small enough,
and lets later jobs read just the columns they need.
"""

from __future__ import annotations

import hashlib
import tempfile
import threading
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_written: set[str] = set()
_local_dirs: dict[str, str] = {}
_lock = threading.RLock()
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """Folder named by spark.checkpoint.dir; a temporary one only for a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="shelfwise-")
    return _local_dirs[context.applicationId]


def stage_path(spark: SparkSession, source: str, name: str) -> str:
    """One folder per application and source, so no run reads another run's tables."""
    tag = hashlib.md5(source.encode()).hexdigest()[:12]
    return f"{shared_dir(spark)}/shelfwise/{spark.sparkContext.applicationId}/{tag}/{name}"


def staged(spark: SparkSession, source: str, name: str) -> bool:
    """Whether this application has written the stage."""
    return stage_path(spark, source, name) in _written


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """What is written within leaves no shuffle files behind.

    Spark deletes them once the driver has collected its garbage. A driver whose tasks run elsewhere makes so little of it
    that the files of all stages would pile up on the executors' disks. A frame that another thread makes meanwhile
    shuffles anew if it is collected twice.
    """
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)


def stage(
    spark: SparkSession, source: str, name: str, build: Callable[[], DataFrame], partition_by: list[str] | None = None,
    figures: list[Column] | None = None, unstored: list[str] | None = None,
) -> DataFrame:
    """Write `build()` as Parquet on first use in this application, then read it.

    `figures` are aggregates that the writing tasks compute on the way; they are stored as one row, the
    stage `<name>_figures`. Columns that are `unstored` count there, but aren't written.
    """
    path = stage_path(spark, source, name)
    with _lock:
        if path not in _written:
            rows, seen = build(), Observation()
            kept = (rows.observe(seen, *figures) if figures else rows).drop(*unstored or [])
            with shuffles_dropped(spark):
                kept.write.mode("overwrite").partitionBy(*partition_by or []).parquet(path)
            if figures:
                found, schema = seen.get, rows.agg(*figures).schema
                row = spark.createDataFrame([tuple(found[c] for c in schema.fieldNames())], schema)
                row.coalesce(1).write.mode("overwrite").parquet(stage_path(spark, source, f"{name}_figures"))
            _written.add(path)
    return spark.read.parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """Store a step inside a report under a name of its own, then read it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/shelfwise/{spark.sparkContext.applicationId}/steps/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
