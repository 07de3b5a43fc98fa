"""Stage boundaries written as parquet tables in the shared checkpoint folder.

A pipeline stage whose output feeds several consumers (or whose lineage is
long) is written once and read back: the write survives executor loss (task
retry), later stages replay from the written table instead of the scans,
and the re-read keeps filter pushdown and column pruning, which an RDD
checkpoint would lose.  The folder is the session's ``spark.checkpoint.dir``
(a shared path on a cluster); never a machine-local temporary folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import ensure_checkpoint_dir


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@contextmanager
def shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a write run inside go with its end, not with the
    driver's next collection of garbage."""
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


def stage_path(df: DataFrame, name: str) -> str:
    root = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    return f"{root}/ledgerflow-stages/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, *, partition_by: list[str] | None = None) -> DataFrame:
    path = stage_path(df, name)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffle_files_removed(df.sparkSession):
        writer.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Rows that one task of a dealt table holds, on average, where that gives more tasks than the session asks for.
ROWS_PER_TASK = 250_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // ROWS_PER_TASK)


def materialize_dealt(df: DataFrame, name: str, key: str, tasks: int | None = None) -> DataFrame:
    """``materialize`` in buckets of ``key``: Spark's planner knows them, so steps
    by that key alone or with others read the table without dealing its rows
    again.  ``df`` should come dealt by ``key`` over as many ``tasks``; unless
    given it is the number of the dealt table that ``df`` was made from."""
    tasks = tasks or df.schema[key].metadata.get("dealt") or tasks_for(df.sparkSession, 0)
    path = stage_path(df, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    with shuffle_files_removed(df.sparkSession):
        (df.withMetadata(key, {"dealt": tasks}).write.option("compression", "zstd").option("path", path)
         .bucketBy(tasks, key).saveAsTable(table))
    return df.sparkSession.table(table)


@contextmanager
def joins_by_part_of_keys(spark: SparkSession) -> Iterator[None]:
    """Joins by a dealt key and others read dealt tables as they are (else Spark
    deals both sides by all keys); for jobs run inside, then put back."""
    with _setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        yield


def is_dealt(df: DataFrame, key: str) -> bool:
    """Whether ``df`` was made from a table that is dealt by ``key``."""
    return "dealt" in df.schema[key].metadata


def stored_as_dealt(df: DataFrame, name: str, key: str) -> DataFrame:
    """``df``, made from a table dealt by ``key``, stored in its buckets; joins by
    the key and others in it deal no rows."""
    with joins_by_part_of_keys(df.sparkSession):
        return materialize_dealt(df, name, key)


def by_dealt_key(frames: Sequence[DataFrame], name: str, key: str, step: Callable[..., DataFrame], most: int) -> DataFrame | None:
    """``step`` of tables dealt by ``key``, stored in buckets again, without
    dealing their rows: ``step(*frames, known=(key,))`` gets the rows that have a
    key, and must keep a key's rows together.  Rows without one take
    ``step(*frames, known=())``.  None where the first table is not dealt, or
    has more than ``most`` rows of one key."""
    tasks = frames[0].schema[key].metadata.get("dealt")
    if not tasks:
        return None
    sizes = frames[0].groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    largest, missing = sizes.agg(F.max(F.when(F.col(key).isNotNull(), F.col("n"))), F.max(F.col(key).isNull())).first()
    if (largest or 0) > most:
        return None
    out = step(*[f.filter(F.col(key).isNotNull()) for f in frames], known=(key,))
    if missing:
        out = out.unionByName(step(*[f.filter(F.col(key).isNull()) for f in frames], known=()))
    with joins_by_part_of_keys(out.sparkSession):
        return materialize_dealt(out, name, key, tasks)
