"""Helpers that the operators of this package share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
U64 = np.uint64
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from the repository's folder.

    On a cluster ship the package instead (``--py-files``); the entry is then
    a folder that does not exist there, which Python ignores.
    """
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *parts])
    # Whole texts make heavy rows: where the session has Spark's default of
    # 10,000 rows an Arrow batch, use fewer, so that workers stay small.
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, "1000")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a fresh one only for a local master."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    known = sc._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="ledgerflow-llm-", dir="/tmp")
    sc.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back, so
    that later steps neither repeat its work nor depend on one executor.

    ``tidy``: the shuffle files of this write go with its end, not with the
    driver's next collection of garbage; for a ``df`` that is not used again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    if tidy:
        spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if tidy:
            spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, schema: str, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]]) -> DataFrame:
    workers_import(df.sparkSession)
    return df.mapInArrow(fn, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A text column as Python strings; null counts as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that long texts stay cheap to hold."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def ascii_words(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


class WordHashes(dict):
    """64-bit hash of each word, remembered up to ``limit`` words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=U64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (shift, xor, multiply)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes, in order."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, U64)
    acc = np.full(n, size, U64)
    for j in range(size):
        acc = mix(acc + words[j:j + n]) if j == 0 else acc * U64(0x9E3779B97F4A7C15) + mix(words[j:j + n] + U64(j))
    return mix(acc)


def whole_row(df: DataFrame):
    """All columns as the struct ``row``, so that none clashes with a helper column; ``row.*`` gives them back."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def row_uid(id_col: str, text_col: str):
    """A 64-bit hash of a row's id and text."""
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))


def crc_mod(column: str, modulus: int):
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


#: Keys that hold more than one in so many rows are hot; there are fewer than that.
SHARE = 4096


def looked_up(rows: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """``rows`` (a stored table) left-joined with ``table``, whose ``key`` is unique.

    Keys with more than one in ``SHARE`` of the rows stay where their rows are:
    they are fewer than ``SHARE``, so their part of ``table`` can be sent to
    every task.  No task of the other join gets more of one key than that share."""
    total = rows.count()
    hot = F.broadcast(stored(rows.groupBy(key).agg(F.count("*").alias("rows")).where((F.col("rows") * SHARE > total) & F.col(key).isNotNull()).select(key), "hot-keys"))
    of_hot = F.broadcast(hot.join(table, key, "left"))
    return rows.join(of_hot, key).unionByName(rows.join(hot, key, "left_anti").join(table, key, "left"))
