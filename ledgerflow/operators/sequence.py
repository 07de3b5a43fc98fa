"""Order-dependent window primitives that stay bounded per task.

A spreadsheet sheet (or a study) may hold a large share of all rows, so a
``Window.partitionBy(sheet).orderBy(row)`` would push that whole sheet
through one task.  Both primitives here split the order into buckets of at
most ``bucket_size`` rows, run the window inside each bucket, and fix the
bucket boundaries with a small per-bucket table (one row per bucket).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.operators.allocate import join_null_safe
from ledgerflow.operators.keys import dense_sequence

DEFAULT_BUCKET = 1_000_000

__all__ = ["DEFAULT_BUCKET", "dense_sequence", "fill_forward", "largest_group", "one_bucket", "row_bucket", "small_groups", "with_copies"]


def row_bucket(order_col: str | Column, bucket_size: int = DEFAULT_BUCKET) -> Column:
    c = F.col(order_col) if isinstance(order_col, str) else order_col
    return F.floor(c / F.lit(bucket_size))


def one_bucket(df: DataFrame, order_col: str, bucket_size: int = DEFAULT_BUCKET) -> bool:
    """Whether all rows are in one bucket of the order, so that no boundary has
    to be mended.  Runs a scan for the least and largest value: ``df`` should be
    a stored table, or narrow steps over one."""
    b = row_bucket(order_col, bucket_size)
    low, high, unknown = df.agg(F.min(b), F.max(b), F.max(F.col(order_col).isNull())).first()
    return low == high and not unknown


def largest_group(df: DataFrame, key: str) -> int:
    """Rows of the largest group of ``key``."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def small_groups(df: DataFrame, key: str, bucket_size: int = DEFAULT_BUCKET) -> bool:
    """Whether no group of ``key`` has more rows than a bucket: its rows can be one task's."""
    return largest_group(df, key) <= bucket_size


COPY_BLOCK = 10_000


def with_copies(df: DataFrame, n_col: str, out_col: str, block: int = COPY_BLOCK) -> DataFrame:
    """One row per copy 1..n of each row.  Rows are first multiplied by blocks
    of copies, so no array is longer than ``block`` or n / ``block``."""
    blocks = F.sequence(F.lit(0), F.floor((F.col(n_col) - 1) / F.lit(block)).cast("int"))
    rows = df.withColumn("__block", F.explode(blocks))
    last = F.least(F.lit(block), F.col(n_col) - F.col("__block") * block).cast("int")
    inside = F.explode(F.sequence(F.lit(1), last))
    return rows.withColumn(out_col, inside).withColumn(out_col, F.col("__block") * block + F.col(out_col)).drop("__block")


def fill_forward(df: DataFrame, *, partition_cols: Sequence[str], order_col: str, value_col: str,
                 out_col: str, bucket_size: int = DEFAULT_BUCKET, nulls: bool = True, single: bool = False) -> DataFrame:
    """Last non-NULL ``value_col`` at or before each row, per partition
    (``nulls=False``: partition and order columns are never NULL).

    Inside a bucket a running ``last(ignorenulls)`` window; across buckets
    the last value of every earlier bucket, carried by a window over the
    per-bucket table.  ``single``: a partition has no more rows than a bucket
    (``one_bucket``, ``small_groups``), and nothing to carry.
    """
    p = list(partition_cols)
    b = "__ff_bucket"
    rows = df.withColumn(b, row_bucket(order_col, bucket_size))
    running = Window.partitionBy(*p, *([] if single else [b])).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("__ff_local", F.last(value_col, ignorenulls=True).over(running))
    if single:
        return local.withColumnRenamed("__ff_local", out_col).drop(b)
    per_bucket = (rows.groupBy(*p, b)
                  .agg(F.max_by(value_col, F.when(F.col(value_col).isNotNull(), F.col(order_col)))
                       .alias("__ff_last")))
    before = Window.partitionBy(*p).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.withColumn("__ff_in", F.last("__ff_last", ignorenulls=True).over(before)).drop("__ff_last")
    return (join_null_safe(local, carry, p + [b], "left", nulls)
            .withColumn(out_col, F.coalesce("__ff_local", "__ff_in"))
            .drop("__ff_local", "__ff_in", b))
