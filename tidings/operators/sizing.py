"""Exact ranks within hot partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_WIDTH = 1 << 16


def _bucket(order: str, bucket_width: int):
    return F.floor(F.col(order) / F.lit(bucket_width)).cast("long")


def bucket_offsets(df: DataFrame, part: list[str], order: str, bucket_width: int = BUCKET_WIDTH) -> DataFrame:
    """(part, _bucket, _offset): how many rows of the partition stand before
    each bucket of the order key. A grouped count, then a running sum over counts."""
    counts = df.groupBy(*part, _bucket(order, bucket_width).alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy(*part).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_offset", F.coalesce(F.sum("_n").over(run), F.lit(0))).drop("_n")


def rank_within(df: DataFrame, part: list[str], order: str, bucket_width: int = BUCKET_WIDTH,
                name: str = "rank", offsets: DataFrame | None = None) -> DataFrame:
    """Exact 1-based row_number() over (partition by ``part`` order by
    ``order``) for a numeric, unique-per-partition order key, without
    sending a whole partition to one task.

    Rows are bucketed by ``order // bucket_width`` and row_number only runs
    inside (partition, bucket), on top of the bucket's offset. A partition
    holding a third of all rows is therefore split across many tasks.
    ``offsets`` may be some of ``bucket_offsets``, with columns of its own: rows
    of other buckets go, and the columns are attached.
    """
    offsets = bucket_offsets(df, part, order, bucket_width) if offsets is None else offsets
    j = df.withColumn("_bucket", _bucket(order, bucket_width)).join(offsets, [*part, "_bucket"])
    w = Window.partitionBy(*part, "_bucket").orderBy(order)
    return j.withColumn(name, F.col("_offset") + F.row_number().over(w)).drop("_bucket", "_offset")
