"""Aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN = ["topic_id", "aggregator_id"]


def run_summary(accepted: DataFrame) -> DataFrame:
    """A1: per run accepted count, min and max published (null when empty)."""
    return accepted.groupBy(*RUN).agg(F.count(F.lit(1)).alias("n_accepted"),
                                      F.min("published_dt").alias("min_published"),
                                      F.max("published_dt").alias("max_published"))


def partition_path(base: str):
    return F.concat(F.lit(f"{base}/topic_id="), F.col("topic_id"), F.lit("/published_date="),
                    F.date_format("published_dt", "yyyy-MM-dd"))


def store_paths(accepted: DataFrame, base: str) -> DataFrame:
    """A2: distinct output partitions per run, sorted and comma-joined.

    Distinct first (partial aggregation), then one small set per run.
    """
    p = accepted.select(*RUN, partition_path(base).alias("p")).distinct()
    return p.groupBy(*RUN).agg(F.array_join(F.array_sort(F.collect_list("p")), ",").alias("store_paths"))
