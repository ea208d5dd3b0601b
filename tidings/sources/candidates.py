"""Candidate store: partitioned sink (S7), unsourced scan (S8), embeddings
sink (S9) and the is_sourced flag update (S12).

Layout: ``<path>/topic_id=<t>/published_date=<yyyy-MM-dd>/part-*.parquet``,
so reading one topic-day is partition pruning, not a scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .stores import append_new, read_table, staged

PARTITIONS = ["topic_id", "published_date"]


def store_candidates(accepted: DataFrame, path: str) -> None:
    """Add accepted articles under topic + published day, flagged
    unsourced. Articles that the store has already are not added again, so a
    rerun of a run changes nothing; only the topic-days of the new articles are
    looked at for that.
    """
    out = accepted.withColumn("published_date", F.to_date("published_dt")).withColumn("is_sourced", F.lit(False))
    out = out.withColumn("aggregation_run_id", F.concat_ws("/", "topic_id", "aggregator_id", F.col("start_dt").cast("string")))
    append_new(staged(out, "candidates-new"), path, PARTITIONS, ["article_id"])


def load_unsourced(spark: SparkSession, path: str, topic_id: str | None = None,
                   day: dt.date | None = None) -> DataFrame:
    """One topic-day (or all) of not-yet-sourced candidates; the topic and
    day predicates prune directories, is_sourced is pushed to Parquet."""
    df = read_table(spark, path)
    if topic_id is not None:
        df = df.filter(F.col("topic_id") == topic_id)
    if day is not None:
        df = df.filter(F.col("published_date") == F.lit(day))
    return df.filter(~F.col("is_sourced"))


def store_embeddings(vectors: DataFrame, path: str, embedding_type: str, model_name: str) -> None:
    """(article_id, embedding_type, embedding_model_name, embedding) rows."""
    (vectors.select("article_id", F.lit(embedding_type).alias("embedding_type"),
                    F.lit(model_name).alias("embedding_model_name"),
                    F.col("embedding").cast("array<float>").alias("embedding"))
     .write.mode("append").parquet(path))


def mark_sourced(spark: SparkSession, path: str, considered: DataFrame, key: str = "article_id") -> DataFrame:
    """Flag the whole considered inventory as sourced.

    Only the partitions that hold considered rows are rewritten (dynamic
    partition overwrite). The updated rows are checkpointed to the shared
    checkpoint folder first, so the overwrite never reads the files it is
    replacing and a lost executor can recompute from the checkpoint.
    """
    from ..session import checkpoint_dir

    checkpoint_dir(spark)
    store = read_table(spark, path)
    touched = considered.select(*PARTITIONS).distinct()
    affected = store.join(touched, PARTITIONS, "left_semi")
    flag = considered.select(*PARTITIONS, key, F.lit(True).alias("_considered")).distinct()
    updated = (affected.join(flag, [*PARTITIONS, key], "left")
               .withColumn("is_sourced", F.col("is_sourced") | F.coalesce(F.col("_considered"), F.lit(False)))
               .drop("_considered")).checkpoint(eager=True)
    (updated.select(*store.columns).repartitionByRange(*PARTITIONS, key).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(path))
    return read_table(spark, path)
