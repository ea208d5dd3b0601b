"""The run ledger, a table of aggregation runs: save if absent, then
update with the outcome. Each step gives the new table; runs are one row each."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .publish import insert_if_absent

RUN = ["topic_id", "aggregator_id"]
RUNNING, COMPLETE, FAILED = "RUNNING", "COMPLETE", "FAILED"


def start_runs(ledger: DataFrame | None, runs: DataFrame, now: dt.datetime) -> DataFrame:
    """One RUNNING row per run, named by topic, aggregator and window; a run
    that the ledger has already is left as it is."""
    new = runs.select(
        F.concat_ws("/", *RUN, F.col("start_dt").cast("string")).alias("run_id"), *RUN,
        F.col("start_dt").alias("data_start"), F.col("end_dt").alias("data_end"), F.lit(RUNNING).alias("run_status"),
        F.lit(now).alias("execution_start"), F.lit(None).cast("timestamp").alias("execution_end"),
        F.lit(None).cast("long").alias("articles_count"), F.lit(None).cast("map<string,string>").alias("articles_ref"))
    return new if ledger is None else insert_if_absent(ledger, new, ["run_id"])


def finish_runs(ledger: DataFrame, outcomes: DataFrame, now: dt.datetime) -> DataFrame:
    """Updates the RUNNING rows that ``outcomes`` (run_id, min_published,
    max_published, n_accepted, store_paths, error) names: COMPLETE with the
    data's start and end, count and result map, or FAILED where it has an error."""
    o = outcomes.select("run_id", "min_published", "max_published", "n_accepted", "store_paths",
                        F.col("error").alias("_error"), F.lit(True).alias("_done"))
    j = ledger.join(o, "run_id", "left")
    done = F.coalesce(F.col("_done"), F.lit(False)) & (F.col("run_status") == RUNNING)
    good = done & F.col("_error").isNull()
    ref = F.create_map(F.lit("type"), F.lit("parquet"), F.lit("paths"), F.coalesce("store_paths", F.lit("")))
    new = {"data_start": F.when(good, F.coalesce("min_published", "data_start")).otherwise(F.col("data_start")),
           "data_end": F.when(good, F.coalesce("max_published", "data_end")).otherwise(F.col("data_end")),
           "run_status": F.when(good, F.lit(COMPLETE)).when(done, F.lit(FAILED)).otherwise(F.col("run_status")),
           "execution_end": F.when(done, F.lit(now)).otherwise(F.col("execution_end")),
           "articles_count": F.when(good, F.coalesce("n_accepted", F.lit(0))).otherwise(F.col("articles_count")),
           "articles_ref": F.when(good, ref).otherwise(F.col("articles_ref"))}
    return j.select(*[new[c].alias(c) if c in new else c for c in ledger.columns])
