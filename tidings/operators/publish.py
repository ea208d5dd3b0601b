"""Validation, lookups, upserts and review."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import DOMAIN_CAP, NEEDS_TRUST

REQUIRED = ("topic_id", "aggregator_id", "start_dt", "end_dt")


def request_lookup(requests: DataFrame, topics: DataFrame, aggregators: DataFrame) -> DataFrame:
    """Request -> its topic and aggregator rows (null = not found)."""
    t = topics.select("topic_id", F.col("topic"), F.col("is_active").alias("topic_active"),
                      F.col("max_aggregator_results"))
    a = aggregators.select("aggregator_id", F.col("is_active").alias("aggregator_active"),
                           F.lit(True).alias("_agg_found"))
    return requests.join(t, "topic_id", "left").join(a, "aggregator_id", "left")


def validate_requests(requests: DataFrame, topics: DataFrame, aggregators: DataFrame,
                      trusted: DataFrame, language: str = "en") -> DataFrame:
    """ordered checks -> reject_reason (null = valid)."""
    j = request_lookup(requests, topics, aggregators)
    n_prov = trusted.filter((F.col("language") == language) & F.col("is_active")).select(
        F.count_distinct("provider_domain")).scalar()
    missing = None
    for c in REQUIRED:
        cond = F.col(c).isNull()
        missing = cond if missing is None else (missing | cond)
    trust_aggs = [a for a, v in NEEDS_TRUST.items() if v]
    cap = F.lit(None).cast("int")
    for a, n in DOMAIN_CAP.items():
        cap = F.when(F.col("aggregator_id") == a, F.lit(n)).otherwise(cap)
    reason = (F.when(missing, F.lit("missing field"))
              .when(F.col("_agg_found").isNull(), F.lit("unknown aggregator"))
              .when(~F.col("aggregator_active"), F.lit("inactive aggregator"))
              .when(F.col("topic_active").isNull(), F.lit("topic not found"))
              .when(~F.col("topic_active"), F.lit("inactive topic"))
              .when(F.col("aggregator_id").isin(*trust_aggs) & (n_prov == 0), F.lit("no trusted providers"))
              .when(cap.isNotNull() & (n_prov > cap), F.lit("too many provider domains"))
              .when(F.col("max_aggregator_results") <= 0, F.lit("max results not positive"))
              .when(F.col("sorting") == "date", F.lit("date sorting unsupported")))
    return j.withColumn("reject_reason", reason).drop("_agg_found")


def validate_sourcing_requests(requests: DataFrame, topics: DataFrame) -> DataFrame:
    """F6 for sourcing requests (topic_id, sourcing_date, daily_sourcing_frequency):
    ordered checks -> reject_reason, and top_k of the valid ones."""
    t = topics.select("topic_id", F.col("is_active").alias("topic_active"), "daily_publishing_limit")
    j = requests.join(t, "topic_id", "left")
    frequency = F.col("daily_sourcing_frequency")
    reason = (F.when(F.coalesce(F.col("topic_id"), F.lit("")) == "", F.lit("topic_id must be specified"))
              .when(F.col("sourcing_date").isNull(), F.lit("sourcing_date must be specified"))
              .when(F.coalesce(frequency, F.lit(0.0)) == 0, F.lit("daily_sourcing_frequency must be specified"))
              .when(F.col("topic_active").isNull(), F.lit("topic not found"))
              .when(~F.col("topic_active"), F.lit("inactive topic")))
    top_k = F.when(reason.isNull(), F.ceil(F.col("daily_publishing_limit") / F.nullif(frequency, F.lit(0.0)))).cast("long")
    return j.withColumns({"reject_reason": reason, "top_k": top_k})


def entity_checks(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """new topics are lower-cased, need a positive result cap, a 2-letter
    language and must not duplicate a stored topic or an earlier candidate."""
    c = candidates.withColumn("topic", F.lower(F.col("topic")))
    ex = existing.select(F.lower(F.col("topic")).alias("topic")).distinct().withColumn("_exists", F.lit(True))
    c = c.join(ex, "topic", "left")
    # first candidate per name by a grouped min (partial aggregation), so a
    # name repeated by a third of the batch is not ranked in one task
    first = c.groupBy("topic").agg(F.min("candidate_id").alias("_first"))
    c = c.join(first, "topic")
    reason = (F.when(F.length("language") != 2, F.lit("language must have 2 letters"))
              .when(F.col("max_aggregator_results") <= 0, F.lit("max results not positive"))
              .when(F.col("_exists").isNotNull(), F.lit("topic exists"))
              .when(F.col("candidate_id") != F.col("_first"), F.lit("duplicate in batch")))
    return c.withColumn("reject_reason", reason).drop("_exists", "_first")


def insert_if_absent(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Conditional insert, only keys not already present."""
    return table.unionByName(new.join(table.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def upsert(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Unconditional save: new rows replace rows with the same key."""
    return table.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def provider_sync(current: DataFrame, desired: DataFrame) -> DataFrame:
    """Desired provider list vs stored one -> NEW / REACTIVATE / KEEP / DEACTIVATE.

    Repeated desired domains are collapsed first (only the first would be
    inserted). Stored inactive rows that are not desired need no action.
    """
    d = desired.groupBy("language", "provider_domain").agg(F.min("provider_name").alias("provider_name"),
                                                           F.lit(True).alias("_desired"))
    c = current.select("language", "provider_domain", F.col("is_active").alias("_active"))
    j = d.join(c, ["language", "provider_domain"], "full_outer")
    action = (F.when(F.col("_desired") & F.col("_active").isNull(), F.lit("NEW"))
              .when(F.col("_desired") & ~F.col("_active"), F.lit("REACTIVATE"))
              .when(F.col("_desired") & F.col("_active"), F.lit("KEEP"))
              .when(F.col("_desired").isNull() & F.col("_active"), F.lit("DEACTIVATE")))
    return j.withColumn("action", action).filter(F.col("action").isNotNull()).select(
        "language", "provider_domain", "action")


def deactivated(current: DataFrame, desired: DataFrame) -> DataFrame:
    """G1: active stored domains that are no longer desired (set difference)."""
    a = current.filter(F.col("is_active")).select("language", "provider_domain")
    return a.exceptAll(desired.select("language", "provider_domain")).distinct()


def pending(sourced: DataFrame, topic_id: str | None = None) -> DataFrame:
    """articles still waiting for review (optionally one topic)."""
    p = sourced.filter(F.col("article_approval_status") == "PENDING")
    return p.filter(F.col("topic_id") == topic_id) if topic_id else p


def review_queue(pending_df: DataFrame) -> DataFrame:
    """Oldest first (dt_sourced, then id): a range-partitioned global
    sort, no single-partition window."""
    return pending_df.orderBy("dt_sourced", "sourced_article_id")


def with_topic_name(pending_df: DataFrame, topics: DataFrame) -> DataFrame:
    """Pending article -> topic name (lookup)."""
    t = topics.select("topic_id", F.col("topic").alias("topic_name"))
    return pending_df.join(t, "topic_id", "left")


def apply_decisions(pending_df: DataFrame, decisions: DataFrame, key: str = "doc_id") -> DataFrame:
    """PUBLISH -> APPROVED, REJECT -> REJECTED, SKIP / none -> PENDING."""
    j = pending_df.join(decisions.select(key, "decision"), key, "left")
    new = (F.when(F.col("decision") == "PUBLISH", F.lit("APPROVED"))
           .when(F.col("decision") == "REJECT", F.lit("REJECTED")).otherwise(F.lit("PENDING")))
    return j.withColumn("new_status", new).withColumn("decision", F.coalesce("decision", F.lit("SKIP")))


def daily_limit_reached(sourced: DataFrame, topics: DataFrame) -> DataFrame:
    """A3: APPROVED per (topic, day) >= the topic's daily limit -> flag."""
    a = sourced.groupBy("topic_id", "date_published").agg(
        F.count_if(F.col("article_approval_status") == "APPROVED").alias("n_approved"))
    t = topics.select("topic_id", "daily_publishing_limit")
    a = a.join(t, "topic_id", "left")
    return a.withColumn("limit_reached", F.col("n_approved") >= F.col("daily_publishing_limit"))


def published_upsert(counters: DataFrame, approvals: DataFrame) -> DataFrame:
    """Add one per approval to (topic, day) counters, creating absent ones."""
    add = approvals.groupBy("topic_id", "date_published").agg(F.count(F.lit(1)).alias("_add"))
    j = counters.join(add, ["topic_id", "date_published"], "full_outer")
    return j.select("topic_id", "date_published",
                    (F.coalesce("published_count", F.lit(0)) + F.coalesce("_add", F.lit(0))).alias("published_count"))


def last_publishing(topics: DataFrame, sourced_today: DataFrame, sourcing_date) -> DataFrame:
    """A5: topics that produced a sourced article get last_publishing_date =
    the sourcing date (even if earlier than the stored one); others keep theirs."""
    hit = sourced_today.select("topic_id").distinct().withColumn("_hit", F.lit(True))
    j = topics.join(hit, "topic_id", "left")
    return j.withColumn("last_publishing_date",
                        F.when(F.col("_hit"), F.lit(sourcing_date)).otherwise(F.col("last_publishing_date"))).drop("_hit")


def action_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts per sync action / review decision."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def metric_counts(df: DataFrame, name: str, dims: list[str]) -> DataFrame:
    """Count metric keyed by its dimension map (as sorted JSON)."""
    m = F.to_json(F.map_from_arrays(F.array(*[F.lit(d) for d in sorted(dims)]),
                                    F.array(*[F.col(d).cast("string") for d in sorted(dims)])))
    return df.groupBy(m.alias("dimensions")).agg(F.count(F.lit(1)).alias("value")).select(
        F.lit(name).alias("metric"), "dimensions", "value")


def published_counts(sourced: DataFrame, decisions: DataFrame, key: str = "doc_id") -> DataFrame:
    """A6 over a whole table in one pass: articles already approved plus
    pending ones whose decision approves them, per (topic, day)."""
    j = sourced.join(decisions.select(key, "decision"), key, "left")
    approved = F.col("article_approval_status") == "APPROVED"
    now = (F.col("article_approval_status") == "PENDING") & (F.col("decision") == "PUBLISH")
    return (j.groupBy("topic_id", "date_published").agg(F.count_if(approved | now).alias("published_count"))
            .filter("published_count > 0"))


def run_status(ledger: DataFrame) -> DataFrame:
    """Latest state of each run from an append-only ledger, and per
    aggregator the complete / failed counts and failure rate."""
    last = ledger.groupBy("run_id", "aggregator_id").agg(
        F.max(F.struct("event_time", "status"))["status"].alias("status"))   # ties: the later name
    return last.groupBy("aggregator_id").agg(
        F.count(F.lit(1)).alias("n_runs"), F.count_if(F.col("status") == "COMPLETE").alias("n_complete"),
        F.count_if(F.col("status") == "FAILED").alias("n_failed"),
        F.round(F.count_if(F.col("status") == "FAILED") / F.count(F.lit(1)), 6).alias("failure_rate"))


def observed(df: DataFrame, name: str, sums: list[str] | None = None, counts: dict[str, Column] | None = None):
    """A14 without an extra job: attach an ``Observation`` that counts the
    rows (sums the given columns, and counts the rows for which a condition of
    ``counts`` holds) flowing through ``df`` while the downstream action runs.
    Returns (df, observation); read ``observation.get`` after the action."""
    from pyspark.sql import Observation

    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")] + [F.sum(c).alias(f"sum_{c}") for c in (sums or [])]
    return df.observe(obs, *exprs, *[F.count_if(c).alias(k) for k, c in (counts or {}).items()]), obs


def observed_metrics(spark: SparkSession, name: str, observation, dimension: str | None = None) -> DataFrame:
    """The counts of one observation in the form of ``metric_counts``: its rows, or one row for each value of the
    dimension that was counted."""
    got = observation.get
    if dimension is None:
        rows = [(name, "{}", got["rows"])]
    else:
        rows = [(name, json.dumps({dimension: k}, separators=(",", ":")), v) for k, v in sorted(got.items()) if k != "rows"]
    return spark.createDataFrame(rows, "metric string, dimensions string, value long")
