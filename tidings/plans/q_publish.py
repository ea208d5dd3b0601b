"""Contract queries for validation, lookups, upserts and review
(F6, F7, F9, J3-J8, A3, A5-A7, A14, A15, G1, G6, W8)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.dates import iso_utc
from ..operators import publish as P
from . import adapters as A
from .catalog import ISO, query
from .oracle_ctes import register, with_views

register("validated", ("requests", "topics", "aggregators", "trusted"), """
SELECT r.*, CASE
  WHEN r.topic_id IS NULL OR r.aggregator_id IS NULL OR r.start_dt IS NULL OR r.end_dt IS NULL THEN 'missing field'
  WHEN a.aggregator_id IS NULL THEN 'unknown aggregator'
  WHEN NOT a.is_active THEN 'inactive aggregator'
  WHEN t.topic_id IS NULL THEN 'topic not found'
  WHEN NOT t.is_active THEN 'inactive topic'
  WHEN r.aggregator_id IN ('newsapi.org', 'thenewsapi.com') AND (SELECT count(DISTINCT provider_domain) FROM trusted WHERE language = 'en' AND is_active) = 0 THEN 'no trusted providers'
  WHEN (r.aggregator_id = 'newsapi.org' AND (SELECT count(DISTINCT provider_domain) FROM trusted WHERE language = 'en' AND is_active) > 500)
    OR (r.aggregator_id = 'thenewsapi.com' AND (SELECT count(DISTINCT provider_domain) FROM trusted WHERE language = 'en' AND is_active) > 50) THEN 'too many provider domains'
  WHEN t.max_aggregator_results <= 0 THEN 'max results not positive'
  WHEN r.sorting = 'date' THEN 'date sorting unsupported' END AS reject_reason,
  t.topic, t.is_active AS topic_active, a.is_active AS aggregator_active
FROM requests r LEFT JOIN topics t ON t.topic_id = r.topic_id LEFT JOIN aggregators a ON a.aggregator_id = r.aggregator_id""")


def validated(spark, sf):
    return P.validate_requests(A.requests(spark, sf), A.topics(spark, sf), A.aggregators(spark, sf),
                               A.trusted(spark, sf))


@query("flt_request_valid", with_views("SELECT topic_id, aggregator_id, reject_reason FROM validated", "validated"))
def flt_request_valid(spark, sf):
    """every request with its first failing check (null = valid)."""
    return validated(spark, sf).select("topic_id", "aggregator_id", "reject_reason")


@query("flt_sourcing_request_valid", with_views("""
SELECT request_id, CASE WHEN coalesce(r.topic_id, '') = '' THEN 'topic_id must be specified'
  WHEN sourcing_date IS NULL THEN 'sourcing_date must be specified'
  WHEN coalesce(frequency, 0) = 0 THEN 'daily_sourcing_frequency must be specified'
  WHEN t.topic_id IS NULL THEN 'topic not found' WHEN NOT t.is_active THEN 'inactive topic' END AS reject_reason,
  CASE WHEN coalesce(r.topic_id, '') <> '' AND sourcing_date IS NOT NULL AND coalesce(frequency, 0) <> 0 AND t.is_active
       THEN CAST(ceil(t.daily_publishing_limit / frequency) AS BIGINT) END AS top_k
FROM (SELECT event_id AS request_id, CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 13 <> 0 THEN 'topic_' || CAST(user_id % 10 AS VARCHAR) END AS topic_id,
             CASE WHEN event_id % 7 <> 0 THEN ts END AS sourcing_date,
             CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN CAST(0 AS DOUBLE) ELSE (event_id % 5) / CAST(2 AS DOUBLE) END AS frequency FROM events) r
LEFT JOIN topics t ON t.topic_id = r.topic_id""", "topics"))
def flt_sourcing_request_valid(spark, sf):
    """F6, sourcing side: one request per event with missing fields, unknown
    and inactive topics; valid ones get their top_k."""
    n = F.col("event_id")
    topic = F.when(n % 11 == 0, F.lit("")).when(n % 13 != 0, F.concat(F.lit("topic_"), (F.col("user_id") % 10).cast("string")))
    frequency = F.when(n % 5 == 0, F.lit(None)).when(n % 5 == 1, F.lit(0.0)).otherwise((n % 5) / 2)
    r = A.read(spark, sf, "events").select(n.alias("request_id"), topic.alias("topic_id"),
                                           F.when(n % 7 != 0, F.col("ts")).alias("sourcing_date"),
                                           frequency.cast("double").alias("daily_sourcing_frequency"))
    return P.validate_sourcing_requests(r, A.topics(spark, sf)).select("request_id", "reject_reason", "top_k")


@query("join_request_lookup", with_views(
    "SELECT topic_id, aggregator_id, topic, topic_active, aggregator_active FROM validated", "validated"))
def join_request_lookup(spark, sf):
    """Request -> topic and aggregator (null = not found)."""
    j = P.request_lookup(A.requests(spark, sf), A.topics(spark, sf), A.aggregators(spark, sf))
    return j.select("topic_id", "aggregator_id", "topic", "topic_active", "aggregator_active")


register("topic_candidates", (), """
SELECT source AS candidate_id, 'Topic ' || CAST(n % 10 AS VARCHAR) AS topic, CAST(n - 1 AS INTEGER) AS max_aggregator_results,
       CASE WHEN n = 19 THEN 'eng' ELSE 'en' END AS language
FROM (SELECT DISTINCT source, CAST(regexp_extract(source, '^src([0-9]+)$', 1) AS INTEGER) AS n FROM documents
      WHERE regexp_extract(source, '^src([0-9]+)$', 1) <> '') s""")


def topic_candidates(spark, sf):
    d = A.read(spark, sf, "documents")
    num = F.regexp_extract("source", r"^src([0-9]+)$", 1)
    s = d.select("source", num.alias("ns")).distinct().filter(F.length("ns") > 0)
    n = F.col("ns").try_cast("int")
    return s.select(F.col("source").alias("candidate_id"), F.concat(F.lit("Topic "), (n % 10).cast("string")).alias("topic"),
                    (n - 1).cast("int").alias("max_aggregator_results"),
                    F.when(n == 19, F.lit("eng")).otherwise(F.lit("en")).alias("language"))


@query("flt_entity_valid", with_views("""
SELECT candidate_id, lower(c.topic) AS topic, CASE
  WHEN length(language) <> 2 THEN 'language must have 2 letters'
  WHEN max_aggregator_results <= 0 THEN 'max results not positive'
  WHEN lower(c.topic) IN (SELECT lower(topic) FROM topics) THEN 'topic exists'
  WHEN row_number() OVER (PARTITION BY lower(c.topic) ORDER BY candidate_id) > 1 THEN 'duplicate in batch' END AS reject_reason
FROM topic_candidates c""", "topic_candidates", "topics"))
def flt_entity_valid(spark, sf):
    """candidate topics lower-cased and checked (cap, language, duplicates)."""
    c = P.entity_checks(topic_candidates(spark, sf), A.topics(spark, sf))
    return c.select("candidate_id", "topic", "reject_reason")


@query("join_insert_if_absent", with_views("""
SELECT topic_id, topic FROM topics
UNION ALL SELECT r.topic_id, 'Topic ' || split_part(r.topic_id, '_', 2) FROM (SELECT DISTINCT topic_id FROM requests) r
WHERE r.topic_id NOT IN (SELECT topic_id FROM topics)""", "topics", "requests"))
def join_insert_if_absent(spark, sf):
    """Topics named in requests are inserted only when absent."""
    new = A.requests(spark, sf).select("topic_id").distinct().select(
        "topic_id", A.topic_name(F.col("topic_id")).alias("topic"))
    return P.insert_if_absent(A.topics(spark, sf).select("topic_id", "topic"), new, ["topic_id"])


@query("join_upsert_dimension", with_views("""
SELECT topic_id, daily_publishing_limit FROM topics WHERE topic_id NOT IN (SELECT DISTINCT topic_id FROM requests)
UNION ALL SELECT topic_id, CAST(10 AS INTEGER) FROM (SELECT DISTINCT topic_id FROM requests) r""", "topics", "requests"))
def join_upsert_dimension(spark, sf):
    """Requested topics are saved unconditionally (replace or insert)."""
    new = A.requests(spark, sf).select("topic_id").distinct().select(
        "topic_id", F.lit(10).cast("int").alias("daily_publishing_limit"))
    return P.upsert(A.topics(spark, sf).select("topic_id", "daily_publishing_limit"), new, ["topic_id"])


register("sync", ("trusted", "desired"), """
SELECT coalesce(d.language, c.language) AS language, coalesce(d.provider_domain, c.provider_domain) AS provider_domain,
  CASE WHEN d.provider_domain IS NOT NULL AND c.provider_domain IS NULL THEN 'NEW'
       WHEN d.provider_domain IS NOT NULL AND NOT c.is_active THEN 'REACTIVATE'
       WHEN d.provider_domain IS NOT NULL AND c.is_active THEN 'KEEP'
       WHEN d.provider_domain IS NULL AND c.is_active THEN 'DEACTIVATE' END AS action
FROM (SELECT DISTINCT language, provider_domain FROM desired) d
FULL OUTER JOIN trusted c ON c.language = d.language AND c.provider_domain = d.provider_domain""")


@query("join_provider_sync", with_views("SELECT * FROM sync WHERE action IS NOT NULL", "sync"))
def join_provider_sync(spark, sf):
    """Desired vs stored providers -> NEW / REACTIVATE / KEEP / DEACTIVATE."""
    return P.provider_sync(A.trusted(spark, sf), A.desired_providers(spark, sf))


@query("agg_sync_summary", with_views(
    "SELECT action, count(*) AS n FROM sync WHERE action IS NOT NULL GROUP BY action", "sync"))
def agg_sync_summary(spark, sf):
    """Number of providers per sync action."""
    return P.action_counts(P.provider_sync(A.trusted(spark, sf), A.desired_providers(spark, sf)), "action")


@query("set_deactivated", with_views("""
SELECT language, provider_domain FROM trusted WHERE is_active
EXCEPT SELECT language, provider_domain FROM desired""", "trusted", "desired"))
def set_deactivated(spark, sf):
    """G1: active stored domains minus desired domains."""
    return P.deactivated(A.trusted(spark, sf), A.desired_providers(spark, sf))


PENDING_COLS = "topic_id, sourced_article_id, doc_id"


@query("flt_pending", with_views(
    f"SELECT {PENDING_COLS}, {ISO('dt_sourced')} AS dt_sourced FROM sourced WHERE article_approval_status = 'PENDING'",
    "sourced"))
def flt_pending(spark, sf):
    """sourced articles with approval status PENDING."""
    p = P.pending(A.sourced(spark, sf))
    return p.select("topic_id", "sourced_article_id", "doc_id", iso_utc(F.col("dt_sourced")).alias("dt_sourced"))


@query("win_review_queue", with_views(
    f"SELECT {PENDING_COLS}, {ISO('dt_sourced')} AS dt_sourced FROM sourced WHERE article_approval_status = 'PENDING' "
    "ORDER BY dt_sourced, sourced_article_id", "sourced"))
def win_review_queue(spark, sf):
    """Pending articles, oldest first."""
    q = P.review_queue(P.pending(A.sourced(spark, sf)))
    return q.select("topic_id", "sourced_article_id", "doc_id", iso_utc(F.col("dt_sourced")).alias("dt_sourced"))


@query("join_review_topic", with_views("""
SELECT s.sourced_article_id, s.topic_id, t.topic AS topic_name FROM sourced s LEFT JOIN topics t ON t.topic_id = s.topic_id
WHERE s.article_approval_status = 'PENDING'""", "sourced", "topics"))
def join_review_topic(spark, sf):
    """Pending article -> topic name."""
    j = P.with_topic_name(P.pending(A.sourced(spark, sf)), A.topics(spark, sf))
    return j.select("sourced_article_id", "topic_id", "topic_name")


register("reviewed", ("sourced", "decisions"), """
SELECT s.*, coalesce(d.decision, 'SKIP') AS decision,
       CASE d.decision WHEN 'PUBLISH' THEN 'APPROVED' WHEN 'REJECT' THEN 'REJECTED' ELSE 'PENDING' END AS new_status
FROM sourced s LEFT JOIN decisions d ON d.doc_id = s.doc_id WHERE s.article_approval_status = 'PENDING'""")


def reviewed(spark, sf):
    return P.apply_decisions(P.pending(A.sourced(spark, sf)), A.decisions(spark, sf))


@query("join_apply_decisions", with_views(
    "SELECT sourced_article_id, decision, new_status FROM reviewed", "reviewed"))
def join_apply_decisions(spark, sf):
    """Review decisions applied to pending articles."""
    return reviewed(spark, sf).select("sourced_article_id", "decision", "new_status")


@query("agg_review_summary", with_views(
    "SELECT decision, count(*) AS n FROM reviewed GROUP BY decision", "reviewed"))
def agg_review_summary(spark, sf):
    """A7 (review side): number of articles per decision."""
    return P.action_counts(reviewed(spark, sf), "decision")


@query("agg_published_upsert", with_views("""
SELECT coalesce(c.topic_id, a.topic_id) AS topic_id, coalesce(c.date_published, a.date_published) AS date_published,
       coalesce(c.published_count, 0) + coalesce(a.n, 0) AS published_count
FROM (SELECT topic_id, date_published, count(*) AS published_count FROM sourced
      WHERE article_approval_status = 'APPROVED' GROUP BY topic_id, date_published) c
FULL OUTER JOIN (SELECT topic_id, date_published, count(*) AS n FROM reviewed WHERE new_status = 'APPROVED'
                 GROUP BY topic_id, date_published) a
ON a.topic_id = c.topic_id AND a.date_published = c.date_published""", "sourced", "reviewed"))
def agg_published_upsert(spark, sf):
    """Published counters per (topic, day) plus one per new approval."""
    return P.published_counts(A.sourced(spark, sf), A.decisions(spark, sf))


@query("agg_daily_limit", with_views("""
SELECT s.topic_id, s.date_published, count(*) FILTER (WHERE article_approval_status = 'APPROVED') AS n_approved,
       t.daily_publishing_limit,
       count(*) FILTER (WHERE article_approval_status = 'APPROVED') >= t.daily_publishing_limit AS limit_reached
FROM sourced s LEFT JOIN topics t ON t.topic_id = s.topic_id GROUP BY s.topic_id, s.date_published, t.daily_publishing_limit""",
    "sourced", "topics"))
def agg_daily_limit(spark, sf):
    """A3: APPROVED per (topic, day) compared with the topic's daily limit."""
    return P.daily_limit_reached(A.sourced(spark, sf), A.topics(spark, sf))


@query("agg_last_publishing", with_views(f"""
SELECT topic_id, {ISO("CASE WHEN topic_id IN (SELECT topic_id FROM sourced WHERE date_published = '2024/01/30') THEN TIMESTAMP '2024-01-30 00:00:00' ELSE last_publishing_date END")} AS last_publishing_date
FROM topics""", "topics", "sourced"))
def agg_last_publishing(spark, sf):
    """A5: topics that sourced an article on the sourcing day get that day."""
    s = A.sourced(spark, sf).filter(F.col("date_published") == "2024/01/30")
    t = P.last_publishing(A.topics(spark, sf), s, dt.datetime(2024, 1, 30))
    return t.select("topic_id", iso_utc(F.col("last_publishing_date")).alias("last_publishing_date"))


@query("agg_metric_counts", with_views("""
SELECT 'hits' AS metric, '{"aggregator_id":"' || aggregator_id || '","topic_id":"' || topic_id || '"}' AS dimensions,
       count(*) AS value FROM hits GROUP BY aggregator_id, topic_id""", "hits"))
def agg_metric_counts(spark, sf):
    """A count metric keyed by its dimension map."""
    return P.metric_counts(A.hits(spark, sf), "hits", ["topic_id", "aggregator_id"])


register("ledger", ("validated",), """
SELECT topic_id || '/' || aggregator_id AS run_id, aggregator_id, 'RUNNING' AS status, start_dt AS event_time FROM validated
UNION ALL SELECT topic_id || '/' || aggregator_id, aggregator_id,
  CASE WHEN reject_reason IS NULL THEN 'COMPLETE' ELSE 'FAILED' END, start_dt + INTERVAL 1 SECOND FROM validated""")


def ledger(spark, sf):
    v = validated(spark, sf)
    run_id = F.concat_ws("/", "topic_id", "aggregator_id")
    a = v.select(run_id.alias("run_id"), "aggregator_id", F.lit("RUNNING").alias("status"),
                 F.col("start_dt").alias("event_time"))
    b = v.select(run_id.alias("run_id"), "aggregator_id",
                 F.when(F.col("reject_reason").isNull(), F.lit("COMPLETE")).otherwise(F.lit("FAILED")).alias("status"),
                 (F.col("start_dt") + F.expr("INTERVAL 1 SECOND")).alias("event_time"))
    return a.unionByName(b)


@query("agg_run_status", with_views("""
SELECT aggregator_id, count(*) AS n_runs, count(*) FILTER (WHERE status = 'COMPLETE') AS n_complete,
       count(*) FILTER (WHERE status = 'FAILED') AS n_failed,
       round(count(*) FILTER (WHERE status = 'FAILED') / count(*), 6) AS failure_rate
FROM (SELECT run_id, aggregator_id, arg_max(status, event_time) AS status FROM ledger GROUP BY run_id, aggregator_id) l
GROUP BY aggregator_id""", "ledger"))
def agg_run_status(spark, sf):
    """Latest state per run from the ledger, failure rate per aggregator."""
    return P.run_status(ledger(spark, sf))


@query("set_replace_users", """
SELECT CAST(user_id AS VARCHAR) AS user_id, 'user ' || CAST(user_id AS VARCHAR) AS name
FROM (SELECT DISTINCT user_id FROM events) u""")
def set_replace_users(spark, sf):
    """The preview-user table replaced as a whole (after F7-style checks)."""
    from ..sources.tables import replace_table
    from ..session import scratch_path
    users = A.read(spark, sf, "events").select(F.col("user_id").cast("string").alias("user_id")).distinct()
    users = users.select("user_id", F.concat(F.lit("user "), F.col("user_id")).alias("name"))
    path = scratch_path(spark, "users")
    return replace_table(spark, users, path, key="user_id")
