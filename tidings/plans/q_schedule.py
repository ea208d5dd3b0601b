"""Contract queries for scheduling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import iso_utc
from ..operators import schedule as S
from ..operators.aggregates import run_summary
from . import adapters as A
from .catalog import ISO, query
from .oracle_ctes import register, with_views
from .q_collect import collect_until

TODAY_SQL = "TIMESTAMP '2024-01-31 00:00:00'"

register("pairs", ("topics", "aggregators"), """
SELECT t.*, a.aggregator_id FROM topics t JOIN aggregators a ON a.is_active WHERE t.is_active""")
register("windows", ("pairs", "watermarks", "aggregators"), f"""
SELECT p.topic_id, p.aggregator_id, p.topic, g.start_dt, g.start_dt + INTERVAL 1 DAY AS end_dt
FROM (SELECT p.*, coalesce(w.last_end, greatest({TODAY_SQL} - to_days(a.horizon_days), TIMESTAMP '2023-01-01 00:00:00')) AS first_start
      FROM pairs p LEFT JOIN watermarks w ON w.topic_id = p.topic_id AND w.aggregator_id = p.aggregator_id
      LEFT JOIN aggregators a ON a.aggregator_id = p.aggregator_id) p,
     LATERAL (SELECT unnest(generate_series(p.first_start, {TODAY_SQL}, INTERVAL 1 DAY)) AS start_dt) g
WHERE p.first_start <= {TODAY_SQL}""")


def windows(spark, sf):
    pairs = S.active_pairs(A.topics(spark, sf), A.aggregators(spark, sf))
    return S.fetch_windows(pairs, A.watermarks(spark, sf), A.aggregators(spark, sf), A.TODAY)


@query("join_topic_x_aggregator", with_views("SELECT topic_id, aggregator_id FROM pairs", "pairs"))
def join_topic_x_aggregator(spark, sf):
    """Every active topic with every active aggregator."""
    return S.active_pairs(A.topics(spark, sf), A.aggregators(spark, sf)).select("topic_id", "aggregator_id")


@query("flt_active", with_views("""
SELECT 'topic' AS kind, topic_id AS id FROM topics WHERE is_active
UNION ALL SELECT 'aggregator', aggregator_id FROM aggregators WHERE is_active
UNION ALL SELECT 'provider', provider_domain FROM trusted WHERE is_active""", "topics", "aggregators", "trusted"))
def flt_active(spark, sf):
    """active topics, aggregators and trusted providers."""
    t = A.topics(spark, sf).filter("is_active").select(F.lit("topic").alias("kind"), F.col("topic_id").alias("id"))
    a = A.aggregators(spark, sf).filter("is_active").select(F.lit("aggregator").alias("kind"), F.col("aggregator_id").alias("id"))
    p = A.trusted(spark, sf).filter("is_active").select(F.lit("provider").alias("kind"), F.col("provider_domain").alias("id"))
    return t.unionByName(a).unionByName(p)


@query("gen_fetch_windows", with_views(
    f"SELECT topic_id, aggregator_id, {ISO('start_dt')} AS start_dt, {ISO('end_dt')} AS end_dt FROM windows", "windows"))
def gen_fetch_windows(spark, sf):
    """1-day fetch windows per active (topic, aggregator) up to today."""
    w = windows(spark, sf)
    return w.select("topic_id", "aggregator_id", iso_utc(F.col("start_dt")).alias("start_dt"),
                    iso_utc(F.col("end_dt")).alias("end_dt"))


ISO_OFFSET = ("strftime({c}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime({c}, '%f') <> '000000' "
              "THEN '.' || strftime({c}, '%f') ELSE '' END || '+00:00'")


@query("gen_message_group", with_views(f"""
SELECT aggregator_id || '-' || topic_id AS message_group_id,
       '{{"topic_id":"' || topic_id || '","aggregator_id":"' || aggregator_id || '","aggregation_data_start_dt":"' ||
       {ISO_OFFSET.format(c='start_dt')} || '","aggregation_data_end_dt":"' || {ISO_OFFSET.format(c='end_dt')} || '"}}' AS message_body
FROM windows""", "windows"))
def gen_message_group(spark, sf):
    """Routing key and JSON body of every aggregation request."""
    return S.aggregation_messages(windows(spark, sf))


@query("fn_request_columns", with_views(f"""
SELECT topic_id, aggregator_id, replace(topic, ' ', '+') AS topic_query,
       strftime(start_dt, '%Y-%m-%dT%H:%M:%S') AS from_param, strftime(end_dt, '%Y-%m-%dT%H:%M:%S') AS to_param,
       CASE WHEN aggregator_id = 'bingnews' THEN
         CASE date_diff('day', start_dt, end_dt) WHEN 1 THEN 'Day' WHEN 7 THEN 'Week' WHEN 30 THEN 'Month' END END AS freshness,
       CASE WHEN aggregator_id = 'bingnews' THEN NULL ELSE
         (SELECT string_agg(DISTINCT provider_domain, ',' ORDER BY provider_domain) FROM trusted WHERE is_active AND language = 'en') END AS include_domains,
       CASE WHEN aggregator_id = 'bingnews' AND date_diff('day', start_dt, end_dt) NOT IN (1, 7, 30) THEN 'unsupported timeframe'
            WHEN (aggregator_id = 'newsapi.org' AND (SELECT count(DISTINCT provider_domain) FROM trusted WHERE is_active AND language = 'en') > 500)
              OR (aggregator_id = 'thenewsapi.com' AND (SELECT count(DISTINCT provider_domain) FROM trusted WHERE is_active AND language = 'en') > 50)
            THEN 'too many provider domains' END AS request_error
FROM windows""", "windows", "trusted"))
def fn_request_columns(spark, sf):
    """P5: per planned window the request parameters of its vendor."""
    from ..functions.requests import request_columns
    return request_columns(windows(spark, sf), A.trusted(spark, sf))


@query("agg_oldest_horizon", with_views(f"""
SELECT {ISO(f"min(greatest({TODAY_SQL} - to_days(horizon_days), TIMESTAMP '2023-01-01 00:00:00'))")} AS oldest
FROM aggregators WHERE is_active""", "aggregators"))
def agg_oldest_horizon(spark, sf):
    """Earliest supported publishing day over active aggregators."""
    o = S.oldest_horizon(A.aggregators(spark, sf), A.TODAY)
    return o.select(iso_utc(F.col("oldest")).alias("oldest"))


register("sourcing_dates", ("topics", "aggregators"), f"""
SELECT t.topic_id, g.sourcing_date FROM (
  SELECT t.*, CASE WHEN l <> {TODAY_SQL} THEN l + INTERVAL 1 DAY ELSE l END AS s FROM (
    SELECT *, date_trunc('day', coalesce(last_publishing_date,
        (SELECT min(greatest({TODAY_SQL} - to_days(horizon_days), TIMESTAMP '2023-01-01 00:00:00')) FROM aggregators WHERE is_active)
        - INTERVAL 1 DAY)) AS l
    FROM topics WHERE is_active) t) t,
  LATERAL (SELECT unnest(generate_series(t.s, {TODAY_SQL}, INTERVAL 1 DAY)) AS sourcing_date) g
WHERE t.s <= {TODAY_SQL}""")


def sourcing_dates(spark, sf):
    oldest = S.oldest_horizon(A.aggregators(spark, sf), A.TODAY).select("oldest").scalar()
    return S.sourcing_dates(A.topics(spark, sf), oldest, A.TODAY)


@query("gen_sourcing_dates", with_views(
    f"SELECT topic_id, {ISO('sourcing_date')} AS sourcing_date FROM sourcing_dates", "sourcing_dates"))
def gen_sourcing_dates(spark, sf):
    """Per active topic the days from its last publishing day to today."""
    d = sourcing_dates(spark, sf)
    return d.select("topic_id", iso_utc(F.col("sourcing_date")).alias("sourcing_date"))


register("marks", ("watermarks", "c_w4"), """
SELECT coalesce(o.topic_id, p.topic_id) AS topic_id, coalesce(o.aggregator_id, p.aggregator_id) AS aggregator_id,
       CASE WHEN o.last_end IS NULL THEN p.proposed_end WHEN p.proposed_end IS NULL THEN o.last_end
            ELSE greatest(o.last_end, p.proposed_end) END AS last_end,
       CASE WHEN p.proposed_end IS NOT NULL THEN TIMESTAMP '2024-01-31 00:00:00' END AS dt_last_aggregated
FROM watermarks o FULL OUTER JOIN (
  SELECT topic_id, aggregator_id, max(published_dt) AS proposed_end FROM c_w4
  WHERE year(published_dt) >= 2000 GROUP BY topic_id, aggregator_id) p
ON o.topic_id = p.topic_id AND o.aggregator_id = p.aggregator_id""")


def proposed_marks(spark, sf):
    s = run_summary(collect_until(spark, sf, "W4"))
    return s.select("topic_id", "aggregator_id", F.col("max_published").alias("proposed_end"))


@query("agg_high_watermark", with_views(
    f"SELECT topic_id, aggregator_id, {ISO('last_end')} AS last_end, {ISO('dt_last_aggregated')} AS dt_last_aggregated FROM marks",
    "marks"))
def agg_high_watermark(spark, sf):
    """last_end = greater of the stored mark and the run's newest article."""
    m = S.high_watermark(A.watermarks(spark, sf), proposed_marks(spark, sf), A.TODAY)
    return m.select("topic_id", "aggregator_id", iso_utc(F.col("last_end")).alias("last_end"),
                    iso_utc(F.col("dt_last_aggregated")).alias("dt_last_aggregated"))


@query("flt_watermark_sane", with_views(f"""
SELECT topic_id, aggregator_id, {ISO('proposed_end')} AS proposed_end FROM (
  SELECT topic_id, aggregator_id, max(published_dt) AS proposed_end FROM c_w4 GROUP BY topic_id, aggregator_id
  UNION ALL SELECT topic_id, aggregator_id, TIMESTAMP '0001-01-01 00:00:00' FROM runs WHERE aggregator_id = 'bingnews') x
WHERE year(proposed_end) >= 2000""", "c_w4", "runs"))
def flt_watermark_sane(spark, sf):
    """F8: proposed marks before year 2000 (empty-run sentinels) are ignored."""
    import datetime as dt
    p = proposed_marks(spark, sf)
    sentinel = A.runs(spark, sf).filter(F.col("aggregator_id") == "bingnews").select(
        "topic_id", "aggregator_id", F.lit(dt.datetime(1, 1, 1)).alias("proposed_end"))
    p = p.unionByName(sentinel).filter(F.year("proposed_end") >= 2000)
    return p.select("topic_id", "aggregator_id", iso_utc(F.col("proposed_end")).alias("proposed_end"))


@query("gen_sourcing_messages", with_views(f"""
SELECT topic_id AS message_group_id,
       '{{"topic_id":"' || topic_id || '","sourcing_date":"' || {ISO_OFFSET.format(c='sourcing_date')} ||
       '","daily_sourcing_frequency":1.0}}' AS message_body
FROM sourcing_dates""", "sourcing_dates"))
def gen_sourcing_messages(spark, sf):
    """G5 (sourcing side): routing key = topic, JSON body with the day and frequency."""
    from ..constants import DAILY_SOURCING_FREQUENCY
    return S.sourcing_messages(sourcing_dates(spark, sf), DAILY_SOURCING_FREQUENCY)
