"""Contract queries for the collect stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.dates import iso_utc, std_published
from ..functions.text import html_body, provider_domain
from ..operators import collect as C
from . import adapters as A
from .catalog import BODY_SQL, DOMAIN_SQL, ISO, PAD6, UUID_SQL, query
from .oracle_ctes import register, with_views

RUNK = ["topic_id", "aggregator_id"]


def collect_until(spark: SparkSession, sf: str, until: str) -> DataFrame:
    """The collect stage over all runs: arrivals are cut on events alone, then
    joined to what the filters read of their documents (never the text)."""
    arrivals = A.with_raw_dates(A.hit_events(spark, sf)).drop("published_dt")
    return C.collect(arrivals, A.runs(spark, sf), A.trusted(spark, sf), body="has_body", until=until,
                     attributes=lambda ev: A.with_documents(spark, sf, ev).drop("text"))


# ------------------------------------------------------------------ oracle
_DIGITS = {K.BING: 26, K.NEWSAPI_ORG: 19, K.THENEWSAPI_COM: 26}     # characters of the date that DuckDB reads
STD_SQL = "CASE " + " ".join(
    f"WHEN aggregator_id = '{a}' AND regexp_matches(raw_published, '{K.PUBLISHED_DATE_REGEX[a]}') "
    f"THEN TRY_CAST(replace(substr(raw_published, 1, {n}), 'T', ' ') AS TIMESTAMP)" for a, n in _DIGITS.items()) + " END"


def register_collect(p: str, hits: str) -> None:
    """The collect stage as views ``p``_paged .. ``p``_w4 over a hits view."""
    register(f"{p}_paged", (hits, "runs"), f"""
SELECT q.*, (arrival_rank - 1) // 100 AS page FROM (
  SELECT h.event_id, h.doc_id, h.topic_id, h.aggregator_id, h.url, h.provider_domain, h.title, h.text AS body,
         CASE WHEN strpos(h.text, chr(10)) > 0 THEN split_part(h.text, chr(10), 2) ELSE '' END AS description,
         h.raw_published, r.topic, r.start_dt, r.end_dt, r.max_results,
         row_number() OVER (PARTITION BY h.topic_id, h.aggregator_id ORDER BY h.event_id) AS arrival_rank
  FROM {hits} h JOIN runs r ON h.topic_id = r.topic_id AND h.aggregator_id = r.aggregator_id) q""")
    register(f"{p}_marked", (f"{p}_paged",), f"""
SELECT *, dated AND row_number() OVER (PARTITION BY topic_id, aggregator_id, url, dated ORDER BY arrival_rank) = 1 AS is_new
FROM (SELECT *, raw_published IS NOT NULL AND raw_published <> '' AS dated FROM {p}_paged) x""")
    register(f"{p}_w2", (f"{p}_marked",), f"""
SELECT *, min(CASE WHEN new_in_page = 0 THEN page END) OVER (PARTITION BY topic_id, aggregator_id) AS stop_page
FROM (SELECT *, sum(CAST(is_new AS INTEGER)) OVER (PARTITION BY topic_id, aggregator_id, page) AS new_in_page FROM {p}_marked) x""")
    register(f"{p}_w3", (f"{p}_w2",), f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY topic_id, aggregator_id ORDER BY arrival_rank) AS candidate_rank
  FROM {p}_w2 WHERE is_new AND (stop_page IS NULL OR page < stop_page)) x
WHERE candidate_rank <= max_results * 2""")
    register(f"{p}_f2", (f"{p}_w3",), f"""
SELECT * FROM (SELECT *, {STD_SQL} AS published_dt FROM {p}_w3) x
WHERE published_dt BETWEEN start_dt AND end_dt""")
    register(f"{p}_f3", (f"{p}_f2",),  f"SELECT * FROM {p}_f2 WHERE body IS NOT NULL AND length(body) > 0")
    register(f"{p}_f4", (f"{p}_f3",), f"""
SELECT * FROM {p}_f3 WHERE aggregator_id NOT IN ('newsapi.org', 'thenewsapi.com')
   OR (description IS NOT NULL AND length(description) > 0)""")
    register(f"{p}_j2", (f"{p}_f4", "trusted"), f"""
SELECT * FROM {p}_f4 c WHERE c.aggregator_id NOT IN ('newsapi.org', 'thenewsapi.com')
   OR c.provider_domain IN (SELECT provider_domain FROM trusted WHERE language = 'en' AND is_active)""")
    register(f"{p}_w4", (f"{p}_j2",), f"""
SELECT *, {PAD6('aggregation_index')} || '#' || {UUID_SQL('topic_id', 'aggregator_id', 'start_dt', 'url')} AS article_id
FROM (SELECT *, row_number() OVER (PARTITION BY topic_id, aggregator_id ORDER BY arrival_rank) - 1 AS aggregation_index
      FROM {p}_j2) x
WHERE aggregation_index < max_results""")


register_collect("c", "raw_hits")


def rows_sql(view: str, extra: str = "") -> str:
    return with_views(f"SELECT topic_id, aggregator_id, event_id, url{extra} FROM {view}", view)


# ------------------------------------------------------------------ queries
@query("fn_std_published", with_views(
    f"SELECT event_id, aggregator_id, raw_published, {ISO(STD_SQL)} AS published FROM raw_hits", "raw_hits"))
def fn_std_published(spark, sf):
    """Vendor date strings (three forms, blanks, malformed) -> UTC timestamps."""
    h = A.raw_hits(spark, sf)
    return h.select("event_id", "aggregator_id", "raw_published",
                    iso_utc(std_published(F.col("raw_published"), F.col("aggregator_id"))).alias("published"))


@query("flt_undated", with_views(
    "SELECT event_id, topic_id, aggregator_id, raw_published FROM raw_hits "
    "WHERE raw_published IS NOT NULL AND raw_published <> ''", "raw_hits"))
def flt_undated(spark, sf):
    """rows without a published date are dropped before dedup."""
    return C.flt_undated(A.raw_hits(spark, sf)).select("event_id", "topic_id", "aggregator_id", "raw_published")


@query("win_url_dedup", with_views(
    "SELECT topic_id, aggregator_id, url, min(event_id) AS first_event_id, count(*) AS n_seen FROM raw_hits "
    "WHERE raw_published IS NOT NULL AND raw_published <> '' GROUP BY topic_id, aggregator_id, url",
    "raw_hits"))
def win_url_dedup(spark, sf):
    """First dated occurrence of every URL within its run (whole runs)."""
    return C.url_first_seen(A.raw_hits(spark, sf))


@query("win_page_stop", with_views("""
SELECT topic_id, aggregator_id, count(DISTINCT page) AS n_pages, min(stop_page) AS stop_page,
       count(*) FILTER (WHERE is_new AND (stop_page IS NULL OR page < stop_page)) AS n_new_before_stop
FROM c_w2 GROUP BY topic_id, aggregator_id""", "c_w2"))
def win_page_stop(spark, sf):
    """Per run, the first page without new rows and the rows before it."""
    return C.page_stops(A.raw_hits(spark, sf))


@query("win_fetch_cap", rows_sql("c_w3", ", page, candidate_rank"))
def win_fetch_cap(spark, sf):
    """First max_results x 2 unique rows per run."""
    return collect_until(spark, sf, "W3").select(*RUNK, "event_id", "url", "page",
                                                 F.col("candidate_rank").cast("long").alias("candidate_rank"))


@query("flt_window", rows_sql("c_f2", f", {ISO('published_dt')} AS published"))
def flt_window(spark, sf):
    """start <= published <= end (inclusive), malformed dates drop out."""
    return collect_until(spark, sf, "F2").select(*RUNK, "event_id", "url", iso_utc(F.col("published_dt")).alias("published"))


@query("flt_has_description", rows_sql("c_f4"))
def flt_has_description(spark, sf):
    """rows of newsapi.org / thenewsapi.com runs need a description."""
    return collect_until(spark, sf, "F4").select(*RUNK, "event_id", "url")


@query("join_trusted_semi", rows_sql("c_j2", ", provider_domain"))
def join_trusted_semi(spark, sf):
    """Rows of trust-checked aggregators need an active trusted provider."""
    return collect_until(spark, sf, "J2").select(*RUNK, "event_id", "url", "provider_domain")


@query("win_accept_cap", rows_sql("c_w4", f", aggregation_index, article_id, {ISO('published_dt')} AS published"))
def win_accept_cap(spark, sf):
    """Dense aggregation_index over accepted rows, first max_results per run."""
    return collect_until(spark, sf, "W4").select(*RUNK, "event_id", "url",
                                                 F.col("aggregation_index").cast("long").alias("aggregation_index"),
                                                 "article_id",
                                                 iso_utc(F.col("published_dt")).alias("published"))


@query("agg_run_summary", with_views(f"""
SELECT topic_id, aggregator_id, count(*) AS n_accepted, {ISO('min(published_dt)')} AS min_published,
       {ISO('max(published_dt)')} AS max_published FROM c_w4 GROUP BY topic_id, aggregator_id""", "c_w4"))
def agg_run_summary(spark, sf):
    """A1: per run, accepted count and min / max published."""
    from ..operators.aggregates import run_summary
    s = run_summary(collect_until(spark, sf, "W4"))
    return s.select(*RUNK, "n_accepted", iso_utc(F.col("min_published")).alias("min_published"),
                    iso_utc(F.col("max_published")).alias("max_published"))


@query("agg_store_paths", with_views("""
SELECT topic_id, aggregator_id, string_agg(DISTINCT p, ',' ORDER BY p) AS store_paths FROM (
  SELECT topic_id, aggregator_id, 'candidates/topic_id=' || topic_id || '/published_date=' ||
         strftime(published_dt, '%Y-%m-%d') AS p FROM c_w4) x
GROUP BY topic_id, aggregator_id""", "c_w4"))
def agg_store_paths(spark, sf):
    """A2: distinct output partitions of each run, comma-joined."""
    from ..operators.aggregates import store_paths
    return store_paths(collect_until(spark, sf, "W4"), "candidates")


@query("flt_has_body", f"""
SELECT page_id, provider_domain, length(body) AS body_chars FROM (
  SELECT page_id, {DOMAIN_SQL('url')} AS provider_domain, {BODY_SQL('html')} AS body FROM pages) p
WHERE body IS NOT NULL AND length(body) > 0""")
def flt_has_body(spark, sf):
    """pages whose extracted body is empty are dropped."""
    p = A.read(spark, sf, "pages")
    p = p.select("page_id", provider_domain(F.col("url")).alias("provider_domain"), html_body(F.col("html")).alias("body"))
    return C.flt_has_body(p).select("page_id", "provider_domain", F.length("body").cast("long").alias("body_chars"))
