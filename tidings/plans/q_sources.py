"""Contract queries for landed vendor responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import BING, NEWSAPI_ORG, THENEWSAPI_COM
from ..session import scratch_path
from ..sources import jsonl as JL
from ..sources import vendor as V
from . import adapters as A
from .catalog import UUID_SQL, query
from .landing import land, vendor_path
from .oracle_ctes import register, with_views
from .q_functions import VENDOR_CAT_SQL

register("paged_raw", ("raw_hits",), f"""
SELECT *, 'Topic ' || split_part(topic_id, '_', 2) AS topic, topic_id || '/' || aggregator_id || '/' || CAST(page AS VARCHAR) AS envelope_id,
       CASE WHEN strpos(text, chr(10)) > 0 THEN split_part(text, chr(10), 2) ELSE '' END AS description,
       CASE WHEN doc_id % 13 = 0 THEN NULL ELSE url END AS url_or_null,
       NULLIF(raw_published, '') AS date_or_null, {VENDOR_CAT_SQL} AS vendor_category, url || '/image' AS image,
       count(*) OVER (PARTITION BY topic_id, aggregator_id, page) AS total_results
FROM (SELECT *, (rn - 1) // 100 AS page, (rn - 1) % 100 AS pos FROM (
        SELECT *, row_number() OVER (PARTITION BY topic_id, aggregator_id ORDER BY event_id) AS rn FROM raw_hits) a) b""")


def _flat(spark, sf, vendor):
    env = V.read_envelopes(spark, vendor_path(land(spark, sf, vendor), vendor), vendor)
    data, _ = V.split_errors(env, vendor)
    return V.flatten(data, vendor)


def _data_sql(vendor: str, cols: str) -> str:
    return with_views(f"SELECT envelope_id, CAST(pos AS INTEGER) AS pos, {cols} FROM paged_raw "
                      f"WHERE aggregator_id = '{vendor}'", "paged_raw")


MISSING = "CASE WHEN url_or_null IS NULL THEN 'url' ELSE '' END AS missing_fields"


@query("src_bing_flatten", _data_sql(BING, f"""title, url_or_null AS url, description, date_or_null AS date_published,
    vendor_category AS category, source AS provider_name, source || '|via ' || lang AS providers, source || '|' || lang AS mentions,
    doc_id % 2 = 0 AS headline, CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 3 = 0 THEN image END AS thumbnail_url,
    CASE WHEN doc_id % 3 = 0 THEN 90::BIGINT END AS thumbnail_height, CASE WHEN doc_id % 3 = 0 THEN 120::BIGINT END AS thumbnail_width,
    CASE WHEN doc_id % 5 = 0 THEN title END AS video_name, CASE WHEN doc_id % 5 = 0 THEN image END AS video_thumbnail_url,
    CASE WHEN doc_id % 5 = 0 THEN url END AS video_motion_thumbnail_url, total_results, topic AS original_query,
    CASE WHEN page % 2 = 0 THEN topic || ' news' END AS altered_query, CASE WHEN doc_id % 7 = 0 THEN url END AS clustered_url,
    CASE WHEN doc_id % 7 = 0 THEN lang END AS clustered_inner_title, {MISSING}"""))
def src_bing_flatten(spark, sf):
    """Landed Bing envelopes -> one row per article (snake_case)."""
    f = _flat(spark, sf, BING)
    return f.select("envelope_id", "pos", "title", "url", "description", "date_published", "category", "provider_name",
                    F.array_join("providers", "|").alias("providers"), F.array_join("mentions", "|").alias("mentions"), "headline", "id",
                    "thumbnail_url", "thumbnail_height", "thumbnail_width", "video_name", "video_thumbnail_url",
                    "video_motion_thumbnail_url", "total_results", "original_query", "altered_query",
                    F.try_variant_get("clustered_articles", "$[0].url", "string").alias("clustered_url"),
                    F.try_variant_get("clustered_articles", "$[0].clusteredArticles[0].name", "string").alias("clustered_inner_title"),
                    "missing_fields")


@query("src_bing_related", with_views("""
SELECT envelope_id, 0 AS topic_pos, topic AS related_topic, 'https://search/' || topic AS web_search_url, 0 AS pos, title, url, description
FROM paged_raw WHERE aggregator_id = 'bingnews' AND page % 2 = 0 AND pos = 0""", "paged_raw"))
def src_bing_related(spark, sf):
    """The news of related topics, from variant columns."""
    env = V.read_envelopes(spark, vendor_path(land(spark, sf, BING), BING), BING)
    r = V.related_articles(V.split_errors(env, BING)[0])
    return r.select("envelope_id", "topic_pos", "related_topic", "web_search_url", "pos", "title", "url", "description")


@query("src_newsapi_flatten", _data_sql(NEWSAPI_ORG, f"""title, url_or_null AS url, description,
    date_or_null AS published_at, CASE WHEN doc_id % 2 = 0 THEN source END AS source_id, source AS source_name,
    CASE WHEN doc_id % 3 = 0 THEN lang ELSE '' END AS author, substr(text, 1, 200) AS content,
    CASE WHEN doc_id % 3 = 0 THEN image END AS url_to_image, total_results,
    CASE WHEN url_or_null IS NULL AND date_or_null IS NULL THEN 'url,publishedAt' WHEN url_or_null IS NULL THEN 'url'
         WHEN date_or_null IS NULL THEN 'publishedAt' ELSE '' END AS missing_fields"""))
def src_newsapi_flatten(spark, sf):
    """Landed NewsAPI.org envelopes -> one row per article."""
    f = _flat(spark, sf, NEWSAPI_ORG)
    return f.select("envelope_id", "pos", "title", "url", "description", "published_at", "source_id", "source_name", "author",
                    "content", "url_to_image", "total_results", "missing_fields")


@query("src_thenewsapi_flatten", _data_sql(THENEWSAPI_COM, f"""title, url_or_null AS url, description,
    date_or_null AS published_at, provider_domain AS source, vendor_category AS categories,
    {UUID_SQL('event_id')} AS uuid, substr(text, 1, 60) AS snippet, lang || ', news' AS keywords, image AS image_url, lang AS language,
    CASE WHEN doc_id % 2 = 0 THEN (doc_id % 7) / CAST(2 AS DOUBLE) END AS relevance_score, 'us' AS locale, total_results,
    CASE WHEN url_or_null IS NULL AND date_or_null IS NULL THEN 'url,published_at' WHEN url_or_null IS NULL THEN 'url'
         WHEN date_or_null IS NULL THEN 'published_at' ELSE '' END AS missing_fields"""))
def src_thenewsapi_flatten(spark, sf):
    """S3: landed TheNewsAPI envelopes -> one row per article."""
    f = _flat(spark, sf, THENEWSAPI_COM)
    return f.select("envelope_id", "pos", "title", "url", "description", "published_at", "source",
                    F.array_join("categories", ",").alias("categories"), "uuid", "snippet", "keywords", "image_url", "language",
                    "relevance_score", "locale", "total_results", "missing_fields")


CUT = """'{"envelope_id":"' || envelope_id || '","value":[{'"""
LACKING = "CASE aggregator_id WHEN 'bingnews' THEN 'value' WHEN 'newsapi.org' THEN 'status,totalResults,articles' ELSE 'meta,data' END"


@query("src_error_split", with_views(f"""
SELECT envelope_id, aggregator_id AS vendor,
  CASE aggregator_id WHEN 'bingnews' THEN 'RateLimitExceeded' WHEN 'newsapi.org' THEN 'rateLimited'
       ELSE 'rate_limit_reached' END AS error_code, 'rate limit exceeded' AS error_message
FROM (SELECT DISTINCT envelope_id, aggregator_id, page FROM paged_raw) p WHERE page % 4 = 3
UNION ALL SELECT NULL, aggregator_id, 'malformed_json', {CUT} FROM (SELECT DISTINCT envelope_id, aggregator_id, page FROM paged_raw) p WHERE page % 3 = 0
UNION ALL SELECT envelope_id, aggregator_id, 'missing_fields', {LACKING} FROM (SELECT DISTINCT envelope_id, aggregator_id, page FROM paged_raw) p WHERE page % 5 = 0""", "paged_raw"))
def src_error_split(spark, sf):
    """What is no data, with its reason; with the data envelopes that is every line read."""
    path = land(spark, sf)
    out = None
    for vendor in (BING, NEWSAPI_ORG, THENEWSAPI_COM):
        _, q = V.split_errors(V.read_envelopes(spark, vendor_path(path, vendor), vendor), vendor)
        q = q.withColumn("envelope_id", F.when(F.col("error_code") != "malformed_json", F.col("envelope_id")))
        out = q if out is None else out.unionByName(q)
    return out


@query("src_required_fields", with_views(f"""
SELECT aggregator_id AS vendor, envelope_id, CAST(pos AS INTEGER) AS pos,
  CASE WHEN aggregator_id = 'bingnews' THEN 'url'
       WHEN aggregator_id = 'newsapi.org' THEN CASE WHEN url_or_null IS NULL AND date_or_null IS NULL THEN 'url,publishedAt'
                                                    WHEN url_or_null IS NULL THEN 'url' ELSE 'publishedAt' END
       ELSE CASE WHEN url_or_null IS NULL AND date_or_null IS NULL THEN 'url,published_at'
                 WHEN url_or_null IS NULL THEN 'url' ELSE 'published_at' END END AS missing_fields
FROM paged_raw WHERE (url_or_null IS NULL OR (aggregator_id <> 'bingnews' AND date_or_null IS NULL))
UNION ALL SELECT DISTINCT aggregator_id, envelope_id, NULL::INTEGER, {LACKING} FROM paged_raw WHERE page % 5 = 0""", "paged_raw"))
def src_required_fields(spark, sf):
    """Articles and envelopes (no pos) that miss a required field, with the field names."""
    path = land(spark, sf)
    out = None
    for vendor in (BING, NEWSAPI_ORG, THENEWSAPI_COM):
        env = V.read_envelopes(spark, vendor_path(path, vendor), vendor)
        data, q = V.split_errors(env, vendor)
        _, bad = V.valid_articles(V.flatten(data, vendor))
        b = bad.select(F.lit(vendor).alias("vendor"), "envelope_id", "pos", "missing_fields").unionByName(
            q.filter("error_code = 'missing_fields'").select("vendor", "envelope_id", F.lit(None).cast("int").alias("pos"),
                                                             F.col("error_message").alias("missing_fields")))
        out = b if out is None else out.unionByName(b)
    return out


@query("src_commented_jsonl", with_views(
    "SELECT provider_domain AS domain, provider_name, country FROM trusted", "trusted"))
def src_commented_jsonl(spark, sf):
    """Provider list as JSON lines with comments and blank lines."""
    t = A.trusted(spark, sf)
    body = F.to_json(F.struct(F.col("provider_domain").alias("domain"), "provider_name", "country"))
    lines = t.select(F.explode(F.array(
        body, F.concat(F.lit("// provider "), F.col("provider_name")), F.lit(""),
        F.concat(F.lit("   # "), F.col("provider_domain")))).alias("value"))
    path = scratch_path(spark, "providers")
    lines.write.mode("overwrite").text(path)
    return JL.read_commented_jsonl(spark, path, JL.PROVIDER_SCHEMA)
