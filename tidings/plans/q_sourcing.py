"""Contract queries for the sourcing stage (S7-S9, S12, F10, G2, W5-W7,
W9, U4, A4, A9-A11, C5, C7, C8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions.dates import iso_utc
from ..operators import sourcing as SO
from ..session import scratch_path
from ..sources import candidates as CS
from ..sources.stores import read_table
from . import adapters as A
from .catalog import ISO, query
from .oracle_ctes import register, with_views
from .q_collect import collect_until

TOPIC_DAY_C = ["topic_id", "day"]

register("inventory", ("c_w4",), """
SELECT topic_id, aggregator_id, event_id, url, article_id, aggregation_index, published_dt,
       CAST(published_dt AS DATE) AS publishing_date FROM c_w4""")


def inventory(spark, sf):
    acc = collect_until(spark, sf, "W4")
    return SO.with_publishing_date(acc.select("topic_id", "aggregator_id", "start_dt", "event_id", "doc_id", "url", "article_id",
                                              "aggregation_index", "published_dt", "title", "provider_domain"))


register("cluster_members", ("c_w4",), """
SELECT w.topic_id, CAST(CAST(w.published_dt AS DATE) AS VARCHAR) AS day, e.label AS cluster, w.event_id AS member_idx, w.article_id, w.url,
       w.provider_domain, w.title, w.body AS text, 'n/a' AS category, w.published_dt, e.embedding
FROM c_w4 w JOIN embeddings e ON e.vec_id = w.doc_id""")


def cluster_members(spark, sf):
    """The accepted inventory joined to the vectors of its documents: what a
    topic and day is clustered from (the stored label stands for the cluster)."""
    inv = inventory(spark, sf).select("topic_id", F.col("publishing_date").cast("string").alias("day"), "event_id", "doc_id",
                                      "article_id", "url", "provider_domain", "title", "published_dt")
    e = A.read(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding", F.col("label").alias("cluster"))
    return inv.join(e, "doc_id").withColumnRenamed("event_id", "member_idx").withColumn("category", F.lit("n/a"))


def with_texts(spark, sf, members):
    """Adds the members' document texts."""
    return members.join(A.read(spark, sf, "documents").select("doc_id", "text"), "doc_id")


def stored(spark, sf):
    path = scratch_path(spark, "candidates")
    CS.store_candidates(inventory(spark, sf).drop("publishing_date"), path)
    return path


@query("sink_candidates", with_views(
    "SELECT topic_id, CAST(publishing_date AS VARCHAR) AS published_date, article_id, url, FALSE AS is_sourced "
    "FROM inventory", "inventory"))
def sink_candidates(spark, sf):
    """Accepted articles written under topic / published day and read back."""
    path = stored(spark, sf)
    d = read_table(spark, path)
    return d.select("topic_id", F.col("published_date").cast("string").alias("published_date"), "article_id", "url",
                    "is_sourced")


def marked(spark, sf):
    path = stored(spark, sf)
    inv = CS.load_unsourced(spark, path)
    considered = SO.sourceable(inv.withColumnRenamed("published_date", "publishing_date")).withColumnRenamed(
        "publishing_date", "published_date")
    return CS.mark_sourced(spark, path, considered)


@query("sink_mark_sourced", with_views("""
SELECT topic_id, CAST(publishing_date AS VARCHAR) AS published_date, count(*) FILTER (WHERE n >= 6) AS n_sourced,
       count(*) FILTER (WHERE n < 6) AS n_unsourced
FROM (SELECT *, count(*) OVER (PARTITION BY topic_id, publishing_date) AS n FROM inventory) x
GROUP BY topic_id, publishing_date""", "inventory"))
def sink_mark_sourced(spark, sf):
    """Whole inventories that were sourced are flagged in the store."""
    d = marked(spark, sf)
    return d.groupBy("topic_id", F.col("published_date").cast("string").alias("published_date")).agg(
        F.count_if("is_sourced").alias("n_sourced"), F.count_if(~F.col("is_sourced")).alias("n_unsourced"))


@query("src_candidates_unsourced", with_views("""
SELECT topic_id, CAST(publishing_date AS VARCHAR) AS published_date, article_id FROM (
  SELECT *, count(*) OVER (PARTITION BY topic_id, publishing_date) AS n FROM inventory) x WHERE n < 6""", "inventory"))
def src_candidates_unsourced(spark, sf):
    """After sourcing, the unsourced (deferred) candidates still in the store."""
    path = stored(spark, sf)
    inv = CS.load_unsourced(spark, path)
    considered = SO.sourceable(inv.withColumnRenamed("published_date", "publishing_date")).withColumnRenamed(
        "publishing_date", "published_date")
    CS.mark_sourced(spark, path, considered)
    left = CS.load_unsourced(spark, path)
    return left.select("topic_id", F.col("published_date").cast("string").alias("published_date"), "article_id")


@query("sink_embeddings", """
SELECT 'vec-' || CAST(vec_id AS VARCHAR) AS article_id, 'title' AS embedding_type, 'fixture' AS embedding_model_name,
       len(embedding) AS dims FROM embeddings""")
def sink_embeddings(spark, sf):
    """Article vectors stored with their type and model, read back."""
    e = A.read(spark, sf, "embeddings").select(F.concat(F.lit("vec-"), F.col("vec_id").cast("string")).alias("article_id"),
                                              "embedding")
    path = scratch_path(spark, "embeddings")
    CS.store_embeddings(e, path, "title", "fixture")
    d = spark.read.parquet(path)
    return d.select("article_id", "embedding_type", "embedding_model_name", F.size("embedding").cast("long").alias("dims"))


@query("flt_inventory_min", with_views("""
SELECT topic_id, CAST(publishing_date AS VARCHAR) AS publishing_date, count(*) AS n_articles,
       CASE WHEN count(*) < 6 THEN 'DEFER' ELSE 'SOURCE' END AS status
FROM inventory GROUP BY topic_id, publishing_date""", "inventory"))
def flt_inventory_min(spark, sf):
    """topic-days with fewer than 6 unsourced articles are deferred."""
    s = SO.inventory_status(inventory(spark, sf))
    return s.select("topic_id", F.col("publishing_date").cast("string").alias("publishing_date"), "n_articles", "status")


RANK_SQL = {
    "relevance": "aggregation_index ASC, published_dt ASC, url ASC",
    "date": "published_dt DESC, url ASC",
}


def _rank_sql(name: str) -> str:
    return (f"SELECT topic_id, CAST(publishing_date AS VARCHAR) AS publishing_date, article_id, "
            f"row_number() OVER (PARTITION BY topic_id, publishing_date ORDER BY {RANK_SQL[name]}) AS inventory_rank "
            f"FROM inventory")


def _ranked(spark, sf, name):
    r = SO.rank_inventory(inventory(spark, sf), name)
    return r.select("topic_id", F.col("publishing_date").cast("string").alias("publishing_date"), "article_id",
                    F.col("inventory_rank").cast("long").alias("inventory_rank"))


@query("win_inventory_relevance", with_views(_rank_sql("relevance"), "inventory"))
def win_inventory_relevance(spark, sf):
    """Inventory by aggregation_index ascending (ties: published, url)."""
    return _ranked(spark, sf, "relevance")


@query("win_inventory_date", with_views(_rank_sql("date"), "inventory"))
def win_inventory_date(spark, sf):
    """Inventory newest first."""
    return _ranked(spark, sf, "date")


@query("udf_sort_spec", with_views(
    "SELECT 'relevance' AS sorting, * FROM (" + _rank_sql("relevance") + ") a UNION ALL SELECT 'date', * FROM ("
    + _rank_sql("date") + ") b", "inventory"))
def udf_sort_spec(spark, sf):
    """U4: the ranking chosen by name (relevance / date; others raise)."""
    names = (K.RELEVANCE_SORTING, K.DATE_SORTING)
    ranked = inventory(spark, sf)
    for name in names:      # both ranks on one inventory, then a row for each
        ranked = SO.rank_inventory(ranked, name).withColumnRenamed("inventory_rank", f"rank_{name}")
    each = F.array(*[F.struct(F.lit(n).alias("sorting"), F.col(f"rank_{n}").cast("long").alias("inventory_rank")) for n in names])
    ranked = ranked.select("topic_id", F.col("publishing_date").cast("string").alias("publishing_date"), "article_id",
                           F.explode(each).alias("r"))
    return ranked.select("r.sorting", "topic_id", "publishing_date", "article_id", "r.inventory_rank")


@query("set_union_sources", with_views("""
SELECT aggregator_id, event_id, CASE WHEN aggregator_id = 'bingnews' THEN NULL ELSE provider_domain END AS provider_domain,
       CASE WHEN aggregator_id = 'bingnews' THEN title END AS title FROM c_w4""", "c_w4"))
def set_union_sources(spark, sf):
    """Per-aggregator candidate frames (different columns) as one inventory."""
    path = scratch_path(spark, "accepted")      # collected once, read per aggregator
    collect_until(spark, sf, "W4").select("aggregator_id", "event_id", "title", "provider_domain").write.parquet(path)
    acc = spark.read.parquet(path)
    bing = acc.filter(F.col("aggregator_id") == K.BING).select("aggregator_id", "event_id", "title")
    n1 = acc.filter(F.col("aggregator_id") == K.NEWSAPI_ORG).select("aggregator_id", "event_id", "provider_domain")
    n2 = acc.filter(F.col("aggregator_id") == K.THENEWSAPI_COM).select("aggregator_id", "event_id", "provider_domain")
    return SO.union_sources(bing, n1, n2).select("aggregator_id", "event_id", "provider_domain", "title")


@query("win_cluster_topk", with_views("""
SELECT topic_id, day, cluster, size, cluster_rank FROM (
  SELECT s.*, t.daily_publishing_limit,
         row_number() OVER (PARTITION BY s.topic_id, s.day ORDER BY size DESC, min_idx ASC, cluster ASC) AS cluster_rank
  FROM (SELECT topic_id, day, cluster, count(*) AS size, min(member_idx) AS min_idx FROM cluster_members
        GROUP BY topic_id, day, cluster) s
  LEFT JOIN topics t ON t.topic_id = s.topic_id) x
WHERE cluster_rank <= ceil(daily_publishing_limit / 1.0)""", "cluster_members", "topics"))
def win_cluster_topk(spark, sf):
    """Largest clusters first, ceil(daily_limit / frequency) per topic-day."""
    m = cluster_members(spark, sf)
    s = SO.cluster_sizes(m, TOPIC_DAY_C)
    return SO.cluster_topk(s, A.topics(spark, sf), TOPIC_DAY_C, K.DAILY_SOURCING_FREQUENCY).select(
        *TOPIC_DAY_C, "cluster", "size", F.col("cluster_rank").cast("long").alias("cluster_rank"))


@query("agg_sourced_article", with_views(f"""
SELECT topic_id, day, cluster, {ISO('min(published_dt)')} AS dt_published,
       string_agg(article_id, ',' ORDER BY member_idx) AS source_article_ids,
       string_agg(url, ' ' ORDER BY member_idx) AS source_article_urls,
       string_agg(provider_domain, ' ' ORDER BY member_idx) AS source_article_provider_domains,
       md5(string_agg(title, chr(10) ORDER BY member_idx)) AS titles_md5,
       string_agg(category, ',' ORDER BY member_idx) AS source_article_categories
FROM cluster_members GROUP BY topic_id, day, cluster""", "cluster_members"))
def agg_sourced_article(spark, sf):
    """A4: cluster -> earliest published and the ordered member arrays."""
    m = cluster_members(spark, sf)
    a = SO.sourced_article(m, TOPIC_DAY_C)
    return a.select(*TOPIC_DAY_C, "cluster", iso_utc(F.col("dt_published")).alias("dt_published"),
                    F.array_join("source_article_ids", ",").alias("source_article_ids"),
                    F.array_join("source_article_urls", " ").alias("source_article_urls"),
                    F.array_join("source_article_provider_domains", " ").alias("source_article_provider_domains"),
                    F.md5(F.array_join("source_article_titles", "\n")).alias("titles_md5"),
                    F.array_join("source_article_categories", ",").alias("source_article_categories"))


@query("clu_group_members", with_views(
    "SELECT topic_id, day, cluster, string_agg(article_id, ',' ORDER BY member_idx) AS members FROM cluster_members "
    "GROUP BY topic_id, day, cluster", "cluster_members"))
def clu_group_members(spark, sf):
    """Labels -> ordered member lists."""
    g = SO.group_members(cluster_members(spark, sf), TOPIC_DAY_C)
    return g.select(*TOPIC_DAY_C, "cluster", F.array_join("members", ",").alias("members"))


@query("clu_stats", with_views("""
SELECT topic_id, day, count(*) AS n_clusters, string_agg(CAST(size AS VARCHAR), ',' ORDER BY size DESC) AS sizes
FROM (SELECT topic_id, day, cluster, count(*) AS size FROM cluster_members GROUP BY topic_id, day, cluster) s
GROUP BY topic_id, day""",
    "cluster_members"))
def clu_stats(spark, sf):
    """Cluster count and sizes (largest first) per topic."""
    return SO.cluster_stats(cluster_members(spark, sf), TOPIC_DAY_C)


@query("clu_embedding_check", """
SELECT doc_id AS vec_id, 'missing vector' AS violation, CAST(0 AS BIGINT) AS n_vectors FROM documents
WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)
UNION ALL SELECT vec_id, 'several vectors', count(*) FROM embeddings GROUP BY vec_id HAVING count(*) > 1""")
def clu_embedding_check(spark, sf):
    """Documents without a vector and ids with several vectors."""
    docs = A.read(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"))
    return SO.embedding_check(docs, A.read(spark, sf, "embeddings"), "vec_id")


@query("agg_embedding_mean", with_views("""
SELECT topic_id, day, cluster, CAST(g.i - 1 AS INTEGER) AS pos, round(avg(CAST(embedding[g.i] AS DOUBLE)), 6) AS value
FROM cluster_members, generate_series(1, 64) AS g(i)
GROUP BY topic_id, day, cluster, pos""", "cluster_members"))
def agg_embedding_mean(spark, sf):
    """Element-wise mean vector per (topic, cluster)."""
    m = SO.embedding_mean(cluster_members(spark, sf), [*TOPIC_DAY_C, "cluster"])
    return m.select(*TOPIC_DAY_C, "cluster", F.col("pos").cast("int").alias("pos"), F.round("value", 6).alias("value"))


@query("win_chunk_interleave", f"""
WITH toks AS (SELECT conv_id AS cluster, turn AS position, regexp_extract_all(text, '(\\s*\\S+)', 1) AS t FROM conversations),
chunks AS (SELECT cluster, position, CAST(g.k AS INTEGER) AS chunk_idx,
                  array_to_string(list_slice(t, g.k * {K.CHUNK_TOKENS} + 1, (g.k + 1) * {K.CHUNK_TOKENS}), '') AS chunk
           FROM toks, generate_series(0, (len(t) - 1) // {K.CHUNK_TOKENS}) AS g(k) WHERE len(t) > 0)
SELECT cluster, chunk_idx, count(*) AS n_parts, md5(string_agg(chunk, '{K.ARTICLE_SEPARATOR}' ORDER BY position)) AS doc_md5
FROM chunks GROUP BY cluster, chunk_idx""")
def win_chunk_interleave(spark, sf):
    """K-th chunks of a cluster's articles joined by the separator."""
    c = SO.chunk_interleave(A.cluster_texts(spark, sf))
    return c.select("cluster", "chunk_idx", F.col("n_parts").cast("long").alias("n_parts"), F.md5("doc").alias("doc_md5"))


@query("agg_token_stats", """
SELECT conv_id AS cluster, CAST(sum(n) AS BIGINT) AS total_tokens, round(avg(n), 6) AS avg_tokens, max(n) AS max_tokens
FROM (SELECT conv_id, len(regexp_extract_all(text, '(\\s*\\S+)', 1)) AS n FROM conversations) x GROUP BY conv_id""")
def agg_token_stats(spark, sf):
    """Per cluster total / mean / max tokens of its texts."""
    s = SO.token_stats(A.cluster_texts(spark, sf), ["cluster"])
    return s.select("cluster", F.col("total_tokens").cast("long").alias("total_tokens"), "avg_tokens",
                    F.col("max_tokens").cast("long").alias("max_tokens"))


@query("agg_embedding_cost", with_views("""
SELECT topic_id, CAST(publishing_date AS VARCHAR) AS publishing_date, CAST(sum(n) AS BIGINT) AS tokens, round(CAST(sum(n) AS DOUBLE) * CAST(0.0000001 AS DOUBLE), 9) AS cost_usd
FROM (SELECT i.topic_id, i.publishing_date, len(regexp_extract_all(replace(h.title || ' ' || CASE WHEN strpos(h.text, chr(10)) > 0 THEN split_part(h.text, chr(10), 2) ELSE '' END || ' ' || h.text, chr(10), ' '), '(\\s*\\S+)', 1)) AS n
      FROM inventory i JOIN hits h ON h.event_id = i.event_id) x GROUP BY topic_id, publishing_date""", "inventory", "hits"))
def agg_embedding_cost(spark, sf):
    """A10: embedding tokens of each topic-day inventory and their price
    (title, description and content: the default documents)."""
    from ..functions.text import embedding_docs
    inv = inventory(spark, sf).select("doc_id", "topic_id", "publishing_date")
    docs = A.doc_attributes(A.read(spark, sf, "documents")).select("doc_id", "title", "description", "text")
    d = inv.join(docs, "doc_id").select("topic_id", "publishing_date", F.explode(embedding_docs(
        "title_and_description_and_content_concat", F.col("title"), F.col("description"), F.col("text"))).alias("doc"))
    c = SO.embedding_cost(d, ["topic_id", "publishing_date"])
    return c.select("topic_id", F.col("publishing_date").cast("string").alias("publishing_date"),
                    F.col("tokens").cast("long").alias("tokens"), "cost_usd")
