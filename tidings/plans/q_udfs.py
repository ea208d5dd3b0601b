"""Contract queries for sourced-article assembly with the pluggable
functions (U1-U3, A8) and the bundle store (S10, S11, S13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import iso_utc
from ..functions.ids import lexicographic_date, sourced_article_id
from ..operators import udfs as U
from ..session import scratch_path
from ..sources import bundles as BD
from ..sources.stores import read_table, scan_objects, staged
from . import adapters as A
from .catalog import ISO, UUID_SQL, query
from .oracle_ctes import register, with_views
from .q_sourcing import cluster_members, with_texts

USD_PER_TOKEN = 0.002 / 1000  # default summarising price per token (parameter)

register("digest", ("cluster_members",), f"""
SELECT *, CASE WHEN length(full_summary) > 0 THEN trim(array_to_string(list_slice(regexp_extract_all(full_summary, '(\\s*\\S+)', 1), 1, 600), '')) END AS medium_summary,
       CASE WHEN length(full_summary) > 0 THEN trim(array_to_string(list_slice(regexp_extract_all(full_summary, '[^.!?]+[.!?]*', 0), 1, 3), '')) END AS short_summary,
       strftime(dt_published, '%Y-%m-%d-%H-%M-%S-%f') || '#' || {UUID_SQL('topic_id', 'day', 'cluster')} AS sourced_article_id,
       strftime(dt_published, '%Y/%m/%d') AS date_published
FROM (SELECT *, CASE WHEN starts_with(t0, '"') AND ends_with(t0, '"') THEN CASE WHEN length(t0) >= 2 THEN substr(t0, 2, length(t0) - 2) ELSE '' END ELSE t0 END AS title
      FROM (SELECT topic_id, day, cluster, min(published_dt) AS dt_published,
                   coalesce(string_agg(text, chr(10) || chr(10) ORDER BY member_idx), '') AS full_summary,
                   coalesce(string_agg(title, chr(10) || chr(10) ORDER BY member_idx), '') AS titles_joined,
                   trim(array_to_string(list_slice(regexp_extract_all(first(title ORDER BY member_idx), '(\\s*\\S+)', 1), 1, 20), '')) AS t0
            FROM cluster_members GROUP BY topic_id, day, cluster) a) b""")


def digest(spark, sf):
    """Per (topic, day, cluster): ordered members, default summaries and ids."""
    return assemble(with_texts(spark, sf, cluster_members(spark, sf)))


def assemble(m):
    """Members of clusters -> sourced articles with summaries and ids. A
    cluster is part of one topic-day's inventory, which the run caps bound."""
    s = F.struct("member_idx", "category", "article_id", "url", "provider_domain", "title", "text")
    g = m.groupBy("topic_id", "day", "cluster").agg(F.min("published_dt").alias("dt_published"),
                                             F.array_sort(F.collect_list(s)).alias("_m"))
    pick = lambda f: F.transform("_m", lambda x: x[f])
    g = g.select("topic_id", "day", "cluster", "dt_published", A.topic_name(F.col("topic_id")).alias("topic"),
                 pick("category").alias("source_article_categories"), pick("article_id").alias("source_article_ids"),
                 pick("url").alias("source_article_urls"), pick("provider_domain").alias("source_article_provider_domains"),
                 pick("title").alias("source_article_titles"), pick("title").alias("titles"), pick("text").alias("texts"))
    d = U.summarise_default(g)
    return d.select("*", sourced_article_id(F.col("dt_published"), F.col("topic_id"), F.col("day"),
                                            F.col("cluster")).alias("sourced_article_id"),
                    lexicographic_date(F.col("dt_published")).alias("date_published"),
                    iso_utc(F.col("dt_published")).alias("dt_published_iso"))


@query("udf_summarise", with_views("""
SELECT topic_id, day, cluster, title, md5(full_summary) AS full_md5, md5(medium_summary) AS medium_md5,
       md5(short_summary) AS short_md5 FROM digest""", "digest"))
def udf_summarise(spark, sf):
    """Title, full, medium and short text per cluster (default extractive)."""
    d = digest(spark, sf)
    return d.select("topic_id", "day", "cluster", "title", F.md5("full_summary").alias("full_md5"),
                    F.md5("medium_summary").alias("medium_md5"), F.md5("short_summary").alias("short_md5"))


@query("chk_summary_contract", with_views("""
SELECT topic_id, day, cluster, v AS violation FROM (
  SELECT topic_id, day, cluster, CASE WHEN NOT len(string_split_regex(trim(title), '\\s+')) BETWEEN 5 AND 20 THEN 'title_length' END AS v FROM digest
  UNION ALL SELECT topic_id, day, cluster, CASE WHEN length(coalesce(full_summary, '')) > 0 AND len(regexp_extract_all(short_summary, '[^.!?]+[.!?]*', 0)) > 3 THEN 'short_sentences' END FROM digest
  UNION ALL SELECT topic_id, day, cluster, CASE WHEN length(coalesce(full_summary, '')) > 0 AND NOT len(string_split_regex(trim(medium_summary), '\\s+')) BETWEEN 300 AND 600 THEN 'medium_length' END FROM digest
  UNION ALL SELECT topic_id, day, cluster, CASE WHEN length(coalesce(full_summary, '')) = 0 THEN 'medium_without_full' END FROM digest
  UNION ALL SELECT topic_id, day, cluster, CASE WHEN length(coalesce(full_summary, '')) = 0 THEN 'short_without_full' END FROM digest) x
WHERE v IS NOT NULL""", "digest"))
def chk_summary_contract(spark, sf):
    """Summaries breaking the length / sentence contract."""
    return U.contract_violations(digest(spark, sf), ["topic_id", "day", "cluster"])


TOK = "len(regexp_extract_all({c}, '(\\s*\\S+)', 1))"


@query("agg_processing_cost", with_views(f"""
SELECT topic_id, day, cluster, round(CAST(({TOK.format(c='titles_joined')} + coalesce({TOK.format(c='title')}, 0)
  + {TOK.format(c='full_summary')} + {TOK.format(c='full_summary')}
  + {TOK.format(c='full_summary')} + coalesce({TOK.format(c='medium_summary')}, 0)
  + {TOK.format(c='full_summary')} + coalesce({TOK.format(c='short_summary')}, 0)) AS DOUBLE) * CAST({USD_PER_TOKEN} AS DOUBLE), 9) AS article_processing_cost
FROM digest""", "digest"))
def agg_processing_cost(spark, sf):
    """Title + full + medium + short cost of every sourced article."""
    d = digest(spark, sf).withColumn("titles_joined", F.array_join("titles", "\n\n"))
    c = U.processing_cost(d, ["topic_id", "day", "cluster"], USD_PER_TOKEN, {
        "title": ("titles_joined", "title"), "full": ("full_summary", "full_summary"),
        "medium": ("full_summary", "medium_summary"), "short": ("full_summary", "short_summary")})
    return c.select("topic_id", "day", "cluster", F.round("article_processing_cost", 9).alias("article_processing_cost"))


@query("udf_embed", """
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(split_part(text, chr(10), 1), '') || ' ' || coalesce(text, '')), '[a-z0-9]+')) AS w FROM documents),
tf AS (SELECT doc_id, f, count(*) AS tf FROM (SELECT doc_id, ('0x' || substr(md5(w), 1, 8))::BIGINT % 4096 AS f FROM t) h GROUP BY doc_id, f),
df AS (SELECT f, count(*) AS df FROM tf GROUP BY f),
w AS (SELECT doc_id, f, tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)) AS w FROM tf JOIN df USING (f)),
v AS (SELECT doc_id, f, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM w WHERE w <> 0)
SELECT doc_id, coalesce(n, 0) AS n_nonzero, coalesce(round(norm, 6), 0.0) AS norm, coalesce(round(checksum, 4), 0.0) AS checksum
FROM (SELECT doc_id FROM documents) d LEFT JOIN (SELECT doc_id, count(*) AS n, sqrt(sum(w * w)) AS norm, sum(w * (f + 1)) AS checksum FROM v GROUP BY doc_id) s
USING (doc_id)""")
def udf_embed(spark, sf):
    """Default hashed TF-IDF embedding of every document's title and text."""
    from ..functions.text import embedding_docs
    d = A.doc_attributes(A.read(spark, sf, "documents"))
    d = d.select("doc_id", F.get(embedding_docs("title_and_content_concat", F.col("title"), F.lit(None), F.col("text")), F.lit(0)).alias("doc"))
    e = U.embed_default(d, "doc_id")
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)
    return e.select("doc_id", F.size("indices").cast("long").alias("n_nonzero"),
                    F.round(F.sqrt(total(F.transform("values", lambda x: x * x))), 6).alias("norm"),
                    F.round(total(F.zip_with("indices", "values", lambda i, x: x * (i + 1))), 4).alias("checksum"))


def letter_vectors(texts: list[str]) -> list[list[float]]:
    """A caller's embedding function: length, words and lines of each text."""
    return [[float(len(t)), float(len(t.split(" "))), float(t.count("\n"))] for t in texts]


@query("udf_embed_stored", """
SELECT doc_id, length(t) AS n_chars, len(string_split(t, ' ')) AS n_words, length(t) - length(replace(t, chr(10), '')) AS n_breaks, 3 AS dims
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""")
def udf_embed_stored(spark, sf):
    """U1 with a caller's function, called once for each distinct text; read twice, the second time from the results."""
    path = scratch_path(spark, "embedding-results")
    docs = A.read(spark, sf, "documents").select("doc_id", "text")
    U.once(docs.filter("doc_id % 2 = 0"), ["text"], lambda d: U.embed_with(d, letter_vectors, "text"), path)
    e = U.once(docs, ["text"], lambda d: U.embed_with(d, letter_vectors, "text"), path)
    n = [F.col("embedding")[k].cast("long").alias(c) for k, c in enumerate(("n_chars", "n_words", "n_breaks"))]
    return e.select("doc_id", *n, F.size("embedding").alias("dims"))


def _bundle_files(spark, sf):
    root = scratch_path(spark, "bundle-files")
    BD.store_bundle_files(digest(spark, sf), root)
    return root


BUNDLE_KEYS_SQL = """
SELECT 'sourced_candidate_articles/' || topic_id || '/' || date_published || '/' || sourced_article_id AS prefix, * FROM digest"""


@query("sink_sourced_bundle", with_views(f"""
SELECT prefix || '/' || sourced_article_id || '.json' AS object_key, NULL AS body_md5 FROM ({BUNDLE_KEYS_SQL}) a
UNION ALL SELECT prefix || '/Short_summary.txt', md5(short_summary) FROM ({BUNDLE_KEYS_SQL}) a
UNION ALL SELECT prefix || '/Medium_summary.txt', md5(medium_summary) FROM ({BUNDLE_KEYS_SQL}) a
UNION ALL SELECT prefix || '/Full_summary.txt', md5(full_summary) FROM ({BUNDLE_KEYS_SQL}) a
UNION ALL SELECT prefix || '/__SUCCESS__', md5('') FROM ({BUNDLE_KEYS_SQL}) a""", "digest"))
def sink_sourced_bundle(spark, sf):
    """Four objects and a marker per sourced article written under one prefix, by two sourcings of
    half the articles and one again of all."""
    path, d = scratch_path(spark, "bundles"), staged(digest(spark, sf), "digest")
    for part in (d.filter("cluster % 2 = 0"), d.filter("cluster % 2 = 1"), d):
        BD.store_bundles(part, path)
    d = read_table(spark, path)
    return d.select("object_key", F.when(~F.col("object_key").endswith(".json"), F.md5("body")).alias("body_md5"))


@query("src_prefix_scan", with_views(f"""
SELECT DISTINCT 'sourced_candidate_articles/' || topic_id || '/' || date_published AS prefix FROM digest""", "digest"))
def src_prefix_scan(spark, sf):
    """Distinct article prefixes (file paths minus their last two parts), from one file per object."""
    return BD.article_prefixes(scan_objects(spark, _bundle_files(spark, sf)))


@query("src_sourced_bundle", with_views(f"""
SELECT sourced_article_id AS article_id, title AS article_title, {ISO('dt_published')} AS article_dt_published,
       topic_id AS article_topic_id, 'Topic ' || split_part(topic_id, '_', 2) AS article_topic,
       array_to_string(list_transform(string_split(source_article_ids, ','), lambda x: x), ',') AS source_article_ids,
       prefix || '/Short_summary.txt' AS short_summary_ref
FROM (SELECT d.*, 'sourced_candidate_articles/' || topic_id || '/' || date_published || '/' || sourced_article_id AS prefix,
             (SELECT string_agg(article_id, ',' ORDER BY member_idx) FROM cluster_members m
              WHERE m.topic_id = d.topic_id AND m.day = d.day AND m.cluster = d.cluster) AS source_article_ids
      FROM digest d) x""",
    "digest", "cluster_members"))
def src_sourced_bundle(spark, sf):
    """Stored article files loaded back with their summary refs."""
    r = BD.load_bundle_files(spark, _bundle_files(spark, sf))
    return r.select("article_id", "article_title", "article_dt_published", "article_topic_id", "article_topic",
                    F.array_join("source_article_ids", ",").alias("source_article_ids"), "short_summary_ref")
