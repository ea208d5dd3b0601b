"""The two services end to end: aggregation (landed responses to candidates,
ledger and marks) and sourcing (candidates to sourced articles)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import constants as K
from ..functions.dates import iso_utc
from ..functions.text import embedding_docs
from ..operators import aggregates as AG
from ..operators import cluster as CL
from ..operators import collect as C
from ..operators import ledger as LG
from ..operators import publish as P
from ..operators import schedule as S
from ..operators import sourcing as SO
from ..operators import udfs as U
from ..session import remove, scratch_path
from ..sources import bundles as BD
from ..sources import candidates as CS
from ..sources import vendor as V
from ..sources.stores import read_table, staged, staged_at
from . import adapters as A
from .catalog import ISO, query
from .landing import landings, vendor_path
from .oracle_ctes import register, with_views
from .q_collect import register_collect
from .q_sourcing import stored
from .q_udfs import assemble

RUN = ["topic_id", "aggregator_id"]
FEATURES = 256      # of the default vectors that articles are clustered by

register("landed_hits", ("paged_raw",), """
SELECT page * 100 + pos AS event_id, doc_id, topic_id, aggregator_id, url, provider_domain, title, text, raw_published
FROM paged_raw WHERE url_or_null IS NOT NULL AND (aggregator_id = 'bingnews' OR date_or_null IS NOT NULL)""")
register_collect("l", "landed_hits")

def lost():
    """One run's first page, which was never answered."""
    return (F.col("topic") == "Topic 3") & (F.col("aggregator_id") == K.THENEWSAPI_COM) & (F.col("page") == 0)


LOST_SQL = f"(r.topic_id = 'topic_3' AND r.aggregator_id = '{K.THENEWSAPI_COM}')"


def landed_articles(envelopes):
    """(valid raw articles of the vendors' envelopes, in arrival order (event_id: place in the run's pages); topic_id,
    aggregator_id and error of the runs that have a page without an answer)."""
    out, failed = None, None
    page = F.split("envelope_id", "/")
    for vendor, env in envelopes.items():
        data, quarantine = V.split_errors(env, vendor)
        missing = V.unanswered(data, quarantine)
        valid, _ = V.valid_articles(V.flatten(data, vendor))
        a = V.raw_articles(valid, vendor)
        out, failed = (a, missing) if out is None else (out.unionByName(a), failed.unionByName(missing))
    failed = failed.select(page[0].alias("topic_id"), page[1].alias("aggregator_id"), "error")
    return out.select("*", page[0].alias("topic_id"), (page[2].cast("long") * K.PAGE_SIZE + F.col("pos")).alias("event_id")), failed


def first_arrivals(articles, runs):
    """The articles of each run up to the last one that ``paged`` keeps. Of the others only run and place are shuffled."""
    keys = staged(articles.select(*RUN, "event_id"), "arrival-keys")
    last = staged(C.paged(keys, runs).groupBy(*RUN).agg(F.max("event_id").alias("_last")), "arrival-last")
    return articles.join(last, RUN).filter(F.col("event_id") <= F.col("_last")).select(*articles.columns)


def arrived(spark, sf, runs):
    """(the first arrivals of all runs that have an answer to each page; the runs that have not, with an error). Lines are
    landed, read and parsed a portion of the pages at a time. An article that is not among the first of a portion and
    of those kept so far is not among the first of the run. A failed run has no articles; the others are not touched by it."""
    kept, at, failed = None, None, None
    for path in landings(spark, sf, lost=lost()):
        parsed = {v: scratch_path(spark, "envelopes") for v in (K.BING, K.NEWSAPI_ORG, K.THENEWSAPI_COM)}
        articles, missing = landed_articles({v: staged_at(V.read_envelopes(spark, vendor_path(path, v), v), to) for v, to in parsed.items()})
        missing = staged(missing, "unanswered")
        failed = missing if failed is None else failed.unionByName(missing)
        articles, before, at = articles if kept is None else articles.unionByName(kept), at, scratch_path(spark, "arrivals")
        kept = staged_at(first_arrivals(articles, runs), at)
        for done in (*parsed.values(), *filter(None, [before])):
            remove(spark, done)
    failed = staged(failed.groupBy(*RUN).agg(F.min("error").alias("error")), "failed-runs")
    return kept.join(failed, RUN, "left_anti"), failed


def with_bodies(spark, sf, articles):
    """Adds whether the article's page has a text (the page is the document its url names)."""
    bodies = A.doc_attributes(A.read(spark, sf, "documents")).select("doc_id", "has_body")
    named = articles.withColumn("doc_id", F.regexp_extract("url", "/a/([0-9]+)$", 1).try_cast("long"))
    return named.join(bodies, "doc_id", "left")


def collected(spark, sf, runs):
    """(store of accepted candidates, failed runs, the accepted articles counted by aggregator while they are written)."""
    articles, failed = arrived(spark, sf, runs)
    accepted = C.collect(articles, runs, A.trusted(spark, sf), body="has_body",
                         description="article_text_description", attributes=lambda a: with_bodies(spark, sf, a))
    accepted, counts = P.observed(accepted, "accepted", counts={k: F.col("aggregator_id") == k for k in (K.BING, K.NEWSAPI_ORG, K.THENEWSAPI_COM)})
    path = scratch_path(spark, "pipe-candidates")
    CS.store_candidates(accepted.select(*RUN, "topic", "sorting", "start_dt", "article_id", "aggregation_index", "published_dt", "title",
                                        "url", "provider_domain", "category", "author", "article_text_description",
                                        "article_text_snippet", "article_data"), path)
    return path, failed, counts


def considered_inventories(spark, path):
    """(the inventories of enough articles, ranked and written; their rows counted while they are written)."""
    inv = CS.load_unsourced(spark, path).withColumnRenamed("published_date", "publishing_date")
    considered, counts = P.observed(SO.rank_inventory(SO.sourceable(inv)), "considered")
    work = scratch_path(spark, "pipe-inventory")
    considered.write.parquet(work)
    return spark.read.parquet(work).withColumn("day", F.col("publishing_date").cast("string")), counts


@query("agg_observed_counts", with_views(f"""
SELECT 'accepted' AS metric, '{{"aggregator_id":"' || a.id || '"}}' AS dimensions, count(r.url) AS value
FROM (SELECT unnest(['{K.BING}', '{K.NEWSAPI_ORG}', '{K.THENEWSAPI_COM}']) AS id) a
LEFT JOIN (SELECT * FROM l_w4 r WHERE NOT {LOST_SQL}) r ON r.aggregator_id = a.id GROUP BY a.id
UNION ALL SELECT 'considered', '{{}}', coalesce(sum(n), 0)::BIGINT FROM (
  SELECT count(*) AS n FROM inventory GROUP BY topic_id, publishing_date HAVING count(*) >= 6) x""", "l_w4", "inventory"))
def agg_observed_counts(spark, sf):
    """Counts that both services take while their main job writes, without a job of their own."""
    _, _, accepted = collected(spark, sf, staged(A.runs(spark, sf), "runs"))
    _, considered = considered_inventories(spark, stored(spark, sf))
    return P.observed_metrics(spark, "accepted", accepted, "aggregator_id").unionByName(P.observed_metrics(spark, "considered", considered))


@query("pipe_collect", with_views(f"""
SELECT r.topic_id, r.aggregator_id, CASE WHEN {LOST_SQL} THEN 'FAILED' ELSE 'COMPLETE' END AS run_status,
       CASE WHEN NOT {LOST_SQL} THEN coalesce(s.n, 0) END AS articles_count,
       {ISO('coalesce(s.lo, r.start_dt)')} AS data_start, {ISO('coalesce(s.hi, r.end_dt)')} AS data_end,
       coalesce(s.n, 0) AS n_stored, s.first_id AS first_article_id, s.categories AS n_categories,
       {ISO('CASE WHEN m.last_end IS NULL THEN s.hi WHEN s.hi IS NULL THEN m.last_end ELSE greatest(m.last_end, s.hi) END')} AS last_end
FROM runs r LEFT JOIN (SELECT topic_id, aggregator_id, count(*) AS n, min(published_dt) AS lo, max(published_dt) AS hi,
                              min(article_id) AS first_id,
                              CASE WHEN aggregator_id = 'newsapi.org' THEN 0 ELSE count(*) END AS categories
                       FROM l_w4 r WHERE NOT {LOST_SQL} GROUP BY topic_id, aggregator_id) s USING (topic_id, aggregator_id)
LEFT JOIN watermarks m USING (topic_id, aggregator_id)""", "l_w4", "watermarks", "runs"))
def pipe_collect(spark, sf):
    """Aggregation: landed responses -> raw articles -> collect stage -> store,
    run summary, ledger and marks; one row per run. A run with an unanswered
    page is FAILED in the ledger, with its error, and stores nothing."""
    runs = staged(A.runs(spark, sf), "runs")
    ledger = LG.start_runs(None, runs, A.TODAY)
    path, failed, _ = collected(spark, sf, runs)
    kept = read_table(spark, path)
    summary = AG.run_summary(kept)
    outcomes = runs.join(summary, RUN, "left").join(AG.store_paths(kept, "candidates"), RUN, "left").join(failed, RUN, "left").select(
        F.concat_ws("/", *RUN, F.col("start_dt").cast("string")).alias("run_id"), "min_published", "max_published", "n_accepted",
        "store_paths", "error")
    ledger = LG.finish_runs(ledger, outcomes, A.TODAY)
    marks = S.high_watermark(A.watermarks(spark, sf), summary.select(*RUN, F.col("max_published").alias("proposed_end")), A.TODAY)
    counts = kept.groupBy(*RUN).agg(F.count(F.lit(1)).alias("n_stored"), F.min("article_id").alias("first_article_id"),
                                    F.count("category").alias("n_categories"))
    out = ledger.join(counts, RUN, "left").join(marks, RUN, "left")
    return out.select(*RUN, "run_status", "articles_count", iso_utc(F.col("data_start")).alias("data_start"),
                      iso_utc(F.col("data_end")).alias("data_end"), F.coalesce("n_stored", F.lit(0)).alias("n_stored"),
                      "first_article_id", "n_categories", iso_utc(F.col("last_end")).alias("last_end"))


@query("pipe_source", with_views("""
SELECT i.topic_id, CAST(publishing_date AS VARCHAR) AS day, count(*) AS n_considered, count(*) AS n_flagged,
       TRUE AS sourced_within_limit, CAST(5 AS DOUBLE) AS objects_per_article, max(t.daily_publishing_limit)::BIGINT AS top_k
FROM inventory i JOIN topics t ON t.topic_id = i.topic_id GROUP BY i.topic_id, publishing_date HAVING count(*) >= 6""", "inventory", "topics"))
def pipe_source(spark, sf):
    """Sourcing: stored candidates -> inventories of enough articles, their
    vectors and clusters, the largest clusters as sourced articles with
    summaries, bundles and table rows; flags and publishing dates; one row per
    sourced topic-day."""
    path = stored(spark, sf)
    considered, _ = considered_inventories(spark, path)
    docs = A.doc_attributes(A.read(spark, sf, "documents")).select("doc_id", "description", "text")
    texts = considered.join(docs, "doc_id")
    doc = F.get(embedding_docs("title_and_description_and_content_concat", F.col("title"), F.col("description"), F.col("text")), F.lit(0))
    vectors = U.embed_default(texts.select("article_id", doc.alias("doc")), "article_id", num_features=FEATURES)
    points = considered.select("topic_id", "day", F.col("inventory_rank").alias("member_idx"), "article_id").join(
        vectors.select("article_id", U.dense_vector("indices", "values", FEATURES).alias("embedding")), "article_id")
    labels = scratch_path(spark, "pipe-labels")
    CL.ward_clusters(points, ["topic_id", "day"], "member_idx").write.parquet(labels)
    labels = spark.read.parquet(labels).select("topic_id", "day", "member_idx", F.col("label").alias("cluster"))

    topics = A.topics(spark, sf)
    top = SO.cluster_topk(SO.cluster_sizes(labels, ["topic_id", "day"]), topics, ["topic_id", "day"], K.DAILY_SOURCING_FREQUENCY)
    members = (texts.withColumnRenamed("inventory_rank", "member_idx").withColumn("category", F.lit(K.NO_CATEGORY))
               .join(labels, ["topic_id", "day", "member_idx"]).join(top.select("topic_id", "day", "cluster"), ["topic_id", "day", "cluster"]))
    articles = scratch_path(spark, "pipe-articles")
    assemble(members).write.parquet(articles)
    articles = spark.read.parquet(articles)
    bundles = scratch_path(spark, "pipe-bundles")
    BD.store_bundles(articles, bundles)
    table = BD.sourced_rows(articles, "run", A.TODAY)
    table = BD.insert_sourced(table.limit(0), table)
    after = CS.mark_sourced(spark, path, considered.select("topic_id", F.col("publishing_date").alias("published_date"), "article_id"))

    topics = P.last_publishing(topics, table, dt.datetime(2024, 1, 30))
    flagged = after.filter("is_sourced").groupBy("topic_id", F.col("published_date").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("n_flagged"))
    sourced = articles.groupBy("topic_id", "day").agg(F.count(F.lit(1)).alias("n_sourced"), F.collect_set("date_published").alias("_dates"))
    objects = read_table(spark, bundles).groupBy("topic_id", F.regexp_extract("object_key", "([^/]+)/[^/]+$", 1).alias("sourced_article_id")).agg(
        F.count(F.lit(1)).alias("n"))
    objects = objects.join(table.select("sourced_article_id"), "sourced_article_id").groupBy("topic_id").agg(F.avg("n").alias("objects_per_article"))
    n = considered.groupBy("topic_id", "day").agg(F.count(F.lit(1)).alias("n_considered"))
    top_k = F.ceil(F.col("daily_publishing_limit") / F.lit(K.DAILY_SOURCING_FREQUENCY)).cast("long")
    out = n.join(flagged, ["topic_id", "day"], "left").join(sourced, ["topic_id", "day"], "left").join(objects, "topic_id", "left").join(
        topics.filter("last_publishing_date = TIMESTAMP '2024-01-30 00:00:00'"), "topic_id")
    return out.select("topic_id", "day", "n_considered", "n_flagged", F.col("n_sourced").between(1, top_k).alias("sourced_within_limit"),
                      "objects_per_article", top_k.alias("top_k"))
