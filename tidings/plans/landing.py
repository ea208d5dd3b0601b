"""Landed vendor responses derived from the hits adapter.

Every (run, page of 100 hits) becomes one JSON envelope in its vendor's
format; beside every 4th page (page % 4 = 3) stands an error envelope, as left
by a try before, beside every 3rd (page % 3 = 0) a line cut off in the middle,
beside every 5th (page % 5 = 0) an envelope without its required fields;
the url of every document with doc_id % 13 = 0 is missing
(a required field). Pages come from an exact distributed rank on events alone;
texts are cut to what a vendor sends beside the documents scan, and one grouped
pass builds the envelopes of all vendors, each of one page, a bounded group.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import BING, NEWSAPI_ORG, PAGE_SIZE, THENEWSAPI_COM
from ..functions.ids import uuid_of
from ..operators.sizing import rank_within
from ..session import remove, scratch_path, shuffles_dropped
from ..sources.stores import staged
from . import adapters as A
from .q_functions import vendor_category

# documented vendor forms: content is the article cut at 200 characters, a snippet its first 60
CONTENT_CHARS, SNIPPET_CHARS = 200, 60
# hits that lie on the disk at once as landed lines, at most: so many for each document, or so many in all
DOCUMENT_HITS, LEAST_HITS = 2, 1 << 18


def paged_events(spark: SparkSession, sf: str, vendors: tuple[str, ...] = ()) -> DataFrame:
    """The events with their place in the pages of their run, without texts."""
    ev = A.with_raw_dates(A.hit_events(spark, sf))
    if vendors:
        ev = ev.filter(F.col("aggregator_id").isin(*vendors))
    ev = rank_within(ev, ["topic_id", "aggregator_id"], "event_id", name="arrival_rank")
    ev = ev.withColumn("page", F.floor((F.col("arrival_rank") - 1) / PAGE_SIZE).cast("long"))
    return ev.withColumn("envelope_id", F.concat_ws("/", "topic_id", "aggregator_id", F.col("page").cast("string")))


def paged_hits(spark: SparkSession, sf: str, vendors: tuple[str, ...] = ()) -> DataFrame:
    return with_texts(spark, sf, paged_events(spark, sf, vendors))


def with_texts(spark: SparkSession, sf: str, ev: DataFrame) -> DataFrame:
    h = A.with_documents(spark, sf, ev, content=F.substring("text", 1, CONTENT_CHARS),
                         snippet=F.substring("text", 1, SNIPPET_CHARS)).drop("text")
    return h.withColumns({
        "url_or_null": F.when(F.col("doc_id") % 13 != 0, F.col("url")),
        "date_or_null": F.nullif(F.col("raw_published"), F.lit("")),
        "vendor_category": vendor_category(F.col("doc_id"), F.col("aggregator_id")),
        "topic": A.topic_name(F.col("topic_id"))})


def _image(x: Column) -> Column:
    return F.concat(x["url"], F.lit("/image"))


def _bing(x: Column) -> Column:
    with_image, with_video = x["doc_id"] % 3 == 0, x["doc_id"] % 5 == 0
    return F.struct(
        x["vendor_category"].alias("category"), x["date_or_null"].alias("datePublished"), x["description"],
        (x["doc_id"] % 2 == 0).alias("headline"), x["doc_id"].cast("string").alias("id"),
        F.when(with_image, F.struct(F.struct(_image(x).alias("contentUrl"), F.lit(90).alias("height"), F.lit(120).alias("width")).alias("thumbnail"))).alias("image"),
        F.when(x["doc_id"] % 7 == 0, F.array(F.struct(x["title"].alias("name"), x["url"], F.array(F.struct(x["lang"].alias("name"))).alias(
            "clusteredArticles")))).alias("clusteredArticles"),
        F.array(F.struct(x["source"].alias("name")), F.struct(x["lang"].alias("name"))).alias("mentions"),
        x["title"].alias("name"),
        F.array(F.struct(x["source"].alias("name")), F.struct(F.concat(F.lit("via "), x["lang"]).alias("name"))).alias("provider"),
        x["url_or_null"].alias("url"),
        F.when(with_video, F.struct(x["title"].alias("name"), _image(x).alias("thumbnailUrl"), x["url"].alias("motionThumbnailUrl"))).alias("video"))


def _newsapi(x: Column) -> Column:
    return F.struct(
        F.struct(F.when(x["doc_id"] % 2 == 0, x["source"]).alias("id"), x["source"].alias("name")).alias("source"),
        F.when(x["doc_id"] % 3 == 0, x["lang"]).alias("author"), x["title"], x["description"], x["url_or_null"].alias("url"),
        F.when(x["doc_id"] % 3 == 0, _image(x)).alias("urlToImage"), x["date_or_null"].alias("publishedAt"), x["content"])


def _thenewsapi(x: Column) -> Column:
    return F.struct(
        uuid_of(x["event_id"]).alias("uuid"), x["title"], x["description"], F.concat(x["lang"], F.lit(", news")).alias("keywords"),
        x["snippet"], x["url_or_null"].alias("url"), _image(x).alias("image_url"), x["lang"].alias("language"),
        x["date_or_null"].alias("published_at"), x["provider_domain"].alias("source"), F.array(x["vendor_category"]).alias("categories"),
        F.when(x["doc_id"] % 2 == 0, (x["doc_id"] % 7) / 2).alias("relevance_score"), F.lit("us").alias("locale"))


FIELDS = ("arrival_rank", "event_id", "doc_id", "title", "description", "content", "snippet", "url", "url_or_null", "date_or_null",
          "source", "provider_domain", "lang", "vendor_category")


def _envelopes(lost: Column) -> Column:
    """The lines of one page, by its vendor: what is left of tries before, and the response."""
    hits, n = F.col("_hits"), F.size("_hits")
    page, vendor, id_ = F.col("page"), F.col("aggregator_id"), F.col("envelope_id")
    limit = F.lit("rate limit exceeded").alias("message")
    topic, first = F.col("topic"), hits[0]
    related = F.array(F.struct(topic.alias("name"), F.concat(F.lit("https://search/"), topic).alias("webSearchUrl"), F.array(
        F.struct(first["title"].alias("name"), first["url"].alias("url"), first["description"].alias("description"))).alias("relatedNews")))
    # the type and the related topics are not always there
    bing = (F.struct(id_, F.when(page % 2 == 1, F.lit("News")).alias("_type"),
                     F.struct(topic.alias("originalQuery"), F.lit(False).alias("adultIntent"),
                              F.when(page % 2 == 0, F.concat(topic, F.lit(" news"))).alias("alteredQuery")).alias("queryContext"),
                     F.when(page % 2 == 0, related).alias("relatedTopics"),
                     n.alias("totalEstimatedMatches"), F.transform(hits, _bing).alias("value")),
            F.struct(id_, F.lit("ErrorResponse").alias("_type"),
                     F.array(F.struct(F.lit("RateLimitExceeded").alias("code"), limit)).alias("errors")))
    newsapi = (F.struct(id_, F.lit("ok").alias("status"), n.alias("totalResults"), F.transform(hits, _newsapi).alias("articles")),
               F.struct(id_, F.lit("error").alias("status"), F.lit("rateLimited").alias("code"), limit, F.lit(0).alias("totalResults")))
    thenewsapi = (F.struct(id_, F.struct(n.alias("found"), n.alias("returned"), F.lit(PAGE_SIZE).alias("limit"), (page + 1).alias("page")).alias("meta"),
                           F.transform(hits, _thenewsapi).alias("data")),
                  F.struct(id_, F.struct(F.lit("rate_limit_reached").alias("code"), limit).alias("error")))
    out = None
    for name, (ok, bad) in ((BING, bing), (NEWSAPI_ORG, newsapi), (THENEWSAPI_COM, thenewsapi)):
        lines = F.array_compact(F.array(
            F.when(page % 4 == 3, F.to_json(bad)), F.when(page % 3 == 0, F.concat(F.lit('{"envelope_id":"'), id_, F.lit('","value":[{'))),
            F.when(page % 5 == 0, F.to_json(F.struct(id_))),
            F.when(lost, F.to_json(bad)).otherwise(F.to_json(ok))))
        out = F.when(vendor == name, lines) if out is None else out.when(vendor == name, lines)
    return out


def land(spark: SparkSession, sf: str, *vendors: str, lost: Column | None = None) -> str:
    """Write the envelopes (of some vendors, or all) as JSON lines under <scratch>/vendor=<id>/. Pages where ``lost``
    (of topic, aggregator_id, page) holds have an error in the place of their data."""
    path = scratch_path(spark, "landed")
    _write_lines(paged_hits(spark, sf, vendors), path, lost)
    return path


def _write_lines(hits: DataFrame, path: str, lost: Column | None) -> None:
    lost = F.lit(False) if lost is None else lost
    pages = hits.groupBy("envelope_id", "page", "aggregator_id", "topic").agg(
        F.array_sort(F.collect_list(F.struct(*FIELDS))).alias("_hits"))
    lines = pages.select(F.col("aggregator_id").alias("vendor"), F.explode(_envelopes(lost)).alias("value"))
    with shuffles_dropped(hits.sparkSession):
        lines.write.mode("overwrite").partitionBy("vendor").text(path)


def landings(spark: SparkSession, sf: str, lost: Column | None = None) -> Iterator[str]:
    """The lines of ``land``, a portion of the pages at a time: each path has a folder for every vendor and is removed
    when the next is asked for, so the disk holds one portion, whatever the number of hits."""
    ev = staged(paged_events(spark, sf).select("event_id", "topic_id", "aggregator_id", "doc_id", "raw_published", "arrival_rank",
                                               "page", "envelope_id"), "landed-events")
    n_docs = A.read(spark, sf, "documents").count()
    portions = max(1, -(-ev.count() // max(LEAST_HITS, DOCUMENT_HITS * n_docs)))
    for k in range(portions):
        path = scratch_path(spark, "landed")
        _write_lines(with_texts(spark, sf, ev.filter(F.pmod(F.xxhash64("envelope_id"), F.lit(portions)) == k)), path, lost)
        for vendor in (BING, NEWSAPI_ORG, THENEWSAPI_COM):      # one without a page has no folder yet
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(vendor_path(path, vendor))
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)
        yield path
        remove(spark, path)


def vendor_path(path: str, vendor: str) -> str:
    return f"{path}/vendor={vendor}"
