"""Sourced-article bundles: sink (S10), prefix scan (S11) and load.

A bundle is five objects under one prefix: the article JSON, the short /
medium / full summaries and an empty success marker. They are stored as rows
(object_key, body) of a Parquet table partitioned by topic and publishing day,
or as files, one for each object. Both stores only grow: an article that is
stored stays as it is, a second sourcing of a topic-day adds its articles
beside those of the first, and a rerun changes nothing. Markers come after the
objects, and an article without its marker is not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import sourced_keys
from .stores import append_new, read_table, scan_objects, staged, write_objects

REF_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in
                           ("article_id", "article_title", "article_dt_published", "article_topic_id", "article_topic")]
                          + [T.StructField(n, T.ArrayType(T.StringType())) for n in
                             ("source_article_categories", "source_article_ids", "source_article_urls",
                              "source_article_provider_domains", "source_article_titles")])


MARKER = "__SUCCESS__"


def _bundles(articles: DataFrame) -> DataFrame:
    """Per article: topic_id, date_published, and the keys and bodies k0, b0 .. k4, b4 (the marker last)."""
    k = sourced_keys(F.col("topic_id"), F.col("date_published"), F.col("sourced_article_id"))
    ref = F.to_json(F.struct(
        F.col("sourced_article_id").alias("article_id"), F.col("title").alias("article_title"),
        F.col("dt_published_iso").alias("article_dt_published"), F.col("topic_id").alias("article_topic_id"),
        F.col("topic").alias("article_topic"), "source_article_categories", "source_article_ids",
        "source_article_urls", "source_article_provider_domains", "source_article_titles"))
    return articles.select("topic_id", "date_published", k["json_key"].alias("k0"), ref.alias("b0"),
                           k["short_key"].alias("k1"), F.col("short_summary").alias("b1"),
                           k["medium_key"].alias("k2"), F.col("medium_summary").alias("b2"),
                           k["full_key"].alias("k3"), F.col("full_summary").alias("b3"),
                           k["marker_key"].alias("k4"), F.lit("").alias("b4"))


def bundle_rows(articles: DataFrame) -> DataFrame:
    """Five (object_key, body) rows per sourced article via stack()."""
    return _bundles(articles).selectExpr("topic_id", "date_published",
                                         "stack(5, k0, b0, k1, b1, k2, b2, k3, b3, k4, b4) AS (object_key, body)")


def store_bundles(articles: DataFrame, path: str) -> None:
    """Add the bundles of articles that are not stored yet, the objects
    first, then the markers. A run that stops in between is completed by the
    next one: what is there is not added again."""
    day = F.regexp_replace("date_published", "/", "-").alias("publishing_day")
    rows = staged(bundle_rows(articles).select("topic_id", day, "object_key", "body"), "bundles-new")
    marker = F.col("object_key").endswith(f"/{MARKER}")
    for part in (rows.filter(~marker), rows.filter(marker)):
        append_new(part, path, ["topic_id", "publishing_day"], ["object_key"])


def store_bundle_files(articles: DataFrame, root: str) -> DataFrame:
    """S10 as files: one for each object, an article's marker after its objects; (marker, written) of each article."""
    objects = F.array(*[F.struct(F.col(f"k{n}").alias("key"), F.col(f"b{n}").alias("body")) for n in range(4)])
    return write_objects(_bundles(articles).select(objects.alias("objects"), F.col("k4").alias("marker")), root)


def article_prefixes(objects: DataFrame, key: str = "object_key") -> DataFrame:
    """Distinct prefixes of object keys (or file paths) with the last two parts removed."""
    parts = F.split(F.col(key), "/")
    prefix = F.array_join(F.slice(parts, 1, F.size(parts) - 2), "/")
    return objects.select(prefix.alias("prefix")).distinct()


def _articles(objects: DataFrame) -> DataFrame:
    """Article JSON (object_key, body) as rows, with the summary refs beside it."""
    r = objects.select("object_key", F.from_json("body", REF_SCHEMA).alias("r"))
    prefix = F.regexp_replace(F.col("object_key"), "/[^/]*$", "")
    return r.select("r.*", prefix.alias("prefix")).select(
        "*", F.concat(F.col("prefix"), F.lit("/Short_summary.txt")).alias("short_summary_ref"),
        F.concat(F.col("prefix"), F.lit("/Medium_summary.txt")).alias("medium_summary_ref"),
        F.concat(F.col("prefix"), F.lit("/Full_summary.txt")).alias("full_summary_ref"))


def load_bundles(spark: SparkSession, path: str) -> DataFrame:
    """Stored article JSON of complete bundles back as rows with their three summary refs."""
    objects = read_table(spark, path).withColumn("_prefix", F.regexp_replace("object_key", "/[^/]*$", ""))
    done = objects.filter(F.col("object_key").endswith(f"/{MARKER}")).select("_prefix").distinct()
    return _articles(objects.filter(F.col("object_key").endswith(".json")).join(done, "_prefix", "left_semi"))


def load_bundle_files(spark: SparkSession, root: str) -> DataFrame:
    """S13 from files: the article JSON of complete bundles, their refs from the files' paths."""
    return _articles(scan_objects(spark, root, "*.json", MARKER))


def sourced_rows(articles: DataFrame, sourcing_run_id: str, dt_sourced, initial_status: str = "PENDING",
                 cost_col: str | None = None) -> DataFrame:
    """Rows of the sourced-articles table written next to the bundles.

    ``initial_status`` defaults to PENDING so new articles enter review
    (the original service saved them as APPROVED as a temporary measure and
    did not touch the published counter; pass "APPROVED" to reproduce that).
    """
    k = sourced_keys(F.col("topic_id"), F.col("date_published"), F.col("sourced_article_id"))
    cost = F.col(cost_col).cast("double") if cost_col else F.lit(0.0)
    return articles.select(
        "topic_id", "sourced_article_id", F.lit(dt_sourced).cast("timestamp").alias("dt_sourced"),
        "dt_published", "date_published", "title", "topic", "source_article_categories", "source_article_ids",
        "source_article_urls", F.col("source_article_provider_domains").alias("providers"),
        k["short_key"].alias("short_summary_ref"), k["medium_key"].alias("medium_summary_ref"),
        k["full_key"].alias("full_summary_ref"), F.lit(sourcing_run_id).alias("sourcing_run_id"),
        cost.alias("article_processing_cost"), F.lit(initial_status).alias("article_approval_status"))


def insert_sourced(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Conditional save: a sourced_article_id already stored is not replaced."""
    return table.unionByName(rows.join(table.select("sourced_article_id"), "sourced_article_id", "left_anti"))
