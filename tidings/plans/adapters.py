"""Views over the driver tables that give the article engine its inputs.

Every view is derived from the given tables by keys only (no clock, no
randomness), so its size grows with the data. The DuckDB oracle builds the
same views in ``oracle_ctes.py``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import AGGREGATORS, HORIZON_DAYS
from ..functions.dates import vendor_date_string

TODAY = dt.datetime(2024, 1, 31)
RUN_START = dt.datetime(2024, 1, 2)
RUN_END = dt.datetime(2024, 1, 29)
WATERMARK_BEFORE = dt.datetime(2024, 1, 21)
RUN_MAX_RESULTS = 100
N_TOPICS = 8
TRUSTED_MAX_SOURCE = 13


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _aggregator_of(event_id: Column) -> Column:
    m = event_id % 3
    return (F.when(m == 0, F.lit(AGGREGATORS[0])).when(m == 1, F.lit(AGGREGATORS[1]))
            .otherwise(F.lit(AGGREGATORS[2])))


def topic_name(topic_id: Column) -> Column:
    return F.concat(F.lit("Topic "), F.substring_index(topic_id, "_", -1))


def second_line(text: Column) -> Column:
    """Second line of a text ('' when there is none). substring_index stops
    at the second newline instead of splitting the whole text."""
    return F.when(F.instr(text, "\n") > 0,
                  F.substring_index(F.substring_index(text, "\n", 2), "\n", -1)).otherwise(F.lit(""))


def doc_attributes(docs: DataFrame) -> DataFrame:
    """Per-document attributes computed next to the scan, so that later
    joins and shuffles carry short strings and flags, not the full text
    (``text`` stays available and is pruned when nothing reads it)."""
    return docs.select("doc_id", "text", "lang", "source",
                       F.substring_index(F.col("text"), "\n", 1).alias("title"),
                       second_line(F.col("text")).alias("description"),
                       (F.coalesce(F.octet_length("text"), F.lit(0)) > 0).alias("has_body"))


def hit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fetched article per event (arrival = event_id), by keys only: the
    event names its document, so no document is read."""
    docs = read(spark, sf_dir, "documents")
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    return read(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("published_dt"), "user_id",
        F.concat(F.lit("topic_"), (F.col("user_id") % N_TOPICS).cast("string")).alias("topic_id"),
        _aggregator_of(F.col("event_id")).alias("aggregator_id"),
        (F.col("event_id") % n_docs).alias("doc_id"))


def with_documents(spark: SparkSession, sf_dir: str, ev: DataFrame, **more: Column) -> DataFrame:
    """Adds the attributes of each event's document, and ``more`` computed
    beside the scan from its columns."""
    j = ev.join(doc_attributes(read(spark, sf_dir, "documents")).withColumns(more), "doc_id")
    return j.withColumns({
        "url": F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/a/"), F.col("doc_id").cast("string")),
        "provider_domain": F.concat(F.col("source"), F.lit(".example.com"))})


def with_raw_dates(ev: DataFrame) -> DataFrame:
    """Adds the published date as the vendor string (raw_dates view): every
    row with event_id % 50 = 0 is blank, every event_id % 97 = 0 is malformed
    (a space instead of the 'T')."""
    s = vendor_date_string(F.col("published_dt"), F.col("aggregator_id"))
    raw = (F.when(F.col("event_id") % 50 == 0, F.lit(""))
           .when(F.col("event_id") % 97 == 0, F.replace(s, F.lit("T"), F.lit(" ")))
           .otherwise(s))
    return ev.withColumn("raw_published", raw)


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events x documents: one fetched article per event."""
    return with_documents(spark, sf_dir, hit_events(spark, sf_dir))


def raw_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hits with the published date as the vendor string."""
    return with_raw_dates(hits(spark, sf_dir))


def first_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, published_dt) of every document's first hit, from events alone."""
    return hit_events(spark, sf_dir).groupBy("doc_id").agg(F.min("published_dt").alias("published_dt"))


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """topic_0..topic_7 from the users seen in events."""
    ev = read(spark, sf_dir, "events")
    i = (F.col("user_id") % N_TOPICS)
    t = ev.select(i.alias("i")).distinct()
    return t.select(
        F.concat(F.lit("topic_"), F.col("i").cast("string")).alias("topic_id"),
        topic_name(F.concat(F.lit("topic_"), F.col("i").cast("string"))).alias("topic"),
        (F.col("i") % 4 != 3).alias("is_active"),
        (F.lit(5) + F.col("i") % 3).cast("int").alias("daily_publishing_limit"),
        F.lit(RUN_MAX_RESULTS).alias("max_aggregator_results"),
        F.when(F.col("i") % 2 == 0, F.lit(dt.datetime(2024, 1, 25)))
        .when(F.col("i") == 3, F.lit(TODAY))
        .otherwise(F.lit(None).cast("timestamp")).alias("last_publishing_date"),
    )


def aggregators(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    a = ev.select(_aggregator_of(F.col("event_id")).alias("aggregator_id")).distinct()
    horizon = (F.when(F.col("aggregator_id") == AGGREGATORS[0], HORIZON_DAYS[AGGREGATORS[0]])
               .when(F.col("aggregator_id") == AGGREGATORS[1], HORIZON_DAYS[AGGREGATORS[1]])
               .otherwise(HORIZON_DAYS[AGGREGATORS[2]]))
    return a.select("aggregator_id", F.lit(True).alias("is_active"),
                    horizon.cast("int").alias("horizon_days"))


def runs(spark: SparkSession, sf_dir: str, h: DataFrame | None = None) -> DataFrame:
    """One fetch run per (topic, aggregator) seen in hits.

    Every event finds its document (the key is taken modulo the document
    count), so the run keys come from events alone; no text is read.
    """
    ev = read(spark, sf_dir, "events")
    keys = ev.select(
        F.concat(F.lit("topic_"), (F.col("user_id") % N_TOPICS).cast("string")).alias("topic_id"),
        _aggregator_of(F.col("event_id")).alias("aggregator_id")).distinct()
    return keys.select(
        "topic_id", "aggregator_id", topic_name(F.col("topic_id")).alias("topic"),
        F.lit(RUN_START).alias("start_dt"), F.lit(RUN_END).alias("end_dt"),
        F.lit(RUN_MAX_RESULTS).alias("max_results"), F.lit("relevance").alias("sorting"))


def watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hit_events(spark, sf_dir)
    return (h.filter((F.col("published_dt") < F.lit(WATERMARK_BEFORE)) & (F.col("topic_id") != "topic_5"))
            .groupBy("topic_id", "aggregator_id").agg(F.max("published_dt").alias("last_end")))


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """src0..src13 as trusted English providers; multiples of 5 inactive."""
    docs = read(spark, sf_dir, "documents")
    num = F.regexp_extract(F.col("source"), r"^src([0-9]+)$", 1)
    s = (docs.select("source").distinct()
         .filter(num.try_cast("int") <= TRUSTED_MAX_SOURCE))
    n = F.regexp_extract(F.col("source"), r"^src([0-9]+)$", 1).try_cast("int")
    return s.select(
        F.lit("en").alias("language"),
        F.concat(F.col("source"), F.lit(".example.com")).alias("provider_domain"),
        F.col("source").alias("provider_name"), F.lit("us").alias("country"),
        (n % 5 != 0).alias("is_active"))


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = read(spark, sf_dir, "labels")
    d = (F.when((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit("PUBLISH"))
         .when(F.col("toxic") == 1, F.lit("REJECT")).otherwise(F.lit("SKIP")))
    return lab.select("doc_id", d.alias("decision"))


def cluster_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("cluster"), F.col("turn").alias("position"), "text")


def sourced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored sourced article per document seen in hits.

    status: doc_id % 4 = 0 APPROVED, 1 REJECTED, else PENDING; published day
    is the day of the document's first hit; topic is topic_{doc_id % 8}.
    """
    g = first_hits(spark, sf_dir).withColumnRenamed("published_dt", "dt_published")
    titles = read(spark, sf_dir, "documents").select("doc_id", F.substring_index(F.col("text"), "\n", 1).alias("title"))
    g = g.join(titles, "doc_id")   # only the title crosses the join, not the text
    status = (F.when(F.col("doc_id") % 4 == 0, F.lit("APPROVED"))
              .when(F.col("doc_id") % 4 == 1, F.lit("REJECTED")).otherwise(F.lit("PENDING")))
    topic_id = F.concat(F.lit("topic_"), (F.col("doc_id") % N_TOPICS).cast("string"))
    return g.select(
        topic_id.alias("topic_id"), topic_name(topic_id).alias("topic"),
        F.concat(F.date_format("dt_published", "yyyy-MM-dd-HH-mm-ss-SSSSSS"), F.lit("#doc-"),
                 F.col("doc_id").cast("string")).alias("sourced_article_id"),
        "doc_id", "dt_published",
        (F.col("dt_published") + F.expr("INTERVAL 1 HOUR")).alias("dt_sourced"),
        F.date_format("dt_published", "yyyy/MM/dd").alias("date_published"),
        "title", status.alias("article_approval_status"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregation requests for topic_{user_id % 10} x aggregator: topic_8 and
    topic_9 do not exist, topics 3 and 7 are inactive (F6 rejects them)."""
    ev = read(spark, sf_dir, "events")
    k = ev.select(F.concat(F.lit("topic_"), (F.col("user_id") % 10).cast("string")).alias("topic_id"),
                  _aggregator_of(F.col("event_id")).alias("aggregator_id")).distinct()
    return k.select("topic_id", "aggregator_id", F.lit(RUN_START).alias("start_dt"),
                    (F.lit(RUN_START) + F.expr("INTERVAL 1 DAY")).alias("end_dt"),
                    F.when(F.col("aggregator_id") == AGGREGATORS[0], F.lit("date"))
                    .otherwise(F.lit("relevance")).alias("sorting"))


def desired_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Desired trusted list: src3..src16 (every source listed twice, as a
    provider file with a repeated line would)."""
    docs = read(spark, sf_dir, "documents")
    num = F.regexp_extract(F.col("source"), r"^src([0-9]+)$", 1)
    s = docs.select("source").distinct().filter(num.try_cast("int").between(3, 16))
    one = s.select(F.lit("en").alias("language"), F.concat(F.col("source"), F.lit(".example.com")).alias("provider_domain"),
                   F.col("source").alias("provider_name"))
    return one.unionByName(one)
