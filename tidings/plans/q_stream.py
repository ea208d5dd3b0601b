"""Contract queries for the streaming operators.

Inputs are derived from the driver tables and landed as files (one
parallel write) before the stream starts; ``availableNow`` then consumes
everything available, and the final no-data batch advances the watermark
to (newest event - delay), which closes the daily windows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import iso_utc
from ..operators import publish as P
from ..operators.schedule import _iso_offset
from ..session import scratch_path
from ..streaming import streams as ST
from . import adapters as A
from .catalog import ISO, query
from .oracle_ctes import with_views


def land_hits(spark, sf):
    """raw_hits landed once as the stream's input folder (one parallel
    write, partitioned by day as a feed would land them)."""
    h = A.raw_hits(spark, sf).select("event_id", "topic_id", "aggregator_id", "url", "raw_published", "published_dt")
    path = scratch_path(spark, "hits-stream")
    h.withColumn("day", F.to_date("published_dt")).write.mode("overwrite").partitionBy("day").parquet(path)
    return path, h.schema


def _stream_files(path):
    return f"{path}/day=*"


@query("st_requests", with_views("SELECT topic_id, aggregator_id, reject_reason FROM validated", "validated"))
def st_requests(spark, sf):
    """Request messages consumed as a stream, each delivered twice in two batches, validated once."""
    req = A.requests(spark, sf)
    msgs = req.select(F.to_json(F.struct("topic_id", "aggregator_id",
                                         _iso_offset(F.col("start_dt")).alias("aggregation_data_start_dt"),
                                         _iso_offset(F.col("end_dt")).alias("aggregation_data_end_dt"),
                                         "sorting", F.concat_ws("/", "topic_id", "aggregator_id").alias("message_id"),
                                         _iso_offset(F.col("start_dt")).alias("sent_at"))).alias("value"))
    path, out = scratch_path(spark, "requests-in"), scratch_path(spark, "requests-out")
    # dimensions are kept between micro-batches
    topics, aggs, trusted = A.topics(spark, sf).persist(), A.aggregators(spark, sf).persist(), A.trusted(spark, sf).persist()
    for _ in range(2):
        msgs.write.mode("append").text(path)
        done = ST.requests_stream(spark, path, lambda b: P.validate_requests(b, topics, aggs, trusted), out)
    return done.select("topic_id", "aggregator_id", "reject_reason")


@query("st_url_dedup", with_views(
    "SELECT DISTINCT topic_id, aggregator_id, url FROM raw_hits WHERE raw_published IS NOT NULL AND raw_published <> ''",
    "raw_hits"))
def st_url_dedup(spark, sf):
    """(run, url) keys kept by streaming dedup within the watermark."""
    path, schema = land_hits(spark, sf)
    d = ST.url_dedup_stream(spark, _stream_files(path), schema)
    return d.select("topic_id", "aggregator_id", "url")


@query("st_high_watermark", with_views(
    f"SELECT topic_id, aggregator_id, {ISO('max(published_dt)')} AS last_end FROM hits GROUP BY topic_id, aggregator_id",
    "hits"))
def st_high_watermark(spark, sf):
    """Per (topic, aggregator) the newest published time, kept as state."""
    path, schema = land_hits(spark, sf)
    m = ST.high_watermark_stream(spark, _stream_files(path), schema)
    return m.select("topic_id", "aggregator_id", iso_utc(F.col("last_end")).alias("last_end"))


@query("st_daily_window", with_views(f"""
SELECT {ISO('window_start')} AS window_start, aggregator_id, count(*) AS n_hits FROM (
  SELECT date_trunc('day', published_dt) AS window_start, aggregator_id, published_dt FROM hits) h
WHERE window_start + INTERVAL 1 DAY <= (SELECT max(published_dt) FROM hits) - INTERVAL 1 HOUR
GROUP BY window_start, aggregator_id""", "hits"))
def st_daily_window(spark, sf):
    """T4: hits per closed 1-day window and aggregator (append mode)."""
    path, schema = land_hits(spark, sf)
    w = ST.daily_window_stream(spark, _stream_files(path), schema)
    return w.select(iso_utc(F.col("window_start")).alias("window_start"), "aggregator_id", "n_hits")


@query("st_late_rows", with_views("""
SELECT h.topic_id, h.aggregator_id, count(*) FILTER (WHERE published_dt BETWEEN start_dt AND end_dt) AS n_in_window,
       count(*) FILTER (WHERE NOT (published_dt BETWEEN start_dt AND end_dt)) AS n_late
FROM hits h JOIN runs r ON r.topic_id = h.topic_id AND r.aggregator_id = h.aggregator_id
GROUP BY h.topic_id, h.aggregator_id""", "hits", "runs"))
def st_late_rows(spark, sf):
    """T5: per run, rows inside the requested window and rows outside it."""
    path, schema = land_hits(spark, sf)
    return ST.late_rows_stream(spark, _stream_files(path), schema, A.runs(spark, sf))
