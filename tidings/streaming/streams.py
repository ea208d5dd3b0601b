"""Structured Streaming operators.

Sources are file streams read with an explicit schema; sinks are
``foreachBatch`` writers that put each micro-batch under its own
``batch_id=<n>`` folder with overwrite, so a replayed batch (after a lost
executor or driver restart) replaces its own output instead of duplicating
it. Checkpoints live in the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

REQUEST_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in
                               ("topic_id", "aggregator_id", "aggregation_data_start_dt",
                                "aggregation_data_end_dt", "sorting", "message_id", "sent_at")])


def batch_writer(path: str, transform: Callable[[DataFrame, int], DataFrame] | None = None):
    """Idempotent foreachBatch sink: batch n always lands in <path>/batch_id=n."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch, batch_id) if transform else batch
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def state_writer(path: str, keys: list[str]):
    """foreachBatch sink of an update-mode aggregate: batch n writes the whole
    state, the rows of batch n - 1 whose keys it does not change and its own,
    to <path>/state=n and drops n - 2. Two states are kept however long the
    stream lives, a replayed batch writes the same, and a reader takes the last."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _states(spark, path)
        out = batch
        if batch_id - 1 in before:
            old = spark.read.parquet(f"{path}/state={batch_id - 1}")
            out = old.join(batch.select(*keys), keys, "left_anti").unionByName(batch)
        out.write.mode("overwrite").parquet(f"{path}/state={batch_id}")
        for n in before:
            if n < batch_id - 1:
                _fs(spark, path).delete(_path(spark, f"{path}/state={n}"), True)

    return write


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _states(spark: SparkSession, path: str) -> list[int]:
    found = _fs(spark, path).globStatus(_path(spark, f"{path}/state=*"))
    return sorted(int(f.getPath().getName().split("=")[1]) for f in found or [])


def last_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/state={_states(spark, path)[-1]}")


def file_stream(spark: SparkSession, fmt: str, path: str, schema: T.StructType,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """File-stream source with an explicit schema; optionally rate-limited
    (files are taken oldest first, so a limit replays the arrival order)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.format(fmt).load(path)


def run_available_now(stream: DataFrame, sink: Callable, checkpoint: str, mode: str = "append") -> None:
    q = (stream.writeStream.outputMode(mode).foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def parse_requests(raw: DataFrame) -> DataFrame:
    """Request messages -> typed columns (ISO strings with offsets -> timestamps).

    message_id is the sender's, or else the hash of what the message says;
    messages with one group key (aggregator and topic) have an order, by
    sent_at and id.
    """
    ts = lambda c: F.try_to_timestamp(F.col(c))  # noqa: E731  (malformed -> null, F6 rejects)
    said = ["topic_id", "aggregator_id", "aggregation_data_start_dt", "aggregation_data_end_dt", "sorting"]
    return raw.select("topic_id", "aggregator_id", ts("aggregation_data_start_dt").alias("start_dt"),
                      ts("aggregation_data_end_dt").alias("end_dt"), "sorting",
                      F.coalesce("message_id", F.sha2(F.to_json(F.struct(*said)), 256)).alias("message_id"),
                      F.concat_ws("-", "aggregator_id", "topic_id").alias("message_group"),
                      ts("sent_at").alias("sent_at"))


def requests_stream(spark: SparkSession, path: str, validate: Callable[[DataFrame], DataFrame],
                    out: str | None = None, remember: str = "14 days", max_files_per_trigger: int | None = None) -> DataFrame:
    """Consume request messages, validate every micro-batch against the
    dimension tables (F6) and route rejects; returns the stored results.

    A message that is delivered again, in one batch or in several, is processed
    once: its id is kept as state for ``remember`` after it came in. The time of
    arrival is the event time, so no message is late.
    ``position`` is a message's place in its group within the batch; batches are
    numbered, so (batch_id, position) is the order of a group. A batch that is
    replayed replaces its own results.
    """
    out = out or scratch_path(spark, "requests-out")
    src = parse_requests(file_stream(spark, "json", path, REQUEST_SCHEMA, max_files_per_trigger))
    src = src.withColumn("received", F.current_timestamp()).withWatermark("received", remember)
    first = src.dropDuplicatesWithinWatermark(["message_id"]).drop("received")
    order = Window.partitionBy("message_group").orderBy("sent_at", "message_id")

    def results(batch: DataFrame, _n: int) -> DataFrame:
        return validate(batch.withColumn("position", F.row_number().over(order)))

    run_available_now(first, batch_writer(out, results), f"{out}/_checkpoint")
    return spark.read.parquet(out)


def url_dedup_stream(spark: SparkSession, path: str, schema: T.StructType, delay: str = "60 days",
                     out: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """First sighting of each (run, url) on a stream of dated hits.

    The watermark delay must exceed the span of a run so that state for a
    key lives as long as the run can repeat it.
    """
    out = out or scratch_path(spark, "dedup-out")
    src = file_stream(spark, "parquet", path, schema, max_files_per_trigger)
    src = src.filter(F.col("raw_published").isNotNull() & (F.col("raw_published") != ""))
    d = (src.withColumn("published_dt", F.col("published_dt").cast("timestamp"))
         .withWatermark("published_dt", delay)
         .dropDuplicatesWithinWatermark(["topic_id", "aggregator_id", "url"]))
    run_available_now(d.select("topic_id", "aggregator_id", "url", "event_id"), batch_writer(out), f"{out}/_checkpoint")
    return spark.read.parquet(out).drop("batch_id")


def high_watermark_stream(spark: SparkSession, path: str, schema: T.StructType,
                          out: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Running max(published_dt) per (topic, aggregator), update mode."""
    out = out or scratch_path(spark, "marks-out")
    src = file_stream(spark, "parquet", path, schema, max_files_per_trigger)
    agg = (src.withColumn("published_dt", F.col("published_dt").cast("timestamp"))
           .groupBy("topic_id", "aggregator_id").agg(F.max("published_dt").alias("last_end")))
    run_available_now(agg, state_writer(out, ["topic_id", "aggregator_id"]), f"{out}/_checkpoint", mode="update")
    return last_state(spark, out)


def daily_window_stream(spark: SparkSession, path: str, schema: T.StructType, delay: str = "1 hour",
                        out: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """T4: hits per 1-day tumbling window and aggregator; append mode emits
    a window only once the watermark has passed its end (closed windows)."""
    out = out or scratch_path(spark, "daily-out")
    src = file_stream(spark, "parquet", path, schema, max_files_per_trigger)
    agg = (src.withColumn("published_dt", F.col("published_dt").cast("timestamp"))
           .withWatermark("published_dt", delay)
           .groupBy(F.window("published_dt", "1 day"), "aggregator_id")
           .agg(F.count(F.lit(1)).alias("n_hits")))
    flat = agg.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                      "aggregator_id", "n_hits")
    run_available_now(flat, batch_writer(out), f"{out}/_checkpoint")
    return spark.read.parquet(out).drop("batch_id")


def late_rows_stream(spark: SparkSession, path: str, schema: T.StructType, windows: DataFrame,
                     out: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """T5: rows outside the window they were fetched for are flagged and
    counted per run (stream-static join with the requested windows)."""
    out = out or scratch_path(spark, "late-out")
    src = file_stream(spark, "parquet", path, schema, max_files_per_trigger)
    j = (src.withColumn("published_dt", F.col("published_dt").cast("timestamp"))
         .join(windows.select("topic_id", "aggregator_id", "start_dt", "end_dt"), ["topic_id", "aggregator_id"]))
    late = ~F.col("published_dt").between(F.col("start_dt"), F.col("end_dt"))
    agg = j.groupBy("topic_id", "aggregator_id").agg(F.count_if(~late).alias("n_in_window"),
                                                     F.count_if(late).alias("n_late"))
    run_available_now(agg, state_writer(out, ["topic_id", "aggregator_id"]), f"{out}/_checkpoint", mode="update")
    return last_state(spark, out)
