"""Scheduling: active pairs (J1), fetch windows (G3), sourcing dates (G4),
messages (G5), high-water marks (A12, F8) and the oldest horizon (A13)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import OLDEST_SUPPORTED_PUBLISHING_DATE

OLDEST = OLDEST_SUPPORTED_PUBLISHING_DATE.replace(tzinfo=None)


def active_pairs(topics: DataFrame, aggregators: DataFrame) -> DataFrame:
    """Every active topic with every active aggregator.

    The active aggregator ids (one for each vendor integration) become one
    array in a scalar subquery that is exploded per topic: a generator instead
    of a cartesian join, with no shuffle of the topic side.
    """
    ids = (aggregators.filter(F.col("is_active"))
           .select(F.array_sort(F.collect_set("aggregator_id")).alias("ids")).scalar())
    return topics.filter(F.col("is_active")).select("*", F.explode(ids).alias("aggregator_id"))


def horizon_start(today: dt.datetime, horizon_days: Column) -> Column:
    """Earliest day an aggregator serves: today - horizon, not before 2023-01-01."""
    return F.greatest(F.lit(today) - F.make_dt_interval(horizon_days), F.lit(OLDEST))


def fetch_windows(pairs: DataFrame, watermarks: DataFrame, aggregators: DataFrame,
                  today: dt.datetime) -> DataFrame:
    """1-day windows from the mark (or the horizon) while start <= today."""
    a = aggregators.select("aggregator_id", "horizon_days")
    w = pairs.join(watermarks, ["topic_id", "aggregator_id"], "left").join(a, "aggregator_id", "left")
    start = F.coalesce(F.col("last_end"), horizon_start(today, F.col("horizon_days")))
    w = w.withColumn("first_start", start).filter(F.col("first_start") <= F.lit(today))
    days = F.sequence(F.col("first_start"), F.lit(today), F.expr("INTERVAL 1 DAY"))
    w = w.select("*", F.explode(days).alias("start_dt"))
    return w.withColumn("end_dt", F.col("start_dt") + F.expr("INTERVAL 1 DAY")).drop("first_start")


def oldest_horizon(aggregators: DataFrame, today: dt.datetime, override_days: int | None = None) -> DataFrame:
    """Earliest supported day over active aggregators (override wins)."""
    o = aggregators.filter(F.col("is_active")).agg(
        F.min(horizon_start(today, F.col("horizon_days"))).alias("oldest"))
    if override_days is not None:
        o = o.select((F.lit(today) - F.make_dt_interval(F.lit(override_days))).alias("oldest"))
    return o


def sourcing_dates(topics: DataFrame, oldest: Column, today: dt.datetime) -> DataFrame:
    """Per active topic the days still to source, up to today.

    No last date -> start from the day before the oldest horizon; a last
    date of today is sourced again (aggregations of today are incomplete).
    """
    last = F.date_trunc("day", F.coalesce(F.col("last_publishing_date"), oldest - F.expr("INTERVAL 1 DAY")))
    start = F.when(last != F.lit(today), last + F.expr("INTERVAL 1 DAY")).otherwise(last)
    t = topics.filter(F.col("is_active")).withColumn("_s", start).filter(F.col("_s") <= F.lit(today))
    t = t.select("*", F.explode(F.sequence(F.col("_s"), F.lit(today), F.expr("INTERVAL 1 DAY"))).alias("sourcing_date"))
    return t.drop("_s")


def _iso_offset(ts: Column) -> Column:
    """Python's isoformat() of an aware UTC datetime."""
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(base, F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(F.lit("")),
                    F.lit("+00:00"))


def aggregation_messages(windows: DataFrame) -> DataFrame:
    """Routing key aggregator-topic and the JSON body of each request."""
    body = F.to_json(F.struct(F.col("topic_id"), F.col("aggregator_id"),
                              _iso_offset(F.col("start_dt")).alias("aggregation_data_start_dt"),
                              _iso_offset(F.col("end_dt")).alias("aggregation_data_end_dt")))
    return windows.select(F.concat_ws("-", "aggregator_id", "topic_id").alias("message_group_id"),
                          body.alias("message_body"))


def sourcing_messages(dates: DataFrame, frequency: float) -> DataFrame:
    body = F.to_json(F.struct(F.col("topic_id"), _iso_offset(F.col("sourcing_date")).alias("sourcing_date"),
                              F.lit(float(frequency)).alias("daily_sourcing_frequency")))
    return dates.select(F.col("topic_id").alias("message_group_id"), body.alias("message_body"))


def high_watermark(old: DataFrame, proposed: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """A12 + F8: last_end = greater of old and new per (topic, aggregator);
    a proposed end before year 2000 (an empty-run sentinel) is ignored. With
    ``now``, dt_last_aggregated is set beside every mark that a run proposed."""
    p = (proposed.filter(F.year("proposed_end") >= 2000)
         .groupBy("topic_id", "aggregator_id").agg(F.max("proposed_end").alias("proposed_end")))
    j = old.join(p, ["topic_id", "aggregator_id"], "full_outer")
    cols = ["topic_id", "aggregator_id", F.greatest("last_end", "proposed_end").alias("last_end")]
    if now is not None:
        kept = F.col("dt_last_aggregated") if "dt_last_aggregated" in old.columns else F.lit(None).cast("timestamp")
        cols.append(F.when(F.col("proposed_end").isNotNull(), F.lit(now)).otherwise(kept).alias("dt_last_aggregated"))
    return j.select(*cols)
