"""P5: vendor request parameters for planned fetch windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import BING, BING_FRESHNESS, DOMAIN_CAP


def request_columns(windows: DataFrame, trusted: DataFrame, language: str = "en") -> DataFrame:
    days = F.floor((F.col("end_dt").cast("long") - F.col("start_dt").cast("long")) / 86400)
    fresh = None
    for n, word in BING_FRESHNESS.items():
        fresh = F.when(days == n, F.lit(word)) if fresh is None else fresh.when(days == n, F.lit(word))
    # comma-joined trusted domains: one scalar, bounded by the vendor caps
    # (500 / 50); a list over the cap is reported in request_error
    domains = (trusted.filter(F.col("is_active") & (F.col("language") == language))
               .select(F.array_join(F.array_sort(F.collect_set("provider_domain")), ",")).scalar())
    n_domains = (trusted.filter(F.col("is_active") & (F.col("language") == language))
                 .select(F.count_distinct("provider_domain")).scalar())
    cap = F.lit(None).cast("int")
    for agg, n in DOMAIN_CAP.items():
        cap = F.when(F.col("aggregator_id") == agg, F.lit(n)).otherwise(cap)
    error = (F.when((F.col("aggregator_id") == BING) & fresh.isNull(), F.lit("unsupported timeframe"))
             .when(cap.isNotNull() & (n_domains > cap), F.lit("too many provider domains")))
    return windows.select(
        "topic_id", "aggregator_id", F.url_encode(F.col("topic")).alias("topic_query"),
        F.date_format("start_dt", "yyyy-MM-dd'T'HH:mm:ss").alias("from_param"),
        F.date_format("end_dt", "yyyy-MM-dd'T'HH:mm:ss").alias("to_param"),
        F.when(F.col("aggregator_id") == BING, fresh).alias("freshness"),
        F.when(F.col("aggregator_id") != BING, domains).alias("include_domains"),
        error.alias("request_error"))
