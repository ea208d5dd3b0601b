"""Vendor published-date strings -> UTC timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import AGGREGATORS, PUBLISHED_DATE_FORMAT, PUBLISHED_DATE_REGEX


def std_published(raw: Column, aggregator: Column) -> Column:
    """Anchored per-aggregator pattern, then parse; anything else is null.

    One CASE expression, evaluated inside whole-stage codegen; the pattern is
    chosen by the row's aggregator so one plan serves all vendors.
    """
    expr = None
    for agg in AGGREGATORS:
        cond = (aggregator == F.lit(agg)) & raw.rlike(PUBLISHED_DATE_REGEX[agg])
        val = F.try_to_timestamp(raw, F.lit(PUBLISHED_DATE_FORMAT[agg]))
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(F.lit(None).cast("timestamp"))


def iso_utc(ts: Column) -> Column:
    """Timestamp rendered with a fixed microsecond format (contract output)."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def vendor_date_string(ts: Column, aggregator: Column) -> Column:
    """Inverse of :func:`std_published`: the string each vendor sends."""
    micro = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    secs = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return (F.when(aggregator == "bingnews", F.concat(micro, F.lit("0Z")))
            .when(aggregator == "newsapi.org", F.concat(secs, F.lit("Z")))
            .otherwise(F.concat(micro, F.lit("Z"))))
