"""Collect stage: F1 -> W1 -> W2 -> W3 -> F2 -> F3 -> F4 -> J2 -> W4.

All runs are processed in one plan keyed by the run (topic_id, aggregator_id).
A run's quota is met by page ``quota`` at the latest, because every page before
the stop page adds a new row. So only its first ``quota * page_size`` arrivals
can become candidates, and ``paged`` finds them from grouped counts of (run,
arrival bucket): it keeps the buckets that begin below that rank and ranks rows
within their bucket. Later windows over a run see those arrivals alone, however
many hits the run has, and attributes of the hits are joined after the cut.

``page_stops`` (W2) reports on whole runs and uses grouped sums only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import FETCH_MULTIPLIER, NEEDS_TRUST, PAGE_SIZE
from ..functions.dates import std_published
from ..functions.ids import article_id
from .sizing import bucket_offsets, rank_within

RUN = ["topic_id", "aggregator_id"]


def needs_trust(aggregator: Column) -> Column:
    flagged = [a for a, v in NEEDS_TRUST.items() if v]
    return aggregator.isin(*flagged)


def flt_undated(df: DataFrame, raw: str = "raw_published") -> DataFrame:
    """drop rows whose published date is null or empty."""
    return df.filter(is_dated(raw))


def is_dated(raw: str) -> Column:
    return F.col(raw).isNotNull() & (F.col(raw) != "")


def url_first_seen(df: DataFrame, raw: str | None = "raw_published",
                   order: str = "event_id") -> DataFrame:
    """W1 over whole runs: the first dated occurrence of every URL per run.

    A grouped min instead of a window: partial aggregation before the
    shuffle makes a URL (or run) holding a third of the rows cheap.
    """
    src = df.filter(is_dated(raw)) if raw else df
    return (src.groupBy(*RUN, "url")
            .agg(F.min(order).alias("first_event_id"), F.count(F.lit(1)).alias("n_seen")))


def paged(df: DataFrame, runs: DataFrame, page_size: int = PAGE_SIZE,
          multiplier: int = FETCH_MULTIPLIER, order: str = "event_id") -> DataFrame:
    """Attach run parameters and the arrival rank / page of every hit that
    can matter (rank <= max_results * multiplier * page_size of its run)."""
    bound = F.col("max_results") * F.lit(multiplier * page_size)
    r = runs.select(*RUN, "topic", "start_dt", "end_dt", "max_results", "sorting")
    kept = bucket_offsets(df, RUN, order).join(r, RUN).filter(F.col("_offset") < bound)
    ranked = rank_within(df, RUN, order, name="arrival_rank", offsets=kept).filter(F.col("arrival_rank") <= bound)
    return ranked.withColumn("page", F.floor((F.col("arrival_rank") - 1) / page_size).cast("long"))


def mark_new(df: DataFrame, raw: str = "raw_published") -> DataFrame:
    """W1 on the paged rows: first dated occurrence of a URL in its run
    (undated rows never claim a URL, so F1 effectively precedes W1)."""
    df = df.withColumn("_dated", is_dated(raw))
    w = Window.partitionBy(*RUN, "url", "_dated").orderBy("arrival_rank")
    return df.withColumn("is_new", F.col("_dated") & (F.row_number().over(w) == 1)).drop("_dated")


def page_stop(df: DataFrame) -> DataFrame:
    """W2 on the paged rows: paging ends at the first page without a new row."""
    new_in_page = F.sum(F.col("is_new").cast("int")).over(Window.partitionBy(*RUN, "page"))
    df = df.withColumn("new_in_page", new_in_page)
    stop = F.min(F.when(F.col("new_in_page") == 0, F.col("page"))).over(Window.partitionBy(*RUN))
    return df.withColumn("stop_page", stop)


def page_stops(df: DataFrame, page_size: int = PAGE_SIZE, raw: str = "raw_published",
               order: str = "event_id") -> DataFrame:
    """W2 over whole runs: n_pages, stop_page (null if every page brought a
    new row) and n_new_before_stop per run, from sums per page."""
    first = url_first_seen(df, raw, order).select(*RUN, F.col("first_event_id").alias(order), F.lit(1).alias("_new"))
    rows = rank_within(df.select(*RUN, order), RUN, order, name="arrival_rank").join(first, [*RUN, order], "left")
    page = F.floor((F.col("arrival_rank") - 1) / page_size).cast("long").alias("page")
    pages = rows.groupBy(*RUN, page).agg(F.count("_new").alias("new_in_page"))
    stop = pages.groupBy(*RUN).agg(F.min(F.when(F.col("new_in_page") == 0, F.col("page"))).alias("stop_page"))
    before = F.col("stop_page").isNull() | (F.col("page") < F.col("stop_page"))
    return (pages.join(stop, RUN).groupBy(*RUN)
            .agg(F.count(F.lit(1)).alias("n_pages"), F.min("stop_page").alias("stop_page"),
                 F.coalesce(F.sum(F.when(before, F.col("new_in_page"))), F.lit(0)).alias("n_new_before_stop")))


def fetch_cap(df: DataFrame, multiplier: int = FETCH_MULTIPLIER) -> DataFrame:
    """The first ``max_results * multiplier`` new rows before the stop page."""
    keep = F.col("is_new") & (F.col("stop_page").isNull() | (F.col("page") < F.col("stop_page")))
    c = df.filter(keep)
    w = Window.partitionBy(*RUN).orderBy("arrival_rank")
    c = c.withColumn("candidate_rank", F.row_number().over(w))
    return c.filter(F.col("candidate_rank") <= F.col("max_results") * multiplier)


def with_published(df: DataFrame, raw: str | None = "raw_published") -> DataFrame:
    if raw is None:
        return df
    return df.withColumn("published_dt", std_published(F.col(raw), F.col("aggregator_id")))


def flt_window(df: DataFrame) -> DataFrame:
    """start <= published <= end, both ends inclusive (unparsable -> out)."""
    return df.filter(F.col("published_dt").between(F.col("start_dt"), F.col("end_dt")))


def flt_has_body(df: DataFrame, body: str = "body") -> DataFrame:
    """drop rows without an extracted body. ``body`` is the text or a
    precomputed boolean flag (so large bodies need not travel with the row)."""
    if isinstance(df.schema[body].dataType, T.BooleanType):
        return df.filter(F.coalesce(F.col(body), F.lit(False)))
    return df.filter(F.col(body).isNotNull() & (F.length(F.col(body)) > 0))


def flt_has_description(df: DataFrame, description: str = "description") -> DataFrame:
    """drop rows without a description, for aggregators that require one."""
    ok = F.col(description).isNotNull() & (F.length(F.col(description)) > 0)
    return df.filter(~needs_trust(F.col("aggregator_id")) | ok)


def join_trusted(df: DataFrame, trusted: DataFrame, language: str = "en") -> DataFrame:
    """Keep rows whose provider is an active trusted provider
    (aggregators without a trust rule pass).

    The provider list is bounded by the per-request domain caps (500 / 50
    per language), so the planner broadcasts it by its size.
    """
    t = (trusted.filter((F.col("language") == language) & F.col("is_active"))
         .select("provider_domain").distinct().withColumn("_trusted", F.lit(True)))
    j = df.join(t, "provider_domain", "left")
    return j.filter(~needs_trust(F.col("aggregator_id")) | F.col("_trusted").isNotNull()).drop("_trusted")


def accept_cap(df: DataFrame) -> DataFrame:
    """Dense 0-based aggregation_index over accepted rows, first max_results.
    The id names the run's window too, so an article on the border of two
    windows (marks are inclusive) has an id in each."""
    w = Window.partitionBy(*RUN).orderBy("arrival_rank")
    a = df.withColumn("aggregation_index", F.row_number().over(w) - 1)
    a = a.filter(F.col("aggregation_index") < F.col("max_results"))
    return a.withColumn("article_id", article_id(F.col("aggregation_index"), F.col("topic_id"),
                                                 F.col("aggregator_id"), F.col("start_dt"), F.col("url")))


def collect(hits: DataFrame, runs: DataFrame, trusted: DataFrame, raw: str | None = "raw_published",
            body: str = "body", description: str = "description", until: str = "W4",
            page_size: int = PAGE_SIZE, multiplier: int = FETCH_MULTIPLIER,
            attributes: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The whole collect stage for every run at once; ``until`` stops early
    (W3, F2, F3, F4, J2, W4) so each step can be inspected. ``attributes``
    joins what the filters read to the arrivals that can matter."""
    if raw is None:
        hits = hits.withColumn("_raw_present", F.lit("x"))
    p = paged(hits, runs, page_size, multiplier)
    p = page_stop(mark_new(attributes(p) if attributes else p, raw or "_raw_present"))
    steps = [("W3", lambda c: fetch_cap(c, multiplier)),
             ("F2", lambda c: flt_window(with_published(c, raw))),
             ("F3", lambda c: flt_has_body(c, body)),
             ("F4", lambda c: flt_has_description(c, description)),
             ("J2", lambda c: join_trusted(c, trusted)),
             ("W4", accept_cap)]
    for name, step in steps:
        p = step(p)
        if name == until:
            return p
    raise ValueError(f"no step {until}")
