"""Collect stage on hand-written hits (dedup, page stop, caps, filters)."""

import datetime as dt

from pyspark.sql import functions as F

from tidings.operators import collect as C

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)
SCHEMA = ("event_id long, topic_id string, aggregator_id string, url string, raw_published string, "
          "provider_domain string, has_body boolean, description string")


def bing_date(ts):
    return ts.strftime("%Y-%m-%dT%H:%M:%S.%f") + "0Z"


def newsapi_date(ts):
    return ts.strftime("%Y-%m-%dT%H:%M:%SZ")


def runs(spark, agg="bingnews", max_results=100, start=dt.datetime(2024, 1, 1), end=dt.datetime(2024, 1, 31)):
    return spark.createDataFrame([("t1", agg, "Topic 1", start, end, max_results, "relevance")],
                                 "topic_id string, aggregator_id string, topic string, start_dt timestamp, "
                                 "end_dt timestamp, max_results int, sorting string")


def trusted(spark, domains=("good.com",)):
    return spark.createDataFrame([("en", d, d, "us", True) for d in domains],
                                 "language string, provider_domain string, provider_name string, country string, "
                                 "is_active boolean")


def hit(i, url, date="x", agg="bingnews", dom="good.com", body=True, desc="d"):
    raw = bing_date(T0 + dt.timedelta(minutes=i)) if date == "x" else date
    if agg == "newsapi.org" and date == "x":
        raw = newsapi_date(T0 + dt.timedelta(minutes=i))
    return (i, "t1", agg, url, raw, dom, body, desc)


def ids(df):
    return sorted(r.event_id for r in df.collect())


def run_collect(spark, rows, until="W4", **kw):
    h = spark.createDataFrame(rows, SCHEMA)
    return C.collect(h, kw.pop("runs", runs(spark)), kw.pop("trusted", trusted(spark)), body="has_body",
                     until=until, **kw)


def test_dedup_mask_keeps_first_occurrences(spark):
    # unique mask (T, F, T) -> rows 1 and 3
    rows = [hit(1, "a"), hit(2, "a"), hit(3, "b")]
    assert ids(run_collect(spark, rows, "W3")) == [1, 3]


def test_undated_row_is_dropped(spark):
    rows = [hit(1, "a"), hit(2, "a"), hit(3, "b", date="")]
    assert ids(run_collect(spark, rows, "W3")) == [1]


def test_undated_duplicate_does_not_claim_url(spark):
    rows = [hit(1, "a", date=None), hit(2, "a")]
    assert ids(run_collect(spark, rows, "W3")) == [2]


def test_page_without_new_rows_stops_paging(spark):
    # page size 2: page 0 = (a, b), page 1 = (a, b) duplicates only, page 2 = (c, d) new
    rows = [hit(1, "a"), hit(2, "b"), hit(3, "a"), hit(4, "b"), hit(5, "c"), hit(6, "d")]
    out = run_collect(spark, rows, "W3", page_size=2)
    assert ids(out) == [1, 2]


def test_fetch_cap_is_twice_max_results(spark):
    rows = [hit(i, f"u{i}") for i in range(1, 11)]
    out = run_collect(spark, rows, "W3", runs=runs(spark, max_results=3))
    assert ids(out) == [1, 2, 3, 4, 5, 6]


def test_window_is_inclusive_on_both_ends(spark):
    start, end = T0 + dt.timedelta(minutes=1), T0 + dt.timedelta(minutes=3)
    rows = [hit(i, f"u{i}") for i in range(0, 5)]
    out = run_collect(spark, rows, "F2", runs=runs(spark, start=start, end=end))
    assert ids(out) == [1, 2, 3]


def test_malformed_date_is_outside_every_window(spark):
    rows = [hit(1, "a", date="2024-01-10 12:00:00.0000000Z"), hit(2, "b")]
    assert ids(run_collect(spark, rows, "F2")) == [2]


def test_body_description_and_trust_rules(spark):
    rows = [hit(1, "a", agg="newsapi.org"), hit(2, "b", agg="newsapi.org", body=False),
            hit(3, "c", agg="newsapi.org", desc=""), hit(4, "d", agg="newsapi.org", dom="bad.com")]
    out = run_collect(spark, rows, "W4", runs=runs(spark, agg="newsapi.org"))
    assert ids(out) == [1]


def test_bing_is_exempt_from_trust_and_description(spark):
    rows = [hit(1, "a", desc=""), hit(2, "b", dom="bad.com"), hit(3, "c", body=False)]
    assert ids(run_collect(spark, rows, "W4")) == [1, 2]


def test_accept_index_is_dense_and_capped(spark):
    rows = [hit(1, "a"), hit(2, "b", body=False), hit(3, "c"), hit(4, "d"), hit(5, "e")]
    out = run_collect(spark, rows, "W4", runs=runs(spark, max_results=3)).orderBy("event_id")
    got = [(r.event_id, r.aggregation_index) for r in out.collect()]
    assert got == [(1, 0), (3, 1), (4, 2)]


def test_article_id_shape(spark):
    rows = [hit(1, "a")]
    aid = run_collect(spark, rows).select("article_id").first()[0]
    assert len(aid) == 43 and aid.startswith("000000#") and aid.count("-") == 4


def test_url_first_seen_over_whole_runs(spark):
    h = spark.createDataFrame([hit(3, "a"), hit(1, "a"), hit(2, "b", date="")], SCHEMA)
    out = C.url_first_seen(h).collect()
    assert [(r.url, r.first_event_id, r.n_seen) for r in out] == [("a", 1, 2)]


def test_whitespace_date_is_a_date(spark):
    # only null and empty strings are undated; a blank one claims its URL and fails to parse later
    assert ids(run_collect(spark, [hit(1, "a", date=" "), hit(2, "a")], "W3")) == [1]
    assert ids(run_collect(spark, [hit(1, "a", date=" "), hit(2, "a")], "F2")) == []


def test_page_stops_counts_whole_runs(spark):
    # 30 000 distinct dated hits in one run: every one of its 300 pages is new
    big = spark.range(1, 30_001).select(F.col("id").alias("event_id"), F.lit("t1").alias("topic_id"), F.lit("bingnews").alias("aggregator_id"),
                                        F.concat(F.lit("u"), "id").alias("url"), F.lit("x").alias("raw_published"))
    assert [tuple(r)[2:] for r in C.page_stops(big).collect()] == [(300, None, 30_000)]
    again = big.withColumn("url", F.concat(F.lit("u"), F.when(F.col("event_id") > 25_000, F.lit(1)).otherwise(F.col("event_id")).cast("string")))
    assert [tuple(r)[2:] for r in C.page_stops(again).collect()] == [(300, 250, 25_000)]


def test_only_arrivals_that_can_matter_pass_the_cut(spark):
    """Scale guard: buckets of arrivals beyond the quota go before any window over a run."""
    hot = spark.range(0, 300_000).select(F.col("id").alias("event_id"), F.lit("t1").alias("topic_id"), F.lit("bingnews").alias("aggregator_id"))
    assert C.paged(hot, runs(spark, max_results=3)).count() == 600
    kept = C.bucket_offsets(hot, C.RUN, "event_id").filter("_offset < 600")
    assert kept.count() == 1
    plan = C.paged(hot, runs(spark))._jdf.queryExecution().executedPlan().toString()
    ranks = [line for line in plan.splitlines() if "row_number()" in line]
    assert ranks and all("_bucket" in line for line in ranks)
