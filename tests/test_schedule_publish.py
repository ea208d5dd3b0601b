"""Scheduling, marks, validation, upserts and review."""

import datetime as dt

from pyspark.sql import functions as F

from tidings.operators import publish as P
from tidings.operators import schedule as S

TODAY = dt.datetime(2024, 1, 31)


def test_fetch_windows_from_mark_and_horizon(spark):
    pairs = spark.createDataFrame([("t1", "newsapi.org"), ("t2", "bingnews"), ("t3", "newsapi.org")],
                                  "topic_id string, aggregator_id string")
    marks = spark.createDataFrame([("t1", "newsapi.org", dt.datetime(2024, 1, 29, 6, 0)),
                                   ("t3", "newsapi.org", dt.datetime(2024, 2, 5))],
                                  "topic_id string, aggregator_id string, last_end timestamp")
    aggs = spark.createDataFrame([("newsapi.org", True, 30), ("bingnews", True, 1)],
                                 "aggregator_id string, is_active boolean, horizon_days int")
    w = S.fetch_windows(pairs, marks, aggs, TODAY).orderBy("topic_id", "start_dt").collect()
    got = [(r.topic_id, r.start_dt, r.end_dt) for r in w]
    assert got == [("t1", dt.datetime(2024, 1, 29, 6), dt.datetime(2024, 1, 30, 6)),
                   ("t1", dt.datetime(2024, 1, 30, 6), dt.datetime(2024, 1, 31, 6)),
                   ("t2", dt.datetime(2024, 1, 30), dt.datetime(2024, 1, 31)),
                   ("t2", dt.datetime(2024, 1, 31), dt.datetime(2024, 2, 1))]


def test_sourcing_dates(spark):
    topics = spark.createDataFrame([("a", True, dt.datetime(2024, 1, 29, 8)), ("b", True, TODAY),
                                    ("c", True, None), ("d", False, None)],
                                   "topic_id string, is_active boolean, last_publishing_date timestamp")
    d = S.sourcing_dates(topics, F.lit(dt.datetime(2024, 1, 30)), TODAY).orderBy("topic_id", "sourcing_date")
    got = [(r.topic_id, r.sourcing_date.day) for r in d.collect()]
    assert got == [("a", 30), ("a", 31), ("b", 31), ("c", 30), ("c", 31)]


def test_high_watermark_ignores_sentinels_and_never_goes_back(spark):
    old = spark.createDataFrame([("t", "a", dt.datetime(2024, 1, 20)), ("t", "b", dt.datetime(2024, 1, 20))],
                                "topic_id string, aggregator_id string, last_end timestamp")
    new = spark.createDataFrame([("t", "a", dt.datetime(2024, 1, 10)), ("t", "b", dt.datetime(1, 1, 1)),
                                 ("t", "c", dt.datetime(2024, 1, 25))],
                                "topic_id string, aggregator_id string, proposed_end timestamp")
    got = {r.aggregator_id: r.last_end for r in S.high_watermark(old, new).collect()}
    assert got == {"a": dt.datetime(2024, 1, 20), "b": dt.datetime(2024, 1, 20), "c": dt.datetime(2024, 1, 25)}


def test_messages(spark):
    w = spark.createDataFrame([("t1", "bingnews", dt.datetime(2024, 1, 30), dt.datetime(2024, 1, 31))],
                              "topic_id string, aggregator_id string, start_dt timestamp, end_dt timestamp")
    m = S.aggregation_messages(w).first()
    assert m.message_group_id == "bingnews-t1"
    assert m.message_body == ('{"topic_id":"t1","aggregator_id":"bingnews","aggregation_data_start_dt":'
                              '"2024-01-30T00:00:00+00:00","aggregation_data_end_dt":"2024-01-31T00:00:00+00:00"}')


def test_provider_sync_actions(spark):
    cur = spark.createDataFrame([("en", "a.com", True), ("en", "b.com", False), ("en", "c.com", True),
                                 ("en", "d.com", False)], "language string, provider_domain string, is_active boolean")
    want = spark.createDataFrame([("en", "a.com", "A"), ("en", "b.com", "B"), ("en", "e.com", "E"), ("en", "e.com", "E")],
                                 "language string, provider_domain string, provider_name string")
    got = sorted((r.provider_domain, r.action) for r in P.provider_sync(cur, want).collect())
    assert got == [("a.com", "KEEP"), ("b.com", "REACTIVATE"), ("c.com", "DEACTIVATE"), ("e.com", "NEW")]
    assert [r.provider_domain for r in P.deactivated(cur, want).collect()] == ["c.com"]


def test_decisions_and_counters(spark):
    pend = spark.createDataFrame([(1, "t", "2024/01/02"), (2, "t", "2024/01/02"), (3, "t", "2024/01/03"),
                                  (4, "u", "2024/01/02")], "doc_id long, topic_id string, date_published string")
    dec = spark.createDataFrame([(1, "PUBLISH"), (2, "REJECT"), (3, "PUBLISH")], "doc_id long, decision string")
    r = P.apply_decisions(pend, dec)
    assert sorted((x.doc_id, x.new_status) for x in r.collect()) == [
        (1, "APPROVED"), (2, "REJECTED"), (3, "APPROVED"), (4, "PENDING")]
    counters = spark.createDataFrame([("t", "2024/01/02", 5)], "topic_id string, date_published string, published_count long")
    up = P.published_upsert(counters, r.filter("new_status = 'APPROVED'"))
    assert sorted((x.date_published, x.published_count) for x in up.collect()) == [("2024/01/02", 6), ("2024/01/03", 1)]


def test_insert_if_absent_and_upsert(spark):
    t = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    n = spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int")
    assert sorted(tuple(r) for r in P.insert_if_absent(t, n, ["k"]).collect()) == [("a", 1), ("b", 1), ("c", 2)]
    assert sorted(tuple(r) for r in P.upsert(t, n, ["k"]).collect()) == [("a", 1), ("b", 2), ("c", 2)]


def test_entity_checks(spark):
    cands = spark.createDataFrame([("1", "Generative AI", 10, "en"), ("2", "generative ai", 10, "en"),
                                   ("3", "Space", 0, "en"), ("4", "Old", 5, "en"), ("5", "New", 5, "eng")],
                                  "candidate_id string, topic string, max_aggregator_results int, language string")
    existing = spark.createDataFrame([("OLD",)], "topic string")
    got = sorted((r.candidate_id, r.reject_reason) for r in P.entity_checks(cands, existing).collect())
    assert got == [("1", None), ("2", "duplicate in batch"), ("3", "max results not positive"),
                   ("4", "topic exists"), ("5", "language must have 2 letters")]


def test_request_columns(spark):
    from tidings.functions.requests import request_columns
    w = spark.createDataFrame([("t", "bingnews", "Generative AI", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 8)),
                               ("t", "bingnews", "Generative AI", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3)),
                               ("t", "thenewsapi.com", "Generative AI", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))],
                              "topic_id string, aggregator_id string, topic string, start_dt timestamp, end_dt timestamp")
    tr = spark.createDataFrame([("en", f"d{i}.com", True) for i in range(51)],
                               "language string, provider_domain string, is_active boolean")
    got = [(r.topic_query, r.freshness, r.request_error) for r in request_columns(w, tr).collect()]
    assert got == [("Generative+AI", "Week", None), ("Generative+AI", None, "unsupported timeframe"),
                   ("Generative+AI", None, "too many provider domains")]


def test_observed_counts_without_extra_job(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    out, obs = P.observed(df.filter("v > 1"), "after_filter", ["v"])
    out.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 2, "sum_v": 5}


def test_observed_metrics_by_dimension(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    out, obs = P.observed(df, "by_k", counts={k: F.col("k") == k for k in "abc"})
    out.write.format("noop").mode("overwrite").save()
    assert [tuple(r) for r in P.observed_metrics(spark, "rows_of", obs, "k").collect()] == [
        ("rows_of", '{"k":"a"}', 2), ("rows_of", '{"k":"b"}', 1), ("rows_of", '{"k":"c"}', 0)]
    assert [tuple(r) for r in P.observed_metrics(spark, "rows_of", obs).collect()] == [("rows_of", "{}", 3)]
