"""Vendor JSON sources, commented JSONL, candidate store and streams."""

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from tidings.session import scratch_path
from tidings.sources import candidates as CS
from tidings.sources import jsonl as JL
from tidings.sources import vendor as V
from tidings.streaming import streams as ST


def _bing_envelope(n):
    arts = [{"name": f"title {i}", "url": f"https://x.com/{i}", "description": f"d{i}",
             "datePublished": "2023-04-07T14:40:00.0000000Z", "category": "Business",
             "provider": [{"_type": "Organization", "name": "X"}],
             "about": [{"name": "ignored", "readLink": "r"}],
             "clusteredArticles": [{"name": "inner", "url": "u", "description": "d", "provider": []}]}
            for i in range(n)]
    arts[3].pop("url")
    arts[5]["provider"] = []
    return {"_type": "News", "envelope_id": "e1", "queryContext": {"originalQuery": "AI", "adultIntent": False},
            "totalEstimatedMatches": 36, "sort": [{"name": "Best match", "id": "relevance", "isSelected": True,
                                                   "url": "u"}], "value": arts}


def test_bing_envelope_flatten(spark):
    d = tempfile.mkdtemp(prefix="bing-")
    with open(os.path.join(d, "p.json"), "w") as f:
        f.write(json.dumps(_bing_envelope(10)) + "\n")
        f.write(json.dumps({"_type": "ErrorResponse", "envelope_id": "e2",
                            "errors": [{"code": "InvalidRequest", "message": "bad"}]}) + "\n")
    env = V.read_envelopes(spark, d, "bingnews")
    data, quarantine = V.split_errors(env, "bingnews")
    e = data.first()
    assert e.totalEstimatedMatches == 36 and len(e.value) == 10 and e.sort[0].isSelected
    assert [r.error_code for r in quarantine.collect()] == ["InvalidRequest"]
    flat = V.flatten(data, "bingnews")
    good, bad = V.valid_articles(flat)
    assert good.count() == 9 and [r.missing_fields for r in bad.collect()] == ["url"]
    first = flat.filter("pos = 0").first()
    assert first.title == "title 0" and first.provider_name == "X" and first.original_query == "AI"
    inner = V.clustered_articles(flat).filter("pos = 0").first()
    assert (inner.title, inner.url, inner.inner_pos) == ("inner", "u", 0)
    assert json.loads(first.article_data)["clusteredArticles"][0]["name"] == "inner"       # nested, not a string of JSON
    assert flat.filter("pos = 5").first().provider_name is None


GOOD = {"bingnews": {"value": []}, "newsapi.org": {"status": "ok", "totalResults": 0, "articles": []},
        "thenewsapi.com": {"meta": {"found": 0}, "data": []}}
BAD = {"bingnews": [{"errors": [{"code": "X"}]}, {"_type": "ErrorResponse"}, {"totalEstimatedMatches": 3}],
       "newsapi.org": [{"status": "error", "code": "X"}, {"totalResults": 1, "articles": []}, {"status": "ok"}],
       "thenewsapi.com": [{"error": {"code": "X"}}, {"meta": {"found": 1}}, {"data": []}]}


def test_every_line_is_data_or_quarantined(spark):
    """Envelopes without a type, errors without a code, cut lines, wrong types and texts that are no object."""
    for vendor, good in GOOD.items():
        d = tempfile.mkdtemp(prefix="split-")
        number = {"bingnews": "totalEstimatedMatches", "newsapi.org": "totalResults", "thenewsapi.com": "meta"}[vendor]
        bad = [json.dumps(x) for x in BAD[vendor]] + ['{"value": [{"name": "cut', "null", "[]", "5", "{}", json.dumps({**good, number: "many"})]
        with open(os.path.join(d, "p.json"), "w") as f:
            f.write("\n".join([json.dumps(good), "", *bad, json.dumps({**good, "new_field": {"a": [1]}}), "  "]) + "\n")
        env = V.read_envelopes(spark, d, vendor)
        data, quarantine = V.split_errors(env, vendor)
        assert data.count() == 2 and quarantine.count() == len(bad) and env.count() == len(bad) + 2
        codes = [r.error_code for r in quarantine.collect()]
        assert codes.count("malformed_json") == 5 and codes.count("missing_fields") >= 2 and codes.count("X") == 1
        assert V.flatten(data, vendor).count() == 0


def test_related_topics_of_drifting_shape(spark):
    d = tempfile.mkdtemp(prefix="related-")
    news = [{"name": "t", "url": "u", "provider": 5}, {"name": 7}, "text"]
    lines = [{"envelope_id": "a", "value": [], "relatedTopics": [{"name": "n", "webSearchUrl": "w", "relatedNews": news}, {"name": "none"}, 3]},
             {"envelope_id": "b", "value": [], "relatedTopics": "gone"}, {"envelope_id": "c", "value": []}]
    with open(os.path.join(d, "p.json"), "w") as f:
        f.write("\n".join(map(json.dumps, lines)))
    data, quarantine = V.split_errors(V.read_envelopes(spark, d, "bingnews"), "bingnews")
    got = [(r.envelope_id, r.topic_pos, r.related_topic, r.pos, r.title, r.url) for r in V.related_articles(data).collect()]
    assert got == [("a", 0, "n", 0, "t", "u"), ("a", 0, "n", 1, "7", None), ("a", 0, "n", 2, None, None)]
    assert data.count() == 3 and quarantine.count() == 0


def test_commented_jsonl(spark):
    d = tempfile.mkdtemp(prefix="jsonl-")
    with open(os.path.join(d, "en.jsonl"), "w") as f:
        f.write('{"domain": "a.com", "provider_name": "A", "country": "US"}\n\n'
                '// {"domain": "b.com", "provider_name": "B", "country": "US"}\n'
                '  # comment\n{"domain": "c.com", "provider_name": "C", "country": "UK"}\n')
    got = [r.domain for r in JL.read_commented_jsonl(spark, d, JL.PROVIDER_SCHEMA).collect()]
    assert sorted(got) == ["a.com", "c.com"]


def test_candidate_store_roundtrip_and_mark(spark):
    rows = [(f"a{i}", "t1", "bingnews", dt.datetime(2024, 1, 2 + i % 2, 5), dt.datetime(2024, 1, 1)) for i in range(8)]
    acc = spark.createDataFrame(rows, "article_id string, topic_id string, aggregator_id string, published_dt timestamp, start_dt timestamp")
    path = scratch_path(spark, "cand-test")
    CS.store_candidates(acc, path)
    CS.store_candidates(acc, path)      # a rerun adds nothing
    day = CS.load_unsourced(spark, path, "t1", dt.date(2024, 1, 2))
    assert day.count() == 4
    considered = day.select("article_id", "topic_id", "published_date")
    after = CS.mark_sourced(spark, path, considered)
    got = {(str(r.published_date), r.is_sourced): r.n for r in
           after.groupBy("published_date", "is_sourced").agg(F.count("*").alias("n")).collect()}
    assert got == {("2024-01-02", True): 4, ("2024-01-03", False): 4}


def test_same_article_in_two_daily_runs(spark):
    """Marks are inclusive: an article on the border is fetched by two runs at
    the same index, is stored twice, and only the considered copy is flagged."""
    from tidings.operators.collect import accept_cap
    row = "topic_id string, aggregator_id string, url string, start_dt timestamp, published_dt timestamp, arrival_rank long, max_results int"
    days = [dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)]
    runs = [accept_cap(spark.createDataFrame([("t1", "bingnews", "u", d, days[1], 1, 5)], row)) for d in days]
    got = [r.collect()[0] for r in runs]
    assert got[0].aggregation_index == got[1].aggregation_index == 0 and got[0].article_id != got[1].article_id
    assert all(len(r.article_id) == 43 for r in got)
    path = scratch_path(spark, "two-runs")
    for r in runs:
        CS.store_candidates(r, path)
    considered = CS.load_unsourced(spark, path).filter(F.col("article_id") == got[0].article_id)
    after = CS.mark_sourced(spark, path, considered)
    assert {(r.article_id, r.is_sourced, r.aggregation_run_id) for r in after.collect()} == {
        (got[0].article_id, True, "t1/bingnews/2024-01-02 00:00:00"), (got[1].article_id, False, "t1/bingnews/2024-01-03 00:00:00")}


def _hits_files(spark):
    rows = [(i, "t", "a", f"u{i % 5}", "2024-01-01T00:00:00Z", dt.datetime(2024, 1, 1 + i // 4, i % 24))
            for i in range(20)]
    rows.append((99, "t", "a", "u9", "", dt.datetime(2024, 1, 2)))
    df = spark.createDataFrame(rows, "event_id long, topic_id string, aggregator_id string, url string, "
                                     "raw_published string, published_dt timestamp")
    path = scratch_path(spark, "stream-in")
    for i in range(5):
        df.filter((F.col("event_id") < 20) & (F.floor(F.col("event_id") / 4) == i)).coalesce(1).write.mode("overwrite").parquet(f"{path}/day={i:05d}")
    df.filter("event_id = 99").coalesce(1).write.mode("overwrite").parquet(f"{path}/day=00099")
    return df, f"{path}/day=*"


def test_stream_dedup_equals_batch(spark):
    df, path = _hits_files(spark)
    s = ST.url_dedup_stream(spark, path, df.schema, max_files_per_trigger=1)
    batch = df.filter("raw_published <> ''").select("topic_id", "aggregator_id", "url").distinct()
    assert sorted(map(tuple, s.select("topic_id", "aggregator_id", "url").collect())) == sorted(map(tuple, batch.collect()))


def test_stream_high_watermark_equals_batch(spark):
    df, path = _hits_files(spark)
    m = ST.high_watermark_stream(spark, path, df.schema, max_files_per_trigger=1).first()
    assert m.last_end == df.agg(F.max("published_dt")).first()[0]


def test_stream_state_keeps_two_batches_and_survives_a_replay(spark):
    path = scratch_path(spark, "state")
    write = ST.state_writer(path, ["k"])
    batches = [[("a", 1)], [("b", 1)], [("a", 2), ("c", 1)], [("b", 5)]]
    for n, rows in enumerate(batches):
        for _ in range(2):      # the second write is a replay
            write(spark.createDataFrame(rows, "k string, v long"), n)
    assert ST._states(spark, path) == [2, 3]
    assert {tuple(r) for r in ST.last_state(spark, path).collect()} == {("a", 2), ("b", 5), ("c", 1)}


def test_stream_daily_windows_only_closed(spark):
    df, path = _hits_files(spark)
    w = ST.daily_window_stream(spark, path, df.schema, max_files_per_trigger=1)
    got = sorted((r.window_start.day, r.n_hits) for r in w.collect())
    # the last day (5th) stays open; row 99 (day 2) lands after the watermark
    # has passed day 2, so it is late and not counted
    assert got == [(1, 4), (2, 4), (3, 4), (4, 4)]


def test_sourced_rows_default_pending(spark):
    from tidings.sources import bundles as BD
    a = spark.createDataFrame(
        [("t1", "2024-01-02-00-00-00-000000#x", dt.datetime(2024, 1, 2), "2024/01/02", "T", "Topic 1",
          ["n/a"], ["a1"], ["u1"], ["d1"])],
        "topic_id string, sourced_article_id string, dt_published timestamp, date_published string, title string, "
        "topic string, source_article_categories array<string>, source_article_ids array<string>, "
        "source_article_urls array<string>, source_article_provider_domains array<string>")
    r = BD.sourced_rows(a, "run-1", dt.datetime(2024, 1, 3)).first()
    assert r.article_approval_status == "PENDING" and r.short_summary_ref.endswith("/Short_summary.txt")
    assert BD.sourced_rows(a, "run-1", dt.datetime(2024, 1, 3), "APPROVED").first().article_approval_status == "APPROVED"
    both = BD.insert_sourced(BD.sourced_rows(a, "old", dt.datetime(2024, 1, 1)), BD.sourced_rows(a, "new", dt.datetime(2024, 1, 3)))
    assert [x.sourcing_run_id for x in both.collect()] == ["old"]


def test_messages_delivered_again_are_processed_once_and_in_order(spark):
    path, out = scratch_path(spark, "messages-in"), scratch_path(spark, "messages-out")
    seen = []

    def say(*messages):
        rows = [json.dumps(dict(zip(("topic_id", "message_id", "sent_at"), m))) for m in messages]
        spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.mode("append").text(path)

    def validate(batch):
        seen.append(batch.count())
        return batch

    def run():
        return ST.requests_stream(spark, path, validate, out, max_files_per_trigger=1).withColumn(
            "t", F.unix_timestamp("sent_at")).orderBy("batch_id", "message_group", "position").collect()

    say(("a", "2", "2024-01-02T00:00:00Z"), ("a", "1", "2024-01-01T00:00:00Z"), ("b", "9", None), ("a", "2", "2024-01-02T00:00:00Z"))
    assert [(r.message_id, r.position) for r in run()] == [("1", 1), ("2", 2), ("9", 1)]
    say(("a", "1", "2024-01-01T00:00:00Z"), ("a", "0", "1999-01-01T00:00:00Z"), ("c", None, None))      # late, and without an id
    say(("c", None, None), ("b", "9", None))
    got = run()
    assert [r.message_id for r in got][:4] == ["1", "2", "9", "0"] and len(got) == 5 and sum(r.topic_id == "c" for r in got) == 1
    assert len(run()) == 5
