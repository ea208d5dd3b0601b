"""Pages landed a portion at a time."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidings import constants as K
from tidings.plans import catalog, landing
from tidings.session import scratch_path


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    docs = [(i, f"title {i}\n" + "second line\n" * (i % 4 > 0) + "body " * (i % 60), "en", f"src{i % 17}") for i in range(97)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{at}/documents.parquet")
    events = [(i, dt.datetime(2024, 1, 3) + dt.timedelta(minutes=5 * i), i * 7 // 3 % 5) for i in range(6000)]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long").write.parquet(f"{at}/events.parquet")
    return at


def lines(spark, path):
    return [(v, r.value) for v in (K.BING, K.NEWSAPI_ORG, K.THENEWSAPI_COM) for r in spark.read.text(landing.vendor_path(path, v)).collect()]


def test_portions_hold_the_landed_lines_and_go(spark, tables, monkeypatch):
    monkeypatch.setattr(landing, "LEAST_HITS", 900)
    lost = (F.col("topic") == "Topic 3") & (F.col("page") == 0)
    got, paths = [], []
    for path in landing.landings(spark, tables, lost):
        assert not [p for p in paths if os.path.exists(p.removeprefix("file://"))]
        paths.append(path)
        got += lines(spark, path)
    assert len(paths) == 7 and sorted(got) == sorted(lines(spark, landing.land(spark, tables, lost=lost)))


def test_collected_runs_do_not_depend_on_the_portions(spark, tables, monkeypatch):
    catalog.load_all()
    rows = lambda: sorted(map(str, catalog.QUERIES["pipe_collect"](spark, tables).collect()))
    want = rows()
    monkeypatch.setattr(landing, "LEAST_HITS", 2500)
    assert rows() == want and "COMPLETE" in str(want) and "FAILED" in str(want)


def test_first_arrivals_are_those_that_paging_keeps(spark):
    catalog.load_all()
    from tidings.plans import q_pipelines

    a = spark.range(50000).select(F.lit("t").alias("topic_id"), F.when(F.col("id") % 5 == 0, "x").otherwise("y").alias("aggregator_id"),
                                  (F.col("id") * 3).alias("event_id"), F.col("id").cast("string").alias("url"))
    runs = spark.createDataFrame([("t", "x", 7), ("t", "y", 2), ("t", "z", 1)], "topic_id string, aggregator_id string, max_results int")
    runs = runs.selectExpr("*", "'T' AS topic", "date'2024-01-01' AS start_dt", "date'2024-01-02' AS end_dt", "'d' AS sorting")
    kept = q_pipelines.first_arrivals(a, runs).collect()
    n = {k: sorted(r.event_id for r in kept if r.aggregator_id == k) for k in "xyz"}
    assert [len(n[k]) for k in "xyz"] == [1400, 400, 0] and n["x"] == [i * 15 for i in range(1400)]


def test_vendors_without_pages_have_no_lines(spark, tables, tmp_path):
    at = scratch_path(spark, "one-vendor")
    spark.read.parquet(f"{tables}/events.parquet").filter("event_id % 3 = 0").write.parquet(f"{at}/events.parquet")
    spark.read.parquet(f"{tables}/documents.parquet").write.parquet(f"{at}/documents.parquet")
    [got] = [lines(spark, p) for p in landing.landings(spark, at)]
    assert len({v for v, _ in got}) == 1
