"""Stores that only grow: candidates (S7), bundles (S10) as rows and as files, scan (S11) and load."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidings.plans import catalog
from tidings.session import scratch_path
from tidings.sources import bundles as BD
from tidings.sources import candidates as CS
from tidings.sources import stores

ARTICLE = ("topic_id string, date_published string, sourced_article_id string, title string, dt_published_iso string, topic string, "
           "source_article_categories array<string>, source_article_ids array<string>, source_article_urls array<string>, "
           "source_article_provider_domains array<string>, source_article_titles array<string>, short_summary string, "
           "medium_summary string, full_summary string")


def articles(spark, *ids, text="full\ntext"):
    return spark.createDataFrame([("007", "2024/01/02", i, f"T {i}", "2024-01-02T00:00:00", "Topic", ["n/a"], ["a"], ["u"], ["d"], ["t"], "short", None, text)
                                  for i in ids], ARTICLE)


def test_a_second_sourcing_adds_to_the_first(spark):
    path = scratch_path(spark, "additive")
    first, second = articles(spark, "2024-01-02#1"), articles(spark, "2024-01-02#2")
    for part in (first, second, first, second, articles(spark, "2024-01-02#1", text="other")):
        BD.store_bundles(part, path)
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 10 and len({r.object_key for r in rows}) == 10
    assert {r.body for r in rows if r.object_key.endswith("Full_summary.txt")} == {"full\ntext"}
    assert sorted(r.article_id for r in BD.load_bundles(spark, path).collect()) == ["2024-01-02#1", "2024-01-02#2"]


def test_an_article_without_marker_is_not_read_and_is_completed(spark):
    path, a = scratch_path(spark, "stopped"), articles(spark, "x#1", "x#2")
    day = F.regexp_replace("date_published", "/", "-").alias("publishing_day")
    rows = BD.bundle_rows(a).select("topic_id", day, "object_key", "body").filter("NOT object_key LIKE '%SUCCESS%' AND NOT object_key LIKE '%x#2/Short%'")
    stores.append_new(rows, path, ["topic_id", "publishing_day"], ["object_key"])      # a run that stopped here
    assert BD.load_bundles(spark, path).count() == 0
    BD.store_bundles(a, path)
    assert spark.read.parquet(path).count() == 10 and BD.load_bundles(spark, path).count() == 2


def test_bundles_as_files(spark):
    root = scratch_path(spark, "files with blank+plus")
    a, both = articles(spark, "x y#1+%"), articles(spark, "x y#1+%", "z#2")
    assert [r.written for r in BD.store_bundle_files(a, root).collect()] == [True]
    assert sorted((r.marker.split("/")[-2], r.written) for r in BD.store_bundle_files(both, root).collect()) == [("x y#1+%", False), ("z#2", True)]
    objects = {r.object_key: r.body for r in stores.scan_objects(spark, root).collect()}
    want = {r.object_key: r.body or "" for r in BD.bundle_rows(both).collect() if not r.object_key.endswith(BD.MARKER)}
    assert objects == want
    assert [r.prefix for r in BD.article_prefixes(stores.scan_objects(spark, root)).collect()] == ["sourced_candidate_articles/007/2024/01/02"]
    got = BD.load_bundle_files(spark, root).collect()
    assert {r.article_id for r in got} == {"x y#1+%", "z#2"} and all(r.full_summary_ref in want for r in got)
    fs, at = stores._files(stores._qualified(spark, root))
    fs.delete_file(f"{at}/sourced_candidate_articles/007/2024/01/02/z#2/{BD.MARKER}")
    assert [r.article_id for r in BD.load_bundle_files(spark, root).collect()] == ["x y#1+%"]
    assert BD.store_bundle_files(both.limit(0), root).count() == 0


def candidates(spark, days):
    rows = [(f"a{d}", "t1", "bingnews", dt.datetime(2024, 1, d, 5), dt.datetime(2024, 1, 1)) for d in days]
    return spark.createDataFrame(rows, "article_id string, topic_id string, aggregator_id string, published_dt timestamp, start_dt timestamp")


def test_an_append_reads_only_the_topic_days_it_touches(spark, capfd):
    path = scratch_path(spark, "pruned")
    CS.store_candidates(candidates(spark, range(1, 11)), path)
    new = candidates(spark, [3, 4]).withColumn("published_date", F.to_date("published_dt"))
    held = stores.stored_keys(spark, path, new, CS.PARTITIONS, ["article_id"])
    assert sorted(r.article_id for r in held.collect()) == ["a3", "a4"]
    plan = held._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "published_date" in filters and "ReadSchema: struct<article_id:string>" in plan
    scan = next(p for p in [held._jdf.queryExecution().sparkPlan()]).collectLeaves().head()
    assert scan.selectedPartitions().totalNumberOfFiles() == 2
    CS.store_candidates(candidates(spark, range(3, 12)), path)
    assert spark.read.parquet(path).count() == 11


def test_numeric_topics_stay_texts(spark):
    path = scratch_path(spark, "numeric")
    c = candidates(spark, [1]).withColumn("topic_id", F.lit("007"))
    CS.store_candidates(c, path)
    CS.store_candidates(c, path)
    assert spark.read.parquet(path).count() == 1


def test_other_errors_of_a_store_are_raised(spark):
    with pytest.raises(Exception, match="(?i)schema|parquet|path"):
        stores.stored_keys(spark, "nosuchscheme://x/y", candidates(spark, [1]), ["topic_id"], ["article_id"])


def test_a_store_that_got_no_row_is_read(spark):
    path = scratch_path(spark, "no-candidates")
    CS.store_candidates(candidates(spark, [1]).limit(0), path)
    left = CS.load_unsourced(spark, path)
    assert left.count() == 0 and CS.mark_sourced(spark, path, left).count() == 0
    assert {"article_id", "is_sourced", *CS.PARTITIONS} <= set(left.columns)
    CS.store_candidates(candidates(spark, [1, 2]), path)
    assert CS.mark_sourced(spark, path, CS.load_unsourced(spark, path).filter("article_id = 'a1'")).filter("is_sourced").count() == 1
    assert [r.article_id for r in CS.load_unsourced(spark, path).collect()] == ["a2"]
    path, none = scratch_path(spark, "no-bundles"), articles(spark, "x#1").limit(0)
    BD.store_bundles(none, path)
    assert BD.load_bundles(spark, path).count() == 0 and stores.read_table(spark, path).columns == ["object_key", "body", "topic_id", "publishing_day"]
    root = scratch_path(spark, "no-files")
    assert BD.store_bundle_files(none, root).count() == 0
    assert stores.scan_objects(spark, root).count() == 0 and BD.load_bundle_files(spark, root).count() == 0


def test_a_first_append_reads_nothing_that_is_not_there(spark, monkeypatch):
    failed, read = [], type(spark.read).parquet

    def parquet(self, *paths, **options):
        try:
            return read(self, *paths, **options)
        except Exception as e:
            failed.append(str(e))
            raise

    monkeypatch.setattr(type(spark.read), "parquet", parquet)
    path, bundles = scratch_path(spark, "first-candidates"), scratch_path(spark, "first-bundles")
    CS.store_candidates(candidates(spark, [1, 2]), path)
    CS.store_candidates(candidates(spark, [2, 3]), path)
    assert sorted(r.article_id for r in CS.load_unsourced(spark, path).collect()) == ["a1", "a2", "a3"]
    BD.store_bundles(articles(spark, "x#1"), bundles)
    assert BD.load_bundles(spark, bundles).count() == 1
    assert not failed


@pytest.mark.parametrize("query, rows", [("agg_observed_counts", 4), ("pipe_collect", 3), ("pipe_source", 0), ("sink_candidates", 0), ("sink_mark_sourced", 0),
                                         ("sink_sourced_bundle", 0), ("src_candidates_unsourced", 0), ("src_prefix_scan", 0), ("src_sourced_bundle", 0)])
def test_queries_when_no_article_is_accepted(spark, tmp_path, query, rows):
    spark.createDataFrame([(i, "title\nsecond line", "en", "src1") for i in range(4)], "doc_id long, text string, lang string, source string").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, dt.datetime(2023, 1, 1, i), 8) for i in range(12)], "event_id long, ts timestamp, user_id long").write.parquet(
        f"{tmp_path}/events.parquet")          # published before the window of every run
    spark.createDataFrame([(i, [0.5] * 64, 0) for i in range(4)], "vec_id long, embedding array<float>, label int").write.parquet(
        f"{tmp_path}/embeddings.parquet")
    catalog.load_all()
    got = catalog.QUERIES[query](spark, str(tmp_path)).collect()
    assert len(got) == rows
    if query == "agg_observed_counts":
        assert {r.value for r in got} == {0}
