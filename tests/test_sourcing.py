"""Sourcing stage: inventory order, cluster ranking, chunk interleave, assembly."""

import datetime as dt

from pyspark.sql import functions as F

from tidings.constants import ARTICLE_SEPARATOR
from tidings.operators import sourcing as SO

INV = "topic_id string, publishing_date date, article_id string, aggregation_index int, published_dt timestamp, url string"
D = dt.date(2021, 4, 11)


def test_relevance_order_by_aggregation_index(spark):
    rows = [("t", D, "r1", 1, dt.datetime(2021, 4, 11, 21, 2, 39), "u1"),
            ("t", D, "r2", 0, dt.datetime(2021, 4, 11, 21, 2, 39), "u2"),
            ("t", D, "r3", 2, dt.datetime(2021, 4, 11, 21, 2, 39), "u3")]
    r = SO.rank_inventory(spark.createDataFrame(rows, INV), "relevance").orderBy("inventory_rank")
    assert [x.article_id for x in r.collect()] == ["r2", "r1", "r3"]


def test_date_order_newest_first(spark):
    rows = [("t", D, "r1", 0, dt.datetime(2021, 4, 11, 22, 2, 45), "u1"),
            ("t", D, "r2", 1, dt.datetime(2021, 4, 11, 22, 2, 39), "u2"),
            ("t", D, "r3", 2, dt.datetime(2021, 4, 11, 21, 2, 39), "u3")]
    r = SO.rank_inventory(spark.createDataFrame(rows, INV), "date").orderBy("inventory_rank")
    assert [x.article_id for x in r.collect()] == ["r1", "r2", "r3"]


def test_unknown_sorting_raises(spark):
    import pytest
    with pytest.raises(ValueError):
        SO.sort_spec("popularity")


def test_inventory_minimum(spark):
    rows = [("a", D, f"x{i}", i, dt.datetime(2021, 4, 11), "u") for i in range(6)] + \
           [("b", D, f"y{i}", i, dt.datetime(2021, 4, 11), "u") for i in range(5)]
    s = SO.inventory_status(spark.createDataFrame(rows, INV)).orderBy("topic_id").collect()
    assert [(r.topic_id, r.n_articles, r.status) for r in s] == [("a", 6, "SOURCE"), ("b", 5, "DEFER")]


def _chunks(spark, texts, size=2):
    df = spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)], "cluster long, position long, text string")
    return [r.doc for r in SO.chunk_interleave(df, size=size).orderBy("chunk_idx").collect()]


def test_chunk_interleave_unequal_lengths(spark):
    sep = ARTICLE_SEPARATOR
    assert _chunks(spark, ["Hello world good morning", "My house", "The brown fox"]) == [
        "Hello world" + sep + "My house" + sep + "The brown", " good morning" + sep + " fox"]


def test_chunk_interleave_equal_lengths(spark):
    sep = ARTICLE_SEPARATOR
    assert _chunks(spark, ["a b c d", "e f g h"]) == ["a b" + sep + "e f", " c d" + sep + " g h"]


def test_chunk_interleave_short_texts(spark):
    sep = ARTICLE_SEPARATOR
    assert _chunks(spark, ["one", "two", "three"]) == ["one" + sep + "two" + sep + "three"]


def test_cluster_topk_by_size_then_member_index(spark):
    members = spark.createDataFrame([("t", 0, 5), ("t", 0, 6), ("t", 1, 1), ("t", 1, 2), ("t", 2, 0), ("t", 3, 3)],
                                    "topic_id string, cluster int, member_idx int")
    limits = spark.createDataFrame([("t", 3)], "topic_id string, daily_publishing_limit int")
    s = SO.cluster_sizes(members, ["topic_id"])
    top = SO.cluster_topk(s, limits, ["topic_id"], frequency=2.0).orderBy("cluster_rank").collect()
    assert [(r.cluster, r.cluster_rank) for r in top] == [(1, 1), (0, 2)]


def test_sourced_article_arrays_in_member_order(spark):
    rows = [("t", 0, 2, "c2", "a2", "u2", "d2", "t2", dt.datetime(2024, 1, 2)),
            ("t", 0, 1, "c1", "a1", "u1", "d1", "t1", dt.datetime(2024, 1, 3))]
    m = spark.createDataFrame(rows, "topic_id string, cluster int, member_idx int, category string, article_id string, "
                                    "url string, provider_domain string, title string, published_dt timestamp")
    a = SO.sourced_article(m, ["topic_id"]).first()
    assert a.source_article_ids == ["a1", "a2"] and a.source_article_titles == ["t1", "t2"]
    assert a.dt_published == dt.datetime(2024, 1, 2)


def test_embedding_mean_elementwise(spark):
    v = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 6.0]), ("b", [1.0, 1.0])], "k string, embedding array<float>")
    got = {r.k: r.embedding for r in SO.embedding_mean_vector(v, ["k"]).collect()}
    assert got == {"a": [2.0, 4.0], "b": [1.0, 1.0]}


def test_embedding_check(spark):
    arts = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    vecs = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    got = sorted((r.k, r.violation) for r in SO.embedding_check(arts, vecs, "k").collect())
    assert got == [(1, "several vectors"), (3, "missing vector")]


def test_empty_inventory(spark):
    empty = spark.createDataFrame([], INV)
    assert SO.rank_inventory(empty, "relevance").count() == 0
    assert SO.inventory_status(empty).count() == 0
    assert SO.sourceable(empty).count() == 0
