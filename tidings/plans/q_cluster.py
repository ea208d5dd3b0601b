"""Contract queries for clustering."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import cluster as CL
from ..session import scratch_path
from .catalog import query
from .oracle_ctes import with_views
from .q_sourcing import TOPIC_DAY_C as TOPIC_DAY
from .q_sourcing import cluster_members


def _members(spark, sf):
    return cluster_members(spark, sf).select(*TOPIC_DAY, "member_idx", F.col("cluster").alias("label"), "embedding")


@query("clu_ward_select_k", with_views("""
SELECT topic_id, day, count(*) AS n_members, TRUE AS k_in_range, TRUE AS labels_contiguous, TRUE AS score_is_silhouette
FROM cluster_members GROUP BY topic_id, day""", "cluster_members"))
def clu_ward_select_k(spark, sf):
    """Ward clustering of each topic-day's vectors, k chosen by silhouette:
    the members, and what every result must satisfy (the partition itself is
    checked against brute force in tests)."""
    path = scratch_path(spark, "ward-members")      # read by the clustering and by its checks
    _members(spark, sf).write.parquet(path)
    m = spark.read.parquet(path)
    return CL.ward_checks(CL.ward_clusters(m, TOPIC_DAY, "member_idx"), m, TOPIC_DAY, "member_idx")


def clu_kmeans_select_k(spark, sf):
    """Seeded MLlib k-means sweep over the inventory's vectors, scored by
    silhouette. Not registered: the whole sweep does not end (see README)."""
    return CL.kmeans_select_k(_members(spark, sf), "member_idx")


def _silhouette_sql(points: str, group: str) -> str:
    """Mean silhouette per group that has 2..n-1 labels."""
    cols = group.split(", ")
    return f"""
SELECT {group}, avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) AS score
FROM (SELECT {group}, member_idx, max(CASE WHEN lj = li THEN md END) AS a, min(CASE WHEN lj <> li THEN md END) AS b
      FROM (SELECT {group}, member_idx, li, lj, avg(dist) AS md
            FROM (SELECT {', '.join(f'a.{c}' for c in cols)}, a.member_idx, a.label AS li, b.label AS lj, list_distance(a.e, b.e) AS dist
                  FROM ({points}) a JOIN ({points}) b ON {' AND '.join(f'a.{c} = b.{c}' for c in cols)} AND a.member_idx <> b.member_idx) d
            GROUP BY {group}, member_idx, li, lj) m
      GROUP BY {group}, member_idx) s
WHERE ({group}) IN (SELECT ({group}) FROM ({points}) p GROUP BY {group} HAVING count(DISTINCT label) BETWEEN 2 AND count(*) - 1)
GROUP BY {group}"""


@query("clu_silhouette", with_views("SELECT topic_id, day, round(score, 6) AS score FROM (" + _silhouette_sql(
    "SELECT topic_id, day, member_idx, cluster AS label, CAST(embedding AS DOUBLE[]) AS e FROM cluster_members",
    "topic_id, day") + ") x", "cluster_members"))
def clu_silhouette(spark, sf):
    """Mean Euclidean silhouette of the stored labels per topic-day."""
    s = CL.silhouette_scores(_members(spark, sf), TOPIC_DAY, "label").filter("score IS NOT NULL AND NOT isnan(score)")
    return s.select(*TOPIC_DAY, F.round("score", 6).alias("score"))


@query("clu_argmax_k", with_views("""
SELECT topic_id, day, k, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY topic_id, day ORDER BY round(score, 6) DESC, k ASC) AS r FROM (""" + _silhouette_sql(
    "SELECT topic_id, day, g.k, member_idx, (r - 1) % g.k AS label, e FROM (SELECT *, CAST(embedding AS DOUBLE[]) AS e, "
    "row_number() OVER (PARTITION BY topic_id, day ORDER BY member_idx) AS r, count(*) OVER (PARTITION BY topic_id, day) AS n "
    "FROM cluster_members) i, generate_series(2, n - 1) AS g(k)", "topic_id, day, k") + ") x) y WHERE r = 1", "cluster_members"))
def clu_argmax_k(spark, sf):
    """C4: per topic-day the first k of 2..n-1 (labels dealt round) with the best silhouette."""
    day = Window.partitionBy(*TOPIC_DAY)
    m = _members(spark, sf).withColumns({"r": F.row_number().over(day.orderBy("member_idx")), "n": F.count(F.lit(1)).over(day)})
    ks = F.sequence(F.lit(2), F.col("n").cast("int") - 1)
    m = m.filter("n > 2").withColumn("labels", F.transform(ks, lambda k: (F.col("r") - 1) % k))
    scores = CL.silhouette_sweep(m, TOPIC_DAY, "labels").withColumn("k", F.col("at").cast("long") + 2)
    return CL.argmax_k(scores, TOPIC_DAY).select(*TOPIC_DAY, "k", F.round("score", 6).alias("score"))


@query("clu_small_bypass", with_views("""
SELECT topic_id, day, cluster, member_idx, row_number() OVER (PARTITION BY topic_id, day, cluster ORDER BY member_idx) - 1 AS label,
       n AS n_clusters, CAST('inf' AS DOUBLE) AS score
FROM (SELECT *, count(*) OVER (PARTITION BY topic_id, day, cluster) AS n FROM cluster_members) x WHERE n <= 2""", "cluster_members"))
def clu_small_bypass(spark, sf):
    """(topic, cluster) groups of at most two vectors: one cluster each, score +inf."""
    m = cluster_members(spark, sf).select(*TOPIC_DAY, "cluster", "member_idx")
    return CL.small_bypass(m, [*TOPIC_DAY, "cluster"], "member_idx")
