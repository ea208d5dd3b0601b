"""Connected components of a link table, by alternating star steps.

Each step points every node's neighbours at the least node it knows (large
star), then every node at its least neighbour (small star), until the table no
longer changes. A node's links are never gathered: each step is a grouped
minimum joined back, so a hot node is summed on the map side. The minima are
written first: a join of two plain shuffles is one whose hot partitions Spark
splits. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): component is the
    least node that it reaches. Null ends and loops are no links."""
    now = links.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    now = written(now, "links")
    mark = _mark(now)
    while mark[0]:
        both = now.selectExpr("hi AS u", "lo AS v").union(now.selectExpr("lo AS u", "hi AS v"))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        wide = written(both.join(least, "u").filter("v > u").selectExpr("v AS hi", "m AS lo").distinct(), "wide")
        least = written(wide.groupBy("hi").agg(F.min("lo").alias("m")), "least")
        near = wide.join(least, "hi").filter("lo <> m").selectExpr("lo AS hi", "m AS lo")
        now = written(near.union(least.selectExpr("hi", "m AS lo")).distinct(), "links")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.selectExpr("hi AS node", "lo AS component").union(now.select("lo", F.col("lo").alias("c")).distinct())
