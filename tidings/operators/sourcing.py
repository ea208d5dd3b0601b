"""Sourcing stage: inventory (S8, G2, F10, W5, W6, U4), cluster ranking (W7),
sourced-article assembly (A4, C5, C8), chunk interleave (W9), token and
cost statistics (A9, A10), embedding mean (A11) and checks (C7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import (ARTICLE_SEPARATOR, CHUNK_OVERLAP, CHUNK_TOKENS, DATE_SORTING,
                         EMBEDDING_USD_PER_TOKEN, MIN_INVENTORY_TO_SOURCE, RELEVANCE_SORTING)
from ..functions.text import token_chunks, token_count

TOPIC_DAY = ["topic_id", "publishing_date"]


def with_publishing_date(df: DataFrame) -> DataFrame:
    return df.withColumn("publishing_date", F.to_date("published_dt"))


def union_sources(*frames: DataFrame) -> DataFrame:
    """One inventory over all aggregators' candidates (missing columns null)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def sort_spec(name: str) -> list[Column]:
    """U4: order of the inventory by name; relevance = aggregation_index
    ascending, date = newest first; ties by published then url."""
    if name == RELEVANCE_SORTING:
        return [F.col("aggregation_index").asc(), F.col("published_dt").asc(), F.col("url").asc()]
    if name == DATE_SORTING:
        return [F.col("published_dt").desc(), F.col("url").asc()]
    raise ValueError(f"Invalid sorting {name}")


def rank_inventory(inv: DataFrame, sorting: str = RELEVANCE_SORTING) -> DataFrame:
    """Position of every article in its topic-day inventory.

    A topic-day inventory is bounded by the collect caps (at most
    ``max_results`` accepted rows per run and window), so one window
    partition per topic-day stays small whatever the input size.
    """
    w = Window.partitionBy(*TOPIC_DAY).orderBy(*sort_spec(sorting))
    return inv.withColumn("inventory_rank", F.row_number().over(w))


def inventory_status(inv: DataFrame, minimum: int = MIN_INVENTORY_TO_SOURCE) -> DataFrame:
    """topic-days with fewer than ``minimum`` unsourced articles are deferred."""
    g = inv.groupBy(*TOPIC_DAY).agg(F.count(F.lit(1)).alias("n_articles"))
    return g.withColumn("status", F.when(F.col("n_articles") < minimum, F.lit("DEFER")).otherwise(F.lit("SOURCE")))


def sourceable(inv: DataFrame, minimum: int = MIN_INVENTORY_TO_SOURCE) -> DataFrame:
    """F10 as a filter: keep only inventories that reach the minimum size
    (grouped count + semi join: partial aggregation, no window)."""
    ok = inv.groupBy(*TOPIC_DAY).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= minimum)
    return inv.join(ok.select(*TOPIC_DAY), TOPIC_DAY, "left_semi")


def cluster_sizes(members: DataFrame, group: list[str]) -> DataFrame:
    return members.groupBy(*group, "cluster").agg(F.count(F.lit(1)).alias("size"),
                                                  F.min("member_idx").alias("min_idx"))


def cluster_topk(sizes: DataFrame, limits: DataFrame, group: list[str],
                 frequency: float = 1.0) -> DataFrame:
    """Clusters by size (ties: smallest member index), first
    ceil(daily_limit / frequency) per group."""
    s = sizes.join(limits.select("topic_id", "daily_publishing_limit"), "topic_id", "left")
    w = Window.partitionBy(*group).orderBy(F.col("size").desc(), F.col("min_idx").asc(), F.col("cluster").asc())
    s = s.withColumn("cluster_rank", F.row_number().over(w))
    top_k = F.ceil(F.col("daily_publishing_limit") / F.lit(float(frequency)))
    return s.filter(F.col("cluster_rank") <= top_k)


def sourced_article(members: DataFrame, group: list[str]) -> DataFrame:
    """A4: per cluster the earliest published time and five parallel
    arrays (categories, ids, urls, domains, titles) in member order."""
    m = F.struct("member_idx", "category", "article_id", "url", "provider_domain", "title")
    g = members.groupBy(*group, "cluster").agg(F.min("published_dt").alias("dt_published"),
                                               F.array_sort(F.collect_list(m)).alias("_m"))
    pick = lambda f: F.transform("_m", lambda x: x[f])
    return g.select(*group, "cluster", "dt_published",
                    pick("category").alias("source_article_categories"),
                    pick("article_id").alias("source_article_ids"),
                    pick("url").alias("source_article_urls"),
                    pick("provider_domain").alias("source_article_provider_domains"),
                    pick("title").alias("source_article_titles"))


def group_members(members: DataFrame, group: list[str], col: str = "article_id") -> DataFrame:
    """Cluster labels -> ordered member lists."""
    g = members.groupBy(*group, "cluster").agg(F.array_sort(F.collect_list(F.struct("member_idx", col))).alias("_m"))
    return g.select(*group, "cluster", F.transform("_m", lambda x: x[col]).alias("members"))


def cluster_stats(members: DataFrame, group: list[str]) -> DataFrame:
    """Per group the cluster count and the sizes, largest first."""
    s = members.groupBy(*group, "cluster").agg(F.count(F.lit(1)).alias("size"))
    return s.groupBy(*group).agg(F.count(F.lit(1)).alias("n_clusters"),
                                 F.array_join(F.reverse(F.array_sort(F.collect_list("size"))), ",").alias("sizes"))


def chunk_interleave(texts: DataFrame, size: int = CHUNK_TOKENS, overlap: int = CHUNK_OVERLAP,
                     separator: str = ARTICLE_SEPARATOR) -> DataFrame:
    """K-th chunk of every article of a cluster joined with the
    separator, for k = 0, 1, ...; articles with fewer chunks drop out.

    One row per (cluster, k): the shuffle is keyed by (cluster, k) so a
    large cluster spreads its chunk positions over many tasks.
    """
    c = texts.select("cluster", "position",
                     F.posexplode(token_chunks(F.col("text"), size, overlap)).alias("chunk_idx", "chunk"))
    g = c.groupBy("cluster", "chunk_idx").agg(F.array_sort(F.collect_list(F.struct("position", "chunk"))).alias("_c"))
    return g.select("cluster", "chunk_idx", F.size("_c").alias("n_parts"),
                    F.array_join(F.transform("_c", lambda x: x["chunk"]), separator).alias("doc"))


def token_stats(texts: DataFrame, group: list[str]) -> DataFrame:
    """Per cluster total, mean and max tokens of its article texts."""
    t = texts.withColumn("_tok", token_count(F.col("text")))
    return t.groupBy(*group).agg(F.sum("_tok").alias("total_tokens"),
                                 F.round(F.avg("_tok"), 6).alias("avg_tokens"), F.max("_tok").alias("max_tokens"))


def embedding_cost(docs: DataFrame, group: list[str], doc_col: str = "doc",
                   usd_per_token: float = EMBEDDING_USD_PER_TOKEN) -> DataFrame:
    """A10: embedding tokens and their cost per group."""
    t = docs.withColumn("_tok", token_count(F.col(doc_col)))
    return t.groupBy(*group).agg(F.sum("_tok").alias("tokens")).withColumn(
        "cost_usd", F.round(F.col("tokens") * F.lit(usd_per_token), 9))


def embedding_mean(vectors: DataFrame, key: list[str], vec: str = "embedding") -> DataFrame:
    """Element-wise mean of the vectors of each key, as long rows
    (key, pos, value); partial aggregation per (key, pos) before the shuffle."""
    e = vectors.select(*key, F.posexplode(vec).alias("pos", "_v"))
    return e.groupBy(*key, "pos").agg(F.avg(F.col("_v").cast("double")).alias("value"))


def embedding_mean_vector(vectors: DataFrame, key: list[str], vec: str = "embedding") -> DataFrame:
    """A11 as arrays: one mean vector per key."""
    m = embedding_mean(vectors, key, vec)
    g = m.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("_m"))
    return g.select(*key, F.transform("_m", lambda x: x["value"]).alias(vec))


def embedding_check(articles: DataFrame, vectors: DataFrame, key: str) -> DataFrame:
    """Articles without a vector, and keys with more than one vector."""
    missing = articles.select(key).distinct().join(vectors.select(key), key, "left_anti").select(
        key, F.lit("missing vector").alias("violation"), F.lit(0).cast("long").alias("n_vectors"))
    many = (vectors.groupBy(key).agg(F.count(F.lit(1)).alias("n_vectors")).filter("n_vectors > 1")
            .select(key, F.lit("several vectors").alias("violation"), "n_vectors"))
    return missing.unionByName(many)
