"""Clustering of topic-day inventories.

An inventory holds the accepted articles of one topic and day, at most
``max_results`` of each run, so it is small whatever the input size. Each is
clustered in one ``applyInPandas`` task with numpy, by one exact algorithm:
Spark shuffles the groups, Arrow ships their vectors, and no pair of rows is
ever a Spark row. The k-means sweep (C3) is MLlib's, over all vectors.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

KMEANS_SEED = 10
KMEANS_FITS = 4      # fits of the sweep at one time


# ------------------------------------------------------------------ numpy kernels
def pairwise(x: np.ndarray) -> np.ndarray:
    """Euclidean distance matrix (float64)."""
    sq = np.einsum("ij,ij->i", x, x)
    d2 = np.maximum(sq[:, None] + sq[None, :] - 2.0 * (x @ x.T), 0.0)
    np.fill_diagonal(d2, 0.0)
    return np.sqrt(d2)


def silhouette_from_sums(sums: np.ndarray, sizes: np.ndarray, own: np.ndarray) -> float:
    """Mean silhouette from point-to-cluster distance sums (n x k)."""
    rows = np.arange(len(own))
    rest = sizes[own] - 1        # a(i) averages over the *other* rows of the cluster
    a = np.where(rest > 0, sums[rows, own] / np.where(rest > 0, rest, 1.0), 0.0)
    means = sums / sizes[None, :]
    means[rows, own] = np.inf
    b = means.min(axis=1)
    denom = np.maximum(a, b)
    return float(np.where((rest > 0) & (denom > 0), (b - a) / np.where(denom > 0, denom, 1.0), 0.0).mean())


def silhouette(x: np.ndarray, labels: np.ndarray) -> float:
    """Mean silhouette with Euclidean distance; singletons score 0."""
    uniq, own = np.unique(labels, return_inverse=True)
    onehot = np.zeros((len(labels), len(uniq)))
    onehot[np.arange(len(labels)), own] = 1.0
    return silhouette_from_sums(pairwise(x) @ onehot, onehot.sum(axis=0), own)


def ward_merges(x: np.ndarray) -> list[tuple[float, int, int]]:
    """Ward agglomeration by nearest-neighbour chain: (distance, a, b) merges
    sorted by distance; cluster ids are the lowest original member index."""
    n = len(x)
    cent = x.astype(np.float64).copy()
    size = np.ones(n)
    active = np.ones(n, dtype=bool)
    merges: list[tuple[float, int, int]] = []
    chain: list[int] = []
    while active.sum() > 1:
        if not chain:
            chain.append(int(np.flatnonzero(active)[0]))
        a = chain[-1]
        diff = cent - cent[a]
        d = size * size[a] / (size + size[a]) * np.einsum("ij,ij->i", diff, diff)
        d[~active] = np.inf
        d[a] = np.inf
        best = float(d.min())
        prev = chain[-2] if len(chain) > 1 else -1
        b = prev if prev >= 0 and d[prev] <= best else int(np.flatnonzero(d == best)[0])
        if b == prev:
            chain.pop()
            chain.pop()
            lo, hi = min(a, b), max(a, b)
            tot = size[lo] + size[hi]
            cent[lo] = (cent[lo] * size[lo] + cent[hi] * size[hi]) / tot
            size[lo] = tot
            active[hi] = False
            merges.append((float(np.sqrt(2.0 * best)), lo, hi))
        else:
            chain.append(b)
    merges.sort(key=lambda m: m[0])
    return merges


def _relabel(root: np.ndarray) -> np.ndarray:
    """Labels numbered by first appearance in member order."""
    _, first = np.unique(root, return_index=True)
    order = {r: i for i, r in enumerate(root[np.sort(first)])}
    return np.array([order[r] for r in root], dtype=np.int64)


def ward_select_k(x: np.ndarray) -> tuple[np.ndarray, int, float]:
    """C1 + C4: Ward tree cut at every k in 2..n-1, keep the first k (in
    increasing k) with the best silhouette. Point-to-cluster distance sums
    are updated per merge, so the sweep never recomputes pairwise terms."""
    n = len(x)
    if n <= 2:
        return np.arange(n, dtype=np.int64), n, float("inf")
    root_of = np.arange(n)   # cluster (lowest member index) of every point
    sums = pairwise(x.astype(np.float64))    # column c = sum of distances to cluster c
    sizes = np.ones(n)
    alive = np.ones(n, dtype=bool)
    pos = np.full(n, -1)
    best = (-np.inf, None, None)
    k = n
    for _dist, a, b in ward_merges(x):
        ra, rb = root_of[a], root_of[b]
        lo, hi = min(ra, rb), max(ra, rb)
        root_of[root_of == hi] = lo
        sums[:, lo] += sums[:, hi]
        sizes[lo] += sizes[hi]
        alive[hi] = False
        k -= 1
        if k < 2:
            break
        cols = np.flatnonzero(alive)
        pos[cols] = np.arange(len(cols))
        score = silhouette_from_sums(sums[:, cols], sizes[cols], pos[root_of])
        if score >= best[0]:    # sweeping k downwards: ties go to the smaller k
            best = (score, k, root_of.copy())
    score, k_best, roots = best
    return _relabel(roots), int(k_best), float(score)


# ------------------------------------------------------------------ Spark operators
def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.map(lambda v: np.asarray(v, dtype=np.float64)).to_numpy())


def ward_clusters(df: DataFrame, group: list[str], idx: str, vec: str = "embedding") -> DataFrame:
    """C1 (+C4, C6): Ward clustering per group with silhouette-chosen k."""
    schema = T.StructType([df.schema[c] for c in [*group, idx]] + [
        T.StructField("label", T.LongType()), T.StructField("n_clusters", T.LongType()), T.StructField("score", T.DoubleType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(idx)
        labels, k, score = ward_select_k(_matrix(pdf[vec]))
        return pdf[[*group, idx]].assign(label=labels, n_clusters=k, score=score)

    return df.select(*group, idx, vec).groupBy(*group).applyInPandas(run, schema)


def ward_checks(clusters: DataFrame, points: DataFrame, group: list[str], idx: str, vec: str = "embedding") -> DataFrame:
    """Per group what any C1 result must satisfy: n_members, whether k lies in
    2..n-1 (n for two members or fewer), whether the labels are 0..k-1, and
    whether the score is C2's for these labels."""
    labelled = points.select(*group, idx, vec).join(clusters, [*group, idx])
    again = silhouette_scores(labelled, group, "label", vec).withColumnRenamed("score", "_again")
    g = clusters.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_members"), F.max("n_clusters").alias("_k"), F.max("score").alias("_score"),
        (F.min("n_clusters") == F.max("n_clusters")).alias("_one"), F.min("label").alias("_low"),
        F.max("label").alias("_high"), F.count_distinct("label").alias("_labels"))
    n, k = F.col("n_members"), F.col("_k")
    small = n <= 2
    return g.join(again, group, "left").select(
        *group, "n_members", (F.col("_one") & F.when(small, k == n).otherwise(k.between(2, n - 1))).alias("k_in_range"),
        ((F.col("_low") == 0) & (F.col("_high") == k - 1) & (F.col("_labels") == k)).alias("labels_contiguous"),
        F.when(small, F.col("_score") == float("inf")).otherwise(F.abs(F.col("_score") - F.col("_again")) < 1e-9).alias("score_is_silhouette"))


def kmeans_select_k(df: DataFrame, idx: str, ks: range | None = None, vec: str = "embedding", seed: int = KMEANS_SEED) -> DataFrame:
    """MLlib k-means for every k, the first k with the best MLlib
    silhouette; per row idx, label, n_clusters, score.

    Without ``ks``, every k of 2..n-1 that can differ: k-means has no more
    clusters than distinct vectors. Two rows or fewer are a cluster each (score
    +inf, as in C1); more rows of one vector are one cluster without a score.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    x = df.select(idx, array_to_vector(F.col(vec).cast("array<double>")).alias("features")).persist()
    if ks is None:
        n = x.count()
        distinct = df.select(vec).distinct().count()
        if n <= 2 or distinct < 2:
            alone = F.row_number().over(Window.orderBy(idx)).cast("long") - 1      # of two rows at most
            label, k, score = (alone, n, float("inf")) if n <= 2 else (F.lit(0).cast("long"), 1, None)
            return x.select(idx, label.alias("label"), F.lit(k).cast("long").alias("n_clusters"), F.lit(score).cast("double").alias("score"))
        ks = range(2, min(n - 1, distinct) + 1)

    def fit(k: int) -> tuple:
        model = KMeans(k=k, seed=seed).fit(x)
        return ClusteringEvaluator().evaluate(model.transform(x)), k, model

    best = (-np.inf, None, None)
    with ThreadPool(KMEANS_FITS) as pool:
        for found in pool.imap(fit, ks):     # in order of k
            if found[0] > best[0]:
                best = found
    score, k, model = best
    return model.transform(x).select(idx, F.col("prediction").cast("long").alias("label"), F.lit(k).cast("long").alias("n_clusters"),
                                     F.lit(score).alias("score"))


def silhouette_scores(df: DataFrame, group: list[str], label: str, vec: str = "embedding") -> DataFrame:
    """Mean Euclidean silhouette of given labels per group; no
    score (NaN or null) unless there are 2..n-1 labels."""
    schema = T.StructType([df.schema[c] for c in group] + [T.StructField("score", T.DoubleType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        labels = pdf[label].to_numpy()
        valid = 2 <= len(np.unique(labels)) <= len(pdf) - 1
        return pdf[group].iloc[:1].assign(score=silhouette(_matrix(pdf[vec]), labels) if valid else float("nan"))

    return df.select(*group, label, vec).groupBy(*group).applyInPandas(run, schema)


def silhouette_sweep(df: DataFrame, group: list[str], labels: str, vec: str = "embedding") -> DataFrame:
    """C2 for many labellings at once: ``labels`` holds, for each member, its
    label in every labelling (arrays of one length per group). Per group and
    labelling: at (its place, from 0) and score (null unless it has 2..n-1
    labels). A group's distances are computed once, and a member crosses the
    shuffle once; each labelling costs one product with its indicator matrix."""
    schema = T.StructType([df.schema[c] for c in group] + [T.StructField("at", T.IntegerType()), T.StructField("score", T.DoubleType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        all_labels = np.stack(pdf[labels].to_numpy())
        far, scores = pairwise(_matrix(pdf[vec])), []
        for own in all_labels.T:
            uniq, own = np.unique(own, return_inverse=True)
            onehot = np.zeros((len(own), len(uniq)))
            onehot[np.arange(len(own)), own] = 1.0
            valid = 2 <= len(uniq) <= len(own) - 1
            scores.append(silhouette_from_sums(far @ onehot, onehot.sum(axis=0), own) if valid else None)
        out = pd.DataFrame({"at": np.arange(len(scores), dtype=np.int32), "score": pd.array(scores, dtype="Float64")})
        return out.assign(**{g: pdf[g].iloc[0] for g in group})[[*group, "at", "score"]]

    return df.select(*group, labels, vec).groupBy(*group).applyInPandas(run, schema)


def argmax_k(scores: DataFrame, group: list[str], digits: int = 6) -> DataFrame:
    """C4: the first k (smallest) with the maximum score per group; scores
    are compared at ``digits`` decimals so float noise cannot break ties."""
    w = Window.partitionBy(*group).orderBy(F.round("score", digits).desc(), F.col("k").asc())
    return scores.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def small_bypass(members: DataFrame, group: list[str], idx: str, max_size: int = 2) -> DataFrame:
    """Groups of at most two articles -> one cluster each, score +inf."""
    small = members.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") <= max_size)
    m = members.join(small, group)   # only groups of <= max_size rows reach the window below
    label = F.row_number().over(Window.partitionBy(*group).orderBy(idx)) - 1
    return m.select(*group, idx, label.cast("long").alias("label"), F.col("_n").alias("n_clusters"),
                    F.lit(float("inf")).alias("score"))
