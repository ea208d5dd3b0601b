"""Clustering kernels against brute force, and the Spark wrappers."""

import itertools

import numpy as np

from tidings.operators import cluster as CL


def naive_ward(x, k):
    clusters = [[i] for i in range(len(x))]
    while len(clusters) > k:
        best = None
        for i, j in itertools.combinations(range(len(clusters)), 2):
            a, b = x[clusters[i]], x[clusters[j]]
            d = len(a) * len(b) / (len(a) + len(b)) * ((a.mean(0) - b.mean(0)) ** 2).sum()
            if best is None or d < best[0]:
                best = (d, i, j)
        _, i, j = best
        clusters[i] = clusters[i] + clusters[j]
        del clusters[j]
    lab = np.zeros(len(x), int)
    for c, mem in enumerate(clusters):
        lab[mem] = c
    return lab


def naive_silhouette(x, lab):
    s = []
    for i in range(len(x)):
        own = [j for j in range(len(x)) if lab[j] == lab[i] and j != i]
        if not own:
            s.append(0.0)
            continue
        a = np.mean([np.linalg.norm(x[i] - x[j]) for j in own])
        b = min(np.mean([np.linalg.norm(x[i] - x[j]) for j in range(len(x)) if lab[j] == c])
                for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    return float(np.mean(s))


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def test_ward_select_k_matches_brute_force():
    rng = np.random.default_rng(7)
    for _ in range(10):
        n = int(rng.integers(3, 12))
        x = rng.normal(size=(n, 3)) + rng.integers(0, 3, size=(n, 1)) * 4
        labels, k, score = CL.ward_select_k(x)
        cand = [(naive_silhouette(x, naive_ward(x, kk)), kk) for kk in range(2, n)]
        best = max(c[0] for c in cand)
        k_ref = min(kk for s, kk in cand if s == best)
        assert k == k_ref and abs(score - best) < 1e-9
        assert same_partition(labels, naive_ward(x, k_ref))
        assert 2 <= k <= n - 1


def test_silhouette_matches_brute_force():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(15, 4))
    lab = np.array([0, 0, 1, 1, 1, 2, 2, 2, 2, 3, 0, 1, 2, 0, 1])
    assert abs(CL.silhouette(x, lab) - naive_silhouette(x, lab)) < 1e-12


def test_small_groups_bypass():
    labels, k, score = CL.ward_select_k(np.zeros((2, 3)))
    assert list(labels) == [0, 1] and score == float("inf")


def test_kmeans_select_k(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.normal(loc=10 * (i % 3), size=2)]) for i in range(18)]
    out = CL.kmeans_select_k(spark.createDataFrame(rows, "i long, embedding array<float>"), "i", range(2, 6)).collect()
    assert {r.n_clusters for r in out} == {3} and same_partition([r.label for r in out], [r.i % 3 for r in out])


def test_ward_finds_a_planted_partition(spark):
    rng = np.random.default_rng(2)
    rows = [(g, i, [float(v) for v in rng.normal(scale=0.1, size=4) + 8 * np.eye(4)[i % 4]]) for g in ("a", "b") for i in range(40)]
    df = spark.createDataFrame(rows, "g string, i long, embedding array<float>")
    out = CL.ward_clusters(df, ["g"], "i")
    for g in ("a", "b"):
        got = [r for r in out.collect() if r.g == g]
        assert {r.n_clusters for r in got} == {4} and same_partition([r.label for r in got], [r.i % 4 for r in got])
    assert {tuple(r)[1:] for r in CL.ward_checks(out, df, ["g"], "i").collect()} == {(40, True, True, True)}


def test_spark_ward_clusters(spark):
    rng = np.random.default_rng(5)
    rows = []
    for g in ("a", "b"):
        for i in range(8):
            rows.append((g, i, [float(v) for v in rng.normal(size=3) + (i % 2) * 10]))
    rows.append(("c", 0, [0.0, 0.0, 0.0]))
    df = spark.createDataFrame(rows, "g string, i long, embedding array<float>")
    out = CL.ward_clusters(df, ["g"], "i").collect()
    assert len(out) == 17
    by = {}
    for r in out:
        by.setdefault(r.g, set()).add(r.n_clusters)
    assert by["c"] == {1} and all(len(v) == 1 for v in by.values())
    lab_a = {r.i: r.label for r in out if r.g == "a"}
    assert len({lab_a[i] for i in range(0, 8, 2)}) == 1 and lab_a[0] != lab_a[1]


def test_spark_silhouette_and_argmax(spark):
    rows = [("a", i, i % 2, [float(i % 2) * 10, float(i)]) for i in range(6)]
    df = spark.createDataFrame(rows, "g string, vec_id long, label long, embedding array<float>")
    s = CL.silhouette_scores(df, ["g"], "label").first()
    x = np.array([[float(i % 2) * 10, float(i)] for i in range(6)])
    assert abs(s.score - naive_silhouette(x, np.array([i % 2 for i in range(6)]))) < 1e-9
    sc = df.sparkSession.createDataFrame([("a", 2, 0.5), ("a", 3, 0.5), ("a", 4, 0.2)], "g string, k int, score double")
    assert CL.argmax_k(sc, ["g"]).first().k == 2


def test_kmeans_sweep_reaches_the_planted_k(spark, monkeypatch):
    from tidings.plans import q_cluster

    rng = np.random.default_rng(3)
    rows = [(k, (100.0 * np.eye(9)[k % 9] + rng.normal(0, 0.1, 9)).tolist()) for k in range(36)]
    df = spark.createDataFrame(rows, "member_idx long, embedding array<float>").coalesce(1)
    monkeypatch.setattr(q_cluster, "_members", lambda spark, sf: df)
    out = q_cluster.clu_kmeans_select_k(spark, "").collect()
    assert {r.n_clusters for r in out} == {9} and len({(r.member_idx % 9, r.label) for r in out}) == 9
    few = CL.kmeans_select_k(df.limit(2), "member_idx").collect()
    assert sorted(r.label for r in few) == [0, 1] and {r.n_clusters for r in few} == {2}
    assert CL.kmeans_select_k(df.limit(0), "member_idx").count() == 0


def test_sweep_equals_one_silhouette_per_labelling(spark):
    import numpy as np
    from pyspark.sql import functions as F

    rng = np.random.default_rng(6)
    rows = [(g, i, rng.normal(size=4).tolist(), rng.integers(0, 3, 5).tolist() + [0, i]) for g, n in (("a", 7), ("b", 12), ("c", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i int, embedding array<double>, labels array<int>")
    got = {(r["g"], r["at"]): r["score"] for r in CL.silhouette_sweep(df, ["g"], "labels").collect()}
    for k in range(7):
        one = CL.silhouette_scores(df.withColumn("label", F.col("labels")[k]), ["g"], "label").collect()
        for r in one:
            a, b = got[r.g, k], r.score
            assert (a is None and (b is None or np.isnan(b))) or abs(a - b) < 1e-12
    assert len(got) == 21 and got["a", 5] is None and got["a", 6] is None
