"""Caller-supplied batch functions (U1, U2) and the horizon override."""

import datetime as dt

import pandas as pd
import pytest

from tidings.operators import schedule as S
from tidings.operators import udfs as U
from tidings.functions.summaries import lead_sentences, lead_words


def test_embed_with_calls_once_per_batch_and_checks_counts(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "id long, doc string")
    out = {r.id: r.embedding for r in U.embed_with(df, lambda texts: [[float(len(t)), 1.0] for t in texts]).collect()}
    assert out == {1: [3.0, 1.0], 2: [0.0, 1.0], 3: [0.0, 1.0]}
    with pytest.raises(Exception, match="different number of vectors"):
        U.embed_with(df, lambda texts: [[1.0]] * (len(texts) + 1)).collect()


def test_embed_default_is_sparse_and_normed(spark):
    df = spark.createDataFrame([(1, "apple banana apple"), (2, "banana cherry"), (3, None)], "id long, doc string")
    out = {r.id: r for r in U.embed_default(df, "id").collect()}
    assert len(out[1].indices) == 2 and abs(sum(v * v for v in out[1]["values"]) - 1) < 1e-12
    assert out[3].indices == [] and out[3]["values"] == []


def test_summarise_with_fills_the_four_texts_and_cost(spark):
    df = spark.createDataFrame([("c1", ["t"], ["one two"]), ("c2", [], [])], "cluster string, titles array<string>, texts array<string>")

    def fn(pdf):
        return pd.DataFrame({"title": [f"T{c}" for c in pdf["cluster"]], "full_summary": [" ".join(t) for t in pdf["texts"]],
                             "medium_summary": "m", "cost": 0.5})

    out = {r.cluster: r for r in U.summarise_with(df, fn).collect()}
    assert (out["c1"].title, out["c1"].full_summary, out["c1"].medium_summary, out["c1"].short_summary, out["c1"].cost) == ("Tc1", "one two", "m", None, 0.5)
    assert out["c2"].full_summary == ""


def test_leads_equal_their_tokens(spark):
    text = '...One two. "Three?!" four\nfive! six'
    from pyspark.sql import functions as F
    row = spark.createDataFrame([(text,), ("",), ("...",)], "t string").select(
        lead_words(F.col("t"), 3).alias("w"), lead_sentences(F.col("t"), 2).alias("s")).collect()
    assert [tuple(r) for r in row] == [('...One two. "Three?!"', 'One two. "Three?!'), ("", ""), ("...", "")]


def test_override_days_wins(spark):
    a = spark.createDataFrame([("x", True, 1), ("y", True, 30), ("z", False, 900)], "aggregator_id string, is_active boolean, horizon_days int")
    today = dt.datetime(2024, 1, 31)
    assert S.oldest_horizon(a, today).first().oldest == dt.datetime(2024, 1, 1)
    assert S.oldest_horizon(a, today, override_days=3).first().oldest == dt.datetime(2024, 1, 28)


def test_a_paid_function_is_called_once_for_each_input(spark):
    import os
    import tempfile

    from tidings.session import scratch_path

    log = tempfile.mkdtemp(prefix="calls-")

    def paid(texts):
        for t in texts:
            with open(os.path.join(log, "calls"), "a") as f:
                f.write(t + "\n")
        return [[float(len(t))] for t in texts]

    def call(d):
        return U.embed_with(d, paid, "doc")

    def calls():
        return sorted(open(os.path.join(log, "calls")).read().split())

    path = scratch_path(spark, "results")
    rows = spark.createDataFrame([(k, f"t{k % 3}", 1) for k in range(30)] + [(99, None, 1)], "id int, doc string, embedding_of int").repartition(4)
    out = U.once(rows, ["doc"], call, path)
    assert out.count() == out.count() == 31 and {r.embedding[0] for r in out.collect() if r.doc} == {2.0}
    assert calls() == ["t0", "t1", "t2"]                            # and the empty text of the null, a blank line
    more = rows.unionByName(spark.createDataFrame([(7, "new", 1)], rows.schema))
    assert U.once(more, ["doc"], call, path).count() == 32 and calls() == ["new", "t0", "t1", "t2"]
    assert U.once(rows.limit(0), ["doc"], call, path).count() == 0


def test_embed_default_counts_repeated_and_missing_keys(spark):
    import hashlib
    import math
    from collections import Counter

    rows = [(1, "One two two İ-x9"), (2, "two three"), (2, "three FOUR"), (3, None), (None, "two five"), (None, "five"), (4, "")]
    texts = {k: " ".join((t or "").lower() for j, t in rows if j == k) for k, _ in rows}
    feature = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 64
    words = {1: ["one", "two", "two", "i", "x9"], 2: ["two", "three", "three", "four"], None: ["two", "five", "five"], 3: [], 4: []}
    assert set(words) == set(texts)
    tf = {k: Counter(map(feature, w)) for k, w in words.items()}
    df = Counter(f for c in tf.values() for f in c)
    got = U.embed_default(spark.createDataFrame(rows, "id long, doc string"), "id", num_features=64).collect()
    assert Counter(r.id for r in got) == Counter(k for k, _ in rows)
    for r in got:
        w = {f: n * math.log((len(rows) + 1) / (df[f] + 1)) for f, n in tf[r.id].items()} if r.id is not None else {}
        norm = math.sqrt(sum(x * x for x in w.values()))
        assert dict(zip(r.indices, r["values"], strict=True)) == pytest.approx({f: x / norm for f, x in w.items() if x})
        assert r.indices == sorted(r.indices)


def test_embed_default_shuffles_no_tokens_of_single_rows(spark):
    plan = U.embed_default(spark.createDataFrame([(i, f"w{i} x") for i in range(50)], "id long, doc string"), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan and "regexp_extract_all" not in plan


def test_a_vector_s_norm_and_map_are_made_once_a_row(spark):
    from tidings.operators import udfs as U

    docs = spark.createDataFrame([("a", "x y y"), ("b", "x"), ("c", "z " + " ".join(f"w{i}" for i in range(400))), ("d", None)], "key string, doc string")
    e = U.embed_default(docs, "key", num_features=256)
    d = e.select("key", "indices", "values", U.dense_vector("indices", "values", 256).alias("v"))
    rows = {r.key: r for r in d.collect()}
    for r in rows.values():
        assert len(r.v) == 256 and {i: x for i, x in enumerate(r.v) if x} == dict(zip(r.indices, r["values"], strict=True))
        assert not r.indices or abs(sum(x * x for x in r.v) - 1) < 1e-9
    assert rows["c"].indices and rows["d"].indices == []
    plan = d._jdf.queryExecution().optimizedPlan().toString()
    assert "/ sqrt(aggregate(" not in plan and "try_element_at(map_from_arrays(" not in plan and "element_at(map_from_arrays(" not in plan
