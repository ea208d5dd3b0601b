"""Candidates of the n-gram Jaccard join: keys that are shared, counted."""

import itertools

import numpy as np
import pyarrow as pa
import pytest

from tidings.llm import jaccard
from tidings.llm.components import components

SIZES = jaccard.Sizes(80, 100, share=1 / 8)


def bundles(df, share=2.0):
    """Component by the first sum of a set; with ``share`` 2 no shingle is common."""
    return {r.node: r.component for r in components(jaccard.candidates(df, SIZES, 5, share)).collect()}


def names(texts):
    sets = jaccard.shingle_sets(texts, 5)
    return sets, jaccard.names_of(sets)[0].tolist()


def test_sets_with_one_passage_do_not_hang_together(spark):
    passage = " ".join(f"p{j}" for j in range(44))
    texts = [" ".join(f"d{k}x{j}" for j in range(360)) + " " + passage for k in range(150)]
    texts.append(texts[0] + " and a few words more")
    found = bundles(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    _, f = names(texts)
    assert len(found) < 12 and found[f[0]] == found[f[-1]]


@pytest.mark.parametrize("seed", [1, 2])
def test_sets_that_link_hang_together(spark, seed):
    rng = np.random.default_rng(seed)
    texts = []
    for size, copies in ((12, 30), (40, 25), (150, 14), (300, 3), (60, 4), (9, 12), (25, 5)):
        base = [f"f{size}w{rng.integers(1 << 30)}" for _ in range(size)]
        for _ in range(copies):
            own = list(base)
            for at in rng.integers(0, max(1, size // 15), max(1, size // 30)):           # each of the first words is in few shingles
                own[at if rng.random() < 0.9 else size // 2] = f"n{rng.integers(1 << 30)}"
            texts += [" ".join(own)] * int(rng.integers(1, 4))
    texts = [texts[k] for k in rng.permutation(len(texts))]
    found = bundles(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5), 2.0 if seed == 1 else 0.1)
    sets, f = names(texts)
    n = 0
    for (a, x), (b, y) in itertools.combinations(zip(sets, f, strict=True), 2):
        both = len(np.intersect1d(a, b))
        if x != y and 100 * both >= 80 * (len(a) + len(b) - both):
            n += 1
            assert found[x] == found[y]
    assert n > 100


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_keys_meet_across_batches(size):
    rng, most = np.random.default_rng(size), jaccard.PAIRED
    held = {(k << 8) | int(rng.integers(0, 3)): sorted(rng.choice(99, n, replace=False).tolist())
            for k, n in enumerate([1, 2, most, most + 1, 1, 30, 3, most + 1, 1, 2, most, 40])}
    keys = [np.array([k for k, v in held.items() if d in v], np.uint64) for d in range(99)]
    rows = []
    for part in (range(0, 60), range(60, 99), range(40, 70)):          # some sets come twice
        rows += jaccard._combined([keys[d] for d in part], list(part)).to_pylist()
    rows.sort(key=lambda r: (r["key"], r["node"] is not None, r["node"]))
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("hot", pa.int64())])
    batches = [pa.RecordBatch.from_pylist(rows[k:k + size], schema) for k in range(0, len(rows), size)]
    got = [(r["a"], r["b"], r["kind"]) for b in jaccard._met(iter(batches)) for r in b.to_pylist()]
    pairs = sorted(x for x in got if x[2] >= 0)
    assert pairs == sorted((a, b, k & 255) for k, v in held.items() if len(v) <= most for a, b in itertools.combinations(v, 2))
    assert {x for x in got if x[2] < 0} == {(d, k, ~(k & 255)) for k, v in held.items() if len(v) > most for d in v}
    assert not [*jaccard._met(iter([]))][0].num_rows
