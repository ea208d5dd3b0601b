"""Every stage of the pipeline against brute force on its own input."""

import os
import re

import numpy as np
import pytest

import corpus_pipeline
from tidings.llm import jaccard, packing
from tidings.llm.common import written

from .test_exact import brute_classes, near_copies

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF), name))
    return out


def test_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_quality_keeps_clean_documents(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    assert all((labels[d] == 1) == (d in kept) for d in labels)


def test_near_duplicates_share_four_fifths_of_five_words(stages):
    texts = {r.doc_id: r.text for r in stages[1].collect()}
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted({c for _, c in brute_classes(texts, 5, 80).values()})


@pytest.mark.parametrize("seed", [4, 5])
def test_near_duplicates_on_made_copies(spark, seed):
    docs = near_copies(seed, families=30)
    want = sorted({c for _, c in brute_classes(docs, 5, 80).values()})
    assert want != sorted({c for _, c in brute_classes(docs).values()})
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates_stage(spark, df, SF).collect()) == want


def test_sets_that_link_at_four_fifths_share_a_key():
    sizes, rng = corpus_pipeline.SIZES, np.random.default_rng(6)
    for n in rng.integers(1, 600, 600).tolist():
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.permutation(n)[int(rng.integers(0, n // 5 + 1)):]], rng.integers(0, 2**64, int(rng.integers(0, n // 4 + 1)), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both) and not np.array_equal(a, b):
            assert set(jaccard.keys_of(a, sizes).tolist()) & set(jaccard.keys_of(b, sizes).tolist())


def test_documents_with_items_go(spark, stages):
    plain = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    items = [plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = sorted(r.doc_id for r in stages[2].collect() if not any(i in plain(r.text) for i in items))
    assert sorted(r.doc_id for r in stages[3].collect()) == clean


def test_mix_repeats_and_cuts(stages):
    before = {r.doc_id: r for r in stages[3].collect()}
    for r in stages[4].collect():
        assert before[r.doc_id].text.startswith(r.text) and r.text and r.n_chars == len(r.text)
    assert sum(len(r.text.split()) for r in stages[4].collect()) == pytest.approx(sum(len(r.text.split()) for r in before.values()), abs=40)


def test_rows_hold_all_tokens(stages):
    encode = packing.encoder(packing.TOKENIZER)
    want = sorted(tuple(encode(r.text)) for r in stages[4].collect())
    pieces = sorted(packing.unpacked(stages[5]).collect(), key=lambda r: (r.doc_id, r.offset))
    assert sum(map(len, want)) == sum(len(p.ids) for p in pieces) == stages[5].agg({"n_tokens": "sum"}).first()[0]
    short = [tuple(np.uint32(p.ids)) for p in pieces if p.offset == 0 and len(p.ids) < packing.SEQ_LEN]
    assert sorted(short) == [w for w in want if len(w) < packing.SEQ_LEN]


def test_rest_works_without_the_package():
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    code = ("import sys\n"
            "class No:\n"
            "    def find_spec(self, name, *a):\n"
            "        if name.split('.')[:2] == ['tidings', 'llm'] or name == 'corpus_pipeline':\n"
            "            raise ModuleNotFoundError(name=name)\n"
            "sys.meta_path.insert(0, No())\n"
            "import __spark_entry__ as e\n"
            "assert 'pipeline' not in e.queries() and len(e.queries()) > 80")
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
