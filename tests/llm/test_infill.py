"""Fill-in-middle against a plain Python version, and the index against counting."""

import hashlib
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidings.llm import infill

ALPHABET = "aZ <>PSM\n.é€\U0001f600ß-"


def laid(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    n, digest = len(units), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=60))
def test_exceptions_turn_places_both_ways(text):
    data = text.encode()
    known = infill.Exceptions(np.frombuffer(data, np.uint8))
    at = np.array([len(text[:k].encode()) for k in range(len(text) + 1)])
    assert known.to_points(at).tolist() == list(range(len(text) + 1))
    assert known.to_bytes(np.arange(len(text) + 1)).tolist() == at.tolist()
    assert len(known.bytes) == sum(ord(c) > 127 for c in text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=30), max_size=6), st.integers(0, 2))
def test_batches_are_cut_as_texts_are(texts, skip):
    h = np.random.default_rng(len(texts)).integers(0, 2**32, (4, len(texts)))
    b = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string()), *[pa.array(x) for x in h]],
                                   ["doc_id", "_text", "_h1", "_h2", "_h3", "_h4"]).slice(min(skip, len(texts)))
    for k, r in enumerate(infill._cut(b, 90, 20).to_pylist(), min(skip, len(texts))):
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", texts[k], re.S)
        lo, hi = sorted(int(x) % (len(units) + 1) for x in h[:2, k])
        p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
        assert r["n"] == len(units)
        if r["form"] == "plain":
            assert r["output"] == texts[k] and r["prefix_chars"] is None
        else:
            assert (r["prefix_chars"], r["middle_chars"], r["prefix_bytes"], r["middle_bytes"]) == (len(p), len(m), len(p.encode()), len(m.encode()))
            assert r["output"] == {"psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[r["form"]]


def test_rows_of_any_kind(spark):
    long = "wörd and\n" * 200_000
    docs = [(k, t) for k, t in enumerate(["", None, " \n", "one two three", "é€\U0001f600 ß a", "has <M> in it", "< P> <<P", long, "a" * 500_000] * 9)]
    docs += [(None, "no id here at all"), (3, "one two three"), (-4, "minus four is an id")]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n int, output string")
    got = infill.infill(df).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    want = sorted(((d or 0, *laid(d, t)) for d, t in docs), key=str)
    assert sorted(((r.doc_id or 0, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=str) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in docs)
    assert infill.infill(df.limit(0)).count() == 0


def test_rates(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("some words to cut").alias("text"))
    forms = {r.form: r["count"] for r in infill.infill(df, seed="7", rate=50, spm=50).groupBy("form").count().collect()}
    assert abs(forms["plain"] - 1500) < 150 and abs(forms["spm"] - 750) < 120 and abs(forms["psm"] - 750) < 120
