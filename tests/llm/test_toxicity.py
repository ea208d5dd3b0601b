"""The grammar against plain loops, the lexicon against counters, held-out accuracy, small cases."""

import math
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidings.llm import toxicity
from tidings.llm.queries import QUERIES

GRAMMAR = toxicity.Grammar(toxicity.CHOSEN)


def score(text, grammar=GRAMMAR):
    return [round(s, 6) for _, _, s in grammar.clauses(text)]


@pytest.mark.parametrize(("text", "scores"), [
    ("what an idiot", [3.0]), ("you idiot", [4.5]), ("idiot you", [4.5]), ("not an idiot", [0.6]), ("you are not an idiot", [0.9]),
    ("he said you are an idiot", [1.8]), ('"you idiot" is bad', [1.8]), ("never one two three idiot", [3.0]),
    ("kill the lights", [0.3]), ("kill you", [4.5]), ("you, kill", [4.5]), ("nothing here", []), ("", []), (None, []),
    ("idiotic", []), ("IDIOT! moron. ok", [3.0, 3.0]), ("idiot moron", [6.0]), ("not idiot moron scum loser", [0.6 * 3 + 3.0]),
    ("he wrote: it; you scum", [4.5]), ("didn't shoot them", [0.9]), ("stupid$$$ | scum%%%", [3.0, 3.0]),
])
def test_clauses(text, scores):
    assert score(text) == [round(s, 6) for s in scores]


def test_places_are_code_points():
    text = "İé ok. You ÜBER idiot\nfine"
    (a, b, s), = GRAMMAR.clauses(text)
    assert text[a:b] == " You ÜBER idiot" and s == 4.5


def plain_clauses(text, lexicon):
    """Clause scores by splitting the text, with no automaton and no tables."""
    out = []
    for part in re.split(r"[.!?;|\n]", toxicity.folded(text)):
        tokens = [m[0] for m in toxicity.TOKEN.finditer(part)]
        kinds, weights = [], []
        for t in tokens:
            w = re.split("['’]", t)[0]
            hit = lexicon.get(w + "$") or next((lexicon[w[:k]] for k in range(len(w), 0, -1) if w[:k] in lexicon), None)
            kinds.append(hit[0] if hit else "target" if t in toxicity.TARGETS else "negation" if t in toxicity.NEGATIONS or t.endswith("n't")
                         else "report" if t in toxicity.REPORTS else "quote" if t in toxicity.QUOTES else "other")
            weights.append(hit[1] if hit else 0)
        if not any(weights):
            continue
        total, negated, said, quoted = 0.0, 0, False, False
        for k, (kind, w) in enumerate(zip(kinds, weights, strict=True)):
            if w:
                aimed = "target" in kinds[:k] + kinds[k + 1:]
                f = 1.5 if aimed else 0.1 if kind == "threat" else 1.0
                total += w * f * (0.2 if negated else 1) * (0.4 if said or quoted else 1)
            negated = toxicity.REACH if kind == "negation" else negated if kind == "quote" else max(negated - 1, 0)
            said, quoted = said or kind == "report", quoted != (kind == "quote")
        out.append(round(total, 6))
    return out


WORDS = ["idiot", "Scum", "you", "not", "said", "kill", "fine", "word", "\"", ".", "\n", "stup", "stupor", "stupid", "don't", "é", ",", "hang"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(WORDS), max_size=25))
def test_grammar_equals_plain_loops(words):
    lexicon = toxicity.CHOSEN | {"stup": ("insult", 2.0)}
    text = " ".join(words)
    assert score(text, toxicity.Grammar(lexicon)) == plain_clauses(text, lexicon)


def test_grammar_on_the_table(spark):
    grammar = toxicity.Grammar(toxicity.CHOSEN | {"th": ("insult", 1.0), "er": ("threat", 1.0)})
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        assert score(r.text, grammar) == plain_clauses(r.text, toxicity.CHOSEN | {"th": ("insult", 1.0), "er": ("threat", 1.0)})


def test_lexicon_equals_counters(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").selectExpr(
        "text", "double(toxic) AS _label")
    texts = {(r.text or "", r._label) for r in rows.collect()}
    a, b, size = Counter(), Counter(), Counter(y for _, y in texts)
    for t, y in texts:
        words = set(re.findall(r"[^\W\d_]+", t.lower()))
        (a if y else b).update({w + "$" for w in words if len(w) <= 40} | {w[:k] for w in words for k in range(4, 9) if len(w) > k})
    share, want = size[1.0] / len(texts), dict(toxicity.CHOSEN)
    for f in set(a) | {f for f in b if f in want}:
        n = a[f] + b[f]
        w = math.log((a[f] + .5) / (size[1.0] + 1)) - math.log((b[f] + .5) / (size[0.0] + 1))
        if a[f] >= 4 and w >= 1.5 and (a[f] - n * share) / math.sqrt(n * share * (1 - share)) >= 5:
            want[f] = (want.get(f, ("insult",))[0], w)
        elif f in want and w < 1.5 and n >= 20:
            del want[f]
    got = toxicity.learned(rows)
    assert got.keys() == want.keys() and all(got[f][0] == want[f][0] and math.isclose(got[f][1], want[f][1]) for f in got)


def test_refuted_words_leave_the_lexicon(spark):
    rows = spark.createDataFrame([(f"a clown number {k} works", 0.0) for k in range(40)] + [(f"you scum {k}", 1.0) for k in range(9)], "text string, _label double")
    lexicon = toxicity.learned(rows)
    assert "clown$" not in lexicon and lexicon["scum$"][1] > 3 and "idiot$" in lexicon


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op13_toxicity"](spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in rows)
    seen = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    right = sum(p and y for p, y in seen)
    assert right >= 0.9 * sum(y for _, y in seen) and right >= 0.95 * sum(p for p, _ in seen)


def test_small_cases(spark):
    schema = "doc_id long, text string, _text string, score int, clauses int, _words int, form int"
    texts = [(1, None), (2, ""), (3, "you stupid moron"), (3, "you stupid moron"), (None, "you scum"), (4, "x" * 2_000_000), (5, "idiot " * 200_000),
             (6, "plain words")]
    docs = spark.createDataFrame([(*t, "idiot", 1, 1, 1, 1) for t in texts], schema)
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (3, 0), (6, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    for model in (toxicity.fit(docs, labels), toxicity.fit(docs, labels.limit(0)), toxicity.fit(docs.limit(0), labels)):
        got = toxicity.scored(docs, model).collect()
        assert len(got) == len(texts) and all(0 <= r.score <= 1 for r in got)
        by = {r.doc_id: r for r in got}
        assert by[3].score > by[6].score and len(by[3].clauses) == 1 and not by[1].clauses
        assert toxicity.scored(docs.limit(0), model).count() == 0
