"""Toxicity by a weighted finite-state pattern grammar.

Four small transducers are composed over the words of a clause:

* lexical: an automaton of insults and threats; each form or stem has a weight;
* target: a match counts more in a clause that addresses someone, on either
  side of the match; a threat without a target counts little;
* negation: a match within ``REACH`` words after a negation counts little;
* reported speech: a match after a verb of saying, or in quotes, counts less.

The last three are finite-state tables (``Machine``); their product is one
table that maps (state, symbol) to (state, factor). It reads a clause's symbols
from the left; the target table reads them from the right as well, because a
target may follow. What is scored is the clause: the sum over its matches of
weight times factor. Clauses without a match are never lexed.

The lexicon: ``INSULTS`` and ``THREATS`` are chosen, with a common weight.
Further forms and stems are learned from labelled texts, in any language: those
that stand in toxic texts far more often than in others, with their log odds as
weight. The longest one that begins a word decides. A chosen word that labelled
texts use freely is dropped. The score of a document is a logistic
function of its sum of clause scores, that sum per word, and its length.

Labels are learned from at most ``SAMPLE`` labelled documents, those with the
least hash of their id; equal texts count once in the lexicon. Its size is
bounded by the sample's; it is collected and sent to the tasks.

Defined cases: a null text counts as empty and gets a score; a document with
several labels counts with the highest; without labels of both classes the
logistic function has chosen weights; rows with one doc_id are scored one by
one; an empty table gives no rows; further columns are not read. Letters are
compared in lower case; places are code points of the text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SAMPLE = 20_000
THRESHOLD = 0.5
LEAST_TEXTS, LEAST_WEIGHT, LEAST_Z = 4, 1.5, 5.0     # of a learned form: toxic texts, log odds, standard deviations
STEMS = range(4, 9)                                  # letters of a learned stem
LONGEST = 40                                         # letters of a learned form
REACH = 3                                            # words after a negation
CHOSEN_WEIGHT = 3.0
CHOSEN_LOGIT = (-3.0, 1.0, 1.0, -0.2)                # without labels of both classes

# chosen words, not taken from anywhere
INSULTS = ("idiot", "idiots", "moron", "morons", "imbecile", "cretin", "scum", "scumbag", "loser", "losers", "trash", "garbage",
           "pathetic", "worthless", "disgusting", "stupid", "dumb", "clown", "vermin", "filth", "coward", "liar", "freak",
           "ugly", "retard", "bastard", "bitch", "asshole", "whore", "slut", "parasite")
THREATS = ("kill", "murder", "strangle", "stab", "shoot", "hang", "hurt", "beat", "burn", "destroy", "rape", "slaughter")
TARGETS = frozenset("you your yours yourself u ur he him his she her they them their these those people everyone all "
                    "du dich dir ihr euch sie tu toi te vous vos ton usted tú ustedes ellos".split())
NEGATIONS = frozenset("not no never none neither nor without don't doesn't didn't isn't aren't wasn't weren't won't cannot can't "
                      "nicht kein keine nie ne pas jamais nunca ni".split())
REPORTS = frozenset("said says say saying called calls wrote writes claimed claims quoted quotes reported reports told tells "
                    "asked sagte nannte schrieb dit écrit dijo llamó".split())
QUOTES = frozenset("\"“”„«»")

TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[\"“”„«»]")
CLAUSE_END = re.compile(r"[.!?;|\n]")
ENDS = ".!?;|\n"


@dataclass(frozen=True)
class Machine:
    """A finite-state transducer: (state, symbol) to (state, factor); other symbols lead by ``rest`` and give 1."""

    start: int
    arcs: dict[tuple[int, str], tuple[int, float]]
    rest: dict[int, int] = field(default_factory=dict)

    def step(self, state: int, symbol: str) -> tuple[int, float]:
        return self.arcs.get((state, symbol)) or (self.rest.get(state, state), 1.0)


SYMBOLS = ("insult", "threat", "target", "negation", "report", "quote", "other")

#: state 1: a target was read
TARGET = Machine(0, {(0, "target"): (1, 1.0), (0, "threat"): (0, 0.1), (1, "insult"): (1, 1.5), (1, "threat"): (1, 1.5)})
#: state k: k more words are negated
NEGATION = Machine(0, {(k, "negation"): (REACH, 1.0) for k in range(REACH + 1)}
                   | {(k, s): (k - 1, 0.2) for k in range(1, REACH + 1) for s in ("insult", "threat")}
                   | {(k, "quote"): (k, 1.0) for k in range(REACH + 1)}, {k: k - 1 for k in range(1, REACH + 1)})
#: states 0 and 1: outside and inside quotes; 2 and 3: the same after a verb of saying
REPORT = Machine(0, {(k, "report"): (k | 2, 1.0) for k in range(4)} | {(k, "quote"): (k ^ 1, 1.0) for k in range(4)}
                 | {(k, s): (k, 0.4) for k in (1, 2, 3) for s in ("insult", "threat")})


def compose(*machines: Machine) -> tuple[int, list[dict[str, tuple[int, float]]]]:
    """The product of machines that read the same symbols: (start, a table of arcs per state); factors multiply."""
    names = {tuple(m.start for m in machines): 0}
    queue, table = list(names), []
    while len(table) < len(queue):
        states, arcs = queue[len(table)], {}
        for s in SYMBOLS:
            steps = [m.step(q, s) for m, q in zip(machines, states, strict=True)]
            to = tuple(q for q, _ in steps)
            if to not in names:
                names[to] = len(names)
                queue.append(to)
            arcs[s] = (names[to], math.prod(f for _, f in steps))
        table.append(arcs)
    return 0, table


CONTEXT = compose(NEGATION, REPORT)


def clause_score(symbols: list[str], weights: list[float]) -> float:
    """The sum over the matches of a clause of weight times factor (symbol ``insult`` or ``threat``)."""
    ahead, seen = [1.0] * len(symbols), TARGET.start
    for k in range(len(symbols) - 1, -1, -1):           # the target table, from the right
        seen, ahead[k] = TARGET.step(seen, symbols[k])
    state, table = CONTEXT
    seen, total = TARGET.start, 0.0
    for s, w, right in zip(symbols, weights, ahead, strict=True):
        state, factor = table[state][s]
        seen, left = TARGET.step(seen, s)
        if w:
            total += w * factor * max(left, right)
    return total


def folded(text: str) -> str:
    """Lower case, letter by letter, so that places stay."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) > 1 else c.lower() for c in text)
    return low


Lexicon = dict[str, tuple[str, float]]      # form, with "$" after it if it is a whole word: (insult or threat, weight)

CHOSEN: Lexicon = {f"{w}$": ("insult", CHOSEN_WEIGHT) for w in INSULTS} | {f"{w}$": ("threat", CHOSEN_WEIGHT) for w in THREATS}


class Grammar:
    """The lexical automaton over a lexicon, and the clause score of what it finds."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.automaton = ahocorasick.Automaton()
        for form, (symbol, weight) in lexicon.items():
            bare = form.removesuffix("$")
            own = self.automaton.get(bare, (len(bare), None, None))
            self.automaton.add_word(bare, (len(bare), own[1], (symbol, weight)) if form != bare else (len(bare), (symbol, weight), own[2]))
        if len(self.automaton):
            self.automaton.make_automaton()

    def words(self, low: str) -> dict[int, tuple[str, float]]:
        """What begins at each place: the longest stem, or the whole word, that begins a word."""
        found: dict[int, tuple[str, float]] = {}
        if not len(self.automaton):
            return found
        size = len(low)
        for end, (n, stem, word) in self.automaton.iter(low):      # of one start, longer matches come later
            at = end + 1 - n
            if at and low[at - 1].isalpha():
                continue
            if word and (end + 1 == size or not low[end + 1].isalpha()):
                found[at] = word
            elif stem:
                found[at] = stem
        return found

    def clauses(self, text: str | None) -> list[tuple[int, int, float]]:
        """(start, end, score) of every clause with a match, in order."""
        low = folded(text or "")
        matches = self.words(low)
        out, done = [], 0
        for at in sorted(matches):
            if at < done:
                continue
            start = 1 + max(done - 1, *(low.rfind(c, done, at) for c in ENDS))
            stop = CLAUSE_END.search(low, at)
            done = stop.end() if stop else len(low)
            symbols, weights = [], []
            for t in TOKEN.finditer(low, start, done):
                symbol, weight = matches.get(t.start(), (None, 0.0))
                if symbol is None:
                    w = t[0]
                    symbol = ("target" if w in TARGETS else "negation" if w in NEGATIONS or w.endswith("n't") else
                              "report" if w in REPORTS else "quote" if w in QUOTES else "other")
                symbols.append(symbol)
                weights.append(weight)
            out.append((start, stop.start() if stop else done, clause_score(symbols, weights)))
        return out


def matches(docs: DataFrame, lexicon: Lexicon, *keep: str) -> DataFrame:
    """Per row of docs: the kept columns, the number of words, the sum of clause scores, and the clauses with a match."""
    rows = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    clause = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(lexicon)
        for b in batches:
            texts = b.column("_text").to_pylist()
            found = [grammar.clauses(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array([len(t.split()) for t in texts], pa.int64()),
                 pa.array([math.fsum(c[2] for c in cs) for cs in found], pa.float64()),
                 pa.array([[dict(zip(("start", "end", "score"), c, strict=True)) for c in cs] for cs in found], clause)],
                [*keep, "_words", "_sum", "clauses"])

    return rows.mapInArrow(work, f"{kept}, _words long, _sum double, clauses array<struct<start: int, end: int, score: double>>")


def _features() -> list:
    words, total = F.col("_words"), F.col("_sum")
    return [F.log1p(total), F.log1p(100 * total / (words + 20)), F.log1p(words)]


def _stems(words: Column, letters: int) -> Column:
    """The first letters of all longer words."""
    return F.transform(F.filter(words, lambda w: F.length(w) > letters), lambda w: F.substring(w, 1, letters))


def learned(rows: DataFrame) -> Lexicon:
    """The lexicon that rows (text, _label) teach, with the chosen words that they do not refute."""
    texts = rows.select(F.coalesce(F.col("text"), F.lit("")).alias("text"), "_label").dropDuplicates(["text", "_label"])
    word = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("\\p{L}+"), F.lit(0)))
    short = F.filter(word, lambda w: F.length(w) <= LONGEST)
    forms = F.concat(F.transform(short, lambda w: F.concat(w, F.lit("$"))), *[_stems(word, k) for k in STEMS])
    sizes = {r["_label"]: r["count"] for r in texts.groupBy("_label").count().collect()}
    ones, zeros = sizes.get(1.0, 0), sizes.get(0.0, 0)
    counts = texts.select("_label", F.explode(F.array_distinct(forms)).alias("form")).groupBy("form").agg(
        F.sum("_label").alias("a"), F.sum(1 - F.col("_label")).alias("b"))
    share = ones / max(ones + zeros, 1)
    n = F.col("a") + F.col("b")
    counts = counts.withColumn("weight", F.log((F.col("a") + 0.5) / (ones + 1)) - F.log((F.col("b") + 0.5) / (zeros + 1)))
    counts = counts.withColumn("z", (F.col("a") - n * share) / F.sqrt(n * max(share * (1 - share), 1e-9)))
    good = (F.col("a") >= LEAST_TEXTS) & (F.col("weight") >= LEAST_WEIGHT) & (F.col("z") >= LEAST_Z)
    refuted = F.col("form").isin(list(CHOSEN)) & (F.col("weight") < LEAST_WEIGHT) & (n >= 5 * LEAST_TEXTS)
    lexicon = dict(CHOSEN)
    for r in counts.filter(good | refuted).orderBy("form").collect():      # forms of at most SAMPLE texts
        if r["weight"] < LEAST_WEIGHT:
            del lexicon[r["form"]]
        else:
            lexicon[r["form"]] = (CHOSEN.get(r["form"], ("insult",))[0], r["weight"])
    return lexicon


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    logit: tuple[float, ...]       # intercept, then a weight for each feature


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Learns the lexicon and the logistic weights from the rows of ``labels`` (doc_id, label)."""
    marked = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(
        F.max(label).cast("double").alias("_label"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)     # at most ``sample`` rows of 16 bytes
    rows = written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "_label"), "toxicity-sample")
    if {r["_label"] for r in rows.select("_label").distinct().collect()} != {0.0, 1.0}:
        return Model(CHOSEN, CHOSEN_LOGIT)
    lexicon = learned(rows)
    seen = matches(rows, lexicon, "_label").select("_label", F.array(*[f.cast("double") for f in _features()]).alias("_x"))
    seen = written(seen, "toxicity-features").select("_label", array_to_vector("_x").alias("_x"))
    model = LogisticRegression(featuresCol="_x", labelCol="_label", regParam=1e-4, maxIter=200).fit(seen)
    return Model(lexicon, (float(model.intercept), *model.coefficients.toArray().tolist()))


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of docs: doc_id, score, predicted, and the clauses that matched (start, end, score)."""
    logit = F.lit(model.logit[0])
    for weight, x in zip(model.logit[1:], _features(), strict=True):
        logit = logit + weight * x
    s = matches(docs, model.lexicon, "doc_id").withColumn("score", 1 / (1 + F.exp(-logit)))
    return s.select("doc_id", "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"), "clauses")
