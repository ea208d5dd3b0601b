"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document, on measurements taken from its
whole text by built-in functions. The ledger keeps the measurements and one
long whose bit k says that rule k failed. A policy is a named, versioned mask:
a document passes if none of its failed bits is in the mask, so a new policy,
or leaving a rule out, is a bit operation on the ledger and reads no text.

Defined cases: a null text counts as empty (no words); rows with one doc_id are
measured one by one; an empty table gives no rows; columns besides doc_id and
text are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, words_of

WINDOW = 5
SYMBOLS = "#*$%&|<>"

#: name -> failing condition over the measurements; the place is the bit.
RULES: dict[str, Column] = {}
#: version -> names of the rules that a document must not fail.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "shouting", "duplicate_lines"),
    "v2": ("few_words", "repeated_words", "symbols", "shouting", "duplicate_lines", "tables", "long_words"),
}
CURRENT = "v2"


def rules() -> dict[str, Column]:
    c = F.col
    return {
        "few_words": c("n_words") < 10,
        "repeated_words": 100 * c("n_repeat_words") > 20 * c("n_words"),
        "symbols": 4 * c("n_symbols") > c("n_words"),
        "shouting": 2 * c("n_shouts") > c("n_words"),
        "duplicate_lines": 2 * c("n_dup_lines") > c("n_lines"),
        "tables": 4 * c("n_bars") > c("n_words"),
        "long_words": c("word_chars") > 30 * c("n_words"),
    }


def _repeat_words(words: Column) -> Column:
    """Words that lie in a WINDOW-word window found twice or more in the text.

    Windows are compared by 64-bit hash. Only texts in which one repeats sort
    them; each place of a repeated window then covers the words up to the next.
    """
    n = F.size(words) - (WINDOW - 1)
    grams = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, WINDOW))))
    return grams


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", text.alias("_text")).withColumn("_words", words_of(F.col("_text")))
    d = d.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != ""))
    d = d.withColumn("_grams", _repeat_words(F.col("_words")))
    # (hash, place) in order of hash; a place is kept if its neighbour has the same hash
    marked = F.array_sort(F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("_marked", F.when(F.size("_grams") > F.size(F.array_distinct("_grams")), marked))
    m, size = F.col("_marked"), F.size("_marked")
    same = lambda k: F.coalesce(F.get(m, k)["h"] == F.get(m, k + 1)["h"], F.lit(False))
    places = F.filter(F.transform(F.sequence(F.lit(0), size - 1), lambda k: F.when(
        ((k > 0) & same(k - 1)) | same(k), F.get(m, k)["i"])), lambda i: i.isNotNull())
    d = d.withColumn("_places", F.when(m.isNotNull(), F.array_sort(places)))
    covered = F.aggregate("_places", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("at")),
                          lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["at"])).alias("n"), p.alias("at")),
                          lambda a: a["n"])
    long = lambda x: x.cast("long")
    return d.select(
        "doc_id", long(F.size("_words")).alias("n_words"),
        long(F.length(F.array_join("_words", ""))).alias("word_chars"),
        long(F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).alias("n_symbols"),
        long(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        long(F.coalesce(covered, F.lit(0))).alias("n_repeat_words"),
        long(F.size("_lines")).alias("n_lines"),
        long(F.length("_text") - F.length(F.replace(F.col("_text"), F.lit("!!"), F.lit("!")))).alias("n_shouts"),
        long(F.length("_text") - F.length(F.replace(F.col("_text"), F.lit("|"), F.lit("")))).alias("n_bars"))


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and ``failed``: bit k is set if rule k failed."""
    bits = [F.when(cond, F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, cond in enumerate(rules().values())]
    return measured(docs).withColumn("failed", reduce(Column.bitwiseOR, bits))


def mask_of(policy: str | tuple[str, ...]) -> int:
    names = list(rules())
    return sum(1 << names.index(r) for r in (POLICIES[policy] if isinstance(policy, str) else policy))


def passes(policy: str | tuple[str, ...]) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask_of(policy)).cast("long")) == 0


def ablations(book: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone (kept
    if it were left out), and that pass the policy. The ledger is first counted
    by its masks, of which there are at most 2 ** rules, then read bit by bit."""
    mask = mask_of(policy)
    masks = book.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("failed")).count()
    names = [n for n in rules() if n in POLICIES[policy]]
    at = list(rules())
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << at.index(n)).cast("long").alias("bit")) for n in names]))
    rows = masks.select("*", each.alias("r"))
    n = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("count"))), F.lit(0))
    return rows.groupBy("r.rule").agg(n(F.col("failed").bitwiseAND(F.col("r.bit")) != 0).alias("n_failed"),
                                      n(F.col("failed") == F.col("r.bit")).alias("n_only"),
                                      n(F.col("failed") == 0).alias("n_passed"))
