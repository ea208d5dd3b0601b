"""Line deduplication by a deletion-neighbourhood join.

A line is the sequence of its words. Two lines are the same up to the edit
bound if one word inserted, deleted or replaced turns one into the other and
both have ``LEAST_WORDS`` words or more (so at least 0.8 of a line agrees);
shorter lines must be equal. A line goes if such a line stands earlier, in
order of (doc_id, line number), kept or not. Only DataFrame functions are used:

1. Equal lines are one line at its earliest place (grouped minimum of hashes).
   These get numbers in order of place, by one sort over ranges.
2. One edit lies in the first or in the second half of a line, so similar
   lines have equal first or equal last halves. A line that shares no half with
   another goes no further, and one that shares only its first half has its
   edit in the rest; no pair is lost by that.
3. Each other line emits every variant with one word of the part that may
   differ left out, as hashed keys: with the gap left open (replaced words),
   and closed up, against the whole lines of one word less.
4. Lines with one open key differ in one word at one place; lines with one
   closed key are a shorter line and longer ones. So the least number of the
   other kind in a key is an earlier similar line, if there is any. Each line is
   joined to it, and the edit distance of the two is verified word by word.

Keys are grouped by minimum and never gathered, so a frequent line or a large
family of variants costs a row for each variant. The minima are written before
they are joined, so hot keys of the join can be split.

Defined cases: null and empty texts have no lines; lines without a word stay
and are not counted; lines at one number of rows with one doc_id stand at the
same place, and none of them makes another go; each is judged by its own text; rows without a doc_id keep all
lines; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE, words_of, written

LEAST_WORDS = 5


def _lines(text: str = "text") -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def _halves(n: Column, words: Column) -> Column:
    """Hashes of the words, at the front and at the end, that one edit in the
    other half leaves alone, for partners of equal length and longer, then (if they differ) for shorter ones."""
    def one(size: Column) -> list[Column]:
        return [F.xxhash64(F.lit(0), size, F.slice(words, F.lit(1), size)),
                F.xxhash64(F.lit(1), size, F.slice(words, n - size + 1, size))]

    # lines of n words share n div 2 words or more with lines of n and n + 1, and (n - 1) div 2 with those of n - 1
    wide, short = one((n / 2).cast("int")), one(((n - 1) / 2).cast("int"))
    return F.when(n < LEAST_WORDS, F.array().cast("array<bigint>")).when(n % 2 == 1, F.array(*wide)).otherwise(F.array(*wide, *short))


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, line, h1, h2, halves) of every line with a word; no text."""
    d = docs.filter("doc_id IS NOT NULL").select("doc_id", F.posexplode(_lines()).alias("line", "_text"))
    d = d.filter(F.btrim("_text", F.lit(WHITE)) != "").select("doc_id", "line", words_of(F.col("_text")).alias("_words"))
    n = F.size("_words")
    return d.select("doc_id", "line", *_names(F.col("_words")), _halves(n, F.col("_words")).alias("halves"))


def _names(words: Column) -> list[Column]:
    return [F.xxhash64(words).alias("h1"), F.xxhash64(words, F.size(words)).alias("h2")]


def _firsts(rows: DataFrame) -> DataFrame:
    """(lid, doc_id, line, h1, h2, halves) of the distinct lines at their earliest places; lid follows the place."""
    first = rows.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "line", "halves")).alias("first")).select("first.*", "h1", "h2")
    ordered = first.repartitionByRange("doc_id", "line").sortWithinPartitions("doc_id", "line")
    return written(ordered.select(F.monotonically_increasing_id().alias("lid"), "doc_id", "line", "h1", "h2", "halves"), "line-first")


def _candidates(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(lid, doc_id, line, shared, words) of the distinct lines that share a half with another; shared: which, as bits."""
    keys = firsts.select("lid", F.posexplode("halves").alias("at", "half"))
    shared = keys.groupBy("half").agg(F.min("lid").alias("a"), F.max("lid").alias("b")).filter("a < b").select("half")
    found = keys.join(written(shared, "line-halves"), "half", "left_semi").groupBy("lid").agg(
        F.bit_or(F.expr("shiftleft(1, at)")).alias("shared"))
    chosen = written(firsts.select("lid", "doc_id", "line", "h1", "h2").join(found, "lid"), "line-chosen")
    numbers = chosen.groupBy("doc_id").agg(F.collect_set("line").alias("_chosen"))
    # the numbers grow with the documents, so they are never broadcast
    texts = docs.select("doc_id", "text").join(numbers.hint("merge"), "doc_id").withColumn("_lines", _lines())
    one = F.explode(F.transform("_chosen", lambda i: F.struct(i.alias("line"), F.get("_lines", i).alias("text"))))
    rows = texts.select("doc_id", one.alias("_one")).select("doc_id", "_one.line", words_of(F.col("_one.text")).alias("words"))
    # of rows with one doc_id, the line that was chosen, not another one at its number
    rows = rows.select("doc_id", "line", "words", *_names(F.col("words"))).join(chosen, ["doc_id", "line", "h1", "h2"])
    return written(rows.select("lid", "doc_id", "line", "shared", "words").dropDuplicates(["lid"]), "line-candidates")


def _variants(lines: DataFrame) -> DataFrame:
    """(key, role, lid): role 0 a gap left open, 1 a whole line, 2 a gap closed up.

    A sequence is hashed as the xor of its words' hashes at their places, so
    leaving one out is an xor with a running value.
    """
    n = F.size("words")
    # the least shared half at the front, and at the end (no half: all the line is shared, nothing may differ)
    wide, short = (F.col("n") / 2).cast("int"), ((F.col("n") - 1) / 2).cast("int")

    def least(end: int) -> Column:
        bit = F.col("shared")
        return F.when(bit.bitwiseAND(4 << end) != 0, short).when(bit.bitwiseAND(1 << end) != 0, wide).otherwise(F.col("n"))

    # by line first: the windows below then need no exchange of words
    w = lines.repartition("lid").select("lid", "shared", n.alias("n"), F.posexplode("words").alias("j", "_word"))
    w = w.withColumn("may", (F.col("j") >= least(0)) | (F.col("j") < F.col("n") - least(1)))
    w = w.select("lid", "n", "j", "may", F.xxhash64("_word", "j").alias("here"), F.xxhash64("_word", F.col("j") - 1).alias("moved"))
    whole = Window.partitionBy("lid").orderBy("j")
    upto, every = whole.rowsBetween(Window.unboundedPreceding, 0), whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = w.select("lid", "n", "j", "may", "here", F.bit_xor("here").over(upto).alias("here_to"), F.bit_xor("moved").over(upto).alias("moved_to"),
                 F.bit_xor("here").over(every).alias("here_all"), F.bit_xor("moved").over(every).alias("moved_all"))
    xor = Column.bitwiseXOR
    closed = xor(xor(xor(F.col("here_to"), F.col("here")), F.col("moved_all")), F.col("moved_to"))

    def key(role: int, hashed: Column) -> Column:
        return F.struct(F.lit(role).cast("tinyint").alias("role"), hashed.alias("key"))

    gap_open = key(0, F.xxhash64("n", "j", xor(F.col("here_all"), F.col("here"))))
    line = F.when(F.col("j") == 0, key(1, F.xxhash64("n", F.col("here_all"))))
    gap_closed = key(2, F.xxhash64(F.col("n") - 1, closed))
    # a run of equal words gives the same closed variant again and again
    keys = F.when(F.col("may"), F.array(gap_open, gap_closed, line)).otherwise(F.array(line))
    return w.select("lid", F.explode(F.filter(keys, lambda k: k.isNotNull())).alias("_key")).select("_key.key", "_key.role", "lid")


def _distance_one(a: Column, b: Column) -> Column:
    """Whether one edit of a word, or none, turns a into b."""
    def shared(x: Column, y: Column) -> Column:
        at = F.array_position(F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False))), F.lit(False))
        return F.when(at == 0, F.least(F.size(x), F.size(y))).otherwise(at - 1)

    longer = F.greatest(F.size(a), F.size(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (shared(a, b) + shared(F.reverse(a), F.reverse(b)) >= longer - 1)


def _near(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(doc_id, line, h1, h2) of the distinct lines with an earlier similar one."""
    lines = _candidates(docs, firsts)
    keys = written(_variants(lines), "line-variants")
    least = [F.min(F.when(F.col("role") == k, F.col("lid"))).alias(f"m{k}") for k in range(3)]
    groups = keys.groupBy("key").agg(F.min("lid").alias("a"), F.max("lid").alias("b"), *least).filter("a < b").drop("a", "b")
    groups = written(groups, "line-least")
    other = F.when(F.col("role") == 0, F.col("m0")).when(F.col("role") == 1, F.col("m2")).otherwise(F.col("m1"))
    pairs = keys.join(groups, "key").withColumn("other", other).filter("other < lid").select("lid", "other").distinct()
    before = lines.select(F.col("lid").alias("other"), F.struct("doc_id", "line").alias("place"), F.col("words").alias("others"))
    pairs = pairs.join(lines.select("lid", "doc_id", "line", "words"), "lid").join(before, "other")
    earlier = F.col("place") < F.struct("doc_id", "line")
    found = pairs.filter(earlier & _distance_one(F.col("words"), F.col("others"))).select("lid").distinct()
    return firsts.join(found, "lid", "left_semi").select("doc_id", "line", "h1", "h2")


def decisions(docs: DataFrame) -> DataFrame:
    """Per doc_id: n_lines, n_equal and n_near (lines that go as equal or
    similar to an earlier one), dropped (their numbers, ascending), gone (number and hash of each)."""
    rows = written(lines_of(docs), "line-rows")
    firsts = _firsts(rows)
    place = ["doc_id", "line", "h1", "h2"]
    near = _near(docs, firsts).withColumn("_near", F.lit(True))
    own = firsts.select(*place, F.lit(True).alias("_first")).join(near, place, "left")
    # a line whose place is not the first of its text is a copy
    marked = rows.select(*place).join(own, place, "left")
    equal, close = F.col("_first").isNull(), F.coalesce(F.col("_near"), F.lit(False))
    return marked.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(equal).alias("n_equal"), F.count_if(~equal & close).alias("n_near"),
        F.array_sort(F.collect_set(F.when(equal | close, F.struct("line", "h1")))).alias("gone")).withColumn(
        "dropped", F.array_distinct(F.transform("gone", lambda g: g.line)))


def report(docs: DataFrame) -> DataFrame:
    """The decisions for every row of docs, those without lines included."""
    found = docs.select("doc_id").join(decisions(docs), "doc_id", "left")
    count = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_lines", "n_equal", "n_near")]
    return found.select("doc_id", *count, F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns as they are, with the lines that go taken out of the text."""
    names = [f"_column_{k}" for k in range(len(docs.columns))]
    doc_id, text = names[docs.columns.index("doc_id")], names[docs.columns.index("text")]
    gone = decisions(docs.select("doc_id", "text")).filter(F.size("gone") > 0).select("doc_id", "gone")
    d = docs.toDF(*names)
    d = d.join(gone, d[doc_id] == gone["doc_id"], "left")
    kept = F.array_join(F.filter(_lines(text), lambda x, i: ~F.array_contains(
        "gone", F.struct(i.alias("line"), F.xxhash64(words_of(x)).alias("h1")))), "\n")
    left = F.when(F.col("gone").isNull(), F.col(text)).otherwise(kept)
    return d.select(*[(left if n == text else F.col(n)).alias(c) for n, c in zip(names, docs.columns, strict=True)])
