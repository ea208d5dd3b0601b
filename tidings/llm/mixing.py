"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks.

1. A document's size is its number of words. A source's target is its share by
   weight of the words of the whole corpus, at most ``MAX_EPOCHS`` times its
   own size; what that cuts off is shared out again by weight.
2. The corpus is counted in blocks of equal size: at least ``BLOCKS``, and so
   many more that an average shard and the source with the least target hold
   ``PART_BLOCKS`` each, however large the corpus is. The blocks go to the
   sources by highest quotients target / (2 * seats + 1). A source's blocks go
   to its shards (hash parts of about ``SHARD_DOCS`` documents, so a hot source
   is many shards) in the same way, by shard size.
3. In each shard the documents stand in a seeded order; its quota is taken
   from the front of that order, again from the front where the quota is more
   than the shard holds.

The quotients are not ranked one by one: the divisor at which all seats are
given is narrowed by grouped sums, and only documents tied at it are ranked.

Defined cases: a null text has size 0 and takes 0; a null source is a source of
its own that sorts last; rows with one doc_id are mixed each on its own; an
empty table gives no rows; a corpus without words has targets 0. Only doc_id,
text and source are read, so further columns of any name do no harm.
"""

from __future__ import annotations

import re
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import words_of, written

MAX_EPOCHS = 3
SHARD_DOCS = 4096
BLOCKS = 1 << 20         # blocks the corpus is counted in, at least (words permitting)
PART_BLOCKS = 64         # blocks of an average shard and of the least target, at least
GRID = 64                # divisors tried in one grouped sum


def _key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), source))


def ranked(sources: DataFrame) -> DataFrame:
    """Adds ``rank`` (from 0) by code point of ``source``, null last, without
    bringing all sources into one task: ranks within ranges, plus the sizes of
    the ranges before (one number for each range)."""
    ranges = sources.repartitionByRange(F.asc_nulls_last("source")).withColumn("range", F.spark_partition_id())
    own = Window.partitionBy("range").orderBy(F.asc_nulls_last("source"))
    ranges = written(ranges.withColumn("place", F.row_number().over(own) - 1), "mix-sources")
    before, n = [], 0
    for r in ranges.groupBy("range").count().orderBy("range").collect():
        before += [F.lit(r["range"]), F.lit(n)]
        n += r["count"]
    offset = F.create_map(*before)[F.col("range")] if before else F.lit(0)
    return ranges.withColumn("rank", F.col("place") + offset).drop("range", "place")


def targets(sources: DataFrame) -> DataFrame:
    """Adds ``target`` to (source, source_size, weight): weighted shares of all
    words, at most MAX_EPOCHS times a source's size, the excess shared again."""
    cap = F.col("source_size") * MAX_EPOCHS
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, n_full = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) > cap
        s = sources.agg(F.count_if(full).alias("n"), F.sum(F.when(full, cap)).alias("cap"),
                        F.sum(F.when(~full, F.col("weight"))).alias("w")).first()
        if s["n"] == n_full or not s["w"]:
            break
        n_full, level = s["n"], (total - (s["cap"] or 0)) / s["w"]
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), cap.cast("double")))


def apportion(parts: DataFrame, group: list[str], votes: str, seats: str, key: list[str]) -> DataFrame:
    """Adds ``quota``: the Sainte-Lague seats of each part within its group.

    ``votes`` is a part's weight, ``seats`` the group's number of seats (the
    same in all its rows), ``key`` breaks ties. A part with no votes gets none.
    """
    most = parts.agg(F.max(seats)).first()[0] or 0
    rounds = 1
    while GRID ** rounds <= 16 * most:      # then at most one seat of a part is open
        rounds += 1
    votes_all = parts.groupBy(*group).agg(F.sum(F.col(votes).cast("double")).alias("_all_votes"))
    base = parts.join(votes_all, group).withColumn(
        "_ideal", F.when((F.col(seats) > 0) & (F.col(votes) > 0), F.col("_all_votes") / F.col(seats)))
    base = written(base.drop("_all_votes"), "mix-parts")

    def held(divisor: Column) -> Column:
        return F.coalesce(F.floor(F.col(votes) / divisor + 0.5), F.lit(0))

    # at the factor 0 < f all seats and more are held, at f = 3 at most the seats
    bounds = written(base.groupBy(*group, F.col(seats).alias("_total")).agg(F.count(F.lit(1)).alias("_parts"))
                     .select(*group, "_total", F.when(F.col("_total") > 0, F.col("_total") / (F.col("_total") + F.col("_parts")) / 2)
                             .otherwise(1.0).alias("_lo"), F.lit(3.0).alias("_hi")), "mix-bounds")
    for _ in range(rounds):
        tried = F.explode(F.sequence(F.lit(1), F.lit(GRID - 1))).alias("_i")
        at = base.select(*group, votes, "_ideal", tried).join(bounds, group)
        step = (F.col("_hi") - F.col("_lo")) / GRID
        at = at.groupBy(*group, "_total", "_lo", "_hi", "_i").agg(
            F.sum(held(F.col("_ideal") * (F.col("_lo") + step * F.col("_i")))).alias("_n"))
        at = at.groupBy(*group, "_total", "_lo", "_hi").agg(F.count_if(F.col("_n") > F.col("_total")).alias("_k"))
        bounds = written(at.select(*group, "_total", (F.col("_lo") + step * F.col("_k")).alias("_lo"),
                                   (F.col("_lo") + step * (F.col("_k") + 1)).alias("_hi")), "mix-bounds")
    at = base.join(bounds, group)
    at = written(at.withColumn("_held", held(F.col("_ideal") * F.col("_hi")))
                 .withColumn("_more", held(F.col("_ideal") * F.col("_lo")) > F.col("_held")), "mix-held")
    rest = at.groupBy(*group).agg((F.max("_total") - F.sum("_held")).alias("_rest"))
    tied = at.filter("_more").select(*group, *[c for c in key if c not in group], (F.col(votes) / (2 * F.col("_held") + 1)).alias("_q"))
    tied = tied.join(rest, group)
    order = Window.partitionBy(*group).orderBy(F.desc("_q"), *key)
    won = (tied.withColumn("_place", F.row_number().over(order)).filter("_place <= _rest")
           .select(*group, *[c for c in key if c not in group], F.lit(1).alias("_won")))
    on = list(dict.fromkeys([*group, *key]))
    return at.join(won, on, "left").select(*parts.columns, (F.col("_held") + F.coalesce("_won", F.lit(0))).cast("long").alias("quota"))


def mix(docs: DataFrame, seed: int = 17, weights: tuple[int, ...] = (1, 2, 3), blocks: int = BLOCKS,
        shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Per row of docs: doc_id, source, size, source_size, target, taken.

    ``taken`` counts the words the mix takes of the document, repeats counted:
    ``taken div size`` whole copies, then its first ``taken mod size`` words.
    """
    sized = written(docs.select("doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size"))
                    .withColumn("_source", _key(F.col("source"))), "mix-sizes")
    sources = ranked(sized.groupBy("_source", "source").agg(F.sum("size").alias("source_size"),
                                                            F.count(F.lit(1)).alias("_docs")))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = written(targets(sources.withColumn("weight", weight)), "mix-targets")
    s = sources.agg(F.sum("source_size").alias("total"), F.min(F.when(F.col("target") > 0, F.col("target"))).alias("least"),
                    F.sum(F.ceil(F.col("_docs") / shard_docs)).alias("shards")).first()
    total = s["total"] or 0
    block = max(1, min(-(-total // blocks), total // (PART_BLOCKS * (s["shards"] or 1)), int(s["least"] or 0) // PART_BLOCKS))
    sources = written(sources.withColumns({"_corpus": F.lit(0), "_seats": F.lit(total // block)}), "mix-seats")
    sources = apportion(sources, ["_corpus"], "target", "_seats", ["_source"])
    sources = written(sources.withColumn("_shards", F.ceil(F.col("_docs") / shard_docs)), "mix-quotas")

    order = F.xxhash64("doc_id", F.lit(seed))
    dealt = sized.join(sources.select("_source", "_shards"), "_source").withColumn("_order", order)
    dealt = written(dealt.withColumn("_shard", F.pmod(order, "_shards")).drop("_shards"), "mix-dealt")
    shards = dealt.groupBy("_source", "_shard").agg(F.sum("size").alias("shard_size"))
    shards = shards.join(sources.select("_source", "source_size", "target", F.col("quota").alias("source_quota")), "_source")
    shards = apportion(shards, ["_source"], "shard_size", "source_quota", ["_source", "_shard"])
    take = F.least(F.col("quota") * block, F.col("shard_size") * MAX_EPOCHS)
    shards = shards.withColumn("_rounds", F.when(F.col("shard_size") > 0, F.floor(take / F.col("shard_size"))).otherwise(0))
    shards = shards.withColumn("_rest", take - F.col("_rounds") * F.col("shard_size"))

    ahead = (Window.partitionBy("_source", "_shard").orderBy("_order", "doc_id", "size")
             .rowsBetween(Window.unboundedPreceding, -1))
    placed = dealt.withColumn("_before", F.coalesce(F.sum("size").over(ahead), F.lit(0)))
    cut = F.greatest(F.lit(0), F.least("size", F.col("_rest") - F.col("_before")))
    return (placed.join(shards.drop("quota", "source_quota"), ["_source", "_shard"])
            .select("doc_id", "source", "size", "source_size", "target",
                    (F.col("_rounds") * F.col("size") + cut).cast("long").alias("taken")))


@F.pandas_udf(StringType())
def first_words(texts: pd.Series, n: pd.Series) -> pd.Series:
    """The text up to the end of its n-th word, white space kept."""
    def cut(text: str, k: int) -> str:
        last = next(islice(re.finditer(r"[^\x20\x09-\x0D]+", text), k - 1, None), None) if k else None
        return text[:last.end()] if last else ""

    return pd.Series([cut(t or "", int(k)) for t, k in zip(texts, n, strict=True)], dtype=object)


def mixed(docs: DataFrame, seed: int = 17) -> DataFrame:
    """The documents of the mix, with the columns of docs: each whole copy a
    row, and the taken part of one more copy a row that ends after that word.
    A row without a taken word goes. Equal rows (doc_id and text) give the
    copies of all of them, with the other columns of one. Rows are told apart
    by two 64-bit hashes of id and text."""
    names = [f"_column_{k}" for k in range(len(docs.columns))]
    doc_id, text, source = (names[docs.columns.index(c)] for c in ("doc_id", "text", "source"))
    row = docs.toDF(*names).withColumn("_row", F.struct(F.xxhash64(doc_id, text), F.xxhash64(F.lit("mix"), text, doc_id)))
    plan = mix(row.select(F.col("_row").alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source")), seed).filter("taken > 0")
    plan = plan.groupBy(F.col("doc_id").alias("_row")).agg(F.sum("taken").alias("_taken"), F.max("size").alias("_size"))
    j = row.dropDuplicates(["_row"]).join(plan, "_row")
    whole, part = F.floor(F.col("_taken") / F.col("_size")).cast("int"), F.col("_taken") % F.col("_size")
    texts = F.concat(F.array_repeat(text, whole),
                     F.when(part > 0, F.array(first_words(text, part))).otherwise(F.array().cast("array<string>")))
    out = j.select(*[n for n in names if n != text], F.explode(texts).alias(text))
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
