"""Pluggable batch functions: embeddings (U1), summaries (U2), the summary
contract check (U3) and processing cost (A8).

Caller-supplied functions run in ``mapInPandas`` (Arrow batches, one call
per batch, never per row). The defaults are hashed TF-IDF for embeddings (tokens
counted in Arrow batches) and string expressions for summaries.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import (MEDIUM_MAX_WORDS, MEDIUM_MIN_WORDS, SHORT_MAX_SENTENCES, TITLE_MAX_WORDS,
                         TITLE_MIN_WORDS)
from ..functions import summaries as SM
from ..functions.text import token_count
from ..sources.stores import staged

KNOWN_TOKENS = 500_000     # tokens whose feature a task keeps

EmbedFn = Callable[[list[str]], list[list[float]]]
SummariseFn = Callable[[pd.DataFrame], pd.DataFrame]


def _token_counts(docs: DataFrame, key: str, text: str, num_features: int) -> DataFrame:
    """Per row: the key, its text's features in order (``_f``) and how often each stands there (``_n``)."""
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("_f", T.ArrayType(T.IntegerType())),
                           T.StructField("_n", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for b in batches:
            features, counts, ends = [], [], [0]
            for t in b.column("_text").to_pylist():
                n: dict[int, int] = {}
                for token, k in Counter(re.findall("[a-z0-9]+", t)).items():
                    f = known.get(token)
                    if f is None:
                        f = known[token] = int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % num_features
                    n[f] = n.get(f, 0) + k
                found = sorted(n)
                features += found
                counts += map(n.__getitem__, found)
                ends.append(len(features))
                if len(known) > KNOWN_TOKENS:
                    known.clear()
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(key), pa.ListArray.from_arrays(at, pa.array(features, pa.int32())),
                                              pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))], [key, "_f", "_n"])

    return docs.select(key, F.lower(F.coalesce(text, F.lit(""))).alias("_text")).mapInArrow(run, schema)


def once_each(value: Column | str, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row: what a lambda takes from
    outside, Spark puts into it and computes again for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def embed_default(docs: DataFrame, key: str, text: str = "doc", num_features: int = 1 << 12) -> DataFrame:
    """U1 default: hashed TF-IDF with L2 norm as sparse vectors (key, indices,
    values): lower-case ASCII word tokens, feature = md5 prefix modulo
    ``num_features``, idf = ln((n + 1) / (df + 1)). Rows of one key are one
    document, whose vector each of them gets; rows without a key count in n and
    df (as one document) and have an empty vector, as has a document without
    tokens or whose tokens all stand in every document.

    Texts are read once, in tasks that count a row's tokens; the counts are
    stored, and only rows whose key comes several times are shuffled.
    """
    spark = docs.sparkSession
    counted = staged(_token_counts(docs, key, text, num_features), "token-counts")
    several = staged(counted.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1 OR _key IS NULL"), "token-keys")
    same = F.col(key).eqNullSafe(F.col("_key"))
    alone, others = counted.join(several, same, "left_anti"), counted.join(several, same, "left_semi")
    sums = others.select(key, F.explode(F.arrays_zip("_f", "_n")).alias("_t")).groupBy(key, F.col("_t._f").alias("_f")).agg(F.sum("_t._n").alias("_n"))
    sums = staged(sums, "token-sums")
    df = alone.select(F.explode("_f").alias("_f")).unionAll(sums.select("_f")).groupBy("_f").agg(F.count(F.lit(1)).alias("_df"))
    n_docs = counted.count()
    idf = [0.0] * num_features
    for r in df.collect():          # at most num_features numbers
        idf[r["_f"]] = math.log((n_docs + 1) / (r["_df"] + 1))
    idf = F.lit(idf)
    merged = sums.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.array_sort(F.collect_list(F.struct("_f", "_n"))).alias("_t"))
    merged = others.select(key).join(merged, F.col(key) == F.col("_key"), "left").select(
        key, F.coalesce("_t._f", F.array().cast("array<int>")).alias("_f"), F.coalesce("_t._n", F.array().cast("array<long>")).alias("_n"))
    w = alone.unionAll(merged).select(key, F.filter(F.zip_with("_f", "_n", lambda i, n: F.struct(i.alias("_f"), (n * F.get(idf, i)).alias("_w"))),
                                                    lambda x: x["_w"] != 0).alias("_v"))
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x["_w"] * x["_w"]))
    vector = once_each("_v", lambda v: once_each(norm(v), lambda n: F.struct(
        v["_f"].alias("indices"), F.transform(v, lambda x: x["_w"] / n).alias("values"))))
    return w.select(key, vector.alias("_s")).select(key, "_s.indices", "_s.values")


def dense_vector(indices: str, values: str, num_features: int) -> Column:
    """A sparse vector as an array of ``num_features`` numbers."""
    return once_each(F.map_from_arrays(indices, values), lambda by_feature: F.transform(
        F.sequence(F.lit(0), F.lit(num_features - 1)), lambda i: F.coalesce(F.try_element_at(by_feature, i), F.lit(0.0))))


def embed_with(docs: DataFrame, fn: EmbedFn, text: str = "doc") -> DataFrame:
    """U1 with a caller-supplied batch text -> vector function."""
    schema = T.StructType(docs.schema.fields + [T.StructField("embedding", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            vecs = fn(pdf[text].fillna("").tolist()) if len(pdf) else []
            if len(vecs) != len(pdf):
                raise ValueError("embedding function returned a different number of vectors")
            yield pdf.assign(embedding=[list(map(float, v)) for v in vecs])

    return docs.mapInPandas(run, schema)


def once(rows: DataFrame, inputs: list[str], call: Callable[[DataFrame], DataFrame], path: str) -> DataFrame:
    """The rows with what ``call`` gives for their inputs, from a table of
    results at ``path`` that only grows.

    ``call`` (such as ``embed_with``) gets the inputs of each distinct key once,
    with its columns added, and only those that the table does not have; what
    it gives is stored under the hash of the inputs. A second reader, a rerun or
    a lost executor that recomputes rows reads the table, so a paid function
    is not called again; only a task that dies before its own results are
    written has its calls repeated.
    """
    spark = rows.sparkSession
    key = F.sha2(F.to_json(F.struct(*inputs), {"ignoreNullFields": "false"}), 256)
    keyed = staged(rows.withColumn("_input", key), "once-rows")
    wanted = keyed.select("_input", *inputs).dropDuplicates(["_input"])
    results = call(wanted.limit(0)).drop(*inputs).schema
    try:
        known = spark.read.schema(results).parquet(path)
        wanted = wanted.join(known, "_input", "left_anti")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    call(wanted).drop(*inputs).write.mode("append").parquet(path)
    return keyed.join(spark.read.schema(results).parquet(path), "_input").drop("_input")


SUMMARY_FIELDS = ("title", "full_summary", "medium_summary", "short_summary")


def summarise_default(clusters: DataFrame) -> DataFrame:
    """U2 default: extractive title / full / medium / short per cluster.

    Input columns: ``titles`` and ``texts`` (arrays in member order).
    """
    full = SM.default_full(F.array_join("texts", "\n\n"))
    c = clusters.withColumn("full_summary", full)
    return (c.withColumn("title", SM.default_title(F.try_element_at(F.col("titles"), F.lit(1))))
            .withColumn("medium_summary", SM.default_medium(F.col("full_summary")))
            .withColumn("short_summary", SM.default_short(F.col("full_summary"))))


def summarise_with(clusters: DataFrame, fn: SummariseFn) -> DataFrame:
    """U2 with a caller-supplied batch function returning the four texts
    (and optionally ``cost``) for a pandas batch of clusters."""
    schema = T.StructType(clusters.schema.fields + [T.StructField(f, T.StringType()) for f in SUMMARY_FIELDS]
                          + [T.StructField("cost", T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            res = fn(pdf) if len(pdf) else pd.DataFrame(columns=list(SUMMARY_FIELDS))
            out = pdf.copy()
            for f in SUMMARY_FIELDS:
                out[f] = res[f].values if f in res else None
            out["cost"] = res["cost"].values if "cost" in res else 0.0
            yield out

    return clusters.mapInPandas(run, schema)


def words(c):
    return F.size(F.split(F.trim(c), r"\s+"))


def sentences(c):
    return F.size(F.regexp_extract_all(c, F.lit(SM.SENTENCE_PATTERN), 0))


def contract_violations(summaries: DataFrame, key: list[str]) -> DataFrame:
    """One row per broken rule of the summary contract."""
    full_empty = F.col("full_summary").isNull() | (F.length("full_summary") == 0)
    checks = [
        ("title_length", ~words(F.col("title")).between(TITLE_MIN_WORDS, TITLE_MAX_WORDS)),
        ("short_sentences", ~full_empty & (sentences(F.col("short_summary")) > SHORT_MAX_SENTENCES)),
        ("medium_length", ~full_empty & ~words(F.col("medium_summary")).between(MEDIUM_MIN_WORDS, MEDIUM_MAX_WORDS)),
        ("medium_without_full", full_empty),
        ("short_without_full", full_empty),
    ]
    arr = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in checks]))
    return summaries.select(*key, F.explode(arr).alias("violation"))


def processing_cost(summaries: DataFrame, key: list[str], usd_per_token: float,
                    prompt_cols: dict[str, str]) -> DataFrame:
    """Per article title + full + medium + short cost from token counts
    of each step's prompt and output."""
    total = None
    for step, (prompt, output) in prompt_cols.items():
        c = (token_count(F.col(prompt)) + F.coalesce(token_count(F.col(output)), F.lit(0))) * F.lit(usd_per_token)
        summaries = summaries.withColumn(f"{step}_cost", c)
        total = c if total is None else total + c
    return summaries.withColumn("article_processing_cost", total)
