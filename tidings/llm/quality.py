"""Quality classifier: a sparse ensemble of rules.

Statistics of every whole text are Spark columns. A random forest is grown on
labelled rows; each path from a root to a node is a rule, a conjunction of
thresholds on statistics. A lasso logistic regression over the rules leaves few
with a weight other than 0. Those are compiled into one Spark column
expression, so scoring is a projection next to the scan.

Labels are learned from at most ``SAMPLE`` labelled documents, those with the
least hash of their id; ``statistics`` of other documents are not computed for
training. The id, labels, language and source are no inputs of a score.

Defined cases: a null text counts as empty and gets a score; a document with
several labels counts with the lowest; without labels of both classes the score
is the share of label 1 in the n rows, (n1 + 1) / (n + 2), everywhere; rows with one doc_id are
scored one by one; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, words_of, written

SAMPLE = 20_000
TREES, DEPTH = 24, 3
LASSO = 0.0005
THRESHOLD = 0.3
STATISTICS = ("log_words", "word_length", "symbols", "exclamations", "bars", "capitals", "digits", "distinct_words",
              "duplicate_lines")

Rule = tuple[tuple[str, bool, float], ...]     # (statistic, above, threshold) ...


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns, and the statistics of each row's text."""
    names = [F.col(k).alias(f"_keep_{k}") for k in keep]
    d = docs.select(*names, F.coalesce(F.col("text"), F.lit("")).alias("_text")).withColumn("_words", words_of(F.col("_text")))
    d = d.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != ""))
    n = F.greatest(F.size("_words"), F.lit(1)).cast("double")
    size = F.length("_text")
    chars = F.greatest(size, F.lit(1)).cast("double")

    def count(of: str) -> Column:
        return size - F.length(F.translate("_text", of, ""))

    def single(of: str) -> Column:
        return size - F.length(F.replace(F.col("_text"), F.lit(of), F.lit("")))

    columns = (F.log1p(F.size("_words")), F.length(F.array_join("_words", "")) / n, count("#*$%&|<>") / n, single("!") / n,
               single("|") / n, count("ABCDEFGHIJKLMNOPQRSTUVWXYZ") / chars, count("0123456789") / chars,
               F.size(F.array_distinct("_words")) / n,
               1 - F.size(F.array_distinct("_lines")) / F.greatest(F.size("_lines"), F.lit(1)))
    return d.select(*[F.col(f"_keep_{k}").alias(k) for k in keep],
                    *[c.cast("double").alias(s) for c, s in zip(columns, STATISTICS, strict=True)])


def paths(tree) -> list[Rule]:
    """The rules of a fitted tree: the path to every node below the root."""
    found: list[Rule] = []

    def walk(node, path: Rule) -> None:
        if path:
            found.append(path)
        if node.numDescendants():
            name, at = STATISTICS[node.split().featureIndex()], node.split().threshold()
            walk(node.leftChild(), (*path, (name, False, at)))
            walk(node.rightChild(), (*path, (name, True, at)))

    walk(tree._call_java("rootNode"), ())
    return found


def holds(rule: Rule) -> Column:
    """A rule as a condition over the statistics."""
    return reduce(Column.__and__, [F.col(s) > t if above else F.col(s) <= t for s, above, t in rule])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Column:
    """Learns from the rows of ``labels`` (doc_id, label); gives the score as
    a column over ``statistics``."""
    marked = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(
        F.min(label).cast("double").alias("_label"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)     # at most ``sample`` rows of 16 bytes
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = written(statistics(rows, "_label"), "quality-sample")
    classes = {r["_label"]: r["count"] for r in rows.groupBy("_label").count().collect()}
    total, ones = sum(classes.values()), classes.get(1.0, 0)
    if not 0 < ones < total:
        return F.lit((ones + 1) / (total + 2))

    rows = VectorAssembler(inputCols=list(STATISTICS), outputCol="_x").transform(rows)
    forest = RandomForestClassifier(featuresCol="_x", labelCol="_label", numTrees=TREES, maxDepth=DEPTH, seed=11,
                                    featureSubsetStrategy="3").fit(rows)
    rules = sorted({r for t in forest.trees for r in paths(t)})
    if not rules:
        return F.lit((ones + 1) / (total + 2))
    fired = rows.select("_label", F.array(*[holds(r).cast("double") for r in rules]).alias("_fired"))
    fired = written(fired, "quality-rules").select("_label", array_to_vector("_fired").alias("_rules"))
    lasso = LogisticRegression(featuresCol="_rules", labelCol="_label", elasticNetParam=1.0, regParam=LASSO, maxIter=60,
                               standardization=False).fit(fired)
    logit: Column = F.lit(float(lasso.intercept))
    for rule, weight in zip(rules, lasso.coefficients.toArray().tolist(), strict=True):
        if weight:
            logit = logit + F.when(holds(rule), F.lit(weight)).otherwise(0.0)
    return 1 / (1 + F.exp(-logit))


def scored(docs: DataFrame, score: Column, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of docs: doc_id, score, predicted."""
    s = statistics(docs, "doc_id").select("doc_id", score.cast("double").alias("score"))
    return s.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def accepted(docs: DataFrame, score: Column, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns as they are, that score the threshold or more."""
    names = [f"_column_{k}" for k in range(len(docs.columns))]
    own = docs.toDF(*names)
    s = statistics(own.withColumnRenamed(names[docs.columns.index("text")], "text"), *[
        "text" if c == "text" else n for c, n in zip(docs.columns, names, strict=True)])
    # generated, so that the filter is not pushed below and each statistic computed for every rule
    kept = s.withColumn("_score", F.explode(F.array(score.cast("double")))).filter(F.col("_score") >= threshold)
    return kept.select(*["text" if c == "text" else F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])
