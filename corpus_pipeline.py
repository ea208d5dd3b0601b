"""From raw documents to packed token rows, in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. ``run`` applies
them in order to the table ``documents``; every stage's result is written as
Parquet to the shared folder and read again as the documents of the next one.
All stages but the last return the columns of documents.

Defined cases (nulls, empty texts and tables, repeated rows, extra columns) are
those of the operators, stated in their modules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm import decontaminate, jaccard, mixing, packing, quality
from tidings.llm.common import read, written
from tidings.llm.queries import quality_score
from tidings.session import scratch_path

#: Near duplicates share 0.8 of their 5-word shingles (op3 has 0.9 of 3 words, by its contract). With 4 shingles
#: a block or fewer, 1 spare block for 8 differences keeps empty blocks from emitting keys.
SHINGLE = 5
SIZES = jaccard.Sizes(80, 100, share=1 / 8)

#: The tokenizer and the matching thresholds have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, quality_score(spark, sf_dir, docs))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of the n-gram Jaccard join, at 5 words and 0.8."""
    return jaccard.deduplicated(docs, SIZES, SHINGLE)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix: repeated, cut or left out as it takes them."""
    mix = mixing.mixed(docs)
    return mix.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in mix.columns else mix


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids, written as binary matrices and read back from them."""
    path = scratch_path(spark, "pipeline-matrices")
    return packing.read_matrices(packing.write_matrices(packing.pack(docs), path), path)


STAGES = [("quality", quality_stage), ("near_duplicates", near_duplicates_stage), ("decontamination", decontamination_stage),
          ("mixing", mixing_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
