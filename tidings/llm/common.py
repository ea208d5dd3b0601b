"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, settings, shuffles_dropped  # noqa: F401

WHITE = " \t\n\x0b\f\r"          # \x20 and \x09-\x0D
WHITE_RUN = "[ \\x09-\\x0D]+"    # the same as a Java regular expression


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; null: none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WHITE_RUN))


def bucket_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; the id null counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder and read again: lineage
    ends here, and what is read more than once is computed once. The write's
    shuffle files go when it ends, not when the driver next collects garbage,
    so the disk holds those of one write at a time."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
