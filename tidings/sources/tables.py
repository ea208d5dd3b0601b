"""Small-table writers: full replacement with checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def replace_table(spark: SparkSession, new: DataFrame, path: str, key: str) -> DataFrame:
    """Overwrite the table at ``path`` with ``new`` after checking that
    keys are unique and names are non-empty (F7); returns the stored table."""
    bad = new.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count()
    empty = new.filter(F.col("name").isNull() | (F.trim("name") == "")).limit(1).count()
    if bad or empty:
        raise ValueError("user table rejected: duplicate ids or empty names")
    new.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
