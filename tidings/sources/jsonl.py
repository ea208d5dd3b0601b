"""JSON lines with comments (blank lines, '//' and '#' lines skipped)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PROVIDER_SCHEMA = T.StructType([T.StructField("domain", T.StringType()),
                                T.StructField("provider_name", T.StringType()),
                                T.StructField("country", T.StringType())])


def read_commented_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    lines = spark.read.text(path).select(F.trim("value").alias("line"))
    keep = (F.length("line") > 0) & ~F.col("line").startswith("//") & ~F.col("line").startswith("#")
    return lines.filter(keep).select(F.from_json("line", schema).alias("r")).select("r.*")
