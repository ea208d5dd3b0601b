"""Plan helpers: distributed exact rank."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidings.operators.sizing import bucket_offsets, rank_within


def test_rank_within_equals_row_number(spark):
    # one hot partition key holding most rows, spread over many buckets
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 3).cast("string"))).alias("p"),
        (F.col("id") * 7919 % 100003).alias("o"))
    got = rank_within(df, ["p"], "o", bucket_width=64, name="r")
    ref = df.withColumn("r", F.row_number().over(Window.partitionBy("p").orderBy("o")))
    assert got.exceptAll(ref.select(*got.columns)).count() == 0
    assert got.count() == ref.count() == 5000


def test_rank_within_chosen_buckets(spark):
    df = spark.range(0, 1000).select(F.lit("p").alias("p"), F.col("id").alias("o"))
    kept = bucket_offsets(df, ["p"], "o", bucket_width=64).filter("_offset < 100").withColumn("extra", F.lit(7))
    got = rank_within(df, ["p"], "o", bucket_width=64, name="r", offsets=kept).orderBy("o").collect()
    assert [(r.o, r.r, r.extra) for r in got] == [(k, k + 1, 7) for k in range(128)]
