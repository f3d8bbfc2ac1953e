"""Exact percentiles against Spark's own, which holds all distinct values of a group in memory."""

from conftest import rows
from pyspark.sql import functions as F

from buildlens.plans import gold


def test_percentiles_are_exact(spark):
    wide = spark.range(400_000).select(F.lit("wide").alias("w"), (F.col("id") * 7919 % 1_000_003 - 5000).alias("s"))
    hot = spark.range(100_000).select(F.lit("hot").alias("w"), F.when(F.col("id") % 10 > 0, 3).otherwise(F.col("id")).alias("s"))
    few = spark.createDataFrame([("one", 5), ("two", 1), ("two", 10_000), (None, 1), (None, 2), (None, 9000), ("none", None)], "w string, s bigint")
    steps = wide.union(hot).union(few).select(F.col("w").alias("workflow_name"), F.col("s").alias("step_duration_seconds"))
    exact = steps.filter("step_duration_seconds IS NOT NULL").groupBy("workflow_name").agg(
        F.count("*"), F.min("step_duration_seconds"), F.max("step_duration_seconds"), F.round(F.avg("step_duration_seconds"), 6),
        *[F.round(F.percentile("step_duration_seconds", p), 6) for p in (0.5, 0.9, 0.99)],
    )
    found = gold.step_duration_stats(steps)
    assert sorted(rows(found), key=str) == sorted(rows(exact), key=str)
    assert "percentile" not in found._jdf.queryExecution().toString()
    assert gold.step_duration_stats(steps.limit(0)).count() == 0
