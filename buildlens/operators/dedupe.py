"""Keep the first rows of each key under an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int, salts: int = 1) -> DataFrame:
    """The first ``k`` rows of every group.

    ``row_number() <= k`` lets Spark cut each group to ``k`` rows inside every map task, before the
    shuffle. With ``salts`` a hot group is first cut in that many parallel pieces, so that the last
    task sees ``salts * k`` rows of it however many map tasks there were.
    """
    if salts > 1:
        spread = F.pmod(F.spark_partition_id(), F.lit(salts))
        pieces = df.withColumn("_salt", spread)
        return top_per_group(_cut(pieces, [*group, "_salt"], order, k).drop("_salt"), group, order, k)
    return _cut(df, group, order, k)


def _cut(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column], salts: int = 1) -> DataFrame:
    """One row per key. ``order`` should end in tie-breakers that make it total."""
    return top_per_group(df, keys, order, 1, salts)
