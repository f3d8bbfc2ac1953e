"""Mixing sources to target weights by repeating documents.

Per source the words are summed; weights are turned into targets in words, bounded by the repetition allowed; the rate of
a source is its target over its size. Every document is taken floor(rate) times, and once more if a draw seeded by its
hash falls below the fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buildlens.llm.common import WORD, written

#: Weights of the sources in their order, repeating.
WEIGHTS = (3, 1, 2)
#: Share of all words that the mix holds, in percent, and times that a document may be taken at most.
SHARE, MOST_TIMES = 150, 2
#: Seeds tried for each source; the one whose draws come nearest the target is taken.
SEEDS = 32


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _draw(seed: Column) -> Column:
    """Uniform in [0, 1), the same in every run: it depends on the document and the seed alone."""
    return F.pmod(F.xxhash64("id", "source", "size", seed), F.lit(1 << 40)) / float(1 << 40)


def targets(sizes: DataFrame) -> DataFrame:
    """source, size -> also target, for one row per source.

    The words are shared by weight; a target stops at MOST_TIMES the source's size, and the excess is shared again. So
    target = min(MOST_TIMES * size, level * weight), and the level follows from running sums over the sources in order
    of MOST_TIMES * size / weight. The windows have no partition: their rows are the sources, not the documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy(F.col("size") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = by_level.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.array(*map(F.lit, WEIGHTS))[(F.row_number().over(order) - 1) % len(WEIGHTS)]
    return (
        sizes.withColumn("weight", weight.cast("long"))
        .withColumn("all_words", F.sum("size").over(everything))
        .withColumn("full_words", F.coalesce(F.sum("size").over(so_far), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(so_far), F.lit(0)))
        # if the sources before this one are full, the others share what is left
        .withColumn("left", F.col("all_words") * SHARE / 100.0 - F.col("full_words") * MOST_TIMES)
        .withColumn("is_open", F.col("left") * F.col("weight") <= F.col("size") * MOST_TIMES * F.col("open_weight"))
        .withColumn("first", F.min(F.when(F.col("is_open"), F.struct("full_words", "left", "open_weight"))).over(everything))
        .select(
            "source",
            "size",
            F.least(
                (F.col("size") * MOST_TIMES).cast("double"),
                F.coalesce(F.col("first.left") * F.col("weight") / F.col("first.open_weight"), F.lit(float("inf"))),
            ).alias("target"),
        )
    )


def _sized(documents: DataFrame, id: str, text: str, source: str) -> DataFrame:
    return documents.select(
        F.col(id).alias("id"),
        F.col(source).alias("source"),
        words(F.col(text)).alias("size"),
        F.struct(*documents.columns).alias("row"),
    )


def rates(sized: DataFrame) -> DataFrame:
    """name, source_size, target, rate, seed: a row for each source; the table is written, so its size is known."""
    sized = written(sized.select("id", "source", "size"), "mix-sizes")
    mixed = targets(sized.groupBy("source").agg(F.sum("size").alias("size"))).select(
        F.col("source").alias("name"),
        F.col("size").alias("source_size"),
        "target",
        F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(F.lit(0.0)).alias("rate"),
    )
    mixed = written(mixed, "mix-targets")
    # a draw is uniform for every seed; of the totals that the seeds give, the one nearest the target is kept
    fraction = F.col("rate") - F.floor("rate")
    drawn = [F.sum(F.when(_draw(F.lit(k)) < fraction, F.col("size")).otherwise(0)).alias(f"drawn{k}") for k in range(SEEDS)]
    whole = F.col("source_size") * F.floor("rate") - F.col("target")
    off = [F.struct(F.abs(whole + F.col(f"drawn{k}")).alias("off"), F.lit(k).alias("seed")) for k in range(SEEDS)]
    seeds = (
        sized.join(mixed, F.col("source").eqNullSafe(F.col("name")))
        .groupBy("name", "source_size", "target", "rate")
        .agg(*drawn)
        .select("name", "source_size", "target", "rate", F.array_min(F.array(*off))["seed"].alias("seed"))
    )
    return written(seeds, "mix-rates")


def plan(documents: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """id, source, size, row, source_size, target, times: how often each row is taken, 0 to MOST_TIMES.

    ``row`` holds the row's columns, whatever their names. A null text has no words; rows without words are as often
    taken as others but count for nothing. Null is a source, the last one. Equal rows are taken alike. An empty table
    gives an empty plan. The rates are joined by the source: Spark broadcasts their table if its written size is small,
    and else splits the rows of a frequent source.
    """
    sized = _sized(documents, id, text, source)
    found = rates(sized)
    fraction = F.col("rate") - F.floor("rate")
    times = F.floor("rate").cast("long") + (_draw(F.col("seed")) < fraction).cast("long")
    return sized.join(found, F.col("source").eqNullSafe(F.col("name"))).select(
        "id", "source", "size", "row", "source_size", "target", times.alias("times")
    )


def mix(documents: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``documents``, each as often as the plan takes it."""
    copies = F.explode(F.when(F.col("times") > 0, F.sequence(F.lit(1), F.col("times").cast("int"))))
    return plan(documents, id, text, source).select("row", copies.alias("copy")).select("row.*")


def taken(documents: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of ``documents``."""
    return plan(documents).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")
    )
