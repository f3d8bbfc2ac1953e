"""Pattern rules by an index on runs of characters: a rule table of any size, judged by joins.

A text that matches a pattern holds every run of characters of the pattern's fixed parts. Of each pattern the run that
the fewest texts hold becomes its anchor. Texts meet the patterns whose anchor they hold, those pairs are verified, and the
best rule of each text is kept. Runs meet as 64-bit hashes, and a bitmap of a bounded size keeps those of the texts that no
pattern has from leaving their task. Up to BROADCAST anchors go to the texts, which then never move, and a text whose best
candidate matches is done; more are joined. Time grows with the texts and with the pairs that are verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from buildlens import schemas
from buildlens.operators.joins import join_grouped
from buildlens.session import scratch_dir

#: Lengths of the runs, longest first. A pattern is found by the longest that its fixed parts have room for; one without
#: any fixed part has the empty run, which every text holds.
SIZES = (6, 5, 4, 3, 2, 1)
#: Bits that number a slot of the bitmap.
SLOT_BITS = 22
#: Characters that are hashed at a time.
WINDOW = 1 << 18
#: Anchors that are broadcast to the texts.
BROADCAST = 20_000
_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_ORDER = ["priority", "error_pattern", "category", "assigned_team", "recommended_fix"]


def runs(text: Column, size: int) -> Column:
    """All distinct runs of ``size`` characters, and the shorter ones at the end, found in one pass over the text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{size}}}))"), F.lit(1)))


def fixed_parts(pattern: Column) -> Column:
    """What stands between the wildcards of an ILIKE pattern; an escaped character parts, too."""
    return F.filter(F.split(pattern, r"\\.|[%_]"), lambda part: part != "")


def pattern_runs(parts: Column) -> Column:
    """The distinct runs of the largest size that one of the parts has room for."""
    found = F.array(F.lit(""))
    for size in reversed(SIZES):
        every = F.array_distinct(F.flatten(F.transform(parts, lambda part: runs(part, size))))
        own = F.filter(every, lambda run: F.length(run) == size)
        found = F.when(F.size(own) > 0, own).otherwise(found)
    return found


def pieces(pattern: Column) -> Column:
    """What a pattern asks for: ``any``, one piece anywhere; ``head``, ``inner`` and ``tail``, pieces in this order, the
    first and the last at the ends of the text; ``whole``, the text itself; ``like``, what only LIKE can tell."""
    split = F.split(pattern, "%")
    some = F.filter(F.slice(split, F.lit(2), F.greatest(F.size(split) - 2, F.lit(0))), lambda piece: piece != "")
    head, tail = F.get(split, F.lit(0)), F.element_at(split, -1)
    like, whole = pattern.rlike(r"[_\\]"), F.size(split) == 1
    alone = ~like & ~whole & (head == "") & (tail == "") & (F.size(some) == 1)
    return F.struct(
        F.when(alone, F.get(some, F.lit(0))).alias("any"),
        F.when(whole, pattern).alias("whole"),
        F.when(like, pattern).alias("like"),
        head.alias("head"),
        some.alias("inner"),
        tail.alias("tail"),
    )


def matches(text: Column, asked: str) -> Column:
    """``text LIKE pattern`` for a column of ``pieces``: linear searches, each piece after the one before."""

    def after(place: Column, piece: Column) -> Column:
        # 0 once a piece was not found
        found = F.call_function("locate", piece, text, place)
        return F.when((place > 0) & (found > 0), found + F.length(piece)).otherwise(0)

    head, tail = F.col(f"{asked}.head"), F.col(f"{asked}.tail")
    end = F.aggregate(F.col(f"{asked}.inner"), F.length(head) + 1, after)
    return (
        F.when(F.col(f"{asked}.like").isNotNull(), F.call_function("like", text, F.col(f"{asked}.like")))
        .when(F.col(f"{asked}.whole").isNotNull(), text == F.col(f"{asked}.whole"))
        .when(F.col(f"{asked}.any").isNotNull(), text.contains(F.col(f"{asked}.any")))
        .when(~text.startswith(head) | ~text.endswith(tail), F.lit(False))
        .otherwise((end > 0) & (end + F.length(tail) <= F.length(text) + 1))
    )


@dataclass
class Wanted:
    """What a text's run must have to be kept: one of the sizes, and its hash a slot that is set."""

    sizes: list[int]
    slots: np.ndarray


def _hashes(points: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """The 64-bit hashes of all runs of each size, by where they start in the code points."""
    points = points.astype(np.uint64) + np.uint64(1)
    found = np.zeros(len(points) + 1, np.uint64)
    for size in range(max(sizes, default=-1) + 1):
        if size:
            found = found[:-1] * _FACTOR + points[size - 1 :] if len(found) > 1 else found[:0]
            found ^= found >> np.uint64(29)
        if size in sizes:
            mixed = (found + np.uint64(size)) * _MIX
            yield size, mixed ^ (mixed >> np.uint64(32))


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes * _FACTOR >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def run_key(run: Column) -> Column:
    """The hash of a run as a whole."""

    def keys(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            own = [next(_hashes(x, [len(x)]))[1][0] for x in map(_points, batch.to_pylist())]
            yield pa.array(np.array(own, np.uint64).view(np.int64))

    keys.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(keys, "long")(run)


def wanted(runs_: DataFrame) -> Wanted:
    """What to look for in texts to find the runs (_run, _key). The driver gets no more than the slots of the bitmap."""
    sizes = [r[0] for r in runs_.select(F.length("_run")).distinct().collect()]

    def slots(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(_slots(batch.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)), pa.int32())

    slots.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    found = runs_.select(arrow_udf(slots, "int")(F.col("_key")).alias("slot")).distinct().toPandas()
    bitmap = np.zeros(1 << SLOT_BITS, bool)
    bitmap[found["slot"].to_numpy(np.int64)] = True
    return Wanted(sorted(sizes), np.packbits(bitmap))


def _held(texts: list[str], wanted: Wanted, bitmap: np.ndarray) -> list[np.ndarray]:
    """The hashes of each text's distinct runs that may be wanted, sorted."""
    overlap = max(wanted.sizes, default=0)

    def own(points: np.ndarray) -> Iterator[np.ndarray]:
        # the last runs of a window start where the next one does
        for start in range(0, max(len(points), 1), WINDOW):
            for _, hashes in _hashes(points[start : start + WINDOW + overlap], wanted.sizes):
                yield hashes[bitmap[_slots(hashes)]]

    return [np.unique(np.concatenate([np.zeros(0, np.uint64), *own(_points(x))])) for x in texts]


def _lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
    values = np.concatenate([np.zeros(0, np.int64), *[x.view(np.int64) for x in found]])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def text_runs(text: Column, wanted: Wanted) -> Column:
    """The hashes of a text's distinct runs that are wanted, and of some others that share a slot with these."""

    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bitmap = np.unpackbits(wanted.slots).view(bool)
        for batch in batches:
            yield _lists(_held(batch.to_pylist(), wanted, bitmap))

    found.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(found, "array<long>")(text)


def candidates(text: Column, few: pd.DataFrame) -> Column:
    """The ranks of all rules whose anchor a text holds, best first. ``few`` has each rule's ``size``, ``_key``, ``_rank``."""
    few = few.sort_values(["_key", "_rank"])
    keys, ranks = few["_key"].to_numpy(np.int64), few["_rank"].to_numpy(np.int64)
    bitmap = np.zeros(1 << SLOT_BITS, bool)
    bitmap[_slots(keys.view(np.uint64))] = True
    asked = Wanted(sorted(map(int, few["size"].unique())), np.packbits(bitmap))

    def ranked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bitmap = np.unpackbits(asked.slots).view(bool)

        def own(held: np.ndarray) -> np.ndarray:
            # rules that share an anchor stand side by side
            first, last = (np.searchsorted(keys, held.view(np.int64), side) for side in ("left", "right"))
            return np.sort(np.concatenate([np.zeros(0, np.int64), *[ranks[a:b] for a, b in zip(first, last) if a < b]]))

        for batch in batches:
            yield _lists([own(held) for held in _held(batch.to_pylist(), asked, bitmap)])

    ranked.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # Spark would run it once more for each filter that it moves before it
    return arrow_udf(ranked, "array<long>").asNondeterministic()(text)


def tried(texts: DataFrame, rules: DataFrame, few: pd.DataFrame) -> DataFrame:
    """Texts with the rules left to verify: the best candidate alone, ``_sure``, if it matches, or else all the others."""
    rules = F.broadcast(rules.select("_rank", "_asked"))
    held = texts.select("_digest", "_lowered", candidates(F.col("_lowered"), few).alias("_ranks"))
    best = held.withColumn("_rank", F.get("_ranks", F.lit(0))).join(rules, "_rank")
    judged = best.withColumn("_sure", F.coalesce(matches(F.col("_lowered"), "_asked"), F.lit(False)))
    others = F.slice("_ranks", F.lit(2), F.size("_ranks"))
    left = F.explode(F.when(F.col("_sure"), F.array("_rank")).otherwise(others)).alias("_rank")
    return judged.select("_digest", "_lowered", "_sure", left).join(rules, "_rank")


def anchors(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """Each pattern with the run of it that the fewest texts hold, and its hash; of equally rare ones the first."""
    base = scratch_dir(texts.sparkSession, "runs")
    own = patterns.select("_pattern", F.explode(pattern_runs(fixed_parts(F.col("_pattern")))).alias("_run"))
    own = own.withColumn("_key", run_key(F.col("_run")))
    own.write.parquet(base)
    own = texts.sparkSession.read.schema(own.schema).parquet(base)
    # counted per task before the shuffle, whatever the number of texts
    every = texts.select(F.explode(text_runs(F.col("_lowered"), wanted(own))).alias("_key"))
    counted = own.join(every.groupBy("_key").agg(F.count("*").alias("_texts")), "_key", "left")
    # a run that no text holds shows that its pattern matches nothing
    rarest = F.min(F.struct(F.coalesce("_texts", F.lit(0)).alias("texts"), F.col("_run").alias("run"), "_key")).alias("_anchor")
    kept = counted.groupBy("_pattern").agg(rarest).filter(F.col("_anchor.texts") > 0)
    return kept.select("_pattern", F.col("_anchor.run").alias("_run"), F.col("_anchor._key").alias("_key"))


def classify_by_pattern_index(logs: DataFrame, rules: DataFrame, text: str) -> DataFrame:
    """``classify_by_rule_table`` for rule tables of any size: the same columns and the same rows.

    Equal texts are judged once; NULL texts, and texts that no rule matches, get NULLs. Rules without a pattern fire
    nowhere, those without a priority come last, equal ones count once. The distinct texts, the rules and the anchors
    are written to the session's scratch folder: the logs are read twice, and Spark knows the sizes when it chooses a join.
    """
    spark = logs.sparkSession
    base = scratch_dir(spark, "patterns")
    fields = schemas.RULE_TABLE_SCHEMA.fieldNames()
    # the digest of the lowered text is its key: logs may have no key or repeat it
    lowered = F.lower(F.col(text))
    digest = F.unhex(F.sha2(lowered, 256))
    distinct = logs.filter(F.col(text).isNotNull()).groupBy(digest.alias("_digest")).agg(F.first(lowered).alias("_lowered"))
    distinct.write.parquet(f"{base}/texts")
    texts = spark.read.parquet(f"{base}/texts")
    last = F.struct(F.col("priority").isNull().alias("_none"), *[F.col(n) for n in _ORDER]).alias("_rule")
    # patterns that differ in case alone match the same texts: only the best of them can win
    best = (
        rules.select(*fields).dropna(subset=["error_pattern"])
        .groupBy(F.lower("error_pattern").alias("_pattern"))
        .agg(F.min(last).alias("_rule"))
        .withColumn("_asked", pieces(F.col("_pattern")))
    )
    # numbered in their order, so that the best of a text is a minimum of numbers
    best.orderBy("_rule").withColumn("_rank", F.monotonically_increasing_id()).write.parquet(f"{base}/rules")
    patterns = spark.read.parquet(f"{base}/rules")
    found = anchors(texts, patterns).join(patterns.drop("_rule"), "_pattern")
    found.select("_run", "_key", "_asked", "_rank").write.parquet(f"{base}/anchors")
    anchored = spark.read.parquet(f"{base}/anchors")

    few = anchored.select(F.length("_run").alias("size"), "_key", "_rank").limit(BROADCAST + 1).toPandas()
    if len(few) <= BROADCAST:
        verified = tried(texts, anchored, few).filter(F.col("_sure") | matches(F.col("_lowered"), "_asked"))
    else:
        keys = F.explode(text_runs(F.col("_lowered"), wanted(anchored))).alias("_key")
        held = join_grouped(texts.select("_digest", keys), anchored, ["_key"]).select("_digest", "_asked", "_rank")
        verified = texts.join(held, "_digest").filter(matches(F.col("_lowered"), "_asked"))
    won = verified.groupBy("_digest").agg(F.min("_rank").alias("_rank")).join(patterns.select("_rank", "_rule"), "_rank")
    answers = join_grouped(logs.withColumn("_digest", digest), won, ["_digest"], "left")
    return answers.select(*logs.columns, *[F.col(f"_rule.{n}").alias(n) for n in fields])
