"""Failure classification: ordered name rules, a log-pattern table, and a pluggable batch classifier."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from buildlens import schemas
from buildlens.functions import scalars
from buildlens.operators.joins import join_grouped

#: Rules that one expression may hold.
INLINE_RULES = 1000

RESULT_FIELDS = ["category", "assigned_team", "recommended_fix"]

Classifier = Callable[[pd.Series], pd.DataFrame]


def _first_rule(rules: tuple[schemas.NameRule, ...]) -> Column:
    number = None
    for position, rule in enumerate(rules):
        fires = F.lit(False)
        for column, token in rule.needles:
            fires = fires | F.col(f"_{column}").contains(token)
        number = F.when(fires, position) if number is None else number.when(fires, position)
    return number


def classify_by_names(
    failures: DataFrame, rules: tuple[schemas.NameRule, ...] = schemas.NAME_RULES
) -> DataFrame:
    """Add category, team, fix, source tag and priority from step, workflow and job names.

    The rule is found once per row and its outputs are looked up by number. The tag and the priority
    look at the step name alone, so a row can have a category and still be tagged unclassified.
    """
    names = sorted({column for rule in rules for column, _ in rule.needles} | {"step_name"})
    ruled = failures.withColumns({f"_{n}": scalars.folded(F.col(n)) for n in names})
    ruled = ruled.withColumn("_rule", _first_rule(rules))

    def output(field: str, fallback: str) -> Column:
        values = F.array(*[F.lit(getattr(r, field)) for r in rules])
        return F.coalesce(F.get(values, F.col("_rule")), F.lit(fallback))

    step = F.col("_step_name")
    tagged = F.lit(False)
    for token in schemas.STEP_TAG_TOKENS:
        tagged = tagged | step.contains(token)
    return ruled.select(
        *failures.columns,
        output("category", schemas.TAG_UNCLASSIFIED).alias("category"),
        output("assigned_team", schemas.UNMATCHED_TEAM).alias("assigned_team"),
        output("recommended_fix", schemas.UNMATCHED_FIX).alias("recommended_fix"),
        F.when(tagged, schemas.TAG_RULE).otherwise(schemas.TAG_UNCLASSIFIED).alias("classification_source"),
        F.when(step.contains(schemas.STEP_URGENT_TOKEN), 1).otherwise(2).alias("priority"),
    )


def like_pattern(text: Column, pattern: str) -> Column:
    """``text LIKE pattern``, with patterns of plain pieces between ``%`` found by linear searches.

    Spark turns one piece into a plain search by itself; more pieces would become a regular expression
    that backtracks over long texts.
    """
    pieces = pattern.split("%")
    inner = [p for p in pieces[1:-1] if p]
    if "_" in pattern or "\\" in pattern or len(inner) < 2 or pieces[0] or pieces[-1]:
        return text.like(pattern)
    # each piece is searched after the end of the one before, 0 meaning it was not found
    position = F.lit(1)
    for piece in inner:
        found = F.call_function("locate", F.lit(piece), text, position)
        position = F.when(found > 0, found + len(piece)).otherwise(F.lit(0))
    return position > 0


def classify_by_rule_table(logs: DataFrame, rules: DataFrame, text: str) -> DataFrame:
    """Best matching rule per log row: lowest priority number, then pattern, then the other fields. NULLs when none matches.

    Patterns are ILIKE patterns with ``\\`` as escape. The rules, which people write, are read to the driver, at most
    ``INLINE_RULES`` of them, and become one CASE expression tried in order of preference: the logs are only mapped over,
    and each row is judged by itself. More rules are refused; ``pattern_index`` takes any number.
    """
    fields = schemas.RULE_TABLE_SCHEMA.fieldNames()
    others = [n for n in fields if n not in ("priority", "error_pattern")]
    # a rule without a priority comes last
    ordered = rules.select(*fields).dropna(subset=["error_pattern"]).distinct()
    found = ordered.orderBy(F.col("priority").asc_nulls_last(), "error_pattern", *others).limit(INLINE_RULES + 1).collect()
    if len(found) > INLINE_RULES:
        raise ValueError(f"more than {INLINE_RULES} rules: use pattern_index.classify_by_pattern_index")
    if not found:
        return logs.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.RULE_TABLE_SCHEMA])
    # The lowered text is a column of its own, so that it is computed once for all patterns.
    lowered = logs.withColumn("_lowered", F.lower(F.col(text)))
    number = None
    for position, rule in enumerate(found):
        fires = like_pattern(F.col("_lowered"), rule.error_pattern.lower())
        number = F.when(fires, position) if number is None else number.when(fires, position)
    table = {n: F.array(*[F.lit(r[n]) for r in found]) for n in fields}
    ruled = lowered.withColumn("_rule", number)
    return ruled.select(*logs.columns, *[F.get(table[n], F.col("_rule")).alias(n) for n in fields])


def unclassified(failures: DataFrame) -> DataFrame:
    """The work list of the fallback classifier."""
    return failures.filter(F.col("classification_source") == schemas.TAG_UNCLASSIFIED)


def with_context(failures: DataFrame) -> DataFrame:
    context = scalars.failure_context(F.col("workflow_name"), F.col("step_name"), F.col("failure_reason"))
    return failures.withColumn("failure_context", context)


def retrying(
    classify: Classifier,
    is_quota_error: Callable[[Exception], bool],
    attempts: int = 5,
    delay: float = 15.0,
    sleep: Callable[[float], None] = time.sleep,
) -> Classifier:
    """Retry quota errors with a growing pause; raise any other error, or the lack of success."""

    def run(contexts: pd.Series) -> pd.DataFrame:
        for attempt in range(1, attempts + 1):
            try:
                return classify(contexts)
            except Exception as error:
                if not is_quota_error(error):
                    raise
                sleep(delay * attempt)
        raise RuntimeError(f"no classification after {attempts} attempts")

    return run


def classify_contexts(contexts: DataFrame, classify: Classifier, parallelism: int | None = None) -> DataFrame:
    """Run a batch classifier once per distinct context, on the executors.

    ``classify`` takes a Series of contexts and returns a frame with category, assigned_team and
    recommended_fix in the same order. An error fails the job.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = classify(batch["failure_context"])
            columns = {n: answers[n].to_numpy() for n in RESULT_FIELDS}
            yield pd.DataFrame({"failure_context": batch["failure_context"].to_numpy(), **columns})

    distinct = contexts.select("failure_context").distinct()
    if parallelism:
        # contexts are few and small, calls are slow: spread them wider than their size asks for
        distinct = distinct.repartition(parallelism, "failure_context")
    return distinct.mapInPandas(run, schemas.CLASSIFICATION_SCHEMA)


@dataclass(frozen=True)
class Quota:
    """What a classification service allows: calls a minute over all tasks, contexts a call, and which of its errors say
    that the quota is spent. The calls are divided among ``tasks``; each task makes ``calls`` of them in one wave."""

    calls_per_minute: float
    is_spent: Callable[[Exception], bool]
    contexts_per_call: int = 20
    tasks: int = 1
    calls: int = 5

    @property
    def pause(self) -> float:
        """Seconds before each call of a task."""
        return 60.0 * self.tasks / self.calls_per_minute

    @property
    def wave(self) -> int:
        return self.tasks * self.calls * self.contexts_per_call


def classify_wave(
    contexts: DataFrame, classify: Classifier, quota: Quota, sleep: Callable[[float], None] = time.sleep
) -> DataFrame:
    """Answers to distinct contexts, at most one wave of them, within a quota.

    A task that is told that the quota is spent asks no more and hands on the answers it has; the other contexts stay
    without one. Any other error fails the job.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            asked = batch["failure_context"]
            for at in range(0, len(asked), quota.contexts_per_call):
                part = asked[at : at + quota.contexts_per_call].reset_index(drop=True)
                sleep(quota.pause)
                try:
                    answers = classify(part)
                except Exception as error:
                    if not quota.is_spent(error):
                        raise
                    return
                columns = {n: answers[n].to_numpy() for n in RESULT_FIELDS}
                yield pd.DataFrame({"failure_context": part.to_numpy(), **columns})

    # dealt by turns, so that the tasks have about as many calls each
    dealt = contexts.select("failure_context").repartition(quota.tasks)
    return dealt.mapInPandas(run, schemas.CLASSIFICATION_SCHEMA)


def pending_contexts(failures: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Distinct contexts of unclassified rows that have no stored answer yet."""
    contexts = with_context(unclassified(failures)).select("failure_context").distinct()
    return contexts if known is None else contexts.join(known.select("failure_context"), "failure_context", "left_anti")


def overlay_contexts(failures: DataFrame, answers: DataFrame) -> DataFrame:
    """Give unclassified rows the stored answer for their context. ``answers`` is unique by context."""
    staged = answers.select("failure_context", *[F.col(n).alias(f"_new_{n}") for n in RESULT_FIELDS])
    open_row = F.col("classification_source") == schemas.TAG_UNCLASSIFIED
    # rows that need no answer carry a NULL context and match nothing
    context = F.when(open_row, F.col("failure_context"))
    keyed = with_context(failures).withColumn("failure_context", context)
    # Spark splits a frequent context by itself when both sides come straight from a shuffle; the few
    # answers may be grouped by context already, and lose that grouping here
    joined = keyed.join(staged.hint("rebalance"), "failure_context", "left")
    return _overlay(failures, joined, F.col("_new_category").isNotNull())


def apply_classifications(failures: DataFrame, results: DataFrame) -> DataFrame:
    """Update category, team, fix and source tag by (job_id, step_number).

    Several results for one key are reduced to one by value order, so the outcome does not depend on
    the order of arrival.
    """
    keys = ["job_id", "step_number"]
    staged = one_answer(results.groupBy(*keys)).select(*keys, *[F.col(n).alias(f"_new_{n}") for n in RESULT_FIELDS], F.lit(True).alias("_hit"))
    return _overlay(failures, join_grouped(failures, staged, keys, "left"), F.col("_hit").isNotNull())


def _overlay(failures: DataFrame, joined: DataFrame, hit: Column) -> DataFrame:
    changes = {n: F.when(hit, F.col(f"_new_{n}")).otherwise(F.col(n)) for n in RESULT_FIELDS}
    tag = F.col("classification_source")
    changes["classification_source"] = F.when(hit, F.lit(schemas.TAG_FALLBACK)).otherwise(tag)
    return joined.select(*[changes[c].alias(c) if c in changes else F.col(c) for c in failures.columns])


def one_answer(grouped: GroupedData) -> DataFrame:
    """One of several answers per group, the same one every time."""
    best = grouped.agg(F.min(F.struct(*RESULT_FIELDS)).alias("_best"))
    return best.select("*", *[F.col(f"_best.{n}").alias(n) for n in RESULT_FIELDS]).drop("_best")


# Offline classifier: (token in the lowered context, category, team, fix), first match wins.
OFFLINE_ANSWERS = (
    ("reason: timed_out", "Execution Timeout", "Platform SRE", "Raise the step time limit or split the step."),
    ("reason: cancelled", "Cancelled Run", "Platform SRE", "Re-run the workflow if the cancellation was not wanted."),
    ("lint", "Style Check", "Core Maintainers", "Run the linters locally and commit the changes."),
    ("test", "Test Run", "Backend Engineering", "Reproduce the failing test locally."),
    ("step: none", "Unnamed Step", "Core Maintainers", "Name the step so that it can be routed."),
)
OFFLINE_DEFAULT = ("General Failure", "Platform SRE", "Read the job log.")


def offline_classifier(
    answers: tuple[tuple[str, str, str, str], ...] = OFFLINE_ANSWERS, default: tuple[str, str, str] = OFFLINE_DEFAULT
) -> Classifier:
    """A deterministic stand-in for an external model: no network, same answer every time.

    Built as a closure, which Spark ships whole; a classifier from a module of its own must be
    importable on the executors.
    """
    names = list(RESULT_FIELDS)

    def classify(contexts: pd.Series) -> pd.DataFrame:
        lowered = contexts.str.lower()
        found = pd.DataFrame([default] * len(contexts), columns=names, index=contexts.index)
        for token, *answer in reversed(answers):
            hits = lowered.str.contains(token, regex=False)
            for name, value in zip(names, answer):
                found.loc[hits, name] = value
        return found

    return classify


def coverage(failures: DataFrame) -> DataFrame:
    """Rows and share by classification source."""
    counts = failures.groupBy("classification_source").agg(F.count("*").alias("failures"))
    total = counts.agg(F.sum("failures")).scalar()
    return counts.withColumn("share", F.round(F.col("failures") / total, 6))
