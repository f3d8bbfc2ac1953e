"""One round of the whole flow: load, build, check, classify what is left."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from buildlens import schemas
from buildlens.operators import classify, merge, quality
from buildlens.plans import bronze, build, incremental
from buildlens.session import scratch_dir


def triage(
    spark: SparkSession,
    failures: DataFrame,
    classifier: classify.Classifier,
    answers_path: str,
    parallelism: int | None = None,
    quota: classify.Quota | None = None,
) -> DataFrame:
    """Classify the open failures, asking only for contexts that were never answered before.

    Answers are written before they are used, keyed by context: a table rebuilt later gets them back
    without a question, and a lost executor does not repeat finished work.

    With a ``quota`` contexts are asked in waves, each written before the next one. When the service says that the quota
    is spent the round ends: its answers are kept, failures without one stay open, and the next round goes on there.
    """
    known = spark.read.parquet(answers_path) if merge.exists(spark, answers_path) else None
    fresh = classify.pending_contexts(failures, known)
    if quota is None:
        classify.classify_contexts(fresh, classifier, parallelism).write.mode("append").parquet(answers_path)
    else:
        _ask_in_waves(spark, fresh, classifier, answers_path, quota)
    # two rounds running at once may both have answered a context
    answers = spark.read.parquet(answers_path).groupBy("failure_context")
    return classify.overlay_contexts(failures, classify.one_answer(answers))


def _ask_in_waves(
    spark: SparkSession, contexts: DataFrame, classifier: classify.Classifier, answers_path: str, quota: classify.Quota
) -> None:
    staged = scratch_dir(spark, "contexts")
    contexts.write.parquet(staged)
    open_ = contexts = spark.read.schema(contexts.schema).parquet(staged)
    while True:
        seen = Observation()
        wave = classify.classify_wave(open_.limit(quota.wave), classifier, quota)
        wave.observe(seen, F.count("*").alias("answered")).write.mode("append").parquet(answers_path)
        if seen.get["answered"] < quota.wave:
            # the last wave, or one that the service has cut short
            return
        answers = spark.read.schema(schemas.CLASSIFICATION_SCHEMA).parquet(answers_path)
        open_ = contexts.join(answers, "failure_context", "left_anti")


def refresh(
    spark: SparkSession,
    lake_root: str,
    home: str,
    classifier: classify.Classifier,
    attempts: str = "all",
    failed_steps_only: bool = False,
    since: date | None = None,
    until: date | None = None,
    stop_on_failed_checks: bool = False,
    jobs_entity: str | None = None,
    incremental: bool = False,
    quota: classify.Quota | None = None,
) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """Load the lake into bronze, rebuild all tables, run the checks and classify the rest.

    Everything is kept under ``home``: also the check results, which are written before anything is classified, and the
    rows that could not be loaded, of all rounds. Returns the tables, the results and these rows. ``stop_on_failed_checks`` raises an
    error instead of classifying when a check fails. ``jobs_entity`` names the lake's entity that holds the jobs, where
    they were fetched by themselves; else they are in the runs' payloads.

    ``incremental`` rebuilds the days of the loaded runs only (the others' files stay as they are), with the same tables as
    a result; a home is kept either way from its first round on. Jobs must then be in the payloads. A job or step with an
    unreadable field is then set aside too, instead of failing the round. ``quota`` bounds the classifier's calls, see
    :func:`triage`.
    """
    if incremental:
        if jobs_entity:
            raise ValueError("jobs of an entity of their own are not built by days")
        tables, rejected = _refresh_days(spark, lake_root, home, attempts, failed_steps_only, since, until)
        return _finished(spark, tables, home, classifier, quota, stop_on_failed_checks, rejected)
    rejected = bronze.load(spark, lake_root, f"{home}/bronze", since=since, until=until)
    landed = None
    if jobs_entity:
        lost = bronze.load(spark, lake_root, f"{home}/bronze_{jobs_entity}", jobs_entity, since=since, until=until)
        rejected = rejected.union(lost)
        landed = bronze.read(spark, f"{home}/bronze_{jobs_entity}")
    typed = build.from_bronze(bronze.read(spark, f"{home}/bronze"), attempts, landed)
    nulls: dict[str, dict[str, int]] = {}
    tables = build.build_all(spark, typed, f"{home}/tables", failed_steps_only, nulls=nulls)
    return _finished(spark, tables, home, classifier, quota, stop_on_failed_checks, rejected, nulls)


def _finished(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    home: str,
    classifier: classify.Classifier,
    quota: classify.Quota | None,
    stop_on_failed_checks: bool,
    rejected: DataFrame,
    nulls: dict[str, dict[str, int]] | None = None,
) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """Check the tables, and classify what the rules left."""
    checks = build.write(quality.run_suite(tables, nulls=nulls), f"{home}/checks", "checks")
    if stop_on_failed_checks and not (failed := checks.filter("status = 'fail'")).isEmpty():
        raise RuntimeError(f"failed checks: {sorted(row['check_name'] for row in failed.collect())}")
    done = triage(spark, tables["fct_actionable_failures"], classifier, f"{home}/answers", quota=quota)
    tables["classified_failures"] = build.write(done, f"{home}/tables/classified_failures", "classified_failures")
    return tables, checks, rejected


def _refresh_days(
    spark: SparkSession,
    lake_root: str,
    home: str,
    attempts: str,
    failed_steps_only: bool,
    since: date | None,
    until: date | None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Load, then rebuild the days of the runs that this round, or one that died before its end, has loaded."""
    notes, path = f"{home}/touched", f"{home}/bronze"
    bronze.load(spark, lake_root, path, since=since, until=until, touched=notes)
    held = bronze.read(spark, path)
    folders = incremental.noted(spark, notes)
    staged = scratch_dir(spark, "touched")
    spark.read.schema("run_id bigint").parquet(*folders).distinct().write.parquet(staged)
    runs = spark.read.schema("run_id bigint").parquet(staged)
    days = incremental.touched_days(spark, held, runs, f"{home}/ties")
    tables, lost = incremental.build_days(spark, held, f"{home}/tables", days, attempts, failed_steps_only)
    # one folder for a round's days: a job that stays broken is set aside again whenever its day is built
    lost.write.parquet(f"{bronze.beside(path)}/batch=build-{uuid.uuid4().hex}")
    for folder in folders:
        merge.remove(spark, f"{folder}/_SUCCESS")
        merge.remove(spark, folder)
    return tables, bronze.quarantined(spark, bronze.beside(path))
