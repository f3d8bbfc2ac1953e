"""Typed runs, jobs and steps to the star schema and its summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buildlens import schemas
from buildlens.functions import scalars
from buildlens.operators import classify
from buildlens.operators.joins import join_grouped

RUN_LABELS = ["workflow_name", "head_branch", "head_sha", "triggered_by", "event_type"]


def fct_workflow_runs(runs: DataFrame, jobs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Runs with job counts. Without jobs ``total_jobs`` stays NULL while the other counts are 0.

    ``carry`` here and below names run columns to keep beside those of the table.
    """
    per_run = jobs.groupBy("workflow_run_id").agg(
        F.count("job_id").alias("total_jobs"),
        F.count_if(F.col("conclusion") == "success").alias("successful_jobs"),
        F.count_if(F.col("conclusion").isin(*schemas.FAILED_CONCLUSIONS)).alias("failed_jobs"),
        F.min("started_at").alias("first_job_started_at"),
        F.max("completed_at").alias("last_job_completed_at"),
    )
    base = ["workflow_run_id", "workflow_name", "head_branch", "head_sha", "event_type", "status", "conclusion",
            "triggered_by", "run_attempt", "created_at", "updated_at", *carry]
    joined = join_grouped(runs.select(*base), per_run, ["workflow_run_id"], "left")
    failed = F.coalesce("failed_jobs", F.lit(0).cast("bigint"))
    return joined.select(
        *[c for c in base if c not in carry],
        "total_jobs",
        F.coalesce("successful_jobs", F.lit(0).cast("bigint")).alias("successful_jobs"),
        failed.alias("failed_jobs"),
        "first_job_started_at",
        "last_job_completed_at",
        scalars.duration_seconds(F.col("first_job_started_at"), F.col("last_job_completed_at")).alias(
            "total_execution_duration_seconds"
        ),
        (failed > 0).alias("has_job_failure"),
        *carry,
    )


def _step_columns(steps: DataFrame) -> DataFrame:
    return steps.select(
        "job_id",
        "step_number",
        "step_name",
        F.col("status").alias("step_status"),
        F.col("conclusion").alias("step_conclusion"),
        F.col("started_at").alias("step_started_at"),
        F.col("completed_at").alias("step_completed_at"),
    )


def fct_step_executions(
    steps: DataFrame, jobs: DataFrame, runs: DataFrame, carry: tuple[str, ...] = ()
) -> DataFrame:
    # jobs meet their run first: the steps, by far the largest side, are then shuffled once
    owners = jobs.select("job_id", "workflow_run_id", "job_name", "runner_name").join(
        runs.select("workflow_run_id", *RUN_LABELS, *carry), "workflow_run_id"
    )
    joined = _step_columns(steps).join(owners, "job_id")
    return joined.select(
        "job_id",
        "step_number",
        "step_name",
        "step_status",
        "step_conclusion",
        "step_started_at",
        "step_completed_at",
        scalars.duration_seconds(F.col("step_started_at"), F.col("step_completed_at")).alias("step_duration_seconds"),
        scalars.is_state(F.col("step_conclusion"), "success").alias("is_successful_step"),
        "workflow_run_id",
        "job_name",
        "runner_name",
        *RUN_LABELS,
        *carry,
    )


def int_failure_events(
    steps: DataFrame, jobs: DataFrame, runs: DataFrame, failed_steps_only: bool = False, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Steps that failed or whose job failed, with the names of job and run.

    A successful step of a failed job is therefore included, unless ``failed_steps_only`` is set.
    """
    failed_job = scalars.is_state(F.col("conclusion"), *schemas.FAILED_CONCLUSIONS).alias("_failed_job")
    owners = jobs.select("job_id", "workflow_run_id", "job_name", "runner_name", failed_job)
    failed = scalars.is_state(F.col("step_conclusion"), *schemas.FAILED_CONCLUSIONS)
    if not failed_steps_only:
        failed = failed | F.col("_failed_job")
    # filtered between the joins, so that only failures are shuffled to their run
    events = _step_columns(steps).join(owners, "job_id").filter(failed).drop("_failed_job")
    joined = events.join(runs.select("workflow_run_id", *RUN_LABELS, *carry), "workflow_run_id")
    return joined.select(*_step_columns(steps).columns, "workflow_run_id", "job_name", "runner_name", *RUN_LABELS, *carry)


def fct_actionable_failures(
    events: DataFrame, rules: tuple[schemas.NameRule, ...] = schemas.NAME_RULES, carry: tuple[str, ...] = ()
) -> DataFrame:
    named = events.withColumn("failure_reason", F.coalesce("step_conclusion", F.lit("failure")))
    return classify.classify_by_names(named, rules).select(*schemas.ACTIONABLE_SCHEMA.fieldNames(), *carry)


def _days_of(rows: DataFrame, keys: list[str], counted: dict[str, str], day: str, *more: Column) -> DataFrame:
    """Per key and day: how many distinct values of each column of ``counted`` (result name: column) came up with the key
    for the first time on that day, and other aggregates. The counts of all days add up to those of the key."""
    parts = rows.groupBy(*keys, day).agg(*more)
    for name, column in counted.items():
        firsts = rows.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.min(day).alias(day))
        own = firsts.groupBy(*[F.col(c).alias(f"_{c}") for c in (*keys, day)]).agg(F.count("*").alias("_first"))
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*keys, day)]
        count = F.coalesce("_first", F.lit(0)).cast("bigint").alias(name)
        parts = parts.join(own, same, "left").select(*parts.columns, count)
    return parts


def repository_days(runs: DataFrame, day: str = "created_date") -> DataFrame:
    """What :func:`dim_repositories` needs of each day; days are merged by :func:`repositories_of`."""
    seen = F.min("created_at").alias("first_seen_at"), F.max("created_at").alias("last_seen_at")
    return _days_of(runs, ["workflow_name", "head_branch"], {"total_runs": "workflow_run_id"}, day, *seen)


def repositories_of(days: DataFrame) -> DataFrame:
    return days.groupBy("workflow_name", "head_branch").agg(
        F.sum("total_runs").alias("total_runs"),
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
    )


def commit_days(runs: DataFrame, day: str = "created_date") -> DataFrame:
    """What :func:`dim_commits` needs of each day; days are merged by :func:`commits_of`."""
    seen = F.min("created_at").alias("first_commit_run_at"), F.max("created_at").alias("last_commit_run_at")
    keys = ["head_sha", "head_branch", "triggered_by"]
    return _days_of(runs.filter(F.col("head_sha").isNotNull()), keys, {"total_runs": "workflow_run_id"}, day, *seen)


def commits_of(days: DataFrame) -> DataFrame:
    return days.groupBy("head_sha", "head_branch", "triggered_by").agg(
        F.sum("total_runs").alias("total_runs"),
        F.min("first_commit_run_at").alias("first_commit_run_at"),
        F.max("last_commit_run_at").alias("last_commit_run_at"),
    )


def error_days(failed_logs: DataFrame, day: str = "created_date") -> DataFrame:
    """What :func:`dim_error_categories` needs of each day; days are merged by :func:`errors_of`."""
    reasons = failed_logs.filter(F.col("failure_reason").isNotNull())
    counted = {"affected_workflow_runs": "workflow_run_id", "affected_jobs": "job_id"}
    return _days_of(reasons, ["failure_reason"], counted, day, F.count("*").alias("total_occurrences"))


def errors_of(days: DataFrame) -> DataFrame:
    counts = ("affected_workflow_runs", "affected_jobs", "total_occurrences")
    return days.groupBy("failure_reason").agg(*[F.sum(c).alias(c) for c in counts])


def dim_repositories(runs: DataFrame) -> DataFrame:
    return runs.groupBy("workflow_name", "head_branch").agg(
        F.count_distinct("workflow_run_id").alias("total_runs"),
        F.min("created_at").alias("first_seen_at"),
        F.max("created_at").alias("last_seen_at"),
    )


def dim_commits(runs: DataFrame) -> DataFrame:
    shas = runs.filter(F.col("head_sha").isNotNull())
    return shas.groupBy("head_sha", "head_branch", "triggered_by").agg(
        F.count_distinct("workflow_run_id").alias("total_runs"),
        F.min("created_at").alias("first_commit_run_at"),
        F.max("created_at").alias("last_commit_run_at"),
    )


def dim_error_categories(failed_logs: DataFrame, approximate: bool = False) -> DataFrame:
    """Reach of each failure reason. ``approximate`` trades exact distinct counts for one shuffle."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    reasons = failed_logs.filter(F.col("failure_reason").isNotNull())
    return reasons.groupBy("failure_reason").agg(
        distinct("workflow_run_id").alias("affected_workflow_runs"),
        distinct("job_id").alias("affected_jobs"),
        F.count("*").alias("total_occurrences"),
    )


def pass_rate(runs: DataFrame) -> DataFrame:
    """Share of successful runs among the completed runs of each workflow."""
    done = runs.filter(F.col("status") == "completed")
    passed = F.count_if(F.col("conclusion") == "success")
    return done.groupBy("workflow_name").agg(
        F.count("*").alias("completed_runs"),
        passed.alias("passed_runs"),
        F.round(passed / F.count("*"), 6).alias("pass_rate"),
    )


#: Distinct seconds in a range of the exact percentiles.
RANGE = 4096


def step_duration_stats(executions: DataFrame, approximate: bool = False) -> DataFrame:
    """Distribution of step seconds per workflow.

    Rows are first counted per distinct duration, so a workflow with most of the rows is reduced to its distinct seconds.
    Percentiles are exact ranks, interpolated: counts per range of RANGE seconds tell in which range a rank lies, and only
    the seconds of these ranges are put in order. ``approximate`` takes a sketch instead.
    """
    timed = executions.filter(F.col("step_duration_seconds").isNotNull())
    shares = {"p50_seconds": 0.5, "p90_seconds": 0.9, "p99_seconds": 0.99}
    sums = F.sum("n").alias("steps"), F.min("s").alias("min_seconds"), F.max("s").alias("max_seconds")
    average = F.round(F.col("_sum") / F.col("steps"), 6).alias("avg_seconds")
    if approximate:
        counted = timed.select("workflow_name", F.col("step_duration_seconds").alias("s"), F.lit(1).alias("n"))
        sketch = F.percentile_approx("s", list(shares.values()), 10000).alias("_p")
        found = counted.groupBy("workflow_name").agg(*sums, F.sum("s").alias("_sum"), sketch)
        columns = [F.round(F.col("_p")[i], 6).alias(c) for i, c in enumerate(shares)]
        return found.select("workflow_name", "steps", "min_seconds", "max_seconds", average, *columns)
    counted = timed.groupBy("workflow_name", F.col("step_duration_seconds").alias("s")).agg(F.count("*").alias("n"))
    counted = counted.withColumn("range", F.floor(F.col("s") / RANGE).cast("bigint"))
    total = F.sum(F.col("s") * F.col("n")).alias("_sum")
    ranges = counted.groupBy("workflow_name", "range").agg(*sums, total)
    own = Window.partitionBy("workflow_name")
    before = F.coalesce(F.sum("steps").over(own.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = ranges.select("workflow_name", "range", "steps", before.alias("before"), F.sum("steps").over(own).alias("all"))
    # the two ranks around each percentile, and how much the upper one weighs
    place = {name: (F.col("all") - 1) * share for name, share in shares.items()}
    targets = F.array(
        *[
            F.struct(F.lit(name).alias("name"), rank.cast("bigint").alias("rank"), weight.alias("weight"))
            for name, at in place.items()
            for rank, weight in ((F.floor(at), 1 - (at - F.floor(at))), (F.floor(at) + 1, at - F.floor(at)))
        ]
    )
    wanted = ranked.select("*", F.explode(targets).alias("t")).filter(
        (F.col("t.weight") > 0) & (F.col("t.rank") >= F.col("before")) & (F.col("t.rank") < F.col("before") + F.col("steps"))
    )
    wanted = wanted.select(
        F.col("workflow_name").alias("_workflow"), F.col("range").alias("_range"), "t.name", "t.weight",
        (F.col("t.rank") - F.col("before")).alias("at"),
    )
    # at most RANGE seconds for each of a workflow's six ranks
    same = F.col("workflow_name").eqNullSafe(F.col("_workflow")) & (F.col("range") == F.col("_range"))
    inside = counted.join(wanted, same)
    line = Window.partitionBy("workflow_name", "name", "at", "range", "weight").orderBy("s")
    inside = inside.withColumn("upto", F.sum("n").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    hit = inside.filter((F.col("upto") > F.col("at")) & (F.col("upto") - F.col("n") <= F.col("at")))
    percentiles = hit.groupBy(F.col("workflow_name").alias("_workflow")).agg(
        *[F.round(F.sum(F.when(F.col("name") == c, F.col("s") * F.col("weight"))), 6).alias(c) for c in shares]
    )
    stats = ranges.groupBy("workflow_name").agg(
        F.sum("steps").alias("steps"), F.min("min_seconds").alias("min_seconds"), F.max("max_seconds").alias("max_seconds"),
        F.sum("_sum").alias("_sum"),
    )
    joined = stats.join(percentiles, F.col("workflow_name").eqNullSafe(F.col("_workflow")))
    return joined.select("workflow_name", "steps", "min_seconds", "max_seconds", average, *shares)


def step_duration_histogram(executions: DataFrame, width: int) -> DataFrame:
    """Steps per duration bucket of ``width`` seconds."""
    timed = executions.filter(F.col("step_duration_seconds").isNotNull())
    bucket = (F.floor(F.col("step_duration_seconds") / width) * width).cast("bigint")
    return timed.groupBy("workflow_name", bucket.alias("from_seconds")).agg(F.count("*").alias("steps"))
