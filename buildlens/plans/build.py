"""Build every table from bronze: silver is typed and written once, the marts read it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from buildlens.operators import quality
from buildlens.plans import gold, silver
from buildlens.sources.rules import default_rules

SILVER = ("stg_workflow_runs", "stg_jobs", "stg_steps")
VIEWS = ("stg_failed_logs", "int_failure_events")
MARTS = (
    "fct_workflow_runs",
    "fct_step_executions",
    "fct_actionable_failures",
    "dim_repositories",
    "dim_commits",
    "dim_error_categories",
)


def from_bronze(bronze: DataFrame, attempts: str = "all", landed: DataFrame | None = None) -> dict[str, DataFrame]:
    """The three typed silver frames of a bronze table.

    Jobs are taken from the runs' payloads, or from ``landed``, the bronze table of jobs landed as an entity of their own.
    """
    runs = silver.workflow_runs(bronze, attempts)
    if landed is None:
        jobs = silver.jobs(bronze, attempts=attempts)
    else:
        jobs = silver.attach_jobs(runs, silver.landed_jobs(landed)).drop("run_composite_key")
    return {
        "stg_workflow_runs": runs,
        "stg_jobs": jobs.drop("raw_steps_array"),
        "stg_steps": silver.steps(jobs),
    }


def derive(typed: dict[str, DataFrame], failed_steps_only: bool = False) -> dict[str, DataFrame]:
    """Views and marts as plans over typed runs, jobs and steps."""
    runs, jobs, steps = (typed[n] for n in SILVER)
    logs = silver.failed_logs(steps)
    events = gold.int_failure_events(steps, jobs, runs, failed_steps_only)
    return {
        "stg_failed_logs": logs,
        "int_failure_events": events,
        "fct_workflow_runs": gold.fct_workflow_runs(runs, jobs),
        "fct_step_executions": gold.fct_step_executions(steps, jobs, runs),
        "fct_actionable_failures": gold.fct_actionable_failures(events),
        "dim_repositories": gold.dim_repositories(runs),
        "dim_commits": gold.dim_commits(runs),
        "dim_error_categories": gold.dim_error_categories(logs),
    }


def write(df: DataFrame, path: str, name: str, bucket_key: str | None = None, buckets: int | None = None) -> DataFrame:
    """Write a table whole and hand back a scan of it.

    With ``buckets`` it is saved as a catalog table, hashed and sorted by ``bucket_key``.
    """
    if buckets and bucket_key:
        hashed = df.repartition(buckets, bucket_key).write.mode("overwrite")
        hashed.bucketBy(buckets, bucket_key).sortBy(bucket_key).option("path", path).saveAsTable(name)
        return df.sparkSession.table(name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def build_all(
    spark: SparkSession,
    typed: dict[str, DataFrame],
    out: str,
    failed_steps_only: bool = False,
    buckets: int | None = None,
    nulls: dict[str, dict[str, int]] | None = None,
) -> dict[str, DataFrame]:
    """Write the silver frames and the marts under ``out``; views stay plans, registered by name.

    The writes count the NULLs that the not-null checks ask for, of the views too as far as a mart reads them whole; a
    dictionary given as ``nulls`` takes the counts, for :func:`quality.run_suite`.

    ``buckets`` stores jobs and steps hashed by job. The two marts that join them then shuffle neither,
    for one shuffle when they are written. Leave it out when single jobs may hold much of the steps:
    the split of a skewed join needs a shuffle.
    """
    keys = {"stg_jobs": "job_id", "stg_steps": "job_id"}
    counts = {} if nulls is None else nulls
    tables = {}
    for name in SILVER:
        frame, seen = quality.watched(typed[name], name)
        tables[name] = write(frame, f"{out}/{name}", name, keys.get(name), buckets)
        counts[name] = seen.get
    plans = derive(tables, failed_steps_only)
    # the marts that read every row of a view
    events, seen_events = quality.watched(plans["int_failure_events"], "int_failure_events")
    logs, seen_logs = quality.watched(plans["stg_failed_logs"], "stg_failed_logs")
    whole = {
        **plans,
        "fct_actionable_failures": gold.fct_actionable_failures(events),
        "dim_error_categories": gold.dim_error_categories(logs),
    }
    for name in MARTS:
        frame, seen = quality.watched(whole[name], name)
        tables[name] = write(frame, f"{out}/{name}", name)
        counts[name] = seen.get
    counts |= {"int_failure_events": seen_events.get, "stg_failed_logs": seen_logs.get}
    for name in VIEWS:
        plans[name].createOrReplaceTempView(name)
        tables[name] = plans[name]
    tables["error_classification_rules"] = default_rules(spark)
    return tables
