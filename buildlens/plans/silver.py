"""Bronze payloads to typed runs, jobs, steps and failed steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buildlens import schemas
from buildlens.functions import payload, scalars
from buildlens.operators.dedupe import latest_per_key
from buildlens.operators.joins import children_or_none

field = payload.field


def pick_attempts(bronze: DataFrame, attempts: str = "all") -> DataFrame:
    """All attempts of a run, or only its highest."""
    if attempts == "all":
        return bronze
    if attempts != "latest":
        raise ValueError("attempts is 'all' or 'latest'")
    return latest_per_key(bronze, ["run_id"], [F.col("run_attempt").desc_nulls_last()])


LINEAGE = ("source_file_name", "loaded_at")


# Payload fields with a type that a text can fail to have.
TYPED = {
    "id": "bigint",
    "run_attempt": "bigint",
    "created_at": payload.TIMESTAMP,
    "updated_at": payload.TIMESTAMP,
    "run_started_at": payload.TIMESTAMP,
}


def split_unreadable(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose typed run fields can be read, rows to quarantine).

    The typed reads below fail the job on a value of the wrong form; this takes such rows out first.
    """
    return bronze.filter(~unreadable()), bronze.filter(unreadable())


def unreadable(payload_column: str = "raw_payload", typed: dict[str, str] = TYPED) -> Column:
    """Whether a typed field, of a run if not told otherwise, is there but cannot be read."""
    broken = F.lit(False)
    for path, kind in typed.items():
        given = field(payload_column, path, "variant", strict=False)
        given = given.isNotNull() & ~F.is_variant_null(given)
        broken = broken | (given & field(payload_column, path, kind, strict=False).isNull())
    return broken


def workflow_runs(bronze: DataFrame, attempts: str = "all", lineage: tuple[str, ...] = LINEAGE) -> DataFrame:
    """Typed runs. ``lineage`` names bronze columns to carry along."""
    p = "raw_payload"
    typed = pick_attempts(bronze, attempts).select(
        field(p, "id", "bigint").alias("workflow_run_id"),
        field(p, "name").alias("workflow_name"),
        field(p, "head_branch").alias("head_branch"),
        field(p, "head_sha").alias("head_sha"),
        field(p, "event").alias("event_type"),
        field(p, "status").alias("status"),
        field(p, "conclusion").alias("conclusion"),
        field(p, "actor.login").alias("triggered_by"),
        field(p, "created_at", payload.TIMESTAMP).alias("created_at"),
        field(p, "updated_at", payload.TIMESTAMP).alias("updated_at"),
        field(p, "run_attempt", "bigint").alias("run_attempt"),
        *lineage,
    )
    return typed.filter(F.col("workflow_run_id").isNotNull())


# Job and step fields with such a type.
JOB_TYPED = {"id": "bigint", "started_at": payload.TIMESTAMP, "completed_at": payload.TIMESTAMP}
STEP_TYPED = {"number": "bigint", "started_at": payload.TIMESTAMP, "completed_at": payload.TIMESTAMP}


def jobs(
    bronze: DataFrame,
    synthesize: bool = True,
    attempts: str = "all",
    carry: tuple[str, ...] = (),
    strict: bool = True,
) -> DataFrame:
    """One row per job. With ``synthesize`` a run without jobs counts as one job with one step.

    A missing ``jobs`` list, JSON null and an empty list all give one job that stands for the run. A
    job field that is missing or null falls back to the run's. A job without a ``steps`` key gets one
    step made from the run, while ``steps: null`` and ``[]`` stay without steps. ``carry`` names bronze columns to keep.

    A typed field that cannot be read fails the job, as a strict cast should. Not ``strict``, it reads as missing, and
    ``reject`` holds the text of such a job, for :func:`split_rejected`.
    """
    p = "raw_payload"
    # run fields are read once per run, before its jobs multiply the row
    run = pick_attempts(bronze, attempts).select(
        field(p, "id", "bigint").alias("workflow_run_id"),
        field(p, "name").alias("run_name"),
        field(p, "status").alias("run_status"),
        field(p, "conclusion").alias("run_conclusion"),
        field(p, "run_started_at").alias("run_started"),
        field(p, "updated_at").alias("run_updated"),
        field(p, "jobs", "variant").alias("_jobs"),
        "source_file_name",
        "loaded_at",
        *carry,
    )
    if not synthesize:
        exploded = payload.explode(run, "_jobs", "_job")
        return _job_columns(exploded, lambda own, _: own, field("_job", "steps", "variant"), lambda own, _: own, carry, strict)
    whole = F.coalesce("_jobs", F.parse_json(F.lit("[{}]")))
    exploded = payload.explode(run.withColumn("_jobs", whole), "_jobs", "_job", outer=True)
    stand_in = run_as_step("run_name", "run_status", "run_conclusion", "run_started", "run_updated")
    steps = F.coalesce(field("_job", "steps", "variant"), stand_in)
    return _job_columns(exploded, F.coalesce, steps, F.coalesce, carry, strict)


def split_rejected(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(jobs or steps that were read, without ``reject``; those with an unreadable field)."""
    return rows.filter("reject IS NULL").drop("reject"), rows.filter("reject IS NOT NULL")


def _unread(element: str, typed: dict[str, str]) -> Column:
    """The text of an element that has a typed field which is there but cannot be read, else NULL."""
    return F.when(unreadable(element, typed), F.to_json(element)).alias("reject")


def run_as_step(name: str, status: str, conclusion: str, started: str, completed: str) -> Column:
    """A step list of one that stands for a whole run, made from the run's columns."""
    step = F.struct(
        F.lit(1).alias("number"),
        F.coalesce(name, F.lit(schemas.DEFAULT_STEP_NAME)).alias("name"),
        F.col(status).alias("status"),
        F.col(conclusion).alias("conclusion"),
        F.col(started).cast("string").alias("started_at"),
        F.col(completed).cast("string").alias("completed_at"),
    )
    return F.to_variant_object(F.array(step))


def _job_columns(
    exploded: DataFrame, fallback, steps: Column, default, carry: tuple[str, ...] = (), strict: bool = True
) -> DataFrame:
    j = "_job"

    def typed_field(path: str) -> Column:
        return field(j, path, JOB_TYPED[path], strict)

    typed = exploded.select(
        "workflow_run_id",
        fallback(typed_field("id"), F.col("workflow_run_id")).alias("job_id"),
        default(fallback(field(j, "name"), F.col("run_name")), F.lit(schemas.DEFAULT_JOB_NAME)).alias("job_name"),
        fallback(field(j, "status"), F.col("run_status")).alias("status"),
        fallback(field(j, "conclusion"), F.col("run_conclusion")).alias("conclusion"),
        fallback(typed_field("started_at"), F.col("run_started").cast(payload.TIMESTAMP)).alias("started_at"),
        fallback(typed_field("completed_at"), F.col("run_updated").cast(payload.TIMESTAMP)).alias("completed_at"),
        default(field(j, "runner_name"), F.lit(schemas.DEFAULT_RUNNER)).alias("runner_name"),
        steps.alias("raw_steps_array"),
        "source_file_name",
        "loaded_at",
        *carry,
        *([] if strict else [_unread(j, JOB_TYPED)]),
    )
    return typed.filter(F.col("job_id").isNotNull())


def steps(jobs: DataFrame, carry: tuple[str, ...] = (), strict: bool = True) -> DataFrame:
    """One row per numbered step. Elements without a number are dropped, so an inner explode is enough.

    ``carry`` names job columns to keep; ``strict`` as for :func:`jobs`.
    """
    s = "_step"
    kept = jobs.select("job_id", "workflow_run_id", "raw_steps_array", *carry)
    exploded = payload.explode(kept, "raw_steps_array", s)
    typed = exploded.select(
        "job_id",
        "workflow_run_id",
        field(s, "number", "bigint", strict).alias("step_number"),
        field(s, "name").alias("step_name"),
        field(s, "status").alias("status"),
        field(s, "conclusion").alias("conclusion"),
        field(s, "started_at", payload.TIMESTAMP, strict).alias("started_at"),
        field(s, "completed_at", payload.TIMESTAMP, strict).alias("completed_at"),
        *carry,
        *([] if strict else [_unread(s, STEP_TYPED)]),
    )
    known = F.col("step_number").isNotNull()
    numbered = typed.filter(known if strict else known | F.col("reject").isNotNull())
    return numbered.withColumn("duration_seconds", scalars.duration_seconds(F.col("started_at"), F.col("completed_at")))


def failed_logs(steps: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Steps that neither succeeded nor were skipped; without a conclusion the status decides."""
    conclusion = F.col("conclusion")
    unfinished = conclusion.isNull() & (F.col("status") == "failure")
    failed = steps.filter(~conclusion.isin(*schemas.HARMLESS_CONCLUSIONS) | unfinished)
    return failed.select(
        "workflow_run_id",
        "job_id",
        "step_number",
        "step_name",
        conclusion.alias("failure_reason"),
        "duration_seconds",
        "started_at",
        "completed_at",
        *carry,
    )


def landed_jobs(records: DataFrame) -> DataFrame:
    """Typed jobs from raw records of the jobs entity, as ``lake.tag_jobs`` tagged them, with the lineage they carry."""
    p = "raw_payload"
    return records.select(
        field(p, "run_composite_key").alias("run_composite_key"),
        field(p, "id", "bigint").alias("job_id"),
        field(p, "name").alias("job_name"),
        field(p, "status").alias("status"),
        field(p, "conclusion").alias("conclusion"),
        field(p, "started_at", payload.TIMESTAMP).alias("started_at"),
        field(p, "completed_at", payload.TIMESTAMP).alias("completed_at"),
        field(p, "runner_name").alias("runner_name"),
        field(p, "steps", "variant").alias("raw_steps_array"),
        *[c for c in LINEAGE if c in records.columns],
    )


def attach_jobs(runs: DataFrame, jobs: DataFrame) -> DataFrame:
    """Jobs landed as an entity of their own, joined to their run attempt; a run without any counts as one job.

    ``runs`` are typed runs, ``jobs`` carry ``run_composite_key`` and the job columns. When they bring
    their steps too, a job without any gets one made from the run. Lineage is the job's, or the run's for a run that
    stands for its job. Jobs are read twice: pass a written table.
    """
    keyed = runs.select(
        scalars.composite_key(F.col("workflow_run_id"), attempt=F.col("run_attempt")).alias("run_composite_key"),
        "workflow_run_id",
        F.col("workflow_name").alias("_name"),
        F.col("status").alias("_status"),
        F.col("conclusion").alias("_conclusion"),
        F.col("created_at").alias("_started_at"),
        F.col("updated_at").alias("_completed_at"),
        *[F.col(c).alias(f"_{c}") for c in LINEAGE if c in runs.columns],
    )
    names = ["job_id", "job_name", "status", "conclusion", "started_at", "completed_at", "runner_name"]
    raw = [c for c in ("raw_steps_array",) if c in jobs.columns]
    lineage = [c for c in LINEAGE if c in jobs.columns and c in runs.columns]
    own = jobs.select("run_composite_key", *names, *raw, *lineage)
    stand_in = run_as_step("_name", "_status", "_conclusion", "_started_at", "_completed_at")
    joined = children_or_none(keyed, own, ["run_composite_key"])
    return joined.select(
        "workflow_run_id",
        "run_composite_key",
        F.coalesce("job_id", "workflow_run_id").alias("job_id"),
        F.coalesce("job_name", "_name", F.lit(schemas.DEFAULT_JOB_NAME)).alias("job_name"),
        *[F.coalesce(c, f"_{c}").alias(c) for c in ("status", "conclusion", "started_at", "completed_at")],
        F.coalesce("runner_name", F.lit(schemas.DEFAULT_RUNNER)).alias("runner_name"),
        *[F.coalesce(c, stand_in).alias(c) for c in raw],
        *[F.coalesce(c, f"_{c}").alias(c) for c in lineage],
    ).filter(F.col("job_id").isNotNull())
