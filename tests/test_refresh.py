"""The whole flow on a small lake, twice."""

import json

from conftest import rows
from pyspark.sql import functions as F
from test_lake import envelope, write

from buildlens.operators import classify
from buildlens.plans import gold, refresh, silver
from buildlens.sources import lake

TIMES = {"created_at": "2024-05-01T09:00:00Z", "run_started_at": "2024-05-01T09:00:00Z", "updated_at": "2024-05-01T09:05:00Z"}
RUN = {"run_attempt": 1, "name": "CI", "status": "completed", "actor": {"login": "ann"}, "head_sha": "abc", **TIMES}


def job(i, conclusion, *steps):
    listed = [{"number": n, "name": s, "status": "completed", "conclusion": c} for n, (s, c) in enumerate(steps, 1)]
    return {"id": i, "name": f"job {i}", "status": "completed", "conclusion": conclusion, "steps": listed}


def test_refresh_twice(spark, tmp_path):
    root, home, log = str(tmp_path / "lake"), str(tmp_path / "home"), str(tmp_path / "asked")
    nested = job(10, "failure", ("checkout", "success"), ("unit tests", "failure"), ("deploy", "failure"))
    write(
        f"{root}/acme/app/workflow_runs/2024/05/01/a.jsonl.gz",
        envelope({**RUN, "id": 1, "conclusion": "failure", "jobs": [nested]}, {**RUN, "id": 2, "conclusion": "success"}),
    )

    offline = classify.offline_classifier()

    def ask(contexts):
        with open(log, "a") as out:
            out.writelines(c + "\n" for c in contexts)
        return offline(contexts)

    tables, checks, rejected = refresh.refresh(spark, root, home, ask)
    found = tables["classified_failures"].select("step_number", "failure_reason", "classification_source")
    assert rows(found, "step_number") == [
        (1, "success", "LLM_FALLBACK"),
        (2, "failure", "DETERMINISTIC_RULE"),
        (3, "failure", "LLM_FALLBACK"),
    ]
    # a successful step of a failed job is kept, and the assertion reports it
    failing = [(r.check_kind, r.failures) for r in checks.filter("status = 'fail'").collect()]
    assert failing == [("no_success_classified", 1)]
    assert rejected.count() == 0 and len(open(log).read().splitlines()) == 2

    write(f"{root}/acme/app/workflow_runs/2024/05/02/b.jsonl.gz", envelope({**RUN, "id": 3, "conclusion": "timed_out"}))
    tables, checks, _ = refresh.refresh(spark, root, home, ask, failed_steps_only=True)
    assert len(open(log).read().splitlines()) == 3
    assert rows(tables["classified_failures"].select("job_id", "step_number"), "job_id", "step_number") == [(3, 1), (10, 2), (10, 3)]
    assert checks.filter("status = 'fail'").isEmpty()
    assert tables["fct_workflow_runs"].count() == 3


def test_jobs_landed_on_their_own(spark, tmp_path):
    landed = [{**job(5001, None, ("Set up", "success")), "run_id": 1001, "run_attempt": 1}, {"id": 5002, "run_id": 1001}]
    frame = spark.createDataFrame([(json.dumps(j),) for j in landed], "text string")
    raw = frame.select(F.parse_json("text").alias("p"))
    typed = lake.tag_jobs(
        raw.select("p", *[F.variant_get("p", f"$.{c}", "bigint").alias(c) for c in ("id", "run_id", "run_attempt")])
    )
    tagged = typed.select(
        F.parse_json(F.concat(F.regexp_replace(F.to_json("p"), "}$", ""), F.lit(',"run_composite_key":"'), "run_composite_key", F.lit('"}'))).alias("raw_payload")
    )
    runs = frame.limit(1).select(F.parse_json(F.lit(json.dumps({**RUN, "id": 1001, "conclusion": "failure"}))).alias("raw_payload"))
    more = frame.limit(1).select(F.parse_json(F.lit(json.dumps({**RUN, "id": 1002, "conclusion": "failure"}))).alias("raw_payload"))
    runs = silver.workflow_runs(runs.union(more), lineage=())
    jobs = silver.attach_jobs(runs, silver.landed_jobs(tagged))
    assert rows(jobs.select("workflow_run_id", "job_id", "job_name", "conclusion"), "job_id") == [
        (1002, 1002, "CI", "failure"), (1001, 5001, "job 5001", "failure"), (1001, 5002, "CI", "failure"),
    ]
    steps = silver.steps(jobs)
    assert rows(steps.select("job_id", "step_number", "step_name"), "job_id") == [(1002, 1, "CI"), (5001, 1, "Set up"), (5002, 1, "CI")]
    assert gold.fct_step_executions(steps, jobs, runs).count() == 3
