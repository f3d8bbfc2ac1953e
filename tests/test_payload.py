"""Missing, null and empty lists in a payload, field fallbacks and attempts."""

import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from buildlens import samples
from buildlens.plans import build, gold, silver

RUN = (
    '"name":"CI","status":"completed","conclusion":"failure","run_attempt":1,"actor":{"login":"ann"},'
    '"run_started_at":"2024-05-01T10:00:00Z","created_at":"2024-05-01T09:59:00Z","updated_at":"2024-05-01T10:10:00Z"'
)
PAYLOADS = [
    f'{{"id":1,{RUN}}}',
    f'{{"id":2,{RUN},"jobs":null}}',
    f'{{"id":3,{RUN},"jobs":[]}}',
    f'{{"id":4,{RUN},"jobs":[{{"id":40,"name":"build","conclusion":null}},{{"id":41}}]}}',
    f'{{"id":5,{RUN},"jobs":[{{"id":50,"steps":null}},{{"id":51,"steps":[]}}]}}',
    f'{{"id":6,{RUN},"jobs":[{{"id":60,"steps":[{{"number":1,"name":"x"}},{{"name":"no number"}}]}}]}}',
    '{"id":7}',
    f'{{"id":null,{RUN}}}',
]


def bronze(spark, payloads):
    return spark.createDataFrame([(p,) for p in payloads], "text string").select(
        F.parse_json("text").alias("raw_payload"),
        F.variant_get(F.parse_json("text"), "$.id", "bigint").alias("run_id"),
        F.coalesce(F.try_variant_get(F.parse_json("text"), "$.run_attempt", "bigint"), F.lit(1)).alias("run_attempt"),
        F.lit("f").alias("source_file_name"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("loaded_at"),
    )


def test_runs_without_id_are_dropped(spark):
    runs = silver.workflow_runs(bronze(spark, PAYLOADS))
    assert sorted(r.workflow_run_id for r in runs.collect()) == [1, 2, 3, 4, 5, 6, 7]
    one = runs.filter("workflow_run_id = 1").first()
    assert one.triggered_by == "ann"
    assert one.created_at == datetime.datetime(2024, 5, 1, 9, 59)


def test_a_run_without_jobs_is_one_job(spark):
    jobs = silver.jobs(bronze(spark, PAYLOADS))
    found = rows(jobs.select("workflow_run_id", "job_id", "job_name", "conclusion"), "workflow_run_id", "job_id")
    assert found == [
        (1, 1, "CI", "failure"),
        (2, 2, "CI", "failure"),
        (3, 3, "CI", "failure"),
        (4, 40, "build", "failure"),
        (4, 41, "CI", "failure"),
        (5, 50, "CI", "failure"),
        (5, 51, "CI", "failure"),
        (6, 60, "CI", "failure"),
        (7, 7, "Default Job", None),
    ]
    assert {r.runner_name for r in jobs.collect()} == {"GitHub Hosted Runner"}


def test_steps_follow_the_outcome_table(spark):
    steps = silver.steps(silver.jobs(bronze(spark, PAYLOADS)))
    found = rows(steps.select("job_id", "step_number", "step_name", "duration_seconds"), "job_id")
    assert found == [
        (1, 1, "CI", 600),
        (2, 1, "CI", 600),
        (3, 1, "CI", 600),
        (7, 1, "Workflow Execution", None),
        (40, 1, "CI", 600),
        (41, 1, "CI", 600),
        (60, 1, "x", None),
    ]


def test_strict_jobs_synthesize_nothing(spark):
    jobs = silver.jobs(bronze(spark, PAYLOADS), synthesize=False)
    found = rows(jobs.select("job_id", "job_name", "conclusion", "runner_name"), "job_id")
    assert found == [(40, "build", None, None)] + [(i, None, None, None) for i in (41, 50, 51, 60)]
    assert [r.job_id for r in silver.steps(jobs).collect()] == [60]


def test_bad_value_fails_loudly(spark):
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        silver.workflow_runs(bronze(spark, ['{"id":1,"created_at":"yesterday"}'])).collect()


def test_unreadable_rows_can_be_taken_out(spark):
    table = bronze(spark, ['{"id":1,"created_at":"yesterday"}', '{"id":2,"updated_at":null}', '{"id":3,"run_attempt":"x"}'])
    good, bad = silver.split_unreadable(table.withColumn("run_id", F.variant_get("raw_payload", "$.id", "bigint")))
    assert [r.workflow_run_id for r in silver.workflow_runs(good).collect()] == [2]
    assert sorted(r.run_id for r in bad.select("run_id").collect()) == [1, 3]


def test_attempts(spark):
    table = bronze(spark, [f'{{"id":1,{RUN}}}', f'{{"id":1,{RUN.replace(":1,", ":2,", 1)}}}'])
    assert silver.workflow_runs(table).count() == 2
    latest = silver.workflow_runs(table, attempts="latest").collect()
    assert [r.run_attempt for r in latest] == [2]
    assert silver.jobs(table, attempts="latest").count() == 1
    with pytest.raises(ValueError):
        silver.jobs(table, attempts="first")


def test_repeated_attempts_fan_out_by_default(spark):
    table = bronze(spark, [f'{{"id":1,{RUN}}}', f'{{"id":1,{RUN.replace(":1,", ":2,", 1)}}}'])
    typed = build.from_bronze(table)
    executions = gold.fct_step_executions(typed["stg_steps"], typed["stg_jobs"], typed["stg_workflow_runs"])
    assert executions.count() == 8
    typed = build.from_bronze(table, attempts="latest")
    executions = gold.fct_step_executions(typed["stg_steps"], typed["stg_jobs"], typed["stg_workflow_runs"])
    assert executions.count() == 1


def test_build_all_writes_tables_and_views(spark, tmp_path):
    tables = build.build_all(spark, build.from_bronze(bronze(spark, PAYLOADS)), str(tmp_path))
    assert spark.table("int_failure_events").count() == tables["fct_actionable_failures"].count() == 6
    assert set(build.MARTS) <= {p.name for p in tmp_path.iterdir()}
    assert not set(build.VIEWS) & {p.name for p in tmp_path.iterdir()}


def test_bucketed_jobs_and_steps_meet_without_a_shuffle(spark, tmp_path):
    typed = build.from_bronze(bronze(spark, PAYLOADS))
    plain = build.build_all(spark, typed, str(tmp_path / "plain"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        tables = build.build_all(spark, typed, str(tmp_path / "bucketed"), buckets=4)
        joined = tables["stg_steps"].join(tables["stg_jobs"], "job_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        marts = ("fct_step_executions", "fct_actionable_failures")
        for name in marts:
            assert rows(tables[name], "job_id", "step_number") == rows(plain[name], "job_id", "step_number")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("stg_jobs", "stg_steps"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _depth(line):
    return next(i for i, c in enumerate(line) if c.isalpha() or c == "*")


def test_nested_payloads_are_made_after_all_shuffles(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = samples.nested_payloads(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = [x for x in text.splitlines() if any(c.isalpha() for c in x)]
    at = next(i for i, x in enumerate(lines) if "collect_list" in x)
    above, depth = [], _depth(lines[at])
    for line in reversed(lines[:at]):
        if _depth(line) < depth:
            depth = _depth(line)
            above.append(line)
    assert above and not [x for x in above if "Exchange" in x]


def test_rejected_jobs_and_steps_are_counted_from_one_reading_of_the_payloads(spark, sf_dir):
    from buildlens.queries import QUERIES

    found = QUERIES["quarantine_jobs"](spark, sf_dir)
    assert "variant" not in found._jdf.queryExecution().optimizedPlan().toString().lower().replace("raw_steps_array", "")
    assert {(r.level, r.outcome) for r in found.collect()} == {(a, b) for a in ("job", "step") for b in ("read", "rejected")}


def test_lines_of_steps_are_dealt_out_by_order_once(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = samples.s_steps(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # lines by order and by part, the orders, the parts
    assert text.count("Exchange hashpartitioning") == 4
