"""Rounds that rebuild only the days they touched give the tables of a full build."""

import json
import os
from datetime import date

import pytest
from conftest import rows
from test_lake import envelope, write
from test_refresh import RUN, job

from buildlens.operators import classify
from buildlens.plans import build, incremental, refresh
from buildlens.plans import bronze as bronze_plan

TABLES = (*build.SILVER, *build.VIEWS, *build.MARTS)


def run(i, day, conclusion="failure", attempt=1, sha="abc", **more):
    at = f"{day}T09:00:00Z"
    return {**RUN, "id": i, "run_attempt": attempt, "conclusion": conclusion, "head_sha": sha, "created_at": at,
            "run_started_at": at, "updated_at": f"{day}T10:0{attempt}:00Z", **more}


def files(home):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(f"{home}/tables")
        for f in names
        if f.endswith(".parquet")
    }


def same_as_full(spark, home, tables):
    typed = build.from_bronze(bronze_plan.read(spark, f"{home}/bronze"))
    full = {**typed, **build.derive(typed)}
    for name in TABLES:
        columns = full[name].columns
        found, expected = (sorted(map(str, t.select(*columns).collect())) for t in (tables[name], full[name]))
        assert found == expected, name
        assert sorted(tables[name].columns) == sorted(columns)


ROUNDS = [
    [
        run(1, "2024-05-01", jobs=[job(10, "failure", ("checkout", "success"), ("unit tests", "failure"))]),
        run(2, "2024-05-01", "success", sha="def"),
        run(3, "2024-05-02", jobs=[job(30, "failure", ("deploy", "failure"))]),
        run(4, "2024-05-03", "success"),
    ],
    # a failure that goes away, and a new run of another day
    [run(3, "2024-05-02", "success", jobs=[job(30, "success", ("deploy", "success"))]), run(5, "2024-05-04", "timed_out")],
    # a second attempt of a run that is dated to another day, which ties the two days together
    [run(1, "2024-05-05", "success", attempt=2, jobs=[job(11, "success", ("unit tests", "success"))])],
    # a run of a tied day
    [run(6, "2024-05-05", "cancelled")],
]


def test_rounds_give_the_tables_of_a_full_build(spark, tmp_path):
    root, home = str(tmp_path / "lake"), str(tmp_path / "home")
    offline, seen = classify.offline_classifier(), {}
    touched = [{"2024-05-01", "2024-05-02", "2024-05-03"}, {"2024-05-02", "2024-05-04"}, {"2024-05-01", "2024-05-05"}, {"2024-05-01", "2024-05-05"}]
    for n, (batch, days) in enumerate(zip(ROUNDS, touched), 1):
        write(f"{root}/acme/app/workflow_runs/2024/06/0{n}/a.jsonl.gz", envelope(*batch))
        day = date(2024, 6, n)
        tables, checks, rejected = refresh.refresh(
            spark, root, home, offline, since=day, until=day, incremental=True
        )
        same_as_full(spark, home, tables)
        now = files(home)
        changed = {f for f in now.keys() | seen.keys() if now.get(f) != seen.get(f) and "classified_failures" not in f}
        assert {f.split("created_date=")[1].split("/")[0] for f in changed} == days
        seen = now
        assert rejected.count() == 0 and incremental.noted(spark, f"{home}/touched") == []
    assert tables["fct_workflow_runs"].count() == 7


def test_a_round_that_died_is_made_up_for(spark, tmp_path, monkeypatch):
    root, home = str(tmp_path / "lake"), str(tmp_path / "home")
    offline = classify.offline_classifier()
    write(f"{root}/acme/app/workflow_runs/2024/06/01/a.jsonl.gz", envelope(*ROUNDS[0]))
    refresh.refresh(spark, root, home, offline, incremental=True)
    write(f"{root}/acme/app/workflow_runs/2024/06/02/a.jsonl.gz", envelope(*ROUNDS[1]))
    monkeypatch.setattr(incremental, "build_days", lambda *_, **__: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        refresh.refresh(spark, root, home, offline, incremental=True)
    monkeypatch.undo()
    # nothing new is landed, and the days of the lost round are built all the same
    tables, _, _ = refresh.refresh(spark, root, home, offline, since=date(2024, 7, 1), until=date(2024, 7, 1), incremental=True)
    same_as_full(spark, home, tables)


def test_jobs_and_steps_that_cannot_be_read_are_set_aside(spark, tmp_path):
    root, home = str(tmp_path / "lake"), str(tmp_path / "home")
    good, bad = job(10, "failure", ("unit tests", "failure")), {**job(11, "failure", ("build", "failure")), "started_at": "soon"}
    half = job(12, "failure", ("deploy", "failure"), ("notify", "failure"))
    half["steps"][0]["number"] = "first"
    write(f"{root}/acme/app/workflow_runs/2024/06/01/a.jsonl.gz", envelope(run(1, "2024-05-01", jobs=[good, bad, half])))
    tables, _, rejected = refresh.refresh(spark, root, home, classify.offline_classifier(), incremental=True)
    assert rows(tables["stg_jobs"].select("job_id"), "job_id") == [(10,), (12,)]
    assert rows(tables["stg_steps"].select("job_id", "step_name"), "job_id") == [(10, "unit tests"), (12, "notify")]
    found = {(r.reject, json.loads(r.raw).get("id") or json.loads(r.raw)["name"]) for r in rejected.collect()}
    assert found == {("job", 11), ("step", "deploy")}


def test_other_days_are_not_read(spark, tmp_path):
    frame = spark.createDataFrame([(i, f"2024-01-{i + 1:02}") for i in range(20)], "n int, created_date string")
    frame.selectExpr("n", "cast(created_date as date) AS created_date").write.partitionBy("created_date").parquet(str(tmp_path / "t"))
    held = spark.read.parquet(str(tmp_path / "t"))
    plan = held.filter(incremental.in_days([date(2024, 1, 3), date(2024, 1, 5)]))
    assert plan.count() == 2 and "PartitionFilters: [created_date" in plan._jdf.queryExecution().toString()
    assert held.filter(incremental.in_days([None])).count() == 0 and held.filter(incremental.in_days(None)).count() == 20
