"""Streams: restarts and any order of arrival lead to the same tables."""

import gzip
import json
import os
import random

from conftest import rows
from pyspark.sql import functions as F

from buildlens.plans import bronze, silver
from buildlens.streaming import ingest, status


def drop(root, name, *records):
    folder = f"{root}/acme/app/workflow_runs/2024/05/06"
    os.makedirs(folder, exist_ok=True)
    with gzip.open(f"{folder}/{name}.jsonl.gz", "wt") as out:
        out.write(json.dumps({"execution_id": name, "record_count": len(records), "data": records}) + "\n")


def run(i, state, minute, **more):
    at = f"2024-05-0{1 + i % 3}T10:{minute:02d}:00Z"
    return {"id": i, "run_attempt": 1, "status": state, "created_at": f"2024-05-0{1 + i % 3}T09:00:00Z", "updated_at": at, **more}


def table(spark, path):
    return rows(silver.workflow_runs(bronze.read(spark, path)).select("workflow_run_id", "status", "created_at"), "workflow_run_id")


def test_two_drops_with_restart_equal_one_batch(spark, tmp_path):
    first = [run(i, "queued", 1) for i in range(6)]
    second = [run(i, "completed", 2) for i in range(3, 9)] + [run(1, "lost", 3, id=None)]
    root, path, state = (str(tmp_path / n) for n in ("lake", "bronze", "state"))
    bad = str(tmp_path / "bad")
    drop(root, "a", *first)
    ingest.ingest_available(spark, root, path, state, quarantine=bad)
    drop(root, "b", *second)
    ingest.ingest_available(spark, root, path, state, quarantine=bad, max_files=1)
    ingest.ingest_available(spark, root, path, state, quarantine=bad)
    whole = str(tmp_path / "whole")
    bronze.load(spark, root, whole)
    assert table(spark, path) == table(spark, whole)
    assert [r[1] for r in table(spark, path)] == ["queued"] * 3 + ["completed"] * 6
    assert spark.read.parquet(bad).count() == 1


def test_lost_checkpoint_changes_nothing(spark, tmp_path):
    root, path = str(tmp_path / "lake"), str(tmp_path / "bronze")
    drop(root, "a", run(1, "queued", 1), run(2, "completed", 2))
    for state in ("s1", "s2"):
        ingest.ingest_available(spark, root, path, str(tmp_path / state), grain="month")
    assert [r[1] for r in table(spark, path)] == ["queued", "completed"]
    assert os.listdir(path) == ["created_date=2024-05-01"]


def test_status_does_not_depend_on_arrival_order(spark, tmp_path):
    schema = "id bigint, state string, at int, bucket int"
    events = [(i, f"s{at}", at, i % 2) for i in range(5) for at in range(4)] + [(None, "x", 9, 0)]
    outcomes = []
    for seed in range(2):
        random.Random(seed).shuffle(events)
        base = tmp_path / str(seed)
        for part in range(3):
            spark.createDataFrame(events[part::3], schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
            stream = spark.readStream.schema(schema).parquet(f"{base}/in")
            order = [F.desc("at"), F.desc("state")]
            status.track_status(spark, stream, f"{base}/out", f"{base}/state", ["id"], order, "bucket")
        assert spark.read.parquet(f"{base}/out__rejected").count() == 1
        outcomes.append(rows(spark.read.parquet(f"{base}/out").select("id", "state", "at"), "id"))
    assert outcomes[0] == outcomes[1] == [(i, "s3", 3) for i in range(5)]
