"""Checks that are made while tables are written."""

from buildlens import samples
from buildlens.operators import quality
from buildlens.plans import build


def test_writes_count_what_scans_would(spark, tmp_path):
    runs = spark.createDataFrame([(1, None), (2, "completed"), (None, None)], "workflow_run_id bigint, status string")
    frame, seen = quality.watched(runs, "stg_workflow_runs")
    build.write(frame, str(tmp_path / "runs"), "runs")
    assert seen.get == {"workflow_run_id": 1, "status": 2}
    nothing, seen = quality.watched(runs.limit(0), "stg_workflow_runs")
    nothing.write.parquet(str(tmp_path / "none"))
    assert seen.get == {"workflow_run_id": 0, "status": 0}
    assert quality.watched(runs, "no_such_table")[1] is None


def test_suite_reads_no_table_for_known_counts(spark, tmp_path, sf_dir):
    nulls = {}
    tables = build.build_all(spark, samples.s_tables(spark, sf_dir), str(tmp_path), nulls=nulls)
    kinds = {c.table for c in quality.DECLARED if c.kind == "not_null"}
    assert kinds - set(nulls) == {"error_classification_rules"}
    found, scanned = (
        sorted(map(tuple, quality.run_suite(tables, nulls=known).collect())) for known in (nulls, None)
    )
    assert found == scanned
