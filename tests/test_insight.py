"""Dashboard questions on small frames, and the plans behind the large ones."""

from conftest import rows
from pyspark.sql import functions as F

from buildlens import samples
from buildlens.functions import scalars
from buildlens.plans import gold, insight, silver
from buildlens.queries import QUERIES


def test_severity_of_null_is_medium(spark):
    df = spark.createDataFrame([(1,), (99,), (2,), (None,)], "p int")
    assert [r[0] for r in df.select(scalars.severity(F.col("p"))).collect()] == ["CRITICAL", "CRITICAL", "MEDIUM", "MEDIUM"]


def test_normalize_adds_only_absent_aliases(spark):
    df = spark.createDataFrame([("c", 1, "mine")], "category string, priority int, severity string")
    board = insight.normalize(df)
    assert board.columns == ["CATEGORY", "PRIORITY", "SEVERITY", "FAILURE_CATEGORY"]
    assert board.first().SEVERITY == "mine"
    assert insight.triage_queue(board).columns == ["FAILURE_CATEGORY", "SEVERITY"]


def test_drilldown_defaults_are_for_absent_columns(spark):
    board = insight.normalize(spark.createDataFrame([(5, None)], "job_id bigint, assigned_team string"))
    assert rows(insight.drilldown(board)) == [
        (5, "Unknown Job", "Unknown", None, "UNKNOWN", "Inspect logs", "No error captured")
    ]


def test_kpis_without_columns(spark):
    assert rows(insight.kpis(spark.createDataFrame([(1,), (2,)], "X int"))) == [(2, 0, 0, 0)]


def test_counts_drop_nulls_and_order_ties_by_name(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("c",)], "T string")
    assert [tuple(r) for r in insight.value_counts(df, "T", "t", "n").collect()] == [("c", 2), ("a", 1), ("b", 1)]
    assert rows(insight.value_share(df, "T", "t").select("share"), "share") == [(0.25,), (0.25,), (0.5,)]
    assert [tuple(r) for r in insight.facet_values(df, ("T",)).collect()] == [("T", "a"), ("T", "b"), ("T", "c")]


def test_empty_selection_filters_nothing(spark):
    df = spark.createDataFrame([("b",), ("a",)], "T string")
    assert insight.facet_filter(df, T=[], MISSING=["x"]).count() == 2
    assert insight.facet_filter(df, T=["a"]).count() == 1


def test_lookback_is_inclusive_on_both_days(spark):
    days = ["2024-01-01 00:00:00", "2023-12-31 23:59:59", "2024-01-08 23:59:59", "2024-01-09 00:00:00"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("timestamp_ntz").alias("created_at"))
    kept = insight.lookback(df, "2024-01-08", 7)
    assert sorted(str(r[0]) for r in kept.collect()) == ["2024-01-01 00:00:00", "2024-01-08 23:59:59"]


def test_seconds_count_boundaries_in_any_session_zone(spark):
    df = spark.createDataFrame([("2024-03-10 01:59:59.9", "2024-03-10 03:00:02.8")], "a string, b string")
    seconds = scalars.duration_seconds(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz"))
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert df.select(seconds).first()[0] == 3603
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_query_multiplies_rows(spark, sf_dir):
    for name in ("fct_step_executions", "int_failure_events", "fct_workflow_runs", "dq_relationships", "attach_jobs"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_lookback_reaches_the_scan(spark, sf_dir):
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan(QUERIES["lookback_window"](spark, sf_dir))


def test_payload_reads_are_pruned_to_the_fields_used(spark, sf_dir):
    text = plan(silver.workflow_runs(samples.nested_bronze(spark, sf_dir)).select("workflow_run_id", "triggered_by"))
    assert "variant_get(raw_payload" not in text.split("FileScan")[1]
    assert "ReadSchema: struct<raw_payload:struct<0:bigint,1:string>" in text


def test_approximate_options(spark):
    logs = spark.range(1000).select(F.lit("failure").alias("failure_reason"), F.col("id").alias("workflow_run_id"), F.col("id").alias("job_id"))
    assert abs(gold.dim_error_categories(logs, approximate=True).first().affected_jobs - 1000) < 100
    steps = spark.range(1001).select(F.lit("w").alias("workflow_name"), F.col("id").alias("step_duration_seconds"))
    exact, near = gold.step_duration_stats(steps).first(), gold.step_duration_stats(steps, approximate=True).first()
    assert (exact.p50_seconds, exact.p90_seconds, exact.avg_seconds) == (500, 900, 500)
    assert abs(near.p50_seconds - 500) <= 1
