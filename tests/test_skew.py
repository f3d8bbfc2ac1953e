"""Hot keys and copies: results stay whole, plans stay balanced."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from buildlens.functions import scalars
from buildlens.operators import classify
from buildlens.operators.dedupe import latest_per_key, top_per_group
from buildlens.operators.joins import children_or_none, join_grouped
from buildlens.plans import gold, refresh


def hot(spark, n=6000):
    """A third of the rows on key 0, a third without key, the rest spread; many equal rows."""
    third = F.col("id") % 3
    key = F.when(third == 0, F.lit(0)).when(third == 1, 1 + F.col("id") % 499)
    return spark.range(n).select(key.cast("bigint").alias("k"), (F.col("id") % 7).alias("v"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_grouped_equals_plain_join(spark, how):
    left = hot(spark)
    right = spark.createDataFrame([(0, "x"), (0, "y"), (1, "z"), (4, "q"), (None, "n")], "k bigint, w string")
    right = right.groupBy("k").agg(F.max("w").alias("w"))
    plain, spread = left.join(right, ["k"], how), join_grouped(left, right, ["k"], how)
    assert spread.columns == plain.columns
    counted = [r for r in rows(plain.groupBy(*plain.columns).count(), *plain.columns)]
    assert rows(spread.groupBy(*spread.columns).count(), *spread.columns) == counted


def test_join_grouped_refuses_right_joins(spark):
    with pytest.raises(ValueError):
        join_grouped(hot(spark), hot(spark), ["k"], "right")


@pytest.mark.parametrize("salts", [1, 5])
def test_top_per_group(spark, salts):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    best = top_per_group(df, ["g"], [F.desc("v")], 4, salts)
    assert best.columns == ["g", "v"]
    assert rows(best, "g", "v") == sorted((v % 3, v) for v in range(2988, 3000))


def test_latest_per_key_is_cut_before_the_shuffle(spark):
    plan = latest_per_key(hot(spark), ["k"], [F.desc("v")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    found = rows(latest_per_key(hot(spark), ["k"], [F.desc("v")]), "k")
    assert found == rows(hot(spark).groupBy("k").agg(F.max("v")), "k")


def test_fingerprint_ignores_order_but_not_copies(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "id bigint, s string")

    def print_of(frame):
        digests = frame.select(scalars.row_hash(["id", "s"]).alias("d"))
        return digests.agg(scalars.batch_fingerprint(F.col("d"))).first()[0]

    assert print_of(df) == print_of(df.orderBy(F.desc("id")).repartition(3))
    assert print_of(df) != print_of(df.distinct())
    plan = df.select(scalars.row_hash(["id"]).alias("d")).groupBy("d").agg(scalars.batch_fingerprint(F.col("d")))
    assert "collect_list" not in plan._jdf.queryExecution().executedPlan().toString()


def test_children_or_none_equals_a_left_join(spark):
    parents = spark.createDataFrame([(0, "a"), (1, "b"), (9999, "c"), (None, "d")], "k bigint, name string")
    plain = parents.join(hot(spark), ["k"], "left")
    split = children_or_none(parents, hot(spark), ["k"])
    assert split.columns == plain.columns
    grouped = plain.groupBy(*plain.columns).count()
    assert rows(split.groupBy(*split.columns).count(), *split.columns) == rows(grouped, *plain.columns)
    assert "Outer" not in split._jdf.queryExecution().executedPlan().toString()


SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def small_skew(spark):
    """Thresholds under which a few kilobytes count as skewed."""
    for key, value in SMALL_SKEW.items():
        spark.conf.set(key, value)
    yield
    for key in SMALL_SKEW:
        spark.conf.unset(key)


def star(spark):
    """Runs, jobs and steps in which one job of one run owns two thirds of all steps."""
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    state = {"status": F.lit("completed"), "conclusion": F.lit("failure"), "started_at": at, "completed_at": at}
    spread = F.when(F.col("id") % 3 == 0, F.col("id") % 200).otherwise(F.lit(7))
    steps = spark.range(0, 12000, 1, 8).select(
        spread.alias("job_id"), (spread % 20).alias("workflow_run_id"), F.col("id").alias("step_number"),
        F.sha2(F.col("id").cast("string"), 256).alias("step_name"),
    ).withColumns(state)
    jobs = spark.range(200).select(
        F.col("id").alias("job_id"), (F.col("id") % 20).alias("workflow_run_id"), F.lit("j").alias("job_name"),
        F.lit("r").alias("runner_name"),
    ).withColumns(state)
    runs = spark.range(20).select(
        F.col("id").alias("workflow_run_id"), *[F.lit("x").alias(c) for c in gold.RUN_LABELS]
    )
    return steps, jobs, runs


@pytest.mark.parametrize("build", [gold.fct_step_executions, gold.int_failure_events])
def test_spark_splits_the_hot_job(spark, small_skew, build):
    marts = build(*star(spark))
    assert len(marts.collect()) == 12000
    assert "skew=true" in marts._jdf.queryExecution().executedPlan().toString()


def test_spark_splits_a_hot_key_before_a_grouped_side(spark, small_skew):
    _, jobs, runs = star(spark)
    wide = jobs.unionByName(
        spark.range(0, 12000, 1, 8).select(
            F.col("id").alias("job_id"), F.lit(7).cast("bigint").alias("workflow_run_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("job_name"), F.lit("r").alias("runner_name"),
        ), allowMissingColumns=True,
    )
    grouped = runs.groupBy("workflow_run_id").agg(F.count("*").alias("n"))
    joined = join_grouped(wide, grouped, ["workflow_run_id"], "left")
    assert len(joined.collect()) == 12200
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_spark_splits_the_hot_context(spark, small_skew):
    workflow = F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise("same")
    failures = spark.range(0, 12000, 1, 8).select(
        workflow.alias("workflow_name"), F.lit("s").alias("step_name"), F.lit("failure").alias("failure_reason"),
        *[F.sha2(F.col("id").cast("string"), 256).alias(c) for c in classify.RESULT_FIELDS],
        F.lit("UNCLASSIFIED_FALLBACK").alias("classification_source"),
    )
    asked = classify.pending_contexts(failures).select("failure_context", *[F.lit("new").alias(c) for c in classify.RESULT_FIELDS])
    done = classify.overlay_contexts(failures, classify.one_answer(asked.groupBy("failure_context")))
    assert {r.category for r in done.collect()} == {"new"}
    assert "skew=true" in done._jdf.queryExecution().executedPlan().toString()


def test_overlay_with_one_hot_context(spark, tmp_path):
    failures = spark.range(900).select(
        F.when(F.col("id") < 600, "same").otherwise(F.col("id").cast("string")).alias("workflow_name"),
        F.lit("s").alias("step_name"),
        F.lit("failure").alias("failure_reason"),
        *[F.lit("old").alias(c) for c in classify.RESULT_FIELDS],
        F.lit("UNCLASSIFIED_FALLBACK").alias("classification_source"),
    )
    done = refresh.triage(spark, failures, classify.offline_classifier(), str(tmp_path / "answers"), parallelism=3)
    assert rows(done.groupBy("classification_source").count()) == [("LLM_FALLBACK", 900)]
