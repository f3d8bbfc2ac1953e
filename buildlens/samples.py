"""CI-shaped views over the sample tables, so that every operator has whole-table input.

R runs, J jobs, S steps with rule-bearing names, N nested payloads, E sub-second durations, D log text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from buildlens.functions.payload import TIMESTAMP
from buildlens.operators.dedupe import latest_per_key
from buildlens.session import scratch_dir

LINE_KEYS = ["l_orderkey", "l_linenumber"]
# Line numbers run from 1 to 7, so ten ids per order are enough.
LINES_PER_ORDER = 10


# Columns of the sample tables that are read here; given, so that no job is run to find them.
TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "benchmark": "item_id bigint, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def line_order() -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in ("l_shipdate", "l_partkey", "l_suppkey")]


def latest_lines(spark: SparkSession, sf_dir: str, dealt: str | None = None) -> DataFrame:
    columns = [*LINE_KEYS, "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"]
    lines = table(spark, sf_dir, "lineitem").select(*columns)
    return latest_per_key(lines.repartition(dealt) if dealt else lines, LINE_KEYS, line_order())


def _order_state() -> dict[str, Column]:
    state = F.col("o_orderstatus")
    return {
        "status": F.when(state == "P", "in_progress").otherwise("completed"),
        "conclusion": F.when(state == "F", "success").when(state == "O", "failure"),
    }


def _line_state() -> dict[str, Column]:
    flag, state = F.col("l_returnflag"), F.col("l_linestatus")
    return {
        "status": F.when(state == "F", "completed").when(state == "O", "in_progress"),
        "conclusion": F.when(flag == "A", "success")
        .when(flag == "R", "failure")
        .when((flag == "N") & (state == "F"), "skipped")
        .when((flag == "N") & (state == "O"), "cancelled"),
        "started_at": F.col("l_shipdate"),
        "completed_at": F.timestamp_add("SECOND", F.col("l_quantity").cast("bigint") * 1000, F.col("l_shipdate")),
    }


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R: one run per order."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_name", "c_nationkey"
    )
    sha = F.when(F.col("o_custkey") % 50 != 0, F.concat(F.lit("sha"), "o_custkey"))
    updated = F.timestamp_add("DAY", F.col("o_orderkey") % 7, F.col("o_orderdate"))
    return orders.join(customers, "o_custkey").select(
        F.col("o_orderkey").alias("workflow_run_id"),
        F.col("o_orderpriority").alias("workflow_name"),
        F.col("c_mktsegment").alias("head_branch"),
        sha.alias("head_sha"),
        F.concat(F.lit("evt_"), F.col("c_nationkey") % 4).alias("event_type"),
        *[c.alias(n) for n, c in _order_state().items()],
        F.col("c_name").alias("triggered_by"),
        F.col("o_orderdate").alias("created_at"),
        updated.alias("updated_at"),
        F.lit(1).cast("bigint").alias("run_attempt"),
    )


def _lines_with_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_lines(spark, sf_dir).join(_part_names(spark, sf_dir), "l_partkey")


def _part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")


def _job_id() -> Column:
    return F.col("l_orderkey") * LINES_PER_ORDER + F.col("l_linenumber")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J: one job per line."""
    return _lines_with_parts(spark, sf_dir).select(
        F.col("l_orderkey").alias("workflow_run_id"),
        _job_id().alias("job_id"),
        F.col("p_name").alias("job_name"),
        F.concat(F.lit("runner-"), "l_suppkey").alias("runner_name"),
        *[c.alias(n) for n, c in _line_state().items()],
    )


def job_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J as an entity of its own, as the jobs endpoint gives it: without the parent run's row."""
    return jobs(spark, sf_dir).withColumns(
        {"id": F.col("job_id"), "run_id": F.col("workflow_run_id"), "run_attempt": F.lit(1).cast("bigint")}
    )


def _step_name(name: str | Column = "p_name") -> Column:
    name = F.col(name) if isinstance(name, str) else name
    word = F.element_at(F.split(name, " "), 2)
    return (
        F.when(word == "anvil", "pre-commit hooks")
        .when(word == "bolt", "Run Tests")
        .when(word == "gear", "smoke check")
        .when(word == "gizmo", "Pre-Commit Test")
        .when(word == "ring", F.lit(None))
        .otherwise(name)
    )


def s_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _line_state()
    last = F.col("l_linenumber") == 7
    state["conclusion"] = F.when(~last, state["conclusion"])
    state["status"] = F.when(last & (F.col("l_returnflag") == "R"), "failure").otherwise(state["status"])
    # lines are dealt out by order once, for their newest versions and for the orders
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = latest_lines(spark, sf_dir, dealt="l_orderkey").join(orders, "l_orderkey")
    steps = lines.join(_part_names(spark, sf_dir), "l_partkey")
    return steps.select(
        F.col("l_orderkey").alias("job_id"),
        F.col("o_custkey").alias("workflow_run_id"),
        F.col("l_linenumber").cast("bigint").alias("step_number"),
        _step_name().alias("step_name"),
        *[c.alias(n) for n, c in state.items()],
        F.col("l_quantity").cast("bigint").alias("_q"),
    ).withColumn("duration_seconds", F.col("_q") * 1000).drop("_q")


def s_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("workflow_run_id"),
        F.col("o_orderkey").alias("job_id"),
        F.col("o_orderpriority").alias("job_name"),
        *[c.alias(n) for n, c in _order_state().items()],
        F.col("o_orderdate").alias("started_at"),
        F.timestamp_add("DAY", F.col("o_orderkey") % 7, F.col("o_orderdate")).alias("completed_at"),
        F.concat(F.lit("runner-"), F.col("o_orderkey") % 10).alias("runner_name"),
    )


def s_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    name = F.when(segment == "MACHINERY", "Lint").when(segment == "BUILDING", "Test Suite").otherwise(segment)
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("workflow_run_id"),
        name.alias("workflow_name"),
        segment.alias("head_branch"),
        F.concat(F.lit("sha"), "c_custkey").alias("head_sha"),
        F.concat(F.lit("evt_"), F.col("c_nationkey") % 4).alias("event_type"),
        F.lit("completed").alias("status"),
        F.when(F.col("c_custkey") % 3 == 0, "failure").otherwise("success").alias("conclusion"),
        F.col("c_name").alias("triggered_by"),
        F.lit("2024-01-01 00:00:00").cast(TIMESTAMP).alias("created_at"),
        F.lit("2024-01-02 00:00:00").cast(TIMESTAMP).alias("updated_at"),
        F.lit(1).cast("bigint").alias("run_attempt"),
    )


def s_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "stg_workflow_runs": s_runs(spark, sf_dir),
        "stg_jobs": s_jobs(spark, sf_dir),
        "stg_steps": s_steps(spark, sf_dir),
    }


def _iso(ts: Column) -> Column:
    return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def nested_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N as a bronze table, written by the first query of a session that asks for it."""
    home = (spark.sparkContext.applicationId, sf_dir)
    if home not in _BRONZE:
        path = scratch_dir(spark, "nested")
        nested_payloads(spark, sf_dir).write.parquet(path)
        _BRONZE[home] = path
    return spark.read.parquet(_BRONZE[home])


_BRONZE: dict[tuple[str, str], str] = {}


def nested_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N: one payload per order, with its at most seven lines as jobs.

    Every kind of gap occurs. Orders: no ``jobs`` key, empty list or null, by the last digit of the key;
    a NULL run name for one priority. Jobs: open ones without conclusion and end, unnamed ones, line 6
    without runner. Steps by line: 1 and 2 have two, 3 has null, 4 an empty list, 5 no key, 6 one
    without a number, 7 one without a conclusion.
    """
    lines = _lines_with_parts(spark, sf_dir).select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_linenumber").alias("line"),
        "p_name",
        _job_id().alias("id"),
        F.concat(F.lit("runner-"), "l_suppkey").alias("runner"),
        *[c.alias(n) for n, c in _line_state().items()],
    )
    # the lines were reduced to one per line number, so a group has at most seven; they are dealt out before they become
    # payloads, which are many times as large
    own = F.sort_array(F.collect_list(F.struct(*[c for c in lines.columns if c != "o_orderkey"])))
    lists = lines.repartition("o_orderkey").groupBy("o_orderkey").agg(own.alias("lines"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_name")
    orders = table(spark, sf_dir, "orders").join(customers, "o_custkey").join(lists, "o_orderkey", "left")
    digit = F.col("o_orderkey") % 10
    found = F.coalesce(F.transform("lines", _nested_job), F.array().cast("array<variant>"))
    listed = F.when(digit == 2, F.array().cast("array<variant>")).when(digit != 3, found)
    order_state = _order_state()
    created = _iso(F.col("o_orderdate"))
    updated = F.timestamp_add("DAY", digit, F.col("o_orderdate"))
    run = [
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("name"),
        F.col("c_mktsegment").alias("head_branch"),
        F.concat(F.lit("sha"), "o_custkey").alias("head_sha"),
        F.lit("push").alias("event"),
        order_state["status"].alias("status"),
        order_state["conclusion"].alias("conclusion"),
        F.struct(F.col("c_name").alias("login")).alias("actor"),
        created.alias("created_at"),
        _iso(updated).alias("updated_at"),
        created.alias("run_started_at"),
        F.lit(1).alias("run_attempt"),
    ]
    whole = F.when(digit != 1, _object(*run, listed.alias("jobs"))).otherwise(_object(*run))
    return orders.select(
        F.col("o_orderkey").alias("run_id"),
        F.lit(1).cast("bigint").alias("run_attempt"),
        updated.alias("updated_at"),
        whole.alias("raw_payload"),
        F.lit("sample").alias("source_file_name"),
        F.lit("2024-01-01 00:00:00").cast(TIMESTAMP).alias("loaded_at"),
        F.to_date("o_orderdate").alias("created_date"),
    )


def _object(*members: Column) -> Column:
    """A VARIANT object; a NULL member is JSON null."""
    return F.to_variant_object(F.struct(*members))


def _nested_job(own: Column) -> Column:
    """The job of a line, a struct of N's columns."""
    line, name, conclusion = own["line"], own["p_name"], own["conclusion"]
    is_open = conclusion == "cancelled"
    started, ended = _iso(own["started_at"]), _iso(own["completed_at"])
    ring = F.element_at(F.split(name, " "), 2) == "ring"

    def step(number: Column, conclusion: Column) -> Column:
        return F.struct(
            number.cast("int").alias("number"),
            _step_name(name).alias("name"),
            own["status"].alias("status"),
            conclusion.cast("string").alias("conclusion"),
            started.alias("started_at"),
            ended.alias("completed_at"),
        )

    one, two, none = F.lit(1), F.lit(2), F.lit(None)
    some = F.array(step(one, F.lit("success")), step(two, conclusion))
    # line 3: null
    steps = (
        F.when(line <= 2, some)
        .when(line == 4, F.slice(some, 1, 0))
        .when(line == 6, F.array(step(none, conclusion)))
        .when(line >= 7, F.array(step(one, none)))
    ).alias("steps")
    job = [
        own["id"].alias("id"),
        F.when(~ring, name).alias("name"),
        own["status"].alias("status"),
        F.when(~is_open, conclusion).alias("conclusion"),
        started.alias("started_at"),
        F.when(~is_open, ended).alias("completed_at"),
    ]
    runner = own["runner"].alias("runner_name")
    # a key that is missing is not one that is null
    with_steps = F.when((line != 6) & runner.isNotNull(), _object(*job, runner, steps)).otherwise(_object(*job, steps))
    without = F.when(runner.isNotNull(), _object(*job, runner)).otherwise(_object(*job))
    return F.when(line != 5, with_steps).when(line == 5, without).otherwise(_object(*job))


def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R in the shape the runs endpoint gives it."""
    return runs(spark, sf_dir).select(
        F.col("workflow_run_id").alias("id"),
        F.col("workflow_name").alias("name"),
        "head_branch",
        "head_sha",
        F.col("event_type").alias("event"),
        "status",
        "conclusion",
        F.struct(F.col("triggered_by").alias("login")).alias("actor"),
        _iso(F.col("created_at")).alias("created_at"),
        _iso(F.col("updated_at")).alias("updated_at"),
        _iso(F.col("created_at")).alias("run_started_at"),
        "run_attempt",
    )


def move_file(spark: SparkSession, pattern: str, path: str) -> None:
    """Give the one file that the pattern names another place and name."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path(path).getParent())
    fs.rename(fs.globStatus(hadoop_path(pattern))[0].getPath(), hadoop_path(path))


def event_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E: one step per event, starting and ending between whole seconds."""
    millis = F.round(F.col("value") * 1000).cast("bigint")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "failure").otherwise("success").alias("conclusion"),
        F.col("ts").alias("started_at"),
        F.timestamp_add("MICROSECOND", millis * 1000, F.col("ts")).alias("completed_at"),
    )


# Rule table for D: overlapping patterns and priorities.
SAMPLE_RULES = (
    ("%license%", "License Notice", "Legal", 1, "Check the license header"),
    ("%test%", "Test Text", "Backend Team", 2, "Read the test report"),
    ("%the%of%", "Common Prose", "Docs Team", 3, "Nothing to fix"),
    ("%de%la%", "Romance Prose", "Docs Team", 3, "Ask a translator"),
    ("%no-such-token%", "Never", "Nobody", 1, "Unreachable"),
)
#: A rule whose fields need quotation marks in a CSV.
QUOTED_RULE = ('%, and%', 'Lists, "and" more', 'Docs "A", Team', 2, 'Say "and", once')

#: Beginnings of words in the sample documents: pairs of them make a long rule table.
SYLLABLES = tuple("th en er on an re in ti es or st ed to it is ha".split())
