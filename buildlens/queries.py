"""Every operator as a query over the sample tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from buildlens import samples, schemas
from buildlens.functions import payload, scalars
from buildlens.operators import classify, dedupe, delta, merge, pattern_index, quality
from buildlens.plans import bronze, build, gold, incremental, insight, refresh, silver
from buildlens.session import scratch_dir
from buildlens.sources import lake
from buildlens.sources.rules import read_rules
from buildlens.streaming import ingest, state, status

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2001-08-01"
LOADED_AT = "2024-01-01 00:00:00"
LANDED_AT = datetime(2024, 1, 1)
REPOSITORY = ["head_branch", "workflow_name"]


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# Runs, jobs and steps


@query
def fct_workflow_runs(spark, sf):
    return gold.fct_workflow_runs(samples.runs(spark, sf), samples.jobs(spark, sf))


@query
def fct_step_executions(spark, sf):
    t = samples.s_tables(spark, sf)
    return gold.fct_step_executions(t["stg_steps"], t["stg_jobs"], t["stg_workflow_runs"])


@query
def stg_failed_logs(spark, sf):
    return silver.failed_logs(samples.s_steps(spark, sf))


def _events(spark, sf, **options):
    t = samples.s_tables(spark, sf)
    return gold.int_failure_events(t["stg_steps"], t["stg_jobs"], t["stg_workflow_runs"], **options)


def _failures(spark, sf):
    return gold.fct_actionable_failures(_events(spark, sf))


@query
def int_failure_events(spark, sf):
    return _events(spark, sf)


@query
def failed_steps_only(spark, sf):
    return _events(spark, sf, failed_steps_only=True)


@query
def fct_actionable_failures(spark, sf):
    return _failures(spark, sf)


@query
def dim_repositories(spark, sf):
    return gold.dim_repositories(samples.runs(spark, sf))


@query
def dim_commits(spark, sf):
    return gold.dim_commits(samples.runs(spark, sf))


@query
def dim_error_categories(spark, sf):
    return gold.dim_error_categories(silver.failed_logs(samples.s_steps(spark, sf)))


@query
def pass_rate(spark, sf):
    return gold.pass_rate(samples.runs(spark, sf))


@query
def step_duration_stats(spark, sf):
    return gold.step_duration_stats(fct_step_executions(spark, sf))


@query
def step_duration_histogram(spark, sf):
    return gold.step_duration_histogram(fct_step_executions(spark, sf), 10_000)


@query
def duration_seconds(spark, sf):
    steps = samples.event_steps(spark, sf)
    return steps.select(
        "event_id", scalars.duration_seconds(F.col("started_at"), F.col("completed_at")).alias("duration_seconds")
    )


# Nested payloads


@query
def stg_workflow_runs(spark, sf):
    return silver.workflow_runs(samples.nested_bronze(spark, sf))


@query
def stg_jobs(spark, sf):
    return silver.jobs(samples.nested_bronze(spark, sf)).drop("raw_steps_array")


@query
def stg_jobs_strict(spark, sf):
    return silver.jobs(samples.nested_bronze(spark, sf), synthesize=False).drop("raw_steps_array")


@query
def stg_steps(spark, sf):
    return silver.steps(silver.jobs(samples.nested_bronze(spark, sf)))


@query
def attach_jobs(spark, sf):
    return silver.attach_jobs(samples.runs(spark, sf), lake.tag_jobs(samples.job_records(spark, sf)))


@query
def composite_keys(spark, sf):
    jobs = lake.tag_jobs(samples.job_records(spark, sf)).select("job_id", "run_id", "composite_job_key", "run_composite_key")
    runs = lake.tag_runs(samples.run_records(spark, sf), "head_branch", "name")
    runs = runs.select(F.col("composite_key").alias("run_composite_key"), "repo_owner", "repo_name")
    return jobs.join(runs, "run_composite_key")


# Dedupe, merge and audit

LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate"]


def _lines(spark, sf):
    return samples.table(spark, sf, "lineitem").select(*LINE_COLUMNS)


def _batch(spark, sf, flag):
    """The lines of one return flag as a load batch, one row per key."""
    lines = _lines(spark, sf).filter(F.col("l_returnflag") == flag)
    return dedupe.latest_per_key(lines, samples.LINE_KEYS, samples.line_order())


@query
def latest_per_key(spark, sf):
    return dedupe.latest_per_key(_lines(spark, sf), samples.LINE_KEYS, samples.line_order())


@query
def merge_upsert(spark, sf):
    first, second, third = (_batch(spark, sf, flag) for flag in "ANR")
    return merge.upsert(merge.upsert(first, second, samples.LINE_KEYS), third, samples.LINE_KEYS)


@query
def merge_idempotent(spark, sf):
    batch = _batch(spark, sf, "R")
    merged = merge_upsert(spark, sf)
    return merge.upsert(merge.upsert(merged, batch, samples.LINE_KEYS), batch, samples.LINE_KEYS)


def _status_events(spark, sf, *flags):
    batch = _lines(spark, sf).filter(F.col("l_returnflag").isin(*flags))
    latest = dedupe.latest_per_key(batch, samples.LINE_KEYS, samples.line_order())
    return latest.select(
        *samples.LINE_KEYS, F.col("l_linestatus").alias("status"), F.col("l_returnflag").alias("conclusion"),
        F.col("l_shipdate").alias("updated_at"), "l_partkey",
    )


@query
def late_reconcile(spark, sf):
    late = _status_events(spark, sf, "R").drop("l_partkey")
    return merge.reconcile(_status_events(spark, sf, "A", "N"), late, samples.LINE_KEYS)


@query
def late_reconcile_newer(spark, sf):
    late = _status_events(spark, sf, "R").drop("l_partkey")
    return merge.reconcile(_status_events(spark, sf, "A", "N"), late, samples.LINE_KEYS, only_if_newer="updated_at")


@query
def bronze_audit(spark, sf):
    return merge.audit(samples.table(spark, sf, "lineitem"), samples.LINE_KEYS)


# Classification


@query
def unclassified_worklist(spark, sf):
    return classify.unclassified(_failures(spark, sf)).select(
        "job_id", "step_number", "failure_reason", "step_name", "workflow_name"
    )


@query
def failure_context(spark, sf):
    return classify.with_context(_failures(spark, sf)).select("job_id", "step_number", "failure_context")


@query
def classify_by_rule_table(spark, sf):
    rules = spark.createDataFrame(list(samples.SAMPLE_RULES), schemas.RULE_TABLE_SCHEMA)
    logs = samples.table(spark, sf, "documents").select("doc_id", "text")
    return classify.classify_by_rule_table(logs, rules, "text").drop("text")


@query
def classify_by_csv_rules(spark, sf):
    """The rule table as a CSV seed, with commas and quotation marks in its fields."""
    seed = f"{scratch_dir(spark, 'seed')}/rules"
    table = spark.createDataFrame([*samples.SAMPLE_RULES, samples.QUOTED_RULE], schemas.RULE_TABLE_SCHEMA)
    table.write.option("header", True).option("escape", '"').csv(seed)
    logs = samples.table(spark, sf, "documents").select("doc_id", "text")
    return classify.classify_by_rule_table(logs, read_rules(spark, seed), "text").drop("text")


@query
def classify_by_long_rule_table(spark, sf):
    """Hundreds of patterns, some equal but for their priority, over logs whose keys repeat or are NULL."""
    rules = [
        (f"% {a}{b}%", f"Category {i % 7}", f"Team {b}", (i * 7 + j) % 40, f"Fix {a}")
        for i, a in enumerate(samples.SYLLABLES)
        for j, b in enumerate(samples.SYLLABLES)
    ]
    rules += [(pattern, "Again", "Team", priority + 1, "Fix") for pattern, _, _, priority, _ in rules[:50]]
    logs = samples.table(spark, sf, "documents").select(
        F.when(F.col("doc_id") % 5 != 0, F.floor(F.col("doc_id") / 3)).alias("log_key"), "text"
    )
    table = spark.createDataFrame(rules, schemas.RULE_TABLE_SCHEMA)
    return pattern_index.classify_by_pattern_index(logs, table, "text").drop("text")


@query
def classify_by_passage_rules(spark, sf):
    """A rule table as large as the data make it: every passage is a pattern of its first and its later words."""

    def words(start):
        return F.regexp_replace(F.substring("text", start, 30), r"([\\%_])", r"\\$1")

    passages = samples.table(spark, sf, "benchmark").select(
        F.concat(F.lit("%"), words(1), F.lit("%"), words(41), F.lit("%")).alias("error_pattern"),
        F.concat(F.lit("Passage "), "item_id").alias("category"),
        F.when(F.col("item_id") % 3 != 0, F.lit("Team")).alias("assigned_team"),
        (F.col("item_id") % 7).cast("int").alias("priority"),
        F.lit("Leave it out").alias("recommended_fix"),
    )
    logs = samples.table(spark, sf, "documents").select("doc_id", "text")
    return pattern_index.classify_by_pattern_index(logs, passages, "text").drop("text")


@query
def fallback_classify(spark, sf):
    return fallback_classify_all(spark, sf).select("job_id", "step_number", *classify.RESULT_FIELDS, "classification_source")


@query
def triage_remembered(spark, sf):
    answers = f"{scratch_dir(spark, 'answers')}/contexts"
    classifier = classify.offline_classifier()
    failures = _failures(spark, sf)
    # the first round sees the rows that are not failures themselves, the second all, reusing its answers
    refresh.triage(spark, failures.filter(F.col("failure_reason") == "success"), classifier, answers)
    done = refresh.triage(spark, failures, classifier, answers)
    return done.select("job_id", "step_number", *classify.RESULT_FIELDS, "classification_source")


@query
def apply_classifications(spark, sf):
    failures = _failures(spark, sf)
    # answers for the failed steps of runs that no rule tagged, looked up by key
    results = classify.unclassified(failures).filter(F.col("failure_reason") == "failure")
    results = results.select(
        "job_id",
        "step_number",
        F.concat(F.lit("Category "), "event_type").alias("category"),
        F.concat(F.lit("Team "), "head_branch").alias("assigned_team"),
        F.concat(F.lit("Ask "), "triggered_by").alias("recommended_fix"),
    )
    return classify.apply_classifications(failures, results)


@query
def classification_coverage(spark, sf):
    return classify.coverage(_failures(spark, sf))


@query
def append_partial(spark, sf):
    open_runs = samples.runs(spark, sf).filter(F.col("status") == "in_progress")
    rows = open_runs.select(
        "workflow_run_id",
        F.col("workflow_run_id").alias("job_id"),
        F.lit(1).alias("step_number"),
        "workflow_name",
        F.lit("stuck").alias("failure_reason"),
        F.lit(99).alias("priority"),
        F.lit("unclassified").alias("category"),
        F.lit(schemas.TAG_UNCLASSIFIED).alias("classification_source"),
    )
    return merge.append_partial(_failures(spark, sf), rows)


# Questions of the dashboard


def _board(spark, sf):
    return insight.normalize(_failures(spark, sf))


@query
def severity(spark, sf):
    return _board(spark, sf).select("JOB_ID", "STEP_NUMBER", "PRIORITY", "SEVERITY")


@query
def triage_queue(spark, sf):
    return insight.triage_queue(_board(spark, sf))


@query
def failure_drilldown(spark, sf):
    # without a fix column, so that its default shows
    return insight.drilldown(_board(spark, sf).drop("RECOMMENDED_FIX"))


@query
def facet_filter(spark, sf):
    teams, sources = ["Backend Engineering", "Core Maintainers"], [schemas.TAG_RULE]
    chosen = insight.facet_filter(
        _board(spark, sf), ASSIGNED_TEAM=teams, FAILURE_CATEGORY=[], CLASSIFICATION_SOURCE=sources
    )
    return chosen.select("JOB_ID", "STEP_NUMBER", "ASSIGNED_TEAM", "CLASSIFICATION_SOURCE")


@query
def facet_values(spark, sf):
    return insight.facet_values(_board(spark, sf))


@query
def failure_kpis(spark, sf):
    return insight.kpis(insight.normalize(fallback_classify_all(spark, sf)))


def fallback_classify_all(spark, sf):
    answers = f"{scratch_dir(spark, 'answers')}/contexts"
    return refresh.triage(spark, _failures(spark, sf), classify.offline_classifier(), answers)


@query
def counts_by_category(spark, sf):
    return insight.value_counts(_board(spark, sf), "FAILURE_CATEGORY", "category", "failures")


@query
def counts_by_team(spark, sf):
    return insight.value_counts(_board(spark, sf), "ASSIGNED_TEAM", "team", "incidents")


@query
def ranked_teams(spark, sf):
    """The place of each team in the order in which the counts come."""
    ordered = insight.value_counts(_board(spark, sf), "ASSIGNED_TEAM", "team", "incidents")
    # numbers that grow with the rows as they come, whatever the partitions; one row for each team
    come = Window.orderBy("_come")
    return ordered.withColumn("_come", F.monotonically_increasing_id()).select(
        "team", "incidents", F.row_number().over(come).alias("place")
    )


@query
def category_share(spark, sf):
    return insight.value_share(_board(spark, sf), "FAILURE_CATEGORY", "category")


@query
def lookback_window(spark, sf):
    recent = insight.lookback(samples.runs(spark, sf), AS_OF, 60)
    return recent.select("workflow_run_id", "created_at", "head_branch", "workflow_name")


@query
def recent_runs(spark, sf):
    return insight.recent_runs(samples.runs(spark, sf), REPOSITORY).select(*REPOSITORY, "workflow_run_id", "created_at")


@query
def source_profile(spark, sf):
    return insight.source_profile(insight.lookback(samples.runs(spark, sf), AS_OF, 60), REPOSITORY)


@query
def failed_jobs_per_run(spark, sf):
    return insight.failed_jobs_per_run(samples.jobs(spark, sf))


# Lake and streams


def _tagged(spark, sf):
    return lake.tag_runs(samples.run_records(spark, sf), "head_branch", "name")


@query
def land_manifest(spark, sf):
    return lake.manifest(_tagged(spark, sf), "workflow_runs")


@query
def payload_fingerprint(spark, sf):
    lines = samples.table(spark, sf, "lineitem")
    digests = lines.withColumn("_digest", scalars.record_hash(lines))
    return digests.groupBy("l_returnflag", "l_linestatus").agg(
        scalars.batch_fingerprint(F.col("_digest")).alias("payload_hash")
    )


def _land(spark, sf, label):
    root = f"{scratch_dir(spark, label)}/lake"
    lake.land(_tagged(spark, sf), root, "workflow_runs", extracted_at=LANDED_AT)
    return root


@query
def land_by_status(spark, sf):
    """The runs of each status land in a lake of their own; of a status that no run has, nothing lands."""
    runs, landed = _tagged(spark, sf), []
    for name in ("completed", "in_progress", "lost"):
        root = f"{scratch_dir(spark, 'land')}/lake"
        path = lake.land(runs.filter(F.col("status") == name), root, "workflow_runs", extracted_at=LANDED_AT)
        if path:
            envelopes = quality.envelope_counts(lake.read_envelopes(spark, path, "workflow_runs"))
            counted = envelopes.agg(F.sum("record_count").alias("records"))
        else:
            counted = spark.range(0).agg(F.count("*").alias("records"))
        landed.append(counted.select(F.lit(name).alias("status"), F.lit(path == root).alias("landed"), "records"))
    return reduce(DataFrame.unionByName, landed)


@query
def lake_roundtrip(spark, sf):
    envelopes = lake.read_envelopes(spark, _land(spark, sf, "roundtrip"), "workflow_runs")
    records = lake.explode_records(envelopes.withColumns(lake.path_parts()))
    return silver.workflow_runs(records, lineage=("lake_owner", "lake_repo", "lake_entity", "lake_date"))


@query
def dq_envelope_counts(spark, sf):
    checked = quality.envelope_counts(lake.read_envelopes(spark, _land(spark, sf, "envelopes"), "workflow_runs"))
    return checked.agg(
        F.sum("record_count").alias("record_count"),
        F.sum("data_count").alias("data_count"),
        F.count_if(~F.col("matches")).alias("mismatches"),
        (F.max("record_count") <= lake.MAX_ENVELOPE_RECORDS).alias("bounded"),
    )


def _run_lines(spark, sf):
    """An envelope line for each run of R, and a number of the run."""
    record = F.struct(
        F.col("workflow_run_id").alias("id"), "run_attempt", "status", "created_at", "updated_at"
    )
    line = F.to_json(F.struct(F.concat(F.lit("e"), "workflow_run_id").alias("execution_id"), F.array(record).alias("data")))
    return samples.runs(spark, sf).select(F.col("workflow_run_id").alias("n"), line.alias("value"))


@query
def load_quarantine(spark, sf):
    """Lines cut short, attempts and times that cannot be read, ids that are missing: what is merged and what is not."""
    base, n = scratch_dir(spark, "quarantine"), F.col("n") % 50
    broken = (
        F.when(n == 0, F.expr("substring(value, 1, length(value) - 3)"))
        .when(n == 1, F.regexp_replace("value", '"run_attempt":1', '"run_attempt":"first"'))
        .when(n == 2, F.regexp_replace("value", '"created_at":"[^"]*"', '"created_at":"soon"'))
        .when(n == 3, F.regexp_replace("value", '"id":[0-9]+', '"id":null'))
        .otherwise(F.col("value"))
    )
    lines = _run_lines(spark, sf).select(broken.alias("value"))
    lines.write.option("compression", "gzip").text(f"{base}/lake/acme/app/workflow_runs/2024/01/01")
    rejected = bronze.load(spark, f"{base}/lake", f"{base}/bronze", grain="year")
    merged = bronze.read(spark, f"{base}/bronze").agg(F.lit("merged").alias("outcome"), F.count("*").alias("n"))
    return merged.union(rejected.groupBy("reject").agg(F.count("*")))


@query
def load_unreadable_file(spark, sf):
    """Runs landed over three days, the last day's file named as packed but plain: the others are loaded, it is set aside."""
    base = scratch_dir(spark, "unreadable")
    lines, days = _run_lines(spark, sf), f"{base}/lake/acme/app/workflow_runs/2024/01"
    for day in range(2):
        own = lines.filter(F.col("n") % 3 == day).select("value")
        own.write.option("compression", "gzip").text(f"{days}/0{day + 1}")
    lines.filter("n % 3 = 2").select("value").coalesce(1).write.text(f"{base}/plain")
    samples.move_file(spark, f"{base}/plain/part-*", f"{days}/03/runs.jsonl.gz")
    rejected = bronze.load(spark, f"{base}/lake", f"{base}/bronze", grain="year")
    merged = bronze.read(spark, f"{base}/bronze").agg(F.lit("merged").alias("outcome"), F.count("*").alias("n"))
    return merged.union(rejected.groupBy("reject").agg(F.count("*")))


@query
def load_since(spark, sf):
    """Runs landed over three days, loaded from the second on."""
    base = scratch_dir(spark, "since")
    lines = _run_lines(spark, sf)
    for day in range(3):
        own = lines.filter(F.col("n") % 3 == day).select("value")
        own.write.option("compression", "gzip").text(f"{base}/lake/acme/app/workflow_runs/2024/01/0{day + 1}")
    bronze.load(spark, f"{base}/lake", f"{base}/bronze", grain="year", since=date(2024, 1, 2))
    return bronze.read(spark, f"{base}/bronze").select("run_id", "run_attempt")


@query
def bronze_upsert(spark, sf):
    """Two batches merged into a table whose partitions are texts with leading zeros."""
    path = f"{scratch_dir(spark, 'upsert')}/lines"
    lines = samples.table(spark, sf, "lineitem").select(*samples.LINE_KEYS).distinct()
    lines = lines.withColumn("bucket", F.lpad((F.col("l_orderkey") % 12).cast("string"), 2, "0"))
    first = lines.withColumn("state", F.lit("first"))
    for batch in (first, lines.filter("l_linenumber <= 2").withColumn("state", F.lit("second"))):
        merge.upsert_path(spark, path, batch, samples.LINE_KEYS, "bucket")
    return merge.read_table(spark, path, first.schema, "bucket")


def _line_loads(spark, sf):
    """All lines as three loads, one for each return flag, one row per key; the last one wins."""
    lines = samples.table(spark, sf, "lineitem").withColumn("bucket", F.lpad((F.col("l_orderkey") % 12).cast("string"), 2, "0"))
    for flag in "ANR":
        yield dedupe.latest_per_key(lines.filter(F.col("l_returnflag") == flag), samples.LINE_KEYS, samples.line_order())


@query
def bronze_delta(spark, sf):
    """Three appended loads, the first compacted, read between load and compaction and after it."""
    path, found = f"{scratch_dir(spark, 'delta')}/lines", []
    for i, load in enumerate(_line_loads(spark, sf)):
        delta.append(spark, path, load, load.schema, samples.LINE_KEYS)
        if not i:
            delta.compact(spark, path, load.schema, samples.LINE_KEYS, "bucket")
    for stage in ("loaded", "compacted"):
        rows = delta.read(spark, path, load.schema, samples.LINE_KEYS, "bucket").withColumn("stage", F.lit(stage))
        # written, as compaction takes away what the first reading reads
        rows.write.parquet(f"{path}-{stage}")
        found.append(spark.read.schema(rows.schema).parquet(f"{path}-{stage}"))
        delta.compact(spark, path, load.schema, samples.LINE_KEYS, "bucket")
    return found[0].unionByName(found[1])


@query
def upsert_by_filter(spark, sf):
    """Loads merged into a table kept by month of shipping; the partition of a known line is found by the files' filters."""
    path = f"{scratch_dir(spark, 'filters')}/lines"
    for load in _line_loads(spark, sf):
        load = load.withColumn("month", F.date_format("l_shipdate", "yyyy-MM")).drop("bucket")
        merge.upsert_path(spark, path, load, samples.LINE_KEYS, "month", schema=load.schema)
    return spark.read.schema(load.schema).parquet(path)


@query
def refresh_incremental(spark, sf):
    """All runs built once, one year of them still queued; then that year's runs arrive, and its tables are built anew."""
    base = scratch_dir(spark, "rounds")
    rows = samples.nested_bronze(spark, sf).withColumn("created_date", F.trunc("created_date", "year"))
    late = F.year("created_date") == 1995
    queued = F.parse_json(F.to_json(F.struct(F.col("run_id").alias("id"), "run_attempt", F.lit("queued").alias("status"))))
    first = rows.withColumn("raw_payload", F.when(late, queued).otherwise(F.col("raw_payload")))
    for number, batch in enumerate((first, rows.filter(late))):
        merge.upsert_path(spark, f"{base}/bronze", batch, schemas.BRONZE_KEYS, schema=rows.schema)
        batch.select("run_id").write.parquet(f"{base}/runs-{number}")
        held = spark.read.schema(rows.schema).parquet(f"{base}/bronze")
        runs = spark.read.parquet(f"{base}/runs-{number}")
        days = incremental.touched_days(spark, held, runs, f"{base}/ties")
        tables, _ = incremental.build_days(spark, held, f"{base}/tables", days)
    return tables["fct_workflow_runs"]


@query
def dim_commits_by_days(spark, sf):
    runs = samples.runs(spark, sf).withColumn("created_date", F.to_date("created_at"))
    return gold.commits_of(gold.commit_days(runs))


@query
def dim_error_categories_by_days(spark, sf):
    """Runs and jobs that fail on several days count once."""
    steps = samples.s_steps(spark, sf).withColumn("created_date", F.to_date("started_at"))
    return gold.errors_of(gold.error_days(silver.failed_logs(steps, ("created_date",))))


@query
def quarantine_jobs(spark, sf):
    """Jobs whose start, and steps whose number cannot be read: what is typed and what is set aside."""
    n, text = F.col("run_id") % 50, F.to_json("raw_payload")
    broken = F.when(n == 0, F.regexp_replace(text, '"started_at":"[^"]*"', '"started_at":"soon"')).when(
        n == 4, F.regexp_replace(text, '"number":1', '"number":"first"')
    )
    rows = samples.nested_bronze(spark, sf).withColumn("raw_payload", F.coalesce(F.parse_json(broken), F.col("raw_payload")))
    # both levels are written: each part that is counted would be made anew from the payloads
    base = scratch_dir(spark, "judged")
    jobs, lost_jobs = silver.split_rejected(build.write(silver.jobs(rows, strict=False), f"{base}/jobs", "judged_jobs"))
    judged = silver.steps(jobs, strict=False).select("reject")
    steps, lost_steps = silver.split_rejected(build.write(judged, f"{base}/steps", "judged_steps"))
    parts = {("job", "read"): jobs, ("job", "rejected"): lost_jobs, ("step", "read"): steps, ("step", "rejected"): lost_steps}
    counts = [
        part.agg(F.lit(level).alias("level"), F.lit(outcome).alias("outcome"), F.count("*").alias("n"))
        for (level, outcome), part in parts.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def latest_attempts(spark, sf):
    """Runs of one to three attempts; the highest stands for the run."""
    times = F.explode(F.sequence(F.lit(1), (F.col("run_id") % 3 + 1).cast("int")))
    member = lambda c: F.to_json(F.struct("id", c.alias("run_attempt"), "status"))
    runs = samples.runs(spark, sf).select(F.col("workflow_run_id").alias("run_id"), F.col("workflow_run_id").alias("id"), "status")
    every = runs.select("*", times.alias("run_attempt")).select(
        "run_id", F.col("run_attempt").cast("bigint").alias("run_attempt"), F.parse_json(member(F.col("run_attempt"))).alias("raw_payload")
    )
    typed = silver.workflow_runs(every, "latest", lineage=())
    key = scalars.composite_key(F.col("workflow_run_id"), attempt=F.col("run_attempt"))
    return typed.select("workflow_run_id", "run_attempt", "status", key.alias("composite_key"))


@query
def build_from_jobs_entity(spark, sf):
    """Runs and jobs landed as two entities, loaded, and built to typed jobs; a run without any stands for one."""
    base = scratch_dir(spark, "entities")
    lake.land(_tagged(spark, sf), f"{base}/lake", "workflow_runs", extracted_at=LANDED_AT)
    jobs = lake.tag_jobs(samples.job_records(spark, sf)).withColumnRenamed("job_name", "name")
    jobs = jobs.withColumns({"repo_owner": F.lit("acme"), "repo_name": F.lit("app")})
    lake.land(jobs, f"{base}/lake", "jobs", extracted_at=LANDED_AT)
    for entity in ("workflow_runs", "jobs"):
        bronze.load(spark, f"{base}/lake", f"{base}/{entity}", entity, grain="year")
    tables = [bronze.read(spark, f"{base}/{entity}") for entity in ("workflow_runs", "jobs")]
    typed = build.from_bronze(tables[0], landed=tables[1])["stg_jobs"]
    lineage = F.when(F.col("source_file_name").contains("entity=jobs"), "job").otherwise("run")
    return typed.withColumn("lineage", lineage).drop("source_file_name", "loaded_at")


@query
def stream_ingest(spark, sf):
    base = scratch_dir(spark, "ingest")
    runs = _tagged(spark, sf)
    loaded = F.lit(LOADED_AT).cast(payload.TIMESTAMP)
    # finished runs land first; then all runs land, so that the second batch repeats most keys
    for drop in (runs.filter(F.col("status") == "completed"), runs):
        lake.land(drop, f"{base}/lake", "workflow_runs", extracted_at=LANDED_AT)
        ingest.ingest_available(
            spark, f"{base}/lake", f"{base}/bronze", f"{base}/checkpoint", loaded_at=loaded, grain="year"
        )
    return silver.workflow_runs(bronze.read(spark, f"{base}/bronze")).drop("source_file_name", "loaded_at")


@query
def stream_status(spark, sf):
    base = scratch_dir(spark, "status")
    schema = samples.table(spark, sf, "lineitem").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet")
    events = reader.parquet(sf).select(
        *LINE_COLUMNS, F.floor(F.col("l_orderkey") / 1_000_000).cast("int").alias("key_range")
    )
    status.track_status(
        spark, events, f"{base}/status", f"{base}/checkpoint", samples.LINE_KEYS, samples.line_order(), "key_range"
    )
    return spark.read.parquet(f"{base}/status").select(*LINE_COLUMNS)


@query
def stream_state(spark, sf):
    """The newest event of each line from a state store, and which lines were open for 30 days at the last event."""
    base = scratch_dir(spark, "state")
    schema = samples.table(spark, sf, "lineitem").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet")
    tracking = state.Tracking(
        samples.LINE_KEYS, ["l_shipdate", "l_partkey", "l_suppkey"], "l_shipdate", "l_linestatus", "O", 30 * 86_400
    )
    state.track_state(spark, reader.parquet(sf).select(*LINE_COLUMNS), f"{base}/changes", f"{base}/checkpoint", tracking)
    return state.current(spark, f"{base}/changes", tracking)


@query
def quarantine_split(spark, sf):
    cut = F.expr("substring(props, 1, length(props) - 1)")
    # every fiftieth line is broken
    lines = samples.table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 50 == 0, cut).otherwise(F.col("props")).alias("line")
    )
    good, bad = quality.split_malformed(lines, "line")
    kept = good.select(
        "event_id", payload.field("payload", "k", "bigint").alias("k"), F.lit(None).cast("string").alias("rejected_line")
    )
    return kept.unionByName(bad.select("event_id", F.lit(None).cast("bigint").alias("k"), F.col("line").alias("rejected_line")))


# Data checks


@query
def dq_not_null(spark, sf):
    runs = quality.null_counts(samples.runs(spark, sf), ["workflow_run_id", "status", "head_sha", "conclusion"])
    steps = quality.null_counts(samples.s_steps(spark, sf), ["job_id", "step_number", "step_name", "conclusion"])
    return runs.withColumn("table_name", F.lit("runs")).unionByName(steps.withColumn("table_name", F.lit("steps")))


@query
def dq_unique(spark, sf):
    lines = quality.duplicates(samples.table(spark, sf, "lineitem"), samples.LINE_KEYS)
    runs = quality.duplicates(samples.runs(spark, sf), ["workflow_run_id"])
    lines = lines.select(F.lit("lineitem").alias("table_name"), F.concat_ws("_", *samples.LINE_KEYS).alias("key"), "n")
    runs = runs.select(F.lit("runs").alias("table_name"), F.col("workflow_run_id").cast("string").alias("key"), "n")
    return lines.unionByName(runs)


@query
def dq_relationships(spark, sf):
    runs, jobs = samples.runs(spark, sf), samples.jobs(spark, sf)
    jobless = quality.orphans(runs, "workflow_run_id", jobs, "workflow_run_id")
    lost = quality.orphans(jobs, "workflow_run_id", runs, "workflow_run_id")
    return jobless.withColumn("child", F.lit("runs")).unionByName(lost.withColumn("child", F.lit("jobs")))


@query
def dq_no_success_classified(spark, sf):
    t = samples.s_tables(spark, sf)
    executions = gold.fct_step_executions(t["stg_steps"], t["stg_jobs"], t["stg_workflow_runs"])
    return quality.classified_successes(executions, _failures(spark, sf))


@query
def dq_suite(spark, sf):
    # the tables are built once and checked as they are written; what no write can tell is looked up after it
    nulls: dict[str, dict[str, int]] = {}
    tables = build.build_all(spark, samples.s_tables(spark, sf), scratch_dir(spark, "suite"), nulls=nulls)
    return quality.run_suite(tables, nulls=nulls)


@query
def dq_rule_lengths(spark, sf):
    """The declared limits, on a rule table with a part's comment-long name for every pattern and fix."""
    parts = samples.table(spark, sf, "part")
    long = lambda n: F.repeat(F.col("p_name"), F.lit(n))
    rules = parts.select(
        long(15).alias("error_pattern"), long(6).alias("category"), F.col("p_name").alias("assigned_team"), long(30).alias("recommended_fix")
    )
    return quality.oversized(rules, schemas.RULE_TABLE_LENGTHS)
