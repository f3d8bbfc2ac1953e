"""Upserts, late updates, appends and the partitioned table."""

import datetime
import os

import pytest
from conftest import rows
from pyarrow import parquet
from pyspark.sql import functions as F

from buildlens.operators import merge
from buildlens.plans import bronze

KEYS = ["id", "attempt"]


def frame(spark, *data, schema="id bigint, attempt bigint, state string, day date"):
    return spark.createDataFrame([(*d[:3], datetime.date.fromisoformat(d[3])) for d in data], schema)


def states(df):
    return rows(df.select("id", "attempt", "state", F.col("day").cast("string")), "id", "attempt")


def test_upsert_replaces_and_inserts(spark):
    target = frame(spark, (101, 1, "failed", "2024-01-01"), (102, 1, "success", "2024-01-01"))
    batch = frame(spark, (101, 1, "fixed", "2024-01-01"), (103, 1, "failed", "2024-01-02"))
    once = merge.upsert(target, batch, KEYS)
    assert [r[:3] for r in states(once)] == [(101, 1, "fixed"), (102, 1, "success"), (103, 1, "failed")]
    assert states(merge.upsert(once, batch, KEYS)) == states(once)


def test_null_keys_go_to_quarantine(spark):
    df = spark.createDataFrame([(1, 1), (None, 1), (2, None)], "id bigint, attempt bigint")
    good, bad = merge.split_null_keys(df, KEYS)
    assert rows(good) == [(1, 1)]
    assert bad.count() == 2


def test_reconcile_updates_known_keys_only(spark):
    target = spark.createDataFrame([(201, "in_progress", None, "10:00", "kept")], "id bigint, status string, conclusion string, at string, x string")
    late = spark.createDataFrame([(201, "completed", "failure", "10:05"), (999, "completed", "failure", "10:05")], "id bigint, status string, conclusion string, at string")
    assert rows(merge.reconcile(target, late, ["id"])) == [(201, "completed", "failure", "10:05", "kept")]
    stale = late.withColumn("at", F.lit("09:00"))
    assert rows(merge.reconcile(target, stale, ["id"]))[0][3] == "09:00"
    assert rows(merge.reconcile(target, stale, ["id"], only_if_newer="at"))[0][3] == "10:00"
    erased = late.withColumn("conclusion", F.lit(None).cast("string"))
    done = merge.reconcile(target, late, ["id"])
    assert rows(merge.reconcile(done, erased, ["id"]))[0][2] is None


def test_append_partial(spark):
    target = spark.createDataFrame([(1, "a", 2)], "id bigint, name string, priority int")
    added = merge.append_partial(target, spark.createDataFrame([(2, 99)], "id int, priority bigint"))
    assert rows(added, "id") == [(1, "a", 2), (2, None, 99)]
    assert added.schema == target.schema
    extra = spark.createDataFrame([(3, "r")], "id bigint, runner_name string")
    with pytest.raises(ValueError, match="runner_name"):
        merge.append_partial(target, extra)
    assert merge.append_partial(target, extra, evolve=True).columns == ["id", "name", "priority", "runner_name"]


def upsert(spark, path, df, **options):
    merge.upsert_path(spark, path, df, KEYS, "day", **options)
    return spark.read.parquet(path)


def test_upsert_path_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, path, frame(spark, (1, 1, "a", "2024-01-01"), (2, 1, "b", "2024-01-02"), (3, 1, "c", "2024-01-02")))
    before = {p: os.listdir(f"{path}/{p}") for p in os.listdir(path) if "=" in p}
    found = upsert(spark, path, frame(spark, (2, 1, "B", "2024-01-02"), (4, 1, "d", "2024-01-03")))
    assert [r[2] for r in states(found)] == ["a", "B", "c", "d"]
    after = {p: os.listdir(f"{path}/{p}") for p in os.listdir(path) if "=" in p}
    assert after["day=2024-01-01"] == before["day=2024-01-01"]
    assert after["day=2024-01-02"] != before["day=2024-01-02"]
    assert sorted(os.listdir(tmp_path)) == ["t"]


def test_upsert_path_keeps_a_key_in_its_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, path, frame(spark, (1, 1, "a", "2024-01-01")))
    found = upsert(spark, path, frame(spark, (1, 1, "b", "2024-02-02")))
    assert states(found) == [(1, 1, "b", "2024-01-01")]


def test_upsert_path_with_null_partition_and_empty_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    dated = frame(spark, (1, 1, "a", "2024-01-01"), (2, 1, "b", "2024-01-01"))
    undated = dated.withColumn("day", F.when(F.col("id") == 1, F.col("day")))
    upsert(spark, path, undated)
    upsert(spark, path, undated.limit(0))
    found = upsert(spark, path, undated.filter("id = 2").withColumn("state", F.lit("B")))
    assert states(found) == [(1, 1, "a", "2024-01-01"), (2, 1, "B", None)]
    found = upsert(spark, path, dated.filter("id = 2"))
    assert states(found) == [(1, 1, "a", "2024-01-01"), (2, 1, "b", None)]


def test_a_cut_off_publish_is_finished_by_the_next_run(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    upsert(spark, path, frame(spark, (1, 1, "a", "2024-01-01"), (2, 1, "b", "2024-01-02")))
    monkeypatch.setattr(merge, "_publish", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        upsert(spark, path, frame(spark, (1, 1, "A", "2024-01-01"), (2, 1, "B", "2024-01-02")))
    monkeypatch.undo()
    # half of the replacement was done when the job died
    merge.remove(spark, f"{path}/day=2024-01-01")
    found = upsert(spark, path, frame(spark, (3, 1, "c", "2024-01-03")))
    assert [r[2] for r in states(found)] == ["A", "B", "c"]
    assert merge.recover(spark, path, "day") == 0 and sorted(os.listdir(tmp_path)) == ["t"]


def test_text_partitions_keep_their_zeros(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "id bigint, attempt bigint, state string, day string"
    for state in ("a", "b"):
        batch = spark.createDataFrame([(1, 1, state, "01"), (2, 1, state, "1")], schema)
        upsert(spark, path, batch)
    assert sorted(p for p in os.listdir(path) if "=" in p) == ["day=01", "day=1"]
    table = merge.read_table(spark, path, batch.schema, "day")
    assert rows(table.select("id", "state", "day"), "id") == [(1, "b", "01"), (2, "b", "1")]


def test_new_columns_are_refused_or_added(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, path, frame(spark, (1, 1, "a", "2024-01-01"), (2, 1, "b", "2024-01-02")))
    wide = frame(spark, (2, 1, "B", "2024-01-02")).withColumn("more", F.lit(5))
    with pytest.raises(ValueError, match="more"):
        upsert(spark, path, wide)
    upsert(spark, path, wide, evolve=True)
    upsert(spark, path, frame(spark, (3, 1, "c", "2024-01-02")))
    table = merge.read_table(spark, path, wide.schema, "day")
    assert rows(table.select("id", "state", "more"), "id") == [(1, "a", None), (2, "B", 5), (3, "c", None)]


def test_audit_counts_duplicates(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "id bigint, attempt bigint")
    assert rows(merge.audit(df, KEYS)) == [(3, 2)]


def test_the_first_batch_is_staged_once(spark, tmp_path, monkeypatch):
    path, staged = str(tmp_path / "t"), []
    monkeypatch.setattr(merge, "remove", lambda _, folder: staged.append(sorted(os.listdir(folder))))
    upsert(spark, path, frame(spark, (1, 1, "a", "2024-01-01")))
    assert staged == [["merged"]]
    assert spark.read.parquet(path).count() == 1


def test_the_newest_of_a_batch_moves_no_row_whose_key_is_alone(spark, tmp_path, monkeypatch):
    # run 7 comes three times, twice at the same time; its second attempt and all others once
    data = [(i, 1, i, "f1", "e", 0) for i in range(20)] + [(7, 1, 50, "f2", "e", 1), (7, 1, 50, "f2", "e", 2), (7, 2, 1, "f1", "e", 3)]
    schema = "run_id bigint, run_attempt bigint, updated_at int, source_file_name string, envelope_id string, record_no int"
    spark.createDataFrame(data, schema).withColumn("kept", F.col("record_no")).write.parquet(f"{tmp_path}/batch")
    batch = spark.read.parquet(f"{tmp_path}/batch")
    expected = rows(bronze.latest_attempts(batch), "run_id", "run_attempt")
    assert len(expected) == 21 and (7, 1, 50, "f2", 2) in expected
    found = bronze.newest_attempts(batch, f"{tmp_path}/few")
    assert rows(found, "run_id", "run_attempt") == expected and found.columns == bronze.latest_attempts(batch).columns
    alone = bronze.newest_attempts(batch.filter("run_id <> 7"), f"{tmp_path}/none")
    assert alone.count() == 19 and "Window" not in alone._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(bronze, "REPEATED", 0)
    assert rows(bronze.newest_attempts(batch, f"{tmp_path}/many"), "run_id", "run_attempt") == expected


def staged_plans(spark, monkeypatch):
    """The plans of all frames that are staged."""
    plans, staged = [], merge._staged

    def noted(writer):
        plans.append(writer._df._jdf.queryExecution().sparkPlan().toString())
        return staged(writer)

    monkeypatch.setattr(merge, "_staged", noted)
    return plans


@pytest.mark.parametrize("fixed", [False, True])
def test_many_keys_are_not_broadcast_however_small_their_files(spark, tmp_path, monkeypatch, fixed):
    # equal rows but for the key: files of some kilobytes
    many = spark.range(2000).select("id", F.lit(1).cast("bigint").alias("attempt"), F.lit("a").alias("state"), F.lit("2024-01-01").cast("date").alias("day"))
    few = many.filter("id < 50")
    plans = staged_plans(spark, monkeypatch)
    for limit, batch, name in ((100, many, "many"), (100, few, "few")):
        monkeypatch.setattr(merge, "BROADCAST", limit, raising=False)
        path = str(tmp_path / name)
        upsert(spark, path, many)
        del plans[:]
        found = upsert(spark, path, batch.withColumn("state", F.lit("b")), fixed_partition=fixed)
        assert found.groupBy("state").count().filter("state = 'b'").first()[1] == batch.count() and found.count() == 2000
        by_key = "".join(line for plan in plans for line in plan.splitlines() if "BroadcastHashJoin" in line and "[id#" in line)
        assert bool(by_key) == (name == "few"), by_key
        # the touched partitions still are
        assert any("BroadcastHashJoin [day#" in line for line in plans[-1].splitlines())


def test_the_touched_partitions_prune_the_table_however_large_the_batch(spark, tmp_path, monkeypatch):
    days = [F.lit(f"2024-01-0{d}").cast("date").alias("day") for d in (1, 2)]
    first, second = (
        spark.range(2000 * i, 2000 * (i + 1)).select("id", F.lit(1).cast("bigint").alias("attempt"), F.lit("a").alias("state"), day)
        for i, day in enumerate(days)
    )
    upsert(spark, path := str(tmp_path / "t"), first.unionByName(second))
    plans = staged_plans(spark, monkeypatch)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # what is joined to find the days is held to be larger than this, the days are not
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        found = upsert(spark, path, second.withColumn("state", F.lit("b")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin [day#" in plans[-1] and "dynamicpruning" in plans[-1]
    assert rows(found.groupBy("day", "state").count().select("state", "count"), "state") == [("a", 2000), ("b", 2000)]


def test_staged_payloads_are_written_whole_and_the_batch_is_given_up_before_they_are_published(spark, tmp_path, monkeypatch):
    path, steps, publish = str(tmp_path / "t"), [], merge._publish
    monkeypatch.setattr(merge, "remove", lambda *_: None)
    monkeypatch.setattr(merge, "_publish", lambda *args: (steps.append("published"), publish(*args)))
    data = frame(spark, *[(i, 1, "a", "2024-01-01") for i in range(50)]).withColumn("payload", F.parse_json(F.lit('{"id": 1, "name": "x"}')))
    for _ in range(2):
        upsert(spark, path, data, done=lambda: steps.append("read"))
    # nothing was removed, so the second merge finishes the first once more
    assert steps == ["read", "published", "published", "read", "published"]

    def taken_apart(folder):
        files = [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]
        return {f.split("/")[-2] for f in files if "typed_value" in str(parquet.read_schema(f))}

    # only the table's own files
    assert taken_apart(tmp_path) == {"day=2024-01-01"}
    assert rows(spark.read.parquet(path).select(F.to_json("payload")).distinct()) == [('{"id":1,"name":"x"}',)]


def test_a_repeated_batch_of_payloads_broadcasts_no_keys(spark, tmp_path, monkeypatch):
    # beside a payload Spark holds key columns for a hundredth of a file
    lines = spark.range(2000).select(F.format_string('{"execution_id": "e%d", "data": [{"id": %d}]}', "id", "id").alias("line"), F.lit("f").alias("source_file_name"))
    records = bronze.judged(lines, F.lit("2024-01-01").cast("timestamp_ntz"), "year")
    monkeypatch.setattr(merge, "BROADCAST", 100, raising=False)
    plans = staged_plans(spark, monkeypatch)
    for n in range(2):
        bronze.merge_batch(spark, records, f"{tmp_path}/bronze", quarantine=f"{tmp_path}/rejected/batch={n}")
    joins = [line for plan in plans for line in plan.splitlines() if "Join [run_id#" in line]
    assert len(joins) >= 3 and not [line for line in joins if "Broadcast" in line]
    assert bronze.read(spark, f"{tmp_path}/bronze").count() == 2000
