"""Landing, reading back and loading the file lake."""

import gzip
import hashlib
import json
import os
import time
from datetime import date, datetime

from conftest import rows
from pyspark.sql import functions as F

from buildlens.operators import quality
from buildlens.plans import bronze, silver
from buildlens.sources import lake
from buildlens.sources.rules import default_rules, read_rules

ENDPOINT = "/repos/%s/%s/actions/runs"


def batch(spark, n=10, owner="acme"):
    df = spark.range(n).select("id", F.lit(1).cast("bigint").alias("run_attempt"), F.lit(None).cast("string").alias("conclusion"))
    return df.withColumns({"owner": F.lit(owner), "repo": F.concat(F.lit("repo"), F.col("id") % 2)})


def tagged(spark, n=10, owner="acme"):
    return lake.tag_runs(batch(spark, n, owner), "owner", "repo").drop("owner", "repo")


def test_envelopes_are_bounded_and_complete(spark, tmp_path):
    root = lake.land(tagged(spark, 1001), str(tmp_path), "workflow_runs", ["id"], ENDPOINT, datetime(2024, 5, 6), max_records=100)
    files = [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".gz")]
    assert all("/owner=acme/repo=repo" in f and "/entity=workflow_runs/year=2024/month=05/day=06/" in f for f in files)
    envelopes = [json.loads(line) for f in files for line in gzip.open(f, "rt")]
    assert max(e["record_count"] for e in envelopes) <= 100
    assert sorted(r["id"] for e in envelopes for r in e["data"]) == list(range(1001))
    assert len({e["execution_id"] for e in envelopes}) == len(envelopes)
    first = envelopes[0]
    assert first["source_endpoint"].startswith("/repos/acme/repo") and first["extracted_at"] == "2024-05-06T00:00:00"
    record = first["data"][0]
    assert record["composite_key"] == f"{record['id']}_1" and record["conclusion"] is None
    assert all({r["repo_name"] for r in e["data"]} == {e["source_endpoint"].split("/")[3]} for e in envelopes)


def test_empty_batch_writes_nothing(spark, tmp_path):
    root = str(tmp_path / "lake")
    assert lake.land(tagged(spark, 0), root, "workflow_runs", ["id"]) == ""
    assert not os.path.exists(root)


def test_keys_of_runs_and_jobs(spark):
    runs = spark.createDataFrame([(1001, 1), (1001, 2), (1002, None), (None, 1)], "id bigint, run_attempt bigint")
    runs = lake.tag_runs(runs.withColumn("o", F.lit("acme")), "o", "o")
    assert [r.composite_key for r in runs.collect()] == ["1001_1", "1001_2", "1002_1", None]
    jobs = spark.createDataFrame([(1001, 5001, 1)], "run_id bigint, id bigint, run_attempt bigint")
    assert rows(lake.tag_jobs(jobs).select("composite_job_key", "run_composite_key")) == [("1001_5001_1", "1001_1")]


def write(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as out:
        out.write("".join(line + "\n" for line in lines))


def envelope(*records, count=None, name="e1"):
    return json.dumps({"execution_id": name, "record_count": len(records) if count is None else count, "data": list(records)})


def test_plain_folders_with_equal_file_names(spark, tmp_path):
    name = "2024/05/06/workflow_runs_20240506_101112.jsonl.gz"
    write(f"{tmp_path}/acme/one/workflow_runs/{name}", envelope({"id": 1}))
    write(f"{tmp_path}/acme/two/workflow_runs/{name}", envelope({"id": 2}))
    write(f"{tmp_path}/acme/two/jobs/{name}", envelope({"id": 3}))
    read = lake.read_envelopes(spark, str(tmp_path), "workflow_runs").withColumns(lake.path_parts())
    parts = read.select("lake_owner", "lake_repo", "lake_entity", F.col("lake_date").cast("string"))
    assert rows(parts, "lake_repo") == [("acme", r, "workflow_runs", "2024-05-06") for r in ("one", "two")]
    records = bronze.to_bronze(lake.explode_records(read))
    assert sorted(r.run_id for r in records.collect()) == [1, 2]


def test_only_the_wanted_days_are_read(spark, tmp_path):
    for day in (6, 7, 8):
        write(f"{tmp_path}/acme/one/runs/2024/05/0{day}/x.jsonl.gz", envelope({"id": day}))
    write(f"{tmp_path}/owner=acme/repo=two/entity=runs/year=2024/month=05/day=07/x.json.gz", envelope({"id": 17}))
    read = lake.read_envelopes(spark, str(tmp_path), "runs", since=date(2024, 5, 7), until=date(2024, 5, 8))
    found = silver.workflow_runs(lake.explode_records(read), lineage=())
    assert sorted(r.workflow_run_id for r in found.collect()) == [7, 8, 17]


def test_open_ranges_of_days(spark, tmp_path):
    for day in (6, 7, 8):
        write(f"{tmp_path}/acme/one/runs/2024/05/0{day}/x.jsonl.gz", envelope({"id": day}))

    def ids(**days):
        read = lake.read_envelopes(spark, str(tmp_path), "runs", **days)
        return sorted(r.workflow_run_id for r in silver.workflow_runs(lake.explode_records(read), lineage=()).collect())

    assert ids(since=date(2024, 5, 7)) == [7, 8] and ids(until=date(2024, 5, 7)) == [6, 7] and ids() == [6, 7, 8]
    assert lake.read_lines(spark, str(tmp_path), "runs", since=date(2024, 5, 8)).count() == 1


def test_path_parts_undo_the_escapes(spark, tmp_path):
    names = ["c++", "50% off", "x/y", "a b", "ä%41"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id bigint, repo_name string")
    lake.land(df.withColumn("repo_owner", F.lit("o+o")), f"{tmp_path}/spark", "runs", ["id"])
    read = lake.read_envelopes(spark, f"{tmp_path}/spark", "runs").withColumns(lake.path_parts())
    assert sorted(r.lake_repo for r in read.collect()) == sorted(names)
    assert {r.lake_owner for r in read.collect()} == {"o+o"}
    for i, name in enumerate(("c++", "50% off", "a%41")):
        write(f"{tmp_path}/plain/acme/{name}/runs/2024/05/06/{i}.jsonl.gz", envelope({"id": i}))
    read = lake.read_envelopes(spark, f"{tmp_path}/plain", "runs").withColumns(lake.path_parts())
    assert sorted(r.lake_repo for r in read.collect()) == sorted(["c++", "50% off", "a%41"])


def test_no_row_is_lost_on_the_way_in(spark, tmp_path):
    root, path = str(tmp_path / "lake"), str(tmp_path / "bronze")
    good = {"id": 1, "run_attempt": 1, "status": "queued", "created_at": "2024-01-01T00:00:00Z", "updated_at": "2024-01-01T00:00:00Z"}
    bad = [{**good, "run_attempt": "x", "status": "wrong"}, {**good, "id": None}, {**good, "id": 2, "created_at": "soon"}]
    write(f"{root}/a/b/workflow_runs/2024/01/01/x.jsonl.gz", envelope(good, *bad), '{"data":[', "", envelope({**good, "id": 3}))
    rejected = bronze.load(spark, root, path)
    assert sorted(r.reject for r in rejected.collect()) == ["key", "key", "line", "value"]
    assert all(r.raw for r in rejected.collect())
    runs = silver.workflow_runs(bronze.read(spark, path))
    assert rows(runs.select("workflow_run_id", "run_attempt", "status"), "workflow_run_id") == [(1, 1, "queued"), (3, 1, "queued")]


def test_payload_without_list_gives_no_rows(spark, tmp_path):
    write(f"{tmp_path}/a/b/runs/2024/01/01/x.jsonl.gz", "{}", '{"data":null}', '{"data":[]}', envelope({"id": 1}))
    assert lake.explode_records(lake.read_envelopes(spark, str(tmp_path), "runs")).count() == 1


def test_envelope_counts(spark, tmp_path):
    write(f"{tmp_path}/a/b/runs/2024/01/01/x.jsonl.gz", envelope({"id": 1}, {"id": 2}), envelope({"id": 3}, count=9), "{}")
    checked = quality.envelope_counts(lake.read_envelopes(spark, str(tmp_path), "runs"))
    found = checked.select("record_count", "data_count", "matches").collect()
    assert sorted(tuple(r) for r in found if r[0] is not None) == [(2, 2, True), (9, 1, False)]
    assert [tuple(r) for r in found if r[0] is None] == [(None, None, False)]


def test_broken_lines_go_to_quarantine(spark, tmp_path):
    write(f"{tmp_path}/a/b/runs/2024/01/01/x.jsonl.gz", envelope({"id": 1}), '{"data":[')
    good, bad = quality.split_malformed(lake.read_lines(spark, str(tmp_path), "runs"), "line", "envelope")
    assert lake.explode_records(good.drop("line")).count() == 1
    assert [r.line for r in bad.collect()] == ['{"data":[']


def test_load_is_idempotent_and_keeps_the_newest(spark, tmp_path):
    root, path = str(tmp_path / "lake"), str(tmp_path / "bronze")
    old = {"id": 1, "run_attempt": 1, "status": "queued", "updated_at": "2024-01-01T00:00:00Z", "created_at": "2024-01-01T00:00:00Z"}
    new = {**old, "status": "completed", "updated_at": "2024-01-02T00:00:00Z"}
    write(f"{root}/a/b/workflow_runs/2024/01/01/x.jsonl.gz", envelope(new, old), envelope({**old, "id": None}, name="e2"))
    write(f"{root}/a/b/workflow_runs/2024/01/02/y.jsonl.gz", envelope({**old, "run_attempt": 2}, {**old, "id": "x"}))
    for _ in range(2):
        rejected = bronze.load(spark, root, path)
        assert rejected.count() == 2
        runs = silver.workflow_runs(bronze.read(spark, path))
        found = rows(runs.select("workflow_run_id", "run_attempt", "status"), "run_attempt")
        assert found == [(1, 1, "completed"), (1, 2, "queued")]


def test_manifest_matches_a_plain_computation(spark):
    records = tagged(spark, 20)
    entry = rows(lake.manifest(records, "workflow_runs", ["id", "conclusion"]), "repo_name")[0]
    words = [0] * 9
    for i in range(0, 20, 2):
        digest = hashlib.sha256(f"∅\u0001{i}".encode()).hexdigest()
        for p in range(3):
            piece = int(digest[15 * p : 15 * p + 15], 16)
            for w, shift in enumerate((40, 20, 0)):
                words[3 * p + w] += piece >> shift & (1 << 20) - 1
    expected = hashlib.sha256(":".join(map(str, [10, *words])).encode()).hexdigest()
    assert entry == ("acme", "repo0", "workflow_runs", "/repos/acme/repo0/actions/runs", 10, expected)


def test_any_changed_field_changes_the_fingerprint(spark):
    records = tagged(spark, 4).withColumns(
        {"updated_at": F.lit("2024-01-01T00:00:00Z"), "actor": F.struct(F.lit("ann").alias("login"), F.lit(None).cast("int").alias("n"))}
    )

    def print_of(frame):
        return [r.payload_hash for r in lake.manifest(frame, "workflow_runs").orderBy("repo_name").collect()]

    first = print_of(records)
    assert print_of(records.orderBy(F.desc("id"))) == first
    later = F.when(F.col("id") == 0, "2024-01-02T00:00:00Z").otherwise(F.col("updated_at"))
    renamed = F.struct(F.when(F.col("id") == 1, "bob").otherwise("ann").alias("login"), F.lit(None).cast("int").alias("n"))
    assert print_of(records.withColumn("updated_at", later))[0] != first[0]
    assert print_of(records.withColumn("actor", renamed))[1] != first[1]


def test_rule_seed_round_trip(spark, tmp_path):
    rules = default_rules(spark)
    rules.coalesce(1).write.option("header", True).csv(str(tmp_path / "rules"))
    again = read_rules(spark, str(tmp_path / "rules"))
    assert rows(again, "error_pattern") == rows(rules, "error_pattern")
    assert again.schema == rules.schema


def test_loads_keep_the_quarantine_of_earlier_loads(spark, tmp_path):
    root, path = str(tmp_path / "lake"), str(tmp_path / "bronze")
    good = {"id": 1, "run_attempt": 1, "status": "queued", "created_at": "2024-01-01T00:00:00Z", "updated_at": "2024-01-01T00:00:00Z"}
    write(f"{root}/a/b/workflow_runs/2024/01/01/x.jsonl.gz", envelope(good, {**good, "id": None}), '{"data":[', '{"data":[')
    write(f"{root}/a/b/workflow_runs/2024/01/02/y.jsonl.gz", envelope({**good, "id": 2}, {**good, "id": 3, "created_at": "soon"}))
    days = [date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)]
    held = [bronze.load(spark, root, path, since=a, until=b) for a, b in ((days[0], days[0]), (days[1], days[1]))]
    kinds = [sorted(r.reject for r in x.collect()) for x in held]
    assert kinds == [["key", "line", "line"], ["key", "line", "line", "value"]]
    # loading all days again adds none twice
    assert sorted(r.reject for r in bronze.load(spark, root, path).collect()) == kinds[1]
    assert [sorted(r.reject for r in x.collect()) for x in held] == kinds


def test_unreadable_files_are_set_aside_whole(spark, tmp_path):
    root, path = str(tmp_path / "lake"), str(tmp_path / "bronze")
    day = f"{root}/acme/app/workflow_runs/2024/05"

    def run(i):
        return {"id": i, "run_attempt": 1, "created_at": "2024-05-01T09:00:00Z", "updated_at": "2024-05-01T09:00:00Z"}

    write(f"{day}/01/good.jsonl.gz", envelope(run(1)), "no json")
    write(f"{day}/02/cut.jsonl.gz", *[envelope(run(i), {"text": hashlib.sha256(b"%d" % i).hexdigest()}) for i in range(2, 300)])
    whole = open(f"{day}/02/cut.jsonl.gz", "rb").read()
    with open(f"{day}/02/cut.jsonl.gz", "wb") as out:
        out.write(whole[: len(whole) // 2])
    os.makedirs(f"{day}/03")
    with open(f"{day}/03/plain %41.jsonl.gz", "w") as out:
        out.write("never packed")
    rejected = bronze.load(spark, root, path)
    assert rows(bronze.read(spark, path).select("run_id")) == [(1,)]
    found = {(r.reject, r.source_file_name.rpartition("/")[2]) for r in rejected.collect()}
    assert found == {("line", "good.jsonl.gz"), ("file", "cut.jsonl.gz"), ("file", "plain%20%2541.jsonl.gz")}
    # mended and loaded again: nothing but its past is left of the fault
    with open(f"{day}/02/cut.jsonl.gz", "wb") as out:
        out.write(whole)
    os.remove(f"{day}/03/plain %41.jsonl.gz")
    bronze.load(spark, root, path)
    assert bronze.read(spark, path).count() == 299


def test_days_without_landings_give_no_lines(spark, tmp_path):
    root = str(tmp_path / "lake")
    write(f"{root}/acme/app/workflow_runs/2024/05/01/a.jsonl.gz", envelope({"id": 1}))
    assert lake.read_lines(spark, root, "workflow_runs", since=date(2024, 6, 1), until=date(2024, 6, 2)).count() == 0
    assert lake.read_lines(spark, root, "workflow_runs", since=date(2024, 5, 1), until=date(2024, 6, 2)).count() == 1


def test_large_unreadable_files_are_streamed(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    day = f"{root}/acme/app/workflow_runs/2024/05/01"
    write(f"{day}/good.jsonl.gz", envelope({"id": 1}))
    write(f"{day}/cut.jsonl.gz", *[envelope({"id": i, "text": hashlib.sha256(b"%d" % i).hexdigest()}) for i in range(300)])
    whole = open(f"{day}/cut.jsonl.gz", "rb").read()
    with open(f"{day}/cut.jsonl.gz", "wb") as out:
        out.write(whole[: len(whole) // 2])
    with open(f"{day}/plain %41.jsonl.gz", "w") as out:
        out.write("never packed")
    for bytes_held in (0, 100):
        # all files are too large to be held by a task, or some
        monkeypatch.setattr(lake, "WHOLE", bytes_held)
        found = lake.broken_files(spark, root, "workflow_runs").collect()
        assert sorted(r.source_file_name.rpartition("/")[2] for r in found) == ["cut.jsonl.gz", "plain%20%2541.jsonl.gz"]
        assert all(r.error for r in found)


def shuffled(spark):
    """The shuffle files that the session holds."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in folders for d, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}


def test_landing_and_loading_leave_no_shuffle_files(spark, tmp_path):
    # held here, as garbage would take them away at some time
    records, before = tagged(spark, 1001).repartition("id"), shuffled(spark)
    lake.land(records, f"{tmp_path}/lake", "workflow_runs")
    bronze.load(spark, f"{tmp_path}/lake", f"{tmp_path}/bronze", grain="year")
    for _ in range(50):
        left = shuffled(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert bronze.read(spark, f"{tmp_path}/bronze").count() == 1001
