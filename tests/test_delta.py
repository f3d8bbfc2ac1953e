"""Appended batches, read and compacted, and the look-up of keys by the files' filters."""

import datetime
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_merge import KEYS, frame, states

from buildlens.operators import delta, merge


def table(spark, path, schema):
    return delta.read(spark, path, schema, KEYS, "day")


def test_loads_read_as_upserts_before_and_after_compaction(spark, tmp_path):
    path, plain = str(tmp_path / "delta"), str(tmp_path / "plain")
    loads = [
        frame(spark, (1, 1, "a", "2024-01-01"), (2, 1, "b", "2024-01-02"), (3, 1, "c", "2024-01-02")),
        frame(spark, (2, 1, "B", "2024-02-02"), (4, 1, "d", "2024-01-03")),
        frame(spark, (4, 1, "D", "2024-03-03"), (5, 2, "e", "2024-01-01"), (1, 1, "A", "2024-01-01")),
        frame(spark, (2, 1, "BB", "2024-04-04")).withColumn("day", F.lit(None).cast("date")),
    ]
    schema = loads[0].schema
    assert table(spark, path, schema).count() == 0 and delta.compact(spark, path, schema, KEYS, "day") == 0
    for compacted_after in (1, 3, 9):
        for i, load in enumerate(loads):
            delta.append(spark, path, load, schema, KEYS)
            merge.upsert_path(spark, plain, load, KEYS, "day")
            assert states(table(spark, path, schema)) == states(spark.read.schema(schema).parquet(plain))
            if i >= compacted_after:
                delta.compact(spark, path, schema, KEYS, "day")
                assert delta.committed(spark, path) == [] and os.listdir(f"{path}/batches") == []
                assert states(table(spark, path, schema)) == states(spark.read.schema(schema).parquet(plain))


def test_a_load_touches_no_file_of_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    first = frame(spark, (1, 1, "a", "2024-01-01"))
    delta.append(spark, path, first, first.schema, KEYS)
    delta.compact(spark, path, first.schema, KEYS, "day")
    seen = {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names}
    delta.append(spark, path, frame(spark, (1, 1, "b", "2024-01-01")), first.schema, KEYS)
    after = {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names}
    assert {f: t for f, t in after.items() if f in seen} == seen
    assert all("/batches/" in f for f in after.keys() - seen.keys())


def test_cut_off_loads_and_compactions(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    loads = [frame(spark, (1, 1, s, "2024-01-01"), (k, 1, s, "2024-01-02")) for k, s in ((2, "a"), (3, "b"), (4, "c"))]
    schema = loads[0].schema
    for load in loads:
        delta.append(spark, path, load, schema, KEYS)
    expected = states(table(spark, path, schema))
    # a load that was cut off before it ended is not seen
    lost = delta.append(spark, path, frame(spark, (9, 1, "x", "2024-01-01")), schema, KEYS)
    os.remove(f"{path}/batches/batch={lost}/_SUCCESS")
    assert states(table(spark, path, schema)) == expected
    # a compaction that is cut off when the first of the batches is gone
    removed, whole = [], merge.remove

    def cut(session, folder):
        if "/batches/" in folder:
            removed.append(folder)
            if len(removed) > 2:
                raise KeyboardInterrupt
        whole(session, folder)

    monkeypatch.setattr(merge, "remove", cut)
    with pytest.raises(KeyboardInterrupt):
        delta.compact(spark, path, schema, KEYS, "day")
    monkeypatch.undo()
    assert len(delta.committed(spark, path)) == 2 and states(table(spark, path, schema)) == expected
    assert delta.compact(spark, path, schema, KEYS, "day") == 2 and states(table(spark, path, schema)) == expected


def test_columns_of_a_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    whole = frame(spark, (1, 1, "a", "2024-01-01"))
    with pytest.raises(ValueError, match="more"):
        delta.append(spark, path, whole.withColumn("more", F.lit(1)), whole.schema, KEYS)
    delta.append(spark, path, whole.drop("state"), whole.schema, KEYS)
    assert states(table(spark, path, whole.schema)) == [(1, 1, None, "2024-01-01")]


def scanned(df):
    """Rows that the scan of a plan gave, once it has run."""
    df.collect()
    nodes, found = [df._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return sum(found)


def test_keys_are_looked_up_by_ranges_and_bloom_filters(spark, tmp_path):
    path, days = str(tmp_path / "t"), 8
    ids = spark.range(days * 1000).select((F.col("id") * 2).alias("id"), F.lit(1).cast("bigint").alias("attempt"))
    first = datetime.date(2024, 1, 1)
    whole = ids.select("*", F.lit("s").alias("state"), F.date_add(F.lit(first), (F.col("id") % days).cast("int")).alias("day"))
    merge.upsert_path(spark, path, whole, KEYS, "day")
    target = spark.read.schema(whole.schema).parquet(path)
    with merge._values_pushed(spark):
        # in the range of all files, held by one; held by none; beyond all ranges
        for own, most in (([4008], 1000 * days // 4), ([4001], 0), ([999_999], 0)):
            batch = spark.createDataFrame([(i, 1) for i in own], "id bigint, attempt bigint")
            found = merge.near(target, batch, KEYS).select(*KEYS, "day")
            assert scanned(found) <= most < target.count()
            assert found.count() == sum(i % 2 == 0 and i < 2000 * days for i in own)
    # more values than are asked for one by one: by their range
    many = spark.range(0, 2 * merge.ASKED + 2).select("id", F.lit(1).cast("bigint").alias("attempt"))
    assert merge.near(target, many, KEYS).count() == merge.ASKED + 1
    assert merge.near(target, many.limit(0), KEYS).count() == 0
    # a key found this way stays where it is
    moved = frame(spark, (4008, 1, "new", "2030-01-01"), (4001, 1, "added", "2030-01-01"))
    merge.upsert_path(spark, path, moved, KEYS, "day")
    after = spark.read.schema(whole.schema).parquet(path)
    home = first + datetime.timedelta(days=4008 % days)
    assert rows(after.filter("state != 's'").select("id", "day"), "id") == [(4001, datetime.date(2030, 1, 1)), (4008, home)]
    assert after.count() == days * 1000 + 1


def test_one_load_is_read_as_it_is(spark, tmp_path):
    path, load = str(tmp_path / "t"), frame(spark, (1, 1, "a", "2024-01-01"))
    names = [delta.append(spark, path, load, load.schema, KEYS)]
    found = delta.newest(spark, path, names, load.schema, KEYS, "day")
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert rows(found) == rows(load)
