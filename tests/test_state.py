"""Status as state: any order of arrival gives the same table, open keys get stuck and are freed again."""

import random

from conftest import rows

from buildlens.streaming import state

SCHEMA = "id bigint, state string, at timestamp, note string"
HOUR = 3600
TRACKING = state.Tracking(["id"], ["at", "state"], "at", "state", "in_progress", 6 * HOUR, delay=HOUR)


def at(hour):
    return f"2024-05-06 {hour:02d}:00:00"


def land(spark, base, events):
    frame = spark.createDataFrame(events, "id bigint, state string, at string, note string")
    frame.selectExpr("id", "state", "CAST(at AS timestamp) AS at", "note").coalesce(1).write.mode("append").parquet(f"{base}/in")


def follow(spark, base):
    events = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
    state.track_state(spark, events, f"{base}/out", f"{base}/ck", TRACKING)
    found = state.current(spark, f"{base}/out", TRACKING)
    return {r.id: (r.state, r.at.hour, r.stuck) for r in found.collect()}


EVENTS = [
    (1, "queued", at(0), None), (1, "in_progress", at(1), "a"), (1, "completed", at(20), "b"),
    (2, "in_progress", at(2), None),
    (3, "in_progress", at(18), None), (3, "queued", at(3), None),
    (4, "in_progress", at(13), None),
    (5, "queued", at(1), None), (5, "in_progress", at(14), None),
    (6, "in_progress", at(4), None), (6, "in_progress", at(4), "again"), (6, "completed", None, None),
]
# the clock stands at 19:00: what is open since 13:00 or before is stuck
NEWEST = {
    1: ("completed", 20, False), 2: ("in_progress", 2, True), 3: ("in_progress", 18, False), 4: ("in_progress", 13, True),
    5: ("in_progress", 14, False), 6: ("in_progress", 4, True),
}


def test_any_order_of_arrival_and_restarts_give_one_table(spark, tmp_path):
    for seed in range(2):
        events = [*EVENTS, (None, "queued", at(5), "lost")]
        random.Random(seed).shuffle(events)
        base = str(tmp_path / str(seed))
        # each round is a restart; in the second order early events arrive long after the clock has passed them
        for part in range(2):
            land(spark, base, events[part::2])
            found = follow(spark, base)
        assert found == NEWEST
        assert rows(spark.read.parquet(f"{base}/out__rejected").select("note")) == [("lost",)]


def test_a_stuck_key_is_freed_by_a_newer_event(spark, tmp_path):
    base = str(tmp_path)
    land(spark, base, [(1, "in_progress", at(1), None), (2, "completed", at(9), None)])
    assert follow(spark, base) == {1: ("in_progress", 1, True), 2: ("completed", 9, False)}
    # a late event that is not the newest changes nothing; the newest one takes the mark off
    land(spark, base, [(1, "completed", at(2), None), (1, "queued", at(0), None), (3, "in_progress", at(1), "late")])
    assert follow(spark, base) == {1: ("completed", 2, False), 2: ("completed", 9, False), 3: ("in_progress", 1, True)}
    changes = spark.read.parquet(f"{base}/out")
    assert changes.filter("id = 1").count() == 3
    state.compact(spark, f"{base}/out", TRACKING, f"{base}/whole")
    assert spark.read.parquet(f"{base}/whole").count() == 3


def test_the_store_setting_is_left_as_it_was(spark):
    before = spark.conf.get(state.STORE)
    with state._state_store(spark):
        assert spark.conf.get(state.STORE) == state.ROCKSDB
    assert spark.conf.get(state.STORE) == before


def test_no_event_passes_through_python(spark, tmp_path):
    land(spark, str(tmp_path), [(1, "queued", at(0), None)])
    events = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
    plan = state.newest_events(events, TRACKING)._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" not in plan and "Aggregate" in plan


def test_a_key_gets_stuck_in_a_later_batch_unless_it_was_closed(spark, tmp_path):
    base = str(tmp_path)
    land(spark, base, [(1, "in_progress", at(1), None), (2, "in_progress", at(1), None)])
    assert follow(spark, base) == {1: ("in_progress", 1, False), 2: ("in_progress", 1, False)}
    # key 2 is closed by the batch that moves the clock; an event that is not the newest of its key is no change
    land(spark, base, [(2, "completed", at(2), None), (2, "queued", at(0), None), (3, "completed", at(20), None)])
    assert follow(spark, base) == {1: ("in_progress", 1, True), 2: ("completed", 2, False), 3: ("completed", 20, False)}
    land(spark, base, [(3, "queued", at(19), "old"), (2, "queued", at(0), "old")])
    assert follow(spark, base)[3] == ("completed", 20, False)
    changes = spark.read.parquet(f"{base}/out")
    assert sorted((r.id, r.state, r.stuck) for r in changes.collect()) == [
        (1, "in_progress", False), (1, "in_progress", True), (2, "completed", False), (2, "in_progress", False), (3, "completed", False)
    ]
