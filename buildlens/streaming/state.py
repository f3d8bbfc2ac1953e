"""Status as state: each key's newest event in a state store, and a mark on keys that stay open too long.

Beside :func:`status.track_status`, which merges each batch into a table, this stream only appends what changed. The state
is an aggregate of Spark's own, so no event passes through Python. Keys that get stuck when the clock moves are looked
for in the files whose event times became due with that move.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from buildlens.operators import merge
from buildlens.operators.dedupe import latest_per_key

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STUCK = "stuck"


@dataclass(frozen=True)
class Tracking:
    """What is tracked: the keys; the columns that order a key's events, newest last, NULLs first; the event time; the
    column and the value that say that a key is open; the seconds after which an open key is stuck; the seconds by which
    the stream's clock stays behind its newest event."""

    keys: list[str]
    order: list[str]
    at: str
    status: str
    open_value: str
    stuck_after: int
    delay: int = 0


@contextmanager
def _state_store(spark: SparkSession):
    """State beyond the memory is kept in this store; a query takes over the settings it starts with."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)


def newest_events(events: DataFrame, tracking: Tracking) -> DataFrame:
    """Of a stream of status events, for each key of a batch: ``newest``, its newest event so far; ``fresh``, whether that
    came with this batch; ``_at``, its greatest event time so far. Events need a key.

    No event is ever too late to be the newest of its key. Of events of equal rank the one that came first stays.
    """
    # one time for a whole batch, the same when it is repeated
    came = -F.unix_micros(F.current_timestamp())
    order = F.struct(*tracking.order, "_came")
    found = events.withColumn("_came", came).groupBy(*tracking.keys).agg(
        F.max_by(F.struct(*events.columns), order).alias("newest"), F.max(order).alias("_rank"), F.max(tracking.at).alias("_at")
    )
    return found.select("newest", (F.col("_rank._came") == came).alias("fresh"), "_at")


def _millis(at: str | Column) -> Column:
    return F.unix_millis((F.col(at) if isinstance(at, str) else at).cast("timestamp"))


def _due(tracking: Tracking, after: int | None, until: int | None) -> Column:
    """Whether an event leaves its key open, and for so long that it got stuck when the clock moved, in milliseconds."""
    if until is None:
        return F.lit(False)

    # compared as times, which files can be skipped by; a millisecond counts to its end
    def end(clock: int) -> Column:
        return F.timestamp_micros(F.lit((clock - tracking.stuck_after * 1000 + 1) * 1000)).cast("timestamp")

    at = F.col(tracking.at).cast("timestamp")
    due = (F.col(tracking.status) == tracking.open_value) & (at < end(until))
    return F.coalesce(due if after is None else due & (at >= end(after)), F.lit(False))


def _stuck_of_before(spark: SparkSession, path: str, batch_id: int, now: DataFrame, due: Column, tracking: Tracking) -> DataFrame:
    """Newest events of earlier batches that are due: those that no later event of their key has replaced."""
    held = spark.read.parquet(path).filter(F.col("batch") < batch_id).select(*now.columns, STUCK)
    keys = held.filter(due & ~F.col(STUCK)).select(*tracking.keys).distinct()
    every = held.unionByName(now.withColumn(STUCK, F.lit(False)))
    newest = _newest(every.join(keys, tracking.keys, "left_semi"), tracking)
    return newest.filter(due & ~F.col(STUCK)).drop(STUCK)


def track_state(
    spark: SparkSession, events: DataFrame, path: str, checkpoint: str, tracking: Tracking, quarantine: str | None = None
) -> None:
    """Follow the events that are there and return; run again, it goes on. :func:`current` reads the result.

    Changes go to ``path``, a folder for each batch, so that a repeated batch replaces its own rows. Events without a key
    go under ``quarantine``, by default beside the table. The stream may have any trigger; this function's ends.
    """
    rejected = quarantine or f"{path.rstrip('/')}__rejected"
    keyless = F.lit(False)
    for name in tracking.keys:
        keyless = keyless | F.col(name).isNull()

    def reject(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{rejected}/batch={batch_id}")

    def append(batch: DataFrame, batch_id: int) -> None:
        _append(batch, batch_id, path, f"{checkpoint}/clock", tracking)

    def run(stream: DataFrame, each, mode: str, state: str) -> None:
        writer = stream.writeStream.foreachBatch(each).outputMode(mode)
        writer.option("checkpointLocation", f"{checkpoint}/{state}").trigger(availableNow=True).start().awaitTermination()

    run(events.filter(keyless), reject, "append", "rejected")
    with _state_store(spark):
        run(newest_events(events.filter(~keyless), tracking), append, "update", "state")


def _append(batch: DataFrame, batch_id: int, path: str, clocks: str, tracking: Tracking) -> None:
    """Write a batch's changes: fresh newest events, and once more, marked, those that got stuck with the clock's move.

    The clock is the newest event time so far less the delay; it is noted for each batch, so that a repeated one starts
    from where it stood.
    """
    spark = batch.sparkSession
    staged = f"{clocks}__batch"
    # the state is read once, whatever is made of it
    batch.write.mode("overwrite").parquet(staged)
    batch = spark.read.schema(batch.schema).parquet(staged)
    held, before = f"{clocks}/batch=", None
    if batch_id and merge.exists(spark, clocks):
        noted = spark.read.schema("clock bigint, batch bigint").parquet(clocks).filter(F.col("batch") < batch_id)
        before = noted.agg(F.max("clock")).first()[0]
    came = batch.agg(F.max(_millis("_at"))).first()[0]
    known = [x for x in (before, None if came is None else came - tracking.delay * 1000) if x is not None]
    clock = max(known, default=None)
    now = batch.filter("fresh").select("newest.*")
    marks = F.when(_due(tracking, None, clock), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    out = now.withColumn(STUCK, F.explode(marks))
    if before is not None and clock > before and merge.exists(spark, path):
        late = _stuck_of_before(spark, path, batch_id, now, _due(tracking, before, clock), tracking)
        out = out.unionByName(late.withColumn(STUCK, F.lit(True)))
    out.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    spark.createDataFrame([(clock,)], "clock bigint").coalesce(1).write.mode("overwrite").parquet(f"{held}{batch_id}")
    merge.remove(spark, staged)


def _newest(changes: DataFrame, tracking: Tracking) -> DataFrame:
    order = [F.col(name).desc_nulls_last() for name in tracking.order]
    return latest_per_key(changes, tracking.keys, [*order, F.col(STUCK).desc()])


def current(spark: SparkSession, path: str, tracking: Tracking) -> DataFrame:
    """One row per key: its newest event, and whether it was stuck when the stream's clock stood where it stands now."""
    changes = spark.read.parquet(path).drop("batch")
    return _newest(changes, tracking)


def compact(spark: SparkSession, path: str, tracking: Tracking, to: str) -> None:
    """Write the table as of now in one folder, for readers that do not want to merge the changes."""
    if not merge.exists(spark, path):
        raise ValueError(f"no changes under {path}")
    current(spark, path, tracking).write.mode("overwrite").parquet(to)
