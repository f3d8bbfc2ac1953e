"""Late and out-of-order status events: the current state of each key as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from buildlens.operators import merge
from buildlens.operators.dedupe import latest_per_key


def track_status(
    spark: SparkSession, events: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[Column], partition: str,
    quarantine: str | None = None,
) -> None:
    """Fold a stream of status events into a table of one row per key, the first by ``order`` winning.

    ``partition`` is a column computed from the key alone. The result does not depend on the order of
    arrival, as long as ``order`` is total. Events without a key go under ``quarantine``, by default beside the table.
    """

    def newest(target: DataFrame, late: DataFrame, keys: list[str]) -> DataFrame:
        return latest_per_key(target.unionByName(late), keys, order)

    def fold(batch: DataFrame, batch_id: int) -> None:
        good, bad = merge.split_null_keys(batch, keys)
        bad.write.mode("overwrite").parquet(f"{quarantine or path.rstrip('/') + '__rejected'}/batch={batch_id}")
        late = latest_per_key(good, keys, order)
        merge.upsert_path(
            batch.sparkSession, path, late, keys, partition, fixed_partition=True, combine=newest
        )

    query = (
        events.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
