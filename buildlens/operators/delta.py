"""A keyed table whose loads are only appended: batches beside a compacted base, merged when they are read.

``path/base`` is a partitioned table as :func:`merge.upsert_path` keeps it, ``path/batches/batch=<time>-<id>`` holds the
rows of one load, one per key. A load writes its batch and looks at nothing else, so its cost follows its size. Readers
take the newest batch that has a key, else the base. Compaction merges the batches into the base by itself, at any time.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from buildlens.operators import merge
from buildlens.operators.dedupe import latest_per_key


def append(spark: SparkSession, path: str, batch: DataFrame, schema: StructType, keys: list[str]) -> str:
    """Add a load's rows, one per key; returns the name of its batch. Later batches win.

    Columns that ``schema``, the table's, does not have are refused; those that the batch lacks are NULL in its rows. A
    load that is cut off leaves nothing that a reader would see.
    """
    extra = [c for c in batch.columns if c not in schema.names]
    if extra:
        raise ValueError(f"columns not in the table: {extra}")
    typed = [
        (F.col(f.name) if f.name in batch.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]
    # ascending in time on one machine; batches of loads at the same instant are ordered by chance, but always alike
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    merge.key_filters(batch.select(*typed).write, keys).parquet(f"{_batches(path)}/batch={name}")
    return name


def _batches(path: str) -> str:
    return f"{path.rstrip('/')}/batches"


def committed(spark: SparkSession, path: str) -> list[str]:
    """The names of the batches whose write was finished, in their order."""
    fs, pattern = merge._path(spark, f"{_batches(path)}/batch=*/_SUCCESS")
    done = fs.globStatus(pattern) or []
    return sorted(entry.getPath().getParent().getName().removeprefix("batch=") for entry in done)


def newest(spark: SparkSession, path: str, names: list[str], schema: StructType, keys: list[str], partition: str) -> DataFrame:
    """The last row of each key in some batches, in the partition that the first of them put it."""
    folders = [f"{_batches(path)}/batch={name}" for name in names]
    rows = spark.read.schema(schema).parquet(*folders)
    if len(names) == 1:
        # a load has one row per key
        return rows
    rows = rows.withColumn("_batch", F.regexp_extract("_metadata.file_path", "/batch=([^/]+)/", 1))
    first = F.min_by(partition, "_batch").over(Window.partitionBy(*keys))
    rows = rows.withColumn("_first", first)
    found = latest_per_key(rows, keys, [F.col("_batch").desc()])
    return found.withColumn(partition, F.col("_first")).select(*schema.names)


def read(spark: SparkSession, path: str, schema: StructType, keys: list[str], partition: str) -> DataFrame:
    """The table as of now: the base with what the batches changed and added; a key stays in its first partition.

    The base is not shuffled as long as the batches' keys are few enough for Spark to broadcast.
    """
    base, names = f"{path.rstrip('/')}/base", committed(spark, path)
    held = spark.read.schema(schema).parquet(base) if merge.exists(spark, base) else None
    if not names:
        return held if held is not None else spark.createDataFrame([], schema)
    found = newest(spark, path, names, schema, keys, partition)
    if held is None:
        return found
    homes = held.select(*keys, F.col(partition).alias("_home"), F.lit(True).alias("_known"))
    own = found.join(homes.join(found.select(*keys), keys, "left_semi"), keys, "left")
    own = own.withColumn(partition, F.when(F.col("_known"), F.col("_home")).otherwise(F.col(partition)))
    return held.join(found.select(*keys), keys, "left_anti").unionByName(own.select(*schema.names))


def compact(spark: SparkSession, path: str, schema: StructType, keys: list[str], partition: str) -> int:
    """Merge the finished batches into the base, rewriting the partitions they touch, and remove them; returns how many.

    Loads may go on meanwhile. A compaction that is cut off is simply done again: the oldest batch goes first, so what
    is left of them never hides a newer row, and merging a batch twice changes nothing.
    """
    names = committed(spark, path)
    if names:
        rows = newest(spark, path, names, schema, keys, partition)
        merge.upsert_path(spark, f"{path.rstrip('/')}/base", rows, keys, partition, schema=schema)
    for name in names:
        folder = f"{_batches(path)}/batch={name}"
        # without its mark a batch is not there, however much of its files is
        merge.remove(spark, f"{folder}/_SUCCESS")
        merge.remove(spark, folder)
    return len(names)
