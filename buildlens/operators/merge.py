"""Upsert, late updates and appends between frames, and the upsert of a partitioned Parquet table."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from buildlens.session import whole_variants


def split_null_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that can be merged, rows to quarantine because a key is NULL)."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return df.filter(~missing), df.filter(missing)


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows replace target rows of the same key; the rest of both is kept.

    ``source`` holds one row per key. The source always wins, there is no "newer than" guard.
    """
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source)


def reconcile(
    target: DataFrame, late: DataFrame, keys: list[str], only_if_newer: str | None = None
) -> DataFrame:
    """Overwrite, field by field, the target rows that ``late`` names. Both hold one row per key.

    A late row without a target row is dropped, a column ``late`` does not have is kept. With
    ``only_if_newer`` a late row is applied only when that column is greater than the target's.
    """
    fields = [c for c in late.columns if c not in keys]
    staged = late.select(*keys, *[F.col(c).alias(f"_late_{c}") for c in fields], F.lit(True).alias("_late"))
    joined = target.join(staged, keys, "left")
    apply = F.col("_late").isNotNull()
    if only_if_newer:
        newer = F.col(f"_late_{only_if_newer}") > F.col(only_if_newer)
        apply = apply & (F.coalesce(newer, F.lit(False)) | F.col(only_if_newer).isNull())
    return joined.select(
        *[F.when(apply, F.col(f"_late_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in target.columns]
    )


def append_partial(target: DataFrame, rows: DataFrame, evolve: bool = False) -> DataFrame:
    """Append rows that name only some columns; the others become NULL.

    Columns the target does not have are refused unless ``evolve`` is set.
    """
    extra = [c for c in rows.columns if c not in target.columns]
    if extra and not evolve:
        raise ValueError(f"columns not in the target: {extra}")
    typed = rows.select(
        *[F.col(c).cast(target.schema[c].dataType).alias(c) if c in target.columns else F.col(c) for c in rows.columns]
    )
    return target.unionByName(typed, allowMissingColumns=True)


def audit(df: DataFrame, keys: list[str]) -> DataFrame:
    """Row count against distinct keys; equal when the merge did its work."""
    # count(distinct a, b) skips rows with a NULL key, as a NULL concatenated key would be skipped
    return df.agg(F.count("*").alias("total_rows"), F.count_distinct(*keys).alias("distinct_keys"))


def _path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _path(spark, path)
    return fs.exists(jpath)


def remove(spark: SparkSession, path: str) -> None:
    fs, jpath = _path(spark, path)
    fs.delete(jpath, True)


#: Distinct values of a key column in a batch up to which a table is asked for the values themselves.
ASKED = 1000
#: Rows of a written table up to which Spark may broadcast them, about 100 bytes of memory each.
BROADCAST = 250_000


def by_rows(written: DataFrame, rows: int | None = None) -> DataFrame:
    """A written table as the right side of a join: many rows are shuffled. Spark goes by the size of files, of which it gives
    key columns a share by type (beside a VARIANT a hundredth), so that it would broadcast many millions of keys."""
    return written if (written.count() if rows is None else rows) <= BROADCAST else written.hint("merge")


def key_filters(writer: DataFrameWriter, keys: list[str]) -> DataFrameWriter:
    """Let the written files hold a Bloom filter of each key column, of a size that fits its values."""
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", True)
    return writer.option("parquet.bloom.filter.adaptive.enabled", True)


def _staged(writer: DataFrameWriter) -> DataFrameWriter:
    """For files that are read a few times and removed."""
    return writer.option("compression", "zstd")


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write what is read a few times, with all its columns, and removed; hands back a scan of it."""
    with whole_variants(df.sparkSession):
        _staged(df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _publish(spark: SparkSession, merged: DataFrame, path: str, partition: str, keys: list[str]) -> None:
    """Replace the partitions that ``merged``, a written table, holds; Spark's committer moves them in. Can be repeated."""
    # in the order of the keys, so that files and row groups have narrow ranges of them
    ordered = merged.hint("rebalance", partition).sortWithinPartitions(partition, *keys)
    writer = key_filters(ordered.write.mode("overwrite").partitionBy(partition), keys)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def near(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of a table that could have a key of ``batch``, a written table: by the range of each key column and, if
    the batch has few values of it, by these. Parquet skips files and row groups by range and by Bloom filter.
    """
    few = F.array_sort(F.collect_set("value"))
    for key in keys:
        values = batch.select(F.col(key).alias("value")).filter("value IS NOT NULL").distinct()
        least, most, count = values.agg(F.min("value"), F.max("value"), F.count("*")).first()
        if not count:
            return target.limit(0)
        if count <= ASKED:
            target = target.filter(F.col(key).isin(values.agg(few).first()[0]))
        else:
            target = target.filter(F.col(key).between(F.lit(least), F.lit(most)))
    return target


@contextlib.contextmanager
def _values_pushed(spark: SparkSession) -> Iterator[None]:
    """Push lists of up to ASKED values to Parquet, where their Bloom filters are; Spark pushes ranges of longer lists."""
    name = "spark.sql.parquet.pushdown.inFilterThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, ASKED)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def recover(spark: SparkSession, path: str, partition: str = "created_date", keys: list[str] | None = None) -> int:
    """Finish the merges into a table that were cut off after their result was written; returns how many."""
    base = path.rstrip("/")
    fs, pattern = _path(spark, f"{base}__merge-*/merged/_SUCCESS")
    done = fs.globStatus(pattern) or []
    for entry in done:
        folder = entry.getPath().getParent().toString()
        merged = spark.read.parquet(folder)
        if not merged.isEmpty():
            _publish(spark, merged, base, partition, keys or [])
        remove(spark, folder.rpartition("/")[0])
    return len(done)


def held_columns(spark: SparkSession, path: str) -> StructType:
    """The columns that any file of a table has: reads all their footers."""
    return spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(path).schema


def read_table(
    spark: SparkSession, path: str, like: StructType, partition: str, held: StructType | None = None
) -> DataFrame:
    """A partitioned table with the columns it has (``held``, where known) and those of ``like``; the partition is read as
    the type that it has in ``like``, whatever its values look like."""
    held = held or held_columns(spark, path)
    more = [f for f in like.fields if f.name not in held.names]
    return spark.read.schema(StructType([*held.fields, *more])).parquet(path)


def upsert_path(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: list[str],
    partition: str = "created_date",
    fixed_partition: bool = False,
    combine: Callable[[DataFrame, DataFrame, list[str]], DataFrame] = upsert,
    evolve: bool = False,
    schema: StructType | None = None,
    done: Callable[[], None] | None = None,
) -> None:
    """Upsert into a Parquet table, rewriting only the partitions the source touches.

    ``source`` holds one row per key; ``combine`` merges it with the touched partitions. Columns that the table lacks are
    refused, unless ``evolve`` adds them; columns that the source lacks become NULL in its rows.

    A key stays in the partition it was first written to. Finding that partition reads the key columns of the files whose
    ranges and Bloom filters admit a key of the source; ``fixed_partition`` skips this when a key's partition never changes.
    Where the table's columns are known, ``schema`` spares a look into all its files. ``done`` is called once ``source`` is
    not read any more, before partitions are replaced. Everything is staged beside the table in
    a folder of the run's own, so the plan never overwrites what it reads, and a run cut off while partitions are
    replaced is finished by the next one. Of two runs at once the later wins in the partitions that both touch.
    """
    base = path.rstrip("/")
    recover(spark, base, partition, keys)
    own = f"{base}__merge-{uuid.uuid4().hex}"
    target = None
    if exists(spark, base):
        held = schema or held_columns(spark, base)
        if schema is None:
            target = read_table(spark, base, source.schema, partition, held)
        else:
            target = spark.read.schema(schema).parquet(base)
        extra = [c for c in source.columns if c not in held.names and c != partition]
        if extra and not evolve:
            raise ValueError(f"columns not in the table: {extra}")
    # written once: it is read for its keys, for its partitions, for the anti-join and the union, and a small batch is
    # then known to be small, so that the table is not shuffled to meet it. The first batch is the merged table
    source = stage(source, f"{own}/{'merged' if target is None else 'incoming'}")
    if done:
        done()
    rows = source.count()
    if not rows:
        remove(spark, own)
        return
    if target is None:
        _publish(spark, source, base, partition, keys)
        remove(spark, own)
        return
    if not fixed_partition:
        homes = target.select(*keys, F.col(partition).alias("_home"), F.lit(True).alias("_known"))
        with _values_pushed(spark):
            found = near(homes, source, keys).join(by_rows(source.select(*keys), rows), keys, "left_semi")
            known = stage(found, f"{own}/homes")
        source = source.join(by_rows(known), keys, "left")
        # a known key's home can be the NULL partition
        home = F.when(F.col("_known"), F.col("_home")).otherwise(F.col(partition))
        source = source.withColumn(partition, home).drop("_home", "_known")
    # written: a handful of values that the join is not made again for, and that Spark knows to be few, so that it broadcasts
    # them; the comparison marks them as a filter, by which it then prunes the table's partitions
    touched = stage(source.groupBy(partition).agg(F.count("*").alias("_n")), f"{own}/touched")
    old = target.join(touched.filter("_n > 0"), partition, "left_semi").select(*target.columns)
    if not touched.filter(F.col(partition).isNull()).isEmpty():
        old = old.union(target.filter(F.col(partition).isNull()))
    lacking = [F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields if f.name not in source.columns]
    source = by_rows(source.select("*", *lacking).select(*target.columns), rows)
    source = combine(old, source, keys)
    _publish(spark, stage(source, f"{own}/merged"), base, partition, keys)
    remove(spark, own)
