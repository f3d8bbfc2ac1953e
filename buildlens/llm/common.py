"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from buildlens.session import scratch_dir

#: Words, everywhere: maximal runs without these six bytes (tab to carriage return, and the space).
SPACES = b"\t\n\x0b\x0c\r "
#: The same as a regular expression that means the same to Java and DuckDB.
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder: later reads do not depend on its lineage."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(key: str, parts: int) -> Column:
    """``crc32(key as text) mod parts``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % parts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A key that holds at least this share of all rows is frequent; so there are at most 1 / SHARE frequent keys.
SHARE = 1e-3


def handed_back(rows: DataFrame, labels: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join of rows with the written ``labels`` of their keys, where a few keys may hold most rows.

    ``weight`` is the number of rows of a label's key. The at most 1 / SHARE frequent keys are broadcast, so that their rows
    stay where they are; no other key is of a size that could hold up a task.
    """
    total = labels.agg(F.sum(weight)).first()[0] or 0
    often = F.broadcast(labels.filter(F.col(weight) >= max(2, total * SHARE)))
    seldom = rows.join(often.select(key), key, "left_anti").join(labels.filter(F.col(weight) < max(2, total * SHARE)), key)
    return rows.join(often, key).unionByName(seldom).drop(weight)


def tidied(function: Callable) -> Callable:
    """A function over an iterator of batches that gives its memory back to the system when a task ends.

    Python workers outlive their tasks, so what one stage has taken would stay beside what the next ones take.
    """

    def run(batches: Iterator) -> Iterator:
        yield from function(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):
            # another C library than that of Linux
            pass

    return run


def slices(texts: pa.Array, most: int = 1 << 20) -> Iterator[pa.Array]:
    """The array in consecutive slices of about ``most`` bytes, one text at least; nulls become empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield texts.slice(at, to - at)
        at = to


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and the n + 1 offsets into it. Texts hold no nulls."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]
