"""Typed reads from a VARIANT payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIMESTAMP = "timestamp_ntz"


def field(payload: str | Column, path: str, kind: str = "string", strict: bool = True) -> Column:
    """``payload.path`` as ``kind``. JSON null and a missing path both give NULL for scalar kinds.

    ``kind='variant'`` keeps them apart: JSON null stays a value, a missing path is NULL.
    """
    payload = F.col(payload) if isinstance(payload, str) else payload
    getter = F.variant_get if strict else F.try_variant_get
    return getter(payload, f"$.{path}", kind)


def explode(df: DataFrame, array: str, into: str, outer: bool = False, position: str | None = None) -> DataFrame:
    """One row per element of a VARIANT array. Missing, null and empty give one NULL row when outer."""
    tvf = df.sparkSession.tvf
    generator = tvf.variant_explode_outer if outer else tvf.variant_explode
    exploded = df.lateralJoin(generator(F.col(array).outer()))
    places = [F.col("pos").alias(position)] if position else []
    return exploded.select(*[c for c in df.columns if c != array], *places, F.col("value").alias(into))
