"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "buildlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library is written for; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder all executors can reach.

    The cluster names the shared root in ``spark.checkpoint.dir``. Only a local session, where driver
    and executors are one machine, falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="buildlens-")
    return f"{root.rstrip('/')}/buildlens/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Other settings for a while; ``conf`` keys use ``__`` for dots."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def shuffles_freed(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Shuffle files go when the query that wrote them ends. Else they stay until the driver happens to collect its garbage,
    and a job of several writes holds those of all. For frames that run once: run again, they would be shuffled again.
    """
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


def whole_variants(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Write VARIANT columns as they are. For files that are read back whole, for which taking payloads apart and putting them
    together again is most of the work."""
    return settings(spark, spark__sql__variant__inferShreddingSchema="false", spark__sql__variant__writeShredding__enabled="false")
