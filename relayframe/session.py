"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Jobs are written by state; a task may keep one file open per state instead of sorting.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    # Frames are wide rows: many small scan splits keep one task's explode output in memory.
    "spark.sql.files.maxPartitionBytes": "64m",
    # One column batch of 32 KiB frames should stay well below 100 MB.
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
}


# Identifiers are digests in hexadecimal: snappy keeps all their bytes, zstd about half.
STAGED_CODEC = "zstd"


# Shuffle files go with the query that made them, not when the driver next collects garbage.
SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str | None = None) -> Iterator[None]:
    """This package's value of a session setting, or ``value``, for sessions that others built."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, SETTINGS[key] if value is None else value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def build_session(app: str = "relayframe", master: str | None = None, **extra: str) -> SparkSession:
    """A session with this package's settings; ``extra`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must set it: executors share no local folder. Only where it is unset and the session
    runs in one process, as in tests, a temporary folder is made and set for the rest of it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="relayframe-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{work_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "step") -> DataFrame:
    """Writes a result to the shared folder once and reads it back.

    What follows neither recomputes it nor depends on the executors that made it, and
    the planner knows its real size.
    """
    path = work_path(df.sparkSession, name)
    df.write.option("compression", STAGED_CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
