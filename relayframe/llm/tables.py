"""What the operators of this subpackage share: table access and plain text expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The characters of ``[\x20\x09-\x0D]``.
BLANKS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def columns_ddl(rows: DataFrame) -> str:
    """The columns of ``rows`` as the schema text of a map over them."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)


def lean(task: Callable) -> Callable:
    """``task``, a map over Arrow batches, that gives its unused memory back to the system when it ends.

    Spark keeps Python workers for later tasks; what Arrow and the C library hold on to after one task
    would stand beside all that an executor does next.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
                pool.release_unused()

    return run


def fresh(rows: DataFrame, name: str) -> str:
    """``name``, or one like it that is no column of ``rows``."""
    taken = {c.lower() for c in rows.columns}
    while name in taken:
        name += "_"
    return name
