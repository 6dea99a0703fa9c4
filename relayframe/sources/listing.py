"""Listing and reading of many files by tasks: no path and no content passes the driver.

For folders that driver and executors mount. Names follow Spark's rules: files and folders that begin
with a dot or an underscore are left out, ``=`` in an underscored name keeps it.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from fnmatch import fnmatchcase
from glob import glob as matching

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What Python and Spark match differently.
PATTERN = re.compile(r"[{}\\^]|\[!")
LISTED = "path string, length long, folder boolean"
#: Rows and bytes of contents handed on together.
ROWS_AT_ONCE, BYTES_AT_ONCE = 4096, 4 << 20


def mounted_roots(path: str | list[str]) -> list[str] | None:
    """What the paths and patterns name, or None where only Spark's readers can tell.

    Those are other file systems, and patterns that Python and Spark read differently.
    """
    found = []
    for one in [path] if isinstance(path, str) else path:
        local = re.sub(r"\Afile:/*", "/", one)
        if not local.startswith("/") or "://" in local or PATTERN.search(local):
            return None
        if re.search(r"[*?\[]", local):
            found += matching(local, include_hidden=True)
        elif os.path.exists(local):
            found.append(local)
    return [name for name in dict.fromkeys(found) if os.path.isdir(name) or not _hidden(os.path.basename(name))] or None


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _entries(folder: str, glob: str | None) -> Iterator[tuple[str, int, bool]]:
    with os.scandir(folder) as entries:
        for entry in entries:
            if _hidden(entry.name):
                continue
            if entry.is_dir():
                yield entry.path, 0, True
            elif glob is None or fnmatchcase(entry.name, glob):
                yield entry.path, entry.stat().st_size, False


def _below(folder: str, glob: str | None) -> Iterator[tuple[str, int, bool]]:
    for path, size, is_folder in _entries(folder, glob):
        if is_folder:
            yield from _below(path, glob)
        else:
            yield path, size, False


def _lister(glob: str | None, below: Callable[[str], bool]) -> Callable:
    def one_folder(folder: str) -> Iterator[tuple[str, int, bool]]:
        for entry in _entries(folder, glob):
            if entry[2] and below(os.path.basename(entry[0])):
                yield from _below(entry[0], glob)
            else:
                yield entry

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                found = one_folder(row["path"]) if row["folder"] else [(row["path"], row["length"], False)]
                for one in found:
                    rows.append(one)
                    if len(rows) == ROWS_AT_ONCE:
                        yield _batch(rows)
                        rows = []
        if rows:
            yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)],
        ["path", "length", "folder"])


def listed(spark: SparkSession, roots: list[str], glob: str | None = None, recursive: bool = False) -> DataFrame:
    """``path, length`` of the files in some folders, and of roots that are files.

    A folder is listed by one task; with ``recursive``, each folder in the roots, and all below it, by another.
    Folders of partitions are listed without it too.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = [(root, 0 if os.path.isdir(root) else os.path.getsize(root), os.path.isdir(root)) for root in roots
            if os.path.isdir(root) or glob is None or fnmatchcase(os.path.basename(root), glob)]
    below = (lambda name: False) if recursive else (lambda name: "=" in name)
    first = spark.createDataFrame(rows, LISTED).repartition(n, "path").mapInArrow(_lister(glob, below), LISTED)
    if recursive:
        first = first.repartition(n, "path").mapInArrow(_lister(glob, lambda name: True), LISTED)
    files = first.filter(~F.col("folder")).select("path", "length")
    if len(roots) > 1:
        files = files.dropDuplicates(["path"])  # one root may lie in another
    return files.select(F.concat(F.lit("file:"), "path").alias("path"), "length")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(rows: list[tuple]) -> pa.RecordBatch:
        paths, contents = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array([len(c) for c in contents], pa.int64()),
             pa.array(contents, pa.binary())], ["path", "length", "content"])

    rows, held = [], 0
    for batch in batches:
        for path in batch.column("path").to_pylist():
            with open(re.sub(r"\Afile:/*", "/", path), "rb") as file:
                content = file.read()
            if rows and held + len(content) > BYTES_AT_ONCE:
                yield out(rows)
                rows, held = [], 0
            rows.append((path, content))
            held += len(content)
    if rows:
        yield out(rows)


def contents(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``path, length, content`` of listed files; a file is a row, and files are dealt evenly to tasks."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(n, "path").mapInArrow(_read, "path string, length long, content binary")
