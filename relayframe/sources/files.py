"""Files in, files out."""

from __future__ import annotations

import os
import re
import shutil
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import frames as X
from ..operators.lookups import join_lookup
from ..session import cut_lineage
from . import listing

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def as_files(found: DataFrame, created_at) -> DataFrame:
    """``binaryFile`` rows as stored files; the size is kept so later steps need no content."""
    name = _file_name("path")
    return found.select(
        X.message_uid("file/", name).alias("file_id"), name.alias("file_name"), "content",
        F.col("length").alias("n_bytes"),
        X.as_column(created_at).cast("timestamp").alias("creation_time"))


def _file_name(path) -> Column:
    return F.regexp_replace(path, r"\Afile:/*", "/")


def _empty_files(spark: SparkSession, found: DataFrame) -> DataFrame:
    """The files that the source lists but gives no row for, as they have no bytes.

    The listing is on the driver already, as Spark's file index holds every path there.
    """
    listed = spark.createDataFrame([(name,) for name in found.inputFiles()], "path string")
    listed = listed.select(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))).alias("path"))
    rows = found.select(_file_name("path").alias("name"))
    return (listed.withColumn("name", _file_name("path")).join(rows, "name", "left_anti")
            .select("path", F.lit(0).cast("bigint").alias("length"), F.lit("").cast("binary").alias("content")))


def import_files(spark: SparkSession, path: str | list[str], created_at, existing: DataFrame | None = None,
                 glob: str | None = None, recursive: bool = False) -> DataFrame:
    """Files below a path or several, named by it, empty ones too. Names stored already are left out.

    One row per file; a file above 2 GB does not fit a row and fails the read. Mounted folders are listed
    and read by tasks; other file systems by Spark's reader.
    """
    files = as_files(_found(spark, path, glob, recursive), created_at)
    if existing is not None:
        files = files.join(existing.select("file_name"), "file_name", "left_anti").select(
            *files.columns)
    return files


def _found(spark: SparkSession, path: str | list[str], glob: str | None, recursive: bool) -> DataFrame:
    """``path, length, content`` of the files to import."""
    roots = None if glob and listing.PATTERN.search(glob) else listing.mounted_roots(path)
    if roots:
        return listing.contents(spark, listing.listed(spark, roots, glob, recursive))
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    found = reader.load(path)
    return found.select("path", "length", "content").unionByName(_empty_files(spark, found))


def import_files_stream(spark: SparkSession, path: str, created_at) -> DataFrame:
    """The same as a stream: every new file arrives once."""
    found = spark.readStream.format("binaryFile").schema(BINARY_FILE).load(path)
    return as_files(found, created_at)


def export_files(parts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Reassembled parts as Parquet rows (message_id, part_no, byte_offset, content)."""
    parts.select("message_id", "part_no", "byte_offset", "content").write.mode(mode).parquet(path)


# Largest message that becomes one row of the file table; Spark's rows end at 2 GB.
STORED_BYTES = 1 << 30
RECEIVED_NAME = "received/"


def received_files(parts: DataFrame, created_at, existing: DataFrame | None = None,
                   max_bytes: int = STORED_BYTES) -> tuple[DataFrame, DataFrame]:
    """Reassembled messages as stored files that can be sent on, and the messages too long for a row.

    ``parts``: the columns of ``reassemble``. A file is named ``received/`` and the message, so storing a
    message again gives the same row, and names in ``existing`` are left out. Messages in one part, most
    of them, are not shuffled; the parts of one message meet in one group of at most ``max_bytes``. Longer
    messages come back as ``message_id, total_bytes, n_parts``; ``write_files`` takes them.
    """
    if existing is not None:
        known = existing.filter(F.startswith("file_name", F.lit(RECEIVED_NAME))).select(
            F.substr("file_name", F.lit(len(RECEIVED_NAME) + 1)).alias("message_id")).distinct()
        parts = join_lookup(parts, known, ["message_id"], "left_anti", spread_by=F.col("part_no"))
    long = F.col("total_bytes") > max_bytes
    whole = parts.filter(~long & (F.col("n_parts") == 1)).select("message_id", "content")
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("part_no", "content"))),
                         lambda piece: piece["content"].cast("string"))
    joined = (
        parts.filter(~long & (F.col("n_parts") > 1)).groupBy("message_id")
        .agg(F.array_join(pieces, "").cast("binary").alias("content"))
    )
    name = F.concat(F.lit(RECEIVED_NAME), F.col("message_id"))
    stored = whole.unionByName(joined).select(
        X.message_uid("file/", name).alias("file_id"), name.alias("file_name"), "content",
        F.octet_length("content").cast("bigint").alias("n_bytes"),
        X.as_column(created_at).cast("timestamp").alias("creation_time"))
    rejected = parts.filter(long & (F.col("part_no") == 0)).select("message_id", "total_bytes", "n_parts")
    return stored, rejected


WRITTEN = "message_id string, part_no long, n_parts long, total_bytes long, file_path string, n_bytes long"


def _exported_path(message_id: str | None) -> str:
    """Where a message lies below the export: its quoted name in one of 256 folders.

    Names come from the wire, so dots and slashes are quoted too: no name leaves the folder.
    """
    name = "null" if message_id is None else "m-" + quote(message_id, safe="").replace(".", "%2E")
    return f"{uuid.uuid5(uuid.NAMESPACE_OID, name).hex[:2]}/{name}"


def _write_at(root: str) -> Callable:
    """Writes the parts of a task to their places; a task that runs again writes the same bytes there."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, sizes = [], []
            for message_id, offset, content in zip(*[batch.column(c) for c in ("message_id", "byte_offset", "content")],
                                                   strict=True):
                path, data = _exported_path(message_id.as_py()), memoryview(content.as_buffer())
                target = os.path.join(root, path)
                with suppress(FileExistsError):
                    os.mkdir(os.path.dirname(target))  # a task that outlives its run finds no folder
                handle = os.open(target, os.O_WRONLY | os.O_CREAT, 0o644)
                try:
                    at = 0
                    while at < len(data):
                        at += os.pwrite(handle, data[at:], offset.as_py() + at)
                    os.fsync(handle)
                finally:
                    os.close(handle)
                paths.append(path)
                sizes.append(len(data))
            kept = [batch.column(c) for c in ("message_id", "part_no", "n_parts", "total_bytes")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(paths, pa.string()), pa.array(sizes, pa.int64())],
                                             ["message_id", "part_no", "n_parts", "total_bytes", "file_path", "n_bytes"])

    return write


def _mounted(path: str) -> str:
    local = re.sub(r"\Afile:/*", "/", path).rstrip("/")
    if "://" in local:
        raise ValueError(f"{path} is not in a file system that is mounted")
    return local


def write_files(parts: DataFrame, path: str) -> DataFrame:
    """Reassembled messages as one file each below ``path``, of any length; gives ``message_id, file_path, n_bytes``.

    ``parts``: the columns of ``reassemble``. Two phases. Each task writes its parts at their offset into a
    folder of this run, in any order and without a shuffle of contents; a part that is written again after a
    failure puts the same bytes to the same place. Only when every part of every message is there, the
    folder is renamed to ``path`` in one step: readers see all files or none, and a run that fails before
    leaves nothing under ``path``. ``path`` lies in a file system that driver and executors mount, and must
    not exist. No messages give an empty folder, repeated parts count once.
    """
    path = _mounted(path)
    if os.path.exists(path):
        raise FileExistsError(path)
    staged = f"{path}.staged-{uuid.uuid4().hex}"
    os.makedirs(staged)
    rows = parts.select("message_id", F.col("part_no").cast("long"), F.col("n_parts").cast("long"),
                        F.col("total_bytes").cast("long"), F.col("byte_offset").cast("long"), "content")
    try:
        written = cut_lineage(rows.mapInArrow(_write_at(staged), WRITTEN), "exported")
        messages = written.dropDuplicates(["message_id", "part_no"]).groupBy("message_id", "file_path").agg(
            F.count_distinct("part_no").alias("_parts"), F.max("n_parts").alias("n_parts"),
            F.sum("n_bytes").alias("n_bytes"), F.max("total_bytes").alias("total_bytes"))
        partial = messages.filter((F.col("_parts") != F.col("n_parts")) | (F.col("n_bytes") != F.col("total_bytes")))
        example = partial.first()
        if example is not None:
            raise ValueError(f"message {example['message_id']} is not whole: {example['_parts']} of "
                             f"{example['n_parts']} parts, {example['n_bytes']} of {example['total_bytes']} bytes")
        os.rename(staged, path)
    except BaseException:
        shutil.rmtree(staged, ignore_errors=True)
        raise
    return messages.select("message_id", F.concat(F.lit(f"{path}/"), "file_path").alias("file_path"), "n_bytes")
