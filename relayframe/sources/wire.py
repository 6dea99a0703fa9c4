"""Received bytes to frames to jobs, send requests to jobs, and log rows."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import frames as X
from ..functions import layout as L
from ..node import Node
from ..operators.framing import JOB_COLUMNS
from ..operators.lookups import join_lookup
from . import listing


# Bytes of a stored stream that one row of work covers, and those a task holds at a time.
RANGE_BYTES = 64 << 20
STEP_BYTES = 4 << 20
STREAM_FRAMES = "path string, ipaddress long, frame_no long, jobdata binary, complete boolean"


def stored_streams(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path, length`` of the files of received bytes below a path; their contents are not read.

    Mounted folders are listed by tasks, so that no path passes the driver; files without bytes hold no frame.
    """
    roots = listing.mounted_roots(path)
    if roots:
        return listing.listed(spark, roots).filter(F.col("length") > 0)
    return spark.read.format("binaryFile").load(path).select("path", "length")


def _frame_ranges(streams: DataFrame, range_bytes: int) -> DataFrame:
    """Ranges of whole frames, of about ``range_bytes`` each; the last one also covers the remainder."""
    size = F.col("frame_size").cast("bigint")
    per_range = F.greatest(F.lit(1), F.floor(F.lit(range_bytes) / size)).cast("bigint")
    ranges = F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("length") / (per_range * size)).cast("bigint") - 1)
    return (
        streams.filter(F.col("length") > 0).withColumn("_range", F.explode(ranges))
        .select("path", "ipaddress", size.alias("frame_size"), (F.col("_range") * per_range).alias("first_frame"),
                F.least(per_range * size, F.col("length") - F.col("_range") * per_range * size).alias("n_bytes"))
    )


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The frames of each range, cut by offsets in steps of ``STEP_BYTES``: no Python work per frame."""
    for batch in batches:
        for row in batch.to_pylist():
            system, name = pa.fs.FileSystem.from_uri(re.sub(r"\Afile:/+", "/", row["path"]))
            size, at, left = row["frame_size"], row["first_frame"] * row["frame_size"], row["n_bytes"]
            step = max(1, STEP_BYTES // size) * size
            with system.open_input_file(name) as stored:
                while left:
                    data = stored.read_at(min(step, left), at)
                    if len(data) < min(step, left):
                        raise OSError(f"{row['path']} became shorter than it was listed")
                    starts = np.arange(0, len(data), size)
                    offsets = np.append(starts, len(data)).astype(np.int32)
                    n = len(starts)
                    frames = pa.Array.from_buffers(
                        pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row["path"]] * n, pa.string()),
                        pa.array(np.full(n, row["ipaddress"] or 0), pa.int64(), mask=np.full(n, row["ipaddress"] is None)),
                        pa.array((at + starts) // size), frames, pa.array(np.diff(offsets) == size)],
                        ["path", "ipaddress", "frame_no", "jobdata", "complete"])
                    at, left = at + len(data), left - len(data)


def split_streams(streams: DataFrame, sizes: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Cuts stored byte streams of any length into frames of the size agreed with their address.

    ``streams``: path, length, ipaddress; one file holds what one connection received. ``sizes``: ipaddress,
    frame_size. Files are cut into ranges that begin at a frame, so one long file is read by many tasks,
    and no task holds more than ``STEP_BYTES`` or one frame. What is left at the end of a file is a row with ``complete``
    false, for the next burst. A file from an address without a size above 0 gives no frame, an empty
    one neither. Only paths and ranges are shuffled.
    """
    sized = join_lookup(streams.select("path", "length", "ipaddress"),
                        sizes.select("ipaddress", "frame_size").filter(F.col("frame_size") > 0), ["ipaddress"],
                        spread_by=F.col("path"))
    # The number is given, for rows of ranges are small and would all be joined into one task.
    n = int(streams.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = _frame_ranges(sized, range_bytes).repartition(n, "path", "first_frame")
    return ranges.mapInArrow(_read_ranges, STREAM_FRAMES)


def read_frames(spark: SparkSession, path: str, size: int) -> DataFrame:
    """``jobdata, complete`` of files of equally long frames, read in parallel ranges."""
    files = stored_streams(spark, path).withColumns({
        "ipaddress": F.lit(None).cast("bigint"), "frame_size": F.lit(size)})
    ranges = _frame_ranges(files, RANGE_BYTES).repartition("path", "first_frame")
    return ranges.mapInArrow(_read_ranges, STREAM_FRAMES).select("jobdata", "complete")


def split_frames(bursts: DataFrame, sizes: DataFrame) -> DataFrame:
    """Cuts bursts of bytes into frames of the size agreed with the sending address.

    ``bursts``: burst_id, fd, ipaddress, content. ``sizes``: ipaddress, frame_size. A
    burst from an address without a size gives no frame. What is left at the end of a
    burst is kept, with ``complete`` false.
    """
    sized = join_lookup(bursts, sizes.filter(F.col("frame_size") > 0), ["ipaddress"],
                        spread_by=F.col("burst_id"))
    size = F.col("frame_size")
    length = F.octet_length("content")
    count = F.ceil(length / size).cast("int")
    return (
        sized.filter(length > 0)
        .withColumn("frame_no", F.explode(F.sequence(F.lit(0), count - 1, F.lit(1))))
        .withColumn("jobdata", F.substring(
            F.col("content"), (F.col("frame_no") * size + 1).cast("int"), size.cast("int")))
        .select("burst_id", "fd", "ipaddress", "frame_no", "jobdata",
                (F.octet_length("jobdata") == size).alias("complete"))
    )


def latest_sizes(capacity_events: DataFrame) -> DataFrame:
    """The frame size of each sending address: its latest capacity event."""
    return capacity_events.groupBy(F.col("rdata1").alias("ipaddress")).agg(
        F.max_by("rdata2", "rcomid").alias("frame_size"))


def ingest_frames(frames: DataFrame, node: Node, received_at) -> DataFrame:
    """Received frames as N-1 jobs below the root.

    ``frames``: frame_key (unique text), fd, jobdata. The job identifier follows from
    the key, so reading the same frame again after a failure gives the same row, while
    two copies that really arrived keep two rows.
    """
    return frames.select(
        X.message_uid("in/", F.col("frame_key")).alias("jobid"), "jobdata",
        F.lit(L.RECEIVED).alias("jstate"), F.lit(L.TYPE_ROOT).alias("jtype"),
        F.col("fd").cast("string").alias("jsource"), F.lit(node.root_id).alias("jparent_jobid"),
        F.lit("0").alias("jdestination"), F.lit(L.DEFAULT_PRIORITY).alias("jpriority"),
        X.as_column(received_at).cast("timestamp").alias("jcreation_time")).select(*JOB_COLUMNS)


def create_send_jobs(requests: DataFrame, files: DataFrame, node: Node, created_at
                     ) -> tuple[DataFrame, DataFrame]:
    """Send jobs for files that exist, and rejected requests with the reason.

    ``requests``: request_id, file_name, destination. A destination longer than the wire's name field
    would be cut to another peer's name there, so it is rejected.
    """
    names = files.select("file_name")
    spread = F.col("request_id")
    accepted = join_lookup(requests, names, ["file_name"], "left_semi", spread_by=spread)
    rejected = join_lookup(requests, names, ["file_name"], "left_anti", spread_by=spread)
    rejected = rejected.withColumn("reason", F.lit("no such file"))
    sendable = X.fits_wire(F.col("destination"))
    rejected = rejected.unionByName(
        accepted.filter(~sendable).withColumn("reason", F.lit("name too long for the wire")))
    accepted = accepted.filter(sendable)
    jobs = accepted.select(
        X.message_uid("send/", F.col("request_id")).alias("jobid"),
        F.col("file_name").cast("binary").alias("jobdata"), F.lit(L.REQUESTED).alias("jstate"),
        F.lit(L.padded(L.TYPE_SEND)).alias("jtype"), F.lit(node.name).alias("jsource"),
        F.lit(node.root_id).alias("jparent_jobid"),
        X.norm_name(F.col("destination")).alias("jdestination"),
        F.lit(L.DEFAULT_PRIORITY).alias("jpriority"),
        X.as_column(created_at).cast("timestamp").alias("jcreation_time"))
    return jobs, rejected


def log_text(*parts) -> Column:
    """One log line from texts, numbers and columns."""
    return F.concat(*[X.as_column(part).cast("string") for part in parts])


def as_logs(rows: DataFrame, text: Column, at, key: tuple[str, ...] | None = None) -> DataFrame:
    """Log rows. The identifier follows from the row: its ``key`` columns, else all of them.

    Equal texts at one time are two log rows with two identifiers, if their keys differ.
    """
    named = F.xxhash64(*(key or rows.columns), X.as_column(at).cast("timestamp"), text)
    return rows.select(named.alias("logid"), text.alias("log"),
                       X.as_column(at).cast("timestamp").alias("lgtime"))


def append_logs(logs: DataFrame, path: str) -> None:
    """Appends log rows to a table partitioned by day."""
    logs.withColumn("day", F.to_date("lgtime")).write.mode("append").partitionBy("day").parquet(path)
