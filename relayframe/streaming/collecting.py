"""Collecting messages from arriving frames: payloads by bucket, progress as keyed state."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from ..functions import frames as X
from ..operators.framing import decode_chunk, decode_manifest
from ..operators.lookups import WIDE_ROWS, join_lookup
from ..operators.reassembly import GAP_BLOCK, message_parts

#: Directories that the payloads of a micro-batch are dealt to by message.
BUCKETS = 16
PAYLOADS = "message_id string, chunk_index bigint, room bigint, byte_offset bigint, payload binary, bucket int"
SEEN = ("message_id string, block bigint, starts array<bigint>, ends array<bigint>, chunk_count bigint, "
        "batch_no bigint, clock timestamp")
KEPT = "starts array<bigint>, ends array<bigint>, chunk_count bigint, batches array<bigint>, done boolean"
EVENTS = "message_id string, status string, n_arrived bigint, chunk_count bigint, batches array<bigint>"
COMPLETE, INCOMPLETE = "complete", "incomplete"


def arrivals(frames: DataFrame) -> DataFrame:
    """Verified chunk and manifest frames. Stateless. ``frames``: jobdata, arrived_at."""
    valid = frames.filter(X.digest_matches(F.col("jobdata")) & ~X.malformed(F.col("jobdata")))
    chunks = decode_chunk(valid).select(
        F.col("parent_id").alias("message_id"), "chunk_index", "room", "byte_offset", "payload",
        F.lit(None).cast("bigint").alias("chunk_count"), "arrived_at")
    manifests = decode_manifest(valid).select(
        F.col("parent_id").alias("message_id"), F.lit(None).cast("bigint").alias("chunk_index"),
        F.lit(None).cast("bigint").alias("room"), F.lit(None).cast("bigint").alias("byte_offset"),
        F.lit(None).cast("binary").alias("payload"),
        "chunk_count", "arrived_at")
    return chunks.unionByName(manifests)


# --- index ranges -----------------------------------------------------------------

def merged_ranges(starts: Column, ends: Column) -> tuple[Column, Column]:
    """The union of the ranges from ``starts`` up to, not including, ``ends``, as sorted ranges that do not touch.

    With both arrays sorted for themselves, a gap lies between the i-th end and the next start exactly
    where that start is larger: as many ranges have ended there as have begun.
    """
    low, high = F.array_sort(starts), F.array_sort(ends)
    begins = F.filter(low, lambda x, i: (i == 0) | (x > F.get(high, i - 1)))
    stops = F.filter(high, lambda x, i: (i == F.size(high) - 1) | (F.get(low, i + 1) > x))
    return begins, stops


def _union(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if merged and start <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(merged[-1][1], end)
        else:
            merged.append((start, end))
    return merged


# --- storing ----------------------------------------------------------------------

def clock_before(spark: SparkSession, root: str, batch_id: int) -> datetime | None:
    """The clock of the batch before. Only the first has none; one that cannot be read must not turn time back."""
    return spark.read.parquet(f"{root}/clock/v{batch_id - 1}").first()["clock"] if batch_id else None


def advance_clock(newest: DataFrame, root: str, batch_id: int) -> datetime:
    """Writes and returns the clock of a batch, the newest time so far. ``newest``: one row of ``clock``, of this batch."""
    spark, before = newest.sparkSession, clock_before(newest.sparkSession, root, batch_id)
    latest = F.greatest(F.lit(before).cast("timestamp"), F.col("clock"))
    path = f"{root}/clock/v{batch_id}"
    newest.select(F.coalesce(latest, F.timestamp_seconds(F.lit(0))).alias("clock")).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).first()["clock"]


def store_batch(root: str) -> Callable[[DataFrame, int], None]:
    """Writes the payloads of a micro-batch, its clock, and which indexes it brought.

    ``chunks/batch_no=N/bucket=B`` holds payloads, ``seen/vN`` one row for each message and block of
    ``GAP_BLOCK`` indexes, with ranges. Copies of a chunk are merged before anything is kept. The clock is the
    newest ``arrived_at`` up to this batch: it never goes back, so no row of ``seen`` is late. Frames
    without a time arrive at the clock of their batch.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64("message_id"), F.lit(BUCKETS)).cast("int")
        path = f"{root}/chunks/batch_no={batch_id}"
        batch.withColumn("bucket", bucket).write.partitionBy("bucket").mode("overwrite").parquet(path)
        new = spark.read.schema(f"{PAYLOADS}, chunk_count bigint, arrived_at timestamp").parquet(path)
        now = advance_clock(new.agg(F.max("arrived_at").alias("clock")), root, batch_id)
        _seen(new, batch_id, now).write.mode("overwrite").parquet(f"{root}/seen/v{batch_id}")

    return write


def _seen(new: DataFrame, batch_id: int, clock: datetime) -> DataFrame:
    block = F.coalesce(F.floor(F.col("chunk_index") / GAP_BLOCK), F.lit(-1)).cast("bigint")
    present = F.array_sort("present")
    starts, ends = merged_ranges(present, F.transform(present, lambda i: i + 1))
    return (
        new.withColumn("block", block).groupBy("message_id", "block").agg(
            F.collect_set("chunk_index").alias("present"), F.max("chunk_count").alias("chunk_count"))
        .select("message_id", "block", starts.alias("starts"), ends.alias("ends"), "chunk_count",
                F.lit(batch_id).cast("bigint").alias("batch_no"), F.lit(clock).alias("clock"))
    )


# --- progress ---------------------------------------------------------------------

def progress(seen: DataFrame, timeout: str) -> DataFrame:
    """Messages that became complete, or were given up ``timeout`` after their last frame. Keyed state.

    A message keeps the ranges of its indexes, its manifest's count and the batches that brought chunks of
    it; a batch touches the messages it names and no others. A finished message keeps a mark until the
    timeout, so that late copies do not start it again.
    """
    return seen.withWatermark("clock", timeout).groupBy("message_id").applyInPandasWithState(
        _step, EVENTS, KEPT, "append", "EventTimeTimeout")


def _step(key: tuple, frames: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
    starts, ends, expected, batches, done = kept.get if kept.exists else ([], [], None, [], False)
    ranges = list(zip(starts, ends, strict=True))

    def event(status: str) -> pd.DataFrame:
        return pd.DataFrame({
            "message_id": [key[0]], "status": [status], "n_arrived": [sum(e - s for s, e in ranges)],
            "chunk_count": pd.array([expected], "Int64"), "batches": [batches]})

    if kept.hasTimedOut:
        kept.remove()
        if not done:
            yield event(INCOMPLETE)
        return
    clock, brought = 0, set(batches)
    for rows in frames:
        clock = max(clock, int(rows["clock"].max().timestamp() * 1000))
        if done:
            continue
        for first, last, count, number in zip(rows["starts"], rows["ends"], rows["chunk_count"], rows["batch_no"], strict=True):
            ranges.extend((int(a), int(b)) for a, b in zip(first, last, strict=True))
            if len(first):
                brought.add(int(number))
            if not pd.isna(count):
                expected = max(int(count), expected or 0)
        ranges = _union(ranges)
    batches = sorted(brought)
    finished = not done and expected is not None and ranges == [(0, expected)]
    if finished:
        yield event(COMPLETE)
    if done or finished:
        ranges, expected, batches, done = [], None, [], True
    kept.update(([s for s, _ in ranges], [e for _, e in ranges], expected, batches, done))
    kept.setTimeoutTimestamp(max(clock, kept.getCurrentWatermarkMs() + 1))


# --- contents ---------------------------------------------------------------------

def finish_batch(root: str, part_bytes: int) -> Callable[[DataFrame, int], None]:
    """Writes the messages that a micro-batch of ``progress`` finished, and the contents of the complete ones.

    Payloads are read from the buckets and batches that hold chunks of these messages, wherever they lie in time.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = f"{root}/finished/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(path)
        ready = spark.read.schema(EVENTS).parquet(path).filter(F.col("status") == COMPLETE)
        bucket = F.pmod(F.xxhash64("message_id"), F.lit(BUCKETS)).cast("int").alias("bucket")
        places = ready.select(F.explode("batches").alias("batch_no"), bucket).distinct().collect()
        if not places:
            return
        stored = _payloads(spark, root, [(p.batch_no, p.bucket) for p in places])
        kept = join_lookup(stored, ready.select("message_id"), ["message_id"], "left_semi",
                           spread_by=F.col("chunk_index"), rows_per_task=WIDE_ROWS)
        message_parts(kept, part_bytes).join(
            ready.select("message_id", "chunk_count"), "message_id"
        ).write.mode("overwrite").parquet(f"{root}/messages/batch_id={batch_id}")

    return write


def _payloads(spark: SparkSession, root: str, places: list[tuple[int, int]]) -> DataFrame:
    """Chunks in the given (batch, bucket) directories."""
    paths = [f"{root}/chunks/batch_no={number}/bucket={bucket}" for number, bucket in sorted(places)]
    return spark.read.schema(PAYLOADS).parquet(*paths).filter(F.col("chunk_index") >= 0).select(
        "message_id", "chunk_index", "room", "byte_offset", "payload")
