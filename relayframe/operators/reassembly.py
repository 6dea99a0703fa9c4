"""Completion of chunked messages and their reassembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import frames as X
from ..functions import layout as L
from .framing import JOB_COLUMNS, decode_chunk, decode_manifest
from .lookups import WIDE_ROWS, join_lookup

# Limits of one reassembled part; longer messages become several rows.
PART_BYTES = 32 << 20
PART_CHUNKS = 1 << 16
# Chunk indexes compared per group when looking for gaps.
GAP_BLOCK = 4096


def _classified(jobs: DataFrame, kind: str) -> DataFrame:
    """Classified well-formed frames of one type; the job table is partitioned by both columns."""
    return jobs.filter((F.col("jstate") == L.CLASSIFIED) & (F.col("jtype") == L.padded(kind))
                       & ~X.malformed(F.col("jobdata")))


def chunk_keys(jobs: DataFrame) -> DataFrame:
    """Message, index and length of every classified chunk, without its payload."""
    frame = F.col("jobdata")
    return (
        _classified(jobs, L.TYPE_CHUNK)
        .select(X.frame_text(frame, L.CHUNK["parent_id"]).alias("message_id"),
                X.frame_number(frame, L.CHUNK["chunk_index"]).alias("chunk_index"),
                X.frame_number(frame, L.CHUNK["chunk_bytes"]).alias("chunk_bytes"))
    )


def manifests(jobs: DataFrame) -> DataFrame:
    """One row per distinct manifest content; re-sent manifests fall together."""
    return (
        decode_manifest(_classified(jobs, L.TYPE_MANIFEST))
        .select(F.col("parent_id").alias("message_id"), "total_bytes", "chunk_count",
                "source_name", F.octet_length("jobdata").alias("frame_bytes"))
        .distinct()
    )


def completion_status(parents: DataFrame, children: DataFrame, mode: str = "rows",
                      extra: int = 0) -> DataFrame:
    """How many children of each parent are complete, and whether all are.

    ``parents``: parent_id, expected. ``children``: parent_id, jstate, chunk_index.
    ``rows`` counts rows, so a duplicate can stand in for a missing chunk; ``distinct``
    counts indexes. ``extra`` is the number of further children expected (a manifest).
    The children are reduced per parent before the join; equal to the self-join of
    siblings, as each manifest sees every complete sibling.
    """
    done = children.filter(F.col("jstate") == L.COMPLETE)
    if mode == "distinct":
        done = done.select("parent_id", "chunk_index").distinct()
    counted = done.groupBy("parent_id").agg(F.count("*").alias("n_done"))
    return parents.join(counted, "parent_id", "left").select(
        *parents.columns,
        F.coalesce("n_done", F.lit(0)).alias("n_done"),
        (F.coalesce("n_done", F.lit(0)) == F.col("expected") + extra).alias("is_complete"))


def incoming_complete(jobs: DataFrame, mode: str = "rows") -> DataFrame:
    """Manifests whose chunks have all arrived, one row per message.

    ``rows`` compares the number of chunk rows; ``distinct`` demands every index from
    0 to count - 1, and that their lengths add up to the manifest's size. Both count per message
    ahead of the join.
    """
    keys = chunk_keys(jobs)
    if mode == "distinct":
        keys = keys.groupBy("message_id", "chunk_index").agg(F.min("chunk_bytes").alias("chunk_bytes"))
    arrived = keys.groupBy("message_id").agg(
        F.count("*").alias("n_arrived"), F.sum("chunk_bytes").alias("_bytes"),
        F.min("chunk_index").alias("_low"), F.max("chunk_index").alias("_high"))
    matched = manifests(jobs).join(arrived, "message_id").filter(
        F.col("chunk_count") == F.col("n_arrived"))
    if mode == "distinct":
        matched = matched.filter(
            (F.col("_low") == 0) & (F.col("_high") == F.col("chunk_count") - 1)
            & (F.col("_bytes") == F.col("total_bytes")))
    return matched.select(
        "message_id", "total_bytes", "chunk_count", "source_name", "frame_bytes",
        F.col("_high").alias("last_index"))


def missing_chunks(jobs: DataFrame) -> DataFrame:
    """One row per missing chunk of a message whose manifest has arrived.

    Indexes are compared in blocks of ``GAP_BLOCK``, so no group holds more than one
    block however long the message is.
    """
    block = F.floor(F.col("chunk_index") / GAP_BLOCK).cast("bigint")
    present = (
        chunk_keys(jobs).withColumn("block", block)
        .groupBy("message_id", "block").agg(F.collect_set("chunk_index").alias("present"))
    )
    last_block = F.floor((F.col("chunk_count") - 1) / GAP_BLOCK).cast("bigint")
    expected = (
        manifests(jobs).filter(F.col("chunk_count") > 0)
        .select("message_id", "chunk_count").distinct()
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
    )
    low = F.col("block") * GAP_BLOCK
    high = F.least(low + GAP_BLOCK, F.col("chunk_count")) - 1
    nothing = F.array().cast("array<bigint>")
    gaps = F.array_except(F.sequence(low, high), F.coalesce("present", nothing))
    return (
        expected.join(present, ["message_id", "block"], "left")
        .select("message_id", F.explode(gaps).alias("missing_index"))
    )


def chunks_of_message(jobs: DataFrame, mode: str = "rows") -> DataFrame:
    """The chunks of complete messages; byte-identical copies count once.

    Identical copies have equal digests, so the digest stands for the whole frame.
    """
    digest = X.frame_text(F.col("jobdata"), L.HEADER["digest"])
    chunks = decode_chunk(_classified(jobs, L.TYPE_CHUNK)).select(
        F.col("parent_id").alias("message_id"), digest.alias("digest"),
        "chunk_index", "byte_offset", "payload")
    complete = incoming_complete(jobs, mode).select("message_id").distinct()
    kept = join_lookup(chunks, complete, ["message_id"], "left_semi", spread_by=F.col("digest"),
                       rows_per_task=WIDE_ROWS, write_lookup=True)
    return kept.dropDuplicates(["message_id", "digest"]).drop("digest")


def chunks_per_part(room: Column, part_bytes: int) -> Column:
    """Whole chunks that make up a part, given the payload room of a chunk."""
    return F.greatest(F.lit(1), F.least(F.floor(F.lit(part_bytes) / room), F.lit(PART_CHUNKS)))


def collect_parts(chunks: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Chunks grouped into parts of about ``part_bytes``, in index order, without copies.

    The part of a chunk follows from its index, so a message of any length is spread over
    as many groups as it has parts and no group exceeds one part. Copies of a chunk are
    merged before the only shuffle of payloads.
    """
    part = F.floor(F.col("chunk_index") / chunks_per_part(F.col("room"), part_bytes)).cast("bigint")
    ordered = F.col("_ordered")
    new_index = (lambda piece, i: (i == 0) | (
        piece["chunk_index"] != F.get(ordered, i - 1)["chunk_index"]))
    return (
        chunks.withColumn("part_no", part)
        .groupBy("message_id", "part_no")
        .agg(F.collect_set(F.struct("chunk_index", "byte_offset", "payload")).alias("_pieces"))
        .withColumn("_ordered", F.array_sort("_pieces"))
        .select("message_id", "part_no", F.filter(ordered, new_index).alias("pieces"))
    )


def message_parts(chunks: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Chunks joined into the bytes of each part.

    ``array_join`` appends raw bytes in one pass; casting binary to string and back
    keeps every byte.
    """
    texts = F.transform("pieces", lambda piece: piece["payload"].cast("string"))
    return collect_parts(chunks, part_bytes).select(
        "message_id", "part_no", F.col("pieces")[0]["byte_offset"].alias("byte_offset"),
        F.array_join(texts, "").cast("binary").alias("content"))


def _payloads(jobs: DataFrame) -> DataFrame:
    return decode_chunk(_classified(jobs, L.TYPE_CHUNK)).select(
        F.col("parent_id").alias("message_id"), "chunk_index", "room", "byte_offset", "payload")


def complete_parts(jobs: DataFrame, part_bytes: int, mode: str) -> DataFrame:
    """Complete messages as (message, part): the key their parts are partitioned by."""
    room = F.col("frame_bytes") - L.DATA_OVERHEAD
    last_part = F.floor(F.col("last_index") / chunks_per_part(room, part_bytes)).cast("bigint")
    return (
        incoming_complete(jobs, mode)
        .groupBy("message_id").agg(
            F.max("total_bytes").alias("total_bytes"), F.max(last_part).alias("_last"))
        .select("message_id", "total_bytes", (F.col("_last") + 1).alias("n_parts"),
                F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_last"))).alias("part_no"))
    )


def reassemble(jobs: DataFrame, part_bytes: int = PART_BYTES, mode: str = "distinct") -> DataFrame:
    """The contents of complete messages: one row per part, one part for most messages.

    Parts meet the list of complete messages on (message, part), so payloads are
    shuffled once.
    """
    parts = message_parts(_payloads(jobs), part_bytes)
    return parts.join(complete_parts(jobs, part_bytes, mode), ["message_id", "part_no"]).select(
        "message_id", "part_no", "n_parts", "byte_offset", "total_bytes", "content")


def reassemble_ordered(jobs: DataFrame, part_bytes: int = PART_BYTES, mode: str = "distinct"
                       ) -> DataFrame:
    """The same as ordered chunk rows with their byte offset, for messages of any size.

    The rows of a part follow each other in index order; a long message spans many
    partitions. A writer that needs bytes at their place has the offset on every row.
    """
    parts = collect_parts(_payloads(jobs), part_bytes)
    complete = complete_parts(jobs, part_bytes, mode)
    return (
        parts.join(complete, ["message_id", "part_no"])
        .select("message_id", "part_no", F.explode("pieces").alias("_piece"))
        .select("message_id", "part_no", "_piece.*")
    )


def finish_incoming(jobs: DataFrame, mode: str = "rows") -> DataFrame:
    """Classified chunks and manifests of complete messages to C."""
    kinds = [L.padded(L.TYPE_CHUNK), L.padded(L.TYPE_MANIFEST)]
    data = (F.col("jstate") == L.CLASSIFIED) & F.col("jtype").isin(*kinds)
    frame = F.col("jobdata")
    message = F.when(F.col("jtype") == kinds[0], X.frame_text(frame, L.CHUNK["parent_id"])).otherwise(
        X.frame_text(frame, L.MANIFEST["parent_id"]))
    complete = (
        incoming_complete(jobs, mode).select("message_id").distinct()
        .withColumn("_complete", F.lit(True))
    )
    joined = join_lookup(jobs.filter(data).withColumn("message_id", message), complete,
                         ["message_id"], "left", spread_by=F.col("jobid"),
                         rows_per_task=WIDE_ROWS, write_lookup=True)
    state = F.when(F.col("_complete"), L.COMPLETE).otherwise(F.col("jstate"))
    return jobs.filter(~data).select(*JOB_COLUMNS).unionByName(
        joined.withColumn("jstate", state).select(*JOB_COLUMNS))
