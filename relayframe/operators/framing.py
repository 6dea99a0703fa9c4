"""Frames out of jobs and files, and fields out of frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import frames as X
from ..functions import layout as L
from ..node import Node
from .lookups import bounded_hot_keys, fits_broadcast, join_lookup, salted_join

# One task frames at most about this much of one file that many jobs ask for.
HOT_FILE_BYTES = 1 << 30

JOB_COLUMNS = [
    "jobid", "jobdata", "jstate", "jtype", "jsource",
    "jparent_jobid", "jdestination", "jpriority", "jcreation_time",
]


# --- decoding ---------------------------------------------------------------------

def decode_header(frames: DataFrame, column: str = "jobdata") -> DataFrame:
    """Adds the fixed header fields; names and type are trimmed."""
    frame = F.col(column)
    trimmed = {"frame_type", "frame_source", "frame_destination", "frame_priority"}
    fields = {}
    for name, place in L.HEADER.items():
        text = X.frame_text(frame, place)
        fields[name] = F.btrim(text) if name in trimmed else text
    return frames.withColumns(fields)


def _numbers(frame: Column, places: dict) -> dict[str, Column]:
    return {
        name: X.frame_text(frame, place) if name == "parent_id" else X.frame_number(frame, place)
        for name, place in places.items()
    }


def _of_type(frames: DataFrame, column: str, *types: str) -> DataFrame:
    return frames.filter(X.frame_type(F.col(column)).isin(*[L.padded(t) for t in types]))


def decode_handshake(frames: DataFrame, column: str = "jobdata") -> DataFrame:
    """Type 4 and 5 frames with the sender's capacity, port, address and name."""
    frame = F.col(column)
    fields = _numbers(frame, L.HANDSHAKE)
    fields["source_name"] = X.frame_text(frame, L.HEADER["frame_source"])
    return _of_type(frames, column, L.TYPE_REQUEST, L.TYPE_REPLY).withColumns(fields)


def decode_manifest(frames: DataFrame, column: str = "jobdata") -> DataFrame:
    """Type 3 frames with parent, total bytes, chunk count and sender name."""
    frame = F.col(column)
    fields = _numbers(frame, L.MANIFEST)
    fields["source_name"] = X.frame_text(frame, L.HEADER["frame_source"])
    return _of_type(frames, column, L.TYPE_MANIFEST).withColumns(fields)


def decode_chunk(frames: DataFrame, column: str = "jobdata") -> DataFrame:
    """Type 2 frames with index, parent, length, room per chunk, byte offset and exact payload.

    Every chunk frame of a message is exactly as long as the agreed capacity, so the room
    and offset of a chunk follow from its own frame and need no running sum.
    """
    frame = F.col(column)
    fields = _numbers(frame, L.CHUNK)
    room = (F.octet_length(frame) - L.DATA_OVERHEAD).cast("bigint")
    # A false length reads what the frame has, and never fails.
    size = F.greatest(F.least(fields["chunk_bytes"], room), F.lit(0)).cast("int")
    fields["payload"] = F.substring(frame, F.lit(L.CHUNK_PAYLOAD_AT), size)
    fields["room"] = room
    fields["byte_offset"] = fields["chunk_index"] * room
    return _of_type(frames, column, L.TYPE_CHUNK).withColumns(fields)


def decode_single(frames: DataFrame, column: str = "jobdata") -> DataFrame:
    """Type 1 frames. They carry no length, so the payload is known up to trailing blanks."""
    frame = F.col(column)
    padded = F.substring(frame, L.SINGLE_PAYLOAD_AT, X.TO_THE_END)
    return _of_type(frames, column, L.TYPE_SINGLE).withColumns({
        "payload_padded": padded,
        "payload": F.rtrim(padded.cast("string")).cast("binary"),
        "exact": F.lit(False),
    })


# --- encoding ---------------------------------------------------------------------

def addressable(peers: DataFrame) -> DataFrame:
    """Negotiated peers that can carry a payload, one per name (the smallest capacity).

    Two peers of one name would otherwise get every chunk twice, and the row count
    that completes a parent would never match. Names that the wire would cut are left out.
    """
    usable = peers.filter((F.col("system_capacity") > L.DATA_OVERHEAD) & X.fits_wire(F.col("system_name")))
    return (
        usable.groupBy(F.col("system_name").alias("jdestination"))
        .agg(F.min("system_capacity").alias("system_capacity"))
    )


def _requests(jobs: DataFrame, peers: DataFrame, state: str) -> DataFrame:
    """Narrow rows of the send jobs in ``state`` with the capacity agreed with their target."""
    narrow = jobs.filter(F.col("jstate") == state).select(
        "jobid", F.col("jobdata").cast("string").alias("file_name"),
        "jsource", "jdestination", "jpriority")
    return join_lookup(narrow, addressable(peers), ["jdestination"], spread_by=F.col("jobid"))


def attach_content(requests: DataFrame, files: DataFrame) -> DataFrame:
    """Requests joined with the bytes of their file.

    Few requests are broadcast, and contents stay where they are. Otherwise the hash table
    is built from the narrow requests and the wide files are streamed past it, unsorted. A
    file whose requests together exceed ``HOT_FILE_BYTES`` is copied to several tasks, each
    serving a share of them.
    """
    asked = requests.groupBy("file_name").agg(F.count("*").alias("n_requests"))
    again = asked.filter(F.col("n_requests") > 1).join(
        files.select("file_name", "n_bytes"), "file_name")

    def hot(share: int) -> DataFrame:
        n_salts = F.ceil(F.col("n_requests") * F.col("n_bytes") / share)
        return again.select(
            "file_name", F.least(n_salts, "n_requests").cast("int").alias("n_salts")
        ).filter(F.col("n_salts") > 1)

    contents = files.select("file_name", "content", "n_bytes")
    hot_files = bounded_hot_keys(hot, HOT_FILE_BYTES)
    if hot_files is None and fits_broadcast(requests):
        return contents.join(F.broadcast(requests), "file_name")
    return salted_join(requests, contents, ["file_name"], "inner", hot_files, F.col("jobid"),
                       hint="SHUFFLE_HASH")


def n_chunks(n_bytes, capacity) -> Column:
    return F.ceil(X.as_column(n_bytes) / (X.as_column(capacity) - L.DATA_OVERHEAD)).cast("int")


def _as_ready_job(df: DataFrame, message_id: Column, message_type: str, created_at,
                  subheader=None, payload=None, keep: tuple[str, ...] = ()) -> DataFrame:
    framed = X.encode_frame(
        message_id=F.col("frame_id"), message_type=message_type,
        source=F.btrim("jsource"), destination=F.btrim("jdestination"),
        priority=F.col("jpriority"), created_at=created_at,
        capacity=F.col("system_capacity"), subheader=subheader, payload=payload)
    return df.withColumn("frame_id", message_id).select(
        F.col("frame_id").alias("jobid"), framed.alias("jobdata"),
        F.lit(L.READY).alias("jstate"), F.lit(message_type).alias("jtype"), "jsource",
        F.col("parent_id").alias("jparent_jobid"), "jdestination", "jpriority",
        X.as_column(created_at).cast("timestamp").alias("jcreation_time"), *keep)


def encode_single(jobs: DataFrame, files: DataFrame, peers: DataFrame, created_at) -> DataFrame:
    """One type 1 frame for every S-3 job."""
    ready = attach_content(_requests(jobs, peers, L.SINGLE), files)
    ready = ready.withColumnRenamed("jobid", "parent_id")
    return _as_ready_job(ready, X.message_uid(F.col("parent_id"), "/1"),
                         L.TYPE_SINGLE, created_at, payload=F.col("content"))


def frame_chunks(rows: DataFrame, created_at, keep: tuple[str, ...] = ()) -> DataFrame:
    """Type 2 frames of files with content. Stateless: the same on a batch and on a stream.

    ``rows``: parent_id, content, n_bytes, system_capacity, jsource, jdestination, jpriority.
    """
    step = F.col("system_capacity") - L.DATA_OVERHEAD
    pieces = (
        rows.filter(F.col("n_bytes") > 0)
        .withColumn("chunk_index", F.explode(F.sequence(
            F.lit(0), n_chunks(F.col("n_bytes"), F.col("system_capacity")) - 1, F.lit(1))))
        .withColumn("piece", F.substring(F.col("content"), F.col("chunk_index") * step + 1, step))
    )
    sub = X.chunk_subheader(F.col("chunk_index"), F.col("parent_id"), F.octet_length("piece"))
    return _as_ready_job(pieces, X.message_uid(F.col("parent_id"), "/2/", F.col("chunk_index")),
                         L.TYPE_CHUNK, created_at, sub, F.col("piece"), keep)


def frame_manifests(rows: DataFrame, created_at, keep: tuple[str, ...] = ()) -> DataFrame:
    """Type 3 frames of chunked files, from their sizes alone."""
    sub = X.manifest_subheader(F.col("parent_id"), F.col("n_bytes"),
                               n_chunks(F.col("n_bytes"), F.col("system_capacity")))
    return _as_ready_job(rows, X.message_uid(F.col("parent_id"), "/3"),
                         L.TYPE_MANIFEST, created_at, sub, keep=keep)


def chunk_payloads(jobs: DataFrame, files: DataFrame, peers: DataFrame, created_at) -> DataFrame:
    """One type 2 frame for every piece of every S-2 job's file."""
    ready = attach_content(_requests(jobs, peers, L.CHUNKED), files)
    return frame_chunks(ready.withColumnRenamed("jobid", "parent_id"), created_at)


def encode_manifest(jobs: DataFrame, files: DataFrame, peers: DataFrame, created_at) -> DataFrame:
    """One type 3 frame for every S-2 job. Reads sizes only, never file contents."""
    planned = join_lookup(_requests(jobs, peers, L.CHUNKED), files.select("file_name", "n_bytes"),
                          ["file_name"], spread_by=F.col("jobid"))
    return frame_manifests(planned.withColumnRenamed("jobid", "parent_id"), created_at)


def encode_handshake(targets: DataFrame, kind: str, node: Node, created_at) -> DataFrame:
    """S-5 jobs with a 147-byte type 4 or type 5 frame.

    ``targets``: message_id, jdestination, jparent_jobid, offered_capacity.
    """
    frame = X.encode_frame(
        message_id=F.col("message_id"), message_type=kind, source=node.name,
        destination=F.col("jdestination"), priority=L.DEFAULT_PRIORITY,
        created_at=created_at, capacity=L.HANDSHAKE_BYTES,
        subheader=X.handshake_subheader(F.col("offered_capacity"), node.dataport, node.ipaddress))
    return targets.select(
        F.col("message_id").alias("jobid"), frame.alias("jobdata"),
        F.lit(L.HANDSHAKE_READY).alias("jstate"), F.lit(kind).alias("jtype"),
        F.lit(node.name).alias("jsource"), "jparent_jobid", "jdestination",
        F.lit(L.DEFAULT_PRIORITY).alias("jpriority"),
        X.as_column(created_at).cast("timestamp").alias("jcreation_time"))
