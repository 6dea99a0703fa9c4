"""The registered queries: every operator over the driver's whole tables.

Each takes (spark, sf_dir) and returns a DataFrame whose columns are named and typed
like its SQL in ``oracles``. Binary columns leave as MD5 text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import frames as X
from ..functions import layout as L
from ..node import NodeState
from ..operators import (
    changes,
    framing,
    integrity,
    negotiate,
    queues,
    reassembly,
    reports,
    transitions,
)
from ..session import work_path
from ..sources import files as file_io
from ..sources import fixtures as fx
from ..sources import state as store
from ..sources import wire
from ..streaming import streams
from .tick import commit_tick, run_tick

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TICK = 7
# What stands for a null in the names of folders and files.
NO_KEY = "__HIVE_DEFAULT_PARTITION__"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def big(name: str) -> Column:
    return F.col(name).cast("bigint").alias(name)


def md5_of(column: str, name: str) -> Column:
    return F.md5(F.col(column)).alias(name)


def jobs_out(jobs: DataFrame) -> DataFrame:
    return jobs.select("jobid", "jstate", "jtype", "jdestination", big("jpriority"),
                       "jparent_jobid", md5_of("jobdata", "data_md5"))


# --- sources and sinks ------------------------------------------------------------

@query
def import_files(spark, sf_dir):
    """Documents written out as a text file each, and imported."""
    path = work_path(spark, "documents")
    # Tasks write the files, as a Hadoop writer starts processes for each; rows of one doc_id are one file.
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit(NO_KEY)).alias("message_id")
    line = F.concat(F.coalesce("text", F.lit("")), F.lit("\n")).cast("binary").alias("content")
    size, rows = F.octet_length("content").cast("bigint"), Window.partitionBy("message_id")
    so_far = rows.orderBy("content").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    file_io.write_files(fx.table(spark, sf_dir, "documents").select(named, line).select(
        "message_id", (F.row_number().over(rows.orderBy("content")) - 1).alias("part_no"),
        F.count("*").over(rows).alias("n_parts"), (F.sum(size).over(so_far) - size).alias("byte_offset"),
        F.sum(size).over(rows).alias("total_bytes"), "content"), path)
    found = file_io.import_files(spark, path, fx.t0(), glob="m-*", recursive=True)
    name = F.url_decode(F.regexp_extract("file_name", "/m-([^/]+)\\z", 1)).alias("file_name")
    return found.select(name, "n_bytes", md5_of("content", "content_md5"))


@query
def split_frames(spark, sf_dir):
    hello = fx.handshake_frames(fx.table(spark, sf_dir, "supplier"), L.TYPE_REQUEST)
    frame = F.col("jobdata")
    bursts = hello.select(
        (F.col("ipaddress") - fx.SUPPLIER_IP).alias("burst_id"), "fd", "ipaddress",
        F.concat(frame, frame, frame, frame, F.substring(frame, 1, 50)).alias("content"))
    sizes = hello.select("ipaddress", F.lit(L.HANDSHAKE_BYTES).alias("frame_size"))
    return wire.split_frames(bursts, sizes).select(
        "burst_id", big("frame_no"), "complete", md5_of("jobdata", "data_md5"))


@query
def split_streams(spark, sf_dir):
    """Each document as the bytes that one peer sent, cut by three sizes."""
    path = work_path(spark, "streams")
    number, content = F.col("doc_id"), F.coalesce("text", F.lit("")).cast("binary")
    file_io.write_files(fx.table(spark, sf_dir, "documents").select(
        number.cast("string").alias("message_id"), F.lit(0).alias("part_no"), F.lit(1).alias("n_parts"),
        F.lit(0).alias("byte_offset"), F.octet_length(content).alias("total_bytes"), content.alias("content")), path)
    address = F.regexp_extract("path", "/m-([0-9]+)\\z", 1).cast("bigint").alias("ipaddress")
    found = wire.stored_streams(spark, f"{path}/*").select("path", "length", address)
    sizes = fx.table(spark, sf_dir, "documents").select(
        number.alias("ipaddress"), (number % 3 * 256 + 512).cast("int").alias("frame_size"))
    return wire.split_streams(found, sizes, range_bytes=4096).select(
        F.col("ipaddress").alias("doc_id"), "frame_no", "complete", md5_of("jobdata", "data_md5"))


@query
def ingest_frames(spark, sf_dir):
    jobs = fx.received_messages(spark, sf_dir)
    return jobs.select("jobid", "jstate", "jtype", "jdestination", big("jpriority"),
                       "jparent_jobid", md5_of("jobdata", "data_md5"), "jsource")


@query
def create_send_jobs(spark, sf_dir):
    key = F.col("c_custkey").cast("string")
    requests = fx.table(spark, sf_dir, "customer").select(
        key.alias("request_id"), F.concat(F.lit("doc-"), key).alias("file_name"),
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("destination"))
    jobs, rejected = wire.create_send_jobs(
        requests, fx.files(spark, sf_dir), fx.node(), fx.t0())
    accepted = jobs.select(
        "jobid", F.col("jobdata").cast("string").alias("file_name"), "jstate", "jdestination")
    return accepted.unionByName(rejected.select(
        X.message_uid("send/", F.col("request_id")).alias("jobid"), "file_name",
        F.lit("rejected").alias("jstate"), X.norm_name(F.col("destination")).alias("jdestination")))


@query
def append_logs(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    text = wire.log_text("event ", F.col("event_id"), " of user ", F.col("user_id"), " : ",
                         F.col("event_type"))
    path = work_path(spark, "logs")
    wire.append_logs(wire.as_logs(events, text, F.col("ts"), key=("event_id",)), path)
    return spark.read.parquet(path).select("log", F.col("day").cast("string").alias("day"))


@query
def export_files(spark, sf_dir):
    path = work_path(spark, "export")
    file_io.export_files(reassembly.reassemble(fx.received_chunks(spark, sf_dir)), path)
    return spark.read.parquet(path).select(
        "message_id", "part_no", F.octet_length("content").cast("bigint").alias("n_bytes"),
        md5_of("content", "content_md5"))


@query
def received_files(spark, sf_dir):
    """Messages in several parts, as files that can be sent on."""
    parts = reassembly.reassemble(fx.received_chunks(spark, sf_dir), part_bytes=4096)
    stored, _ = file_io.received_files(parts, fx.t0())
    return stored.select("file_id", "file_name", "n_bytes", md5_of("content", "content_md5"))


@query
def write_files(spark, sf_dir):
    """Messages written as files, and those files imported again."""
    path = work_path(spark, "messages")
    parts = reassembly.reassemble(fx.received_chunks(spark, sf_dir), part_bytes=4096)
    written = file_io.write_files(parts, path)
    found = file_io.import_files(spark, f"{path}/*", fx.t0())
    name = F.url_decode(F.regexp_extract("file_name", "/m-([^/]+)\\z", 1))
    return found.select(name.alias("message_id"), big("n_bytes"), md5_of("content", "content_md5")).join(
        written.select("message_id", F.col("n_bytes").alias("n_written")), "message_id")


@query
def load_save_state(spark, sf_dir):
    path = work_path(spark, "state")
    state = fx.new_state(spark, sf_dir).with_tables(
        jobs=fx.family_jobs(spark, sf_dir), peers=fx.peers(spark, sf_dir))
    store.save_state(state, path)
    saved = store.load_state(spark, path)
    counts = saved.jobs.groupBy("jstate").count().select(
        F.lit("jobs").alias("table_name"), F.col("jstate").alias("part"),
        F.col("count").alias("n_rows"))
    for name in ("files", "peers"):
        counts = counts.unionByName(getattr(saved, name).agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), F.lit("").alias("part"), "n_rows"))
    return counts


@query
def seed_node(spark, sf_dir):
    nodes = fx.table(spark, sf_dir, "supplier").select(
        fx.uid("root", F.col("s_suppkey")).alias("root_id"), fx.supplier_name().alias("system_name"))
    return store.root_jobs(nodes, fx.t0()).select(
        "jobid", "jparent_jobid", "jsource", "jdestination", "jstate", "jtype", big("jpriority"),
        F.col("jobdata").cast("string").alias("jobdata"))


# --- framing ----------------------------------------------------------------------

@query
def encode_frame(spark, sf_dir):
    frame = X.encode_frame(
        message_id=fx.uid("msg", F.col("conv_id"), "-", F.col("turn")), message_type=L.TYPE_SINGLE,
        source=F.concat(F.lit("src"), (F.col("conv_id") % 20).cast("string")),
        destination=F.when(F.col("conv_id") % 3 == 0, "src1").otherwise(F.lit("M3")),
        priority=L.DEFAULT_PRIORITY, created_at=fx.t0(), capacity=fx.MESSAGE_CAPACITY,
        payload=F.col("text").cast("binary"))
    framed = fx.table(spark, sf_dir, "conversations").withColumn("frame", frame)
    return framed.select("conv_id", "turn", F.octet_length("frame").cast("bigint").alias("n_bytes"),
                         md5_of("frame", "data_md5"))


@query
def decode_header(spark, sf_dir):
    return framing.decode_header(fx.received_messages(spark, sf_dir)).select(
        "jobid", *L.HEADER)


@query
def decode_handshake(spark, sf_dir):
    return framing.decode_handshake(
        fx.received_handshakes(spark, sf_dir, L.TYPE_REQUEST)
    ).select("jobid", *L.HANDSHAKE, "source_name")


@query
def decode_manifest(spark, sf_dir):
    return framing.decode_manifest(fx.received_chunks(spark, sf_dir)).select(
        "jobid", F.col("parent_id").alias("message_id"), "total_bytes", "chunk_count",
        "source_name")


@query
def decode_chunk(spark, sf_dir):
    return framing.decode_chunk(fx.received_chunks(spark, sf_dir)).select(
        "jobid", F.col("parent_id").alias("message_id"), "chunk_index", "chunk_bytes",
        "byte_offset", md5_of("payload", "payload_md5"))


@query
def decode_single(spark, sf_dir):
    singles = framing.encode_single(fx.planned_sends(spark, sf_dir), fx.files(spark, sf_dir),
                                    fx.peers(spark, sf_dir), fx.t0())
    return framing.decode_single(singles).select("jobid", md5_of("payload", "payload_md5"))


@query
def encode_single(spark, sf_dir):
    return jobs_out(framing.encode_single(fx.planned_sends(spark, sf_dir), fx.files(spark, sf_dir),
                                          fx.peers(spark, sf_dir), fx.t0()))


@query
def chunk_payloads(spark, sf_dir):
    return jobs_out(framing.chunk_payloads(fx.planned_sends(spark, sf_dir), fx.files(spark, sf_dir),
                                           fx.peers(spark, sf_dir), fx.t0()))


@query
def encode_manifest(spark, sf_dir):
    return jobs_out(framing.encode_manifest(fx.planned_sends(spark, sf_dir), fx.files(spark, sf_dir),
                                            fx.peers(spark, sf_dir), fx.t0()))


@query
def encode_handshake(spark, sf_dir):
    frames = fx.handshake_frames(fx.table(spark, sf_dir, "supplier"), L.TYPE_REPLY)
    return frames.select(
        (F.col("ipaddress") - fx.SUPPLIER_IP).alias("s_suppkey"),
        F.octet_length("jobdata").cast("bigint").alias("n_bytes"), md5_of("jobdata", "data_md5"))


@query
def show_files_info(spark, sf_dir):
    return reports.show_files_info(fx.files(spark, sf_dir)).drop("creation_time")


@query
def show_jobs_info(spark, sf_dir):
    info = reports.show_jobs_info(fx.send_jobs(spark, sf_dir))
    return info.withColumn("jpriority", big("jpriority"))


# --- transitions ------------------------------------------------------------------

def verified(spark, sf_dir) -> DataFrame:
    return transitions.verify_integrity(fx.received_messages(spark, sf_dir))


@query
def verify_integrity(spark, sf_dir):
    return jobs_out(verified(spark, sf_dir))


@query
def dead_letter(spark, sf_dir):
    return jobs_out(transitions.dead_letter(fx.received_messages(spark, sf_dir)))


@query
def route_local(spark, sf_dir):
    return jobs_out(transitions.route_local(verified(spark, sf_dir), fx.node()))


@query
def route_forward(spark, sf_dir):
    return transitions.route_forward(verified(spark, sf_dir), fx.node()).select(
        "jobid", "jstate", "jdestination")


@query
def classify_type(spark, sf_dir):
    local = transitions.route_local(verified(spark, sf_dir), fx.node())
    return transitions.classify_type(local).select("jobid", "jstate", "jtype")


@query
def advance_inbound(spark, sf_dir):
    return jobs_out(transitions.advance_inbound(fx.received_messages(spark, sf_dir), fx.node()))


@query
def complete_chunked_parents(spark, sf_dir):
    return jobs_out(transitions.complete_chunked_parents(fx.family_jobs(spark, sf_dir)))


@query
def complete_single_parents(spark, sf_dir):
    return jobs_out(transitions.complete_single_parents(fx.family_jobs(spark, sf_dir)))


@query
def admit_known_peers(spark, sf_dir):
    lanes = fx.lane_jobs(spark, sf_dir)
    asked = transitions.move(lanes, F.col("jstate") == L.READY, L.REQUESTED)
    return jobs_out(transitions.admit_known_peers(asked, fx.supplier_peers(spark, sf_dir, True)))


@query
def finish_handshake(spark, sf_dir):
    return jobs_out(transitions.finish_handshake(
        fx.classified_handshakes(spark, sf_dir, L.TYPE_REQUEST), L.TYPE_REQUEST))


def _state_and_target(jobs: DataFrame) -> DataFrame:
    return jobs.select("jobid", "jstate", "jdestination")


@query
def plan_chunked(spark, sf_dir):
    return _state_and_target(transitions.plan_chunked(
        fx.send_jobs(spark, sf_dir, L.ADMITTED), fx.files(spark, sf_dir), fx.peers(spark, sf_dir)))


@query
def plan_single(spark, sf_dir):
    return _state_and_target(transitions.plan_single(
        fx.send_jobs(spark, sf_dir, L.ADMITTED), fx.files(spark, sf_dir), fx.peers(spark, sf_dir)))


@query
def await_chunks(spark, sf_dir):
    return _state_and_target(transitions.await_chunks(
        fx.planned_sends(spark, sf_dir), fx.peers(spark, sf_dir)))


@query
def await_single(spark, sf_dir):
    return _state_and_target(transitions.await_single(
        fx.planned_sends(spark, sf_dir), fx.peers(spark, sf_dir)))


def _pending(spark, sf_dir) -> DataFrame:
    return queues.pending_with_conn(
        fx.lane_jobs(spark, sf_dir), fx.supplier_peers(spark, sf_dir, True),
        fx.supplier_conns(spark, sf_dir))


@query
def mark_taken(spark, sf_dir):
    picked = queues.top_pending(_pending(spark, sf_dir), 3, per_peer=True)
    return jobs_out(transitions.mark_taken(fx.lane_jobs(spark, sf_dir), picked))


@query
def apply_send_status(spark, sf_dir):
    acks = fx.acks(fx.table(spark, sf_dir, "events"), fx.uid("job", F.col("user_id")))
    jobs = fx.send_jobs(spark, sf_dir, L.READY_TAKEN)
    return transitions.apply_send_status(jobs, acks).select("jobid", "jstate")


@query
def apply_handshake_status(spark, sf_dir):
    acks = fx.acks(fx.table(spark, sf_dir, "events"), fx.uid("lane", F.col("event_id")))
    return transitions.apply_handshake_status(fx.lane_jobs(spark, sf_dir), acks).select(
        "jobid", "jstate")


@query
def update_job_priority(spark, sf_dir):
    updates = fx.table(spark, sf_dir, "events").select(
        fx.uid("ord", F.col("user_id")).alias("jobid"),
        (F.col("event_id") % 10).cast("int").alias("new_priority"),
        F.col("event_id").alias("update_no"))
    return transitions.update_job_priority(fx.family_jobs(spark, sf_dir), updates).select(
        "jobid", big("jpriority"))


@query
def apply_connection_status(spark, sf_dir):
    conns, commands = queues.apply_connection_status(
        fx.supplier_conns(spark, sf_dir), fx.commands(spark, sf_dir), fx.conn_reports(spark, sf_dir))
    return conns.select(
        F.lit("conn").alias("kind"), F.col("sipaddr").alias("id"),
        F.col("sfd").cast("bigint").alias("fd"), F.col("scstatus").cast("bigint").alias("status")
    ).unionByName(commands.select(
        F.lit("command").alias("kind"), F.col("scommid").alias("id"),
        F.col("mdata2").cast("bigint").alias("fd"), F.lit(None).cast("bigint").alias("status")))


@query
def take_command(spark, sf_dir):
    commands = fx.commands(spark, sf_dir)
    picked = commands.filter(F.col("mtype").isin(L.COMMAND_OPEN, L.COMMAND_CLOSE))
    return queues.take_command(commands, picked).select("scommid", "mtype")


# --- joins ------------------------------------------------------------------------

def _sent(jobs: DataFrame) -> DataFrame:
    return jobs.select("jobid", "jdestination", md5_of("jobdata", "data_md5"))


@query
def handshake_requests(spark, sf_dir):
    return _sent(negotiate.handshake_requests(
        fx.send_jobs(spark, sf_dir), fx.peers(spark, sf_dir), fx.node(), fx.t0()))


@query
def handshake_requests_per_job(spark, sf_dir):
    return _sent(negotiate.handshake_requests(
        fx.send_jobs(spark, sf_dir), fx.peers(spark, sf_dir), fx.node(), fx.t0(), distinct=False))


def _handshakes(spark, sf_dir, kind) -> DataFrame:
    return negotiate.handshakes(fx.classified_handshakes(spark, sf_dir, kind), kind)


@query
def handshake_replies(spark, sf_dir):
    requests = _handshakes(spark, sf_dir, L.TYPE_REQUEST)
    return _sent(negotiate.handshake_replies(requests, fx.node(), fx.t0()))


def _peers_out(peers: DataFrame) -> DataFrame:
    return peers.select("system_name", "ipaddress", big("dataport"), big("comssport"),
                        big("system_capacity"))


def _peer_writes(spark, sf_dir) -> DataFrame:
    return negotiate.peer_writes(_handshakes(spark, sf_dir, L.TYPE_REQUEST), fx.node())


@query
def upsert_peers(spark, sf_dir):
    known = fx.supplier_peers(spark, sf_dir, False)
    return _peers_out(negotiate.upsert_peers(known, _peer_writes(spark, sf_dir)))


@query
def apply_replies(spark, sf_dir):
    known = fx.supplier_peers(spark, sf_dir, False)
    return _peers_out(negotiate.apply_replies(known, _handshakes(spark, sf_dir, L.TYPE_REPLY)))


@query
def pending_with_conn(spark, sf_dir):
    return _pending(spark, sf_dir).select(
        "jobid", "jdestination", big("jpriority"), "ipaddress", big("sfd"))


def _pending_handshake(spark, sf_dir) -> DataFrame:
    return queues.pending_handshake(
        fx.lane_jobs(spark, sf_dir), fx.supplier_peers(spark, sf_dir, True))


@query
def pending_handshake(spark, sf_dir):
    return _pending_handshake(spark, sf_dir).select(
        "jobid", "jdestination", big("comssport"), "ipaddress")


def _command_inputs(spark, sf_dir) -> tuple[DataFrame, ...]:
    return (fx.commands(spark, sf_dir), fx.lane_jobs(spark, sf_dir),
            fx.supplier_peers(spark, sf_dir, True), fx.supplier_conns(spark, sf_dir))


@query
def open_commands(spark, sf_dir):
    return queues.open_commands(*_command_inputs(spark, sf_dir), TICK).withColumn(
        "mdata2", big("mdata2"))


@query
def close_commands(spark, sf_dir):
    return queues.close_commands(*_command_inputs(spark, sf_dir), TICK).withColumn(
        "mdata2", big("mdata2"))


@query
def chunks_of_message(spark, sf_dir):
    return reassembly.chunks_of_message(fx.received_chunks(spark, sf_dir)).select(
        "message_id", "chunk_index", "byte_offset", md5_of("payload", "payload_md5"))


# --- aggregates -------------------------------------------------------------------

@query
def show_stats(spark, sf_dir):
    return reports.show_stats(fx.wide_jobs(spark, sf_dir)).withColumn(
        "jpriority", big("jpriority"))


@query
def completion_status(spark, sf_dir):
    return reassembly.completion_status(fx.parents(spark, sf_dir), fx.children(spark, sf_dir))


@query
def completion_status_distinct(spark, sf_dir):
    return reassembly.completion_status(
        fx.parents(spark, sf_dir), fx.children(spark, sf_dir), mode="distinct")


@query
def incoming_complete(spark, sf_dir):
    return reassembly.incoming_complete(fx.received_chunks(spark, sf_dir)).drop(
        "frame_bytes", "last_index")


@query
def incoming_complete_distinct(spark, sf_dir):
    return reassembly.incoming_complete(
        fx.received_chunks(spark, sf_dir), "distinct").drop("frame_bytes", "last_index")


@query
def missing_chunks(spark, sf_dir):
    return reassembly.missing_chunks(fx.received_chunks(spark, sf_dir))


@query
def reassemble(spark, sf_dir):
    return reassembly.reassemble(fx.received_chunks(spark, sf_dir)).select(
        "message_id", "part_no", "n_parts", "total_bytes",
        F.octet_length("content").cast("bigint").alias("n_bytes"), md5_of("content", "content_md5"))


@query
def reassemble_ordered(spark, sf_dir):
    return reassembly.reassemble_ordered(fx.received_chunks(spark, sf_dir)).select(
        "message_id", "chunk_index", "byte_offset", md5_of("payload", "payload_md5"))


@query
def finish_incoming(spark, sf_dir):
    return reassembly.finish_incoming(fx.received_chunks(spark, sf_dir)).select("jobid", "jstate")


# --- top-k ------------------------------------------------------------------------

@query
def top_pending(spark, sf_dir):
    return queues.top_pending(_pending(spark, sf_dir), 100).select(
        "jobid", "jdestination", big("jpriority"))


@query
def top_pending_per_peer(spark, sf_dir):
    return queues.top_pending(_pending(spark, sf_dir), 3, per_peer=True).select(
        "jobid", "jdestination", big("jpriority"), big("pick"))


@query
def top_handshake(spark, sf_dir):
    return queues.top_handshake(_pending_handshake(spark, sf_dir), 100).select(
        "jobid", "jdestination", big("jpriority"))


@query
def next_command(spark, sf_dir):
    return queues.next_command(fx.commands(spark, sf_dir), 25).select(
        "scommid", "mdata1", "mtype")


@query
def dequeue(spark, sf_dir):
    taken, remaining = queues.dequeue(fx.capacity_event_rows(spark, sf_dir), 5)
    return taken.select("rcomid", "rdata1", F.lit(True).alias("taken")).unionByName(
        remaining.select("rcomid", "rdata1", F.lit(False).alias("taken")))


@query
def get_payload(spark, sf_dir):
    picked = queues.top_pending(_pending(spark, sf_dir), 3, per_peer=True)
    return queues.get_payload(fx.lane_jobs(spark, sf_dir), picked).select(
        "jobid", md5_of("jobdata", "data_md5"))


# --- upserts, deletes, constraints, lineage ---------------------------------------

@query
def ensure_conns(spark, sf_dir):
    return queues.ensure_conns(
        fx.supplier_conns(spark, sf_dir), fx.lane_jobs(spark, sf_dir),
        fx.supplier_peers(spark, sf_dir, True), fx.T0
    ).select("sipaddr", big("sfd"), big("scstatus"))


@query
def upsert_in_conns(spark, sf_dir):
    return queues.upsert_in_conns(
        fx.in_conns(spark, sf_dir), fx.in_conn_reports(spark, sf_dir), fx.T0
    ).select(big("rfd"), "ripaddr", big("rcstatus"))


@query
def delete_command(spark, sf_dir):
    return queues.delete_command(fx.commands(spark, sf_dir), fx.conn_reports(spark, sf_dir)).select(
        "scommid", "mdata1", "mtype")


@query
def check_constraints(spark, sf_dir):
    return integrity.check_constraints({
        "jobs": fx.family_jobs(spark, sf_dir), "files": fx.files(spark, sf_dir),
        "peers": fx.peers(spark, sf_dir), "out_conns": fx.supplier_conns(spark, sf_dir),
        "commands": fx.commands(spark, sf_dir)})


@query
def job_descendants(spark, sf_dir):
    jobs = fx.family_jobs(spark, sf_dir)
    return integrity.job_descendants(jobs, fx.root(spark).select("jobid")).withColumn(
        "depth", big("depth"))


# --- change feeds -----------------------------------------------------------------

@query
def capacity_events(spark, sf_dir):
    return changes.capacity_events(_peer_writes(spark, sf_dir), TICK)


@query
def notify_handshake(spark, sf_dir):
    replies = negotiate.handshake_replies(
        _handshakes(spark, sf_dir, L.TYPE_REQUEST), fx.node(), fx.t0())
    updated = changes.write_set(fx.lane_jobs(spark, sf_dir), changes.UPDATE)
    return changes.notify_handshake(
        changes.write_set(replies, changes.INSERT).unionByName(updated))


@query
def notify_sender(spark, sf_dir):
    chunks = framing.chunk_payloads(fx.planned_sends(spark, sf_dir), fx.files(spark, sf_dir),
                                    fx.peers(spark, sf_dir), fx.t0())
    writes = changes.write_set(chunks, changes.INSERT).unionByName(
        changes.write_set(fx.lane_jobs(spark, sf_dir), changes.UPDATE))
    return changes.notify_sender(
        writes, changes.write_set(fx.commands(spark, sf_dir), changes.INSERT))


@query
def notify_receiver(spark, sf_dir):
    events = changes.capacity_events(_peer_writes(spark, sf_dir), TICK)
    return changes.notify_receiver(changes.write_set(events, changes.INSERT))


@query
def snapshot_diff(spark, sf_dir):
    before = fx.lane_jobs(spark, sf_dir)
    acks = fx.acks(fx.table(spark, sf_dir, "events"), fx.uid("lane", F.col("event_id")))
    after = transitions.apply_send_status(before, acks)
    return changes.snapshot_diff(before, after, ["jobid"]).select("jobid", "op", "jstate")


# --- reports ----------------------------------------------------------------------

@query
def stalled_parents(spark, sf_dir):
    return reports.stalled_parents(fx.family_jobs(spark, sf_dir))


@query
def stalled_jobs(spark, sf_dir):
    return reports.stalled_jobs(fx.send_jobs(spark, sf_dir), fx.peers(spark, sf_dir))


@query
def stranded_forwards(spark, sf_dir):
    return reports.stranded_forwards(
        transitions.advance_inbound(fx.received_messages(spark, sf_dir), fx.node()))


@query
def dead_letter_report(spark, sf_dir):
    return transitions.dead_letter_report(
        transitions.advance_inbound(fx.received_messages(spark, sf_dir), fx.node()))


@query
def colliding_names(spark, sf_dir):
    return reports.colliding_names(fx.table(spark, sf_dir, "part"), "p_name")


# --- a whole tick -----------------------------------------------------------------

@query
def run_tick_query(spark, sf_dir):
    return jobs_out(run_tick(fx.node_state(spark, sf_dir), fx.T0).state.jobs)


QUERIES["run_tick"] = QUERIES.pop("run_tick_query")


def _small_tables(state: NodeState) -> DataFrame:
    def row(df, kind, address, number, status):
        return df.select(F.lit(kind).alias("kind"), F.col(address).alias("address"),
                         F.col(number).cast("bigint").alias("fd_or_port"),
                         F.col(status).cast("string").alias("status"))

    return (
        row(state.out_conns, "conn", "sipaddr", "sfd", "scstatus")
        .unionByName(row(state.commands, "command", "mdata1", "mdata2", "mtype"))
        .unionByName(row(state.peers, "peer", "ipaddress", "dataport", "system_capacity"))
    )


@query
def run_tick_connections(spark, sf_dir):
    return _small_tables(run_tick(fx.node_state(spark, sf_dir), fx.T0).state)


# --- streams ----------------------------------------------------------------------

@query
def tick_stream(spark, sf_dir):
    path = work_path(spark, "tick")
    root = fx.new_state_path(spark, sf_dir, "tick-state", with_messages=False)
    frames = fx.arrived_messages(spark, sf_dir, fx.stored_stream)
    streams.tick_stream(frames, root, f"{path}/checkpoint", lambda: fx.T0,
                        every=None).awaitTermination()
    return jobs_out(store.load_state(spark, root).jobs)


@query
def change_feed(spark, sf_dir):
    """What a tick's commit tells the three channels; numbered rows are counted, their numbers are the tick's own."""
    path = work_path(spark, "feed")
    root = fx.new_state_path(spark, sf_dir, "feed-state", with_messages=True)
    commit_tick(store.load_state(spark, root), root, fx.T0)
    streams.change_feed(spark, root, streams.batch_sink(f"{path}/feed"), f"{path}/checkpoint").awaitTermination()
    key = F.when(F.col("key").rlike("^[0-9]+$"), "serial").otherwise(F.col("key")).alias("key")
    return spark.read.parquet(f"{path}/feed").groupBy("version", "channel", "op", key).agg(F.count("*").alias("n_rows"))


@query
def ingest_stream(spark, sf_dir):
    path = work_path(spark, "ingest")
    frames = fx.arrived_messages(spark, sf_dir, fx.stored_stream)
    jobs = streams.ingest_stream(frames, fx.node(), fx.t0())
    streams.start(jobs, streams.batch_sink(f"{path}/jobs"), f"{path}/checkpoint").awaitTermination()
    return jobs_out(spark.read.parquet(f"{path}/jobs"))


def _lifecycle(spark: SparkSession, sf_dir: str, strict: bool) -> DataFrame:
    path = work_path(spark, "lifecycle")
    kind = F.col("event_type")
    state = (
        F.when(kind == "error", L.DEAD).when(kind == "purchase", L.COMPLETE)
        .when(kind == "signup", L.REQUESTED).when(kind == "view", L.READY)
        .otherwise(F.lit(L.READY_TAKEN)))
    moves = fx.stream(spark, sf_dir, "events").select(
        fx.uid("job", F.col("user_id")).alias("jobid"), state.alias("jstate"),
        F.col("ts").cast("timestamp").alias("changed_at"), F.col("event_id").alias("change_no"))
    streams.start(streams.lifecycle_stream(moves, strict=strict), streams.batch_sink(f"{path}/jobs"),
                  f"{path}/checkpoint", mode="update").awaitTermination()
    return streams.read_latest(spark, f"{path}/jobs", ["jobid"]).drop("changed_at")


@query
def lifecycle_stream(spark, sf_dir):
    return _lifecycle(spark, sf_dir, False).drop("n_rejected")


@query
def lifecycle_strict_stream(spark, sf_dir):
    return _lifecycle(spark, sf_dir, True)


@query
def reassembly_stream(spark, sf_dir):
    path = work_path(spark, "reassembly")
    arrived = fx.arrived_chunks(spark, sf_dir, fx.stored_stream)
    streams.reassembly_stream(arrived.withColumn("arrived_at", fx.t0()), path,
                              f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/messages").select(
        "message_id", "part_no", "chunk_count",
        F.octet_length("content").cast("bigint").alias("n_bytes"), md5_of("content", "content_md5"))


@query
def delivery_rate(spark, sf_dir):
    path = work_path(spark, "rate")
    acks = fx.acks(fx.stream(spark, sf_dir, "events"), F.lit(""))
    streams.start(streams.delivery_rate(acks), streams.batch_sink(f"{path}/rate"),
                  f"{path}/checkpoint", mode="update").awaitTermination()
    latest = streams.read_latest(spark, f"{path}/rate", ["window_start", "outcome"])
    return latest.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


@query
def delivery_rate_closed(spark, sf_dir):
    path = work_path(spark, "closed-rate")
    acks = fx.acks(fx.stream(spark, sf_dir, "events"), F.lit(""))
    streams.delivery_rate_stream(acks, path, f"{path}/checkpoint").awaitTermination()
    rate = spark.read.parquet(f"{path}/rate").select("window_start", "outcome", "n_acks")
    return rate.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))
