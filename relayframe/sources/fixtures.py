"""Engine-shaped tables derived from the driver's Parquet tables (see FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import frames as X
from ..functions import layout as L
from ..node import Node, NodeState
from ..operators import framing, transitions
from ..operators.framing import JOB_COLUMNS
from ..session import STAGED_CODEC, work_path
from .state import load_state, root_jobs, save_state
from .wire import ingest_frames

T0 = datetime(2024, 1, 2, 3, 4, 5, 123456)
LOOPBACK = 2130706433
SUPPLIER_IP = LOOPBACK + 10_000
MESSAGE_CAPACITY = 32768


def t0() -> Column:
    return F.lit(T0.isoformat(sep=" ")).cast("timestamp")


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the file once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


_STORED: dict[tuple[str, str, str], tuple[str, T.StructType]] = {}


def stored_path(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]
                ) -> tuple[str, T.StructType]:
    """Writes a derived table once per application; its path and schema.

    Frames that arrived and files that were imported are stored data: operators read them
    from files, and filters on frame fields do not become filters on the expression that
    once built the frame.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        path, df = work_path(spark, name), make()
        spread(df).write.option("compression", STAGED_CODEC).parquet(path)
        _STORED[key] = (path, df.schema)
    return _STORED[key]


def stored(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]
           ) -> DataFrame:
    path, schema = stored_path(spark, sf_dir, name, make)
    return spark.read.schema(schema).parquet(path)


def stored_stream(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]
                  ) -> DataFrame:
    """A derived table as a file stream."""
    path, schema = stored_path(spark, sf_dir, name, make)
    return spark.readStream.schema(schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where the source has fewer splits than there are cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a file stream."""
    # The table's own path, one file or a folder of part files: as a pattern, for a stream takes a
    # path without one for a folder.
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque[t]")


def uid(*parts) -> Column:
    return X.message_uid(*parts)


ROOT_ID = "63a9f0ea-7bb9-8050-796b-649e85481845"  # uid('root')


def node() -> Node:
    return Node("M3", LOOPBACK, 6001, 6000, MESSAGE_CAPACITY, ROOT_ID)


def jobs_from(df: DataFrame, **columns) -> DataFrame:
    """Job rows from expressions, with the usual defaults."""
    defaults = {
        "jstate": L.REQUESTED, "jtype": L.padded(L.TYPE_SEND), "jsource": node().name,
        "jparent_jobid": ROOT_ID, "jpriority": L.DEFAULT_PRIORITY, "jcreation_time": t0(),
    }
    given = {**defaults, **columns}
    kinds = {"jpriority": "int", "jcreation_time": "timestamp"}
    return df.select(*[
        (X.as_column(given[c]).cast(kinds[c]) if c in kinds else X.as_column(given[c])).alias(c)
        for c in JOB_COLUMNS
    ])


# --- documents: peers, files, send jobs -------------------------------------------

def source_number(source: Column) -> Column:
    return F.regexp_extract(source, "([0-9]+)", 1).cast("int")


def source_capacity(number: Column) -> Column:
    return F.when(number % 5 == 0, 0).otherwise((number % 4 + 1) * 1024)


def peers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "peers", lambda: _peers(spark, sf_dir))


def _peers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n")
    known = table(spark, sf_dir, "documents").select("source").distinct().withColumn(
        "n", source_number(F.col("source")))
    return known.select(
        X.norm_name(F.col("source")).alias("system_name"),
        (F.lit(LOOPBACK).cast("bigint") + n).alias("ipaddress"),
        F.when(n % 5 == 0, 0).otherwise(7001).alias("dataport"), F.lit(7000).alias("comssport"),
        source_capacity(n).alias("system_capacity"))


def _file_name() -> Column:
    return F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "files", lambda: _files(spark, sf_dir))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        uid("file", F.col("doc_id")).alias("file_id"), _file_name().alias("file_name"),
        F.col("text").cast("binary").alias("content"),
        F.octet_length("text").cast("bigint").alias("n_bytes"), t0().alias("creation_time"))


def send_jobs(spark: SparkSession, sf_dir: str, state: str = L.REQUESTED) -> DataFrame:
    return jobs_from(
        table(spark, sf_dir, "documents"), jobid=uid("job", F.col("doc_id")), jstate=state,
        jobdata=_file_name().cast("binary"), jdestination=X.norm_name(F.col("source")),
        jpriority=F.col("doc_id") % 10 + 1)


def planned_sends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Send jobs after planning (S-1, S-2, S-3), as the job table stores them."""
    return stored(spark, sf_dir, "planned-sends", lambda: transitions.plan_sends(
        send_jobs(spark, sf_dir, L.ADMITTED), files(spark, sf_dir), peers(spark, sf_dir)))


def root(spark: SparkSession) -> DataFrame:
    one = spark.range(1).select(
        F.lit(ROOT_ID).alias("root_id"), F.lit(node().name).alias("system_name"))
    return root_jobs(one, t0()).select(*JOB_COLUMNS)


def outgoing_rows(documents: DataFrame) -> DataFrame:
    """Documents as rows ready for ``frame_chunks``, where they exceed one payload."""
    n = source_number(F.col("source"))
    rows = documents.select(
        "doc_id", uid("job", F.col("doc_id")).alias("parent_id"),
        F.col("text").cast("binary").alias("content"),
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        source_capacity(n).alias("system_capacity"), F.lit(node().name).alias("jsource"),
        X.norm_name(F.col("source")).alias("jdestination"),
        (F.col("doc_id") % 10 + 1).cast("int").alias("jpriority"))
    return rows.filter(
        (F.col("system_capacity") > 0)
        & (F.col("n_bytes") > F.col("system_capacity") - L.DATA_OVERHEAD))


def chunk_arrivals(documents: DataFrame) -> DataFrame:
    """Frames of chunked documents as they arrive elsewhere: some missing, some twice.

    Chunk 1 is lost when doc_id % 11 = 0. Chunk 0 comes twice when doc_id % 13 = 0: as a
    byte-identical copy for even doc_id, framed again at another time for odd.
    """
    rows = outgoing_rows(documents)
    doc, index = F.col("doc_id"), F.col("chunk_index")
    chunks = framing.frame_chunks(rows, t0(), ("doc_id", "chunk_index"))
    chunks = chunks.filter(~((doc % 11 == 0) & (index == 1)))
    twice = rows.filter(doc % 13 == 0)
    again = framing.frame_chunks(
        twice, F.when(doc % 2 == 0, t0()).otherwise(t0() + F.expr("INTERVAL 1 SECOND")),
        ("doc_id", "chunk_index")).filter(index == 0)
    manifests = framing.frame_manifests(rows, t0(), ("doc_id",)).withColumn(
        "chunk_index", F.lit(-1))
    pairs = [(chunks, "a"), (again, "b"), (manifests, "a")]
    parts = [df.select("jobdata", F.concat("jobid", F.lit(copy)).alias("frame_key"),
                       "doc_id") for df, copy in pairs]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def arrived_chunks(spark: SparkSession, sf_dir: str, read=stored) -> DataFrame:
    return read(spark, sf_dir, "chunk-frames",
                lambda: chunk_arrivals(table(spark, sf_dir, "documents")))


def received_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as classified jobs (N-4)."""
    arrived = arrived_chunks(spark, sf_dir).withColumn("fd", F.lit(9))
    return ingest_frames(arrived, node(), t0()).withColumns({
        "jstate": F.lit(L.CLASSIFIED), "jtype": X.frame_type(F.col("jobdata"))})


# --- conversations: small messages ------------------------------------------------

def message_frames(conversations: DataFrame) -> DataFrame:
    """A type 1 frame per turn; every seventh conversation has a wrong digest."""
    key = F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    frame = X.encode_frame(
        message_id=uid("msg", key), message_type=L.TYPE_SINGLE,
        source=F.concat(F.lit("src"), (F.col("conv_id") % 20).cast("string")),
        destination=F.when(F.col("conv_id") % 3 == 0, "src1").otherwise(F.lit("M3")),
        priority=L.DEFAULT_PRIORITY, created_at=t0(), capacity=MESSAGE_CAPACITY,
        payload=F.col("text").cast("binary"))
    damaged = F.concat(F.repeat(F.lit("0"), F.lit(32)).cast("binary"),
                       F.substring(frame, 33, X.TO_THE_END))
    return conversations.select(
        key.alias("frame_key"), (F.col("conv_id") % 20).cast("int").alias("fd"),
        F.when(F.col("conv_id") % 7 == 0, damaged).otherwise(frame).alias("jobdata"))


def arrived_messages(spark: SparkSession, sf_dir: str, read=stored) -> DataFrame:
    return read(spark, sf_dir, "message-frames",
                lambda: message_frames(table(spark, sf_dir, "conversations")))


def received_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_frames(arrived_messages(spark, sf_dir), node(), t0())


# --- suppliers: negotiating peers -------------------------------------------------

def supplier_name(key: Column | None = None) -> Column:
    """``S`` and the key up to 9,999, then five base-36 digits, so that every name fits the wire:
    from SA000 on, and after SZZZZ from T0000 on. Keys beyond ZZZZZ raise an error."""
    key = (F.col("s_suppkey") if key is None else key).cast("bigint")
    after_s = 10_000 + 26 * 36**3
    digits = (F.when(key < after_s, key - 10_000 + int("SA000", 36))
              .when(key < after_s + 7 * 36**4, key - after_s + int("T0000", 36))
              .otherwise(F.raise_error(F.concat(F.lit("no five-byte name for supplier "), key.cast("string"))).cast("bigint")))
    return X.norm_name(F.when(key < 10_000, F.concat(F.lit("S"), key.cast("string")))
                       .otherwise(F.conv(digits.cast("string"), 10, 36)))


def supplier_ip() -> Column:
    return F.lit(SUPPLIER_IP).cast("bigint") + F.col("s_suppkey")


def handshake_frames(suppliers: DataFrame, kind: str) -> DataFrame:
    key = F.concat(F.lit(f"hs{kind}-"), F.col("s_suppkey").cast("string"))
    frame = X.encode_frame(
        message_id=uid(key), message_type=kind, source=supplier_name(), destination="M3",
        priority=L.DEFAULT_PRIORITY, created_at=t0(), capacity=L.HANDSHAKE_BYTES,
        subheader=X.handshake_subheader((F.col("s_suppkey") % 128 + 1) * 512, 7001, supplier_ip()))
    return suppliers.select(
        key.alias("frame_key"), (F.col("s_suppkey") % 64).cast("int").alias("fd"),
        supplier_ip().alias("ipaddress"), frame.alias("jobdata"))


def received_handshakes(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    frames = stored(spark, sf_dir, f"handshake-frames-{kind}",
                    lambda: handshake_frames(table(spark, sf_dir, "supplier"), kind))
    return ingest_frames(frames, node(), t0())


def classified_handshakes(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return received_handshakes(spark, sf_dir, kind).withColumns({
        "jstate": F.lit(L.CLASSIFIED), "jtype": F.lit(L.padded(kind))})


def supplier_peers(spark: SparkSession, sf_dir: str, negotiated: bool) -> DataFrame:
    """Suppliers as peers. Not negotiated ones are known for even keys only."""
    suppliers = table(spark, sf_dir, "supplier")
    if negotiated:
        port, capacity = F.lit(7001), ((F.col("s_suppkey") % 128 + 1) * 512).cast("int")
    else:
        suppliers = suppliers.filter(F.col("s_suppkey") % 2 == 0)
        port, capacity = F.lit(0), F.lit(0)
    return suppliers.select(
        supplier_name().alias("system_name"), supplier_ip().alias("ipaddress"),
        port.alias("dataport"), F.lit(7000).alias("comssport"), capacity.alias("system_capacity"))


def supplier_conns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open for every third supplier, wanted for the next, none for the third."""
    third = F.col("s_suppkey") % 3
    return table(spark, sf_dir, "supplier").filter(third < 2).select(
        F.when(third == 0, F.col("s_suppkey")).otherwise(-1).cast("int").alias("sfd"),
        supplier_ip().alias("sipaddr"), F.when(third == 0, 2).otherwise(1).alias("scstatus"),
        t0().alias("sctime"))


# --- orders and line items --------------------------------------------------------

def lane_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as messages to suppliers in various states."""
    customer = F.col("o_custkey")
    state = (
        F.when(customer % 4 == 0, L.COMPLETE).when(F.col("o_orderstatus") == "O", L.READY)
        .when(F.col("o_orderstatus") == "P", L.HANDSHAKE_READY).otherwise(F.lit(L.DEAD)))
    n_suppliers = table(spark, sf_dir, "supplier").count()
    lane = supplier_name(customer % n_suppliers)
    return jobs_from(
        table(spark, sf_dir, "orders"), jobid=uid("lane", F.col("o_orderkey")), jstate=state,
        jobdata=F.concat(F.lit("payload "), F.col("o_orderkey").cast("string")).cast("binary"),
        jtype=F.lit(L.TYPE_CHUNK), jdestination=lane,
        jpriority=F.substring("o_orderpriority", 1, 1), jcreation_time=F.col("o_orderdate"))


def wide_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as jobs for the statistics view."""
    return jobs_from(
        table(spark, sf_dir, "orders"), jobid=uid("job", F.col("o_orderkey")),
        jobdata=F.lit("x").cast("binary"), jstate=F.col("o_orderstatus"), jtype=F.lit("6"),
        jdestination=(F.col("o_custkey") % 25).cast("string"),
        jpriority=F.substring("o_orderpriority", 1, 1))


def child_state() -> Column:
    return (
        F.when(F.col("l_linestatus") == "F", L.COMPLETE)
        .when(F.col("l_returnflag") == "R", L.DEAD).otherwise(F.lit(L.READY)))


def parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waiting orders (parent_id, expected) with the highest line number as chunk count."""
    expected = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_linenumber").cast("bigint").alias("expected"))
    waiting = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "O")
    return waiting.join(expected, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").alias("parent_id"), "expected")


def children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("parent_id"), child_state().alias("jstate"),
        (F.col("l_linenumber") - 1).cast("bigint").alias("chunk_index"))


def family_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as waiting parents, line items as their chunks, and a manifest per order."""
    return stored(spark, sf_dir, "family-jobs", lambda: _family_jobs(spark, sf_dir))


def _family_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    order_id = uid("ord", F.col("o_orderkey"))
    status = F.col("o_orderstatus")
    parent_rows = jobs_from(
        orders, jobid=order_id, jobdata=F.concat(
            F.lit("order "), F.col("o_orderkey").cast("string")).cast("binary"),
        jstate=F.when(status == "O", L.CHUNKED_WAITING).when(
            status == "P", L.SINGLE_WAITING).otherwise(F.lit(L.COMPLETE)),
        jdestination=F.lit(L.padded("src1")))
    key = F.concat_ws("-", *[F.col(c).cast("string") for c in
                             ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    child_rows = jobs_from(
        items, jobid=uid("li", key), jobdata=key.cast("binary"), jstate=child_state(),
        jtype=F.lit(L.TYPE_CHUNK), jparent_jobid=uid("ord", F.col("l_orderkey")),
        jdestination=F.lit(L.padded("src1")))
    counts = items.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("n"))
    manifest = X.encode_frame(
        message_id=uid("man", F.col("l_orderkey")), message_type=L.TYPE_MANIFEST, source="M3",
        destination="src1", priority=L.DEFAULT_PRIORITY, created_at=t0(),
        capacity=L.DATA_OVERHEAD, subheader=X.manifest_subheader(
            uid("ord", F.col("l_orderkey")), F.col("n") * 852, F.col("n")))
    manifest_rows = jobs_from(
        counts, jobid=uid("man", F.col("l_orderkey")), jobdata=manifest,
        jstate=F.when(F.col("l_orderkey") % 4 == 0, L.READY).otherwise(F.lit(L.COMPLETE)),
        jtype=F.lit(L.TYPE_MANIFEST), jparent_jobid=uid("ord", F.col("l_orderkey")),
        jdestination=F.lit(L.padded("src1")))
    return parent_rows.unionByName(child_rows).unionByName(manifest_rows)


# --- customers and events ---------------------------------------------------------

def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connection commands; every fifth address has none."""
    kind = F.col("c_custkey") % 4
    return table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 5 != 0).select(
        F.col("c_custkey").alias("scommid"),
        (F.lit(SUPPLIER_IP).cast("bigint") + F.col("c_custkey")).alias("mdata1"),
        F.lit(7001).alias("mdata2"),
        F.when(kind == 0, "1").when(kind == 1, "2").when(kind == 2, "1W").otherwise(
            F.lit("2W")).alias("mtype"))


def conn_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("scommid"),
        F.when(F.col("event_type") == "error", -1).otherwise(
            F.col("event_id") % 1000).cast("int").alias("fd"),
        (F.lit(SUPPLIER_IP).cast("bigint") + F.col("user_id")).alias("ipaddress"),
        F.col("ts").cast("timestamp").alias("reported_at"), F.col("event_id").alias("report_id"))


def in_conn_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("rfd"),
        (F.lit(LOOPBACK).cast("bigint") + F.col("event_id")).alias("ripaddr"),
        F.when(F.col("event_type") == "error", 1).otherwise(2).alias("rcstatus"),
        F.col("ts").cast("timestamp").alias("reported_at"), F.col("event_id").alias("report_id"))


def in_conns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("rfd"), supplier_ip().alias("ripaddr"),
        F.lit(2).alias("rcstatus"), t0().alias("rctime"))


def capacity_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("rcomid"), supplier_ip().alias("rdata1"),
        ((F.col("s_suppkey") % 128 + 1) * 512).alias("rdata2"))


def acks(events: DataFrame, target: Column) -> DataFrame:
    return events.select(
        target.alias("jobid"), F.when(F.col("event_type") == "error", 0).otherwise(
            1).alias("status"),
        F.col("ts").cast("timestamp").alias("ack_time"), F.col("event_id").alias("ack_id"))


# --- a whole node -----------------------------------------------------------------

_STATES: dict[tuple[str, str, str], str] = {}


def node_state(spark: SparkSession, sf_dir: str, with_messages: bool = True) -> NodeState:
    """A stored node in the middle of its work: every kind of row a tick can meet."""
    name = "node-state" if with_messages else "node-state-quiet"
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STATES:
        _STATES[key] = new_state_path(spark, sf_dir, name, with_messages)
    return load_state(spark, _STATES[key])


def new_state(spark: SparkSession, sf_dir: str, with_messages: bool = True) -> NodeState:
    """That node before it is stored. Orders and line items are written once, with the state, not before."""
    parts = [
        root(spark), send_jobs(spark, sf_dir), _family_jobs(spark, sf_dir),
        received_handshakes(spark, sf_dir, L.TYPE_REQUEST),
        received_handshakes(spark, sf_dir, L.TYPE_REPLY),
    ]
    if with_messages:
        parts.append(received_messages(spark, sf_dir))
    return NodeState(
        node=node(), jobs=reduce(DataFrame.unionByName, parts), files=files(spark, sf_dir),
        peers=peers(spark, sf_dir).unionByName(supplier_peers(spark, sf_dir, False)),
        out_conns=supplier_conns(spark, sf_dir), in_conns=in_conns(spark, sf_dir),
        commands=commands(spark, sf_dir), capacity_events=capacity_event_rows(spark, sf_dir))


def new_state_path(spark: SparkSession, sf_dir: str, name: str, with_messages: bool) -> str:
    """Saves that node as version 0 below a new path."""
    path = work_path(spark, name)
    save_state(new_state(spark, sf_dir, with_messages), path, 0)
    return path
