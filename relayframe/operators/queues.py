"""Picks, connection rows and connection commands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import layout as L
from ..functions.frames import as_column
from .lookups import WIDE_ROWS, join_lookup, latest_by

TIES = ["jcreation_time", "jobid"]
# Identifiers made in one tick stay below this, so later ticks sort after earlier ones.
IDS_PER_TICK = 1 << 33


def serial(tick: int, kind: int, ipaddress) -> Column:
    """An increasing identifier without a global sort: tick, kind, 32-bit address."""
    return F.lit(tick * IDS_PER_TICK + kind * (IDS_PER_TICK >> 1)) + ipaddress


# --- picks ------------------------------------------------------------------------

def _destinations(peers: DataFrame, *columns: str) -> DataFrame:
    return peers.select(F.col("system_name").alias("jdestination"), *columns)


def _one_route(routes: DataFrame, *columns: str) -> DataFrame:
    """Of peers of one name the one with the smallest address: a message takes one route."""
    return routes.groupBy("jdestination").agg(
        *[F.min_by(c, "ipaddress").alias(c) for c in columns], F.min("ipaddress").alias("ipaddress"))


def pending_with_conn(jobs: DataFrame, peers: DataFrame, out_conns: DataFrame) -> DataFrame:
    """Ready messages whose peer has an open connection, without their payload."""
    ready = jobs.filter(F.col("jstate") == L.READY).select(
        "jobid", "jdestination", "jpriority", "jcreation_time")
    opened = out_conns.filter(F.col("scstatus") == L.CONN_OPEN).select(
        F.col("sipaddr").alias("ipaddress"), "sfd")
    routes = _destinations(peers, "ipaddress").join(opened, "ipaddress")
    return join_lookup(ready, _one_route(routes, "sfd"), ["jdestination"], spread_by=F.col("jobid"))


def top_pending(pending: DataFrame, k: int = 1, per_peer: bool = False) -> DataFrame:
    """The k most urgent ready messages, overall or per destination: highest priority first."""
    order = [F.col("jpriority").desc(), *TIES]
    if not per_peer:
        return pending.orderBy(*order).limit(k)
    window = Window.partitionBy("jdestination").orderBy(*order)
    return pending.withColumn("pick", F.row_number().over(window)).filter(F.col("pick") <= k)


def pending_handshake(jobs: DataFrame, peers: DataFrame) -> DataFrame:
    """Handshake frames to send with the peer's communication port."""
    ready = jobs.filter(F.col("jstate") == L.HANDSHAKE_READY).select(
        "jobid", "jdestination", "jpriority", "jcreation_time")
    routes = _one_route(_destinations(peers, "comssport", "ipaddress"), "comssport")
    return join_lookup(ready, routes, ["jdestination"], spread_by=F.col("jobid"))


def top_handshake(pending: DataFrame, k: int = 1) -> DataFrame:
    """The first k handshakes. Priorities compare as text here, smallest first."""
    return pending.orderBy(F.col("jpriority").cast("string"), *TIES).limit(k)


def get_payload(jobs: DataFrame, picked: DataFrame) -> DataFrame:
    """The bytes of picked messages, fetched after the pick."""
    ids = picked.select("jobid").distinct()
    return join_lookup(jobs.select("jobid", "jobdata"), ids, ["jobid"], "left_semi",
                       spread_by=F.col("jobid"),
                         rows_per_task=WIDE_ROWS, write_lookup=True)


def next_command(commands: DataFrame, k: int = 1) -> DataFrame:
    """The oldest k commands nobody has taken."""
    fresh = commands.filter(F.col("mtype").isin(L.COMMAND_OPEN, L.COMMAND_CLOSE))
    return fresh.orderBy("scommid").limit(k)


def dequeue(events: DataFrame, k: int = 1, key: str = "rcomid") -> tuple[DataFrame, DataFrame]:
    """The oldest k rows, and the rows that remain."""
    taken = events.orderBy(key).limit(k)
    remaining = join_lookup(events, taken.select(key), [key], "left_anti", spread_by=F.col(key))
    return taken, remaining


# --- commands ---------------------------------------------------------------------

def take_command(commands: DataFrame, picked: DataFrame) -> DataFrame:
    """Marks the picked commands as taken: W is appended to their type."""
    ids = picked.select("scommid").distinct().withColumn("_picked", F.lit(True))
    joined = join_lookup(commands, ids, ["scommid"], "left", spread_by=F.col("scommid"))
    taken = F.concat("mtype", F.lit(L.TAKEN_SUFFIX))
    return joined.withColumn(
        "mtype", F.when(F.col("_picked"), taken).otherwise(F.col("mtype"))
    ).select(*commands.columns)


def delete_command(commands: DataFrame, done: DataFrame) -> DataFrame:
    """Removes commands by identifier."""
    ids = done.select("scommid").distinct()
    return join_lookup(commands, ids, ["scommid"], "left_anti", spread_by=F.col("scommid"))


def apply_connection_status(out_conns: DataFrame, commands: DataFrame, reports: DataFrame
                            ) -> tuple[DataFrame, DataFrame]:
    """Connection reports: open when a descriptor came back, else wanted; command removed.

    ``reports``: scommid, fd, ipaddress, reported_at, report_id.
    """
    last = latest_by(reports.withColumnRenamed("ipaddress", "sipaddr"), ["sipaddr"],
                     ["reported_at", "report_id"], ["fd"])
    joined = join_lookup(out_conns, last, ["sipaddr"], "left", spread_by=F.col("sipaddr"))
    status = F.when(F.col("fd") >= 0, L.CONN_OPEN).when(F.col("fd") < 0, L.CONN_WANTED)
    conns = joined.withColumns({
        "sfd": F.coalesce("fd", "sfd").cast("int"),
        "scstatus": F.coalesce(status, F.col("scstatus")).cast("int"),
    }).select(*out_conns.columns)
    return conns, delete_command(commands, reports)


# --- connections ------------------------------------------------------------------

def _ready_destinations(jobs: DataFrame) -> DataFrame:
    """Destinations with ready messages. Distinct comes before any join."""
    return jobs.filter(F.col("jstate") == L.READY).select("jdestination").distinct()


def ensure_conns(out_conns: DataFrame, jobs: DataFrame, peers: DataFrame, created_at
                 ) -> DataFrame:
    """Adds a wanted connection for every peer with ready messages and none yet."""
    wanted = (
        _ready_destinations(jobs).join(_destinations(peers, "ipaddress"), "jdestination")
        .select(F.col("ipaddress").alias("sipaddr")).distinct()
        .join(out_conns.select("sipaddr"), "sipaddr", "left_anti")
    )
    created = as_column(created_at).cast("timestamp").alias("sctime")
    return out_conns.unionByName(wanted.select(
        F.lit(L.NO_FD).alias("sfd"), "sipaddr", F.lit(L.CONN_WANTED).alias("scstatus"), created))


def _new_commands(rows: DataFrame, commands: DataFrame, kind: str, tick: int) -> DataFrame:
    """``rows``: mdata1, mdata2. Pairs that exist already are left alone."""
    fresh = rows.distinct().join(
        commands.select("mdata1", "mdata2"), ["mdata1", "mdata2"], "left_anti")
    return fresh.select(
        serial(tick, int(kind) - 1, F.col("mdata1")).alias("scommid"),
        "mdata1", F.col("mdata2").cast("int").alias("mdata2"), F.lit(kind).alias("mtype"))


def open_commands(commands: DataFrame, jobs: DataFrame, peers: DataFrame, out_conns: DataFrame,
                  tick: int = 0) -> DataFrame:
    """New commands to open the wanted connections of peers with ready messages."""
    wanted = out_conns.filter(F.col("scstatus") == L.CONN_WANTED).select(
        F.col("sipaddr").alias("ipaddress"))
    rows = (
        _destinations(peers, "ipaddress", "dataport").join(wanted, "ipaddress")
        .join(_ready_destinations(jobs), "jdestination", "left_semi")
        .select(F.col("ipaddress").alias("mdata1"), F.col("dataport").alias("mdata2"))
    )
    return _new_commands(rows, commands, L.COMMAND_OPEN, tick)


def close_commands(commands: DataFrame, jobs: DataFrame, peers: DataFrame, out_conns: DataFrame,
                   tick: int = 0, terminal_states: tuple[str, ...] = (L.COMPLETE,)) -> DataFrame:
    """New commands to close open connections whose peer has no unfinished job."""
    unfinished = jobs.filter(~F.col("jstate").isin(*terminal_states)).select(
        "jdestination").distinct()
    opened = out_conns.filter(F.col("scstatus") == L.CONN_OPEN).select(
        F.col("sipaddr").alias("ipaddress"), "sfd")
    rows = (
        _destinations(peers, "ipaddress").join(opened, "ipaddress")
        .join(unfinished, "jdestination", "left_anti")
        .select(F.col("ipaddress").alias("mdata1"), F.col("sfd").alias("mdata2"))
    )
    return _new_commands(rows, commands, L.COMMAND_CLOSE, tick)


def upsert_in_conns(in_conns: DataFrame, reports: DataFrame, created_at) -> DataFrame:
    """Inbound connections: a known descriptor gets the last status, its address stays.

    ``reports``: rfd, ripaddr, rcstatus, reported_at, report_id.
    """
    order = F.struct("reported_at", "report_id")
    new = reports.groupBy("rfd").agg(
        F.min_by("ripaddr", order).alias("_ip"), F.max_by("rcstatus", order).alias("_status"))
    return in_conns.join(new, "rfd", "full").select(
        "rfd",
        F.coalesce("ripaddr", "_ip").alias("ripaddr"),
        F.coalesce("_status", "rcstatus").cast("int").alias("rcstatus"),
        F.coalesce("rctime", as_column(created_at).cast("timestamp")).alias("rctime"))
