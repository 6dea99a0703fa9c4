"""One tick: the 24 set-based statements of the job table, in their order of effect.

Statements see the effects of those before them. As most concern disjoint states, the
job table is split by state once, each part gets its own short plan, and the parts are
put together again. Only rows in ``MOVABLE`` are read and written; payloads at rest
(ready, taken, complete, dead, classified data frames) stay where they are. What depends on rows at
rest, completion of parents and the connections, comes from counters (``operators/counters``) that are
changed by the rows of the tick, so its cost does not grow with the finished history.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import frames as X
from ..functions import layout as L
from ..node import NodeState
from ..operators import changes, counters, framing, negotiate, queues, transitions
from ..operators.framing import JOB_COLUMNS
from ..session import SWEEP, cut_lineage, setting
from ..sources import state as store

INBOUND = [L.RECEIVED, L.VERIFIED, L.LOCAL]
SENDING = [L.REQUESTED, L.ADMITTED, L.CHUNKED, L.SINGLE]
WAITING = [L.CHUNKED_WAITING, L.SINGLE_WAITING]
HANDSHAKE_TYPES = [L.padded(L.TYPE_REQUEST), L.padded(L.TYPE_REPLY)]
# Job versions after which a tick rewrites the whole table into one.
COMPACT_AFTER = 100


def _sql_list(values: list[str]) -> str:
    return "(" + ", ".join(f"'{value}'" for value in values) + ")"


# Rows a tick can move, as a condition on the partition columns of the job table.
MOVABLE = (
    f"jstate IN {_sql_list(INBOUND + WAITING)}"
    f" OR (jstate IN {_sql_list(SENDING)} AND trim(jtype) = '{L.TYPE_SEND}')"
    f" OR (jstate = '{L.CLASSIFIED}' AND jtype IN {_sql_list(HANDSHAKE_TYPES)})"
)


@dataclass(frozen=True)
class TickResult:
    """The state after a tick and the rows it wrote, for the change feeds."""

    state: NodeState
    job_changes: DataFrame
    inserted_jobs: DataFrame
    new_events: DataFrame
    new_commands: DataFrame


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _negotiate(state: NodeState, tick: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Peers after this tick's handshakes, the type 4 frames, and the capacity events."""
    node = state.node
    frame_kind = X.frame_type(F.col("jobdata"))
    # Movable rows only, so classified data frames at rest are not read; then the type test, so only
    # handshakes pay for a digest here.
    arrived = state.jobs.filter(F.expr(MOVABLE) & F.col("jstate").isin(*INBOUND, L.CLASSIFIED)).filter(
        frame_kind.isin(*HANDSHAKE_TYPES))
    classified = transitions.advance_inbound(arrived, node)
    requests = negotiate.handshakes(classified, L.TYPE_REQUEST)
    written = negotiate.peer_writes(requests, node)
    known = negotiate.upsert_peers(state.peers, written)
    replied = negotiate.reply_writes(known, negotiate.handshakes(classified, L.TYPE_REPLY))
    peers = cut_lineage(negotiate.upsert_peers(known, replied))
    events = changes.capacity_events(written, tick, 0).unionByName(
        changes.capacity_events(replied, tick, 1))
    return peers, requests, events


def _finish_parents(state: NodeState) -> DataFrame:
    """Waiting parents, moved to C where their children are complete. Reads counters, no children."""
    waiting = state.jobs.filter(F.expr(MOVABLE) & F.col("jstate").isin(*WAITING))
    # Identifiers move as 16 bytes, and counts are dealt out by parent once.
    packed = waiting.withColumn("_parent", X.packed_id(F.col("jobid"))).drop("jobid")
    joined = packed.join(counters.finished_keys(state.child_counts), "_parent", "left")
    done = F.when(F.col("jstate") == L.CHUNKED_WAITING, F.col("_chunked")).otherwise(F.col("_chunked").isNotNull())
    named = joined.withColumn("jobid", X.unpacked_id(F.col("_parent")))
    return transitions.move(named, done, L.COMPLETE).select(*JOB_COLUMNS)


def _count_changes(state: NodeState, written: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Child counts and job counts after a tick, from the rows it replaced and those it wrote."""
    replaced = state.jobs.filter(F.expr(MOVABLE))
    stats = counters.merged(state.job_counts, counters.job_counts(written), counters.job_counts(replaced))
    children = counters.together(state.child_counts, counters.child_counts(written), counters.child_counts(replaced))
    unfinished = written.filter(F.col("jstate").isin(*SENDING, *WAITING) & (F.btrim("jtype") == L.TYPE_SEND))
    return counters.of_open_parents(children, unfinished), stats


def _plan_sends(state: NodeState, peers: DataFrame) -> DataFrame:
    """Send jobs after admission and planning: S, S-1, S-2 or S-3. Narrow rows."""
    sends = state.jobs.filter(
        F.col("jstate").isin(*SENDING) & (F.btrim("jtype") == L.TYPE_SEND))
    admitted = transitions.admit_known_peers(sends, state.peers)
    return cut_lineage(transitions.plan_sends(admitted, state.files, peers))


def run_tick(state: NodeState, as_of: datetime,
             write_jobs: Callable[[DataFrame], DataFrame] | None = None) -> TickResult:
    """Runs all statements once.

    ``write_jobs`` may store the changed jobs and return them read back; the connection
    statements then read three narrow columns instead of running the plan again.
    """
    node, tick = state.node, state.version + 1
    spark = state.jobs.sparkSession
    peers, requests, events = _negotiate(state, tick)
    planned = _plan_sends(state, peers)

    created = [
        negotiate.handshake_requests(state.jobs, state.peers, node, as_of),
        negotiate.handshake_replies(requests, node, as_of),
    ]
    if not planned.filter(F.col("jstate").isin(L.CHUNKED, L.SINGLE)).isEmpty():
        created += [
            framing.encode_single(planned, state.files, peers, as_of),
            framing.chunk_payloads(planned, state.files, peers, as_of),
            framing.encode_manifest(planned, state.files, peers, as_of),
        ]
    inserted = _union(created)

    movable = F.expr(MOVABLE)
    inbound = state.jobs.filter(
        movable & F.col("jstate").isin(*INBOUND, L.CLASSIFIED))
    inbound = transitions.advance_inbound(inbound, node)
    for kind in (L.TYPE_REQUEST, L.TYPE_REPLY):
        inbound = transitions.finish_handshake(inbound, kind)
    framed = {L.CHUNKED: L.CHUNKED_WAITING, L.SINGLE: L.SINGLE_WAITING}
    waiting = transitions._where_peer_known(planned, peers, framed)
    finished = _finish_parents(state)
    if write_jobs is None:  # what is not stored is read several times
        with setting(spark, SWEEP, "true"):
            finished = cut_lineage(finished)
    moved = _union([part.select(*JOB_COLUMNS) for part in (inbound, finished, waiting)])

    job_changes = moved.unionByName(inserted)
    if write_jobs is not None:
        job_changes = write_jobs(job_changes)
    jobs = state.jobs.filter(~movable).unionByName(job_changes)
    child_counts, job_counts = _count_changes(state, job_changes)
    # States and destinations are all the connection statements ask of jobs, so counters will do.
    present = job_counts = cut_lineage(job_counts, "job-counts")

    out_conns = queues.ensure_conns(state.out_conns, present, peers, as_of)
    out_conns = cut_lineage(out_conns)
    opened = queues.open_commands(state.commands, present, peers, out_conns, tick)
    commands = state.commands.unionByName(opened)
    closed = queues.close_commands(commands, present, peers, out_conns, tick)
    after = state.with_tables(
        jobs=jobs, peers=peers, out_conns=out_conns, commands=commands.unionByName(closed),
        capacity_events=state.capacity_events.unionByName(events), version=tick,
        child_counts=child_counts, job_counts=job_counts)
    return TickResult(after, job_changes, inserted, events, opened.unionByName(closed))


def write_set(state: NodeState, result: TickResult) -> DataFrame:
    """What the tick after ``state`` wrote, for ``changes.notifications``: jobs, commands, capacity events."""
    version = result.state.version
    moved = changes.job_writes(state.jobs.filter(F.expr(MOVABLE)), result.job_changes)
    commands = changes.write_set(result.new_commands, changes.INSERT)
    events = changes.write_set(result.new_events, changes.INSERT)
    return _union([
        changes.write_rows(version, "jobs", moved, "jobid", "jstate"),
        changes.write_rows(version, "commands", commands, "scommid", "mtype"),
        changes.write_rows(version, "capacity_events", events, "rcomid"),
    ])


def commit_tick(state: NodeState, root: str, as_of: datetime, batch: str | None = None
                ) -> NodeState:
    """Runs a tick on a stored state and commits the next version.

    The jobs that moved or are new are written once, to the directory of the new version.
    ``batch`` names the micro-batch taken in, if any. The commit names the version's write set too,
    which ``streams.change_feed`` follows.
    """
    with setting(state.jobs.sparkSession, SWEEP, "true"):
        return _commit_tick(state, root, as_of, batch)


def _commit_tick(state: NodeState, root: str, as_of: datetime, batch: str | None) -> NodeState:
    version = state.version + 1
    spark = state.jobs.sparkSession
    result = run_tick(state, as_of, lambda df: store.write_job_changes(df, root, version))
    tables = {name: getattr(result.state, name)
              for name in ("peers", "out_conns", "commands", "capacity_events", "child_counts", "job_counts")}
    tables["writes"] = write_set(state, result)
    done = store.save_changes(state, root, version, MOVABLE, tables, batch)
    if store.n_job_parts(spark, root, version) > COMPACT_AFTER:
        done = store.save_state(done, root, version + 1, batch)
    return done
