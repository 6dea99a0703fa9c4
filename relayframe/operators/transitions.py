"""State transitions: jobs in, jobs out.

Each takes the jobs table and returns it with the same columns. Those that depend on
the row alone are one projection and move no data. Those that depend on other rows
join narrow rows first and touch the wide payload column only where the state changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import frames as X
from ..functions import layout as L
from ..node import Node
from ..session import cut_lineage
from .framing import JOB_COLUMNS, addressable
from .lookups import BROADCAST_ROWS, WIDE_ROWS, BitTable, fits_broadcast, join_lookup, latest_by


def move(jobs: DataFrame, condition: Column, state) -> DataFrame:
    """Sets ``jstate`` where the condition holds."""
    return jobs.withColumn("jstate", F.when(condition, X.as_column(state)).otherwise(F.col("jstate")))


# --- inbound ----------------------------------------------------------------------

def verify_integrity(jobs: DataFrame) -> DataFrame:
    """N-1 to N-2 when the leading digest matches the rest of the frame."""
    return move(jobs, (F.col("jstate") == L.RECEIVED) & X.digest_matches(F.col("jobdata")), L.VERIFIED)


def dead_letter(jobs: DataFrame) -> DataFrame:
    """N-1 to D when the digest does not match."""
    return move(jobs, (F.col("jstate") == L.RECEIVED) & ~X.digest_matches(F.col("jobdata")), L.DEAD)


def dead_letter_report(jobs: DataFrame) -> DataFrame:
    """Why inbound rows are or would be dead: wrong digest, or a field that is out of range."""
    frame = F.col("jobdata")
    reason = F.when(~X.digest_matches(frame), F.lit("digest")).when(X.malformed(frame), F.lit("malformed"))
    return (
        jobs.filter(F.col("jstate").isin(L.RECEIVED, L.CLASSIFIED, L.DEAD))
        .select("jobid", "jstate", reason.alias("reason"))
        .filter(F.col("reason").isNotNull())
    )


def _for_this_node(node: Node) -> Column:
    return X.frame_text(F.col("jobdata"), L.HEADER["frame_destination"]) == node.name


def route_local(jobs: DataFrame, node: Node) -> DataFrame:
    """N-2 to N-3 when the frame is addressed to this node."""
    return move(jobs, (F.col("jstate") == L.VERIFIED) & _for_this_node(node), L.LOCAL)


def route_forward(jobs: DataFrame, node: Node) -> DataFrame:
    """N-2 to S-1 with the frame's own destination when it is addressed elsewhere."""
    away = (F.col("jstate") == L.VERIFIED) & ~_for_this_node(node)
    target = X.frame_text(F.col("jobdata"), L.HEADER["frame_destination"])
    return jobs.withColumns({
        "jdestination": F.when(away, target).otherwise(F.col("jdestination")),
        "jstate": F.when(away, L.ADMITTED).otherwise(F.col("jstate")),
    })


def classify_type(jobs: DataFrame) -> DataFrame:
    """N-3 to N-4, with the type read from the frame; malformed chunks and manifests to D."""
    here = F.col("jstate") == L.LOCAL
    return jobs.withColumns({
        "jtype": F.when(here, X.frame_type(F.col("jobdata"))).otherwise(F.col("jtype")),
        "jstate": F.when(here & malformed_data(), L.DEAD).when(here, L.CLASSIFIED).otherwise(F.col("jstate")),
    })


def advance_inbound(jobs: DataFrame, node: Node) -> DataFrame:
    """The five inbound steps in order, as one projection: one digest per frame."""
    frame = F.col("jobdata")
    target = X.frame_text(frame, L.HEADER["frame_destination"])
    ok = F.when(F.col("jstate") == L.RECEIVED, X.digest_matches(frame))
    routed = (F.col("jstate") == L.VERIFIED) | (F.col("_ok"))
    staged = jobs.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    local = (F.col("jstate") == L.LOCAL) | (routed & (target == node.name))
    away = routed & (target != node.name)
    return staged.select(*[
        {
            "jstate": F.when(local & malformed_data(), L.DEAD).when(local, L.CLASSIFIED).when(away, L.ADMITTED)
            .when(F.col("jstate") == L.RECEIVED, L.DEAD).otherwise(F.col("jstate")).alias("jstate"),
            "jtype": F.when(local, X.frame_type(frame)).otherwise(F.col("jtype")).alias("jtype"),
            "jdestination": F.when(away, target).otherwise(
                F.col("jdestination")).alias("jdestination"),
        }.get(name, F.col(name))
        for name in jobs.columns
    ])


def malformed_data() -> Column:
    """True for a chunk or manifest that could not be placed; it takes part in no message."""
    frame = F.col("jobdata")
    return X.frame_type(frame).isin(L.padded(L.TYPE_CHUNK), L.padded(L.TYPE_MANIFEST)) & X.malformed(frame)


def finish_handshake(jobs: DataFrame, kind: str) -> DataFrame:
    """N-4 handshakes of one kind to C; malformed ones to D."""
    done = (F.col("jstate") == L.CLASSIFIED) & (F.col("jtype") == L.padded(kind))
    return move(jobs, done, F.when(X.malformed(F.col("jobdata")), L.DEAD).otherwise(F.lit(L.COMPLETE)))


# --- completion of sending parents ------------------------------------------------

def _split(jobs: DataFrame, *states: str) -> tuple[DataFrame, DataFrame]:
    return jobs.filter(F.col("jstate").isin(*states)), jobs.filter(~F.col("jstate").isin(*states))


def _flagged(rows: DataFrame, parents: DataFrame, state: str) -> DataFrame:
    """Moves the rows whose jobid is among the packed ``_parent`` keys."""
    found = parents.withColumn("_found", F.lit(True))
    joined = rows.withColumn("_parent", X.packed_id(F.col("jobid"))).join(found, "_parent", "left")
    return move(joined, F.col("_found").isNotNull(), state).select(*JOB_COLUMNS)


def finished_chunked_parents(jobs: DataFrame) -> DataFrame:
    """Parents whose manifest count + 1 equals their number of complete children.

    Children are counted per parent before anything is joined, so the root, parent of
    every inbound row, costs one partial count per task.
    """
    return _finished_keys(jobs).select(X.unpacked_id(F.col("_parent")).alias("jparent_jobid"))


def _finished_keys(jobs: DataFrame) -> DataFrame:
    parent = X.packed_id(F.col("jparent_jobid")).alias("_parent")
    done = (
        jobs.filter(F.col("jstate") == L.COMPLETE)
        .groupBy(parent).agg(F.count("*").alias("n_done"))
    )
    frame = F.col("jobdata")
    manifests = (
        jobs.filter(F.col("jtype").isin(L.TYPE_MANIFEST, L.padded(L.TYPE_MANIFEST)))
        .filter(X.frame_type(frame) == L.padded(L.TYPE_MANIFEST))
        .select(parent, X.frame_number(frame, L.MANIFEST["chunk_count"]).alias("n_chunks"))
        .distinct()
    )
    return (
        manifests.join(done, "_parent")
        .filter(F.col("n_chunks") + 1 == F.col("n_done"))
        .select("_parent").distinct()
    )


def complete_chunked_parents(jobs: DataFrame) -> DataFrame:
    """S-2W to C when all chunks and the manifest are complete."""
    waiting, rest = _split(jobs, L.CHUNKED_WAITING)
    moved = _flagged(waiting, _finished_keys(jobs), L.COMPLETE)
    return rest.select(*JOB_COLUMNS).unionByName(moved)


def complete_single_parents(jobs: DataFrame) -> DataFrame:
    """S-3W to C when any child is complete."""
    waiting, rest = _split(jobs, L.SINGLE_WAITING)
    parents = jobs.filter(F.col("jstate") == L.COMPLETE).select(
        X.packed_id(F.col("jparent_jobid")).alias("_parent")).distinct()
    moved = _flagged(waiting, parents, L.COMPLETE)
    return rest.select(*JOB_COLUMNS).unionByName(moved)


# --- outbound ---------------------------------------------------------------------

def _where_peer_known(jobs: DataFrame, peers: DataFrame, moves: dict[str, str]) -> DataFrame:
    rows, rest = _split(jobs, *moves)
    known = (
        peers.select(F.col("system_name").alias("jdestination")).distinct()
        .withColumn("_known", F.lit(True))
    )
    joined = join_lookup(rows, known, ["jdestination"], "left", spread_by=F.col("jobid"))
    target = F.coalesce(*[F.when(F.col("jstate") == old, F.lit(new)) for old, new in moves.items()])
    moved = move(joined, F.col("_known").isNotNull(), target)
    return rest.select(*JOB_COLUMNS).unionByName(moved.select(*JOB_COLUMNS))


def admit_known_peers(jobs: DataFrame, peers: DataFrame) -> DataFrame:
    """S to S-1 when the destination is a known peer."""
    return _where_peer_known(jobs, peers, {L.REQUESTED: L.ADMITTED})


def await_chunks(jobs: DataFrame, peers: DataFrame) -> DataFrame:
    """S-2 to S-2W when the destination is a known peer."""
    return _where_peer_known(jobs, peers, {L.CHUNKED: L.CHUNKED_WAITING})


def await_single(jobs: DataFrame, peers: DataFrame) -> DataFrame:
    """S-3 to S-3W when the destination is a known peer."""
    return _where_peer_known(jobs, peers, {L.SINGLE: L.SINGLE_WAITING})


def plan_sends(jobs: DataFrame, files: DataFrame, peers: DataFrame,
               states: tuple[str, ...] = (L.CHUNKED, L.SINGLE)) -> DataFrame:
    """S-1 send jobs to S-2 (file larger than one payload) or S-3 (it fits).

    Joins names and sizes, never file contents. Forwarded frames also sit in S-1; they
    hold no file name, so they stay out of the join with their payload.
    """
    is_send = (F.col("jstate") == L.ADMITTED) & (F.btrim("jtype") == L.TYPE_SEND)
    rows, rest = jobs.filter(is_send), jobs.filter(~is_send)
    sizes = files.select("file_name", "n_bytes")
    capacity = addressable(peers)
    named = rows.withColumn("file_name", F.col("jobdata").cast("string"))
    sized = join_lookup(named, sizes, ["file_name"], "left", spread_by=F.col("jobid"))
    sized = join_lookup(sized, capacity, ["jdestination"], "left", spread_by=F.col("jobid"))
    fits = F.col("n_bytes") <= F.col("system_capacity") - L.DATA_OVERHEAD
    planned = F.when(~fits & F.lit(L.CHUNKED in states), L.CHUNKED).when(
        fits & F.lit(L.SINGLE in states), L.SINGLE)
    moved = sized.withColumn("jstate", F.coalesce(planned, F.col("jstate"))).select(*JOB_COLUMNS)
    return rest.select(*JOB_COLUMNS).unionByName(moved)


def plan_chunked(jobs: DataFrame, files: DataFrame, peers: DataFrame) -> DataFrame:
    """S-1 to S-2 when the file is larger than one payload."""
    return plan_sends(jobs, files, peers, (L.CHUNKED,))


def plan_single(jobs: DataFrame, files: DataFrame, peers: DataFrame) -> DataFrame:
    """S-1 to S-3 when the file fits one payload."""
    return plan_sends(jobs, files, peers, (L.SINGLE,))


# --- updates from outside ---------------------------------------------------------

def mark_taken(jobs: DataFrame, picked: DataFrame) -> DataFrame:
    """Appends W to the state of the picked jobids, e.g. S-4 to S-4W."""
    ids = picked.select("jobid").distinct().withColumn("_picked", F.lit(True))
    joined = join_lookup(jobs, ids, ["jobid"], "left", spread_by=F.col("jobid"),
                         rows_per_task=WIDE_ROWS, write_lookup=True)
    taken = F.concat(F.rtrim(F.col("jstate")), F.lit(L.TAKEN_SUFFIX))
    return move(joined, F.col("_picked").isNotNull(), taken).select(*jobs.columns)


def apply_send_status(jobs: DataFrame, acks: DataFrame) -> DataFrame:
    """Acknowledged jobs to C (status > 0) or D. ``acks``: jobid, status, ack_time, ack_id.

    Like the statement it stands for it does not look at the job's present state. Of
    several acknowledgements of a job the last one counts.
    """
    last = latest_by(acks, ["jobid"], ["ack_time", "ack_id"], ["status"])
    joined = join_lookup(jobs, last, ["jobid"], "left", spread_by=F.col("jobid"),
                         rows_per_task=WIDE_ROWS, write_lookup=True)
    outcome = F.when(F.col("status") > 0, L.COMPLETE).otherwise(F.lit(L.DEAD))
    return move(joined, F.col("status").isNotNull(), outcome).select(*jobs.columns)


def apply_handshake_status(jobs: DataFrame, acks: DataFrame) -> DataFrame:
    """The same for handshake frames: S-5 to C or D."""
    return apply_send_status(jobs, acks)


def update_job_priority(jobs: DataFrame, updates: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """New priority for a job and its direct children.

    ``updates``: jobid, new_priority, update_no. Updates apply in the order of
    ``update_no``, so for a row named both itself and through its parent the later wins.

    More than ``max_rows`` updated jobs are too many to be sent to every executor. Then a bit table of
    them leaves the jobs aside that no update can reach, and only the others move, with identifiers of 16
    bytes. ``jobs`` is read several times, so it should be a stored table.
    """
    last = cut_lineage(
        latest_by(updates, ["jobid"], ["update_no"], ["update_no", "new_priority"]), "lookup")
    if fits_broadcast(last, max_rows):
        return _prioritised(jobs, last, max_rows).select(*jobs.columns)
    named = BitTable(last.select(F.xxhash64("jobid").alias("_hash")), last.count())
    flagged = named.flag(named.flag(jobs, F.col("jobid"), "_self"), F.col("jparent_jobid"), "_above")
    rest = flagged.filter(~F.col("_self") & ~F.col("_above")).withColumn("jpriority", F.col("jpriority").cast("int"))
    packed = {c: X.packed_id(F.col(c)) for c in ("jobid", "jparent_jobid")}
    reached = flagged.filter(F.col("_self") | F.col("_above")).select(*jobs.columns).withColumns(packed)
    changed = _prioritised(reached, last.withColumn("jobid", packed["jobid"]), max_rows)
    changed = changed.withColumns({c: X.unpacked_id(F.col(c)) for c in packed})
    return rest.select(*jobs.columns).unionByName(changed.select(*jobs.columns))


def _prioritised(jobs: DataFrame, last: DataFrame, max_rows: int) -> DataFrame:
    """Joins the last update of each job with the job and with its children."""
    own = last.select("jobid", F.struct("update_no", "new_priority").alias("_own"))
    parent = last.select(F.col("jobid").alias("jparent_jobid"),
                         F.struct("update_no", "new_priority").alias("_parent"))
    joined = join_lookup(jobs, own, ["jobid"], "left", spread_by=F.col("jobid"),
                         rows_per_task=WIDE_ROWS, max_rows=max_rows)
    # Counted before the first join, which would else be done for the count too.
    joined = join_lookup(joined, parent, ["jparent_jobid"], "left", spread_by=F.col("jobid"),
                         rows_per_task=WIDE_ROWS, max_rows=max_rows, count_in=jobs)
    newest = F.greatest("_own", "_parent")["new_priority"]
    return joined.withColumn("jpriority", F.coalesce(newest, F.col("jpriority")).cast("int"))
