"""Ticks on stored state, and two nodes that exchange files until nothing moves."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from relayframe.node import Node
from relayframe.operators import queues, reassembly, reports, transitions
from relayframe.plans import tick as tick_plan
from relayframe.plans.tick import commit_tick, run_tick
from relayframe.sources import state as store
from relayframe.sources import wire
from tests import samples as S

M2 = Node("M2", 2130706434, 7001, 7000, 400, "22222222-0000-0000-0000-000000000000")
M3 = Node("M3", 2130706433, 6001, 6000, 32768, "33333333-0000-0000-0000-000000000000")


def job_rows(state):
    return sorted((r.jobid, r.jstate, r.jtype, r.jdestination, bytes(r.jobdata))
                  for r in state.jobs.collect())


def sending_node(spark, root, contents, requests):
    state = store.seed_node(spark, M2, S.AT, [("M3", M3.ipaddress, 6000)])
    files = S.files(spark, contents)
    wanted = spark.createDataFrame([(str(i), name, target) for i, (name, target)
                                    in enumerate(requests)],
                                   "request_id string, file_name string, destination string")
    jobs, _ = wire.create_send_jobs(wanted, files, M2, S.AT)
    return store.save_state(state.with_tables(files=files, jobs=state.jobs.unionByName(jobs)),
                            root, 0)


def deliver(spark, sender, receiver, roots, rows, moment):
    """Acknowledges the rows at the sender and ingests their bytes at the receiver."""
    picked = rows.select("jobid")
    frames = queues.get_payload(sender.jobs, picked).select(
        F.concat(F.lit(f"{moment}/"), F.col("jobid")).alias("frame_key"), F.lit(4).alias("fd"),
        "jobdata")
    arrived = wire.ingest_frames(frames, receiver.node, S.AT + timedelta(seconds=moment))
    done = picked.select("jobid", F.lit(1).alias("status"), F.lit(S.AT).alias("ack_time"),
                         F.lit(1).alias("ack_id"))
    taken = transitions.mark_taken(sender.jobs, picked)
    sent = sender.with_tables(jobs=transitions.apply_send_status(taken, done))
    got = receiver.with_tables(jobs=receiver.jobs.unionByName(arrived))
    got = store.save_state(got, roots[1])
    return store.save_state(sent, roots[0]), got


def open_connections(state, root):
    """Every open command succeeds with descriptor 5."""
    reports_ = state.commands.filter("mtype = '1'").select(
        "scommid", F.lit(5).alias("fd"), F.col("mdata1").alias("ipaddress"),
        F.lit(S.AT).alias("reported_at"), F.lit(1).alias("report_id"))
    conns, commands = queues.apply_connection_status(state.out_conns, state.commands, reports_)
    return store.save_state(state.with_tables(out_conns=conns, commands=commands), root)


def test_two_nodes_exchange_files(spark, folder):
    roots = (f"{folder}/m2", f"{folder}/m3")
    contents = {"large": random.Random(1).randbytes(2000), "small": b"hello", "empty": b""}
    sender = sending_node(spark, roots[0], contents, [
        ("large", "M3"), ("small", "M3"), ("empty", "M3"), ("small", "M7")])
    receiver = store.save_state(store.seed_node(spark, M3, S.AT), roots[1], 0)

    # The target is known but not negotiated: one request, and jobs wait in S-1.
    sender = commit_tick(sender, roots[0], S.AT)
    shaken = sender.jobs.filter("jstate = 'S-5'")
    assert shaken.count() == 1
    assert sorted(S.states(sender.jobs.filter("jtype = '    6'")).values()) == [
        "S", "S-1", "S-1", "S-1"]
    sender, receiver = deliver(spark, sender, receiver, roots, shaken, 1)

    # The receiver learns the sender and replies with the smaller capacity.
    receiver = commit_tick(receiver, roots[1], S.AT)
    assert [tuple(r) for r in receiver.peers.collect()] == [("   M2", M2.ipaddress, 7001, 7000, 400)]
    assert [(r.rdata1, r.rdata2) for r in receiver.capacity_events.collect()] == [
        (M2.ipaddress, 400)]
    receiver, sender = deliver(spark, receiver, sender, roots[::-1],
                               receiver.jobs.filter("jstate = 'S-5'"), 2)

    # The reply fills the peer; files become frames; a connection is wanted.
    sender = commit_tick(sender, roots[0], S.AT)
    assert [tuple(r) for r in sender.peers.collect()] == [("   M3", M3.ipaddress, 6001, 6000, 400)]
    ready = sender.jobs.filter("jstate = 'S-4'")
    assert {r.jtype: r["count"] for r in ready.groupBy("jtype").count().collect()} == {
        "1": 2, "2": 9, "3": 1}
    assert [r.mtype for r in sender.commands.collect()] == ["1"]
    assert queues.pending_with_conn(sender.jobs, sender.peers, sender.out_conns).count() == 0
    sender = open_connections(sender, roots[0])
    pending = queues.pending_with_conn(sender.jobs, sender.peers, sender.out_conns)
    assert pending.count() == 12
    sender, receiver = deliver(spark, sender, receiver, roots, pending, 3)

    # Children complete the parents; the receiver has the file.
    sender = commit_tick(sender, roots[0], S.AT)
    assert sorted(S.states(sender.jobs.filter("jtype = '    6'")).values()) == ["C", "C", "C", "S"]
    assert [(r.jobid != "", r.reason) for r in
            reports.stalled_jobs(sender.jobs, sender.peers).collect()] == [(True, "unknown peer")]
    assert [r.mtype for r in sender.commands.collect()] == ["2"]
    receiver = commit_tick(receiver, roots[1], S.AT)
    assert receiver.jobs.filter("jstate = 'N-4'").count() == 12
    assert bytes(reassembly.reassemble(receiver.jobs).first().content) == contents["large"]

    # Quiet: another tick changes nothing but the version.
    for state, root in ((sender, roots[0]), (receiver, roots[1])):
        before, small = job_rows(state), sorted(map(repr, state.commands.collect()))
        again = commit_tick(state, root, S.AT + timedelta(days=1))
        assert job_rows(again) == before
        assert sorted(map(repr, again.commands.collect())) == small
        assert again.version == state.version + 1


def test_stored_tick_equals_the_lazy_one_and_can_run_again(spark, folder, monkeypatch):
    state = sending_node(spark, folder, {"a": b"x" * 900, "b": b"y"}, [("a", "M3"), ("b", "M3")])
    state = store.save_state(state.with_tables(
        peers=S.peers(spark, [("M3", M3.ipaddress, 6001, 400)])), folder)
    lazy = run_tick(state, S.AT)
    first = commit_tick(state, folder, S.AT, "batch-1")
    rows = job_rows(first)
    assert job_rows(lazy.state) == rows and store.last_batch(spark, folder) == "batch-1"
    again = commit_tick(state, folder, S.AT, "batch-1")
    assert job_rows(again) == rows and again.version == first.version
    assert job_rows(store.load_state(spark, folder, state.version)) == job_rows(state)

    monkeypatch.setattr(tick_plan, "COMPACT_AFTER", 1)
    compact = commit_tick(again, folder, S.AT, "batch-2")
    assert job_rows(compact) == rows and store.last_batch(spark, folder) == "batch-2"
    assert store.n_job_parts(spark, folder, compact.version) == 1


def test_a_tick_rewrites_only_rows_that_can_move(spark, folder):
    state = sending_node(spark, folder, {"b": b"y"}, [("b", "M7")])
    at_rest = [{"jobid": f"x{s}{t}", "jstate": s, "jtype": t} for s, t in (
        ("C", "2"), ("D", "0"), ("S-4", "2"), ("S-4W", "1"), ("N-4", "    2"), ("S-1", "0"))]
    jobs = state.jobs.unionByName(S.jobs(spark, at_rest))
    state = store.save_state(state.with_tables(jobs=jobs), folder)
    result = run_tick(state, S.AT)
    assert {r.jstate for r in result.job_changes.collect()} == {"S"}
    assert job_rows(result.state) == job_rows(state)


def test_reading_without_a_commit_fails(spark, folder):
    with pytest.raises(FileNotFoundError):
        store.load_state(spark, folder)
