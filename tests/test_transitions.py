from datetime import timedelta

import pytest

from relayframe.functions import layout as L
from relayframe.operators import changes, integrity, negotiate, queues, reports, transitions
from relayframe.schemas import COMMANDS, IN_CONNS, OUT_CONNS
from relayframe.sources import wire
from tests import samples as S

MID = "12345678-1234-1234-1234-123456789012"


def acks(spark, rows):
    return spark.createDataFrame(
        [(j, s, S.AT + timedelta(seconds=t), n) for n, (j, s, t) in enumerate(rows)],
        "jobid string, status int, ack_time timestamp, ack_id int")


def test_inbound_steps_equal_the_single_pass(spark):
    good = S.frame(MID, "1", "M2", "M3", 5, 200, payload=b"x")
    away = S.frame(MID, "1", "M2", "M9", 5, 200, payload=b"x")
    bad = b"0" * 32 + good[32:]
    rows = [{"jobid": n, "jobdata": d, "jstate": s, "jtype": "0", "jdestination": "0"}
            for n, d, s in (("good", good, "N-1"), ("away", away, "N-1"), ("bad", bad, "N-1"),
                            ("two", good, "N-2"), ("three", good, "N-3"), ("other", bad, "S-4"))]
    jobs = S.jobs(spark, rows)
    stepwise = transitions.dead_letter(transitions.verify_integrity(jobs))
    stepwise = transitions.route_forward(transitions.route_local(stepwise, S.NODE), S.NODE)
    stepwise = transitions.classify_type(stepwise)
    at_once = transitions.advance_inbound(jobs, S.NODE)
    assert sorted(map(repr, stepwise.collect())) == sorted(map(repr, at_once.collect()))
    assert S.states(at_once) == {"good": "N-4", "away": "S-1", "bad": "D", "two": "N-4",
                                 "three": "N-4", "other": "S-4"}
    assert {r.jobid: r.jdestination for r in at_once.collect()}["away"] == "   M9"


@pytest.mark.parametrize("done, manifest, want", [
    (3, "C", "C"), (2, "C", "S-2W"), (3, "S-4", "S-2W"), (4, "S-4", "C"), (4, "C", "S-2W")])
def test_parent_completes_on_row_count(spark, done, manifest, want):
    """Rows are counted: one chunk too many stands in for an unsent manifest, as specified."""
    sub = MID.encode() + b"         384" + b"         3"
    rows = [{"jobid": "p", "jstate": "S-2W"},
            {"jobid": "m", "jobdata": S.frame(MID, "3", "M3", "M2", 5, 172, sub), "jtype": "3",
             "jparent_jobid": "p", "jstate": manifest}]
    rows += [{"jobid": f"c{i}", "jtype": "2", "jparent_jobid": "p", "jstate": "C"}
             for i in range(done)]
    assert S.states(transitions.complete_chunked_parents(S.jobs(spark, rows)))["p"] == want


def test_dead_chunk_stalls_its_parent(spark):
    jobs = S.jobs(spark, [
        {"jobid": "p", "jstate": "S-3W"}, {"jobid": "q", "jstate": "S-3W"},
        {"jobid": "c", "jtype": "1", "jparent_jobid": "p", "jstate": "D"},
        {"jobid": "d", "jtype": "1", "jparent_jobid": "q", "jstate": "C"}])
    assert S.states(transitions.complete_single_parents(jobs)) == {
        "p": "S-3W", "q": "C", "c": "D", "d": "C"}
    assert [(r.jobid, r.dead_children) for r in reports.stalled_parents(jobs).collect()] == [("p", 1)]


def test_last_ack_wins_and_zero_is_dead(spark):
    jobs = S.jobs(spark, [{"jobid": j, "jstate": "S-4W"} for j in "abc"])
    rows = [("a", 0, 1), ("a", 5, 2), ("b", 5, 1), ("b", 0, 1)]
    assert S.states(transitions.apply_send_status(jobs, acks(spark, rows))) == {
        "a": "C", "b": "D", "c": "S-4W"}


def test_priority_reaches_direct_children_in_order(spark):
    jobs = S.jobs(spark, [{"jobid": "p"}, {"jobid": "c", "jparent_jobid": "p"},
                          {"jobid": "g", "jparent_jobid": "c"}])
    updates = spark.createDataFrame([("p", 9, 1), ("c", 7, 2), ("p", 8, 3), ("g", 1, 4)],
                                    "jobid string, new_priority int, update_no int")
    one_by_one = {"p": 5, "c": 5, "g": 5}
    parent = {"p": S.ROOT, "c": "p", "g": "c"}
    for target, value, _ in sorted((tuple(r) for r in updates.collect()), key=lambda r: r[2]):
        for j in one_by_one:
            if j == target or parent[j] == target:
                one_by_one[j] = value
    got = transitions.update_job_priority(jobs, updates)
    assert {r.jobid: r.jpriority for r in got.collect()} == one_by_one == {"p": 8, "c": 8, "g": 1}


def test_taken_and_payload(spark):
    jobs = S.jobs(spark, [{"jobid": j, "jstate": "S-4", "jobdata": j.encode()} for j in "ab"])
    picked = jobs.filter("jobid = 'a'").select("jobid")
    assert S.states(transitions.mark_taken(jobs, picked)) == {"a": "S-4W", "b": "S-4"}
    assert [bytes(r.jobdata) for r in queues.get_payload(jobs, picked).collect()] == [b"a"]


def test_picks_order_by_number_or_by_text(spark):
    jobs = S.jobs(spark, [{"jobid": f"j{p}", "jstate": s, "jpriority": p}
                          for p in (2, 10, 9) for s in ("S-4",)])
    peers = S.peers(spark, [("M2", 7, 7001, 1024)])
    conns = spark.createDataFrame([(3, 7, 2, S.AT)], OUT_CONNS)
    pending = queues.pending_with_conn(jobs, peers, conns)
    assert [r.jobid for r in queues.top_pending(pending, 2).collect()] == ["j10", "j9"]
    shaken = queues.pending_handshake(transitions.move(jobs, jobs.jstate == "S-4", "S-5"), peers)
    assert [r.jobid for r in queues.top_handshake(shaken, 3).collect()] == ["j10", "j2", "j9"]


def test_two_requests_of_one_peer_in_a_tick(spark):
    frames = [S.frame(MID, "4", "M2", "M3", 5, 147, f"{c:>11}       7001          9".encode())
              for c in (1024, 65536)]
    rows = [{"jobid": f"j{i}", "jobdata": f, "jstate": "N-4", "jtype": "    4",
             "jcreation_time": S.AT + timedelta(seconds=i)} for i, f in enumerate(frames)]
    requests = negotiate.handshakes(S.jobs(spark, rows), L.TYPE_REQUEST)
    writes = negotiate.peer_writes(requests, S.NODE)
    peers = negotiate.upsert_peers(S.peers(spark, [("M2", 9, 0, 0), ("M9", 8, 0, 0)]), writes)
    assert {(r.system_name, r.system_capacity) for r in peers.collect()} == {
        ("   M2", 32768), ("   M9", 0)}
    replies = negotiate.handshake_replies(requests, S.NODE, S.AT).collect()
    assert sorted(bytes(r.jobdata)[114:125] for r in replies) == [b"       1024", b"      32768"]


def test_connection_reports_and_commands(spark):
    conns = spark.createDataFrame([(-1, 1, 1, S.AT), (5, 2, 2, S.AT), (6, 3, 2, S.AT)], OUT_CONNS)
    commands = spark.createDataFrame(
        [(1, 1, 7001, "1W"), (2, 2, 5, "2W"), (3, 3, 6, "2")], COMMANDS)
    reports_ = spark.createDataFrame([(1, 9, 1, S.AT, 1), (2, -1, 2, S.AT, 2)],
                                     "scommid long, fd int, ipaddress long, "
                                     "reported_at timestamp, report_id int")
    new_conns, left = queues.apply_connection_status(conns, commands, reports_)
    assert {(r.sipaddr, r.sfd, r.scstatus) for r in new_conns.collect()} == {
        (1, 9, 2), (2, -1, 1), (3, 6, 2)}
    assert [r.scommid for r in left.collect()] == [3]
    taken = queues.take_command(left, queues.next_command(left))
    assert [r.mtype for r in taken.collect()] == ["2W"]
    assert queues.next_command(taken).count() == 0


def test_close_waits_for_dead_jobs_too(spark):
    peers = S.peers(spark, [("M2", 1, 7001, 1024), ("M4", 2, 7001, 1024)])
    conns = spark.createDataFrame([(5, 1, 2, S.AT), (6, 2, 2, S.AT)], OUT_CONNS)
    none = spark.createDataFrame([], COMMANDS)
    jobs = S.jobs(spark, [{"jobid": "a", "jstate": "D"},
                          {"jobid": "b", "jstate": "C", "jdestination": "   M4"}])
    closing = queues.close_commands(none, jobs, peers, conns)
    assert [(r.mdata1, r.mdata2) for r in closing.collect()] == [(2, 6)]
    closing = queues.close_commands(none, jobs, peers, conns, terminal_states=("C", "D"))
    assert {r.mdata1 for r in closing.collect()} == {1, 2}


def test_known_descriptor_keeps_its_address(spark):
    conns = spark.createDataFrame([(4, 100, 2, S.AT)], IN_CONNS)
    rows = [(4, 200, 1, S.AT, 1), (5, 300, 2, S.AT, 2), (5, 400, 1, S.AT, 3)]
    reports_ = spark.createDataFrame(
        rows, "rfd int, ripaddr long, rcstatus int, reported_at timestamp, report_id int")
    got = queues.upsert_in_conns(conns, reports_, S.AT)
    assert {(r.rfd, r.ripaddr, r.rcstatus) for r in got.collect()} == {(4, 100, 1), (5, 300, 1)}


def test_bursts_are_cut_at_the_latest_size(spark):
    events = spark.createDataFrame([(1, 7, 10), (2, 7, 4), (3, 8, 3)],
                                   "rcomid long, rdata1 long, rdata2 long")
    bursts = spark.createDataFrame(
        [(1, 3, 7, bytearray(b"abcdefghij")), (2, 3, 8, bytearray(b"")), (3, 3, 9, bytearray(b"x"))],
        "burst_id int, fd int, ipaddress long, content binary")
    cut = wire.split_frames(bursts, wire.latest_sizes(events)).orderBy("frame_no").collect()
    assert [(bytes(r.jobdata), r.complete) for r in cut] == [
        (b"abcd", True), (b"efgh", True), (b"ij", False)]


def test_send_requests_for_missing_files_are_rejected(spark):
    requests = spark.createDataFrame([("1", "a", "M2"), ("2", "zz", "M2")],
                                     "request_id string, file_name string, destination string")
    jobs, rejected = wire.create_send_jobs(requests, S.files(spark, {"a": b"x"}), S.NODE, S.AT)
    assert [(bytes(r.jobdata), r.jstate, r.jtype, r.jdestination) for r in jobs.collect()] == [
        (b"a", "S", "    6", "   M2")]
    assert [r.request_id for r in rejected.collect()] == ["2"]


def test_change_feeds(spark):
    writes = spark.createDataFrame([("a", "S-5", "insert"), ("b", "S-5", "update"),
                                    ("c", "S-4", "update"), ("d", "S-4", "insert")],
                                   "jobid string, jstate string, op string")
    commands = spark.createDataFrame([(1, "1", "insert"), (2, "1W", "insert")],
                                     "scommid long, mtype string, op string")
    assert [r.key for r in changes.notify_handshake(writes).collect()] == ["a"]
    assert {r.key for r in changes.notify_sender(writes, commands).collect()} == {"c", "d", "1"}
    before = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, v string")
    after = spark.createDataFrame([(2, "y"), (3, "w"), (4, "n")], "k int, v string")
    diff = {(r.k, r.op) for r in changes.snapshot_diff(before, after, ["k"]).collect()}
    assert diff == {(1, "delete"), (3, "update"), (4, "insert")}


def test_constraints_and_lineage(spark):
    jobs = S.jobs(spark, [
        {"jobid": S.ROOT, "jstate": "N-0"}, {"jobid": "p"}, {"jobid": "p"},
        {"jobid": "c", "jparent_jobid": "p"}, {"jobid": "x", "jparent_jobid": "gone"},
        {"jobid": "n", "jdestination": None}])
    found = {(r.table_name, r.rule): r.violations
             for r in integrity.check_constraints({"jobs": jobs}).collect()}
    assert found[("jobs", "unique(jobid)")] == 1 and found[("jobs", "parent exists")] == 1
    assert found[("jobs", "required(jdestination)")] == 1
    assert sum(found.values()) == 3
    root = spark.createDataFrame([(S.ROOT,)], "jobid string")
    below = integrity.job_descendants(jobs.dropDuplicates(["jobid"]), root)
    assert {(r.jobid, r.depth) for r in below.collect()} == {("p", 1), ("n", 1), ("c", 2)}
    assert integrity.job_descendants(jobs, jobs.filter("jobid = 'c'")).count() == 0


def test_a_cycle_ends_where_it_began(spark):
    jobs = S.jobs(spark, [{"jobid": "a", "jparent_jobid": "b"}, {"jobid": "b", "jparent_jobid": "a"},
                          {"jobid": "c", "jparent_jobid": "b"}])
    below = integrity.job_descendants(jobs, jobs.filter("jobid = 'a'"))
    assert {(r.jobid, r.depth) for r in below.collect()} == {("b", 1), ("c", 2)}


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    written, inner = [], integrity.cut_lineage
    monkeypatch.setattr(integrity, "cut_lineage", lambda df, name="step": written.append(name) or inner(df, name))
    n = 1000
    jobs = spark.range(n).selectExpr("cast(id as string) jobid", "cast(greatest(id - 1, 0) as string) jparent_jobid")
    side = spark.createDataFrame([("x", "990"), ("y", "x"), ("z", "gone")], "jobid string, jparent_jobid string")
    above = spark.createDataFrame([("0",), ("990",), ("nobody",), (None,)], "jobid string")
    below = {(r.ancestor, r.jobid): r.depth for r in integrity.job_descendants(jobs.unionByName(side), above).collect()}
    want = {("0", str(i)): i for i in range(1, n)} | {("990", str(i)): i - 990 for i in range(991, n)}
    want |= {("0", "x"): 991, ("0", "y"): 992, ("990", "x"): 1, ("990", "y"): 2}
    assert below == want
    assert written.count("below") <= 11
    assert integrity.job_descendants(jobs.limit(0), above).count() == 0


def test_a_cycle_longer_than_a_round_lists_each_job_once(spark):
    ring = spark.range(7).selectExpr("cast(id as string) jobid", "cast((id + 6) % 7 as string) jparent_jobid")
    below = integrity.job_descendants(ring, ring.filter("jobid in ('0', '3')"))
    got = sorted((r.ancestor, r.jobid, r.depth) for r in below.collect())
    assert got == sorted((a, str((int(a) + d) % 7), d) for a in "03" for d in range(1, 7))
