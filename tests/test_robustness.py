"""Inputs that must not be lost, merged or allowed to stop the rest."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from relayframe import session
from relayframe.functions import frames as X
from relayframe.operators import changes, framing, negotiate, queues, reassembly, transitions
from relayframe.sources import files as file_io
from relayframe.sources import fixtures as fx
from relayframe.sources import wire
from relayframe.streaming import streams
from tests import samples as S

UID = "{:036d}"


def chunk(index, length, parent=1, payload=b"abc", capacity=178):
    sub = str(index).rjust(8).encode() + UID.format(parent).encode() + str(length).rjust(10).encode()
    return S.frame(UID.format(parent), "2", "M2", "M3", 5, capacity, sub, payload)


def manifest(total, count, parent=1, capacity=178):
    sub = UID.format(parent).encode() + str(total).rjust(12).encode() + str(count).rjust(10).encode()
    return S.frame(UID.format(parent), "3", "M2", "M3", 5, capacity, sub)


def handshake(capacity, port, ip, name="M2"):
    sub = b"".join(str(x).rjust(11).encode() for x in (capacity, port, ip))
    return S.frame(UID.format(9), "4", name, "M3", 5, 147, sub)


def classified(spark, raw):
    rows = [{"jobid": f"r{i}", "jobdata": data, "jstate": "N-4", "jtype": data[68:73].decode()}
            for i, data in enumerate(raw)]
    return S.jobs(spark, rows)


@pytest.mark.parametrize("as_folder", [False, True])
def test_streams_read_a_table_as_file_or_folder(spark, folder, as_folder, tmp_path):
    rows = spark.createDataFrame([(i, S.AT + timedelta(hours=i)) for i in range(9)], "event_id long, ts timestamp")
    rows.repartition(3 if as_folder else 1).write.parquet(str(tmp_path / "events.parquet"))
    if not as_folder:
        part, = (tmp_path / "events.parquet").glob("part-*.parquet")
        part.rename(tmp_path / "x")
        moved = tmp_path / "one"
        moved.mkdir()
        (tmp_path / "x").rename(moved / "events.parquet")
        tmp_path = moved
    streams.start(fx.stream(spark, str(tmp_path), "events"), streams.batch_sink(f"{folder}/out"),
                  f"{folder}/cp").awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 9


def test_empty_files_are_imported(spark, tmp_path):
    names = {"full.txt": b"x", "empty.txt": b"", "a b+c%20.txt": b"", "é +.txt": b"y"}
    for name, data in names.items():
        (tmp_path / name).write_bytes(data)
    got = {r.file_name: (bytes(r.content), r.n_bytes) for r in file_io.import_files(spark, str(tmp_path), S.AT).collect()}
    assert got == {f"{tmp_path}/{n}": (d, len(d)) for n, d in names.items()}


def test_long_names_are_not_merged(spark):
    rows = spark.createDataFrame([("S1000",), ("S10000",), (" S1 ",)], "n string")
    assert [r[0] for r in rows.select(X.norm_name(F.col("n"))).collect()] == ["S1000", "S10000", "   S1"]
    requests = spark.createDataFrame([("1", "f", "S1000"), ("2", "f", "S10000")],
                                     "request_id string, file_name string, destination string")
    jobs, rejected = wire.create_send_jobs(requests, S.files(spark, {"f": b"x"}), S.NODE, S.AT)
    assert [r.jdestination for r in jobs.collect()] == ["S1000"]
    assert [(r.request_id, r.reason) for r in rejected.collect()] == [("2", "name too long for the wire")]
    peers = S.peers(spark, [("S1000", 1, 1, 300), ("S10000", 2, 1, 400)])
    assert [r.jdestination for r in framing.addressable(peers).collect()] == ["S1000"]


@pytest.mark.parametrize("bad", [chunk("x", 3), chunk(-1, 3), chunk(1, 9999999999), chunk(1, -1), chunk(1, 7)])
def test_a_bad_chunk_completes_nothing_and_harms_nobody(spark, bad):
    good = [chunk(i, 3, 2) for i in range(2)] + [manifest(6, 2, 2)]
    jobs = classified(spark, [chunk(0, 3), bad, chunk(2, 3), manifest(9, 3), *good])
    for mode in ("rows", "distinct"):
        assert [r.message_id for r in reassembly.incoming_complete(jobs, mode).collect()] == [UID.format(2)]
    assert {(r.message_id, r.missing_index) for r in reassembly.missing_chunks(jobs).collect()} == {(UID.format(1), 1)}
    parts = reassembly.reassemble(jobs).collect()
    assert [bytes(r.content) for r in parts] == [b"abcabc"]
    reasons = {r.jobid: r.reason for r in transitions.dead_letter_report(jobs).collect()}
    assert reasons == {"r1": "malformed"}
    arrived = jobs.withColumn("jstate", F.lit("N-1"))
    for moved in (transitions.advance_inbound(arrived, S.NODE.__class__("   M3", *list(vars(S.NODE).values())[1:])),):
        assert S.states(moved)["r1"] == "D" and S.states(moved)["r0"] == "N-4"


def test_lengths_must_add_up(spark):
    jobs = classified(spark, [chunk(0, 3), chunk(1, 2), manifest(6, 2)])
    assert reassembly.incoming_complete(jobs, "distinct").count() == 0


@pytest.mark.parametrize("bad", [manifest(-5, 1), manifest("x", 1), manifest(3, 9999999999)])
def test_a_bad_manifest_is_dead(spark, bad):
    jobs = classified(spark, [chunk(0, 3), bad])
    assert reassembly.missing_chunks(jobs).count() == 0
    assert [r.reason for r in transitions.dead_letter_report(jobs).collect()] == ["malformed"]


def test_a_handshake_out_of_range_leaves_the_others(spark):
    jobs = classified(spark, [handshake(300, 99999999999, 1), handshake(99999999999, 1, 1), handshake(300, 7001, 5)])
    asked = negotiate.handshakes(jobs, "4")
    peers = negotiate.upsert_peers(S.peers(spark, []), negotiate.peer_writes(asked, S.NODE)).collect()
    assert [(r.ipaddress, r.dataport, r.system_capacity) for r in peers] == [(5, 7001, 300)]
    assert sorted(S.states(transitions.finish_handshake(jobs, "4")).values()) == ["C", "D", "D"]


def test_a_moved_value_is_an_update(spark):
    schema = "k int, a string, b string"
    before, after = spark.createDataFrame([(1, "v", None)], schema), spark.createDataFrame([(1, None, "v")], schema)
    assert [(r.k, r.op) for r in changes.snapshot_diff(before, after, ["k"]).collect()] == [(1, "update")]
    assert changes.snapshot_diff(after, after, ["k"]).count() == 0


def test_a_message_takes_one_route(spark):
    peers = S.peers(spark, [("M2", 1, 7001, 300), ("M2", 2, 7001, 300)])
    conns = spark.createDataFrame([(10, 1, 2, S.AT), (20, 2, 2, S.AT)], "sfd int, sipaddr long, scstatus int, sctime timestamp")
    jobs = S.jobs(spark, [{"jobid": "a", "jstate": "S-4"}, {"jobid": "b", "jstate": "S-5"}])
    assert [(r.jobid, r.ipaddress, r.sfd) for r in queues.pending_with_conn(jobs, peers, conns).collect()] == [("a", 1, 10)]
    assert [r.jobid for r in queues.pending_handshake(jobs, peers).collect()] == ["b"]


def test_equal_log_lines_have_two_identifiers(spark):
    rows = spark.createDataFrame([(1, S.AT), (2, S.AT)], "n int, at timestamp")
    logs = wire.as_logs(rows, F.lit("same"), F.col("at"), key=("n",))
    assert logs.select("logid").distinct().count() == 2


def test_late_acknowledgements_count(spark, folder):
    schema = "ack_time timestamp, status int"
    for i, hours in enumerate((0, 50, 1)):
        spark.createDataFrame([(S.AT + timedelta(hours=hours), 1)], schema).coalesce(1).write.parquet(f"{folder}/in/{i}")
    acks = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
            .parquet(f"{folder}/in"))
    streams.start(streams.delivery_rate(acks), streams.batch_sink(f"{folder}/out"), f"{folder}/cp", mode="update").awaitTermination()
    latest = streams.read_latest(spark, f"{folder}/out", ["window_start", "outcome"])
    assert latest.agg(F.sum("n_acks")).first()[0] == 3


def test_a_cluster_must_name_a_shared_folder():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Session:
        sparkContext = Context()  # noqa: N815
        conf = {}

    with pytest.raises(ValueError, match="share"):
        session.work_root(Session())


def test_every_supplier_has_a_handshake(spark):
    keys = [0, 9, 9_999, 10_000, 10_001, 100_000, 999_999, 1_223_055, 1_223_056, 12_980_000]
    suppliers = spark.createDataFrame([(k,) for k in keys], "s_suppkey long")
    frames = fx.handshake_frames(suppliers, "4").collect()
    assert len(frames) == len(keys) and {len(r.jobdata) for r in frames} == {147}
    names = [r[0] for r in suppliers.select(fx.supplier_name()).collect()]
    assert names[:3] == ["   S0", "   S9", "S9999"] and names[3:5] == ["SA000", "SA001"] and names[7:9] == ["SZZZZ", "T0000"]
    assert len(set(names)) == len(keys) and all(len(n) == 5 for n in names)
    assert all(any(n.encode() in bytes(r.jobdata) for r in frames) for n in names)
    rows = spark.range(9_000, 12_000).withColumnRenamed("id", "s_suppkey")
    assert rows.select(fx.supplier_name()).distinct().count() == fx.handshake_frames(rows, "5").count() == 3_000
    with pytest.raises(Exception, match="no five-byte name"):
        spark.createDataFrame([(99_999_999,)], "s_suppkey long").select(fx.supplier_name()).collect()
