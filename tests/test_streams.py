"""Streams give what the batch operators give, also after a restart."""

import random
import time
from datetime import timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from relayframe.operators import changes, reassembly, transitions
from relayframe.sources import files as file_io
from relayframe.sources import state as store
from relayframe.sources import wire
from relayframe.streaming import collecting, streams
from tests import samples as S
from tests.test_transfer import content, receive, send

FRAMES = "frame_key string, fd int, jobdata binary, arrived_at timestamp"


def write_frames(spark, path, frames, n_files, seed=0):
    """Frames in random order over several files, one second apart."""
    order = list(enumerate(frames))
    random.Random(seed).shuffle(order)
    step = -(-len(order) // n_files)
    for n in range(n_files):
        rows = [(f"{seed}-{i}", 4, bytearray(f), S.AT + timedelta(seconds=n))
                for i, f in order[n * step:(n + 1) * step]]
        spark.createDataFrame(rows, FRAMES).coalesce(1).write.mode("append").parquet(path)


def frame_stream(spark, path):
    return spark.readStream.schema(FRAMES).option("maxFilesPerTrigger", 1).parquet(path)


def test_ingest_stream_equals_batch(spark, folder):
    _, (singles, chunks, manifests) = send(spark, {"a": content(900), "b": b"x"}, 300)
    bad = b"0" * 32 + chunks[0][32:]
    write_frames(spark, f"{folder}/in", [*singles, *chunks, *manifests, bad], 3)
    jobs = streams.ingest_stream(frame_stream(spark, f"{folder}/in"), S.NODE, S.AT)
    streams.start(jobs, streams.batch_sink(f"{folder}/out"), f"{folder}/cp").awaitTermination()
    batch = transitions.advance_inbound(
        wire.ingest_frames(spark.read.parquet(f"{folder}/in"), S.NODE, S.AT), S.NODE)
    assert S.states(spark.read.parquet(f"{folder}/out")) == S.states(batch)
    assert sorted(S.states(batch).values()).count("D") == 1


def test_reassembly_stream_equals_batch_over_a_restart(spark, folder):
    contents = {f"f{i}": content(400 + 300 * i, i) for i in range(6)}
    _, (_, chunks, manifests) = send(spark, contents, 300)
    lost = next(c for c in chunks if c[122:158] == manifests[0][114:150])
    frames = [c for c in chunks if c != lost] * 2 + manifests + manifests[:2]

    def run():
        streams.reassembly_stream(frame_stream(spark, f"{folder}/in"), f"{folder}/out",
                                  f"{folder}/cp", part_bytes=512).awaitTermination()

    half = len(frames) // 2
    write_frames(spark, f"{folder}/in", frames[:half], 2, seed=1)
    run()
    write_frames(spark, f"{folder}/in", frames[half:], 3, seed=2)
    run()

    def parts(df):
        return sorted((r.message_id, r.part_no, bytes(r.content)) for r in df.collect())

    batch = reassembly.reassemble(receive(spark, frames), 512)
    assert parts(spark.read.parquet(f"{folder}/out/messages")) == parts(batch)
    finished = spark.read.parquet(f"{folder}/out/finished").collect()
    assert [r.status for r in finished] == ["complete"] * 5
    assert len({r.message_id for r in finished}) == 5

    # A copy that comes late does not start a finished message again, and the message
    # that misses a chunk is reported when its time is over.
    late = [(f"late-{i}", 4, bytearray(c), S.AT + timedelta(days=d))
            for d in (0, 3) for i, c in enumerate(chunks[-1:])]
    for row in late:
        spark.createDataFrame([row], FRAMES).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        run()
    finished = spark.read.parquet(f"{folder}/out/finished").collect()
    assert sorted(r.status for r in finished) == ["complete"] * 5 + ["incomplete"]
    gone = next(r for r in finished if r.status == "incomplete")
    assert gone.message_id.encode() == manifests[0][114:150]
    assert gone.n_arrived == gone.chunk_count - 1
    assert parts(spark.read.parquet(f"{folder}/out/messages")) == parts(batch)


def test_a_lost_clock_is_an_error(spark, folder):
    rows = spark.createDataFrame([("m", 0, 1, 0, bytearray(b"x"), None, S.AT)],
                                 "message_id string, chunk_index long, room long, byte_offset long, payload binary, "
                                 "chunk_count long, arrived_at timestamp")
    with pytest.raises(AnalysisException):
        collecting.store_batch(folder)(rows, 1)
    collecting.store_batch(folder)(rows, 0)
    collecting.store_batch(folder)(rows.withColumn("arrived_at", F.lit(None).cast("timestamp")), 1)
    clocks = spark.read.parquet(f"{folder}/seen/*").select("batch_no", "clock").collect()
    assert {tuple(r) for r in clocks} == {(0, S.AT), (1, S.AT)}


def test_ranges_are_the_union(spark):
    rng = random.Random(4)
    cases = [[(s, s + rng.randint(1, 6)) for s in (rng.randrange(40) for _ in range(rng.randrange(9)))] for _ in range(200)]
    rows = spark.createDataFrame([([s for s, _ in c], [e for _, e in c]) for c in cases], "s array<long>, e array<long>")
    starts, ends = collecting.merged_ranges(F.col("s"), F.col("e"))
    for case, r in zip(cases, rows.select(starts.alias("a"), ends.alias("b")).collect(), strict=True):
        covered = {i for s, e in case for i in range(s, e)}
        edges = [i for i in sorted(covered) if i - 1 not in covered], [i + 1 for i in sorted(covered) if i + 1 not in covered]
        assert (r.a, r.b) == edges
        assert collecting._union(case) == list(zip(*edges, strict=True))


def test_a_finished_message_reads_its_own_buckets_only(spark, folder, monkeypatch):
    """One message begins, many others pass, then its last chunk comes: only its two batches are read."""
    _, (_, chunks, manifests) = send(spark, {f"f{i}": content(700, i) for i in range(4)}, 300)
    slow = manifests[0][114:150]
    mine = [c for c in chunks if c[122:158] == slow]
    reads, inner = [], collecting._payloads

    def watched(spark, root, places):
        reads.append(set(places))
        return inner(spark, root, places)

    monkeypatch.setattr(collecting, "_payloads", watched)
    steps = [[manifests[0], *mine[:-1]]]
    for m in manifests[1:]:
        steps.append([m, *[c for c in chunks if c[122:158] == m[114:150]]])

    def run():
        streams.reassembly_stream(frame_stream(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/cp").awaitTermination()

    for n, frames in enumerate(steps):
        write_frames(spark, f"{folder}/in", frames, 1, seed=n)
    run()
    write_frames(spark, f"{folder}/in", mine[-1:], 1, seed=9)
    run()
    others, own = reads
    assert sorted(number for number, _ in others) == [1, 2, 3]
    assert sorted(number for number, _ in own) == [0, 4] and len({b for _, b in own}) == 1
    assert spark.read.parquet(f"{folder}/out/messages").count() == 4


def test_tick_stream_skips_a_committed_batch(spark, folder):
    root, now = f"{folder}/state", lambda: S.AT
    store.save_state(store.seed_node(spark, S.NODE, S.AT), root, 0)
    frames = [S.frame(f"{i:036d}", "4", f"P{i}", "M3", 5, 147,
                      f"{512 * (i + 1):>11}       7001{1000 + i:>11}".encode()) for i in range(4)]
    write_frames(spark, f"{folder}/in", frames, 2)
    query = streams.tick_stream(frame_stream(spark, f"{folder}/in"), root, f"{folder}/cp", now,
                                every=None)
    query.awaitTermination()
    done = store.load_state(spark, root)
    assert done.version == 2 and store.last_batch(spark, root) == f"{folder}/cp#1"
    assert {r.system_name: r.system_capacity for r in done.peers.collect()} == {
        f"   P{i}": 512 * (i + 1) for i in range(4)}
    kinds = {r.jstate: r["count"] for r in done.jobs.groupBy("jstate").count().collect()}
    assert kinds == {"N-0": 1, "C": 4, "S-5": 4}

    # The last batch runs again when only its checkpoint entry is lost.
    copy = spark.read.schema(FRAMES).parquet(f"{folder}/in")
    assert copy.count() == 4
    sink = []
    streams_start = streams.start
    try:
        streams.start = lambda stream, write, checkpoint, **kw: sink.append(write)
        streams.tick_stream(copy, root, f"{folder}/cp", now)
    finally:
        streams.start = streams_start
    sink[0](copy, 1)
    assert store.load_state(spark, root).version == 2


def handshakes(n):
    return [S.frame(f"{i:036d}", "4", f"P{i}", "M3", 5, 147,
                    f"{512 * (i + 1):>11}       7001{1000 + i:>11}".encode()) for i in range(n)]


def test_change_feed_hears_every_tick_once_over_a_restart(spark, folder):
    root = f"{folder}/state"
    store.save_state(store.seed_node(spark, S.NODE, S.AT), root, 0)
    heard = []
    for step in range(2):
        # The same peer with the same capacity again: an event although nothing changes.
        write_frames(spark, f"{folder}/in", handshakes(2), 1, seed=step)
        streams.tick_stream(frame_stream(spark, f"{folder}/in"), root, f"{folder}/cp", lambda: S.AT,
                            every=None).awaitTermination()
        streams.change_feed(spark, root, streams.batch_sink(f"{folder}/feed"), f"{folder}/feed-cp").awaitTermination()
        heard.append(spark.read.parquet(f"{folder}/feed").count())
    feed = spark.read.parquet(f"{folder}/feed")
    rows = sorted((r.version, r.channel, r.op) for r in feed.collect())
    assert [r for r in rows if r[1] == "receiver"] == [(v, "receiver", "insert") for v in (1, 1, 2, 2)]
    assert [r for r in rows if r[1] == "handshake"] == [(v, "handshake", "insert") for v in (1, 1, 2, 2)]
    assert feed.select("channel", "key").distinct().count() == len(rows) and heard[0] < heard[1] == len(rows)
    done = store.load_state(spark, root)
    ids = {r.jobid for r in done.jobs.filter("jstate = 'S-5'").collect()}
    assert {r.key for r in feed.filter("channel = 'handshake'").collect()} == ids
    # Rows that versions keep of jobs: all that arrived moved, all replies are new.
    writes = spark.read.parquet(f"{root}/writes/v*").filter("table_name = 'jobs'")
    assert {(r.op, r.state): r["count"] for r in writes.groupBy("op", "state").count().collect()} == {
        ("insert", "S-5"): 4, ("update", "C"): 4}
    streams.change_feed(spark, root, streams.batch_sink(f"{folder}/feed"), f"{folder}/feed-cp").awaitTermination()
    assert spark.read.parquet(f"{folder}/feed").count() == len(rows)


def test_job_writes_know_inserts_updates_and_rows_left_alone(spark):
    before = spark.createDataFrame([("a", "N-1"), ("b", "S-2W")], "jobid string, jstate string")
    after = spark.createDataFrame([("a", "N-4"), ("b", "S-2W"), ("c", "S-4")], "jobid string, jstate string")
    assert {tuple(r) for r in changes.job_writes(before, after).collect()} == {
        ("a", "N-4", "update"), ("c", "S-4", "insert")}


def test_ticks_go_on_without_frames_and_after_a_failure(spark, folder, monkeypatch):
    """A send job is planned although no frame arrives; the first tick fails, runs again and commits once."""
    state = store.seed_node(spark, S.NODE, S.AT).with_tables(
        files=S.files(spark, {"a": content(500)}), peers=S.peers(spark, [("M2", 1, 7001, 300)]))
    job = S.jobs(spark, [{"jobid": "j", "jobdata": b"a", "jstate": "S"}])
    root = f"{folder}/state"
    store.save_state(state.with_new_jobs(job), root, 0)
    spark.createDataFrame([], FRAMES).write.parquet(f"{folder}/in")
    calls, waits, commit = [], [], streams.commit_tick

    def failing(state, root, now, name):
        calls.append(name)
        if len(calls) == 1:
            raise RuntimeError("injected")
        return commit(state, root, now, name)

    monkeypatch.setattr(streams, "commit_tick", failing)

    def begin():
        query = streams.tick_stream(frame_stream(spark, f"{folder}/in"), root, f"{folder}/cp", lambda: S.AT,
                                    every="200 milliseconds")
        if calls:
            deadline = time.time() + 120
            while store.load_state(spark, root).version < 1 and time.time() < deadline:
                time.sleep(0.2)
            query.stop()
        return query

    assert streams.supervise(begin, pause=waits.append) == 1 and waits == [streams.RETRY_SECONDS]
    done = store.load_state(spark, root)
    assert calls[0] == calls[1] and len(set(calls)) == len(calls) - 1 and done.version >= 1
    assert S.states(done.jobs)["j"] == "S-2W"
    chunks = done.jobs.filter("jstate = 'S-4'")
    assert chunks.count() == 4 + 1 and chunks.select("jobid").distinct().count() == 5


MOVES = "jobid string, jstate string, changed_at timestamp, change_no long"


def add_moves(spark, path, rows):
    spark.createDataFrame([(j, s, None if t is None else S.AT + timedelta(seconds=t), n) for j, s, t, n in rows],
                          MOVES).coalesce(1).write.mode("append").parquet(path)


def run_lifecycle(spark, folder, **options):
    moves = spark.readStream.schema(MOVES).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
    streams.start(streams.lifecycle_stream(moves, **options), streams.batch_sink(f"{folder}/out"),
                  f"{folder}/cp", mode="update").awaitTermination()
    latest = streams.read_latest(spark, f"{folder}/out", ["jobid"])
    return {(r.jobid, r.jstate, r.n_changes, r.n_rejected) for r in latest.collect()}


def test_lifecycle_stream_keeps_the_last_state_and_rejects_illegal_moves(spark, folder):
    add_moves(spark, f"{folder}/in", [
        ("a", "N-1", 0, 1), ("b", "S", 0, 2), ("a", "N-4", 1, 3), ("a", "C", 2, 4), ("b", "D", 1, 5), ("a", "N-1", 3, 6),
        ("c", "S-4", None, None), ("c", "S-4W", 9, None), ("c", "S-4", 10, 1), (None, "S", 0, 1), ("d", None, 0, 1),
        ("e", "S-4W", 5, 2), ("e", "S-4", 5, 1), ("f", "C  ", 1, 1), ("f", "C", 1, 1)])
    want = {("a", "C", 3, 1), ("b", "S", 1, 1), ("c", "S-4W", 2, 1), ("e", "S-4W", 2, 0), ("f", "C", 2, 0)}
    assert run_lifecycle(spark, folder) == want
    # From the checkpoint on: the state of jobs is known, those not named keep theirs.
    add_moves(spark, f"{folder}/in", [("b", "S-2W", 4, 9), ("a", "D", 9, 9)])
    want = want - {("a", "C", 3, 1), ("b", "S", 1, 1)} | {("a", "C", 3, 2), ("b", "S-2W", 2, 1)}
    assert run_lifecycle(spark, folder) == want


def test_lifecycle_state_of_finished_jobs_falls_after_its_time(spark, folder):
    add_moves(spark, f"{folder}/in", [(f"x{i}", "C" if i % 2 else "S-4", 0, 1) for i in range(20)])
    assert len(run_lifecycle(spark, folder, keep_done="2 seconds")) == 20

    def held():
        return spark.read.format("statestore").load(f"{folder}/cp").count()

    assert held() == 20
    time.sleep(3)
    add_moves(spark, f"{folder}/in", [("x0", "C", 1, 2)])
    # x0 was not done and goes on; the ten that were are forgotten, so x1 starts anew.
    assert ("x0", "C", 2, 0) in run_lifecycle(spark, folder, keep_done="2 seconds")
    assert held() == 10
    add_moves(spark, f"{folder}/in", [("x1", "S", 1, 2)])
    assert ("x1", "S", 1, 0) in run_lifecycle(spark, folder, keep_done="2 seconds")


def test_delivery_rate_counts_every_window(spark, folder):
    rows = [(S.AT + timedelta(minutes=20 * i), i % 3) for i in range(12)]
    spark.createDataFrame(rows, "ack_time timestamp, status int").write.parquet(f"{folder}/in")
    acks = spark.readStream.schema("ack_time timestamp, status int").parquet(f"{folder}/in")
    streams.start(streams.delivery_rate(acks), streams.batch_sink(f"{folder}/out"),
                  f"{folder}/cp", mode="update").awaitTermination()
    latest = streams.read_latest(spark, f"{folder}/out", ["window_start", "outcome"])
    assert latest.agg(F.sum("n_acks")).first()[0] == 12
    assert {r.outcome: r["sum(n_acks)"] for r in
            latest.groupBy("outcome").agg(F.sum("n_acks")).collect()} == {"C": 8, "D": 4}


def test_closed_windows_and_late_rows_add_up_to_all(spark, folder):
    schema = "ack_time timestamp, status int, extra string"
    rng, sent = random.Random(2), []

    def add(minutes):
        rows = [(None if m is None else S.AT + timedelta(minutes=m), rng.randint(0, 1), "e") for m in minutes]
        sent.extend(rows)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def run():
        acks = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        streams.delivery_rate_stream(acks, f"{folder}/out", f"{folder}/cp").awaitTermination()
        closed = spark.read.parquet(f"{folder}/out/rate").collect()
        late = spark.read.parquet(f"{folder}/out/late").collect()
        keys = [(r.window_start, r.outcome) for r in closed]
        assert len(keys) == len(set(keys))  # each window is given once
        return sum(r.n_acks for r in closed), len(late)

    add([rng.randrange(300) for _ in range(50)])
    add([rng.randrange(600) for _ in range(50)] + [None, 600])
    run()
    add([0, 5, 590])  # from the checkpoint on, two are late
    add([10_000])
    closed, late = run()
    newest = max(r[0] for r in sent[:50])
    ends = [r[0].replace(minute=0, second=0, microsecond=0) + timedelta(hours=1) for r in sent[50:100]]
    assert late == 1 + 2 + sum(e <= newest - timedelta(hours=1) for e in ends)
    assert closed + late == len(sent) - 1  # the window of the last one is open


def test_files_in_and_out(spark, folder, tmp_path):
    contents = {"a.bin": bytes(range(256)), "b.txt": "grüße".encode(), "c.txt": b"x"}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    batch = file_io.import_files(spark, str(tmp_path), S.AT)
    got = {r.file_name: (bytes(r.content), r.n_bytes) for r in batch.collect()}
    assert got == {f"{tmp_path}/{n}": (d, len(d)) for n, d in contents.items()}
    known = batch.filter(F.col("file_name").endswith("a.bin"))
    assert file_io.import_files(spark, str(tmp_path), S.AT, existing=known).count() == 2
    stream = file_io.import_files_stream(spark, str(tmp_path), S.AT)
    streams.start(stream, streams.batch_sink(f"{folder}/files"), f"{folder}/cp").awaitTermination()
    again = spark.read.parquet(f"{folder}/files")
    assert {r.file_id for r in again.collect()} == {r.file_id for r in batch.collect()}


def test_messages_become_files_and_come_back(spark, folder, tmp_path):
    """Send, receive, export, import and store: equal bytes, also when a message lies in many parts."""
    sent = {f"f{i}": content(n, i) for i, n in enumerate([130, 500, 3000, 9000])}
    _, (_, chunks, manifests) = send(spark, sent, 300)
    parts = reassembly.reassemble(receive(spark, chunks + manifests + chunks[:5]), 512)
    want = {f"{n:>36}".replace(" ", "0"): d for n, d in sent.items()}

    written = file_io.write_files(parts, f"{tmp_path}/out")
    got = {r.message_id: (r.file_path, r.n_bytes) for r in written.collect()}
    assert {m: open(p, "rb").read() for m, (p, _) in got.items()} == want
    assert all(n == len(want[m]) for m, (_, n) in got.items())
    back = file_io.import_files(spark, f"{tmp_path}/out/*", S.AT)
    assert {bytes(r.content) for r in back.collect()} == set(want.values())
    with pytest.raises(FileExistsError):
        file_io.write_files(parts, f"{tmp_path}/out")

    stored, rejected = file_io.received_files(parts, S.AT, max_bytes=5000)
    assert {r.file_name: (bytes(r.content), r.n_bytes) for r in stored.collect()} == {
        f"received/{m}": (d, len(d)) for m, d in want.items() if len(d) <= 5000}
    assert [r.total_bytes for r in rejected.collect()] == [9000]
    known = stored.filter(F.col("n_bytes") == 500)
    again, _ = file_io.received_files(parts, S.AT, existing=known)
    assert sorted(r.n_bytes for r in again.collect()) == [130, 3000, 9000]
    requests = spark.createDataFrame([(str(i), f"received/{m}", "M2") for i, m in enumerate(want)],
                                     "request_id string, file_name string, destination string")
    jobs, refused = wire.create_send_jobs(requests, stored, S.NODE, S.AT)
    assert jobs.count() == 3 and refused.count() == 1


PARTS = "message_id string, part_no long, n_parts long, byte_offset long, total_bytes long, content binary"


def test_a_failed_export_leaves_nothing_and_names_stay_inside(spark, tmp_path):
    rows = [("../../x", 0, 2, 0, 6, b"abc"), ("../../x", 1, 2, 3, 6, b"def"), (".", 0, 1, 0, 0, b""),
            (None, 0, 1, 0, 2, b"no"), ("a/b", 0, 1, 0, 1, b"1"), ("A/B", 0, 1, 0, 1, b"2")]
    parts = spark.createDataFrame([(*r[:5], bytearray(r[5])) for r in rows], PARTS)
    with pytest.raises(ValueError, match="not whole"):
        file_io.write_files(parts.filter("part_no = 0"), f"{tmp_path}/out")
    torn = parts.withColumn("content", F.when(F.col("message_id") == "a/b", F.raise_error(F.lit("lost")).cast("binary"))
                            .otherwise(F.col("content")))
    with pytest.raises(Exception, match="lost"):
        file_io.write_files(torn, f"{tmp_path}/out")
    assert list(tmp_path.iterdir()) == []
    written = file_io.write_files(parts.unionByName(parts).repartition(3), f"{tmp_path}/out")
    found = {r.message_id: open(r.file_path, "rb").read() for r in written.collect()}
    assert found == {"../../x": b"abcdef", ".": b"", None: b"no", "a/b": b"1", "A/B": b"2"}
    assert all(str(tmp_path) in r.file_path for r in written.collect()) and len(list(tmp_path.iterdir())) == 1
    file_io.write_files(parts.limit(0), f"{tmp_path}/none")
    assert list((tmp_path / "none").iterdir()) == []


def test_fixed_size_frames_are_read_in_splits(spark, tmp_path):
    frames = [bytes([i]) * 147 for i in range(10)]
    (tmp_path / "wire").write_bytes(b"".join(frames))
    got = wire.read_frames(spark, str(tmp_path / "wire"), 147)
    assert sorted(bytes(r.jobdata) for r in got.collect()) == frames


def test_byte_streams_are_cut_by_the_size_of_their_peer(spark, tmp_path):
    """Three sizes, files that end within a frame, an empty file, a peer without a size; many ranges and steps."""
    sizes = {1: 10, 2: 147, 3: 1000, 4: 0}
    data = {(ip, n): content(n, ip * 100_000 + n) for ip in (1, 2, 3, 4, 5) for n in (0, 9, 147, 1000, 5003)}
    for (ip, n), sent in data.items():
        (tmp_path / f"{ip}-{n}").write_bytes(sent)
    found = wire.stored_streams(spark, str(tmp_path)).withColumn(
        "ipaddress", F.regexp_extract("path", "/([0-9]+)-[0-9]+$", 1).cast("long"))
    agreed = spark.createDataFrame(list(sizes.items()), "ipaddress long, frame_size int")
    want = {}
    for (ip, n), sent in data.items():
        if sizes.get(ip):
            for no in range(-(-n // sizes[ip])):
                piece = sent[no * sizes[ip]:(no + 1) * sizes[ip]]
                want[f"{ip}-{n}", ip, no] = piece, len(piece) == sizes[ip]
    for range_bytes in (wire.RANGE_BYTES, 700):
        rows = wire.split_streams(found, agreed, range_bytes).collect()
        got = {(r.path.rsplit("/", 1)[1], r.ipaddress, r.frame_no): (bytes(r.jobdata), r.complete) for r in rows}
        assert got == want and len(rows) == len(want)
    plan = wire._frame_ranges(found.withColumn("frame_size", F.lit(147)), 700)
    ranges = plan.filter("path LIKE '%/2-5003'").collect()
    assert sorted((r.first_frame, r.n_bytes) for r in ranges) == [
        (4 * i, min(588, 5003 - 588 * i)) for i in range(9)]


def test_logs_are_kept_by_day(spark, folder):
    rows = spark.createDataFrame([("x", S.AT), ("y" * 3000, S.AT + timedelta(days=1))],
                                 "t string, at timestamp")
    wire.append_logs(wire.as_logs(rows, wire.log_text("n ", 1, " ", F.col("t")), F.col("at")), folder)
    wire.append_logs(wire.as_logs(rows, F.col("t"), F.col("at")), folder)
    logs = spark.read.parquet(folder)
    assert logs.count() == 4 and logs.select("day").distinct().count() == 2
    assert logs.agg(F.max(F.length("log"))).first()[0] == 3004
