"""Files to frames and back."""

import random

import pytest

from relayframe.operators import framing, reassembly, transitions
from tests import samples as S


def receive(spark, frames):
    """Raw frames as classified jobs; every copy keeps its own row."""
    rows = [{"jobid": f"r{i}", "jobdata": data, "jstate": "N-4",
             "jtype": data[68:73].decode(), "jsource": "9", "jdestination": "0"}
            for i, data in enumerate(frames)]
    return S.jobs(spark, rows)


def send(spark, contents, capacity):
    """Frames of all files as one list per job."""
    jobs = S.jobs(spark, [{"jobid": f"{name:>36}".replace(" ", "0"), "jobdata": name.encode(),
                           "jstate": "S-1"} for name in contents])
    files, peers = S.files(spark, contents), S.peers(spark, [("M2", 1, 7001, capacity)])
    planned = transitions.plan_sends(jobs, files, peers)
    parts = [make(planned, files, peers, S.AT) for make in
             (framing.encode_single, framing.chunk_payloads, framing.encode_manifest)]
    return S.states(planned), [[bytes(r.jobdata) for r in part.collect()] for part in parts]


def content(n, seed=0):
    return random.Random(seed).randbytes(n)


@pytest.mark.parametrize("capacity", [173, 300, 1024])
def test_lengths_around_the_limits(spark, capacity):
    room = capacity - 172
    sizes = sorted({0, 1, room - 1, room, room + 1, 2 * room, 2 * room + 1, 7 * room - 1} - {-1})
    contents = {f"f{n}": content(n, n) for n in sizes if n <= 2000}
    states, (singles, chunks, manifests) = send(spark, contents, capacity)
    for name, data in contents.items():
        assert states[f"{name:>36}".replace(" ", "0")] == ("S-2" if len(data) > room else "S-3")
    large = {n: d for n, d in contents.items() if len(d) > room}
    assert len(chunks) == sum(-(-len(d) // room) for d in large.values())
    assert {len(f) for f in chunks} <= {capacity} and len(manifests) == len(large)
    assert len(singles) == len(contents) - len(large)

    arrived = chunks + manifests
    random.Random(1).shuffle(arrived)
    jobs = receive(spark, arrived + arrived[: len(arrived) // 2])
    for part_bytes in (reassembly.PART_BYTES, 3 * room):
        parts = reassembly.reassemble(jobs, part_bytes).collect()
        rebuilt = {}
        for r in sorted(parts, key=lambda r: r.part_no):
            assert r.byte_offset == len(rebuilt.get(r.message_id, b""))
            rebuilt[r.message_id] = rebuilt.get(r.message_id, b"") + bytes(r.content)
        assert rebuilt == {f"{n:>36}".replace(" ", "0"): d for n, d in large.items()}
    ordered = reassembly.reassemble_ordered(jobs).collect()
    for name, data in large.items():
        mine = [r for r in ordered if r.message_id == f"{name:>36}".replace(" ", "0")]
        assert [r.chunk_index for r in mine] == list(range(len(mine)))
        assert b"".join(bytes(r.payload) for r in mine) == data


def test_capacity_without_room_for_payload_plans_nothing(spark):
    states, frames = send(spark, {"a": b"x"}, 172)
    assert set(states.values()) == {"S-1"} and frames == [[], [], []]


def test_every_byte_value_survives(spark):
    data = bytes(range(256)) * 5
    _, (_, chunks, manifests) = send(spark, {"all": data}, 300)
    row = reassembly.reassemble(receive(spark, chunks + manifests)).first()
    assert bytes(row.content) == data and row.total_bytes == len(data)


def test_missing_and_duplicate_chunks(spark):
    _, (_, chunks, manifests) = send(spark, {"a": content(1000)}, 300)
    chunks.sort(key=lambda f: f[114:122])
    incomplete = receive(spark, chunks[:3] + chunks[4:] + [chunks[0]] + manifests)
    assert reassembly.incoming_complete(incomplete, "rows").count() == 1
    assert reassembly.incoming_complete(incomplete, "distinct").count() == 0
    assert reassembly.reassemble(incomplete).count() == 0
    missing = reassembly.missing_chunks(incomplete).collect()
    assert [r.missing_index for r in missing] == [3]
    complete = receive(spark, chunks + chunks[:2] + manifests * 2)
    assert reassembly.incoming_complete(complete, "rows").count() == 0
    assert reassembly.incoming_complete(complete, "distinct").count() == 1
    assert bytes(reassembly.reassemble(complete).first().content) == content(1000)
    done = S.states(reassembly.finish_incoming(complete, "distinct"))
    assert set(done.values()) == {"C"}


def test_missing_chunks_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(reassembly, "GAP_BLOCK", 3)
    _, (_, chunks, manifests) = send(spark, {"a": content(1500)}, 300)
    chunks.sort(key=lambda f: f[114:122])
    assert len(chunks) == 12
    lost = {2, 3, 9, 10, 11}
    jobs = receive(spark, [c for i, c in enumerate(chunks) if i not in lost] + manifests)
    assert {r.missing_index for r in reassembly.missing_chunks(jobs).collect()} == lost


def test_same_capacity_name_twice_sends_once(spark):
    jobs = S.jobs(spark, [{"jobid": "j", "jobdata": b"a", "jstate": "S-2"}])
    files = S.files(spark, {"a": content(500)})
    peers = S.peers(spark, [("M2", 1, 7001, 400), ("M2", 2, 7001, 300)])
    chunks = framing.chunk_payloads(jobs, files, peers, S.AT)
    assert chunks.count() == 4 and chunks.select("jobid").distinct().count() == 4


def test_hot_file_is_spread_and_whole(spark, monkeypatch):
    """Two thirds of all jobs send the same file; the result is that of the plain join."""
    contents = {"hot": content(900, 1), "a": content(700, 2), "b": content(500, 3)}
    names = ["hot"] * 40 + ["a"] * 10 + ["b"] * 10
    jobs = S.jobs(spark, [{"jobid": f"j{i}", "jobdata": n.encode(), "jstate": "S-2"}
                          for i, n in enumerate(names)])
    files, peers = S.files(spark, contents), S.peers(spark, [("M2", 1, 7001, 300)])

    def run():
        rows = framing.chunk_payloads(jobs, files, peers, S.AT).collect()
        return sorted((r.jobid, bytes(r.jobdata)) for r in rows)

    plain = run()
    monkeypatch.setattr(framing, "fits_broadcast", lambda requests: False)
    assert run() == plain
    monkeypatch.setattr(framing, "HOT_FILE_BYTES", 5000)
    assert run() == plain
    assert len(plain) == sum(-(-len(contents[n]) // 128) for n in names)


def test_hot_message_is_split_into_parts(spark):
    """A message with most of all chunks becomes many groups of bounded size."""
    _, (_, chunks, manifests) = send(spark, {"big": content(20000, 5), "small": content(600)}, 300)
    jobs = receive(spark, chunks * 2 + manifests)
    parts = reassembly.reassemble(jobs, part_bytes=1280).collect()
    big = sorted((r for r in parts if r.n_parts > 1 and r.total_bytes == 20000),
                 key=lambda r: r.part_no)
    assert len(big) == 16 and max(len(r.content) for r in big) == 1280
    assert b"".join(bytes(r.content) for r in big) == content(20000, 5)


def test_completion_modes(spark):
    parents = spark.createDataFrame([(1, 2), (2, 2), (3, 2), (4, 1)], "parent_id int, expected long")
    rows = [(1, "C", 0), (1, "C", 1), (2, "C", 0), (2, "C", 0), (3, "C", 0), (3, "S-4", 1)]
    children = spark.createDataFrame(rows, "parent_id int, jstate string, chunk_index long")
    for mode, want in (("rows", {1, 2}), ("distinct", {1})):
        status = reassembly.completion_status(parents, children, mode)
        assert {r.parent_id for r in status.filter("is_complete").collect()} == want
        assert status.count() == 4
