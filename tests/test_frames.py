import pytest
from pyspark.sql import functions as F

from relayframe.functions import frames as X
from relayframe.functions import layout as L
from relayframe.operators import framing, negotiate, reports, transitions
from tests import samples as S

MID = "12345678-1234-1234-1234-123456789012"
PARENT = "abcdefab-1234-1234-1234-abcdefabcdef"


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def encoded(spark, **given):
    args = {"message_id": MID, "message_type": "1", "source": "M3", "destination": "M2",
            "priority": 5, "created_at": S.AT, "capacity": 0} | given
    return bytes(one(spark, X.encode_frame(**args)))


@pytest.mark.parametrize("payload", [b"", b"hello", bytes(range(256)), "grüße".encode()])
@pytest.mark.parametrize("capacity", [0, 114, 200, 1024])
def test_single_frame_matches_layout(spark, payload, capacity):
    got = encoded(spark, capacity=capacity, payload=F.lit(payload))
    assert got == S.frame(MID, "1", "M3", "M2", 5, capacity, payload=payload)
    assert len(got) == max(capacity, 114 + len(payload))


def test_chunk_manifest_and_handshake_layout(spark):
    sub = X.chunk_subheader(7, F.lit(PARENT), 3)
    got = encoded(spark, message_type="2", capacity=300, subheader=sub, payload=F.lit(b"abc"))
    want_sub = b"       7" + PARENT.encode() + b"         3"
    assert got == S.frame(MID, "2", "M3", "M2", 5, 300, want_sub, b"abc")
    assert got[168:171] == b"abc"

    sub = X.manifest_subheader(F.lit(PARENT), 12345, 9)
    got = encoded(spark, message_type="3", capacity=172, subheader=sub)
    assert got == S.frame(MID, "3", "M3", "M2", 5, 172,
                          PARENT.encode() + b"       12345" + b"         9")
    assert len(got) == 172

    sub = X.handshake_subheader(32768, 6001, 2130706433)
    got = encoded(spark, message_type="4", capacity=147, subheader=sub)
    assert got == S.frame(MID, "4", "M3", "M2", 5, 147, b"      32768       6001 2130706433")
    assert len(got) == 147


def test_long_names_are_joined_whole_and_their_wire_form_is_reported(spark):
    assert one(spark, X.norm_name("abcdefgh")) == "abcdefgh"
    assert one(spark, X.wire_name("abcdefgh")) == "abcde" and one(spark, X.wire_name(" M3 ")) == "   M3"
    assert one(spark, X.norm_name(" M3 ")) == "   M3"
    names = spark.createDataFrame([("server1",), ("server2",), ("M3",)], "system_name string")
    assert [tuple(r) for r in reports.colliding_names(names).collect()] == [("serve", 2)]


def test_identifier_is_repeatable_and_uuid_shaped(spark):
    a, b = (one(spark, X.message_uid("x", F.lit(1))) for _ in range(2))
    assert a == b and [len(p) for p in a.split("-")] == [8, 4, 4, 4, 12]


def test_escape_encode(spark):
    cases = {b"plain.txt": "plain.txt", b"": "", b"a\\b": "a\\\\b", b"a\x00b": "a\\000b",
             "é".encode(): "\\303\\251", b"tab\t\x7f\x80": "tab\t\x7f\\200"}
    df = spark.createDataFrame([(bytearray(k),) for k in cases], "b binary")
    got = {bytes(r.b): r.t for r in df.select("b", X.escape_encode(F.col("b")).alias("t")).collect()}
    assert got == cases


def test_decode_is_inverse_of_encode(spark):
    frame = S.frame(MID, "2", "M3", "M2", 5, 300, b"       4" + PARENT.encode() + b"         3",
                    b"xyz")
    jobs = S.jobs(spark, [{"jobid": "j", "jobdata": frame}])
    header = framing.decode_header(jobs).first()
    assert (header.message_id, header.frame_type, header.frame_source, header.frame_destination,
            header.created_at) == (MID, "2", "M3", "M2", S.AT_TEXT)
    chunk = framing.decode_chunk(jobs).first()
    assert (chunk.chunk_index, chunk.parent_id, chunk.chunk_bytes, bytes(chunk.payload),
            chunk.byte_offset) == (4, PARENT, 3, b"xyz", 4 * 128)


def test_single_payload_is_known_up_to_trailing_blanks(spark):
    frame = S.frame(MID, "1", "M3", "M2", 5, 200, payload=b"two words  ")
    row = framing.decode_single(S.jobs(spark, [{"jobid": "j", "jobdata": frame}])).first()
    assert bytes(row.payload) == b"two words" and not row.exact
    assert bytes(row.payload_padded).startswith(b"two words  ")


def test_malformed_digits_go_dead_with_reason(spark):
    good = S.frame(MID, "4", "M2", "M3", 5, 147, b"       1024       7001 2130706434")
    bad = S.frame(MID, "4", "M2", "M3", 5, 147, b"       10x4       7001 2130706434")
    jobs = S.jobs(spark, [
        {"jobid": name, "jobdata": data, "jstate": "N-4", "jtype": "    4"}
        for name, data in (("good", good), ("bad", bad))])
    assert [r.capacity for r in negotiate.handshakes(jobs, L.TYPE_REQUEST).collect()] == [1024]
    done = transitions.finish_handshake(jobs, L.TYPE_REQUEST)
    assert S.states(done) == {"good": "C", "bad": "D"}
    report = transitions.dead_letter_report(done).collect()
    assert [(r.jobid, r.reason) for r in report] == [("bad", "malformed")]


def test_address_above_128_0_0_0_keeps_its_value(spark):
    data = S.frame(MID, "4", "M2", "M3", 5, 147, b"       1024       7001 4294967295")
    jobs = S.jobs(spark, [{"jobid": "j", "jobdata": data, "jstate": "N-4", "jtype": "    4"}])
    assert negotiate.handshakes(jobs, L.TYPE_REQUEST).first().ipaddress == 4294967295


@pytest.mark.parametrize("position", [0, 31, 32, 100, 146])
def test_one_flipped_byte_is_detected(spark, position):
    data = bytearray(S.frame(MID, "4", "M2", "M3", 5, 147, b"       1024       7001 2130706434"))
    data[position] ^= 1
    jobs = S.jobs(spark, [{"jobid": "j", "jobdata": bytes(data), "jstate": "N-1", "jtype": "0"}])
    assert S.states(transitions.advance_inbound(jobs, S.NODE)) == {"j": "D"}
