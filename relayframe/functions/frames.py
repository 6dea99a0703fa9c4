"""Column expressions for the wire format. All of them run inside the JVM."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import layout as L

TO_THE_END = 2**31 - 1


def as_column(value) -> Column:
    """Columns stay columns, everything else becomes a literal.

    A time without zone is wall time of the session, whatever zone Python runs in.
    """
    if isinstance(value, datetime) and value.tzinfo is None:
        return F.lit(value.isoformat(sep=" ", timespec="microseconds")).cast("timestamp")
    return value if isinstance(value, Column) else F.lit(value)


def message_uid(*parts) -> Column:
    """A repeatable identifier in uuid shape: the MD5 of the joined parts.

    A random uuid would be drawn again when a lost stage is recomputed, and the
    identifier inside a frame would then differ from the one of its row.
    """
    text = F.concat(*[as_column(p).cast("string") for p in parts])
    digest = F.md5(text.cast("binary"))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, at, size) for at, size in cuts])


def norm_name(name) -> Column:
    """Names are compared in their form on the wire, padded to five characters; longer ones whole."""
    name = F.btrim(as_column(name))
    return F.when(F.length(name) > L.NAME_WIDTH, name).otherwise(F.lpad(name, L.NAME_WIDTH, " "))


def wire_name(name) -> Column:
    """The five characters of a name in a frame: padded in front, cut behind."""
    return F.lpad(F.btrim(as_column(name)), L.NAME_WIDTH, " ")


def fits_wire(name) -> Column:
    """Whether a name has room in a frame; a longer one would be cut to another name there."""
    return F.coalesce(F.octet_length(F.btrim(as_column(name))) <= L.NAME_WIDTH, F.lit(False))


def frame_text(frame: Column, field: tuple[int, int]) -> Column:
    """The raw text of a fixed-position field."""
    at, size = field
    return F.substring(frame, at, size).cast("string")


def frame_number(frame: Column, field: tuple[int, int]) -> Column:
    """A numeric field; null when its digits are malformed."""
    return F.btrim(frame_text(frame, field)).try_cast("bigint")


def malformed(frame: Column) -> Column:
    """Whether a frame of type 2 to 5 has a field out of its range or unreadable.

    Chunks: index 0 or more, and a length that their frame holds. Manifests: no negative size or
    count, and no more chunks than bytes. Handshakes: capacity and port fit their columns, addresses
    have 32 bits.
    """
    def outside(place: tuple[int, int], low, high) -> Column:
        return ~F.coalesce(frame_number(frame, place).between(low, as_column(high)), F.lit(False))

    room = (F.octet_length(frame) - L.DATA_OVERHEAD).cast("bigint")
    total = F.coalesce(frame_number(frame, L.MANIFEST["total_bytes"]), F.lit(-1))
    chunk = outside(L.CHUNK["chunk_index"], 0, 2**31 - 1) | outside(L.CHUNK["chunk_bytes"], 0, room)
    manifest = (total < 0) | outside(L.MANIFEST["chunk_count"], 0, total)
    handshake = (outside(L.HANDSHAKE["capacity"], 0, 2**31 - 1) | outside(L.HANDSHAKE["port"], 0, 2**31 - 1)
                 | outside(L.HANDSHAKE["ipaddress"], 0, 2**32 - 1))
    kind = frame_type(frame)
    return (F.when(kind == L.padded(L.TYPE_CHUNK), chunk).when(kind == L.padded(L.TYPE_MANIFEST), manifest)
            .when(kind.isin(L.padded(L.TYPE_REQUEST), L.padded(L.TYPE_REPLY)), handshake).otherwise(F.lit(False)))


def frame_type(frame: Column) -> Column:
    return frame_text(frame, L.HEADER["frame_type"])


def digest_matches(frame: Column) -> Column:
    """True when the leading digest equals the MD5 of the rest of the frame."""
    rest = F.substring(frame, L.DIGEST_BYTES + 1, TO_THE_END)
    return frame_text(frame, L.HEADER["digest"]) == F.md5(rest)


def fixed_number(value, width: int) -> Column:
    return F.lpad(as_column(value).cast("string"), width, " ")


def chunk_subheader(index, parent_id, n_bytes) -> Column:
    return F.concat(
        fixed_number(index, L.CHUNK["chunk_index"][1]),
        as_column(parent_id),
        fixed_number(n_bytes, L.CHUNK["chunk_bytes"][1]),
    )


def manifest_subheader(parent_id, total_bytes, chunk_count) -> Column:
    return F.concat(
        as_column(parent_id),
        fixed_number(total_bytes, L.MANIFEST["total_bytes"][1]),
        fixed_number(chunk_count, L.MANIFEST["chunk_count"][1]),
    )


def handshake_subheader(capacity, port, ipaddress) -> Column:
    pairs = zip(L.HANDSHAKE.values(), (capacity, port, ipaddress), strict=True)
    return F.concat(*[fixed_number(value, size) for (_, size), value in pairs])


def encode_frame(
    *,
    message_id,
    message_type,
    source,
    destination,
    priority,
    created_at,
    capacity,
    subheader=None,
    payload: Column | None = None,
) -> Column:
    """One wire frame: digest, fixed header, sub-header, payload, blank padding.

    The frame is padded up to ``capacity`` and never cut: what is longer stays longer.
    """
    def five(value):
        return F.lpad(as_column(value).cast("string"), L.NAME_WIDTH, " ")

    head = F.concat(
        as_column(message_id),
        five(message_type),
        five(source),
        five(destination),
        five(priority),
        F.date_format(as_column(created_at), L.TIME_FORMAT),
        *([] if subheader is None else [subheader]),
    )
    used = F.octet_length(head)
    if payload is not None:
        used = used + F.octet_length(payload)
    missing = F.greatest(as_column(capacity) - L.DIGEST_BYTES - used, F.lit(0)).cast("int")
    pieces = [head.cast("binary"), payload, F.repeat(F.lit(" "), missing).cast("binary")]
    body = F.concat(*[piece for piece in pieces if piece is not None])
    return F.concat(F.md5(body).cast("binary"), body)


def escape_encode(data: Column) -> Column:
    """Bytes as readable text: NUL and high bytes as ``\\nnn`` (octal), backslash doubled."""
    text = data.cast("string")

    def one_byte(position: Column) -> Column:
        code = F.hex(F.substring(data, position, F.lit(1)))
        return (
            F.when(code == "5C", F.lit("\\\\"))
            .when((code == "00") | (code >= "80"),
                  F.concat(F.lit("\\"), F.lpad(F.conv(code, 16, 8), 3, "0")))
            .otherwise(F.unhex(code).cast("string"))
        )

    spelled = F.array_join(
        F.transform(F.sequence(F.lit(1), F.greatest(F.octet_length(data), F.lit(1))), one_byte), "")
    plain = text.rlike(r"\A[\x01-\x5B\x5D-\x7F]*\z")
    return F.when(plain, text).otherwise(spelled)


_CANONICAL = r"\A[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"
_OTHER = b"\0" * 17


def packed_id(jobid: Column) -> Column:
    """An identifier as a join key: 16 bytes where it is a canonical one, else its text behind 17 zero bytes.

    Different texts have different keys, so joins by it are exact and move less than half of the bytes.
    """
    short = F.unhex(F.replace(jobid, F.lit("-"), F.lit("")))
    return F.when(F.rlike(jobid, F.lit(_CANONICAL)), short).otherwise(F.concat(F.lit(_OTHER), jobid.cast("binary")))


def unpacked_id(key: Column) -> Column:
    """The identifier of a key of ``packed_id``."""
    digits = F.lower(F.hex(key))
    parts = [F.substring(digits, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    other = F.substring(key, len(_OTHER) + 1, TO_THE_END).cast("string")
    return F.when(F.octet_length(key) == 16, F.concat_ws("-", *parts)).otherwise(other)
