"""Fixed values of the wire format and of the job life cycle.

Fields are (1-based byte position, length) inside a frame.
"""

# --- wire format: fixed values -------------------------------------------------
HEADER = {
    "digest": (1, 32),
    "message_id": (33, 36),
    "frame_type": (69, 5),
    "frame_source": (74, 5),
    "frame_destination": (79, 5),
    "frame_priority": (84, 5),
    "created_at": (89, 26),
}
CHUNK = {"chunk_index": (115, 8), "parent_id": (123, 36), "chunk_bytes": (159, 10)}
MANIFEST = {"parent_id": (115, 36), "total_bytes": (151, 12), "chunk_count": (163, 10)}
HANDSHAKE = {"capacity": (115, 11), "port": (126, 11), "ipaddress": (137, 11)}

DIGEST_BYTES = 32
NAME_WIDTH = 5
HEADER_BYTES = 114
DATA_OVERHEAD = 172
CHUNK_PAYLOAD_AT = 169
SINGLE_PAYLOAD_AT = 115
HANDSHAKE_BYTES = 147
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

TYPE_ROOT = "0"
TYPE_SINGLE = "1"
TYPE_CHUNK = "2"
TYPE_MANIFEST = "3"
TYPE_REQUEST = "4"
TYPE_REPLY = "5"
TYPE_SEND = "6"

# --- life cycle: fixed values --------------------------------------------------
ROOT = "N-0"
RECEIVED = "N-1"
VERIFIED = "N-2"
LOCAL = "N-3"
CLASSIFIED = "N-4"
REQUESTED = "S"
ADMITTED = "S-1"
CHUNKED = "S-2"
CHUNKED_WAITING = "S-2W"
SINGLE = "S-3"
SINGLE_WAITING = "S-3W"
READY = "S-4"
READY_TAKEN = "S-4W"
HANDSHAKE_READY = "S-5"
COMPLETE = "C"
DEAD = "D"
TAKEN_SUFFIX = "W"

DEFAULT_PRIORITY = 5
DEFAULT_COMMS_PORT = 7000
CONN_WANTED = 1
CONN_OPEN = 2
COMMAND_OPEN = "1"
COMMAND_CLOSE = "2"
NO_FD = -1
ROOT_PAYLOAD = "__ROOT__"


def padded(value: str) -> str:
    """A literal in the fixed five-character form used for types and names."""
    return value[:NAME_WIDTH].rjust(NAME_WIDTH)
