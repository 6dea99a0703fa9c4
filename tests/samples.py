"""Small inputs and an independent Python model of the wire format."""

from __future__ import annotations

import hashlib
from datetime import datetime

from relayframe.node import Node
from relayframe.schemas import FILES, JOBS, PEERS

AT = datetime(2024, 1, 2, 3, 4, 5, 123456)
AT_TEXT = "2024-01-02 03:04:05.123456"
ROOT = "00000000-0000-0000-0000-000000000000"
NODE = Node("M3", 2130706433, 6001, 6000, 32768, ROOT)


def frame(message_id, kind, source, target, priority, capacity, sub=b"", payload=b""):
    """A frame put together byte by byte."""
    head = "".join([message_id, kind.rjust(5), source.rjust(5), target.rjust(5),
                    str(priority).rjust(5), AT_TEXT]).encode()
    body = head + sub + payload
    body += b" " * max(capacity - 32 - len(body), 0)
    return hashlib.md5(body).hexdigest().encode() + body


def jobs(spark, rows):
    """Job rows from dictionaries; what is missing gets a default."""
    base = {"jobdata": b"", "jstate": "S", "jtype": "    6", "jsource": NODE.name,
            "jparent_jobid": ROOT, "jdestination": "   M2", "jpriority": 5,
            "jcreation_time": AT}
    full = [{**base, **row} for row in rows]
    return spark.createDataFrame([tuple(r[c] for c in JOBS.names) for r in full], JOBS)


def files(spark, contents):
    rows = [(f"id-{name}", name, bytearray(data), len(data), AT) for name, data in contents.items()]
    return spark.createDataFrame(rows, FILES)


def peers(spark, rows):
    """(name, address, port, capacity)."""
    return spark.createDataFrame(
        [(name.rjust(5), ip, port, 7000, capacity) for name, ip, port, capacity in rows], PEERS)


def states(df):
    return {r.jobid: r.jstate for r in df.select("jobid", "jstate").collect()}
