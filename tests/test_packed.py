"""Identifiers as short join keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from relayframe.functions import frames as X


def test_packed_ids_are_exact(spark):
    ids = ["63a9f0ea-7bb9-8050-796b-649e85481845", "63A9F0EA-7bb9-8050-796b-649e85481845", "0123456789abcdef",
           "", "root", "63a9f0ea7bb98050796b649e85481845", "é", None]
    df = spark.createDataFrame([(x,) for x in ids], "id string")
    rows = df.select("id", X.packed_id(F.col("id")).alias("key")).select(
        "id", "key", X.unpacked_id(F.col("key")).alias("back")).collect()
    assert [r.back for r in rows] == ids
    assert len({r.key if r.key is None else bytes(r.key) for r in rows}) == len(ids)
    assert len(rows[0].key) == 16
