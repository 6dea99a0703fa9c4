"""Rows that a large lookup cannot reach are told apart before anything is shuffled."""

from __future__ import annotations

from pyspark.sql import functions as F

from relayframe.operators import lookups, transitions

from . import samples as S


def test_a_bit_table_has_every_key(spark):
    keys = spark.range(0, 3000, 3).select(F.col("id").cast("string").alias("k"))
    table = lookups.BitTable(keys.select(F.xxhash64("k")), 1000)
    rows = spark.range(3000).select(F.col("id").cast("string").alias("k")).unionByName(
        spark.createDataFrame([(None,)], "k string"))
    got = {r.k: r.held for r in table.flag(rows, F.col("k"), "held").collect()}
    assert all(got[str(i)] for i in range(0, 3000, 3)) and got[None] is False
    assert sum(got.values()) < 1300
    full = lookups.BitTable(keys.select(F.xxhash64("k")), 1000, most=6)
    assert full.flag(keys, F.col("k"), "held").filter("held").count() == 1000


def test_only_reached_jobs_move(spark, monkeypatch):
    moved, inner = [], transitions.join_lookup
    monkeypatch.setattr(transitions, "join_lookup", lambda big, *a, **kw: moved.append(big.count()) or inner(big, *a, **kw))
    rows = [{"jobid": f"p{i}", "jpriority": 3} for i in range(1000)]
    rows += [{"jobid": f"c{i}", "jparent_jobid": f"p{i}"} for i in range(1000)] + [{"jobid": "p1", "jparent_jobid": "p2"}]
    jobs = S.jobs(spark, rows)
    updates = spark.createDataFrame(
        [("p1", 9, 1), ("c1", 7, 2), ("p2", 8, 3), ("gone", 1, 4), ("c3", 2, 5), (None, 4, 6)],
        "jobid string, new_priority int, update_no int")
    few = transitions.update_job_priority(jobs, updates, max_rows=2)
    assert max(moved) < 300
    want = sorted((r.jobid, r.jpriority) for r in transitions.update_job_priority(jobs, updates).collect())
    assert sorted((r.jobid, r.jpriority) for r in few.collect()) == want
    assert {j: p for j, p in want if j in ("c1", "c2", "c3", "p2", "c4")} == {"c1": 7, "c2": 8, "c3": 2, "p2": 8, "c4": 5}
    assert [p for j, p in want if j == "p1"] == [8, 9]
    assert few.schema == transitions.update_job_priority(jobs, updates).schema
