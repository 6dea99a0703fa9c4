"""Lineage of jobs at size: what is moved and written, and results by every path."""

from __future__ import annotations

import random

from relayframe.operators import integrity, lookups


def test_rounds_leave_out_jobs_without_children(spark, monkeypatch):
    sizes, inner = [], integrity.cut_lineage

    def written(df, name="step"):
        out = inner(df, name)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(integrity, "cut_lineage", written)
    pairs = [("r", "r")] + [(f"p{i}", "r") for i in range(10)] + [(f"c{i}", f"p{i % 10}") for i in range(2000)]
    jobs = spark.createDataFrame(pairs, "jobid string, jparent_jobid string")
    below = integrity.job_descendants(jobs, jobs.filter("jobid = 'r'"))
    assert {(r.jobid, r.depth) for r in below.collect()} == {(j, 1 if p == "r" else 2) for j, p in pairs[1:]}
    assert below.count() == len(pairs) - 1 and max(sizes) <= 11


def test_descendants_by_bit_table_and_spread_parents(spark, monkeypatch):
    monkeypatch.setattr(integrity, "NARROW_ROWS", 5)
    rng = random.Random(1)
    pairs = [("0", "0")] + [(str(i), str(rng.randrange(i) // 3)) for i in range(1, 400)]
    pairs += [("x", "z"), ("y", "x"), ("z", "y"), ("w", "z"), ("n", None), ("v", "gone")]
    pairs += [("63a9f0ea-7bb9-8050-796b-649e85481845", "5")]
    jobs = spark.createDataFrame(pairs, "jobid string, jparent_jobid string")
    above = spark.createDataFrame([("0",), ("7",), ("x",), ("gone",), (None,)], "jobid string")
    want, parent = set(), dict(pairs)
    for job in parent:
        at, depth, seen = job, 0, {job}
        while parent.get(at) not in (None, at):
            at, depth = parent[at], depth + 1
            if at in seen:
                break
            seen.add(at)
            if at in ("0", "7", "x", "gone"):
                want.add((at, job, depth))
    for most in (0, lookups.BROADCAST_ROWS):
        got = [tuple(r) for r in integrity.job_descendants(jobs, above, max_rows=most).select("ancestor", "jobid", "depth").collect()]
        assert len(got) == len(set(got)) and set(got) == want
