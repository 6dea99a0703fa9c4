"""The identity of one node and its tables."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

from .functions import layout as L
from .operators import counters


@dataclass(frozen=True)
class Node:
    """Settings of the local node: one row of a few scalars, used as literals."""

    name: str
    ipaddress: int
    dataport: int
    comssport: int
    capacity: int
    root_id: str

    def __post_init__(self):
        object.__setattr__(self, "name", L.padded(self.name.strip(" ")))


@dataclass(frozen=True)
class NodeState:
    """The stored tables of a node. ``version`` counts the committed ticks.

    ``child_counts`` and ``job_counts`` follow from ``jobs``; who changes jobs by known rows gives the
    counters along, and where they are not given (``recounted``) they are counted anew from all jobs.
    Rows of ``child_counts`` add up.
    """

    node: Node
    jobs: DataFrame
    files: DataFrame
    peers: DataFrame
    out_conns: DataFrame
    in_conns: DataFrame
    commands: DataFrame
    capacity_events: DataFrame
    version: int = 0
    child_counts: DataFrame | None = None
    job_counts: DataFrame | None = None
    recounted: frozenset[str] = field(default=frozenset(), init=False)

    def __post_init__(self):
        missing = [name for name in counters.COUNTED if getattr(self, name) is None]
        for name in missing:
            object.__setattr__(self, name, counters.COUNTED[name](self.jobs))
        object.__setattr__(self, "recounted", frozenset(missing))

    def with_tables(self, **tables) -> NodeState:
        if "jobs" in tables:
            tables = {"child_counts": None, "job_counts": None, **tables}
        return replace(self, **tables)

    def with_new_jobs(self, rows: DataFrame) -> NodeState:
        """The state with ``rows`` added to its jobs; no other job is looked at."""
        children, stats = counters.child_counts(rows), counters.job_counts(rows)
        return self.with_tables(
            jobs=self.jobs.unionByName(rows),
            child_counts=counters.together(self.child_counts, children),
            job_counts=counters.merged(self.job_counts, stats))
