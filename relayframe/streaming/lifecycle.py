"""The life cycle of a message as keyed state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql.streaming.state import GroupState

from ..functions import layout as L

# --- life cycle: fixed values ---------------------------------------------------
NEXT = {
    L.RECEIVED: (L.VERIFIED, L.DEAD),
    L.VERIFIED: (L.LOCAL, L.ADMITTED),
    L.LOCAL: (L.CLASSIFIED, L.DEAD),
    L.CLASSIFIED: (L.COMPLETE, L.DEAD),
    L.REQUESTED: (L.ADMITTED,),
    L.ADMITTED: (L.CHUNKED, L.SINGLE),
    L.CHUNKED: (L.CHUNKED_WAITING,),
    L.CHUNKED_WAITING: (L.COMPLETE,),
    L.SINGLE: (L.SINGLE_WAITING,),
    L.SINGLE_WAITING: (L.COMPLETE,),
    L.READY: (L.READY_TAKEN, L.COMPLETE, L.DEAD),
    L.READY_TAKEN: (L.COMPLETE, L.DEAD),
    L.HANDSHAKE_READY: (L.COMPLETE, L.DEAD),
}

DONE = (L.COMPLETE, L.DEAD)
LIFECYCLE = "jobid string, jstate string, n_changes bigint, n_rejected bigint, changed_at timestamp"
KEPT = "jstate string, n_changes bigint, n_rejected bigint, changed_at timestamp"


def reachable() -> dict[str, frozenset[str]]:
    """The states each state can come to; a tick passes several at once, so not only the next ones."""
    found = {state: set(after) for state, after in NEXT.items()}
    for _ in found:
        for after in found.values():
            for state in list(after):
                after |= found.get(state, set())
    return {state: frozenset(after) for state, after in found.items()}


def lifecycle(keep_done_ms: int, strict: bool) -> Callable:
    """The step of ``applyInPandasWithState`` that keeps the state of each job; see ``lifecycle_stream``.

    The changes of a job within a batch are taken in the order of ``changed_at`` and ``change_no``, nulls
    first; batches as they come. The first state of a job is taken as it is. A change to the state
    that the job has already counts as a change of no effect. One that cannot be reached is rejected.
    """
    later = reachable()

    def step(key: tuple, batches: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        if kept.hasTimedOut:
            kept.remove()
            return
        changes = pd.concat(list(batches)).sort_values(
            ["changed_at", "change_no", "jstate"], na_position="first", kind="stable")
        state, n_changes, n_rejected, at = kept.get if kept.exists else (None, 0, 0, None)
        for new, changed_at in zip(changes["jstate"], changes["changed_at"], strict=True):
            if strict and state is not None and new != state and new not in later.get(state, ()):
                n_rejected += 1
                continue
            state, n_changes = new, n_changes + 1
            at = None if pd.isna(changed_at) else changed_at.to_pydatetime()
        kept.update((state, n_changes, n_rejected, at))
        if state in DONE:
            kept.setTimeoutDuration(keep_done_ms)
        yield pd.DataFrame({"jobid": [key[0]], "jstate": [state], "n_changes": [n_changes],
                            "n_rejected": [n_rejected], "changed_at": pd.Series([at], dtype="datetime64[us]")})

    return step
