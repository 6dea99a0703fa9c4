"""Physical plans: what is read, shuffled and broadcast."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from relayframe.operators import framing, lookups, queues, reassembly, transitions
from relayframe.operators.lookups import join_lookup
from relayframe.sources import state as store
from tests import samples as S


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def scans(text):
    return [line for line in text.splitlines() if line.startswith("ReadSchema")]


@pytest.fixture
def tables(spark, folder):
    """Stored jobs, files and peers."""
    jobs = S.jobs(spark, [{"jobid": f"j{i}", "jobdata": f"f{i}".encode(), "jstate": "S-2"}
                          for i in range(5)])
    state = store.seed_node(spark, S.NODE, S.AT).with_tables(
        jobs=jobs, files=S.files(spark, {f"f{i}": b"x" * 500 for i in range(5)}),
        peers=S.peers(spark, [("M2", 7, 7001, 300)]))
    return store.save_state(state, folder, 0)


def test_manifests_and_planning_never_read_contents(tables):
    manifests = framing.encode_manifest(tables.jobs, tables.files, tables.peers, S.AT)
    planned = transitions.plan_sends(tables.jobs, tables.files, tables.peers)
    for text in map(plan, (manifests, planned)):
        assert scans(text) and not any("content" in line for line in scans(text))


def test_few_requests_leave_contents_in_place(tables):
    text = plan(framing.chunk_payloads(tables.jobs, tables.files, tables.peers, S.AT))
    assert "ShuffledHashJoin" not in text and "SortMergeJoin" not in text


def test_chunks_hash_the_narrow_side_and_do_not_sort_contents(tables, monkeypatch):
    monkeypatch.setattr(framing, "fits_broadcast", lambda requests: False)
    text = plan(framing.chunk_payloads(tables.jobs, tables.files, tables.peers, S.AT))
    assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "PartitionFilters: [isnotnull(jstate" in text


def test_inbound_steps_move_no_data(tables):
    text = plan(transitions.advance_inbound(tables.jobs, S.NODE))
    assert "Exchange" not in text


def test_manifests_are_read_without_chunks(tables):
    text = plan(reassembly.manifests(tables.jobs))
    assert "(jtype" in text and "PartitionFilters: [isnotnull(jstate" in text


def test_payloads_are_shuffled_once(tables):
    text = plan(reassembly.reassemble(tables.jobs))
    wide = [block for block in text.split("\n\n") if ") Exchange" in block and "_pieces" in block
            or ") Exchange" in block and "buf" in block]
    assert len(wide) == 1


def test_per_peer_pick_limits_before_the_shuffle(spark, tables):
    conns = spark.createDataFrame([(3, 7, 2, S.AT)], tables.out_conns.schema)
    pending = queues.pending_with_conn(tables.jobs, tables.peers, conns)
    text = plan(queues.top_pending(pending, 2, per_peer=True))
    first, last = text.index("WindowGroupLimit"), text.rindex("Exchange")
    assert first < last
    assert "TakeOrderedAndProject" in plan(queues.top_pending(pending, 2))


def test_broadcast_only_within_the_limit(spark):
    big, lookup = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("k")), spark.range(
        7).withColumnRenamed("id", "k")
    small = plan(join_lookup(big, lookup, ["k"], spread_by=F.col("id"), max_rows=10))
    assert "BroadcastHashJoin" in small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = plan(join_lookup(big, lookup, ["k"], spread_by=F.col("id"), max_rows=3))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in large and "SortMergeJoin" in large
    assert lookups.BROADCAST_ROWS <= 1_000_000
