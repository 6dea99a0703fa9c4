"""Headline queries, warm, median of several runs, written to the noop sink.

Prints one JSON line. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the threads,
``BENCH_RUNS`` the repetitions; ``BENCH_DUCKDB=1`` adds DuckDB's time for the same SQL.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relayframe.functions import frames as X
from relayframe.plans import oracles
from relayframe.plans.queries import QUERIES
from relayframe.plans.tick import run_tick
from relayframe.session import build_session, cut_lineage
from relayframe.sources import fixtures as fx

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

REGISTERED = [
    "chunk_payloads", "encode_manifest", "advance_inbound", "reassemble", "reassemble_ordered",
    "incoming_complete", "missing_chunks", "finish_incoming", "completion_status",
    "completion_status_distinct", "complete_chunked_parents", "show_stats", "plan_chunked",
    "apply_send_status", "update_job_priority", "top_pending_per_peer", "mark_taken",
    "open_commands", "close_commands", "check_constraints", "job_descendants", "stalled_parents",
]


def verify_chunk_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every stored chunk frame."""
    frames = fx.arrived_chunks(spark, sf_dir)
    return frames.select("frame_key", X.digest_matches(F.col("jobdata")).alias("ok"))


def tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tick over the stored node; the rows that moved or are new are written and read."""
    state = fx.node_state(spark, sf_dir)
    return run_tick(state, fx.T0, lambda df: cut_lineage(df, "bench-tick")).job_changes


def once(query, spark: SparkSession) -> float:
    started = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def duckdb_times(names: list[str]) -> dict[str, float]:
    import duckdb

    con = duckdb.connect(config={"threads": int(CPUS)})
    for path in Path(SF_DIR).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    times = {}
    for name in names:
        if name in oracles.SQL:
            con.sql(oracles.SQL[name]).fetchall()
            started = time.perf_counter()
            con.sql(oracles.SQL[name]).fetchall()
            times[name] = round(time.perf_counter() - started, 3)
    return times


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    named = {name: QUERIES[name] for name in REGISTERED}
    named |= {"verify_chunk_frames": verify_chunk_frames, "run_tick": tick}
    times = {}
    for name, query in named.items():
        once(query, spark)
        times[name] = round(statistics.median(once(query, spark) for _ in range(RUNS)), 3)
    result = {
        "metric": "total wall time of headline queries (warm, median)",
        "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": Path(SF_DIR).name.removeprefix("sf"), "cpus": int(CPUS), "runs": RUNS,
    }
    if os.environ.get("BENCH_DUCKDB"):
        result["duckdb"] = duckdb_times(REGISTERED)
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
