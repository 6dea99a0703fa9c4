"""Status reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import frames as X
from ..functions import layout as L
from .framing import addressable
from .lookups import join_lookup


def show_stats(jobs: DataFrame) -> DataFrame:
    """Number of jobs by state, priority, destination and type."""
    return jobs.groupBy("jstate", "jpriority", "jdestination", "jtype").agg(
        F.count("jstate").alias("total_jobs"))


def show_jobs_info(jobs: DataFrame) -> DataFrame:
    """Send jobs with the name of their file as readable text."""
    return jobs.filter(F.col("jtype") == L.padded(L.TYPE_SEND)).select(
        "jobid", X.escape_encode(F.col("jobdata")).alias("file_name"),
        "jstate", "jpriority", "jdestination")


def show_files_info(files: DataFrame) -> DataFrame:
    """Stored files and their size; contents are not read."""
    return files.select("file_id", "file_name", "n_bytes", "creation_time")


def stalled_parents(jobs: DataFrame) -> DataFrame:
    """Waiting parents that have a dead child and therefore never complete."""
    dead = (
        jobs.filter(F.col("jstate") == L.DEAD)
        .groupBy(X.packed_id(F.col("jparent_jobid")).alias("_key")).agg(F.count("*").alias("dead_children"))
    )
    waiting = jobs.filter(F.col("jstate").isin(L.CHUNKED_WAITING, L.SINGLE_WAITING)).select(
        X.packed_id(F.col("jobid")).alias("_key"), "jstate", "jdestination")
    return waiting.join(dead, "_key").select(
        X.unpacked_id(F.col("_key")).alias("jobid"), "jstate", "jdestination", "dead_children")


def stalled_jobs(jobs: DataFrame, peers: DataFrame) -> DataFrame:
    """Send jobs that cannot move: no such peer, or no usable capacity agreed yet."""
    waiting = jobs.filter(
        F.col("jstate").isin(L.REQUESTED, L.ADMITTED) & (F.btrim("jtype") == L.TYPE_SEND)
    ).select("jobid", "jstate", "jdestination")
    named = peers.select(F.col("system_name").alias("jdestination")).distinct()
    known = named.join(addressable(peers), "jdestination", "left").select(
        "jdestination", F.col("system_capacity").isNotNull().alias("_usable"))
    joined = join_lookup(waiting, known, ["jdestination"], "left", spread_by=F.col("jobid"))
    reason = F.when(F.col("_usable").isNull(), F.lit("unknown peer")).when(
        ~F.col("_usable"), F.lit("no capacity"))
    return joined.select("jobid", "jstate", "jdestination", reason.alias("reason")).filter(
        F.col("reason").isNotNull())


def stranded_forwards(jobs: DataFrame) -> DataFrame:
    """Frames for other nodes that stay in S-1, by destination."""
    stranded = jobs.filter(
        (F.col("jstate") == L.ADMITTED) & (F.btrim("jtype") != L.TYPE_SEND))
    return stranded.groupBy("jdestination").agg(F.count("*").alias("n_frames"))


def colliding_names(names: DataFrame, column: str = "system_name") -> DataFrame:
    """Names that would be equal on the wire. Joins compare whole names, frames hold five characters."""
    full = F.btrim(column)
    return (
        names.select(X.wire_name(F.col(column)).alias("short_name"), full.alias("_full")).distinct()
        .groupBy("short_name").agg(F.count("*").alias("n_names"))
        .filter(F.col("n_names") > 1)
    )
