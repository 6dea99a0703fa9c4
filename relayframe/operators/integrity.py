"""Key and reference checks over the stored tables, and the lineage of jobs."""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import frames as X
from ..session import cut_lineage
from .lookups import BROADCAST_ROWS, NARROW_ROWS, BitTable, bounded_hot_keys, fits_broadcast, join_lookup, salted_join

# Keys and required columns per table: fixed values.
UNIQUE = {
    "jobs": [["jobid"]],
    "files": [["file_id"], ["file_name"]],
    "peers": [["system_name", "ipaddress"], ["ipaddress"]],
    "self_info": [["ipaddress"]],
    "out_conns": [["sipaddr"]],
    "in_conns": [["rfd"]],
    "commands": [["mdata1", "mdata2"]],
    "capacity_events": [["rcomid"]],
}
REQUIRED = {
    "jobs": ["jobid", "jobdata", "jstate", "jtype", "jsource", "jparent_jobid",
             "jdestination", "jpriority"],
    "files": ["file_id", "file_name", "content", "creation_time"],
    "peers": ["system_name", "ipaddress", "comssport"],
    "self_info": ["system_name", "ipaddress", "dataport", "comssport", "system_capacity"],
    "out_conns": ["sfd", "sipaddr", "scstatus"],
    "in_conns": ["rfd", "ripaddr", "rcstatus"],
    "commands": ["mdata1", "mdata2", "mtype"],
    "capacity_events": ["rcomid", "rdata1", "rdata2"],
}


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Surplus rows per key violation, as one count."""
    return (
        df.dropna(subset=key).groupBy(*key).agg(F.count("*").alias("n"))
        .filter(F.col("n") > 1).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
    )


def check_constraints(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations per table and rule: unique keys, required columns, parents that exist."""
    found = []
    for name, df in tables.items():
        for key in UNIQUE.get(name, []):
            rule = "unique(" + ",".join(key) + ")"
            found.append(_row(duplicate_keys(df, key), name, rule))
        required = [c for c in REQUIRED.get(name, []) if c in df.columns]
        if required:
            # The filter lets Parquet skip every row group without nulls, payloads included.
            anywhere = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
            nulls = df.filter(anywhere).agg(
                *[F.count_if(F.col(c).isNull()).alias(c) for c in required])
            pairs = F.explode(F.array(*[
                F.struct(F.lit(f"required({c})").alias("rule"), F.col(c).alias("violations"))
                for c in required])).alias("_pair")
            found.append(nulls.select(pairs).select(
                F.lit(name).alias("table_name"), "_pair.rule", "_pair.violations"))
        if name == "jobs":
            # Distinct first: the root is the parent of most rows.
            parents = df.select(F.col("jparent_jobid").alias("jobid")).dropna().distinct()
            orphans = parents.join(df.select("jobid"), "jobid", "left_anti")
            found.append(_row(orphans.agg(F.count("*").alias("violations")), name,
                              "parent exists"))
    return reduce(DataFrame.unionByName, found)


def _row(counted: DataFrame, table: str, rule: str) -> DataFrame:
    return counted.select(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"),
                          F.col("violations").cast("bigint").alias("violations"))


def job_descendants(jobs: DataFrame, ancestors: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Everything below the given jobids, ``ancestor, jobid, depth``: what deleting them would delete too.

    Paths are doubled: a round knows the job 2^k steps above each job, finds what lies 2^k to 2^(k+1) - 1
    steps below the ancestors from what lies less deep, and joins the steps with themselves. So rounds grow
    as the logarithm of the depth. Steps and findings are narrow and written, so the plan does not grow.
    Only jobs that are parents take part in the rounds: what has no job below it is found by one last join of
    all jobs with their parents. Identifiers move as 16 bytes. ``jobs`` is read several times, so it should be a
    stored table.
    The root's edge to itself is left out. Jobids are unique, so a job has one parent and a path can only come
    back to where it began: an ancestor in a cycle is not listed below itself, and others once, at the least depth.
    """
    linked = jobs.filter(F.col("jobid") != F.col("jparent_jobid"))
    edge = [X.packed_id(F.col("jparent_jobid")).alias("above"), X.packed_id(F.col("jobid")).alias("jobid")]
    parents = cut_lineage(linked.groupBy(F.xxhash64("jparent_jobid").alias("_hash")).agg(F.count("*").alias("n_below")), "parents")
    steps = cut_lineage(_parents_only(linked, parents, max_rows).select(*edge), "steps")
    first = X.packed_id(F.col("jobid"))
    found = ancestors.select(first.alias("ancestor"), first.alias("jobid"), F.lit(0).alias("depth")).dropna().distinct()
    back, cyclic = F.col("jobid") == F.col("ancestor"), False
    for k in count():
        known = found.select("ancestor", F.col("jobid").alias("above"), "depth")
        below = cut_lineage(join_lookup(steps, known, ["above"], spread_by=F.col("jobid"), max_rows=max_rows).select(
            "ancestor", "jobid", (F.col("depth") + (1 << k)).alias("depth")), "below")
        n_rows, n_back = below.agg(F.count(F.lit(1)), F.count_if(back)).first()
        # Nothing is met twice before an ancestor is met below itself.
        cyclic = cyclic or n_back > 0
        if cyclic:
            below = below.filter(~back).groupBy("ancestor", "jobid").agg(F.min("depth").alias("depth"))
            below = cut_lineage(below.join(found.select("ancestor", "jobid"), ["ancestor", "jobid"], "left_anti"), "new")
            n_rows = below.count()
        if not n_rows:
            break
        found = found.unionByName(below)
        higher = steps.select(F.col("jobid").alias("above"), F.col("above").alias("_higher"))
        steps = cut_lineage(join_lookup(steps, higher, ["above"], spread_by=F.col("jobid"), max_rows=max_rows).select(
            F.col("_higher").alias("above"), "jobid"), "steps")
        if steps.isEmpty():
            break
    known = found.select("ancestor", F.col("jobid").alias("above"), "depth")
    rows = _with_parents(linked.select(*edge, F.xxhash64("jparent_jobid").alias("_hash")), known, parents, max_rows)
    rows = rows.select("ancestor", "jobid", (F.col("depth") + 1).alias("depth"))
    if cyclic:
        rows = rows.filter(~back).groupBy("ancestor", "jobid").agg(F.min("depth").alias("depth"))
    return rows.select(X.unpacked_id(F.col("ancestor")).alias("ancestor"), X.unpacked_id(F.col("jobid")).alias("jobid"), "depth")


def _parents_only(linked: DataFrame, parents: DataFrame, max_rows: int) -> DataFrame:
    """The rows whose jobid is some row's parent, by the parents' hashes; another one now and then does no harm."""
    hashed = linked.withColumn("_hash", F.xxhash64("jobid"))
    if fits_broadcast(parents, max_rows):
        return hashed.join(F.broadcast(parents), "_hash", "left_semi")
    table = BitTable(parents.select("_hash"), parents.count())
    likely = table.flag(linked, F.col("jobid"), "_likely").filter("_likely").select(
        "jobid", "jparent_jobid", F.xxhash64("jobid").alias("_hash"))
    return likely.join(parents.select("_hash"), "_hash", "left_semi")


def _with_parents(edges: DataFrame, known: DataFrame, parents: DataFrame, max_rows: int) -> DataFrame:
    """``edges`` joined with what is known of ``above``; the counts of ``parents`` tell which are spread over tasks."""
    if fits_broadcast(known, max_rows):
        return edges.drop("_hash").join(F.broadcast(known), "above")
    hot = bounded_hot_keys(lambda share: parents.select(
        "_hash", F.ceil(F.col("n_below") / share).cast("int").alias("n_salts")).filter("n_salts > 1"), NARROW_ROWS)
    known = known.withColumn("_hash", F.xxhash64(X.unpacked_id(F.col("above"))))
    return salted_join(edges, known, ["above"], "inner", hot, F.col("jobid"), hot_on=["_hash"])
