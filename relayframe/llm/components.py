"""Connected components by alternating large and small stars, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relayframe.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                    F.bit_xor(F.xxhash64("v", "u")).alias("y")).first()
    return row["n"], row["x"], row["y"]


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` edges to ``(node, component)``: the smallest node that each node reaches.

    Every node of an edge is listed once, the smallest of a component too. Edges with a null end
    and loops link nothing; repeated edges count once; no edges give no rows. Each round is
    written to the shared folder, so the lineage stays short and a lost executor costs one round.
    The driver sees one row of counters per round. A hub is a join key only against one row of
    its own, which a skewed join splits.
    """
    links = edges.select("u", "v").where("u <> v").distinct()
    links = cut_lineage(links, "links")
    seen = _state(links)
    while seen[0]:
        stars = cut_lineage(_small_star(_large_star(links).distinct()).distinct(), "stars")
        now = _state(stars)
        links = stars
        if now == seen:
            break
        seen = now
    members = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
