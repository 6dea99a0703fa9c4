"""Line dedup over levelled sorted runs of line hashes.

A batch of documents is counted by line hash, hashed to buckets and sorted in each, with the number
of documents and the largest doc_id holding it. A merge anti join with all earlier runs leaves the
hashes that are new: they are the batch's run, so a hash is in one run only. The others are updates,
kept beside the runs and added to them in the end. All have the same buckets, so joins neither move
nor sort them again. When a level holds ``FANOUT`` runs or updates they are merged into one of the next
level; a hash is thus rewritten once a level.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relayframe.llm.tables import BLANKS, ascii_lower, read
from relayframe.session import cut_lineage, work_path

MIN_CHARS, MIN_DOCS = 40, 5
FANOUT = 3
#: Batches of the registered query, by ranges of a hash of doc_id.
BATCHES = 4
HASH_BYTES = 16


def line_key(line: Column) -> Column:
    """The line with ``[\\x20\\x09-\\x0D]`` stripped at both ends and A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Distinct ``(doc_id, h)``: 16-byte hashes of the line keys of ``min_chars`` and more.

    Null texts have no such line; rows without a doc_id hold none. Rows of one doc_id are one
    document.
    """
    lines = (docs.where("doc_id IS NOT NULL")
             .select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
             .select("doc_id", line_key(F.col("line")).alias("key")))
    return (lines.where(F.length("key") >= min_chars)
            .select("doc_id", F.unhex(F.md5("key")).alias("h")).distinct())


class LineRuns:
    """Sorted runs of ``h, n_docs, last_doc``, and updates of them, by level, in tables below the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, n_buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.n_buckets = n_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.updates: list[list[str]] = [[]]

    def _write(self, rows: DataFrame, in_place: bool = False) -> str:
        """Writes a table; rows joined ``in_place`` already lie in its buckets."""
        name = f"line_run_{uuid.uuid4().hex}"
        rows = rows if in_place else rows.repartition(self.n_buckets, "h")
        (rows.write.bucketBy(self.n_buckets, "h").sortBy("h")
         .option("path", work_path(self.spark, name)).saveAsTable(name))
        return name

    def _runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _without(self, batch: str, runs: list[str]) -> DataFrame:
        """The rows of a batch whose hashes are in none of the runs."""
        rows = self.spark.table(batch)
        for run in runs:
            rows = rows.join(self.spark.table(run).select("h").hint("merge"), "h", "left_anti")
        return rows

    def add(self, lines: DataFrame) -> DataFrame:
        """Takes the ``(doc_id, h)`` of a batch of new documents; returns the hashes no run held.

        The rows returned are ``h, n_docs, last_doc`` of this batch, an anti join of its counts, which are
        written first, with each earlier run. They are written as the batch's run, and the rest as its updates.
        """
        counts = lines.groupBy("h").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))
        earlier, batch = self._runs(), self._write(counts)
        novel = self._without(batch, earlier)
        if not earlier:
            self.levels[0].append(batch)
            return novel
        run = self._write(novel, in_place=True)
        self.updates[0].append(self._write(self._without(batch, [run]), in_place=True))
        self.levels[0].append(run)
        return novel

    def compact(self) -> None:
        """Merges the tables of every full level into one of the next."""
        for levels in (self.levels, self.updates):
            for depth in range(len(levels)):
                if len(levels[depth]) < self.fanout:
                    continue
                if depth + 1 == len(levels):
                    levels.append([])
                levels[depth + 1].append(self._write(self._merged(levels[depth])))
                levels[depth] = []

    def _merged(self, names: list[str]) -> DataFrame:
        # A union of bucketed tables counts as bucketed, but its partitions hold one table each, so
        # an aggregate right above it would keep a hash once a table. The cut names the hash anew.
        parts = [self.spark.table(name).select(F.substring("h", 1, HASH_BYTES).alias("h"), "n_docs", "last_doc")
                 for name in names]
        rows = reduce(DataFrame.unionByName, parts)
        return rows.groupBy("h").agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def merged(self) -> DataFrame:
        """All hashes with their counts over every batch so far: those of the runs, and what updates add to them."""
        updates = [name for level in self.updates for name in level]
        if len(updates) > 1:
            updates = [self._write(self._merged(updates))]
            self.updates = [[] for _ in self.updates[1:]] + [updates]
        parts = []
        for run in self._runs():
            rows = self.spark.table(run)
            for name in updates:
                later = self.spark.table(name).toDF("h", "n_later", "last_later").hint("merge")
                rows = rows.join(later, "h", "left").select(
                    "h", (F.col("n_docs") + F.coalesce("n_later", F.lit(0))).alias("n_docs"),
                    F.greatest("last_doc", "last_later").alias("last_doc"))
            # As in _merged: a union of bucketed tables must not count as bucketed.
            parts.append(rows.select(F.substring("h", 1, HASH_BYTES).alias("h"), "n_docs", "last_doc"))
        return reduce(DataFrame.unionByName, parts)


_KEPT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_dropped", T.LongType())])


@F.pandas_udf(_KEPT)
def _without(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    def one(text: str | None, drop) -> tuple[str | None, int]:
        if text is None or drop is None:
            return None, 0
        gone, kept = set(drop), []
        lines = text.split("\n")
        for line in lines:
            key = line.strip(BLANKS).encode().lower()
            if hashlib.md5(key, usedforsecurity=False).digest() not in gone:
                kept.append(line)
        return "\n".join(kept), len(lines) - len(kept)

    for texts, drops in batches:
        yield pd.DataFrame([one(t, d) for t, d in zip(texts, drops, strict=True)], columns=["text", "n_dropped"])


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                        batches: int = BATCHES) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped``: texts without lines that many documents share.

    A key of ``min_chars`` characters found in ``min_docs`` documents keeps its lines in the
    largest doc_id holding it, all of them, and loses them elsewhere. Shorter lines always stay.
    Null text counts as one empty line. Rows without a doc_id stay as they are. Every row of
    ``docs`` gives one row.

    Counts come from the runs that batches founded and their updates; only hashes move until the last join, which
    moves each text once. A line that a third of the documents share is a hot key of a join that can be
    split, against one row.
    """
    spark = docs.sparkSession
    lines = cut_lineage(line_hashes(docs, min_chars)
                        .withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches))), "lines")
    runs = LineRuns(spark)
    for batch in range(batches):
        runs.add(lines.where(F.col("batch") == batch))
        runs.compact()
    shared = runs.merged().where(F.col("n_docs") >= min_docs)
    drops = (lines.join(shared, "h").where("doc_id < last_doc")
             .groupBy("doc_id").agg(F.collect_list("h").alias("gone")))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(drops, "doc_id", "left")
    touched = F.col("gone").isNotNull()
    rows = rows.select("doc_id", "text", F.size(F.split("text", "\n")).cast("long").alias("n_lines"), touched.alias("touched"),
                       _without(F.when(touched, F.col("text")), "gone").alias("kept"))
    return rows.select(
        "doc_id", F.when(F.col("touched"), F.col("kept.text")).otherwise(F.col("text")).alias("text"),
        "n_lines", F.col("kept.n_dropped").alias("n_dropped"))


def op5_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup of all documents."""
    kept = drop_repeated_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL_OP5 = r"""
WITH rows AS (
  SELECT row_number() OVER () AS row_no, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT row_no, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS line_no FROM rows
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), shared AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 40 AND doc_id IS NOT NULL
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.*, coalesce(k.doc_id < s.last_doc, false) AS gone FROM keyed k LEFT JOIN shared s USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY row_no, doc_id
"""
