"""Near-duplicate documents: fast similarity sketches, banding, verification on full sets.

Documents with one shingle set are one class, so copies cost one row each. A class is sketched
once; classes that share a band are candidates. First every class of a band is held against the
band's smallest class only, which joins large groups of close copies by as many pairs as members.
Then the pairs of a band that are still in different components are held against each other,
where their sizes and sketch bits allow the similarity. Every link is confirmed on the full
sets, and no pair that shares a band is left out, but those whose sketch bits lie more than 4.5
standard deviations below what the similarity gives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relayframe.llm import shingles as sh
from relayframe.llm.components import components
from relayframe.llm.tables import fresh, lean, read
from relayframe.session import cut_lineage

#: Coordinates in a band, and in a sketch, all of which count when candidates are compared.
ROWS, COORDINATES = 8, 1024
#: Pieces into which the partners of one document are split for verification.
SALTS = 256
_SKETCH = "doc_id long, n_shingles long, digest binary, bands array<long>, bits array<long>"


def _sketcher(size: int, bands: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                found = sh.shingle_set(text.as_py() or "", size)
                if len(found):
                    sketch = sh.similarity_sketch(found, max(COORDINATES, bands * ROWS))
                    rows.append((len(found), sh.set_digest(found), sh.band_keys(sketch[: bands * ROWS], ROWS), sh.sketch_bits(sketch)))
                else:
                    rows.append((0, None, None, None))
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns],
                                             ["doc_id", "n_shingles", "digest", "bands", "bits"])

    return run


def _verifier(size: int, percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for batch in batches:
            found = []
            for key, a, b, text in zip(*(batch.column(c) for c in ("key", "a", "b", "text")), strict=True):
                own = sh.shingle_set(text.as_py() or "", size)
                digest = sh.set_digest(own)
                if b.as_py() is None:
                    # Rows of one doc_id may have other texts; the digest tells them apart.
                    if digest == a.as_py():
                        now, held = key.as_py(), own
                elif digest == b.as_py() and now == key.as_py():
                    shared = len(np.intersect1d(held, own, assume_unique=True))
                    if 100 * shared >= percent * (len(held) + len(own) - shared):
                        found.append((a.as_py(), b.as_py()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], pa.binary()) for i in (0, 1)], ["u", "v"])

    return run


def verify_pairs(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of classes whose full sets reach the similarity, as ``(u, v)``.

    The text of ``a`` goes ahead of its partners' texts, once for each of ``SALTS`` pieces that
    has partners; a task holds one set and passes the partners by. Only texts of candidates move.
    """
    salted = pairs.withColumn("key", F.concat(F.col("a"), F.hex(F.pmod(F.xxhash64("b"), F.lit(SALTS))).cast("binary")))
    named = classes.select("digest", "doc_id")
    heads = salted.select("key", "a").distinct().join(named.withColumnRenamed("digest", "a"), "a")
    tails = salted.join(named.withColumnRenamed("digest", "b"), "b")
    wanted = (heads.select("doc_id", "key", "a", F.lit(None).cast("binary").alias("b"))
              .unionByName(tails.select("doc_id", "key", "a", "b")))
    texts = wanted.join(docs.select("doc_id", "text"), "doc_id").select("key", "a", "b", "text")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = texts.repartition(n, "key").sortWithinPartitions("key", F.asc_nulls_first("b"))
    return rows.mapInArrow(lean(_verifier(size, percent)), "u binary, v binary").distinct()


def _alike(a: str, b: str, percent: int, words: int) -> Column:
    """Whether sizes and sketch bits of two rows leave room for the similarity."""
    def different(i: int) -> Column:
        x = F.col(f"{a}.bits")[i].bitwiseXOR(F.col(f"{b}.bits")[i])
        return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))

    differ = sum((different(i) for i in range(words)), F.lit(0))
    return ((100 * F.least(f"{a}.n_shingles", f"{b}.n_shingles")
             >= percent * F.greatest(f"{a}.n_shingles", f"{b}.n_shingles"))
            & (differ <= sh.most_different(percent / 100, words * 32)))


def near_components(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (doc_id, text).

    Two documents are linked if the Jaccard similarity of their sets of ``size``-word shingles is
    ``percent`` hundredths or more. ``component_id`` is the smallest doc_id of the component, and
    ``kept`` is true where it is the row's own. Texts without a word, and null, have no set and
    are alone. Repeated rows are one class. A row without a doc_id joins those with an equal set only,
    near ones are not looked for; without any doc_id ``component_id`` is null, and the rows are kept.
    """
    bands = sh.bands_needed(percent / 100, ROWS)
    words = max(COORDINATES, bands * ROWS) // 32
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = cut_lineage(rows.mapInArrow(lean(_sketcher(size, bands)), _SKETCH), "sketches")
    sets = sketched.where("n_shingles > 0")
    classes = cut_lineage(sets.where("doc_id IS NOT NULL").dropDuplicates(["digest"]), "classes")
    banded = classes.select("digest", F.explode("bands").alias("band"))
    shared = (banded.groupBy("band").agg(F.min("digest").alias("low"), F.max("digest").alias("high"),
                                         F.count(F.lit(1)).alias("n")).where("low < high").select("band", "n"))
    members = cut_lineage(banded.join(shared, "band"), "members")
    # The text that others were copied from shares more bands than any copy, so it is the hub.
    degrees = members.groupBy("digest").agg(F.sum("n").alias("degree"))
    hubs = (members.join(degrees, "digest").groupBy("band")
            .agg(F.max(F.struct("degree", "digest")).alias("best")).select("band", F.col("best.digest").alias("hub")))

    marks = classes.select("digest", "n_shingles", "bits", "bands")
    near = marks.join(members.select("digest").distinct(), "digest", "left_semi")
    near = cut_lineage(near, "marks")

    star = (members.join(hubs, "band").where("digest <> hub")
            .select(F.col("hub").alias("a"), F.col("digest").alias("b")).distinct())
    x, y = near.alias("x"), near.alias("y")
    star = (star.join(x, F.col("a") == F.col("x.digest")).join(y, F.col("b") == F.col("y.digest"))
            .where(_alike("x", "y", percent, words)).select("a", "b"))
    star = cut_lineage(star, "star-pairs")
    linked = cut_lineage(verify_pairs(star, classes, rows, size, percent), "star-links")
    groups = components(linked).withColumnRenamed("node", "digest")

    label = F.coalesce("component", "digest")
    placed = members.select("band", "digest").join(groups, "digest", "left").select("band", "digest", label.alias("label"))
    open_bands = (placed.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"))
                  .where("low < high").select("band"))
    rest = placed.join(open_bands, "band").join(near, "digest").withColumn("at", F.array_position("bands", F.col("band")))
    rest = cut_lineage(rest, "open-members")
    x, y = rest.alias("x"), rest.alias("y")
    # A pair that shares several bands is met in the first of them only.
    shared_at = F.array_position(F.zip_with("x.bands", "y.bands", lambda s, t: s == t), True)
    cross = (x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.digest") < F.col("y.digest"))
                    & (F.col("x.label") != F.col("y.label")) & _alike("x", "y", percent, words)
                    & (shared_at == F.col("x.at")))
             .select(F.col("x.digest").alias("a"), F.col("y.digest").alias("b")).distinct()
             .join(star, ["a", "b"], "left_anti"))
    more = verify_pairs(cut_lineage(cross, "cross-pairs"), classes, rows, size, percent)
    groups = components(linked.unionByName(more)).withColumnRenamed("node", "digest")

    named = sketched.select("doc_id", "n_shingles", "digest").join(groups, "digest", "left")
    named = named.select("doc_id", "n_shingles", label.alias("label"))
    least = named.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    out = named.join(least, "label", "left").select(
        "doc_id", "n_shingles", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"))
    return out.withColumn("kept", F.col("component_id").isNull() | F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def one_of_each(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The rows of ``docs`` whose doc_id is that of their component, with all columns.

    Of repeated rows one stays. Rows without a doc_id stay, as no component can name them.
    """
    name, again = fresh(docs, "kept"), fresh(docs, "again")
    kept = near_components(docs, size, percent).where("kept").select(F.col("doc_id").alias(name)).distinct()
    named = docs.join(kept, F.col("doc_id") == F.col(name), "left_semi")
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    # Rows of one doc_id are in one task already; of those with one text the first stays.
    last = F.lag(F.xxhash64("text")).over(order)
    named = named.withColumn(again, F.coalesce(last == F.xxhash64("text"), F.lit(False))).where(~F.col(again)).drop(again)
    return named.unionByName(docs.where("doc_id IS NULL"))


def op7_similarity_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 85 of 100 three-word shingles."""
    return near_components(read(spark, sf_dir, "documents"), 3, 85)
