"""N-gram Jaccard join by vertical partitions of the global n-gram order.

The order is that of the n-grams' 64-bit hashes, so cutting it needs no statistics and no n-gram is
favoured. It is cut three times, each time into fragments, no two of which share an n-gram:

* Finely, for candidates. Two sets of sizes x and y that reach the similarity differ in at most
  ``allowed`` n-grams, so of more fragments than that one holds the same n-grams in both. Equal
  non-empty segments are an equality join, and a frequent n-gram counts only with all its segment.
* Into ``SKETCH_WORDS`` fragments of 64 parity bits each. Differing bits, summed over the fragments,
  never exceed the n-grams in which two sets differ, which rules out candidates without error.
* Coarsely, for counting. Segments of at most about ``SEGMENT`` n-grams are intersected each by itself,
  and the partial overlaps of a pair are summed. No task holds more than a segment of a set.

Documents with equal sets are one class, so copies cost one row each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relayframe.llm import shingles as sh
from relayframe.llm.components import components
from relayframe.llm.tables import read
from relayframe.session import cut_lineage

#: Sizes are classed in ranges that grow by this factor; a class has this many fragments for every
#: n-gram in which a pair of it may differ.
GROWTH, SLACK = 1.3, 1.5
#: Least similarity in hundredths for which the fragments of every set can outnumber the differences.
LEAST_PERCENT = 75
SKETCH_WORDS = 16
#: N-grams in a segment that is intersected, and pieces into which the partners of a set are dealt.
SEGMENT, SALTS = 4096, 64
_SKETCH = ("doc_id long, text_key long, n_shingles long, digest binary, segments array<long>, bits array<long>")


def allowed(x: int, y: int, percent: int) -> int:
    """In how many elements sets of these sizes may differ to reach the similarity."""
    return (100 - percent) * (x + y) // (100 + percent)


def size_classes(percent: int, up_to: int = 1 << 32) -> list[tuple[int, int, int, int]]:
    """``(low, high, differences, fragments)`` of each class of sizes, ``high`` included.

    A pair belongs to the class of its smaller set; ``differences`` is the most that any of its
    pairs may have.
    """
    found, low = [], 1
    while low <= up_to:
        high = max(low, int(low * GROWTH) - 1)
        most = allowed(high, 100 * high // percent, percent)
        found.append((low, high, most, int(SLACK * (most + 1)) + 1))
        low = high + 1
    return found


def _keys(grams: np.ndarray, at: int, seed: int, fragments: int) -> np.ndarray:
    """One key for each non-empty segment of a sorted set; equal segments have equal keys."""
    if seed:
        grams = np.sort(sh.mix(grams ^ sh.mix(np.array([seed], np.uint64))))
    fragment = (grams >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)
    first = np.flatnonzero(np.diff(fragment, prepend=np.uint64(1 << 63)))
    name = sh.mix(fragment[first] + np.uint64((at << 48) + (seed << 32)))
    return sh.mix(np.add.reduceat(sh.mix(grams), first) + name)


def segment_keys(grams: np.ndarray, classes: list[tuple], percent: int) -> np.ndarray:
    """Keys of a set such that any two sets which reach the similarity have one in common.

    Should a set have too few non-empty segments, it is cut by further orders too until one of them
    gives enough. Of a pair, the set that is done earlier has enough in an order that both are cut by.
    """
    n, found = len(grams), []
    at = next(i for i, c in enumerate(classes) if c[1] >= n)
    own = at
    while at >= 0 and (at == own or 100 * classes[at][1] >= percent * n):
        _, _, most, fragments = classes[at]
        seed, enough = 0, most == 0  # without differences only equal sets are linked
        while not enough:
            keys = _keys(grams, at, seed, fragments)
            found.append(keys)
            seed, enough = seed + 1, len(keys) > most
        at -= 1
    return np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)


def parity(grams: np.ndarray) -> np.ndarray:
    """Whether the number of elements is odd, for each of 64 places in each fragment of the order."""
    width = (SKETCH_WORDS * 64).bit_length() - 1
    odd = np.bincount((grams >> np.uint64(64 - width)).astype(np.int64), minlength=SKETCH_WORDS * 64) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _sketcher(size: int, percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = size_classes(percent)
        kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                grams = sh.shingle_set(text.as_py() or "", size)
                if len(grams):
                    rows.append((len(grams), sh.set_digest(grams), segment_keys(grams, classes, percent), parity(grams)))
                else:
                    rows.append((0, None, None, None))
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), *columns],
                                             ["doc_id", "text_key", "n_shingles", "digest", "segments", "bits"])

    return run


def _level(n: Column) -> Column:
    """Into how many halves of halves a set of ``n`` is cut for counting."""
    return F.greatest(F.lit(0), F.ceil(F.log2(n / F.lit(float(SEGMENT))))).cast("int")


def _cutter(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for node, digest, level, text in zip(*(batch.column(c) for c in ("node", "digest", "level", "text")), strict=True):
                grams = sh.shingle_set(text.as_py() or "", size)
                if sh.set_digest(grams) == digest.as_py():
                    halves = level.as_py()
                    bounds = np.searchsorted(grams, np.arange(1, 1 << halves, dtype=np.uint64) << np.uint64(64 - halves))
                    found += [(node.as_py(), f, part.tobytes()) for f, part in enumerate(np.split(grams, bounds)) if len(part)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))],
                ["node", "fragment", "grams"])

    return run


def _segments(nodes: DataFrame, marks: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """``node, fragment, grams`` of the given nodes, written. Only their texts move."""
    wanted = nodes.join(marks.select("node", "digest", "first_id", "text_key", _level(F.col("n")).alias("level")), "node")
    texts = wanted.join(docs, (wanted.text_key == docs.text_key) & wanted.first_id.eqNullSafe(docs.doc_id)).select(
        "node", "digest", "level", "text")
    cut = texts.mapInArrow(_cutter(size), "node long, fragment long, grams binary")
    # Rows of one text that share a doc_id, or have none, are met more than once.
    return cut_lineage(cut.dropDuplicates(["node", "fragment"]), "segments")


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, held = None, None
    for batch in batches:
        found = []
        for key, a, b, grams in zip(*(batch.column(c) for c in ("key", "a", "b", "grams")), strict=True):
            own = np.frombuffer(grams.as_py(), np.uint64)
            if b.as_py() is None:
                now, held = key.as_py(), own
            elif now == key.as_py():
                found.append((a.as_py(), b.as_py(), len(np.intersect1d(held, own, assume_unique=True))))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(3)], ["a", "b", "shared"])


def verified(pairs: DataFrame, marks: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``a, b, shared`` of the pairs ``(a, b)`` that reach the similarity.

    Each fragment of a pair is counted by itself and the counts are summed. The segment of ``a`` goes
    ahead of those of its partners, once for each of ``SALTS`` pieces that has any.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = marks.select("node", "n")
    sized = cut_lineage(pairs.join(sizes.toDF("a", "n_a"), "a").join(sizes.toDF("b", "n_b"), "b"), "pairs")
    nodes = sized.select(F.col("a").alias("node")).unionByName(sized.select(F.col("b").alias("node"))).distinct()
    segments = _segments(nodes, marks, docs, size)
    # Where the two are cut differently, the finer cut counts: its segment meets the coarser one's.
    level = F.greatest(_level(F.col("n_a")), _level(F.col("n_b")))
    split = sized.withColumn("level", level).withColumn("f", F.explode(F.sequence(F.lit(0), F.expr("shiftleft(1L, level) - 1"))))
    split = split.withColumns({
        "key": F.concat_ws(".", "a", "f", F.pmod(F.xxhash64("b"), F.lit(SALTS))),
        "f_a": _coarser("n_a"), "f_b": _coarser("n_b")})
    heads = split.select("key", "a", F.col("f_a").alias("fragment")).distinct().join(
        segments.withColumnRenamed("node", "a"), ["a", "fragment"]).select("key", "a", F.lit(None).cast("long").alias("b"), "grams")
    tails = split.select("key", "a", "b", F.col("f_b").alias("fragment")).join(
        segments.withColumnRenamed("node", "b"), ["b", "fragment"]).select("key", "a", "b", "grams")
    rows = heads.unionByName(tails).repartition(n, "key").sortWithinPartitions("key", F.asc_nulls_first("b"))
    parts = rows.mapInArrow(_overlaps, "a long, b long, shared long")
    total = parts.groupBy("a", "b").agg(F.sum("shared").alias("shared")).join(sized, ["a", "b"])
    return total.where(100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))).select("a", "b", "shared")


def _coarser(size: str) -> Column:
    """The fragment of a set's own cut that holds fragment ``f`` of the pair's cut."""
    return F.floor(F.col("f") / F.pow(F.lit(2), F.col("level") - _level(F.col(size)))).cast("long")


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether sizes and parities of two rows leave room for the similarity; never wrongly false."""
    x, y = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = sum((F.bit_count(F.col(f"{a}.bits")[i].bitwiseXOR(F.col(f"{b}.bits")[i])) for i in range(SKETCH_WORDS)), F.lit(0))
    return (100 * F.least(x, y) >= percent * F.greatest(x, y)) & ((100 + percent) * differ <= (100 - percent) * (x + y))


class Prepared:
    """Classes of equal sets and the segments that more than one class holds, all written."""

    def __init__(self, docs: DataFrame, size: int, percent: int):
        if not LEAST_PERCENT <= percent <= 100:
            raise ValueError(f"percent must be {LEAST_PERCENT} to 100")
        self.size, self.percent = size, percent
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
        self.rows = cut_lineage(self.docs.mapInArrow(_sketcher(size, percent), _SKETCH), "sets")
        sets = self.rows.where("n_shingles > 0")
        # The first row of a class is the one with the smallest doc_id; one without a doc_id comes last.
        first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first")
        classes = sets.groupBy("digest").agg(first, F.first("n_shingles").alias("n"), F.first("segments").alias("segments"),
                                             F.first("bits").alias("bits"))
        self.classes = cut_lineage(classes.select(
            F.monotonically_increasing_id().alias("node"), "digest", F.col("first.doc_id").alias("first_id"),
            F.col("first.text_key").alias("text_key"), "n", "segments", "bits"), "classes")
        self.marks = self.classes.select("node", "digest", "first_id", "text_key", "n", "bits")
        held = self.classes.select("node", F.explode("segments").alias("segment"))
        shared = held.groupBy("segment").agg(F.min("node").alias("low"), F.max("node").alias("high"),
                                             F.count(F.lit(1)).alias("held_by")).where("low < high").select("segment", "held_by")
        self.members = cut_lineage(held.join(shared, "segment"), "members")

    def possible(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` that sizes and parities do not rule out."""
        near = self.marks.select("node", "n", "bits")
        x, y = near.alias("x"), near.alias("y")
        return (pairs.join(x, F.col("a") == F.col("x.node"))
                .join(y, (F.col("b") == F.col("y.node")) & _possible("x", "y", self.percent)).select("a", "b"))

    def verified(self, pairs: DataFrame) -> DataFrame:
        return verified(pairs, self.marks, self.docs, self.size, self.percent)

    def candidates(self, members: DataFrame, apart: Column | None = None) -> DataFrame:
        """Pairs that share one of the given segments and may reach the similarity."""
        rows = members.join(self.marks.select("node", "n", "bits"), "node")
        x, y = rows.alias("x"), rows.alias("y")
        meet = ((F.col("x.segment") == F.col("y.segment")) & (F.col("x.node") < F.col("y.node"))
                & _possible("x", "y", self.percent))
        if apart is not None:
            meet = meet & apart
        return x.join(y, meet).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def similar_pairs(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The whole join: ``(a, b, shared)`` between classes, and ``doc_id, n_shingles, node`` of each document.

    All links between different sets are listed, none of copies, which share a ``node``. Documents
    without a word have a null ``node``.
    """
    made = Prepared(docs, size, percent)
    links = made.verified(cut_lineage(made.candidates(made.members.select("segment", "node")), "candidates"))
    members = made.rows.select("doc_id", "n_shingles", "digest").join(made.classes.select("digest", "node"), "digest", "left")
    return links, members.select("doc_id", "n_shingles", "node")


def joined_components(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (doc_id, text).

    Documents whose sets of ``size``-word shingles have a Jaccard similarity of ``percent`` hundredths
    or more are linked; ``component_id`` is the smallest doc_id that a document reaches. Null and empty
    texts, and those without a word, have no set and are alone. Repeated rows are copies. Rows without a
    doc_id link others like any row; a component of such rows only has a null ``component_id``. An
    empty table gives no rows; columns other than the two are not looked at.

    The holders of a segment are first compared with that holder which shares most; only those that are
    in different components after that are compared with each other. What is skipped joins nothing new.
    """
    made = Prepared(docs, size, percent)
    members = made.members
    degrees = members.groupBy("node").agg(F.sum("held_by").alias("degree"))
    hubs = (members.join(degrees, "node").groupBy("segment")
            .agg(F.max(F.struct("degree", "node")).alias("best")).select("segment", F.col("best.node").alias("a")))
    star = members.join(cut_lineage(hubs, "hubs"), "segment").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    linked = cut_lineage(made.verified(cut_lineage(made.possible(star), "star")).select(
        F.col("a").alias("u"), F.col("b").alias("v")), "star-links")
    label = F.coalesce("component", "node").alias("label")
    placed = members.join(components(linked), "node", "left").select("segment", "node", label)
    placed = cut_lineage(placed, "placed")
    still = placed.groupBy("segment").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    apart = placed.join(cut_lineage(still.select("segment"), "open"), "segment")
    cross = made.candidates(apart, F.col("x.label") != F.col("y.label"))
    more = made.verified(cut_lineage(cross, "cross")).select(F.col("a").alias("u"), F.col("b").alias("v"))
    groups = components(linked.unionByName(more))
    named = made.classes.select("node", "digest", "first_id").join(groups, "node", "left").select("digest", "first_id", label)
    named = cut_lineage(named, "labels")
    least = cut_lineage(named.groupBy("label").agg(F.min("first_id").alias("component_id")), "least")
    named = cut_lineage(named.join(least, "label").select("digest", "component_id"), "named")
    return made.rows.select("doc_id", "n_shingles", "digest").join(named, "digest", "left").select(
        "doc_id", "n_shingles", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op12_vertical_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 90 of 100 three-word shingles."""
    return joined_components(read(spark, sf_dir, "documents"), 3, 90)


SQL_OP12 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'),
    lambda x: x <> '') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g
  FROM words WHERE len(w) > 0),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * shared >= 90 * (s.n + t.n - shared)),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, min(r.b) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN reached r ON r.a = d.doc_id
GROUP BY d.doc_id, s.n
"""
