"""Homomorphic multiset fingerprints of documents.

A paragraph hashes to a wide vector; a document's fingerprint is the sum of its paragraphs'
vectors, each coordinate modulo a power of two. The sum forgets the order of paragraphs, and a
paragraph is added or taken away by adding or subtracting its vector. ``EQUAL`` coordinates are
uniform hashes of the whole paragraph and decide equality. ``NEAR`` coordinates are the sums of
the hash bits of the paragraph's word pairs: twice such a count less the number of pairs is a sum
of signs, and products of two documents' signs estimate how much text they share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relayframe.llm.tables import read

#: Coordinates modulo 2**32 of whole paragraphs: 8 * 32 bits.
EQUAL = 8
#: Words of two counters modulo 2**32, one for each bit of a 64-bit hash.
NEAR = 32
_TWO = (1 << 32) | 1
_LOW = (1 << 32) - 1


def paragraph_vectors(texts: DataFrame, *keys: str) -> DataFrame:
    """``keys``, ``text`` to one row per paragraph and word pair with its share of the vector.

    Paragraphs end at a line feed; null has none, empty paragraphs count. The vector of a
    paragraph is the sum of its rows.
    """
    pairs = F.zip_with("words", F.slice("words", 2, F.size("words")), lambda w, after: F.xxhash64(w, after))
    whole = [F.xxhash64(F.lit(i), F.col("paragraph")).alias(f"w{i}") for i in range(EQUAL // 2)]
    paragraphs = texts.select(*keys, F.explode(F.split("text", "\n")).alias("paragraph"))
    rows = paragraphs.select(*keys, *whole, F.split("paragraph", r"[\x20\x09-\x0D]+").alias("words"))
    rows = rows.select(
        *keys, *[f"w{i}" for i in range(EQUAL // 2)], F.posexplode(pairs).alias("at", "pair"))
    first = [F.when(F.col("at") == 0, F.col(f"w{i}")).otherwise(F.lit(0)).alias(f"w{i}")
             for i in range(EQUAL // 2)]
    return rows.select(*keys, *first, "pair")


def fingerprint_sums() -> list[Column]:
    """Aggregates over ``paragraph_vectors`` to the coordinates ``e0..``, ``n0..`` and ``pairs``."""
    equal = []
    for i in range(EQUAL // 2):
        low, high = F.col(f"w{i}").bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(f"w{i}", 32)
        equal += [F.sum(low).alias(f"e{2 * i}"), F.sum(high).alias(f"e{2 * i + 1}")]
    near = [F.sum(F.shiftrightunsigned("pair", i).bitwiseAND(F.lit(_TWO))).alias(f"n{i}")
            for i in range(NEAR)]
    return [*equal, *near, F.count("pair").alias("pairs")]


def fingerprint_array() -> Column:
    """The coordinates as one array: EQUAL sums modulo 2**32, NEAR packed sums, the pair count."""
    equal = [F.coalesce(F.col(f"e{i}"), F.lit(0)).bitwiseAND(F.lit(_LOW)) for i in range(EQUAL)]
    near = [F.coalesce(F.col(f"n{i}"), F.lit(0)) for i in range(NEAR)]
    return F.array(*equal, *near, F.coalesce("pairs", F.lit(0)))


def _added(left: Column, right: Column, sign: int) -> Column:
    def one(x: Column, y: Column) -> Column:
        low = (x.bitwiseAND(F.lit(_LOW)) + sign * y.bitwiseAND(F.lit(_LOW))).bitwiseAND(F.lit(_LOW))
        high = (F.shiftrightunsigned(x, 32) + sign * F.shiftrightunsigned(y, 32)).bitwiseAND(F.lit(_LOW))
        return F.shiftleft(high, 32).bitwiseOR(low)

    return F.zip_with(left, right, one)


def insert(fingerprint: Column, paragraphs: Column) -> Column:
    """The fingerprint after the text of another fingerprint is added."""
    return _added(fingerprint, paragraphs, 1)


def delete(fingerprint: Column, paragraphs: Column) -> Column:
    """The fingerprint after the text of another fingerprint is taken away."""
    return _added(fingerprint, paragraphs, -1)


def fingerprint_hex(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(left: Column, right: Column) -> Column:
    """0 to 1: the estimated cosine of the word pair counts behind two fingerprints.

    Equal fingerprints give 1, an empty text against another 0.
    """
    def signs(fingerprint: Column) -> Column:
        words, n = F.slice(fingerprint, EQUAL + 1, NEAR), fingerprint[EQUAL + NEAR]
        halves = F.concat(F.transform(words, lambda w: w.bitwiseAND(F.lit(_LOW))),
                          F.transform(words, lambda w: F.shiftrightunsigned(w, 32)))
        return F.transform(halves, lambda half: (2 * half - n).cast("double"))

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    a, b = signs(left), signs(right)
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    cosine = F.coalesce(F.try_divide(dot(a, b), size), F.lit(0.0))
    return F.when(left == right, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def _buckets(docs: DataFrame, per_partition: int = 4) -> list:
    """Upper bounds of doc_id ranges, as many as a few for each shuffle partition."""
    spark = docs.sparkSession
    n = per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    points = [i / n for i in range(1, n)]
    row = docs.agg(F.percentile_approx("doc_id", points, 10 * n).alias("bounds")).first()
    return sorted(set(row["bounds"] or []))


def with_next(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with the text of the next in descending doc_id order.

    After the last row comes the first again; a single row follows itself. Null doc_ids come last;
    rows of one doc_id go by text. Gives ``bucket, place, doc_id, text, next_text`` with the rows
    of a bucket together; (bucket, place) names a row. Rows marked ``guest`` stand at the end of a
    bucket: the first row of the next one.

    Ranges of doc_id are buckets, so texts move once. Only the first row of a bucket is copied to
    the bucket before it, so no task sees more than its range.
    """
    bounds = _buckets(docs)
    ordered = F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length() + 1))])
    # How many bounds lie below the id, by halving steps.
    below = F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(
        F.get(ordered, at + step - 1) < F.col("doc_id"), step).otherwise(0))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), -1).otherwise(below))
    heads = rows.groupBy("bucket").agg(F.max("doc_id").alias("head"))
    # One row a bucket: the order of buckets is a window over as many rows as there are ranges.
    ring = Window.orderBy(F.col("bucket"))
    heads = heads.select("bucket", "head", F.lead("bucket").over(ring).alias("to"),
                         F.min("bucket").over(Window.partitionBy()).alias("least"))
    heads = heads.select("bucket", "head", F.coalesce("to", "least").alias("to"))
    first = (rows.join(F.broadcast(heads), "bucket")
             .where(F.col("doc_id").eqNullSafe(F.col("head")))
             .groupBy("to").agg(F.max(F.struct("doc_id", "text")).alias("first"))
             .select(F.col("to").alias("bucket"), "first.doc_id", "first.text"))
    every = (rows.withColumn("guest", F.lit(False))
             .unionByName(first.withColumn("guest", F.lit(True)), allowMissingColumns=True))
    order = Window.partitionBy("bucket").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc("text"))
    return every.select("bucket", F.row_number().over(order).alias("place"), "guest", "doc_id", "text",
                        F.lead("text").over(order).alias("next_text"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of the text with its second half replaced, and their likeness.

    Needs ``doc_id, text`` of ``docs``. Null texts count as empty. One row per row of ``docs``.
    """
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
                      F.substring("next_text", F.lit(1), half))
    rows = rows.select(
        "bucket", "place", "guest", "doc_id", "n_chars",
        F.when(~F.col("guest"), F.sha2(edited, 256)).alias("edited_sha256"),
        F.posexplode(F.when(F.col("guest"), F.array("text")).otherwise(F.array("text", edited)))
        .alias("side", "text"))
    keys = ["bucket", "place", "guest", "doc_id", "n_chars", "edited_sha256", "side"]
    prints = (paragraph_vectors(rows, *keys).groupBy(*keys).agg(*fingerprint_sums())
              .select(*keys, fingerprint_array().alias("own")))
    # A row and its edited text stand side by side, then comes the next row.
    order = Window.partitionBy("bucket").orderBy("place", "side")
    beside = prints.select(*keys, "own", F.lead("own", 1).over(order).alias("edited"),
                           F.lead("own", 2).over(order).alias("next"))
    return beside.where("side = 0 AND NOT guest").select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint_hex(F.col("own")).alias("fingerprint"),
        fingerprint_hex(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"))


def op2_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprint_edits(read(spark, sf_dir, "documents"))
