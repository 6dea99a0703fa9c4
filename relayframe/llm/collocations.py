"""Phrases whose words occur together more often than their parts would by chance.

Texts become blocks of word numbers local to the block. Words that occur often enough get dense ids; no
task holds the vocabulary, as each block is joined, where it lies, with the ids of its own words. A phrase that is
frequent has only frequent words, and its pairs of neighbours are frequent too, so pairs are counted
first and longer phrases only where each pair passes a bit table of the frequent ones, whose size is
bounded and whose errors only add work. Counting is done by quotient filters (``quotient``): each task
writes its filters cut into ranges of the permuted key space, and the filters of a range are merged.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relayframe.llm.quotient import Counting, Filter, Packing
from relayframe.llm.tables import read
from relayframe.operators.numbering import dense_numbers
from relayframe.session import STAGED_CODEC, cut_lineage, work_path

#: A-Z folded, ends of pieces as line feeds, tabs as blanks.
_FOLD = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Tokens of a block, and of all blocks a task has open; keys of a filter; filters merged at once.
BLOCK_TOKENS, OPEN_TOKENS, FILTER_KEYS, MERGE_KEYS = 1 << 19, 1 << 21, 1 << 20, 1 << 20
#: Largest bit table of frequent pairs, as a power of two: 16 MB.
TABLE_BITS = 27
_BLOCKS = "block long, lang string, n_words long, tokens binary, words array<string>, counts array<long>"


class _Numbers(dict):
    """Numbers of words in order of appearance, from 1; a piece's end is 0 and no word is -1."""

    def __init__(self):
        super().__init__({b"\n": 0, b"": -1})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) - 1
        return number


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seq, made = TaskContext.get().partitionId(), 0, {}

    def block(lang: str) -> pa.RecordBatch:
        nonlocal seq
        numbers, texts = made.pop(lang)
        tokens = np.concatenate(texts)
        words = [w.decode() for w in numbers][2:]
        counts = np.bincount(tokens, minlength=len(words) + 1)[1:]
        seq += 1
        values = [(part << 32) + seq, lang, int(counts.sum()), tokens.astype("<u4").tobytes(), words, counts]
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(values, kinds, strict=True)],
                                          ["block", "lang", "n_words", "tokens", "words", "counts"])

    sizes: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            numbers, texts = made.setdefault(lang, (_Numbers(), []))
            tokens = (text.as_py() or b"").translate(_FOLD).replace(b"\n", b" \n ").split(b" ")
            found = np.fromiter(map(numbers.__getitem__, [*tokens, b"\n"]), np.int64, len(tokens) + 1)
            texts.append(found[found >= 0])
            sizes[lang] = sizes.get(lang, 0) + len(texts[-1])
            if sizes[lang] >= BLOCK_TOKENS or sum(sizes.values()) >= OPEN_TOKENS:
                full = max(sizes, key=sizes.get)
                sizes.pop(full)
                yield block(full)
    for lang in list(made):
        yield block(lang)


def _by_block(blocks: DataFrame) -> DataFrame:
    """Blocks written in buckets, so that the ids of their words are joined with them where they lie."""
    spark, name = blocks.sparkSession, f"word_blocks_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (blocks.write.bucketBy(n, "block").option("path", work_path(spark, name)).option("compression", STAGED_CODEC)
     .saveAsTable(name))
    return spark.table(name)


def _renumber(kind: str) -> Callable:
    """Blocks with ids for their frequent words and 0 for all else; runs of 0 are one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for tokens, ids in zip(batch.column("tokens"), batch.column("ids"), strict=True):
                tokens, pairs = np.frombuffer(tokens.as_py(), "<u4"), ids.values
                table = np.zeros(int(tokens.max(initial=0)) + 1, kind)
                table[pairs.field("number").to_numpy()] = pairs.field("id").to_numpy()
                now = table[tokens]
                found.append(now[np.append(True, (now[1:] | now[:-1]) != 0)].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["ids"])

    return run


def _kind(bits: int) -> str:
    return "<u4" if bits <= 32 else "<u8"


def _table_places(ids: np.ndarray, following: np.ndarray, bits: int) -> np.ndarray:
    """Where the bit table keeps pairs of neighbours."""
    mixed = Packing(2, 32).permute([ids.astype(np.uint64) << np.uint64(32) ^ following.astype(np.uint64)])[0]
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def _counter(packing: Packing, kind: str, range_bits: int, table: Broadcast | None, table_bits: int) -> Callable:
    """Filters of pairs, or of the phrases of three and more words whose pairs are in the bit table."""
    def phrases(ids: np.ndarray) -> Iterator[list[np.ndarray]]:
        linked = (ids[:-1] > 0) & (ids[1:] > 0)
        if table is None:
            at = np.flatnonzero(linked)
            yield packing.pack([ids[at], ids[at + 1]])
            return
        at = np.flatnonzero(linked)
        place = _table_places(ids[at], ids[at + 1], table_bits)
        known = np.frombuffer(table.value, np.uint8)[place >> 3] >> (place & 7).astype(np.uint8) & 1
        linked[at[known == 0]] = False
        for n in range(3, packing.words + 1):
            if len(linked) < n - 1:
                return
            at = np.flatnonzero(np.lib.stride_tricks.sliding_window_view(linked, n - 1).all(axis=1))
            yield packing.pack([ids[at + i] for i in range(n)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = Counting(packing, FILTER_KEYS)

        def written(full: Filter | None) -> Iterator[pa.RecordBatch]:
            parts = full.ranges(range_bits) if full else []
            if parts:
                yield pa.RecordBatch.from_arrays([
                    pa.array([at for at, _ in parts], pa.int64()),
                    pa.array([part.encode(range_bits) for _, part in parts], pa.binary())], ["range", "filter"])

        for batch in batches:
            for block in batch.column("ids"):
                for limbs in phrases(np.frombuffer(block.as_py(), kind)):
                    yield from written(counting.add(limbs))
        yield from written(counting.finish())

    return run


def _merger(packing: Packing, range_bits: int, least: int) -> Callable:
    """Merges the filters of each range and gives the phrases that occur often enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []

        def frequent() -> pa.RecordBatch:
            whole = Filter.merged(parts)
            kept = whole.counts >= least
            ids = packing.unpack(packing.restore([x[kept] for x in whole.limbs]))
            rows = pa.array([[i for i in row if i] for row in ids.tolist()], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([rows, pa.array(whole.counts[kept])], ["ids", "f"])

        for batch in batches:
            for at, data in zip(batch.column("range").to_pylist(), batch.column("filter"), strict=True):
                if parts and at != now:
                    yield frequent()
                    parts = []
                now = at
                parts.append(Filter.decode(packing, data.as_py(), at, range_bits))
                # Like sorted runs: small ones are merged when they add up to as much as the first.
                if len(parts) > 1 and sum(map(len, parts[1:])) > max(MERGE_KEYS, len(parts[0])):
                    parts = [Filter.merged(parts)]
        if parts:
            yield frequent()

    return run


def _count(blocks: DataFrame, packing: Packing, least: int, table: Broadcast | None = None, table_bits: int = 0) -> DataFrame:
    """``ids, f`` of the phrases that occur at least ``least`` times, written."""
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    range_bits = min((4 * n).bit_length(), packing.widths[0])
    filters = blocks.select("ids").mapInArrow(_counter(packing, _kind(packing.bits), range_bits, table, table_bits), "range long, filter binary")
    dealt = filters.repartition(n, "range").sortWithinPartitions("range")
    return cut_lineage(dealt.mapInArrow(_merger(packing, range_bits, least), "ids array<long>, f long"), "phrases")


def _bit_table(pairs: DataFrame) -> tuple[Broadcast, int]:
    """The pairs as bits of a table of at most ``2 ** TABLE_BITS``, on every executor."""
    spark = pairs.sparkSession
    bits = min(TABLE_BITS, max(10, (16 * pairs.count()).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.array(batch.column("ids").to_pylist(), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_table_places(ids[:, 0], ids[:, 1], bits)))], ["place"])

    found = (pairs.mapInArrow(places, "place long").groupBy(F.shiftright("place", 3).alias("byte"))
             .agg(F.bit_or(F.expr("shiftleft(1, cast(place & 7 as int))")).alias("bits")).toArrow())
    table = np.zeros(1 << (bits - 3), np.uint8)
    table[found.column("byte").to_numpy()] = found.column("bits").to_numpy()
    return spark.sparkContext.broadcast(table.tobytes()), bits


def collocations(docs: DataFrame, least: int = 100, words: int = 5, first: int = 2000, percent: int = 100) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the ``first`` phrases of each language.

    ``docs``: text, lang. A null language is ``und``; a null or empty text has no word. Words are parted by
    blanks and tabs, pieces by punctuation and line ends, and phrases stay within a piece. A phrase of 2 to
    ``words`` words is a candidate if it occurs ``a >= least`` times. Its score is that of its lowest
    cut, ``1000 * a * n / (l * r)`` rounded down, of equal ones that of the shortest first part. It is
    dropped if a longer candidate holds it and occurs at least ``percent`` hundredths as often. Equal
    scores go by ``a``, then by phrase in byte order, so there are no ties. Repeated rows count each
    time. An empty table gives no rows; other columns are not read.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    blocks = _by_block(texts.mapInArrow(_blocks, _BLOCKS))
    totals = blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    held = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("number", "held")).select(
        "block", "lang", (F.col("number") + 1).alias("number"), F.col("held.words").alias("word"), F.col("held.counts").alias("f"))
    # The words of the blocks move once: where a word stands goes with its count, one place a block.
    frequent = held.groupBy("lang", "word").agg(
        F.sum("f").alias("f"), F.collect_list(F.struct("block", "number")).alias("places")).where(F.col("f") >= least)
    vocabulary = cut_lineage(dense_numbers(frequent, "id"), "vocabulary")
    n_words = vocabulary.agg(F.max("id")).first()[0] or 0
    own = (vocabulary.select("id", F.explode("places").alias("place")).select("place.block", F.struct("place.number", "id").alias("pair"))
           .groupBy("block").agg(F.collect_list("pair").alias("ids")))
    bits = max(1, n_words.bit_length())
    numbered = cut_lineage(blocks.select("block", "tokens").join(own.hint("shuffle_hash"), "block").select("tokens", "ids")
                           .mapInArrow(_renumber(_kind(bits)), "ids binary"), "numbered")
    pairs = _count(numbered, Packing(2, bits), least)
    found = pairs
    if words > 2:
        table, table_bits = _bit_table(pairs)
        found = found.unionByName(_count(numbered, Packing(words, bits), least, table, table_bits))
    return _ranked(found, vocabulary, totals, first, percent)


def _ranked(found: DataFrame, vocabulary: DataFrame, totals: DataFrame, first: int, percent: int) -> DataFrame:
    """Scores frequent phrases (``ids, f``) and ranks those that no longer one stands for."""
    size = F.size("ids")
    inner = F.expr("flatten(transform(sequence(2, size(ids) - 1), "
                   "n -> transform(sequence(1, size(ids) - n + 1), i -> slice(ids, i, n))))")
    longer = (found.where(size > 2).select(F.explode(inner).alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("longer")))
    kept = found.join(longer, "ids", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("f")))
    cuts = kept.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"first": F.expr("slice(ids, 1, k)"), "rest": F.expr("slice(ids, k + 1, size(ids) - k)")})
    parts = found.unionByName(vocabulary.select(F.array("id").alias("ids"), "f"))
    cuts = cuts.join(parts.toDF("first", "l"), "first").join(parts.toDF("rest", "r"), "rest").drop("first", "rest")
    placed = vocabulary.join(totals, "lang").select("id", "lang", "n")
    cuts = cuts.withColumn("id", F.col("ids")[0]).join(placed, "id")
    # Products may pass 64 bits; decimals of 38 digits hold them exactly.
    score = F.expr("(CAST(1000 AS DECIMAL(38, 0)) * a * n) div (CAST(l AS DECIMAL(38, 0)) * r)")
    best = cuts.withColumn("score", score.cast("long")).groupBy("ids", "lang", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    named = best.select("ids", F.posexplode("ids").alias("at", "id")).join(vocabulary.select("id", "word"), "id")
    phrases = named.groupBy("ids").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words")).select(
        "ids", F.array_join(F.col("words.word"), " ").alias("phrase"))
    rows = best.join(phrases, "ids").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_quotient_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language of the documents."""
    return collocations(read(spark, sf_dir, "documents"))


SQL_OP13 = r"""
WITH parts AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS part FROM documents),
pieces AS MATERIALIZED (SELECT lang, list_filter(string_split_regex(part, '[ \t]+'), lambda x: x <> '') AS w FROM parts),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, unnest(list_transform(range(1, len(w) - s.size + 2), lambda i: w[i:i + s.size - 1])) AS g
  FROM pieces, range(1, 6) s(size) WHERE len(w) >= s.size),
counted AS MATERIALIZED (SELECT lang, g, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
inside AS (
  SELECT lang, unnest(list_transform(range(1, len(g) - s.size + 2), lambda i: g[i:i + s.size - 1])) AS g, f
  FROM counted, range(2, 5) s(size) WHERE len(g) > s.size),
longer AS MATERIALIZED (SELECT lang, g, max(f) AS f FROM inside GROUP BY ALL),
kept AS MATERIALIZED (
  SELECT c.* FROM counted c LEFT JOIN longer o ON o.lang = c.lang AND o.g = c.g
  WHERE len(c.g) > 1 AND NOT coalesce(100 * o.f >= 100 * c.f, false)),
cuts AS (SELECT lang, g, f AS a, unnest(range(1, len(g))) AS k FROM kept),
scored AS (
  SELECT c.lang, c.g, c.k, c.a, x.f AS l, y.f AS r, t.n,
    ((1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN counted x ON x.lang = c.lang AND x.g = c.g[1:c.k]
  JOIN counted y ON y.lang = c.lang AND y.g = c.g[c.k + 1:]),
best AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""
