"""Ranked lexical search over a length-stratified index.

A document's normaliser m follows from its length, so documents of equal m form a stratum, in which a
term that occurs tf times has one impact whatever the document. The index is a Parquet table of pieces:
documents of one stratum, split by hash where a stratum is large, with the postings of each term by tf.
Impacts are computed once for each (term, stratum, tf) and stand for all documents behind them.

A stratum's bound for a query adds the impacts of the terms' largest tf in it. Each query first visits
the stratum with its highest bound, everywhere; the score of rank k found there is a threshold for all
others. The remaining pieces are visited in the order of their bounds, those below the threshold are
not read for the query, and the threshold of a task rises as it goes. Nothing that could be in the
first k is left out, ties included.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relayframe.llm.tables import read
from relayframe.session import cut_lineage, work_path

#: Everything that is no term: ASCII but letters and digits. Bytes of longer characters are term bytes.
_APART = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
_FOLD = bytes(32 if b in _APART else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Postings of a piece, and queries of one pass: so many of them, or so many bytes of their terms.
PIECE, BLOCK_QUERIES, BLOCK_BYTES = 400_000, 1000, 4 << 20
#: Part of a mean length in a normaliser's hundredths, and the saturation of a term's count.
SLOPE, SATURATION, UNIT = 25, 12, 1_000_000_000
_FORWARD = "doc_id long, n long, distinct long, terms binary, tfs binary"
_PIECE = ("m long, n_docs long, doc_ids array<long>, terms binary, list_terms binary, list_tfs binary, "
          "list_sizes binary, docs binary")


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order: runs of what is not ASCII, ASCII letters and digits; A-Z folded."""
    return text.translate(_FOLD).split()


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column("text"):
            found = terms(text.as_py() or b"")
            counts = Counter(found)
            rows.append((len(found), len(counts), b" ".join(counts), np.fromiter(counts.values(), "<u4", len(counts)).tobytes()))
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n", "distinct", "terms", "tfs"])


def _piece(m: int, docs: list[tuple]) -> pa.RecordBatch:
    """One piece: its vocabulary, and lists of documents by (term, tf) in this order."""
    numbers: dict[bytes, int] = {}
    ids = [np.fromiter((numbers.setdefault(t, len(numbers)) for t in words), np.int64, len(words)) for _, words, _ in docs]
    tfs = np.concatenate([tf for *_, tf in docs]).astype(np.int64)
    sizes = [len(x) for x in ids]
    ids, at = np.concatenate(ids), np.repeat(np.arange(len(docs), dtype="<u4"), sizes)
    order = np.lexsort((at, tfs, ids))
    ids, tfs, at = ids[order], tfs[order], at[order]
    first = np.flatnonzero(np.diff(ids, prepend=-1) | np.diff(tfs, prepend=-1))
    lists = np.diff(first, append=len(ids))
    values = [m, len(docs), [d for d, _, _ in docs], b" ".join(numbers), ids[first].astype("<u4").tobytes(),
              tfs[first].astype("<u4").tobytes(), lists.astype("<u4").tobytes(), at.tobytes()]
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 5)
    return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(values, kinds, strict=True)],
                                      ["m", "n_docs", "doc_ids", "terms", "list_terms", "list_tfs", "list_sizes", "docs"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, docs, held = None, [], 0
    for batch in batches:
        for row in zip(*(batch.column(c) for c in ("m", "salt", "doc_id", "terms", "tfs")), strict=True):
            m, salt, doc_id, words, tfs = (x.as_py() for x in row)
            # By hash a piece is about as large as planned; should it be larger, it is split here.
            if docs and (now != (m, salt) or held > 2 * PIECE):
                yield _piece(now[0], docs)
                docs, held = [], 0
            now = m, salt
            docs.append((doc_id, words.split(), np.frombuffer(tfs, "<u4")))
            held += len(docs[-1][2])
    if docs:
        yield _piece(now[0], docs)


@dataclass(frozen=True)
class Index:
    """A written index: ``n_docs`` documents hold at least one term, ``n_terms`` terms in all."""

    spark: SparkSession
    path: str
    n_docs: int
    n_terms: int

    def pieces(self, *columns: str) -> DataFrame:
        rows = self.spark.read.schema(_PIECE).parquet(self.path)
        return rows.select(*columns) if columns else rows


def build(docs: DataFrame, path: str) -> Index:
    """Writes the index of ``docs`` (doc_id, text) to ``path``.

    Every row is a document of its own, also repeated ones and those without a doc_id. Null and empty
    texts, and those without a term, are in no stratum and count nowhere. Other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    forward = cut_lineage(texts.mapInArrow(_forward, _FORWARD).where("n > 0"), "forward")
    row = forward.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = row["docs"], row["terms"] or 0
    m = F.expr(f"{100 - SLOPE} + ({SLOPE} * n * {n_docs}L) div {max(n_terms, 1)}L")
    marked = forward.withColumn("m", m)
    # As many rows as there are lengths in the corpus; joined, not collected.
    strata = cut_lineage(marked.groupBy("m").agg(F.ceil(F.sum("distinct") / PIECE).alias("salts")), "strata")
    salted = marked.join(strata, "m").withColumn("salt", F.pmod(F.xxhash64("doc_id", "tfs", "terms"), F.col("salts")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = salted.select("m", "salt", "doc_id", "terms", "tfs").repartition(n, "m", "salt").sortWithinPartitions("m", "salt")
    ordered.mapInArrow(_pieces, _PIECE).write.option("compression", "zstd").parquet(path)
    return Index(spark, path, n_docs, n_terms)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _row(batch: pa.RecordBatch, i: int) -> dict:
    return {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns, strict=True)}


class _Queries:
    """A block of queries over its own numbering of terms: one flat list of (term, repeats) per query."""

    def __init__(self, found: list[Counter]):
        self.number = {t: i for i, t in enumerate(sorted({t for q in found for t in q}))}
        self.terms = np.array([self.number[t] for q in found for t in q], np.int64)
        self.repeats = np.array([n for q in found for n in q.values()], np.int64)
        self.sizes = np.array([len(q) for q in found], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.weights = np.zeros(len(self.number), np.int64)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """``values`` by term, added up for each query with its repeats."""
        return np.add.reduceat(values[self.terms] * self.repeats, self.first)

    def local(self, words: list[bytes]) -> np.ndarray:
        """The numbers of a piece's terms here; -1 for terms no query has."""
        return np.fromiter((self.number.get(w, -1) for w in words), np.int64, len(words))

    def lists(self, row: dict) -> tuple[np.ndarray, ...]:
        """The piece's lists of query terms: place in the piece, term, tf and impact."""
        term = self.local(row["terms"].split())[np.frombuffer(row["list_terms"], "<u4")]
        here = np.flatnonzero(term >= 0)
        term, tf = term[here], np.frombuffer(row["list_tfs"], "<u4")[here].astype(np.int64)
        impact = self.weights[term] * (UNIT * tf // (1000 * tf + SATURATION * row["m"]))
        return here, term, tf, impact

    def bounds(self, term: np.ndarray, impact: np.ndarray) -> np.ndarray:
        """The most that any document of the piece can score, by query."""
        best = np.zeros(len(self.number), np.int64)
        np.maximum.at(best, term, impact)
        return self.sums(best)


def _document_counts(queries: _Queries) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(queries.number), np.int64)
        for batch in batches:
            for row in (_row(batch, i) for i in range(batch.num_rows)):
                term = queries.local(row["terms"].split())[np.frombuffer(row["list_terms"], "<u4")]
                here = term >= 0
                np.add.at(total, term[here], np.frombuffer(row["list_sizes"], "<u4")[here])
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["term", "df"])

    return run


def _highest_strata(queries: _Queries) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bound, stratum = np.zeros(len(queries.sizes), np.int64), np.zeros(len(queries.sizes), np.int64)
        for batch in batches:
            for row in (_row(batch, i) for i in range(batch.num_rows)):
                _, term, _, impact = queries.lists(row)
                found = queries.bounds(term, impact)
                better = (found > bound) | ((found == bound) & (row["m"] < stratum))
                bound[better], stratum[better] = found[better], row["m"]
        seen = np.flatnonzero(bound)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(bound[seen]), pa.array(stratum[seen])], ["query", "bound", "m"])

    return run


class _Best:
    """The k best documents of each query so far, and the score that a further one has to reach."""

    def __init__(self, n_queries: int, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        empty = np.zeros(0, np.int64)
        self.rows = [(empty, empty, np.zeros(0, bool))] * n_queries

    def add(self, query: int, score: np.ndarray, ids: np.ndarray, named: np.ndarray) -> None:
        score, ids, named = (np.concatenate(x) for x in zip(self.rows[query], (score, ids, named), strict=True))
        order = np.lexsort((ids, ~named, -score))[: self.k]
        self.rows[query] = score[order], ids[order], named[order]
        if len(order) == self.k:
            self.least[query] = max(self.least[query], score[order[-1]])


def _visit(queries: _Queries, k: int, least: np.ndarray, first_strata: np.ndarray, first: bool) -> Callable:
    """Scores of pieces: each query in its first stratum, or in all others that its threshold leaves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(queries.sizes), k, least)
        for batch in batches:
            bounds = []
            for i in range(batch.num_rows):
                row = _row(batch.select(["m", "terms", "list_terms", "list_tfs"]), i)
                _, term, _, impact = queries.lists(row)
                # A query visits its first stratum in the first pass and all others in the second.
                mine = (first_strata == row["m"]) == first
                bounds.append(np.where(mine, queries.bounds(term, impact), 0))
            for i in sorted(range(len(bounds)), key=lambda i: -int(bounds[i].max(initial=0))):
                wanted = np.flatnonzero((bounds[i] > 0) & (bounds[i] >= best.least))
                if len(wanted):
                    _score(queries, _row(batch, i), wanted, best)
        found = [(q, *x) for q, rows in enumerate(best.rows) for x in zip(*(a.tolist() for a in rows), strict=True)]
        yield pa.RecordBatch.from_arrays([
            pa.array([x[0] for x in found], pa.int64()), pa.array([x[2] if x[3] else None for x in found], pa.int64()),
            pa.array([x[1] for x in found], pa.int64())], ["query", "doc_id", "score"])

    return run


def _score(queries: _Queries, row: dict, wanted: np.ndarray, best: _Best) -> None:
    """Adds the documents of a piece to the best of the wanted queries."""
    here, term, _, impact = queries.lists(row)
    sizes = np.frombuffer(row["list_sizes"], "<u4").astype(np.int64)
    ends = np.cumsum(sizes)
    docs = np.frombuffer(row["docs"], "<u4")
    # The lists of a term lie one after the other, by tf: documents and their impacts term by term.
    starts = (ends - sizes)[here]
    by_term = {}
    cuts = np.flatnonzero(np.diff(term, prepend=-1))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(term)], strict=True):
        by_term[int(term[a])] = docs[starts[a] : starts[b - 1] + sizes[here[b - 1]]], np.repeat(impact[a:b], sizes[here[a:b]])
    ids = np.array([x or 0 for x in row["doc_ids"]], np.int64)
    named = np.array([x is not None for x in row["doc_ids"]], bool)
    for query in wanted.tolist():
        score = np.zeros(row["n_docs"], np.int64)
        at = slice(queries.first[query], queries.first[query] + queries.sizes[query])
        for t, n in zip(queries.terms[at].tolist(), queries.repeats[at].tolist(), strict=True):
            if t in by_term:
                held, gain = by_term[t]
                score[held] += gain * n if n > 1 else gain
        hit = np.flatnonzero((score > 0) & (score >= best.least[query]))
        if len(hit):
            best.add(query, score[hit], ids[hit], named[hit])


def _first_k(rows: DataFrame, k: int) -> DataFrame:
    """The first k documents of each query, ranked. Tasks pass on at most k a query."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").isNull(), "doc_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(index: Index, found: list[Counter], k: int) -> DataFrame:
    queries = _Queries(found)
    counted = (index.pieces("terms", "list_terms", "list_sizes").mapInArrow(_document_counts(queries), "term long, df long")
               .groupBy("term").agg(F.sum("df").alias("df")).toArrow())
    for term, df in zip(counted.column("term").to_pylist(), counted.column("df").to_pylist(), strict=True):
        queries.weights[term] = weight(index.n_docs, df)
    lists = index.pieces("m", "terms", "list_terms", "list_tfs")
    tops = (lists.mapInArrow(_highest_strata(queries), "query long, bound long, m long").groupBy("query")
            .agg(F.max(F.struct("bound", (-F.col("m")).alias("m"))).alias("top")).select("query", (-F.col("top.m")).alias("m")).toArrow())
    strata = np.full(len(found), -1)
    strata[tops.column("query").to_numpy().astype(int)] = tops.column("m").to_numpy()
    nothing = np.zeros(len(found), np.int64)
    shape = "query long, doc_id long, score long"
    chosen = index.pieces().where(F.col("m").isin([int(m) for m in set(strata.tolist())]))
    seen = cut_lineage(_first_k(chosen.mapInArrow(_visit(queries, k, nothing, strata, True), shape), k), "first-strata")
    least = nothing.copy()
    reached = seen.where(F.col("rank") == k).select("query", "score").toArrow()
    least[reached.column("query").to_numpy().astype(int)] = reached.column("score").to_numpy()
    others = index.pieces().mapInArrow(_visit(queries, k, least, strata, False), shape)
    return _first_k(seen.drop("rank").unionByName(others), k)


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """The queries in blocks bounded by number and bytes; only one block is on the driver at a time."""
    block, held = [], 0
    for row in items.select("item_id", F.col("text").cast("binary").alias("text")).toLocalIterator():
        found = Counter(terms(bytes(row["text"] or b"")))
        if not found:
            continue
        size = sum(map(len, found)) + 8 * len(found)
        if block and (len(block) >= BLOCK_QUERIES or held + size > BLOCK_BYTES):
            yield block
            block, held = [], 0
        block.append((row["item_id"], found))
        held += size
    if block:
        yield block


def search(index: Index, items: DataFrame, k: int = 20) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the first ``k`` documents of each item (item_id, text).

    Every row of ``items`` is a query of its own, repeated ones too. Items without a term, and null
    text, find nothing. Only scores above 0 are listed; equal scores go by ascending doc_id, rows
    without one last. Each block of queries passes over the index four times, twice over its
    vocabulary alone, and its result is written before the next one starts.
    """
    spark, path, n = index.spark, work_path(index.spark, "ranked"), 0
    kind = items.schema["item_id"].dataType.simpleString()
    for n, block in enumerate(_blocks(items), 1):  # noqa: B007
        names = spark.createDataFrame(list(enumerate(x for x, _ in block)), f"query long, item_id {kind}")
        found = _search_block(index, [q for _, q in block], k).join(names, "query")
        found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score").write.parquet(f"{path}/block={n}")
    ddl = f"item_id {kind}, rank int, doc_id long, score long"
    return spark.read.schema(ddl).parquet(f"{path}/block=*") if n else spark.createDataFrame([], ddl)


def op11_stratified_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest-scoring documents of each benchmark item."""
    index = build(read(spark, sf_dir, "documents"), work_path(spark, "stratified-index"))
    return search(index, read(spark, sf_dir, "benchmark"))


SQL_OP11 = r"""
WITH occurrences AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
counts AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM occurrences GROUP BY ALL),
lengths AS MATERIALIZED (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
norms AS (SELECT doc_id, 100 - 25 + ((25 * n * docs) // terms) AS m FROM lengths, corpus),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, corpus GROUP BY term, docs),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN norms USING (doc_id)
  GROUP BY item_id, doc_id)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 20
"""
