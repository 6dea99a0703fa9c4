"""Benchmark decontamination by greedy string tiling.

A document and a test item share seeds: windows of ``MIN_WORDS`` words with one Karp-Rabin hash.
Neighbouring seeds on one diagonal are a match. The longest match is marked, what it covers is
taken from the others, and so on until no match of ``MIN_WORDS`` unmarked words is left. The share
of the item's words under marks is its coverage, whatever order the document has them in. An item of
fewer than ``MIN_WORDS`` words has no seed; it is looked for as a whole, by one hash of all its words.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relayframe.llm.tables import columns_ddl, lean, read

MIN_WORDS, MIN_COVERAGE = 5, 0.8
#: Items that a task holds at a time; more are taken in blocks of about as many.
BLOCK_ITEMS = 10_000
CHARS_AT_ONCE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_M = (1 << 64) - 1
#: ASCII punctuation separates words like blanks.
_PLAIN = bytes(32 if chr(i) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else i for i in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def rolling_hashes(codes: np.ndarray, size: int = MIN_WORDS) -> np.ndarray:
    """Karp-Rabin hashes modulo 2**64 of all windows of ``size`` words."""
    n = max(0, len(codes) - size + 1)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total += codes[i : i + n] * np.uint64(pow(_BASE, size - 1 - i, 1 << 64))
    return total


class Items:
    """The seeds of a block of test items, sorted by hash."""

    def __init__(self, rows: list[tuple]):
        codes = [(item, word_codes(words_of(text or ""))) for item, text in rows]
        self.items = [(item, x) for item, x in codes if len(x) >= MIN_WORDS]
        self.short: dict[int, tuple[np.ndarray, list[int]]] = {}
        for size in range(1, MIN_WORDS):
            own = sorted((int(rolling_hashes(x, size)[0]), -1 if item is None else item, item)
                         for item, x in codes if len(x) == size)
            if own:
                self.short[size] = np.array([h for h, *_ in own], np.uint64), [item for *_, item in own]
        seeds = [rolling_hashes(x) for _, x in self.items]
        self.sizes = np.array([len(x) for _, x in self.items], np.int64)
        hashes = np.concatenate([np.zeros(0, np.uint64), *seeds])
        owner = np.repeat(np.arange(len(seeds)), [len(x) for x in seeds])
        place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(x)) for x in seeds]])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owner, self.place = hashes[order], owner[order], place[order]
        self.may = np.zeros(1 << 20, bool)
        self.may[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def seeds(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (window of the document, item, window of the item) with one hash."""
        at = np.flatnonzero(self.may[(hashes >> np.uint64(44)).astype(np.int64)])
        low, high = (np.searchsorted(self.hashes, hashes[at], side) for side in ("left", "right"))
        n = high - low
        ends = np.cumsum(n)
        row = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n) + np.repeat(low, n)
        return np.repeat(at, n), self.owner[row], self.place[row]


def tiles(doc_at: np.ndarray, item_at: np.ndarray, size: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """Greedy tiling of a document and an item by their seeds: (document word, item word, length).

    Longer matches go first, then earlier ones in the item, then in the document.
    """
    order = np.lexsort((item_at, doc_at - item_at))
    d, i = doc_at[order], item_at[order]
    cut = np.flatnonzero((np.diff(d - i, prepend=np.inf) != 0) | (np.diff(i, prepend=-2) != 1))
    n = np.diff(cut, append=len(d)) + size - 1
    heap = [(-int(k), int(b), int(a)) for k, a, b in zip(n, d[cut], i[cut], strict=True)]
    heapq.heapify(heap)
    in_doc: set[int] = set()
    in_item: set[int] = set()
    found = []
    while heap:
        k, b, a = heapq.heappop(heap)
        k = -k
        free = [a + x not in in_doc and b + x not in in_item for x in range(k)]
        if all(free):
            found.append((a, b, k))
            in_doc.update(range(a, a + k))
            in_item.update(range(b, b + k))
            continue
        x = 0
        while x < k:
            if free[x]:
                y = x
                while y < k and free[y]:
                    y += 1
                if y - x >= size:
                    heapq.heappush(heap, (-(y - x), b + x, a + x))
                x = y
            x += 1
    return found


_FOUND = "doc_id long, item_id long, coverage double, n_tiles long, longest long"


def _matches(batch: pa.RecordBatch, items: Items, least: float) -> Iterator[tuple]:
    """(row of the batch, item_id, coverage, tiles, words of the longest) where ``least`` is reached."""
    texts, at = batch.column("text"), 0
    while at < len(texts):
        words, bounds, chars, first = [], [], 0, at
        while at < len(texts) and chars < CHARS_AT_ONCE:
            text = texts[at].as_py() or ""
            words += words_of(text)
            bounds.append(len(words))
            chars += len(text)
            at += 1
        codes, ends = word_codes(words), np.array(bounds)
        for doc, item, size in _whole(codes, ends, items):
            yield first + doc, item, 1.0, 1, size
        where, item, place = items.seeds(rolling_hashes(codes))
        doc = np.searchsorted(ends, where, side="right")
        inside = where + MIN_WORDS <= ends[np.minimum(doc, len(ends) - 1)]
        where, item, place, doc = where[inside], item[inside], place[inside], doc[inside]
        order = np.lexsort((place, item, doc))
        where, item, place, doc = where[order], item[order], place[order], doc[order]
        pair = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(item, prepend=-1) != 0))
        for a, b in pairwise([*pair.tolist(), len(doc)]):
            n = items.sizes[item[a]]
            # Words of the item that any seed covers: no tiling covers more.
            step = np.diff(np.unique(place[a:b]))
            if np.minimum(step, MIN_WORDS).sum() + MIN_WORDS < least * n:
                continue
            found = tiles(where[a:b], place[a:b])
            coverage = sum(k for _, _, k in found) / n
            if coverage >= least:
                yield first + int(doc[a]), items.items[item[a]][0], float(coverage), len(found), max(k for _, _, k in found)


def _whole(codes: np.ndarray, ends: np.ndarray, items: Items) -> Iterator[tuple[int, int | None, int]]:
    """(document, item_id, words) of the short items whose words stand in a row in a document."""
    for size, (hashes, names) in items.short.items():
        windows = rolling_hashes(codes, size)
        where = np.flatnonzero(np.isin(windows, hashes))
        doc = np.searchsorted(ends, where, side="right")
        inside = where + size <= ends[np.minimum(doc, len(ends) - 1)]
        found = np.unique(np.rec.fromarrays([doc[inside], windows[where[inside]]], names="doc,h"))
        low, high = (np.searchsorted(hashes, found.h, side) for side in ("left", "right"))
        for d, a, b in zip(found.doc.tolist(), low.tolist(), high.tolist(), strict=True):
            yield from ((d, names[i], size) for i in range(a, b))


def _finder(rows: list[tuple], least: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(rows)
        for batch in batches:
            doc_ids = batch.column("doc_id")
            out = [(doc_ids[row].as_py(), *rest) for row, *rest in _matches(batch, items, least)]
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)],
                                             ["doc_id", "item_id", "coverage", "n_tiles", "longest"])

    return run


def _cleaner(rows: list[tuple], least: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(rows)
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            clean[[row for row, *_ in _matches(batch, items, least)]] = False
            yield batch.filter(pa.array(clean))

    return run


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """The test items in blocks of about ``BLOCK_ITEMS``; at least one block, maybe empty."""
    tests = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    n = max(1, -(-tests.count() // BLOCK_ITEMS))
    for block in range(n):
        own = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block)
        yield [tuple(r) for r in own.collect()]


def contaminated(docs: DataFrame, items: DataFrame, least: float = MIN_COVERAGE) -> DataFrame:
    """``doc_id, item_id, coverage, n_tiles, longest`` where tiles cover ``least`` of an item.

    Words are split at blanks and ASCII punctuation and lower-cased. ``items`` (item_id, text) is
    the test set; it is sent to tasks in blocks of about ``BLOCK_ITEMS`` items, each of which
    passes over all documents, which do not move. Null texts hold no words. Items of fewer than
    ``MIN_WORDS`` words are found where all their words stand in a row, with coverage 1; those without
    a word are found nowhere. Repeated rows are reported once; documents without a doc_id are reported
    with null.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return reduce(DataFrame.unionByName, [rows.mapInArrow(lean(_finder(block, least)), _FOUND)
                                          for block in _blocks(items)]).distinct()


def without_tests(docs: DataFrame, items: DataFrame, least: float = MIN_COVERAGE) -> DataFrame:
    """The rows of ``docs`` that hold no item as ``contaminated`` finds them, with all columns."""
    for block in _blocks(items):
        docs = docs.mapInArrow(lean(_cleaner(block, least)), columns_ddl(docs))
    return docs


def op8_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold 0.8 of a benchmark item, with the items."""
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
