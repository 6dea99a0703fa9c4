"""Token ids of documents in Huffman-coded files, in ascending order of doc_id.

The file format is two Parquet tables in one folder. ``codes`` has the code length of each id;
codes are canonical, so the lengths are the whole code. ``blocks`` has rows of whole documents,
about ``BLOCK_IDS`` ids each: ``part`` and ``first`` order them, ``doc_ids`` and ``doc_lengths``
list the documents, ``payload`` is the bit stream, and ``checkpoints`` has the bit offset of every
``STEP``-th id, from each of which decoding can start. A block needs nothing but the code.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relayframe.llm import huffman
from relayframe.llm.tables import lean, read
from relayframe.session import work_path

END_ID = 2
#: Ids in a block, but for its last document, which is never split.
BLOCK_IDS = 1 << 17
#: Bytes of pieces and ids that a worker remembers, beyond which its memory starts anew, what each piece
#: takes besides its text and ids, and the longest piece that is remembered.
CACHE_BYTES, PIECE_BYTES, LONGEST_PIECE = 256 << 20, 180, 200
#: Pieces given to the tokenizer together, bytes of whole texts cut together, and documents handed on together.
PIECES_AT_ONCE, BYTES_AT_ONCE, ROWS_AT_ONCE = 2000, 8 << 20, 200
#: Bytes of cut pieces and ids that a worker remembers besides, and what each takes in places and hashes.
KNOWN_BYTES, KNOWN_EACH = 32 << 20, 32
#: What a document counts for besides its text's bytes.
ROW_BYTES = 64
#: Longest code in bits, and two more than the ids need where that is longer.
LIMIT = 18

#: Whole words of Latin letters, with the one blank before them. The tokenizer's own split always
#: cuts at both ends of such a word: what follows is no letter, digit or apostrophe, and what
#: precedes is a blank of the word's own or no letter, digit or apostrophe. A run of blanks gives its
#: last one to what follows, so a word right behind a run that does not end in U+0020 stays with it.
_WORD = re.compile(r"((?: |(?<![\w'])(?<!\s[^\S ]))[A-Za-zÀ-ÖØ-öø-ɏ]+(?![\w']))")

#: A word, and the mark between it and a blank, which is a piece by itself.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?]?)")

#: Runs of blanks. All but the last of one are a piece by themselves, and the last goes with what follows
#: if it is U+0020. Four control characters are blanks for Python alone; texts with them are cut by _WORD.
_RUN, _ODD = re.compile(r"(\s\s+)"), re.compile("[\x1c-\x1f]")

#: A piece that is one to the tokenizer's own split.
_SINGLE = re.compile(r" ?(?:[A-Za-zÀ-ÖØ-öø-ɏ]+|[0-9]+)")

#: Kinds of bytes. The letters are those of _WORD; controls and other characters beyond ASCII are of no kind.
_OTHER, _GAP, _LETTER, _DIGIT, _MARK = range(5)
_KINDS = np.zeros(256, np.uint8)
_KINDS[33:127] = _MARK
_KINDS[[9, 10, 11, 12, 13, 32]] = _GAP
_KINDS[48:58] = _DIGIT
_KINDS[65:91] = _KINDS[97:123] = _LETTER

#: Two kinds side by side, as ``before << 3 | after``, between which every text can be cut, but for a letter
#: behind an apostrophe.
_APART = np.zeros(256, bool)
for _kind in (_LETTER, _DIGIT, _MARK):
    _APART[[_kind << 3 | other for other in (_GAP, _LETTER, _DIGIT, _MARK) if other != _kind]] = True

#: The letters by which byte-level vocabularies spell bytes: printable ones by themselves, the rest,
#: in order, by the code points from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}

_BLANK = chr(_BYTE_LETTERS[32])


@cache
def _packing(n: int) -> Callable:
    return struct.Struct(f"<{n}I").pack


def tokenizer_json(path: str) -> str:
    """The tokenizer file's content; tasks get it with their code, so they need no such file."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _mapped(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``table[values]`` for bytes; the table has 256 entries of one byte."""
    return np.frombuffer(bytearray(values).translate(table.tobytes()), table.dtype)


def _ends_in_gap(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character beyond ASCII whose last byte is at ``at`` is, or ever was, a Unicode blank."""
    third, second, last = raw[np.maximum(at - 2, 0)], raw[np.maximum(at - 1, 0)], raw[at]
    general = (third == 0xE2) & (second == 0x80) & ((last <= 0x8B) | (last == 0xA8) | (last == 0xA9) | (last == 0xAF))
    return (general | (second == 0xC2) & ((last == 0x85) | (last == 0xA0)) | (third == 0xE2) & (second == 0x81)
            | (third == 0xE1) & ((second == 0x9A) | (second == 0xA0)) | (third == 0xE3) & (second == 0x80) & (last == 0x80))


def piece_starts(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pieces start in the UTF-8 bytes of texts that lie one behind the other from ``starts`` on.

    A piece gives the same ids alone as in its text: no token of the byte-level split spans a cut, and that
    split looks ahead only from blanks, which end a piece only where it would end a token there too.
    """
    kind = _mapped(raw, _KINDS)
    lead = np.flatnonzero((raw[:-1] >= 0xC3) & (raw[:-1] <= 0xC9))
    if len(lead):
        first, second = raw[lead], raw[lead + 1]
        lead = lead[~((first == 0xC3) & ((second == 0x97) | (second == 0xB7)) | (first == 0xC9) & (second > 0x8F))]
        kind[lead] = kind[lead + 1] = _LETTER
    pair = kind[:-1] << 3 | kind[1:]
    starts = starts[starts < len(raw)]
    pair[starts[starts > 0] - 1] = _OTHER  # neighbours, but of two texts
    cut = np.zeros(len(raw), bool)
    cut[1:] = _mapped(pair, _APART)
    quoted = np.flatnonzero(raw[:-1] == ord("'"))
    cut[quoted[pair[quoted] & 7 == _LETTER] + 1] = False
    foreign = np.flatnonzero(pair == _GAP)
    foreign = foreign[raw[foreign] >= 0x80]
    cut[foreign[~_ends_in_gap(raw, foreign)] + 1] = True
    cut[starts] = True
    # The last blank of a run goes with what follows if it is U+0020, and is a piece by itself if not.
    last = np.flatnonzero((pair > (_GAP << 3 | _GAP)) & (pair < _LETTER << 3))
    run = last[last > 0]
    cut[run[pair[run - 1] == (_GAP << 3 | _GAP)]] = True
    last = last[raw[last] != ord(" ")]
    cut[last[cut[last]] + 1] = True
    return np.flatnonzero(cut)


class _Remembered(dict):
    """Ids of pieces by the piece itself; of those behind a blank, by what follows it."""

    def __init__(self, encoder: PieceEncoder, before: str):
        super().__init__()
        self.encoder, self.before = encoder, before

    def __missing__(self, token: str) -> bytes:
        found = _PLAIN.fullmatch(token) if self.before else None
        if found and found[2]:
            # The mark is a piece by itself, and not one to be remembered with every word.
            return self[found[1]] + self.encoder.first[found[2]]
        ids = self.encoder.word(self.before + token) if found else self.encoder.pieces(self.before + token)
        if len(token) <= LONGEST_PIECE:
            self.encoder.hold(token, ids)
            self[token] = ids
        return ids


class PieceEncoder:
    """Ids of texts; every distinct short piece is given to the tokenizer once while it is remembered.

    ``encode_all`` cuts many texts together and looks up each distinct piece of them once; ``encode``
    takes one text, for tokenizers and texts that ``encode_all`` does not cut.

    Between two characters that are no blanks, a single U+0020 starts a piece of the tokenizer's split
    and a single line feed is one, so such texts are cut by plain splitting; texts that hold an added
    token, such as one for the end of a text, go to the tokenizer whole.
    """

    def __init__(self, content: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.model = self.tokenizer.model
        self.end = np.array([end_id], "<u4").tobytes()
        parts = json.loads(content)
        self.added = [token["content"] for token in parts.get("added_tokens") or []]
        pre = parts.get("pre_tokenizer") or {}
        self.by_bytes = (parts.get("normalizer") is None and pre.get("type") == "ByteLevel"
                         and not pre.get("add_prefix_space") and parts["model"]["type"] == "BPE")
        self.known: dict[str, bytes] = {}
        self.known_pieces, self.known_ids = pa.array([], pa.binary()), pa.array([], pa.binary())
        self.first, self.behind, self.held = _Remembered(self, ""), _Remembered(self, " "), 0

    def hold(self, piece: str, ids: bytes) -> None:
        """Counts what is remembered and forgets all of it when that is too much."""
        size = PIECE_BYTES + 4 * len(piece) + len(ids)
        self.held += size
        if self.held > CACHE_BYTES:
            self.known.clear()
            self.first.clear()
            self.behind.clear()
            self.held = size

    def _learn(self, words: set[str], others: set[str]) -> dict[str, bytes]:
        """Ids of pieces that are not remembered."""
        new, rest = words.difference(self.known), others.difference(self.known)
        if not self.by_bytes:
            new, rest = set(), new | rest
        found = {piece: self.word(piece) for piece in new}
        listed = list(rest)
        for at in range(0, len(listed), PIECES_AT_ONCE):
            some = listed[at : at + PIECES_AT_ONCE]
            for piece, got in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                found[piece] = _packing(len(got.ids))(*got.ids)
        return found

    def word(self, piece: str) -> bytes:
        """Ids of a whole word, with its blank if it has one: one piece to the tokenizer, so its model gets it."""
        if piece.isascii():
            spelled = _BLANK + piece[1:] if piece[0] == " " else piece
        else:
            spelled = piece.encode().decode("latin-1").translate(_BYTE_LETTERS)
        ids = [token.id for token in self.model.tokenize(spelled)]
        return _packing(len(ids))(*ids)

    def pieces(self, text: str) -> bytes:
        """Ids of a text cut at whole words."""
        pieces = _WORD.split(text)
        try:
            return b"".join(map(self.known.__getitem__, pieces))
        except KeyError:
            found = self._learn(set(pieces[1::2]), set(pieces[::2]))  # words stand between what is none
        ids = b"".join([found[p] if p in found else self.known[p] for p in pieces])
        for piece, got in found.items():
            if len(piece) <= LONGEST_PIECE:
                self.hold(piece, got)
                self.known[piece] = got
        return ids

    def _lines(self, text: str, behind_blank: bool, out: list[bytes]) -> None:
        """Ids of a text without a run of blanks."""
        for i, line in enumerate(text.split("\n")):
            if i:
                out.append(self.first["\n"])
            first, *tokens = line.split(" ")
            out.append((self.behind if behind_blank and not i else self.first)[first])
            out += map(self.behind.__getitem__, tokens)

    def encode(self, text: str) -> bytes:
        """The ids of a text and the end id, as little-endian unsigned 32-bit integers."""
        if any(token in text for token in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes() + self.end
        if not self.by_bytes or _ODD.search(text):
            return self.pieces(text) + self.end
        out: list[bytes] = []
        parts, behind_blank = _RUN.split(text), False
        for i, part in enumerate(parts):
            if i % 2 == 0:
                if part or behind_blank:
                    self._lines(part, behind_blank, out)
            elif i == len(parts) - 2 and not parts[-1]:
                out.append(self.first[part])  # nothing follows the last run
                break
            else:
                out.append(self.first[part[:-1]])
                behind_blank = part[-1] == " "
                if not behind_blank:
                    out.append(self.first[part[-1]])
        out.append(self.end)
        return b"".join(out)

    def _ids(self, pieces: pa.BinaryArray) -> pa.BinaryArray:
        """Ids of pieces of texts cut by ``piece_starts``."""
        texts = pieces.cast(pa.string()).to_pylist()
        single = [_SINGLE.fullmatch(text) is not None for text in texts]
        words = "\n".join(compress(texts, single)).encode().decode("latin-1")
        for byte in set(words) - {"\n"}:  # few; translate takes its time for each letter
            words = words.replace(byte, chr(_BYTE_LETTERS.get(ord(byte), ord(byte))))
        of_words = ([token.id for token in self.model.tokenize(word)] for word in words.split("\n"))
        rest = [text for text, one in zip(texts, single, strict=True) if not one]
        of_rest = (got.ids for at in range(0, len(rest), PIECES_AT_ONCE)
                   for got in self.tokenizer.encode_batch_fast(rest[at : at + PIECES_AT_ONCE], add_special_tokens=False))
        found = [next(of_words if one else of_rest) for one in single]
        ends = np.cumsum([0, *map(len, found)]).astype("<i4")
        flat = np.fromiter(chain.from_iterable(found), "<u4", int(ends[-1]))
        return pa.BinaryArray.from_buffers(pa.binary(), len(found), [None, pa.py_buffer(ends * 4), pa.py_buffer(flat)])

    def _numbered(self, pieces: pa.BinaryArray) -> tuple[np.ndarray, pa.BinaryArray]:
        """For each piece its place in the array of ids that is returned; new pieces are remembered.

        Remembered pieces are encoded in front of the given ones, so they keep their places. When they
        take too much, only those of this call are kept.
        """
        coded = pa.chunked_array([self.known_pieces, pieces]).dictionary_encode().chunks[-1]
        every, places = coded.dictionary, coded.indices.to_numpy()
        ids = pa.concat_arrays([self.known_ids, self._ids(every.slice(len(self.known_pieces)))])
        sizes = pc.binary_length(every).to_numpy()
        keep = sizes <= LONGEST_PIECE
        sizes = sizes + pc.binary_length(ids).to_numpy() + KNOWN_EACH
        if sizes[keep].sum() > KNOWN_BYTES:
            keep &= np.bincount(places, minlength=len(every)) > 0
            keep &= np.cumsum(sizes * keep) <= KNOWN_BYTES
        kept = pa.array(keep)
        self.known_pieces, self.known_ids = every.filter(kept), ids.filter(kept)
        return places, ids

    def _together(self, texts: pa.StringArray) -> pa.BinaryArray:
        """``encode`` of texts without added tokens, none null: pieces are cut and put together as arrays."""
        n = len(texts)
        starts = np.frombuffer(texts.buffers()[1], "<i4")[texts.offset : texts.offset + n + 1]
        if starts[0] == starts[-1]:
            return pa.array([self.end] * n, pa.binary())
        raw = np.frombuffer(texts.buffers()[2], np.uint8)[starts[0] : starts[-1]]
        starts = starts - starts[0]
        cuts = piece_starts(raw, starts)
        bounds = pa.py_buffer(np.append(cuts, len(raw)).astype("<i4"))
        pieces = pa.BinaryArray.from_buffers(pa.binary(), len(cuts), [None, bounds, pa.py_buffer(raw)])
        places, ids = self._numbered(pieces)
        # Each text's pieces and, behind them, the end id.
        firsts = np.searchsorted(cuts, starts)
        order = np.insert(places, firsts[1:], len(ids))
        flat = pa.concat_arrays([ids, pa.array([self.end], pa.binary())]).take(pa.array(order))
        ends = np.frombuffer(flat.buffers()[1], "<i4")[firsts + np.arange(n + 1)]
        return pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), flat.buffers()[2]])

    def encode_all(self, texts: pa.StringArray) -> pa.BinaryArray:
        """``encode`` of every text; a null text is empty."""
        texts = pc.fill_null(texts, "")
        if not self.by_bytes:
            return pa.array([self.encode(text) for text in texts.to_pylist()], pa.binary())
        whole = pa.array(np.zeros(len(texts), bool))
        for token in self.added:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        if not whole.true_count:
            return self._together(texts)
        ids = self._together(pc.if_else(whole, "", texts))
        alone = pa.array([self.encode(text) for text in texts.filter(whole).to_pylist()], pa.binary())
        return pc.replace_with_mask(ids, whole, alone)


_IDS = ["part", "seq", "doc_id", "ids", "counts"]


@cache
def _shared_encoder(content: str, end_id: int) -> PieceEncoder:
    """One encoder for all tasks of a Python worker."""
    return PieceEncoder(content, end_id)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.StringArray]]:
    """``doc_id`` and ``text`` in order, of about ``BYTES_AT_ONCE`` bytes, or of one longer text, at once."""
    held, size = [], 0

    def group() -> tuple[pa.Array, pa.StringArray]:
        return tuple(pa.concat_arrays([x[i] for x in held]) for i in range(2))

    for batch in batches:
        doc_ids, texts = batch.column("doc_id"), batch.column("text").cast(pa.string())
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64) + ROW_BYTES)
        at = before = 0
        while at < len(texts):
            n = int(np.searchsorted(ends, before + BYTES_AT_ONCE - size, "right")) - at
            if n < 1 and held:
                yield group()
                held, size = [], 0
                continue
            n = max(n, 1)
            held.append((doc_ids.slice(at, n), texts.slice(at, n)))
            size, before, at = size + int(ends[at + n - 1]) - before, int(ends[at + n - 1]), at + n
    if held:
        yield group()


def _encoder(content: str, end_id: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq = _shared_encoder(content, end_id), TaskContext.get().partitionId(), 0
        counts = np.zeros(0, np.int64)
        for doc_ids, texts in _groups(batches):
            every = encoder.encode_all(texts)
            counts = _added(counts, np.bincount(_values(every)))
            for at in range(0, len(every), ROWS_AT_ONCE):
                ids = every.slice(at, ROWS_AT_ONCE)
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n, pa.int32()), pa.array(range(seq, seq + n), pa.int64()),
                     doc_ids.slice(at, n), ids, pa.nulls(n, pa.binary())], _IDS)
                seq += n
        if seq:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                 pa.array([counts.astype("<i8").tobytes()], pa.binary())], _IDS)

    return run


def tokenize(docs: DataFrame, content: str, end_id: int = END_ID) -> DataFrame:
    """``part, seq, doc_id, ids, counts``: every text's ids as little-endian unsigned 32-bit integers.

    (part, seq) follows ascending doc_id, null first, rows of one doc_id by text. Null text is
    empty. The strings of added tokens give their ids, as the tokenizer does. Texts are ranged by doc_id,
    the only time they move. One more row of each part, without seq and ids, has ``counts``: how often
    the part holds each id from 0 on, as little-endian 64-bit integers.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(lean(_encoder(content, end_id)), "part int, seq long, doc_id long, ids binary, counts binary")


def _values(column: pa.BinaryArray) -> np.ndarray:
    """All ids of a column; they stand one after the other, from its first offset to its last."""
    offsets = np.frombuffer(column.buffers()[1], "<i4")[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view("<u4")


def _added(total: np.ndarray, found: np.ndarray) -> np.ndarray:
    if len(found) > len(total):
        found, total = total, found
    total[: len(found)] += found
    return total


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for counts in batch.column("counts"):
            total = _added(total, np.frombuffer(counts.as_py(), "<i8").astype(np.int64))
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])


def id_counts(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs. At most one row for each id of the vocabulary reaches the driver."""
    rows = (tokens.where("counts IS NOT NULL").select("counts").mapInArrow(lean(_count), "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 0, np.int64)
    counts[rows["id"].to_numpy(int)] = rows["n"].to_numpy(int)
    return counts


_BLOCK = pa.schema([("part", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64())),
                    ("checkpoints", pa.list_(pa.int64())), ("payload", pa.binary())])
_BLOCK_DDL = ("part int, first long, n_ids long, doc_ids array<long>, doc_lengths array<long>, "
              "checkpoints array<long>, payload binary")


def _packer(lengths: np.ndarray) -> Callable:
    codes = huffman.canonical_codes(lengths)

    def block(part: int, first: int, docs: list[tuple]) -> pa.RecordBatch:
        ids = np.concatenate([x for _, x in docs])
        payload, checkpoints = huffman.pack(ids, codes, lengths)
        values = [part, first, len(ids), [d for d, _ in docs], [len(x) for _, x in docs],
                  checkpoints.tolist(), payload]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(values, _BLOCK, strict=True)], schema=_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, part, first, n = [], None, 0, 0
        for batch in batches:
            columns = [batch.column(c) for c in ("part", "seq", "doc_id", "ids")]
            for row in zip(*columns, strict=True):
                p, seq, doc_id = (x.as_py() for x in row[:3])
                # A task may read several files or a piece of one: blocks hold neighbours only.
                if docs and (p != part or seq != first + len(docs) or n >= BLOCK_IDS):
                    yield block(part, first, docs)
                    docs, n = [], 0
                if not docs:
                    part, first = p, seq
                ids = np.frombuffer(row[3].as_py(), "<u4")
                docs.append((doc_id, ids))
                n += len(ids)
        if docs:
            yield block(part, first, docs)

    return run


def write_token_files(docs: DataFrame, path: str, content: str, end_id: int = END_ID) -> None:
    """Tokenizes every text and writes the folder ``path`` in the format of this module.

    Ids are written once in the shared folder, compressed, as the code needs the counts of all
    of them before the first can be packed. Each task counts its own, so they are read once.
    """
    spark = docs.sparkSession
    staged = work_path(spark, "token-ids")
    tokenize(docs, content, end_id).write.option("compression", "zstd").parquet(staged)
    tokens = spark.read.parquet(staged)
    counts = id_counts(tokens)
    lengths = huffman.code_lengths(counts, max(LIMIT, len(counts).bit_length() + 2))
    code = [(i, int(x)) for i, x in enumerate(lengths) if x]
    spark.createDataFrame(code, "id long, length int").coalesce(1).write.parquet(f"{path}/codes")
    rows = tokens.where("seq IS NOT NULL").drop("counts")
    rows.mapInArrow(lean(_packer(lengths)), _BLOCK_DDL).write.parquet(f"{path}/blocks")


def read_code(spark: SparkSession, path: str) -> np.ndarray:
    """Code lengths by id; as many rows as the vocabulary has ids."""
    rows = spark.read.parquet(f"{path}/codes").toPandas()
    lengths = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 0, np.uint8)
    lengths[rows["id"].to_numpy(int)] = rows["length"].to_numpy()
    return lengths


def _unpacker(lengths: np.ndarray, give_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, depth = huffman.decode_table(lengths)
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                part, first, n_ids, doc_ids, sizes, checkpoints, payload = row
                ids = huffman.unpack(payload.as_py(), checkpoints.values.to_numpy(), n_ids.as_py(), table, depth)
                sizes = sizes.values.to_numpy()
                ends = np.cumsum(sizes)
                each = [x.astype("<u4").tobytes() for x in np.split(ids, ends[:-1])]
                n = len(sizes)
                columns = [pa.array([part.as_py()] * n, pa.int32()), pa.array([first.as_py()] * n, pa.int64()),
                           doc_ids.values, pa.array(ends - sizes), pa.array(sizes),
                           pa.array([zlib.crc32(x) for x in each], pa.int64())]
                if give_ids:
                    columns.append(pa.array(each, pa.binary()))
                names = ["part", "first", "doc_id", "before", "n_tokens", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    return run


def read_token_files(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, if asked, ``ids`` of every document in the files.

    ``start`` counts the ids of all documents before it: blocks are added up by their headers
    within a part, and parts, as many as the ranges they were written in, among each other.
    """
    blocks = spark.read.schema(_BLOCK_DDL).parquet(f"{path}/blocks")
    ddl = "part int, first long, doc_id long, before long, n_tokens long, ids_crc32 long"
    docs = blocks.mapInArrow(lean(_unpacker(read_code(spark, path), ids)), ddl + ", ids binary" * ids)
    before = (Window.unboundedPreceding, -1)
    heads = blocks.select("part", "first", "n_ids")
    parts = heads.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*before)), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("first").rowsBetween(*before)
    starts = heads.select("part", "first", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("at"))
    starts = starts.join(parts, "part").select("part", "first", (F.col("base") + F.col("at")).alias("base"))
    rows = docs.join(starts, ["part", "first"])
    return rows.select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32",
                       *["ids"] * ids)


def token_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Writes the files of ``docs`` to the shared folder and reads them back."""
    path = work_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer_json(tokenizer_path))
    return read_token_files(docs.sparkSession, path, ids=False)


def op10_huffman_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    import public_tokenizers

    return token_digests(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
