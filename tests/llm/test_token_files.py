import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from relayframe.llm import huffman as h
from relayframe.llm import token_files as tf

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
HARD = ["don't  stop\n\n x 'll he'll I'M  ", "á é中文word 3word word3 _x_ x² ²word ‘quoted’", "  two  spaces \t tab nbsp word",
        "<|endoftext|> x", "a <|endoftext|>b<|endoftext|>\n\n c", "<|endoftext", " a", "a ", "\na\n", " \n", "a\x1c\x1d b \x1e\x1f c", "ǅungla ß ŉ word…word naïve ’s 's", "", "\r\n a\r\nb  c", "Ωmega omegaΩ Å å", "x" * 3000, " " * 500,
        "a'b 'c d' e'", "ÀÖØöøɏ ɐb"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize(("n", "limit"), [(0, 5), (1, 5), (2, 1), (3, 2), (8, 3), (9, 4), (300, 9), (5000, 13)])
def test_codes_are_within_the_limit_and_round_trip(n, limit):
    rng = np.random.default_rng(n)
    counts = (rng.pareto(0.6, n) * 5).astype(np.int64) + 1
    lengths = h.code_lengths(counts, limit)
    assert (lengths <= limit).all() and (lengths > 0).all()
    if n > 1:
        assert sum(2.0 ** -lengths.astype(float)) == 1.0
    codes = h.canonical_codes(lengths)
    table, depth = h.decode_table(lengths)
    for m in [0, 1, h.STEP - 1, h.STEP, h.STEP + 1, 5 * h.STEP, 3000] if n else []:
        ids = rng.choice(n, m).astype(np.uint32)
        payload, checkpoints = h.pack(ids, codes, lengths)
        assert len(payload) == -(-int(lengths[ids].sum()) // 8)
        assert (h.unpack(payload, checkpoints, m, table, depth) == ids).all()


def test_codes_are_optimal():
    import heapq
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 0, 7])
    heap = [(int(c), i) for i, c in enumerate(counts) if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], -1))
    assert (counts * h.code_lengths(counts, 12)).sum() == cost
    assert h.code_lengths(counts, 4).max() == 4 and h.code_lengths(counts, 4)[9] == 0
    with pytest.raises(ValueError, match="more than"):
        h.code_lengths(counts, 3)


def test_pieces_encode_as_whole_texts(tokenizer, monkeypatch):
    monkeypatch.setattr(tf, "CACHE_BYTES", 4000)
    monkeypatch.setattr(tf, "LONGEST_PIECE", 6)
    encoder = tf.PieceEncoder(tf.tokenizer_json(PATH), 2)
    for text in HARD * 2:
        want = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want, text


def test_runs_of_blanks_before_words_encode_as_whole_texts(tokenizer):
    encoder = tf.PieceEncoder(tf.tokenizer_json(PATH), 2)
    blanks = [chr(i) for i in range(0x3001) if chr(i).isspace()] + ["\u200b", "\u180e", "\ufeff"]
    rng = np.random.default_rng(7)
    texts = ["\n\nword", "x\n\nword", "a.\n\nb c", "x\r\n\r\nword more", "x\xa0\xa0word", "x \n\tword", "x\n\n word's", "x\n\nword's"]
    texts += [f"x{a}{b}word{a}{b}{a}y" for a in blanks for b in blanks]
    pieces = [*blanks, " ", " ", "\n", "\n", "word", "Été", "x", "中", "7", "'", "'s", "."]
    texts += ["".join(rng.choice(pieces, rng.integers(1, 30))) for _ in range(5000)]
    for text in texts:
        want = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want, text


def test_memory_is_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(tf, "CACHE_BYTES", 100_000)
    encoder = tf.PieceEncoder(tf.tokenizer_json(PATH), 2)
    for i in range(200):
        encoder.encode("中文" * 2000 + f"词{i} " + " ".join(f"w{i}x{j}" for j in range(50)))
        kept = [*encoder.known.items(), *encoder.first.items(), *encoder.behind.items()]
        assert sum(4 * len(k) + len(v) + tf.PIECE_BYTES for k, v in kept) <= 100_000 and max(len(k) for k, _ in kept) <= tf.LONGEST_PIECE


def test_files_round_trip(spark, folder, tokenizer, monkeypatch):
    monkeypatch.setattr(tf, "BLOCK_IDS", 300)
    rows = [(i * 3 - 50, f"{text} {i}") for i, text in enumerate(HARD * 5)] + [(None, "no id"), (4000, None), (4001, ""), (7, "tie"), (7, "a tie")]
    docs = spark.createDataFrame([(d, t, "p") for d, t in rows], "doc_id long, text string, part string").repartition(3)
    tf.write_token_files(docs, folder, tf.tokenizer_json(PATH))
    found = tf.read_token_files(spark, folder).orderBy("start").collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for row, (doc_id, text) in zip(found, ordered, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        raw = np.array(ids, "<u4").tobytes()
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"]) == (doc_id, start, len(ids), zlib.crc32(raw))
        assert bytes(row["ids"]) == raw
        start += len(ids)
    assert spark.read.parquet(f"{folder}/blocks").count() > 5


def test_empty_table(spark):
    assert tf.token_digests(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def _encoded(encoder, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in encoder.encode_all(pa.array(texts, pa.string())).to_pylist()]


def _whole(tokenizer, texts):
    return [[*tokenizer.encode(text or "", add_special_tokens=False).ids, 2] for text in texts]


def test_texts_cut_together_encode_as_whole_texts(tokenizer):
    encoder = tf.PieceEncoder(tf.tokenizer_json(PATH), 2)
    blanks = [chr(i) for i in range(0x3001) if chr(i).isspace()] + ["​", "᠎", "﻿"]
    texts = [*HARD, None, "", *[f"x{a}{b}word{a}{b}{a}y{a}" for a in blanks for b in blanks]]
    texts += [a + b + c for a in (*blanks, "слово", "中", "é", "x", "'", ".") for b in (" ", "\n", "\r") for c in ("w", "7", "!", "é", "中", "")]
    rng = np.random.default_rng(11)
    pieces = [*blanks, *" \n" * 6, *"word Été x 中 7 '' 's 'll . # ß × ÷ ɏ ɐ Ã é слово \x00 \x1c \x7f 😀 don't".split(" ")]
    texts += ["".join(rng.choice(pieces, rng.integers(0, 30))) for _ in range(20000)]
    every = "".join(chr(i) for i in (*range(0x250), 0x300, 0x2028, 0x3000))
    texts += ["".join(rng.choice(list(every), 40)) for _ in range(5000)]
    want = _whole(tokenizer, texts)
    assert _encoded(encoder, texts) == want
    assert _encoded(encoder, texts[::-1]) == want[::-1]  # now with all pieces remembered
    assert _encoded(encoder, ["", None]) == [[2], [2]] and _encoded(encoder, []) == []
    sliced = encoder.encode_all(pa.array(texts, pa.string()).slice(7, 300))
    assert [np.frombuffer(x, "<u4").tolist() for x in sliced.to_pylist()] == want[7:307]


def test_each_distinct_word_is_looked_up_once_for_many_texts():
    encoder = tf.PieceEncoder(tf.tokenizer_json(PATH), 2)
    given, ids = [], encoder._ids
    encoder._ids = lambda pieces: given.append(pieces.to_pylist()) or ids(pieces)
    encoder.encode_all(pa.array(["the cat, the dog###", "The cat; the\n\ndog the cat"] * 50))
    encoder.encode_all(pa.array(["the cat! the bird"]))
    assert sorted(given[0]) == sorted([b"the", b" cat", b",", b" the", b" dog", b"###", b"The", b";", b"\n", b"dog"])
    assert given[1] == [b"!", b" bird"]


def test_memory_of_cut_pieces_is_bounded_in_bytes(monkeypatch, tokenizer):
    monkeypatch.setattr(tf, "KNOWN_BYTES", 20_000)
    encoder = tf.PieceEncoder(tf.tokenizer_json(PATH), 2)
    for i in range(60):
        texts = [f"{'中' * 300} w{i}a{j} w{chr(97 + j % 26) * (i + 1)} common {'x' * 300}" for j in range(50)] + ["a <|endoftext|> b"]
        assert _encoded(encoder, texts) == _whole(tokenizer, texts)
        pieces = encoder.known_pieces.to_pylist()
        assert sum(map(len, pieces)) + sum(map(len, encoder.known_ids.to_pylist())) + tf.KNOWN_EACH * len(pieces) <= 20_000
        assert max(map(len, pieces)) <= tf.LONGEST_PIECE and len(set(pieces)) == len(pieces) == len(encoder.known_ids)
    assert b" common" in pieces


def test_groups_keep_rows_in_order(monkeypatch):
    monkeypatch.setattr(tf, "BYTES_AT_ONCE", 1000)
    rng = np.random.default_rng(5)
    rows = [(i, None if i % 17 == 0 else "é" * int(rng.choice([0, 3, 40, 600, 2000]))) for i in range(400)]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[a : a + 37]]), pa.array([r[1] for r in rows[a : a + 37]], pa.string())],
                                          ["doc_id", "text"]) for a in range(0, 400, 37)]
    groups = [list(zip(d.to_pylist(), t.to_pylist(), strict=True)) for d, t in tf._groups(iter(batches))]
    assert [r for g in groups for r in g] == rows and len(groups) > 5
    assert all(len(g) == 1 or sum(len((t or "").encode()) + tf.ROW_BYTES for _, t in g) <= 1000 for g in groups)


def test_tasks_count_their_ids(spark):
    docs = spark.createDataFrame([(i, f"{text} {i % 3}") for i, text in enumerate(HARD * 4)], "doc_id long, text string")
    tokens = tf.tokenize(docs, tf.tokenizer_json(PATH))
    ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in tokens.where("ids IS NOT NULL").collect()])
    counts = tf.id_counts(tokens)
    assert counts.tolist() == np.bincount(ids).tolist() and counts.sum() == len(ids)


LEFT = """
import gc, re
from types import SimpleNamespace as Named
import numpy as np, pyarrow as pa, public_tokenizers
from relayframe.llm import token_files as tf

class Docs:
    sparkSession = Named(conf=Named(get=lambda key: "4"))
    select = repartitionByRange = sortWithinPartitions = lambda self, *columns: self
    mapInArrow = lambda self, task, ddl: task

def held():
    gc.collect()
    return sum(map(int, re.findall(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) // 1024

tf.F = Named(col=lambda name: Named(cast=lambda kind: Named(alias=lambda name: None)))
tf.TaskContext = Named(get=lambda: Named(partitionId=lambda: 0))
task = tf.tokenize(Docs(), tf.tokenizer_json(public_tokenizers.path("byte_bpe_50k.json")))
rng, rows = np.random.default_rng(1), 0

def batch():
    texts = [" ".join(map(str.lower, map(hex, rng.integers(0, 1 << 20, 400)))) for _ in range(5000)]
    return pa.RecordBatch.from_arrays([pa.array(range(5000)), pa.array(texts)], ["doc_id", "text"])

for found in task(batch() for _ in range(2)):
    rows += found.num_rows
del found
left = held()
for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
    pool.release_unused()
print(rows, left - held())
"""


def test_a_task_leaves_its_worker_no_unused_memory():
    out = subprocess.run([sys.executable, "-c", LEFT], cwd=Path(__file__).parents[2], capture_output=True, text=True, check=True)
    rows, unused = map(int, out.stdout.split())
    assert rows == 10_001 and unused < 40
