import hashlib
import random

from pyspark.sql import functions as F

from relayframe.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, bucket string, side string, pairs string"


def edits(spark, rows):
    docs = spark.createDataFrame([(*r, "b", "s", "p") for r in rows], SCHEMA).repartition(3)
    return fp.fingerprint_edits(docs).collect()


def brute(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True)
    out = []
    for i, (doc_id, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), edited, text))
    return out


def test_edits_follow_the_order_over_all_partitions(spark):
    rng = random.Random(1)
    rows = [(i * 7, "".join(rng.choice("aé\n 😀b") for _ in range(rng.randrange(30)))) for i in range(200)]
    rows += [(None, "null id"), (21, None), (21, "tie"), (35, ""), (-4, "x" * 20000)]
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_chars"], r["edited_sha256"]) for r in edits(spark, rows))
    assert got == sorted((d is not None, d or 0, n, h) for d, n, h, *_ in brute(rows))


def test_equal_texts_and_only_they_have_equal_fingerprints(spark):
    rows = [(1, "a b\nc d"), (2, "c d\na b"), (3, "a b\nc d"), (4, "a b c d"), (5, None), (6, ""), (7, "a b\nc d\n"), (8, "A b\nc d")]
    prints = {r["doc_id"]: r["fingerprint"] for r in edits(spark, rows)}
    assert prints[1] == prints[3] == prints[2]  # the order of paragraphs does not count
    assert prints[5] == prints[6] and len({prints[i] for i in (1, 4, 5, 7, 8)}) == 5


def test_edited_fingerprint_is_that_of_the_edited_text(spark):
    rows = [(i, f"some words of text {i} and\nmore of {i * 3} it {i}") for i in range(20)]
    texts = {d: e for d, _, _, e, _ in brute(rows)}
    again = {r["doc_id"]: r["fingerprint"] for r in edits(spark, list(texts.items()))}
    for r in edits(spark, rows):
        assert r["edited_fingerprint"] == again[r["doc_id"]]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1


def test_a_single_row_follows_itself(spark):
    row, = edits(spark, [(3, "abcd")])
    assert row["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and row["near_next"] == 1.0
    assert edits(spark, []) == []


def test_halves_are_nearer_than_strangers(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(3000)]
    found = edits(spark, [(i, " ".join(rng.choices(words, k=200))) for i in range(60)])
    assert all(r["near_edited"] > r["near_next"] for r in found)
    assert 0.35 < sum(r["near_edited"] for r in found) / 60 < 0.65 and sum(r["near_next"] for r in found) / 60 < 0.15


def test_insert_and_delete_paragraphs(spark):
    def prints(texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
        sums = fp.paragraph_vectors(rows, "k").groupBy("k").agg(*fp.fingerprint_sums())
        return {r["k"]: r["v"] for r in sums.select("k", fp.fingerprint_array().alias("v")).collect()}

    p = prints(["a b c\nd e\nf", "a b c\nf", "d e"])
    row = spark.createDataFrame([(p[0], p[1], p[2])], "x array<long>, y array<long>, z array<long>")
    whole, part = row.select(fp.insert(F.col("y"), F.col("z")), fp.delete(F.col("x"), F.col("z"))).first()
    assert whole == p[0] and part == p[1]
