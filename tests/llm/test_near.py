import random

import numpy as np
import pytest

from relayframe.llm import near
from relayframe.llm import shingles as sh

SCHEMA = "doc_id long, text string, digest string, band string, label string"


def words(text):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, size, percent):
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    return sorted((d, len(sets[i]), least[top(i)], d == least[top(i)]) for i, (d, _) in enumerate(rows))


def found(spark, rows, size, percent):
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in near.near_components(docs, size, percent).collect())


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_equals_brute_force(spark, size, percent):
    rng = random.Random(size)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 120)))) for i in range(60)]
    for i in range(60, 180):  # chains of copies with more and more edits
        base = rng.choice(rows)[1].split()
        for _ in range(rng.randrange(4)):
            base[rng.randrange(len(base))] = rng.choice(vocabulary)
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(base)))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "one"), (504, "ONE"), (505, "one two"), (506, "Ünï one"), (507, "ünï one")]
    rows += [(600 + i, rows[0][1]) for i in range(40)] + [(700, "a b c d " * 4000), (701, "a b c d " * 4100)]
    assert found(spark, rows, size, percent) == brute(rows, size, percent)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    assert found(spark, [], 3, 85) == []
    rows = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "A  b c"), (None, "a b c"), (None, "q"), (None, None)],
                                 "doc_id long, text string")
    got = sorted((tuple(r) for r in near.near_components(rows, 3, 85).collect()), key=repr)
    assert got == sorted([(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (None, 1, 1, False), (None, 1, None, True),
                          (None, 0, None, True)], key=repr)
    kept = near.one_of_each(rows.selectExpr("*", "1 AS kept", "'x' AS again"), 3, 85)
    assert kept.columns == ["doc_id", "text", "kept", "again"]
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == [(0, ""), (0, "a b c"), (0, "q"), (1, "a b c")]


def test_a_hub_that_is_not_the_middle(spark):
    # Edits of one text are linked by it, not by each other.
    rng = random.Random(1)
    base = [f"b{i}" for i in range(100)]
    rows = [(1000, " ".join(base))]
    for i in range(60):
        text = list(base)
        for at in rng.sample(range(100), 2):
            text[at] = f"e{i}{at}"
        rows.append((i, " ".join(text)))
    got = found(spark, rows, 3, 85)
    assert got == brute(rows, 3, 85) and len({c for *_, c, _ in got}) < 61


@pytest.mark.parametrize("n", [1, 2, 7, 60, 900])
def test_every_place_is_filled_and_estimates_hold(n):
    rng = np.random.default_rng(n)
    errors = []
    for _ in range(40):
        pool = rng.integers(0, 1 << 63, 2 * n).astype(np.uint64)
        shared = int(rng.integers(0, n + 1))
        a, b = np.unique(pool[:n]), np.unique(pool[n - shared : 2 * n - shared])
        x, y = sh.similarity_sketch(a, 352), sh.similarity_sketch(b, 352)
        assert (x == sh.similarity_sketch(a[::-1].copy(), 352)).all()
        errors.append((x == y).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.13


def test_bands_miss_little():
    assert sh.bands_needed(0.85, near.ROWS) == 44 and (1 - 0.85**8) ** 44 <= 1e-6
    assert sh.window_hashes(sh.word_hashes("a b"), 3).size == 1 and sh.window_hashes(sh.word_hashes(""), 3).size == 0
