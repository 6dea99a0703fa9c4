import random

import numpy as np
import pytest

from relayframe.llm import shingles as sh
from relayframe.llm import vertical
from tests.llm.test_near import brute

SCHEMA = "doc_id long, text string, node string, segment string, n string, label string"


def found(spark, rows, size, percent):
    docs = spark.createDataFrame([(*r, "x", "y", "z", "u") for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in vertical.joined_components(docs, size, percent).collect())


def edited(rng, rows, n, vocabulary, most):
    out = []
    for i in range(n):
        base = rng.choice(rows)[1].split()
        for _ in range(rng.randrange(most)):
            base[rng.randrange(len(base))] = rng.choice(vocabulary)
        out.append((1000 + i, rng.choice([" ", "\n", " \t"]).join(base)))
    return out


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (1, 75)])
def test_equals_brute_force(spark, size, percent):
    rng = random.Random(size)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 160)))) for i in range(60)]
    rows += edited(rng, rows, 160, vocabulary, 5)
    rows += [(500, None), (501, ""), (502, " \n"), (503, "one"), (504, "ONE"), (505, "one two"), (506, "Ünï one"), (507, "ünï one")]
    rows += [(600 + i, rows[0][1]) for i in range(40)] + [(700, "a b c d " * 4000), (701, "a b c d " * 4100)]
    assert found(spark, rows, size, percent) == [r[:3] for r in brute(rows, size, percent)]


def test_long_sets_are_counted_by_fragments(spark, monkeypatch):
    monkeypatch.setattr(vertical, "SEGMENT", 16)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(5000)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([30, 60, 66, 120, 133, 300])))) for i in range(30)]
    rows += edited(rng, rows, 60, vocabulary, 6)
    rows += [(3000 + i, t + " " + " ".join(rng.choices(vocabulary, k=4))) for i, t in rows[:30]]
    assert found(spark, rows, 3, 90) == [r[:3] for r in brute(rows, 3, 90)]


@pytest.mark.parametrize("percent", [75, 80, 90, 100])
def test_no_link_without_a_common_key_and_parity_is_never_wrong(percent):
    rng, classes = np.random.default_rng(percent), vertical.size_classes(percent)
    for _ in range(400):
        n = int(rng.integers(2, 400))
        whole = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        swap = int(rng.integers(0, max(1, n * (100 - percent) // 100) + 1))
        other = np.unique(np.concatenate([whole[swap:], rng.integers(0, 1 << 63, int(rng.integers(0, swap + 1))).astype(np.uint64)]))
        shared, union = len(np.intersect1d(whole, other)), len(np.union1d(whole, other))
        apart = int(np.bitwise_count((vertical.parity(whole) ^ vertical.parity(other)).view(np.uint64)).sum())
        assert apart <= union - shared
        if 100 * shared >= percent * union and shared < union:
            assert union - shared <= vertical.allowed(len(whole), len(other), percent)
            assert len(np.intersect1d(vertical.segment_keys(whole, classes, percent), vertical.segment_keys(other, classes, percent)))


def test_sets_with_few_segments_are_cut_by_further_orders():
    classes = vertical.size_classes(90)
    # All elements lie in one fragment of the first order.
    grams = np.arange(1, 21, dtype=np.uint64)
    class_of = next(c for c in classes if c[1] >= 20)
    keys = vertical.segment_keys(grams, classes, 90)
    assert len(keys) > class_of[2] + 1
    assert len(np.intersect1d(keys, vertical.segment_keys(grams[:-1], classes, 90)))


def test_repeated_rows_null_ids_and_empty_tables(spark):
    assert found(spark, [], 3, 90) == []
    words = [f"w{i}" for i in range(100)]
    near = " ".join(words[:-1] + ["x"])
    rows = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "A  b c"), (None, "a b c"), (None, "q"), (None, None),
                                  (7, " ".join(words)), (None, near), (None, near), (8, None)], "doc_id long, text string")
    got = sorted((tuple(r) for r in vertical.joined_components(rows, 3, 90).collect()), key=repr)
    assert got == sorted([(1, 1, 1), (1, 1, 1), (2, 1, 1), (None, 1, 1), (None, 1, None), (None, 0, None),
                          (7, 98, 7), (None, 98, 7), (None, 98, 7), (8, 0, 8)], key=repr)
    with pytest.raises(ValueError):
        vertical.joined_components(rows, 3, 50)


def test_a_chain_through_a_text_without_id_and_all_links(spark):
    rng = random.Random(1)
    base = [f"b{i}" for i in range(200)]
    rows = [(1000, " ".join(base))]
    for i in range(60):
        text = list(base)
        for at in rng.sample(range(200), 3):
            text[at] = f"e{i}{at}"
        rows.append((i, " ".join(text)))
    assert found(spark, rows, 3, 90) == [r[:3] for r in brute(rows, 3, 90)]
    docs = spark.createDataFrame([*rows, (2000, rows[0][1])], "doc_id long, text string")
    links, members = vertical.similar_pairs(docs, 3, 90)
    node = {r.doc_id: r.node for r in members.collect()}
    assert node[1000] == node[2000] and len(set(node.values())) == 61
    sets = {i: set(sh.shingle_set(t, 3).tolist()) for i, t in rows}
    want = {(min(node[a], node[b]), max(node[a], node[b]), len(sets[a] & sets[b])) for a in sets for b in sets
            if a < b and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])}
    assert {tuple(r) for r in links.collect()} == want and len(want) == 60
