import random

from relayframe.llm import decontaminate as dc

DOCS = "doc_id long, text string, coverage string, item_id string"
ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def greedy(doc, item, size):
    """Greedy string tiling word by word, without seeds or hashes."""
    a, b = dc.words_of(doc), dc.words_of(item)
    in_a, in_b, found = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for j in range(len(b)):
            for i in range(len(a)):
                k = 0
                while (i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]
                       and i + k not in in_a and j + k not in in_b):
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < size:
            return found / len(b)
        in_a.update(range(i, i + k))
        in_b.update(range(j, j + k))
        found += k


def run(spark, docs, items, least=dc.MIN_COVERAGE):
    rows = spark.createDataFrame([(*d, "c", "i") for d in docs], DOCS).repartition(2)
    return rows, dc.contaminated(rows, spark.createDataFrame(items, "item_id long, text string"), least)


def test_reordered_and_punctuated_passages(spark):
    w = ITEM.split()
    docs = [(1, f"before {ITEM} after"), (2, " ".join(w[10:] + ["x"] + w[:10])), (3, ITEM.upper().replace(" ", ",\n")),
            (4, " ".join(w[:10])), (5, " ".join(w[::2])), (6, None), (7, ""), (8, " ".join(w[:9] + ["q"] + w[10:])),
            (9, "word " * 30_000 + ITEM), (1, f"before {ITEM} after")]
    rows, found = run(spark, docs, [(70, ITEM), (71, "too short"), (72, None), (70, ITEM), (None, "a b c d e")])
    got = {r["doc_id"]: r for r in found.collect()}
    assert found.count() == len(got) and set(got) == {1, 2, 3, 8, 9}
    assert {r["item_id"] for r in got.values()} == {70}
    assert (got[2]["n_tiles"], got[2]["longest"], got[2]["coverage"]) == (2, 10, 1.0) and got[8]["coverage"] == 0.95
    clean = dc.without_tests(rows, spark.createDataFrame([(70, ITEM)], "item_id long, text string"))
    assert clean.columns == rows.columns and sorted(r["doc_id"] for r in clean.collect()) == [4, 5, 6, 7]


def test_equals_tiling_without_seeds(spark):
    rng = random.Random(6)
    letters = [rng.choices("abcdef", k=rng.randrange(5, 30)) for _ in range(6)]
    items = [(i, " ".join(x)) for i, x in enumerate(letters)]
    docs = []
    for i in range(40):
        parts = [rng.choices("abcdef", k=rng.randrange(12)) for _ in range(3)]
        own = rng.choice(letters)
        cut = rng.randrange(len(own))
        docs.append((i, " ".join(parts[0] + own[cut:] + parts[1] + own[:cut] + parts[2])))
    _, found = run(spark, docs, items, 0.01)
    got = {(r["doc_id"], r["item_id"]): round(r["coverage"], 9) for r in found.collect()}
    want = {(d, i): round(greedy(text, item, dc.MIN_WORDS), 9) for d, text in docs for i, item in items}
    assert got == {k: v for k, v in want.items() if v}


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    w = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(w[10 * i : 10 * i + 8])) for i in range(40)]
    docs = [(i, f"x {items[i][1]} y {items[-1 - i][1]}") for i in range(10)]
    rows, whole = run(spark, docs, items)
    want = sorted(tuple(r) for r in whole.collect())
    monkeypatch.setattr(dc, "BLOCK_ITEMS", 7)
    assert sorted(tuple(r) for r in run(spark, docs, items)[1].collect()) == want and len(want) == 20
    assert dc.without_tests(rows, spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_short_items_are_found_whole(spark):
    rng = random.Random(3)
    items = [(i, " ".join(rng.choices("abc", k=i % 4 + 1))) for i in range(12)] + [(50, "a, B"), (51, ""), (52, None)]
    docs = [(i, " ".join(rng.choices("abcd", k=rng.randrange(9)))) for i in range(60)] + [(99, "a b " * 40_000), (100, None)]
    _, found = run(spark, docs, [*items, (53, ITEM), (None, "d d")])
    got = sorted((r["doc_id"], -1 if r["item_id"] is None else r["item_id"], r["coverage"], r["longest"]) for r in found.collect())
    want = [(d, -1 if i is None else i, 1.0, len(dc.words_of(item))) for d, text in docs for i, item in [*items, (None, "d d")]
            if text and item and f" {b' '.join(dc.words_of(item)).decode()} " in f" {b' '.join(dc.words_of(text)).decode()} "]
    assert got == sorted(want) and len(want) > 100
    rows = spark.createDataFrame([(1, "x y z"), (2, "x"), (3, "yz x y")], "doc_id long, text string")
    kept = dc.without_tests(rows, spark.createDataFrame([(1, "y z")], "item_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3]


def test_empty_tables(spark):
    assert run(spark, [], [(1, ITEM)])[1].count() == 0 and run(spark, [(1, ITEM)], [])[1].count() == 0
