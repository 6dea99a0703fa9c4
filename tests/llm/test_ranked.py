import random
import re
from collections import Counter

import pytest

from relayframe.llm import ranked
from relayframe.session import work_path

DOCS = "doc_id long, text string, m string, salt string, terms string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    counts = [(i, Counter(words(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in counts:
            m = 100 - 25 + 25 * sum(c.values()) * n_docs // n_terms
            score = sum(ranked.weight(n_docs, df[t]) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in words(text) if t in c)
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, at, None if no else doc, -s) for at, (s, no, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, k):
    rows = spark.createDataFrame([(*r, "x", "y", "z") for r in docs], DOCS).repartition(3)
    index = ranked.build(rows, work_path(spark, "index"))
    asked = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in ranked.search(index, asked, k).collect()), key=repr)


def samples(n_docs, n_items, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(2000)] + ["É", "straße", "日本", "x_y", "A-b"]
    docs = [(i, rng.choice([" ", "\n", ", ", "\x00"]).join(rng.choices(vocabulary, k=rng.randrange(1, 90)))) for i in range(n_docs)]
    docs += [(n_docs + i, docs[0][1]) for i in range(30)]  # ties
    docs += [(5000, None), (5001, ""), (5002, " .,- \x7f"), (None, docs[1][1]), (None, docs[1][1]), (3, docs[2][1]), (5003, "w1 " * 30000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 40)))) for i in range(n_items)]
    return docs, [*items, (900, None), (901, "..."), (902, "nowhere"), (0, "w1 w1 w1 w2"), (903, docs[0][1]), (904, docs[1][1])]


@pytest.mark.parametrize("k", [1, 20])
def test_equals_brute_force(spark, k):
    docs, items = samples(250, 30, k)
    assert found(spark, docs, items, k) == brute(docs, items, k)


def test_small_pieces_and_blocks_change_nothing(spark, monkeypatch):
    docs, items = samples(150, 12, 7)
    want = brute(docs, items, 5)
    # Pieces are made in workers started before, so they are made small by the salts alone.
    monkeypatch.setattr(ranked, "PIECE", 100)
    monkeypatch.setattr(ranked, "BLOCK_QUERIES", 5)
    assert found(spark, docs, items, 5) == want


def test_empty_tables(spark):
    docs, items = samples(5, 3, 1)
    assert found(spark, [], items, 20) == []
    assert found(spark, docs, [], 20) == []
    assert found(spark, [(1, None), (2, " ")], items, 20) == []


def test_all_documents_that_score(spark):
    docs, items = samples(60, 10, 3)
    full = brute(docs, items, 10**6)
    assert found(spark, docs, items, 10**6) == full and len(full) > 100
