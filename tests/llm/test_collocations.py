import random
import re
from collections import Counter

import numpy as np
import pytest

from relayframe.llm import collocations as co
from relayframe.llm.quotient import Counting, Filter, Packing

SCHEMA = "doc_id long, text string, lang string, ids string, block string, n string"


def pieces(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", folded)]


def brute(docs, least, words, first, percent=100):
    f, n = {}, Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        for p in pieces(text):
            n[lang] += len(p)
            for size in range(1, words + 1):
                for i in range(len(p) - size + 1):
                    f.setdefault(lang, Counter())[tuple(p[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        candidates = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        held = Counter()
        for g, a in candidates.items():
            for size in range(2, len(g)):
                for i in range(len(g) - size + 1):
                    held[g[i : i + size]] = max(held[g[i : i + size]], a)
        rows = []
        for g, a in candidates.items():
            if held[g] and 100 * held[g] >= percent * a:
                continue
            cuts = [(1000 * a * n[lang] // (counts[g[:k]] * counts[g[k:]]), k, counts[g[:k]], counts[g[k:]]) for k in range(1, len(g))]
            score, _, left, right = min(cuts)
            rows.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def found(spark, docs, *args):
    rows = spark.createDataFrame([(*r, "x", "y", "z") for r in docs], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in co.collocations(rows, *args).collect())


def samples(seed, n=200):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.8)) % 60}" for _ in range(500)] + ["É", "straße", "日本", "A\x0bB", "c\x1fd", "x\x00y"]
    said = [" ".join(rng.choices(vocabulary, k=rng.randrange(2, 7))) for _ in range(8)]
    docs = []
    for i in range(n):
        parts = [rng.choice(said) if rng.random() < 0.4 else " ".join(rng.choices(vocabulary, k=rng.randrange(0, 9))) for _ in range(rng.randrange(9))]
        docs.append((i, rng.choice([". ", "\n", " ", "\t ", "!?"]).join(parts), rng.choice(["en", "EN", None, "und", "de"])))
    docs += [(900, None, "en"), (901, "", "en"), (902, " .\n\t", "fr"), (None, docs[0][1], "en"), (0, docs[0][1], docs[0][2])]
    return [*docs, (903, "a a a a a a a a a a a a", "aa"), (904, "long run " * 5000, "de")]


@pytest.mark.parametrize(("seed", "least", "words", "first"), [(1, 5, 5, 2000), (2, 12, 5, 7), (3, 3, 2, 50), (4, 4, 7, 30)])
def test_equals_brute_force(spark, seed, least, words, first):
    docs = samples(seed)
    want = brute(docs, least, words, first)
    assert found(spark, docs, least, words, first) == want and len(want) > 10


def test_a_smaller_share_drops_more(spark):
    docs = samples(5)
    assert found(spark, docs, 4, 5, 500, 60) == brute(docs, 4, 5, 500, 60)


def test_empty_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, None), (2, "", "en"), (None, " . ", "en")]) == []
    assert found(spark, [(1, "one two", "en")]) == []


def test_scores_beyond_64_bits(spark):
    # The parts are as in a corpus of 10^12 words.
    n, a, left, right = 3 * 10**12, 10**11 + 7, 10**11 + 9, 10**11 + 11
    found = spark.createDataFrame([([1, 2], a)], "ids array<long>, f long")
    vocabulary = spark.createDataFrame([("en", "x", left, 1), ("en", "y", right, 2)], "lang string, word string, f long, id long")
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    row = co._ranked(found, vocabulary, totals, 10, 100).first()
    assert row.score == 1000 * a * n // (left * right) and row.phrase == "x y"


@pytest.mark.parametrize("packing", [Packing(2, 5), Packing(2, 17), Packing(5, 12), Packing(5, 17), Packing(5, 30), Packing(3, 64), Packing(2, 32), Packing(1, 1)])
def test_keys_are_recovered_and_counts_are_exact(packing):
    rng = np.random.default_rng(packing.bits)
    top = min(1 << packing.bits, 1 << 62)
    pool = rng.integers(0, top, (300, packing.words))
    pool = np.concatenate([pool, [[top - 1] * packing.words, [0] * packing.words]])
    drawn = pool[rng.integers(0, len(pool), 20000) ** 2 % len(pool)]
    limbs = packing.pack([drawn[:, i] for i in range(packing.words)])
    assert (packing.unpack(packing.restore(packing.permute(limbs))) == drawn).all()
    counting, made = Counting(packing, 700), []
    for at in range(0, len(drawn), 333):
        made.append(counting.add([x[at : at + 333] for x in limbs]))
    made = [f for f in [*made, counting.finish()] if f]
    bits = min(3, packing.widths[0])
    parts = {}
    for one in made:
        for at, part in one.ranges(bits):
            parts.setdefault(at, []).append(Filter.decode(packing, part.encode(bits), at, bits))
    got = Counter()
    for at, filters in parts.items():
        whole = Filter.merged(filters)
        assert (np.diff(whole.limbs[0].astype(object)) >= 0).all()
        rows = packing.unpack(packing.restore(whole.limbs))
        for row, count in zip(rows.tolist(), whole.counts.tolist(), strict=True):
            assert tuple(row) not in got
            got[tuple(row)] = count
    assert got == Counter(map(tuple, drawn.tolist()))


def test_filters_are_smaller_than_their_keys():
    packing = Packing(2, 17)
    limbs = packing.pack([np.arange(1 << 16), np.arange(1 << 16)[::-1]])
    whole = Filter.of(packing, packing.permute(limbs))
    assert sum(len(part.encode(4)) for _, part in whole.ranges(4)) < 6 * len(whole)


def test_blocks_are_joined_where_they_lie(spark, monkeypatch):
    seen, inner = [], co.cut_lineage
    monkeypatch.setattr(co, "cut_lineage", lambda df, name="step": seen.append((name, df)) or inner(df, name))
    assert found(spark, samples(3), 5) == brute(samples(3), 5, 5, 2000)
    plan = dict(seen)["numbered"]._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    tokens = [line for line in physical.splitlines() if "Exchange" in line and "tokens" in line]
    assert "Bucketed: true" in physical and not tokens
