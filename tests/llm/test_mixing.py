import math
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from relayframe.llm import mixing as mx

SCHEMA = "doc_id long, text string, source string, turn string, block string"


def corpus(spark, sizes):
    rows, n = [], 0
    for source, docs in sizes.items():
        for k in range(docs):
            rows.append((n, "w " * (1 + (n * 7) % 13), source, "t", "b"))
            n += 1
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def shares(tokens, alpha):
    total = sum(tokens.values())
    power = {s: (t / total) ** alpha for s, t in tokens.items() if t}
    z = sum(power.values())
    return {s: p / z for s, p in power.items()}


def entropy(weights):
    return -sum(w * math.log(w) for w in weights.values())


TOKENS = {"a": 9000, "b": 700, "c": 50, "d": 3, "none": 0}


@pytest.mark.parametrize("part", [0.3, 0.6, 0.9, 0.999])
def test_entropy_is_met(spark, part):
    sources = spark.createDataFrame([(s, 1, t) for s, t in TOKENS.items()], "source string, n_docs long, tokens long")
    alpha = mx.exponent(sources, mx.Target(entropy=part))
    assert 0 < alpha < 1
    assert entropy(shares(TOKENS, alpha)) == pytest.approx(part * math.log(4), abs=1e-6)


@pytest.mark.parametrize("limit", [1.0, 2.0, 50.0, 1e9])
def test_repeats_are_kept_to(spark, limit):
    sources = spark.createDataFrame([(s, 1, t) for s, t in TOKENS.items()], "source string, n_docs long, tokens long")
    alpha = mx.exponent(sources, mx.Target(repeats=limit))
    w = shares(TOKENS, alpha)
    passes = [w[s] / TOKENS[s] for s in w]
    assert max(passes) / min(passes) == pytest.approx(min(limit, 3000.0), rel=1e-6)


def test_extremes(spark):
    same = spark.createDataFrame([("a", 1, 5), ("b", 1, 5)], "source string, n_docs long, tokens long")
    assert mx.exponent(same, mx.Target(entropy=0.9)) == 1.0 and mx.exponent(same, mx.Target()) == 1.0
    assert mx.exponent(same.limit(0), mx.Target(entropy=0.9)) == 1.0
    far = spark.createDataFrame([("a", 1, 5), ("b", 1, 500)], "source string, n_docs long, tokens long")
    assert mx.exponent(far, mx.Target(entropy=2.0)) == 0.0


def test_draws_fill_budgets_by_whole_passes_and_one_part(spark, monkeypatch):
    monkeypatch.setattr(mx, "BLOCK_DOCS", 8)
    docs = corpus(spark, {"a": 300, "b": 40, "c": 5})
    drawn = [r.asDict() for r in mx.draw(docs, mx.Target(entropy=0.95)).collect()]
    assert len(drawn) == 345
    by = defaultdict(list)
    for r in drawn:
        by[r["source"]].append(r)
    tokens = {s: sum(r["tokens"] for r in rows) for s, rows in by.items()}
    for source, rows in by.items():
        budget = math.floor(sum(tokens.values()) * rows[0]["weight"] + 0.5)
        got = sum(r["tokens"] * r["draws"] for r in rows)
        assert budget <= got < budget + 13 or got == budget
        draws = sorted({r["draws"] for r in rows})
        assert draws[-1] - draws[0] <= 1
        # The last pass takes whole blocks but for one.
        part = defaultdict(set)
        for r in rows:
            part[r["block"]].add(r["draws"])
        assert sum(len(x) > 1 for x in part.values()) <= 1
    weights = {s: rows[0]["weight"] for s, rows in by.items()}
    assert entropy(weights) == pytest.approx(0.95 * math.log(3), abs=1e-6)


def unit(seed, *values):
    """Spark's xxhash64 over the values, chained by seed, as a fraction of 1; nulls are passed over."""
    h = xxhash.xxh64_intdigest(seed.encode(), 42)
    for v in values:
        if v is not None:
            h = xxhash.xxh64_intdigest(v.to_bytes(8, "little", signed=True), h)
    return (h >> 11) / float(1 << 53)


def test_permutation_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(mx, "BLOCK_DOCS", 8)
    docs = corpus(spark, {"a": 300, "b": 40, "c": 5, None: 9}).unionByName(spark.createDataFrame(
        [(None, "x y z", "b", "t", "b"), (7000, "", "c", "t", "b"), (1, "w w", "b", "t", "b"), (1, "w w", "b", "t", "b"),
         (1, "w", "b", "t", "b")], SCHEMA))
    drawn = mx.draw(docs, mx.Target(entropy=0.97))
    rows = [r.asDict() for r in drawn.collect()]
    got = [r.asDict() for r in mx.permutation(drawn).collect()]
    total = sum(r["tokens"] for r in rows)
    want, lost = set(), set()
    for source in {r["source"] for r in rows}:
        held = [r for r in rows if r["source"] == source]
        size, budget = sum(r["tokens"] for r in held), math.floor(total * held[0]["weight"] + 0.5)
        by = defaultdict(list)
        for r in held:
            by[r["block"]].append(r)
        number, spent = 0, 0
        seen = set()
        while spent < budget:
            left = budget - spent if budget - spent < size else size
            before = 0
            for at, block in enumerate(sorted(by, key=lambda b: (unit("mix pass", number, b), b)), 1):
                turn = sorted(by[block], key=lambda r: unit("mix doc", number, r["doc_id"], r["text_hash"]))
                for place, r in enumerate(turn, 1):
                    if left == size or before < left:
                        want.add((r["doc_id"], source, r["text_hash"], number, at, place))
                        seen.add((r["doc_id"], r["text_hash"]))
                    before += r["tokens"]
            number, spent = number + 1, spent + left
        lost |= {(r["doc_id"], source, r["text_hash"], None, None, None) for r in held
                 if (r["doc_id"], r["text_hash"]) not in seen}
    found = [tuple(r[c] for c in ("doc_id", "source", "text_hash", "pass", "block_place", "place")) for r in got]
    assert len(found) == len(set(found)) and set(found) == want | lost
    orders = defaultdict(list)
    for r in sorted((r for r in got if r["source"] == "c" and r["pass"] is not None),
                    key=lambda r: (r["pass"], r["block_place"], r["place"])):
        orders[r["pass"]].append(r["doc_id"])
    full = [tuple(o) for p, o in orders.items() if len(o) == 6]
    assert len(full) > 3 and len(set(full)) > 1
    assert mx.permutation(mx.draw(docs.limit(0), mx.Target(entropy=0.5))).count() == 0


def test_another_seed_draws_others_and_the_same_the_same(spark):
    docs = corpus(spark, {"a": 200, "b": 5})
    target = mx.Target(entropy=0.9)
    one, same, other = ({r["doc_id"]: r["draws"] for r in mx.draw(docs, target, seed).collect()} for seed in ("x", "x", "y"))
    assert one == same != other


def test_mixture_covers_all_and_keeps_columns(spark):
    docs = corpus(spark, {"a": 100, "b": 10, None: 3}).unionByName(spark.createDataFrame(
        [(900, None, "a", "t", "b"), (901, "", "a", "t", "b"), (None, "x y", "b", "t", "b"), (0, "w w", "a", "t", "b"),
         (0, "w w", "a", "t", "b"), (902, None, "only", "t", "b")], SCHEMA))
    mixed = mx.mixture(docs, mx.Target(repeats=2.0, cover=True))
    assert mixed.columns == docs.columns
    n, before = ({tuple(r)[:-1]: r["n"] for r in x.groupBy(*docs.columns).agg(F.count(F.lit(1)).alias("n")).collect()}
                 for x in (mixed, docs))
    assert set(n) == set(before) and all(before[k] <= n[k] <= 2 * before[k] for k in n)
    assert n[0, "w w", "a", "t", "b"] == 2 and n[902, None, "only", "t", "b"] == 1
    assert mx.mixture(docs.limit(0), mx.Target(entropy=0.5)).count() == 0


def test_tokens_are_words(spark):
    texts = ["", None, " ", "a", " a\tb\n\nc ", "a\u00a0b", "x" * 100_000]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", mx.token_count(F.col("t")).alias("n")).collect()
    assert [r["n"] for r in rows] == [0, 0, 0, 1, 3, 1, 1]
