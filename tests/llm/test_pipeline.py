"""The stages against plain versions, over the smallest tables and over awkward rows."""

import zlib

import numpy as np
import pytest

import corpus_pipeline as cp
from relayframe.llm import decontaminate, langid, registry
from relayframe.llm import shingles as sh
from relayframe.session import cut_lineage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(cut_lineage(stage(spark, out[-1], SF), name))
    return out


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_stages_and_their_columns(steps):
    assert [name for name, _ in cp.STAGES] == ["language", "near_dedup", "decontamination", "mixing", "tokens"]
    assert all(tuple(x.columns) == cp.COLUMNS for x in steps[:-1])
    assert steps[-1].columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_language_keeps_prose(spark, steps):
    before, after = rows(steps[0]), {r["doc_id"] for r in rows(steps[1])}
    model = langid.learn(steps[0].where(~langid.held_out(steps[0].doc_id)))
    for r in before:
        (lang, score, _), = langid.label_texts([r["text"]], model)
        assert (r["doc_id"] in after) == (lang != "und" and score > 1 / len(model.langs))
    assert len(after) >= 0.99 * len(before)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6])
def test_texts_in_a_script_of_no_learned_language_go(spark, n):
    words = ["the and with that", "der und nicht das", "los que una por", "les des dans pour", "il che della sono", "och att det som"]
    docs = [(i, f"{words[i % n]} " * 9, f"l{i % n}") for i in range(40)]
    odd = [(100, "Привет мир и труд"), (101, "世界和平"), (102, "Привет " * 500), (103, "12"), (105, "мир")]
    given = [(*x, "s", 1) for x in docs] + [(i, x, None, "s", 1) for i, x in odd]
    table = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"] for r in rows(cp.language(spark, table, SF))} == set(range(40))


def test_the_bar_follows_the_learned_scores(spark, steps):
    learned = steps[0].where(~langid.held_out(steps[0].doc_id))
    model = langid.learn(learned)
    found = [langid.label_texts([r["text"]], model)[0][1] for r in rows(learned)]
    chance = 1 / len(model.langs)
    assert chance < langid.bar(learned, model) < max(found) and langid.bar(learned, model) <= (min(found) + chance) / 2 + 0.25
    assert langid.bar(learned.limit(0), model) == chance + 1e-6


def test_one_of_each_group_stays(steps):
    before, after = rows(steps[1]), {r["doc_id"] for r in rows(steps[2])}
    sets = {r["doc_id"]: set(sh.shingle_set(r["text"], cp.SHINGLE_WORDS).tolist()) for r in before}
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and 100 * len(x & y) >= cp.PERCENT * len(x | y):
                a_, b_ = sorted((top(a), top(b)))
                up[b_] = a_
    assert after == {top(i) for i in ids} and len(after) < len(ids)


def test_passages_go(spark, steps):
    items = [decontaminate.words_of(r["text"]) for r in rows(spark.read.parquet(f"{SF}/benchmark.parquet"))]
    before, after = rows(steps[2]), {r["doc_id"] for r in rows(steps[3])}
    whole = {r["doc_id"] for r in before for x in items
             if b" ".join(x) in b" ".join(decontaminate.words_of(r["text"]))}
    assert whole and not whole & after
    assert len(after) >= len(before) - len(whole) - 2


def test_mixing_loses_none_and_repeats_little(steps):
    before, after = rows(steps[3]), rows(steps[4])
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
    assert len(before) < len(after) <= (cp.REPEATS + 0.2) * len(before)


def test_tokens_are_those_of_the_library(steps):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = sorted(rows(steps[4]), key=lambda r: (r["doc_id"], r["text"]))
    start = 0
    for found, doc in zip(sorted(rows(steps[5]), key=lambda r: r["start"]), docs, strict=True):
        ids = [*tokenizer.encode(doc["text"], add_special_tokens=False).ids, 2]
        assert found == {"doc_id": doc["doc_id"], "start": start, "n_tokens": len(ids),
                         "ids_crc32": zlib.crc32(np.array(ids, "<u4").tobytes())}
        start += len(ids)


def test_stages_bear_awkward_rows(spark):
    text = "the and of to in that is was for on " * 8
    docs = spark.createDataFrame(
        [(1, text, "en", "a", 1, "x"), (1, text, "en", "a", 1, "x"), (2, None, None, None, None, "x"), (3, "", "en", "", 0, "x"),
         (None, "der die das und " * 9, "de", "a", 5, "x"), (4, "123", "en", "b", 3, "x"), (5, "les des une " * 40_000, "fr", "b", 9, "x")],
        "doc_id long, text string, lang string, source string, n_chars long, score string")
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        for name, stage in cp.STAGES:
            now = cut_lineage(stage(spark, now, SF), name)
        assert (now.count() == 0) == empty


def test_registered_queries(spark):
    import __spark_entry__ as entry
    assert "pipeline" in entry.queries() and set(registry.QUERIES) <= set(entry.queries())
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in registry.QUERIES)] == []
