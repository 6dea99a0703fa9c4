import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from relayframe.llm import langid
from relayframe.llm.tables import read

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = read(spark, SF, "documents")
    return langid.learn(docs.where(~langid.held_out(F.col("doc_id"))))


def test_held_out_follows_crc32(spark):
    rows = spark.range(50).select("id", langid.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)


def test_held_out_accuracy(spark):
    found = langid.op3_language(spark, SF).where("held_out").join(read(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    assert found.where("lang_pred = lang").count() >= 0.98 * found.count() > 0


def test_paths_equal_a_search_from_word_to_word():
    rng = np.random.default_rng(2)
    sizes = [1, 63, 64, 65, 200, 3, 128, 1]
    text = np.repeat(np.arange(len(sizes)) * 2, sizes)
    scores = np.round(rng.normal(0, 9, (len(text), 3)) + np.repeat(rng.normal(0, 9, (len(text) // 10 + 1, 3)), 10, axis=0)[: len(text)], 3)
    labels = langid.best_labels(scores.astype(np.float32), text)

    def worth(path, own):
        return own[np.arange(len(path)), path].sum() - langid.SWITCH * (np.diff(path) != 0).sum()

    for i in set(text):
        own = scores[text == i]
        value, came = own[0].copy(), []
        for s in own[1:]:
            best = value.argmax()
            moves = value < value[best] - langid.SWITCH
            came.append(np.where(moves, best, np.arange(3)))
            value = np.where(moves, value[best] - langid.SWITCH, value) + s
        path = [int(value.argmax())]
        for c in reversed(came):
            path.append(int(c[path[-1]]))
        assert worth(labels[text == i], own) == pytest.approx(worth(np.array(path[::-1]), own), abs=1e-2)


def test_mixed_text_has_spans(spark, model):
    docs = {r["lang"]: r["text"] for r in read(spark, SF, "documents").where("n_chars > 900").collect()}
    a, b = docs["de"][:400], docs["es"][:700]
    (lang, score, spans), = langid.label_texts([f"{a}\n{b}"], model)
    assert lang == "es" and [s["lang"] for s in spans] == ["de", "es"]
    assert abs(spans[1]["start"] - len(a)) < 30 and 0 < score < 1


def test_what_has_no_letter_is_undetermined(spark, model):
    rows = [(1, None, "a"), (2, "", "b"), (3, "123 !? 😀", "c"), (4, "the and of", None), (4, "the and of", None),
            (None, "der die und", "x"), (5, "Привет мир", "y"), (6, "x" * 200_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    found = langid.predict(docs, model).collect()
    assert len(found) == len(rows) and {r["doc_id"] for r in found if r["lang_pred"] == "und"} == {1, 2, 3}
    assert all(0 <= r["score"] <= 1 for r in found) and all(r["lang_pred"] in [*model.langs, "und"] for r in found)


def test_scripts_narrow_candidates(spark):
    rows = [("мир и труд", "ru"), ("peace and work", "en"), (None, "xx"), ("text", None)] * 3
    model = langid.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert model.langs == ["en", "ru"]
    assert [x[0] for x in langid.label_texts(["книга", "zzz", "世界"], model)][:2] == ["ru", "en"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = langid.learn(none)
    assert model.langs == [] and langid.predict(none, model).collect() == []
    some = spark.createDataFrame([(1, "words")], "doc_id long, text string")
    assert langid.predict(some, model).first()["lang_pred"] == "und"


def test_words_keep_their_places():
    rng = random.Random(4)
    texts = ["".join(rng.choice("aé ß1\n😀Жİ") for _ in range(60)) for _ in range(20)] + [""]
    words = langid.find_words(texts)
    for t, a, n in zip(words.text, words.start, words.size, strict=True):
        assert texts[t][a : a + n].isalpha()
    assert sum(words.size) == sum(c.isalpha() for t in texts for c in t)


def test_letters_of_all_planes_are_letters():
    for text in ("\U00032010", "a\U000323af", "\U00020000 x"):
        assert langid.find_words([text]).size.sum() == sum(map(str.isalpha, text))
