"""Language identification: script ranges, letter trigram scores of words, Viterbi labels.

A model holds, for each learned language, the logarithms of its trigram shares and how much of
its letters each script makes up. A word is scored only for languages that use its script. The
labels of a text's words are the path with the best sum of scores, less a penalty for each change
of language, so a passage in another language becomes a span of its own and a stray word does not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relayframe.llm.tables import columns_ddl, lean, read

#: Starts of the code point ranges that belong to one script each; 0 is any other.
SCRIPTS = [(0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
           (0x0600, "arabic"), (0x0700, ""), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"),
           (0x0A80, "gujarati"), (0x0B00, "odia"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
           (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
           (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, ""),
           (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, ""), (0x1E00, "latin"), (0x1F00, "greek"),
           (0x2000, ""), (0x3040, "kana"), (0x3100, ""), (0x3130, "hangul"), (0x3190, ""), (0x3400, "han"),
           (0xA000, ""), (0xAC00, "hangul"), (0xD7B0, ""), (0xF900, "han"), (0xFB00, "latin"), (0xFB10, ""),
           (0xFB50, "arabic"), (0xFE00, ""), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, ""),
           (0x20000, "han")]
UNDETERMINED = "und"
#: Hash slots of trigrams.
SLOTS = 1 << 16
#: A language takes a script if it makes up this share of the letters learned for it.
SCRIPT_SHARE = 0.001
#: Log score that a change of language must gain.
SWITCH = 12.0
#: Log score of a word for a language that does not use its script, next to those that do.
FOREIGN = -40.0
#: Words in a stretch of the path search, and characters searched together.
STRETCH, CHARS_AT_ONCE = 64, 1 << 20
_TOP = 0x110000  # one above the last code point


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: whether it is a letter, its lower case, its script number."""
    alpha = np.fromiter(map(str.isalpha, map(chr, range(_TOP))), bool, _TOP)
    lower = np.arange(_TOP, dtype=np.uint32)
    for i in np.flatnonzero(alpha):
        small = chr(i).lower()
        if len(small) == 1:
            lower[i] = ord(small)
    names = sorted({name for _, name in SCRIPTS})  # "" is number 0
    starts = np.array([start for start, _ in SCRIPTS])
    numbers = np.array([0] + [names.index(name) for _, name in SCRIPTS])
    return alpha, lower, numbers[np.searchsorted(starts, np.arange(_TOP), side="right")].astype(np.uint8)


N_SCRIPTS = len({name for _, name in SCRIPTS})


@dataclass
class Words:
    """The letter runs of several texts: where they stand, their scripts and trigram slots."""

    text: np.ndarray  # number of the text
    start: np.ndarray  # in characters of the text
    size: np.ndarray
    script: np.ndarray
    slots: np.ndarray  # one for each letter


def find_words(texts: list[str]) -> Words:
    alpha, lower, scripts = _tables()
    sizes = np.array([len(t) + 1 for t in texts])
    points = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = alpha[points]
    edges = np.diff(letter.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)
    # What is no letter is 0 and stands for the border of a word.
    small = np.where(letter, lower[points], 0).astype(np.uint64)
    at = np.flatnonzero(letter)
    before = np.where(at > 0, small[at - 1], 0)
    after = small[np.minimum(at + 1, len(small) - 1)]
    mixed = (before * np.uint64(0x9E3779B97F4A7C15) + small[at]) * np.uint64(0xC2B2AE3D27D4EB4F) + after
    slots = ((mixed * np.uint64(0x165667B19E3779F9)) >> np.uint64(48)).astype(np.int64) & (SLOTS - 1)
    bounds = np.cumsum(sizes)
    text = np.searchsorted(bounds, start, side="right")
    return Words(text, start - (bounds - sizes)[text], end - start, scripts[points[start]], slots)


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    texts, at = batch.column("text"), 0
    while at < len(texts):
        group, chars = [], 0
        while at + len(group) < len(texts) and chars < CHARS_AT_ONCE:
            group.append(texts[at + len(group)].as_py() or "")
            chars += len(group[-1])
        yield at, group
        at += len(group)


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for at, texts in _groups(batch):
            words = find_words(texts)
            owners = np.repeat(words.text, words.size)
            script = np.repeat(words.script, words.size)
            here = np.array(langs[at : at + len(texts)])
            for lang in set(here.tolist()):
                own = here[owners] == lang
                found = np.bincount(words.slots[own], minlength=SLOTS)
                scripts = np.bincount(script[own], minlength=N_SCRIPTS)
                counts[lang] = counts.get(lang, 0) + np.concatenate([found, scripts])
    for lang, found in counts.items():
        seen = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(found[seen], pa.int64())],
            ["lang", "slot", "n"])


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray  # of a slot for each language
    uses: np.ndarray  # whether a script is one of a language's


def learn(labelled: DataFrame) -> Model:
    """Counts the trigrams of all of ``labelled`` (text, lang); null texts and langs teach nothing.

    Counting is distributed; the driver gets at most ``SLOTS + N_SCRIPTS`` counters a language.
    """
    rows = labelled.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    counts = (rows.mapInArrow(lean(_learn), "lang string, slot int, n long")
              .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(counts["lang"].unique())
    table = np.zeros((SLOTS + N_SCRIPTS, len(langs)))
    table[counts["slot"].to_numpy(int), np.searchsorted(langs, counts["lang"].to_numpy(str))] = counts["n"]
    slots, scripts = table[:SLOTS] + 0.5, table[SLOTS:]
    scores = np.log(slots / slots.sum(axis=0, keepdims=True)).astype(np.float32)
    return Model(langs, scores, scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0, keepdims=True), 1))


def word_scores(words: Words, model: Model) -> np.ndarray:
    """Log scores of words by language, the best of a word at 0; 0 for all where no script fits."""
    ends = np.cumsum(words.size)
    sums = np.add.reduceat(model.scores[words.slots], ends - words.size, axis=0) if len(ends) else np.zeros((0, len(model.langs)))
    fits = model.uses[words.script]
    none = ~fits.any(axis=1, keepdims=True)
    sums = np.where(fits, sums, -np.inf)
    best = np.where(none, 0, sums.max(axis=1, keepdims=True, initial=-np.inf))
    return np.where(none, 0, np.maximum(sums - best, FOREIGN))


def best_labels(scores: np.ndarray, text: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The language number of every word on the best path of its text; ties stay or go first.

    Texts are cut into stretches. All stretches are searched side by side, from each language
    that may stand before them; then the stretches of a text are chained by those results. The
    path is the one that a search from word to word finds.
    """
    n, langs = scores.shape
    if not n:
        return np.zeros(0, np.int64)
    first = np.flatnonzero(np.diff(text, prepend=-1))
    place = np.arange(n) - np.repeat(first, np.diff(first, append=n))
    opens = np.flatnonzero(place % STRETCH == 0)
    row, column = np.cumsum(place % STRETCH == 0) - 1, place % STRETCH
    grid = np.zeros((STRETCH, len(opens), 1, langs), np.float32)
    grid[column, row, 0] = scores

    # Before a stretch stands one language, or, in the last case, none.
    before = np.vstack([np.where(np.eye(langs, dtype=bool), 0.0, -np.inf), np.zeros(langs)]).astype(np.float32)
    value = np.broadcast_to(before, (len(opens), langs + 1, langs))
    came, moved = [], []
    for k in range(STRETCH):
        top = value.argmax(axis=2)
        other = np.take_along_axis(value, top[:, :, None], 2) - np.float32(switch)
        moved.append(value < other)
        came.append(top)
        value = np.maximum(value, other) + grid[k]

    owner = text[opens]
    start = np.flatnonzero(np.diff(owner, prepend=-1))
    length = np.diff(start, append=len(opens))
    total = np.zeros((len(opens), langs))
    left = np.full((len(opens), langs), langs)
    total[start] = value[start, langs]
    for k in range(1, int(length.max())):
        now = start[length > k] + k
        through = total[now - 1][:, :, None] + value[now, :langs]
        left[now] = through.argmax(axis=1)
        total[now] = through.max(axis=1)
    state, entered = np.zeros(len(opens), np.int64), np.zeros(len(opens), np.int64)
    last = start + length - 1
    state[last] = total[last].argmax(axis=1)
    for k in range(int(length.max()) - 1, -1, -1):
        now = start[length > k] + k
        entered[now] = left[now, state[now]]
        inner = now[entered[now] < langs]
        state[inner - 1] = entered[inner]
    labels, every = np.zeros((STRETCH, len(opens)), np.int64), np.arange(len(opens))
    for k in range(STRETCH - 1, -1, -1):
        labels[k] = state
        state = np.where(moved[k][every, entered, state], came[k][every, entered], state)
    return labels[column, row]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))


def label_texts(texts: list[str], model: Model) -> list[tuple[str, float, list]]:
    """Language, score and spans of each text. Spans are ranges of characters from the first to
    the last word of one language."""
    out = [(UNDETERMINED, 0.0, [])] * len(texts)
    words = find_words(texts)
    langs = len(model.langs)
    if not len(words.text) or not langs:
        return out
    scores = word_scores(words, model)
    labels = best_labels(scores, words.text)
    letters = np.bincount(words.text * langs + labels, words.size, minlength=len(texts) * langs).reshape(-1, langs)
    pred = letters.argmax(axis=1)
    share = np.exp(scores)
    share = share[np.arange(len(labels)), pred[words.text]] / share.sum(axis=1)
    share[~model.uses[words.script].any(axis=1)] = 0
    sure = np.bincount(words.text, share * words.size, minlength=len(texts)) / np.maximum(letters.sum(axis=1), 1)
    heads = np.flatnonzero(np.diff(words.text * langs + labels, prepend=-1))
    tails = np.append(heads[1:], len(labels)) - 1
    spans: list[list] = [[] for _ in texts]
    for text, a, b, label in zip(words.text[heads].tolist(), words.start[heads].tolist(),
                                 (words.start[tails] + words.size[tails]).tolist(), labels[heads].tolist(), strict=True):
        spans[text].append({"start": a, "end": b, "lang": model.langs[label]})
    return [(model.langs[pred[i]], min(1.0, float(sure[i])), spans[i]) if spans[i] else out[i] for i in range(len(texts))]


def _predictor(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _groups(batch):
                found = label_texts(texts, model)
                rest = batch.slice(at, len(texts))
                columns = [pa.array([x[i] for x in found], kind)
                           for i, kind in enumerate((pa.string(), pa.float64(), _SPANS))]
                yield pa.RecordBatch.from_arrays([*rest.columns, *columns], [*rest.schema.names, "lang_pred", "score", "spans"])

    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``spans``, from ``text`` alone.

    The prediction is the language with most letters on the best path, the score the share that
    it gets of each word, averaged over letters; a word in a script of no learned language gives 0.
    Null texts and texts without a letter give ``und``, score 0 and no spans; so does everything if
    nothing was learned. Columns of ``docs`` with one of the three names are replaced.
    """
    rows = docs.drop("lang_pred", "score", "spans")
    ddl = "lang_pred string, score double, spans array<struct<start: long, end: long, lang: string>>"
    return rows.mapInArrow(lean(_predictor(model)), f"{columns_ddl(rows)}, {ddl}")


def bar(labelled: DataFrame, model: Model) -> float:
    """The score that a text must exceed to be in a learned language.

    It lies halfway between chance and the lowest score of the ``labelled`` rows (text, lang) whose label
    is found, so these all stay while they score above chance. With one language, whose
    share of a word is all or nothing, it is 0.
    """
    n = len(model.langs)
    if n < 2:
        return 0.0
    found = predict(labelled.select("text", "lang"), model).where("lang_pred = lang")
    lowest = found.agg(F.min("score")).first()[0]
    # Equal shares of single precision do not add up to 1 / n exactly.
    return 1 / n + max(1e-6, ((lowest or 0.0) - 1 / n) / 2)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the doc_id as text leaves 2 of 4; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = read(spark, sf_dir, "documents")
    model = learn(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    found = predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
