"""PII surrogates: entities are replaced by others of their kind, gender, script and format.

An entity is split into its variable characters and what frames them. The variable characters are
a number in mixed radix (digits, hex digits, vowels and consonants of an alphabet, places in a list of
first names), and a keyed cyclic permutation of all numbers of that format gives the surrogate's.
So one entity has one surrogate wherever it stands and however it is punctuated, two entities
never share one, and none stays as it is; a surrogate that would read as another kind is
passed over along the cycle. ``checked_salt`` verifies this over all entities of a corpus.
Letters and digits of any script vary; of punctuation only that of a secret that has nothing else.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect
from collections.abc import Callable, Iterator
from functools import cache, lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relayframe.llm.tables import columns_ddl, read

#: First names by script and gender.
FIRST_NAMES = {
    ("latin", "f"): "Alice Amélie Anna Camille Carmen Clara Elena Elizabeth Emma Hannah Ingrid Isabel Julia Laura Lucía "
                    "María Marie Martha Olivia Petra Sarah Sofía Sophie Ursula".split(),
    ("latin", "m"): "Alejandro Antonio Carlos Charles Daniel David Dieter Étienne François Hans Heinrich James John José "
                    "Jürgen Louis Manuel Michael Paul Pierre Robert Stefan Thomas William".split(),
    ("cyrillic", "f"): "Анна Вера Галина Елена Ирина Людмила Мария Надежда Наталья Ольга Светлана Татьяна".split(),
    ("cyrillic", "m"): "Алексей Андрей Борис Владимир Дмитрий Иван Михаил Николай Павел Сергей Фёдор Юрий".split(),
    ("greek", "f"): "Αθηνά Άννα Ειρήνη Ελένη Κατερίνα Μαρία Σοφία Χριστίνα".split(),
    ("greek", "m"): "Αλέξανδρος Γιώργος Δημήτρης Ιωάννης Κώστας Νίκος Παύλος Σπύρος".split(),
}
#: Forms of address and the gender they tell.
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Herr": "m", "Herrn": "m", "Frau": "f", "Monsieur": "m", "Madame": "f",
          "Mademoiselle": "f", "Señor": "m", "Señora": "f", "Señorita": "f", "Господин": "m", "Госпожа": "f", "Κύριος": "m",
          "Κυρία": "f"}
#: Letters that replace each other, vowels and consonants of an alphabet apart.
ALPHABETS = ["aeiou", "bcdfghjklmnpqrstvwxyz", "àâäáãå", "éèêë", "íìîï", "óòôöõ", "úùûü", "çñ", "аеёиоуыэюя",
             "бвгджзйклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ", "άέήίόύώ", "0123456789"]
#: The letters of names that are in none of these; upper case is listed where it differs in kind.
_OTHERS = ["æðøýþÿ", "ÆÐØÝÞ", "ъь", "ЪЬ", "ΰςϊϋ"]
_CLASS = {c: letters for x in ALPHABETS for letters in (x.upper(), x) for c in letters} | {
    c: letters for letters in _OTHERS for c in letters}
_MARKS = "!#$%&()*+,-./:;=?@[\\]^_`{|}~"
#: A value that stands for a secret without telling it, or a ruled line.
_MASKED = re.compile(r"(?:AKIA|gh[opsu]_|sk-)?[*•●○◦∙·…▪■█×_\-=.#~]+[,;:)\]}|]*")
#: Salts tried before it is said that none helps.
SALTS = 20
_GENDER = {name: key for key, names in FIRST_NAMES.items() for name in names}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_CAPITAL = r"[A-ZÀ-ÖØ-ÞА-ЯЁΆ-Ω][a-zà-öø-ÿа-яёά-ώ]+(?:-[A-ZÀ-ÖØ-ÞА-ЯЁΆ-Ω][a-zà-öø-ÿа-яёά-ώ]+)?"
#: Kinds in order of precedence; group ``x`` is the entity where more is matched.
KINDS = {
    "secret": re.compile(r"""(?<![\w])(?P<x>[0-9a-fA-F]{32,}|AKIA[0-9A-Z]{16}|gh[opsu]_\w{20,}|sk-[\w-]{20,})(?![\w])"""
                         r"""|(?i:\b(?:token|api[_-]?key|secret|passw(?:or)?d)["']?\s*[=:]\s*["']?)(?P<y>[^\s"'<>]{6,})"""),
    "email": re.compile(r"[\w.%+\-]{1,64}@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,}"),
    "ip": re.compile(rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    "phone": re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .\-]?)?\(\d{2,4}\)[ .\-]?\d{3,4}[ .\-]?\d{3,4}(?!\w)"
                        r"|(?<![\w+])\+\d{1,3}(?:[ .\-]?\d{2,4}){2,5}(?!\w)"),
    "ssn": re.compile(r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])"),
    "card": re.compile(r"(?<![\w.])(?:\d{13,19}|\d{4}([ \-])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ \-])\d{6}\2\d{5})(?!\w)"),
    "name": re.compile(rf"\b(?P<title>{'|'.join(TITLES)})\.? (?P<x>{_CAPITAL}(?: {_CAPITAL})?)"
                       rf"|\b(?P<y>(?:{'|'.join(_GENDER)}) {_CAPITAL})"),
}
#: What a text must hold for a kind to be looked for.
_HINTS = {"email": re.compile("@"), "name": re.compile("|".join([*TITLES, *_GENDER]))}
_DIGIT = re.compile(r"\d")
_HEX = re.compile(r"[0-9a-fA-F]{32}")
_SECRET_WORDS = ("token", "api", "secret", "passw", "akia", "gho_", "ghp_", "ghs_", "ghu_", "sk-")


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, gender) of all entities; earlier kinds win where two overlap."""
    found = []
    digits, small = bool(_DIGIT.search(text)), text.lower()
    for kind, pattern in KINDS.items():
        hint = _HINTS.get(kind)
        if kind == "secret" and not any(w in small for w in _SECRET_WORDS) and not (digits and _HEX.search(text)):
            continue
        if hint and not hint.search(text):
            continue
        if not digits and kind in ("ip", "iban", "phone", "ssn", "card"):
            continue
        for m in pattern.finditer(text):
            group = next((g for g in ("x", "y") if g in pattern.groupindex and m[g]), 0)
            if kind == "secret" and _MASKED.fullmatch(m[group]):
                continue
            if kind == "email" and not any(map(str.isalnum, m[0].rpartition(".")[0])):
                continue
            gender = TITLES.get(m["title"], "") if kind == "name" and m["title"] else ""
            found.append((*m.span(group), kind, gender))
    rank = {kind: i for i, kind in enumerate(KINDS)}
    kept: list[tuple[int, int, str, str]] = []
    for entity in sorted(found, key=lambda e: (rank[e[2]], e[0])):
        at = bisect(kept, entity)
        if (not at or kept[at - 1][1] <= entity[0]) and (at == len(kept) or entity[1] <= kept[at][0]):
            kept.insert(at, entity)
    return kept


class Cipher:
    """A keyed cyclic permutation of the numbers below ``n``: one cycle through all of them."""

    def __init__(self, key: bytes, label: str, n: int):
        self.n, self.key = n, hashlib.blake2b(f"{label}:{n}".encode(), key=key[:64], digest_size=32).digest()
        self.half = max(1, ((n - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1

    def _round(self, i: int, x: int) -> int:
        size = (self.half + 7) // 8
        data = bytes([i]) + x.to_bytes(size, "big")
        return int.from_bytes(hashlib.shake_256(self.key + data).digest(size), "big") & self.mask

    def _forth(self, x: int) -> int:
        while True:
            a, b = x >> self.half, x & self.mask
            for i in range(6):
                a, b = b, a ^ self._round(i, b)
            x = a << self.half | b
            if x < self.n:
                return x

    def _back(self, x: int) -> int:
        while True:
            a, b = x >> self.half, x & self.mask
            for i in reversed(range(6)):
                a, b = b ^ self._round(i, a), a
            x = a << self.half | b
            if x < self.n:
                return x

    def next(self, x: int) -> int:
        return self._back((self._forth(x) + 1) % self.n)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _kind_of_char(c: str) -> tuple:
    cased = len(c.upper()) == 1 and c.upper().lower() == c
    return ord(c) >> 8, unicodedata.category(c), c.lower() == c, cased


def _varies(c: str) -> bool:
    return not (c.isascii() or c in _CLASS or c.isspace() or "\ud800" <= c <= "\udfff")


def _block(c: str) -> str:
    first, own = ord(c) & ~255, _kind_of_char(c)
    return "".join(x for x in map(chr, range(first, first + 256)) if _varies(x) and _kind_of_char(x) == own)


@cache
def _single() -> dict[tuple, str]:
    """The characters that are the only ones of their kind in their block, by what else they share."""
    found: dict[tuple, str] = {}
    for first in range(0, 0x110000, 256):
        kinds: dict[tuple, str] = {}
        for c in filter(_varies, map(chr, range(first, first + 256))):
            own = _kind_of_char(c)
            kinds[own] = kinds.get(own, "") + c
        for own, chars in kinds.items():
            if len(chars) == 1:
                found[own[1:]] = found.get(own[1:], "") + chars
    return found


@lru_cache(maxsize=1 << 12)
def _letters(c: str) -> str | None:
    """What may replace a character: its alphabet, else the others of its kind in its block of 256
    code points, or, if it is the only one there, those of which the same is true."""
    if not _varies(c):
        return _CLASS.get(c)
    letters = _block(c)
    if len(letters) < 2:
        letters = _single()[_kind_of_char(c)[1:]]
    return letters if len(letters) > 1 else None


def _shape(kind: str, text: str) -> list[str | None]:
    """For each character of a normal form the characters that may stand there; None is fixed."""
    if kind == "secret" and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text):
        return ["0123456789abcdef" if text == text.lower() else "0123456789ABCDEF"] * len(text)
    fixed = {"email": len(text) - text.rindex(".") if "." in text else 0}.get(kind, 0)
    head = {"iban": 4, "card": 1}.get(kind, 0)
    if kind == "secret":
        head = len(re.match(r"(?:AKIA|gh[opsu]_|sk-)?", text)[0])
    if kind == "phone" and text.startswith("+"):
        head = 1 + len(re.match(r"\+(1|7|\d{2})", text)[1])
    out: list[str | None] = []
    for i, c in enumerate(text):
        letters = _CLASS.get(c) if kind == "last" else _letters(c)
        out.append(letters if head <= i < len(text) - fixed else None)
    if kind == "secret" and not any(out):
        out = [_MARKS if i >= head and c in _MARKS else None for i, c in enumerate(text)]
    return out


def _permuted(kind: str, text: str, key: bytes, fits: Callable[[str], bool] = lambda _: True) -> str:
    """The next text of the same shape along the keyed cycle that ``fits``; itself if there is no other."""
    shape = _shape(kind, text)
    places = [i for i, letters in enumerate(shape) if letters]
    n = 1
    for i in places:
        n *= len(shape[i])
    if n < 2:
        return text
    label = f"{kind}:{''.join(c if letters is None else letters[0] for c, letters in zip(text, shape, strict=True))}"
    cipher, value = Cipher(key, label, n), 0
    for i in places:
        value = value * len(shape[i]) + shape[i].index(text[i])
    while True:
        value = cipher.next(value)
        rest, out = value, list(text)
        for i in reversed(places):
            rest, digit = divmod(rest, len(shape[i]))
            out[i] = shape[i][digit]
        if fits("".join(out)):
            return "".join(out)


def normal(kind: str, text: str) -> str:
    """The form in which mentions of one entity are equal."""
    if kind == "email":
        return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    if kind == "ip":
        return ".".join(str(int(x)) for x in text.split("."))
    if kind in ("phone", "ssn", "card"):
        return re.sub(r"[^\d+]", "", text)
    return text.replace(" ", "") if kind == "iban" else text


def _iban_checked(text: str) -> str:
    number = "".join(str(int(c, 36)) for c in f"{text[4:]}{text[:2]}00")
    return f"{text[:2]}{98 - int(number) % 97:02d}{text[4:]}"


def _first_name(name: str, gender: str, key: bytes) -> str:
    script, known = _GENDER[name]
    names = FIRST_NAMES[script, known]
    return names[Cipher(key, f"first:{script}:{known}", len(names)).next(names.index(name))]


@lru_cache(maxsize=1 << 16)
def surrogate(kind: str, text: str, key: bytes) -> str:
    """The surrogate of a normal form, itself one."""
    if kind == "ip":
        a, b, c, d = (int(x) for x in text.split("."))
        value = Cipher(key, "ip", 1 << 32).next(a << 24 | b << 16 | c << 8 | d)
        return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))
    if kind == "name":
        # Parts have their own surrogates, so a surname alone goes with the full name.
        return " ".join(_first_name(x, "", key) if x in _GENDER else _permuted("last", x, key, lambda y: y not in _GENDER)
                        for x in text.split(" "))
    if kind == "iban":
        return _iban_checked(_permuted(kind, text, key))
    if kind == "card":
        valid = _luhn(text)
        return _permuted(kind, text, key, lambda y: _luhn(y) == valid)
    if kind == "email":
        local, _, domain = text.partition("@")
        return f"{_permuted('local', local, key)}@{_permuted('email', domain, key)}"
    if kind == "secret":
        return _permuted(kind, text, key, lambda y: not _MASKED.fullmatch(y))
    return _permuted(kind, text, key)


def _dressed(kind: str, text: str, replacement: str) -> str:
    """The surrogate with the punctuation and case of the mention."""
    if kind in ("phone", "ssn", "card", "iban"):
        rest = iter(replacement)
        fill = str.isalnum if kind == "iban" else lambda c: c.isdigit() or c == "+"
        return "".join(next(rest) if fill(c) else c for c in text)
    if kind == "email":
        return "".join(r.upper() if c.isupper() else r for c, r in zip(text, replacement, strict=True))
    return replacement


def replace(text: str, key: bytes) -> tuple[str, list[tuple[str, str, str]]]:
    """The text with surrogates, and (kind, normal form, surrogate) of every mention."""
    out, at, done = [], 0, []
    for start, end, kind, _ in find(text):
        entity = normal(kind, text[start:end])
        other = surrogate(kind, entity, key)
        out += [text[at:start], _dressed(kind, text[start:end], other)]
        done.append((kind, entity, other))
        at = end
    return "".join([*out, text[at:]]), done


def _mentions(key: bytes) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = {x for text in batch.column("text") for x in replace(text.as_py() or "", key)[1]}
            digest = [[hashlib.blake2b(f"{kind}\0{x}".encode(), key=key[:64], digest_size=16).digest()
                       for kind, *pair in seen for x in [pair[i]]] for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in digest], ["entity", "surrogate"])

    return run


def checked_salt(docs: DataFrame, key: bytes) -> bytes:
    """The key, salted anew while two entities of ``docs`` share a surrogate.

    Entities meet by keyed digests of themselves and their surrogates; the driver gets two counts.
    ValueError if an entity is its own surrogate, which no salt changes, or if ``SALTS`` salts do not help.
    """
    for salt in range(SALTS):
        salted = hashlib.blake2b(salt.to_bytes(4, "big"), key=key[:64], digest_size=32).digest()
        pairs = docs.select("text").mapInArrow(_mentions(salted), "entity binary, surrogate binary").distinct()
        shared = pairs.groupBy("surrogate").agg(F.min("entity").alias("a"), F.max("entity").alias("b"),
                                                F.max(F.col("entity") == F.col("surrogate")).alias("same"))
        n_shared, n_same = shared.agg(F.count_if(F.expr("a < b")), F.count_if("same")).first()
        if n_same:
            raise ValueError(f"{n_same} entities have no character that can be replaced")
        if not n_shared:
            return salted
    raise ValueError(f"{n_shared} surrogates are shared under each of {SALTS} salts")


_COLUMNS = "surrogate_text string, n_entities long, kinds array<string>"


def _replacer(key: bytes) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(None, []) if x is None else replace(x, key) for x in batch.column("text").to_pylist()]
            columns = [pa.array([t for t, _ in found], pa.string()), pa.array([len(e) for _, e in found], pa.int64()),
                       pa.array([sorted({k for k, *_ in e}) for _, e in found], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns],
                                             [*batch.schema.names, "surrogate_text", "n_entities", "kinds"])

    return run


def pseudonymize(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with ``surrogate_text``, ``n_entities`` and ``kinds``; their columns of these names go.

    Null stays null and empty text empty. No row moves; the check before it moves digests only.
    """
    salted = checked_salt(docs, key)
    rows = docs.drop("surrogate_text", "n_entities", "kinds")
    return rows.mapInArrow(_replacer(salted), f"{columns_ddl(rows)}, {_COLUMNS}")


#: The key of the registered query. A user keeps their own secret.
KEY = b"surrogates of the registered query"


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates in place of their entities."""
    done = pseudonymize(read(spark, sf_dir, "documents").select("doc_id", "text"), KEY)
    return done.select("doc_id", F.col("surrogate_text").alias("text"), "n_entities", F.array_join("kinds", ",").alias("kinds"))
