"""Word shingle sets and their sketches, computed a document at a time with whole arrays."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import xxhash

_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Multipliers of the finishing rounds of a 64-bit mix.
_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _step(i: int) -> np.uint64:
    return np.uint64(i * int(_GOLD) & (1 << 64) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for each ``size`` words in a row; a shorter text is one window."""
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        total = mix(total + words[i : i + len(total)] + _step(i + 1))
    return total


def shingle_set(text: str, size: int) -> np.ndarray:
    """The distinct shingle hashes of a text in ascending order."""
    return np.unique(window_hashes(word_hashes(text), size))


def set_digest(shingles: np.ndarray) -> bytes:
    """16 bytes that name a set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def bands_needed(similarity: float, rows: int, miss: float = 1e-6) -> int:
    """How many bands of ``rows`` miss a pair of ``similarity`` with at most the given chance."""
    return math.ceil(math.log(miss) / math.log1p(-(similarity ** rows)))


def similarity_sketch(shingles: np.ndarray, size: int) -> np.ndarray:
    """``size`` coordinates of a non-empty set, each a hash of the least element placed there.

    Round i throws every element into one random place with value i plus a random fraction, and
    places keep their least value, so a later round never changes a filled place. After ``size``
    rounds, round ``size + j`` throws all elements into place j, which fills what is still empty.
    Early rounds are thrown together, as many as are likely to fill every place. ``size`` stays
    below 2**16.
    """
    n, out = len(shingles), np.zeros(size, np.uint64)
    empty, done, width = np.ones(size, bool), 0, size.bit_length()
    # A key is place, round and fraction from the top, so the first of a place is its least value.
    to_place, to_round = np.uint64(64 - width), np.uint64(64 - 2 * width)
    fraction = (np.uint64(1) << to_round) - np.uint64(1)
    while done < size and empty.any():
        rounds = min(size - done, max(1, math.ceil(size * math.log(size) / n)))
        seeds = mix(np.arange(done + 1, done + rounds + 1, dtype=np.uint64) * _GOLD)
        thrown = mix(shingles[None, :] ^ seeds[:, None])
        place = (thrown >> np.uint64(40)) * np.uint64(size) >> np.uint64(24)
        key = (place << to_place) | (np.arange(rounds, dtype=np.uint64)[:, None] << to_round) | (thrown & fraction)
        key = np.sort(key, axis=None)
        place = (key >> to_place).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        first = first[empty[place[first]]]
        out[place[first]] = mix((key[first] << np.uint64(width)) + _step(done + 1))
        empty[place[first]] = False
        done += rounds
    for j in np.flatnonzero(empty):
        out[j] = mix(np.array([mix(shingles ^ mix(np.array([_step(size + int(j) + 1)]))).min()]) + np.uint64(j))[0]
    return out


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    """One hash for each band of ``rows`` coordinates, different in each band."""
    bands = sketch.reshape(-1, rows)
    total = np.arange(1, len(bands) + 1, dtype=np.uint64) * _GOLD
    for i in range(rows):
        total = mix(total + bands[:, i])
    return total.view(np.int64)


def sketch_bits(sketch: np.ndarray) -> np.ndarray:
    """Two bits of each coordinate, 32 coordinates to a word; those beyond whole words are left out."""
    pairs = (sketch[: len(sketch) // 32 * 32] & np.uint64(3)).reshape(-1, 32)
    return (pairs << (2 * np.arange(32, dtype=np.uint64))).sum(axis=1, dtype=np.uint64).view(np.int64)


def most_different(similarity: float, n: int, deviations: float = 4.5) -> int:
    """In how many of ``n`` bit pairs a pair of ``similarity`` differs, but for ``deviations`` sigma."""
    p = (1 - similarity) * 3 / 4
    return math.ceil(n * p + deviations * math.sqrt(n * p * (1 - p)))
