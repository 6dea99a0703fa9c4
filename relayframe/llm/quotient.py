"""Counting quotient filters over packed n-grams, with whole arrays.

An n-gram is packed into a key of one or more limbs, ``bits`` a word. An invertible permutation of the
key space spreads the keys evenly, whatever the n-grams. A filter holds keys in permuted order: the top
bits of the first limb, the quotient, are not stored but counted by slot; all other bits, the
remainder, are stored in full, so keys are recovered exactly and counts are never shared. Filters of
different tasks agree on the order and are merged like sorted runs.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass
from functools import cached_property

import numpy as np

_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ROUNDS = 3
_HEAD = struct.Struct("<QBBQ")  # keys, quotient bits in all, bytes of a slot's count, large counts


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _tail(values: np.ndarray, bits: int) -> bytes:
    """The low ``bits`` of each value, in whole bytes."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : (bits + 7) // 8].tobytes()


@dataclass(frozen=True)
class Packing:
    """Keys of up to ``words`` word ids of ``bits`` bits; id 0 pads shorter n-grams."""

    words: int
    bits: int

    @cached_property
    def widths(self) -> list[int]:
        """Bits of each limb."""
        per = min(self.words, 64 // self.bits)
        return [self.bits * min(per, self.words - i) for i in range(0, self.words, per)]

    def pack(self, ids: list[np.ndarray]) -> list[np.ndarray]:
        """Limbs of the n-grams whose i-th words are ``ids[i]``."""
        limbs, at = [], 0
        for width in self.widths:
            limb = np.zeros(len(ids[0]), np.uint64)
            for _ in range(width // self.bits):
                limb <<= np.uint64(self.bits)
                if at < len(ids):
                    limb |= ids[at].astype(np.uint64)
                at += 1
            limbs.append(limb)
        return limbs

    def unpack(self, limbs: list[np.ndarray]) -> np.ndarray:
        """One row of ``words`` ids for each key."""
        out = []
        for limb, width in zip(limbs, self.widths, strict=True):
            out += [limb >> np.uint64(shift) & _mask(self.bits) for shift in range(width - self.bits, -1, -self.bits)]
        return np.stack(out, axis=1).astype(np.int64)

    def _steps(self) -> list[tuple[int, int, np.uint64]]:
        n = len(self.widths)
        return [(i, (i + 1) % n, np.uint64(r * n + i + 1)) for r in range(_ROUNDS) for i in range(n)]

    def permute(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        """An invertible map of the key space onto itself that spreads keys over the first limb."""
        limbs = list(limbs)
        if len(limbs) == 1:
            width, x = self.widths[0], limbs[0]
            for factor in _MIX:
                x = x ^ (x >> np.uint64((width + 1) // 2))
                x = x * factor & _mask(width)
            return [x ^ (x >> np.uint64((width + 1) // 2))]
        for i, j, salt in self._steps():
            limbs[i] = limbs[i] ^ (_mixed(limbs[j] + salt) & _mask(self.widths[i]))
        return limbs

    def restore(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        """The inverse of ``permute``."""
        limbs = list(limbs)
        if len(limbs) == 1:
            width, x = self.widths[0], limbs[0]
            x = x ^ (x >> np.uint64((width + 1) // 2))
            for factor in reversed(_MIX):
                x = x * np.uint64(pow(int(factor), -1, 1 << width)) & _mask(width)
                x = x ^ (x >> np.uint64((width + 1) // 2))
            return [x]
        for i, j, salt in reversed(self._steps()):
            limbs[i] = limbs[i] ^ (_mixed(limbs[j] + salt) & _mask(self.widths[i]))
        return limbs


@dataclass
class Filter:
    """Permuted keys in ascending order, each once, and how often each occurs."""

    packing: Packing
    limbs: list[np.ndarray]
    counts: np.ndarray

    @classmethod
    def of(cls, packing: Packing, limbs: list[np.ndarray], counts: np.ndarray | None = None) -> Filter:
        """Sorts permuted keys and adds up the counts of equal ones."""
        if len(limbs) == 1 and counts is None:
            limbs = [np.sort(limbs[0])]
        else:
            order = np.argsort(limbs[0], kind="stable")
            tied = np.flatnonzero(np.diff(limbs[0][order]) == 0)
            # Only where first limbs are equal and others are not does their order matter.
            if any((x[order[tied]] != x[order[tied + 1]]).any() for x in limbs[1:]):
                order = np.lexsort(limbs[::-1])
            limbs = [x[order] for x in limbs]
            counts = None if counts is None else counts[order]
        n = len(limbs[0])
        new = np.zeros(n, bool)
        new[:1] = True
        for x in limbs:
            new[1:] |= x[1:] != x[:-1]
        first = np.flatnonzero(new)
        if counts is None:
            summed = np.diff(first, append=n)
        else:
            summed = np.add.reduceat(counts, first) if n else counts
        return cls(packing, [x[first] for x in limbs], summed.astype(np.int64))

    @classmethod
    def merged(cls, filters: list[Filter]) -> Filter:
        limbs = [np.concatenate(x) for x in zip(*(f.limbs for f in filters), strict=True)]
        return cls.of(filters[0].packing, limbs, np.concatenate([f.counts for f in filters]))

    def __len__(self) -> int:
        return len(self.counts)

    def ranges(self, bits: int) -> list[tuple[int, Filter]]:
        """The parts of the filter by the top ``bits`` of the quotient, without empty ones."""
        top = (self.limbs[0] >> np.uint64(self.packing.widths[0] - bits)).astype(np.int64)
        first = np.flatnonzero(np.diff(top, prepend=-1))
        ends = [*first[1:].tolist(), len(self)]
        return [(int(top[a]), Filter(self.packing, [x[a:b] for x in self.limbs], self.counts[a:b]))
                for a, b in zip(first.tolist(), ends, strict=True)]

    def encode(self, bits: int) -> bytes:
        """A part of one range of ``bits`` bits: counts by slot, remainders, counters of a byte or more."""
        width, n = self.packing.widths[0], len(self)
        quotient = min(width, bits + max(1, n.bit_length()))
        slot = (self.limbs[0] >> np.uint64(width - quotient)) & _mask(quotient - bits)
        held = np.bincount(slot.astype(np.int64), minlength=1 << (quotient - bits))
        wide = 1 if held.max(initial=0) < 256 else 8
        large = self.counts >= 255
        return b"".join([
            _HEAD.pack(n, quotient, wide, int(large.sum())), held.astype(f"<u{wide}").tobytes(),
            _tail(self.limbs[0] & _mask(width - quotient), width - quotient),
            *[_tail(x, w) for x, w in zip(self.limbs[1:], self.packing.widths[1:], strict=True)],
            np.where(large, 255, self.counts).astype(np.uint8).tobytes(), self.counts[large].astype("<i8").tobytes()])

    @classmethod
    def decode(cls, packing: Packing, data: bytes, at: int, bits: int) -> Filter:
        """The part that ``encode`` wrote for range ``at``."""
        n, quotient, wide, n_large = _HEAD.unpack_from(data)
        place, slots, width = _HEAD.size, 1 << (quotient - bits), packing.widths[0]

        def take(size: int) -> np.ndarray:
            nonlocal place
            place += size
            return np.frombuffer(data, np.uint8, size, place - size)

        def tail(n_bits: int) -> np.ndarray:
            size = (n_bits + 7) // 8
            whole = np.zeros((n, 8), np.uint8)
            whole[:, :size] = take(n * size).reshape(n, size)
            return whole.view("<u8").reshape(n)

        held = take(slots * wide).view(f"<u{wide}").astype(np.int64)
        slot = np.repeat(np.arange(slots, dtype=np.uint64), held) + np.uint64(at << (quotient - bits))
        limbs = [slot << np.uint64(width - quotient) | tail(width - quotient)] if quotient < width else [slot]
        limbs += [tail(w) for w in packing.widths[1:]]
        counts = take(n).astype(np.int64)
        counts[counts == 255] = take(8 * n_large).view("<i8")
        return cls(packing, limbs, counts)


class Counting:
    """Counts packed n-grams into filters of a bounded number of keys."""

    def __init__(self, packing: Packing, most: int):
        self.packing, self.most = packing, most
        self.waiting: list[list[np.ndarray]] = []
        self.n_waiting, self.held = 0, None

    def add(self, limbs: list[np.ndarray]) -> Filter | None:
        """Takes keys in; now and then gives a full filter, which is then forgotten here."""
        if len(limbs[0]):
            self.waiting.append(self.packing.permute(limbs))
            self.n_waiting += len(limbs[0])
        if self.n_waiting < self.most:
            return None
        self._count()
        return self.finish() if len(self.held) >= self.most else None

    def _count(self) -> None:
        if self.waiting:
            new = Filter.of(self.packing, [np.concatenate(x) for x in zip(*self.waiting, strict=True)])
            self.held = Filter.merged([self.held, new]) if self.held else new
            self.waiting, self.n_waiting = [], 0

    def finish(self) -> Filter | None:
        """What is still held, if anything."""
        self._count()
        held, self.held = self.held, None
        return held
