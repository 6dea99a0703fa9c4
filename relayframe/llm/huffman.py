"""Canonical length-limited Huffman codes over token ids, packed and unpacked by whole arrays."""

from __future__ import annotations

import numpy as np

#: Ids between two checkpoints of a block.
STEP = 128


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for the counts, 0 where a count is 0.

    Package-merge: coins of every symbol at each bit level, paired from the deepest level up; the
    2n - 2 cheapest at the top make the code. As leaves enter each level in order of weight,
    only how many leaves each level takes needs to be followed back.
    """
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols need codes of more than {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.float64)
    level, from_leaf = leaves, []
    for _ in range(limit - 1):
        from_leaf.append(np.ones(len(level), bool) if not from_leaf else is_leaf)
        packages = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, packages])
        order = np.argsort(both, kind="stable")
        level, is_leaf = both[order], order < len(leaves)
    from_leaf.append(is_leaf if limit > 1 else np.ones(len(level), bool))
    take = 2 * len(used) - 2
    ranks = np.zeros(len(used), np.int64)
    for flags in reversed(from_leaf):
        n = int(flags[:take].sum())
        ranks[:n] += 1
        take = 2 * (take - n)
    lengths[used] = ranks
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id), each one more than the last, at the top of 64 bits."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes = np.zeros(len(lengths), np.uint64)
    steps = np.uint64(1) << (np.uint64(64) - lengths[order].astype(np.uint64))
    # The sum of all steps is 2**64 at most, so no start wraps.
    codes[order] = np.cumsum(steps) - steps
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """For each next ``depth`` bits the id and its length, as ``id << 8 | length``."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    depth = int(lengths.max()) if len(lengths) else 0
    kind = np.uint32 if len(lengths) < 1 << 24 else np.uint64
    table = np.zeros(1 << depth, kind)
    entries = order.astype(kind) << kind(8) | lengths[order]
    filled = np.repeat(entries, np.int64(1) << (depth - lengths[order].astype(np.int64)))
    table[: len(filled)] = filled
    return table, depth


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bit stream of ``ids`` and the bit offset of every ``STEP``-th id."""
    ids = ids.astype(np.intp)
    size = lengths[ids]
    ends = np.cumsum(size, dtype=np.int64)
    offsets = ends - size
    if not len(ids):
        return b"", offsets
    code, word, bit = codes[ids], offsets >> 6, (offsets & 63).astype(np.uint64)
    words = np.zeros(int(ends[-1] + 63 >> 6) + 1, np.uint64)
    starts = np.flatnonzero(np.diff(word, prepend=-1))
    words[word[starts]] = np.bitwise_or.reduceat(code >> bit, starts)
    # A code that does not end in its word goes on in the next.
    at = starts[1:] - 1
    at = at[(ends[at] & 63 != 0) & (word[at] != ends[at] >> 6)]
    words[word[at] + 1] |= code[at] << (np.uint64(64) - bit[at])
    if (ends[-1] - 1) >> 6 != word[-1]:
        words[word[-1] + 1] |= code[-1] << (np.uint64(64) - bit[-1])
    return words.byteswap().tobytes()[: int(ends[-1] + 7 >> 3)], offsets[::STEP]


def unpack(payload: bytes, checkpoints: np.ndarray, n: int, table: np.ndarray, depth: int) -> np.ndarray:
    """The ``n`` ids of a block: every stretch between checkpoints advances by one id at a time."""
    if not n:
        return np.zeros(0, np.uint32)
    raw = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    windows = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    at, out = checkpoints.astype(np.int64), np.zeros((STEP, len(checkpoints)), np.uint32)
    last = n - STEP * (len(checkpoints) - 1)
    shift, mask = 32 - depth, (1 << depth) - 1
    for k in range(STEP):
        if k == last and last < STEP:
            at = at[:-1]
            if not len(at):
                break
        entry = table[(windows[at >> 3] >> (shift - (at & 7))) & mask]
        out[k, : len(at)] = entry >> 8
        at = at + (entry & 255)
    return out.T.reshape(-1)[:n]
