"""Minimal perfect hashing of integer keys, level by level.

On a level every key has a bit. A bit that only one key has is set and is that key's place; keys that share a bit go on to the
next level. A key's number is how many set bits come before its own, over all levels, so n keys get the numbers 0 to n - 1. Keys
that were not hashed may get any number, so whoever looks a key up compares it with the key kept at that number.
"""

from __future__ import annotations

import numpy as np

_LEVELS = 64
# Bits of a level for each key that enters it.
_ROOM = 2


def _at(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(bits)).astype(np.int64)


def build(keys: np.ndarray) -> list[bytes]:
    """The bits of each level for distinct keys."""
    levels, left = [], keys
    while len(left):
        if len(levels) == _LEVELS:
            raise ValueError("the keys of a perfect hash are not distinct")
        bits = -(-_ROOM * len(left) // 64) * 64
        at = _at(left, len(levels), bits)
        alone = np.bincount(at, minlength=bits) == 1
        levels.append(np.packbits(alone, bitorder="little").tobytes())
        left = left[~alone[at]]
    return levels


class PerfectHash:
    def __init__(self, levels: list[bytes]):
        self.words = [np.frombuffer(level, np.uint64) for level in levels]
        self.before, n = [], 0
        for words in self.words:
            counts = np.bitwise_count(words).astype(np.int64)
            self.before.append(n + np.cumsum(counts) - counts)
            n += int(counts.sum())
        self.size = n

    def number(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for some of those that were not hashed."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (words, before) in enumerate(zip(self.words, self.before)):
            at = _at(keys[left], level, 64 * len(words))
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            found = (word >> bit & np.uint64(1)).astype(bool)
            below = word[found] & ((np.uint64(1) << bit[found]) - np.uint64(1))
            out[left[found]] = before[at[found] >> 6] + np.bitwise_count(below)
            left = left[~found]
            if not len(left):
                break
        return out
