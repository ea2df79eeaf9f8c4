"""A minimal perfect hash over a set of 128-bit key hashes, as one byte string.

Keys are placed level by level. A level has twice as many bits as keys are left; a key whose place no other key of the
level takes sets its bit and is done, the others go on. The number of set bits before a key's bit is its slot, so n keys
take the slots 0 to n - 1. A running count every 512 bits makes a look-up a constant number of steps a level. Keys
that were never in the set get some slot or none, so callers compare a stored fingerprint.
"""

from __future__ import annotations

import numpy as np

SPARE = 2
BLOCK_WORDS = 8
MAGIC = b"LMPH0001"


def mixed(first: np.ndarray, second: np.ndarray, level: int) -> np.ndarray:
    """A hash of its own for each level."""
    x = first + second * np.uint64(2 * level + 1) + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def place(first: np.ndarray, second: np.ndarray, level: int, bits: int) -> np.ndarray:
    """A bit of the level, from the upper half of the hash."""
    return ((mixed(first, second, level) >> np.uint64(32)) * np.uint64(bits) >> np.uint64(32)).astype(np.int64)


def fingerprints(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """32 bits of a key that its slots do not depend on."""
    return mixed(second, first, 1 << 20).astype(np.uint32)


def build(first: np.ndarray, second: np.ndarray) -> bytes:
    """The function for distinct (first, second) pairs of unsigned 64-bit hashes, at most 2 ** 31 of them."""
    levels, left = [], np.arange(len(first))
    while len(left):
        bits = max(64, SPARE * len(left) + 63 & ~63)
        at = place(first[left], second[left], len(levels), bits)
        taken = np.bincount(at, minlength=bits)
        levels.append(np.packbits(taken == 1, bitorder="little").view("<u8"))
        left = left[taken[at] != 1]
        if len(levels) > 200:
            raise ValueError("two keys have the same hash")
    words = np.concatenate([np.empty(0, "<u8"), *levels])
    ones = np.bitwise_count(words).astype(np.int64)
    before = np.concatenate([[0], np.cumsum(ones)])[: len(words) : BLOCK_WORDS].astype("<u4")
    head = np.array([len(first), len(levels), len(words), *(len(x) for x in levels)], "<u4")
    return MAGIC + head.tobytes() + words.tobytes() + before.tobytes()


class PerfectHash:
    """Reads what ``build`` made, from the start of a byte string; ``end`` is where it ends."""

    def __init__(self, data: bytes) -> None:
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a perfect hash")
        at = len(MAGIC)
        self.keys, levels, words = np.frombuffer(data, "<u4", 3, at).tolist()
        self.sizes = np.frombuffer(data, "<u4", levels, at + 12).astype(np.int64)
        at += 12 + 4 * levels
        self.words = np.frombuffer(data, "<u8", words, at)
        at += 8 * words
        counts = -(-words // BLOCK_WORDS)
        self.before = np.frombuffer(data, "<u4", counts, at)
        self.end = at + 4 * counts

    def slots(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level has its bit, which happens to unknown keys only."""
        found, left, base = np.full(len(first), -1, np.int64), np.arange(len(first)), 0
        for level, size in enumerate(self.sizes.tolist()):
            bit = base * 64 + place(first[left], second[left], level, size * 64)
            word, inside = bit >> 6, (bit & 63).astype(np.uint64)
            hit = (self.words[word] >> inside) & np.uint64(1) == 1
            found[left[hit]] = self.rank(word[hit], inside[hit])
            left, base = left[~hit], base + size
            if not len(left):
                break
        return found

    def rank(self, word: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Set bits before the bit ``inside`` of each word."""
        total = self.before[word // BLOCK_WORDS].astype(np.int64)
        start = word // BLOCK_WORDS * BLOCK_WORDS
        for k in range(BLOCK_WORDS - 1):
            here = start + k
            total += np.where(here < word, np.bitwise_count(self.words[np.minimum(here, len(self.words) - 1)]), 0)
        return total + np.bitwise_count(self.words[word] & ((np.uint64(1) << inside) - np.uint64(1)))
