"""Words and n-grams of many texts as numpy arrays, without a Python step per word.

Texts are laid behind each other as UTF-8 bytes, a chunk at a time, so memory follows the chunk and the longest text.
A rolling hash over the bytes gives the hash of every word as a difference of two running sums (arithmetic modulo 2**64).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 20
BASE = 0x9E3779B97F4A7C15
MIX = 0xBF58476D1CE4E5B9
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def chunks(texts: list[str | None], size: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """(first index, texts as bytes): consecutive texts of about ``size`` bytes in all; null is empty."""
    first, held, total = 0, [], 0
    for k, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "replace")
        held.append(raw)
        total += len(raw)
        if total >= size:
            yield first, held
            first, held, total = k + 1, [], 0
    if held:
        yield first, held


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(MIX)
    return values ^ (values >> np.uint64(29))


class Words:
    """The words (runs without ASCII white space) of some texts: byte range, hash and text of each."""

    def __init__(self, texts: list[bytes], lower: bool = True) -> None:
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        raw = b"\n".join(texts) + b"\n" if texts else b""
        self.data = np.frombuffer(raw.lower() if lower else raw, np.uint8)
        self.raw = np.frombuffer(raw, np.uint8)
        inside = ~SPACE[self.data]
        edge = np.diff(inside.astype(np.int8), prepend=0)
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.first = np.searchsorted(self.starts, self.bounds)  # first word of each text, and the end
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        n = len(self.data)
        powers = np.empty(n + 1, np.uint64)
        powers[0] = 1
        powers[1:] = BASE
        np.multiply.accumulate(powers, out=powers)
        inverse = np.full(n + 1, pow(BASE, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        np.multiply.accumulate(inverse, out=inverse)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
        return mixed((sums[self.ends] - sums[self.starts]) * inverse[self.starts])
