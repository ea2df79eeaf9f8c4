"""Cutting one text at natural breaks, by offsets; the per-row helper of ``chunks.recursive_pieces``."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

Span = tuple[int, int]


def split_text(text: str, size: int, overlap: int, separators: Sequence[str]) -> list[str]:
    return [text[begin:end] for begin, end in split_spans(text, size, overlap, separators)]


def split_spans(text: str, size: int, overlap: int, separators: Sequence[str]) -> list[Span]:
    """Where the chunks of a text begin and end. No part of the text is copied but a chunk at a time."""
    return list(_cut(text, 0, len(text), size, overlap, list(separators)))


def _cut(text: str, low: int, high: int, size: int, overlap: int, separators: list[str]) -> Iterator[Span]:
    level = next((i for i, s in enumerate(separators) if not s or text.find(s, low, high) >= 0), len(separators) - 1)
    separator, finer = separators[level], separators[level + 1 :]
    bounds = _bounds(text, low, high, separator)
    if not separator and size > 1:
        yield from _packed(text, bounds, size, overlap)
        return
    begin = 0
    for n in range(len(bounds) - 1):
        if bounds[n + 1] - bounds[n] < size:
            continue
        yield from _packed(text, bounds[begin : n + 1], size, overlap)
        if finer:
            yield from _cut(text, bounds[n], bounds[n + 1], size, overlap, finer)
        else:
            yield bounds[n], bounds[n + 1]
        begin = n + 1
    yield from _packed(text, bounds[begin:], size, overlap)


def _bounds(text: str, low: int, high: int, separator: str) -> Sequence[int]:
    """Where parts begin, and the end of the last one. Parts keep the separator in front of them."""
    if not separator:
        return range(low, high + 1)
    bounds, at = [low], text.find(separator, low, high)
    while at >= 0:
        if at > low:
            bounds.append(at)
        at = text.find(separator, at + len(separator), high)
    return [*bounds, high] if high > low else bounds


def _packed(text: str, bounds: Sequence[int], size: int, overlap: int) -> Iterator[Span]:
    """Greedy packing of parts below ``size``; each chunk begins with the last parts of the one before, up to ``overlap``."""
    first, last = 0, len(bounds) - 1
    while first < last:
        end = bisect_right(bounds, bounds[first] + size) - 1
        yield from _stripped(text, bounds[first], bounds[end])
        if end >= last:
            return
        first = bisect_left(bounds, max(bounds[end] - overlap, bounds[end + 1] - size), first)


def _stripped(text: str, begin: int, end: int) -> Iterator[Span]:
    chunk = text[begin:end]
    begin += len(chunk) - len(chunk.lstrip())
    end -= len(chunk) - len(chunk.rstrip())
    if begin < end:
        yield begin, end
