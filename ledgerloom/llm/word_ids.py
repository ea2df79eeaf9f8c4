"""Token ids of many texts by way of their distinct units, without a Python step per word.

The tokenizer drops white space before it splits, so a text's ids are those of its stretches between ASCII white space,
in order. A stretch of ASCII characters without apostrophe falls into units which the tokenizer encodes on their own:
runs of letters, single digits, runs of other characters. Any other stretch is one unit, whatever is in it. Units
are found and hashed in numpy. Only distinct ones that are not known yet go to the tokenizer; ids are then gathered.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

CHUNK = 1 << 20
MOST_KEPT = 500_000
TOGETHER = 200
KEPT_IN = "ledgerloom_kept_words"
TEXTS_AT_ONCE = 16
WORD_END = "</w>"
SPACE, LETTER, DIGIT, OTHER, WHOLE = 0, 1, 2, 3, 4


def byte_classes() -> np.ndarray:
    """Class of each byte; apostrophes and bytes beyond ASCII make their stretch one unit."""
    found = np.full(256, OTHER, np.uint8)
    found[[9, 10, 11, 12, 13, 32]] = SPACE
    found[ord("a") : ord("z") + 1] = found[ord("A") : ord("Z") + 1] = LETTER
    found[ord("0") : ord("9") + 1] = DIGIT
    found[ord("'")] = WHOLE
    found[128:] = WHOLE
    found[28:32] = WHOLE  # control characters that some count as white space
    return found


CLASSES = byte_classes()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


class UnitHash:
    """Two 64-bit sums of random multiples of random byte values, which tell units apart."""

    def __init__(self) -> None:
        self.random = np.random.default_rng(7)
        self.values = self.random.integers(1, 1 << 64, (2, 256), np.uint64)
        self.factors = self.random.integers(1, 1 << 64, (2, 4096), np.uint64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the units, which lie behind each other in ``data``."""
        if not len(starts):
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        longest = int(lengths.max())
        while longest > self.factors.shape[1]:
            more = self.random.integers(1, 1 << 64, self.factors.shape, np.uint64)
            self.factors = np.concatenate([self.factors, more], axis=1)
        place = np.arange(len(data)) - np.repeat(starts, lengths)
        first, second = (np.add.reduceat(v[data] * f[place], starts) for v, f in zip(self.values, self.factors, strict=True))
        return first, second


class WordIds:
    """Ids of texts; what the tokenizer answered is kept, within a bound."""

    def __init__(self, path: str, kind: str) -> None:
        self.tokenizer, self.kind = Tokenizer.from_file(path), np.dtype(kind)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[k for token, k in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Any special token's name cuts a text before all else; the ids of the first one separate units.
        self.cut = self.special[0] if self.special else None
        self.cut_id = vocabulary[self.cut.decode()] if self.cut else -1
        self.hash = UnitHash()
        self.forget()

    def forget(self) -> None:
        self.keys, self.checks = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.at, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool = np.empty(0, self.kind)

    def ids_of(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The tokenizer's ids, some texts at a time, since its answers hold much more than ids."""
        for at in range(0, len(texts), TEXTS_AT_ONCE):
            some = [t.decode("utf-8", "replace") for t in texts[at : at + TEXTS_AT_ONCE]]
            for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False):
                yield np.array(e.ids, self.kind)

    def joined_ids(self, units: list[bytes], glue: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, ids of each unit), some units at a time, which the tokenizer keeps apart when ``glue`` is between them."""
        parts = [units[at : at + TOGETHER] for at in range(0, len(units), TOGETHER)]
        for some, ids in zip(parts, self.ids_of([glue.join(p) for p in parts]), strict=True):
            if glue == b" ":
                ends = np.flatnonzero(self.ends_word[ids]) + 1
                good = len(ends) == len(some) and ends[-1] == len(ids)
            else:
                cuts = np.flatnonzero(ids == self.cut_id)
                good, ends = len(cuts) == len(some) - 1, np.append(cuts - np.arange(len(cuts)), len(ids) - len(cuts))
                ids = np.delete(ids, cuts)
            if good:
                yield ids, np.diff(ends, prepend=0)
            else:
                yield from self.each(some)

    def each(self, units: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for ids in self.ids_of(units):
            yield ids, np.array([len(ids)])

    def learn(self, keys: np.ndarray, checks: np.ndarray, units: list[bytes], plain: np.ndarray, special: bool) -> None:
        """Adds the ids of units. ``plain`` ones are single words to the tokenizer, others anything."""
        named = np.full(len(units), self.cut is None)
        if special:
            named |= np.fromiter((any(s in u for s in self.special) for u in units), bool, len(units))
        order = np.concatenate([np.flatnonzero(plain & ~named), np.flatnonzero(~plain & ~named), np.flatnonzero(named)])
        in_order = [units[k] for k in order.tolist()]
        one, two = int((plain & ~named).sum()), int((~named).sum())
        ids, sizes = [self.pool], []
        for some in (
            self.joined_ids(in_order[:one], b" "),
            self.joined_ids(in_order[one:two], self.cut or b""),
            self.each(in_order[two:]),
        ):
            for more, counts in some:
                ids.append(more)
                sizes.append(counts)
        size = np.concatenate(sizes)
        at = len(self.pool) + np.cumsum(size) - size
        self.pool = np.concatenate(ids)
        rank = np.argsort(keys[order], kind="stable")
        into = np.searchsorted(self.keys, keys[order][rank])
        for name, values in (("keys", keys[order]), ("checks", checks[order]), ("at", at), ("size", size)):
            setattr(self, name, np.insert(getattr(self, name), into, values[rank]))

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids of each text) of UTF-8 texts laid behind each other; ``bounds`` has len(texts) + 1 offsets."""
        ids, counts = [], np.zeros(len(bounds) - 1, np.int64)
        for begin, end in self.chunks(data, bounds):
            found, units_at, sizes = self.encode_chunk(data[begin:end], bounds - begin)
            ids.append(found)
            text = np.searchsorted(bounds, units_at + begin, side="right") - 1
            counts += np.bincount(text, sizes, len(counts)).astype(np.int64)
        return np.concatenate(ids) if ids else np.empty(0, self.kind), counts

    @staticmethod
    def chunks(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of about ``CHUNK`` bytes that end at a text's end or at white space."""
        begin = int(bounds[0])
        while begin < bounds[-1]:
            end = begin + CHUNK
            if end >= bounds[-1]:
                end = int(bounds[-1])
            else:
                stop = int(bounds[np.searchsorted(bounds, end)])
                while end < stop:
                    blank = np.flatnonzero(CLASSES[data[end : min(stop, end + 4096)]] == SPACE)
                    if len(blank):
                        end += int(blank[0])
                        break
                    end = min(stop, end + 4096)
            yield begin, end
            begin = end

    def encode_chunk(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first byte of each unit, ids of each unit)."""
        special = bool(np.any((raw[:-1] == ord("<")) & (raw[1:] == ord("|"))))
        kind = CLASSES[raw]
        edge = np.zeros(len(raw), bool)  # first bytes of texts
        edge[bounds[(bounds >= 0) & (bounds < len(raw))]] = True
        solid = kind != SPACE
        begins = solid & (edge | np.concatenate([[True], ~solid[:-1]]))
        first = np.flatnonzero(begins)
        if not len(first):
            return np.empty(0, self.kind), first, first
        whole = (np.cumsum(np.concatenate([[0], kind == WHOLE]))).astype(np.int64)
        last = np.append(first[1:], len(raw))
        odd = whole[last] > whole[first]
        if special:
            mark = np.concatenate([[0], np.cumsum((raw[:-1] == ord("<")) & (raw[1:] == ord("|")))])
            mark = np.append(mark, mark[-1])
            odd |= mark[last] > mark[first]
        inside = np.repeat(odd, last - first)
        inside = np.concatenate([np.zeros(first[0], bool), inside])
        change = np.concatenate([[True], kind[1:] != kind[:-1]]) | (kind == DIGIT)
        starts = np.flatnonzero(begins | (solid & change & ~inside))
        filled = np.flatnonzero(solid)
        # Capitals count where marks behind a letter may join it, and in a special token's name.
        packed = np.where(inside[filled], raw[filled], LOWER[raw[filled]])
        place = np.searchsorted(filled, starts)
        lengths = np.diff(np.append(place, len(filled)))
        keys, checks = self.hash(packed, place, lengths)
        distinct, sample, which = np.unique(keys, return_index=True, return_inverse=True)
        if np.any(checks[sample][which] != checks):  # two units of this chunk share 64 bits; the rest tells
            distinct, sample, which = np.unique(keys ^ (checks * np.uint64(3)), return_index=True, return_inverse=True)
            keys, distinct = keys ^ (checks * np.uint64(3)), distinct
        spot = self.known(distinct, checks[sample])
        new = np.flatnonzero(spot < 0)
        if len(new):
            if len(self.keys) > MOST_KEPT:
                self.forget()
                new = np.arange(len(distinct))
            raw_units, at, size = packed.tobytes(), place[sample[new]], lengths[sample[new]]
            units = [raw_units[a : a + n] for a, n in zip(at.tolist(), size.tolist(), strict=True)]
            self.learn(distinct[new], checks[sample[new]], units, ~inside[filled[at]], special)
            spot = self.known(distinct, checks[sample])
        at, sizes = self.at[spot][which], self.size[spot][which]
        before = np.cumsum(sizes) - sizes
        ids = self.pool[np.repeat(at - before, sizes) + np.arange(int(sizes.sum()))]
        return ids, starts, sizes

    def known(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Where each unit is kept, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        spot = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        same = self.keys[spot] == keys
        found = np.where(same & (self.checks[spot] == checks), spot, -1)
        for k in np.flatnonzero(same & (found < 0)):  # another unit with the same first 64 bits
            run = np.arange(np.searchsorted(self.keys, keys[k]), np.searchsorted(self.keys, keys[k], side="right"))
            run = run[self.checks[run] == checks[k]]
            found[k] = run[0] if len(run) else -1
        return found


def kept_words(path: str, kind: str) -> WordIds:
    """The task's ``WordIds``. A Python worker runs many tasks; it keeps what it has learned, within the bound.

    Functions that travel with their code have globals of their own in every task, so a module of the worker holds it.
    """
    kept = sys.modules.setdefault(KEPT_IN, ModuleType(KEPT_IN)).__dict__
    if (path, kind) not in kept:
        kept.clear()
        kept[path, kind] = WordIds(path, kind)
    return kept[path, kind]


def id_kind(path: str) -> str:
    """Two bytes an id if the vocabulary allows it."""
    return "<u2" if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a text column; null is empty."""
    texts = texts.cast(pa.binary())
    texts = texts.fill_null(b"") if texts.null_count else texts
    bounds = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
    data = texts.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), bounds


def encoded_column(words: WordIds, texts: pa.Array, end_id: int) -> tuple[pa.Array, pa.Array]:
    """(ids of each text with ``end_id`` behind them as bytes, their number)."""
    data, bounds = text_bytes(texts)
    ids, counts = words.encode(data, bounds)
    ids = np.insert(ids, np.cumsum(counts), np.array(end_id, words.kind))
    counts = counts + 1
    offsets = np.concatenate([[0], np.cumsum(counts)]) * words.kind.itemsize
    kind, width = (pa.binary(), np.int32) if offsets[-1] < 1 << 31 else (pa.large_binary(), np.int64)
    buffers = [None, pa.py_buffer(offsets.astype(width)), pa.py_buffer(np.ascontiguousarray(ids))]
    return pa.Array.from_buffers(kind, len(counts), buffers), pa.array(counts, pa.int64())


def tokenize(docs: DataFrame, tokenizer: str, end_id: int, columns: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """(row, *columns, n, ids): all ids of each text with ``end_id`` behind them; null text has that alone.

    row numbers the rows within their partition, so the result must be stored before it is read twice.
    """
    kind = id_kind(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        words, row = kept_words(tokenizer, kind), TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                ids, counts = encoded_column(words, part.column("text"), end_id)
                rows = pa.array(range(row, row + part.num_rows), pa.int64())
                row += part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [rows, *(part.column(c) for c in columns), counts, ids.cast(pa.binary())], ["row", *columns, "n", "ids"]
                )

    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(["row long", *(f"{c} {fields[c]}" for c in columns), "n long", "ids binary"])
    return docs.select(*columns, "text").mapInArrow(run, schema)
