"""Text -> vectors, as a pluggable step."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Embedder = Callable[[DataFrame, str, str], DataFrame]


def hashing_embedder(dims: int = 256) -> Embedder:
    """Deterministic default: counts of hashed lower-case words, scaled to length 1. Words are hashed in the JVM, counted in
    Arrow batches.

    A word is a run of letters, digits and ``_``; its place is the first eight hex digits of its md5 modulo ``dims``. A
    text without words has all zeros.
    """

    @F.arrow_udf("array<float>")
    def dense(slots: pa.Array) -> pa.Array:
        """Counts of each row's slots, scaled, a batch at a time."""
        sizes = np.diff(slots.offsets.to_numpy())
        rows = np.repeat(np.arange(len(slots)), sizes)
        places = rows * dims + slots.flatten().to_numpy()
        counts = np.bincount(places, minlength=len(slots) * dims).reshape(len(slots), dims).astype(np.float64)
        length = np.sqrt(np.einsum("ij,ij->i", counts, counts))
        scaled = (counts / np.maximum(length, 1e-300)[:, None]).astype(np.float32)
        return pa.ListArray.from_arrays(np.arange(len(slots) + 1, dtype=np.int32) * dims, scaled.reshape(-1))

    def embed(frame: DataFrame, text: str, vector: str) -> DataFrame:
        words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}_]+"), lambda w: w != "")
        slots = F.transform(words, lambda w: F.conv(F.substring(F.md5(w.cast("binary")), 1, 8), 16, 10).cast("bigint") % dims)
        return frame.withColumn(vector, dense(slots))

    return embed


def batch_embedder(fn: Callable[..., Column]) -> Embedder:
    """Wraps a pandas UDF (text column -> ARRAY<FLOAT>), e.g. one that calls a model."""

    def embed(frame: DataFrame, text: str, vector: str) -> DataFrame:
        return frame.withColumn(vector, fn(F.col(text)))

    return embed


def model_embedder(load: Callable[[], Callable[[list[str]], np.ndarray]], batch: int = 100, most_waiting: int = 64) -> Embedder:
    """Texts go to a model ``batch`` at a time, whatever the size of Arrow batches; ``load`` is called once a task.

    Null texts never reach the model and have no vector. Only the last call of a task may be smaller, and one after
    ``most_waiting`` Arrow batches that did not fill it, so that rows in waiting are bounded.
    """
    if batch < 1:
        raise ValueError("batch must be at least 1")

    @F.pandas_udf("array<float>")
    def vectors(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        waiting: deque[list] = deque()  # vectors of Arrow batches that are not complete, oldest first
        texts: list[tuple[list, int, str]] = []

        def call(size: int) -> None:
            chosen = texts[:size]
            del texts[:size]
            for (made, at, _), vector in zip(chosen, model([text for *_, text in chosen]), strict=True):
                made[at] = np.asarray(vector, dtype=np.float32)

        def complete() -> Iterator[pd.Series]:
            first_open = texts[0][0] if texts else None
            while waiting and waiting[0] is not first_open:
                yield pd.Series(waiting.popleft(), dtype=object)

        for given in series:
            made: list = [None] * len(given)
            waiting.append(made)
            texts.extend((made, at, text) for at, text in enumerate(given) if text is not None)
            while len(texts) >= batch:
                call(batch)
            if texts and len(waiting) > most_waiting:
                call(batch)
            yield from complete()
        if texts:
            call(batch)
        yield from complete()

    return batch_embedder(vectors)


def embed(frame: DataFrame, embedder: Embedder, text: str = "text", vector: str = "textEmbedding") -> DataFrame:
    """One vector per row, computed in the row itself; nothing is joined back."""
    return embedder(frame, text, vector)


def missing_vectors(nodes: DataFrame, text: str = "text", vector: str = "textEmbedding") -> DataFrame:
    return nodes.filter(F.col(vector).isNull() & F.col(text).isNotNull())


def fill_missing(
    nodes: DataFrame, embedder: Embedder, text: str = "text", vector: str = "textEmbedding"
) -> DataFrame:
    """All nodes, with a vector computed where there is text and none yet."""
    lacking = F.col(vector).isNull() & F.col(text).isNotNull()
    # Only rows that lack a vector reach the embedder, which may be costly or paid for.
    done = embedder(nodes.filter(lacking), text, "_filled").withColumn(vector, F.col("_filled")).drop("_filled")
    return nodes.filter(~lacking).unionByName(done.select(*nodes.columns))
