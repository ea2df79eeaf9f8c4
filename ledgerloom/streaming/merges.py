"""Nodes and mentions merged as they arrive, each micro-batch exactly once.

The store remembers the batches it contains and takes a batch in with one rename. A stream that stops between the merge and its
own commit runs the same batch again, which the store then knows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators import upsert
from ledgerloom.operators.bucket_store import BucketStore


def start_merges(
    arriving: DataFrame,
    store: BucketStore,
    name: str,
    checkpoint: str,
    order_by: list[str],
    policy: str = upsert.LAST,
    create_only: tuple[str, ...] = (),
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Merges all rows that are there now, batch by batch. ``name`` is the stream's, as its checkpoint is."""

    def take_in(batch: DataFrame, number: int) -> None:
        store.merge(prepare(batch) if prepare else batch, f"{name}-{number}", order_by, policy, create_only)

    return (
        arriving.writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
