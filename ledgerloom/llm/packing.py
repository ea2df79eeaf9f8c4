"""Mixture-controlled packing: deficit round-robin over source queues, cut into windows.

Each round gives every source's queue a quantum of tokens in the target proportions, one window in all; a queue serves
its next document once its unspent quanta cover it and carries the rest, its deficit, on. So the round that serves a
document follows from the tokens before its end in its queue, and its place in the stream from the tokens of
earlier rounds and sources: two running sums, each over buckets of bounded size. Deficits carry across windows and
partitions by construction. The stream is cut every ``window`` tokens, so that only the last window is padded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import hash_join_small, sliced, store, totals_before
from ledgerloom.llm.word_ids import id_kind, tokenize

WINDOW = 2048
END_ID = 1
BUCKET_DOCS = 2_000
BUCKET_ROUNDS = 1024
NEVER = 1 << 53


def queue_rounds(lengths: DataFrame, window: int, weights: dict[str | None, float] | None) -> DataFrame:
    """(row, source, n, until, round): tokens of the queue up to the document's end and the round that serves it."""
    spark = lengths.sparkSession
    queues = lengths.groupBy("source").agg(F.sum("n").alias("queue_tokens"), F.count("*").alias("queue_docs"))
    if weights is None:
        queues = queues.withColumn("weight", F.col("queue_tokens").cast("double"))
    else:
        given = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "__source string, weight double")
        queues = queues.join(F.broadcast(given), F.col("source").eqNullSafe(F.col("__source")), "left")
        queues = queues.drop("__source").fillna(0.0, ["weight"])
    queues = queues.withColumn("share", F.col("weight") / F.sum("weight").over(Window.partitionBy()))
    queues = queues.withColumn("buckets", F.expr(f"queue_docs div {BUCKET_DOCS} + 1"))
    queues = queues.withColumn("quantum", F.col("share") * window).drop("weight", "share", "queue_docs")
    mixed = F.shiftrightunsigned(F.xxhash64("doc_id", "row"), 33)  # rows that share an id are spread too
    rows = lengths.withColumn("mixed", mixed).withColumnRenamed("source", "__source")
    rows = rows.join(queues, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    rows = rows.withColumn("bucket", F.shiftright(F.col("mixed") * F.col("buckets"), 31))
    before = totals_before(rows, ["source"], "bucket", "n").toDF("__source", "__bucket", "before")
    order = Window.partitionBy("source", "bucket").orderBy("mixed", "doc_id", "row").rowsBetween(
        Window.unboundedPreceding, 0
    )
    rows = rows.withColumn("inside", F.sum("n").over(order))
    rows = rows.join(before, F.col("source").eqNullSafe(F.col("__source")) & (F.col("bucket") == F.col("__bucket")))
    until = F.col("before") + F.col("inside")
    # A source without a share comes after all others, a window a round.
    late = F.lit(NEVER) + F.expr(f"(before + inside) div {window}")
    round_ = F.when(F.col("quantum") > 0, F.ceil(until / F.col("quantum"))).otherwise(late)
    return rows.select("row", "source", "n", until.alias("until"), round_.cast("long").alias("round"))


def stream_positions(rounds: DataFrame) -> DataFrame:
    """(row, position): tokens of the stream before each document, in order of round, source and queue."""
    rows = rounds.withColumn("bucket", F.expr(f"round div {BUCKET_ROUNDS}"))
    before = totals_before(rows, [], "bucket", "n").withColumnRenamed("bucket", "__bucket")
    order = Window.partitionBy("bucket").orderBy("round", F.col("source").asc_nulls_last(), "until")
    rows = rows.withColumn("inside", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.join(before, F.col("bucket") == F.col("__bucket"))
    return rows.select("row", (F.col("before") + F.col("inside") - F.col("n")).alias("position"))


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    weights: dict[str | None, float] | None = None,
) -> DataFrame:
    """Pieces of documents in windows: (doc_id, start, length, doc_tokens, sequence_id, offset, ids).

    ids are little-endian unsigned 32-bit numbers. start counts the document's ids before the piece, offset the
    window's. All windows are full but the last. ``weights`` gives each source's share of a round (a source left
    out is served last); without it sources share as their tokens do, so all queues end together. Null is a source of
    its own; null and empty texts are their end id alone; repeated rows are packed as often as they come; ties in
    the queue go by row. Other columns are not read; an empty table gives no piece.
    """
    tokens = store(tokenize(docs, tokenizer, end_id), "pack-tokens")
    kind = id_kind(tokenizer)
    rounds = store(queue_rounds(tokens.select("row", "doc_id", "source", "n"), window, weights), "pack-rounds")
    placed = stream_positions(rounds).withColumnRenamed("row", "__row")
    joined = hash_join_small(tokens.select("row", "doc_id", "n", "ids"), placed, F.col("row") == F.col("__row"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            doc, start, length, tokens_of, sequence, offset, pieces = ([] for _ in range(7))
            for at, (n, ids, place) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in ("n", "ids", "position")), strict=True)
            ):
                wide, done = np.frombuffer(ids, kind).astype("<u4"), 0
                while done < n:
                    inside = (place + done) % window
                    size = min(n - done, window - inside)
                    doc.append(at)
                    start.append(done)
                    length.append(size)
                    tokens_of.append(n)
                    sequence.append((place + done) // window)
                    offset.append(inside)
                    pieces.append(wide[done : done + size].tobytes())
                    done += size
            longs = (pa.array(x, pa.int64()) for x in (start, length, tokens_of, sequence, offset))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc, pa.int64())), *longs, pa.array(pieces, pa.binary())],
                ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    kind_of_id = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind_of_id}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    )
    return joined.select("doc_id", "n", "ids", "position").mapInArrow(cut, schema)
