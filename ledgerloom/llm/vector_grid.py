"""Blocks of vectors against blocks of queries, for the two vector searches.

A block of vectors or queries is one row of packed arrays. Every query block goes to every vector block of the same
dimension, as an equi-join on the block; a task holds one cell of the grid at a time. Of equal vectors only the
``k + 1`` smallest ids go on, which is all that the best ``k`` can hold when ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VECTOR_BLOCK = 262_144
QUERY_BLOCK = 512
SLICE = 8192


def finite(vector: Column) -> Column:
    """Not null, not empty, all components numbers that are neither NaN nor infinite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def without_spare_copies(vectors: DataFrame, k: int) -> DataFrame:
    """(vec_id, vector): repeated rows once, and of equal vectors the k + 1 smallest ids."""
    copies = Window.partitionBy("vector").orderBy("vec_id")
    once = vectors.select("vec_id", "vector").where("vec_id IS NOT NULL").distinct()
    return once.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy")


def blocks_of(frame: DataFrame, rows: int, most: int, name: str) -> DataFrame:
    """Adds dims and a block number in 0..n-1; n makes blocks of at most ``most`` rows, and one a core at least."""
    cores = frame.sparkSession.sparkContext.defaultParallelism
    count = max(1, -(-rows // most), min(cores, -(-rows // SLICE) * 2) if most > QUERY_BLOCK else 1)
    spread = F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(count)).cast("int")
    return frame.withColumn("dims", F.size("vector")).withColumn(name, spread)


def packed(frame: DataFrame, name: str, pack: Callable[[np.ndarray, np.ndarray], dict[str, bytes]], fields: list[str]):
    """One row per (dims, block) with the binaries that ``pack(ids, matrix)`` makes."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id", kind="stable")
        made = pack(rows["vec_id"].to_numpy(np.int64), np.stack(rows["vector"].to_numpy()))
        return pd.DataFrame([{"dims": key[0], name: key[1], **made}])

    schema = ", ".join(["dims int", f"{name} int", *(f"{f} binary" for f in fields)])
    return frame.groupBy("dims", name).applyInPandas(run, schema)


def scan(
    vectors: DataFrame,
    queries: DataFrame,
    bounds: Callable[[dict, dict, int], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]],
    k: int,
) -> DataFrame:
    """Candidates (query_id, vec_id, low, high) of every cell, where small is good.

    ``bounds`` yields, slice by slice of a vector block, its ids and matrices (vectors x queries) of lower and upper
    bounds. A candidate's lower bound is not above the k-th smallest upper bound of its query in the cell. The
    query's own row is no candidate.
    """
    blocks = vectors.select("dims", F.col("block")).groupBy("dims").agg(F.collect_set("block").alias("blocks"))
    blocks = blocks.withColumnRenamed("dims", "__dims")
    many = queries.join(blocks, F.col("dims") == F.col("__dims")).drop("__dims")
    many = many.withColumn("block", F.explode("blocks")).drop("blocks")
    shared = [F.col(c).alias(f"q_{c}") for c in queries.columns]
    right = many.select(*shared, F.col("block").alias("q_block"))
    cells = vectors.join(right, (F.col("dims") == F.col("q_dims")) & (F.col("block") == F.col("q_block")))
    cells = cells.repartition("dims", "block", "q_qblock")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                cell = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
                yield from one(cell)

    def one(cell: dict) -> Iterator[pa.RecordBatch]:
        index = {c: v for c, v in cell.items() if not c.startswith("q_")}
        asked = {c[2:]: v for c, v in cell.items() if c.startswith("q_")}
        query_ids = np.frombuffer(asked["ids"], np.int64)
        best = np.full((k, len(query_ids)), np.inf)
        found = []
        for ids, low, high in bounds(index, asked, cell["dims"]):
            own = ids[:, None] == query_ids[None, :]
            low, high = np.where(own, np.inf, low), np.where(own, np.inf, high)
            least = np.partition(high, k - 1, axis=0)[:k] if len(high) > k else high
            best = np.sort(np.concatenate([best, least]), axis=0)[:k]
            row, column = np.nonzero((low <= best[-1]) & ~own)
            found.append((ids[row], column, low[row, column], high[row, column]))
        vec, column, low, high = (np.concatenate(x) for x in zip(*found, strict=True))
        good = low <= best[-1][column]
        yield pa.RecordBatch.from_arrays(
            [pa.array(query_ids[column[good]]), pa.array(vec[good]), pa.array(low[good]), pa.array(high[good])],
            ["query_id", "vec_id", "low", "high"],
        )

    return cells.mapInArrow(run, "query_id long, vec_id long, low double, high double")


def within_kth(candidates: DataFrame, k: int) -> DataFrame:
    """Candidates whose lower bound is not above the k-th smallest upper bound over all cells of the query."""
    by_high = Window.partitionBy("query_id").orderBy("high", "vec_id")
    kth = candidates.withColumn("place", F.row_number().over(by_high)).where(F.col("place") <= k)
    kth = kth.groupBy("query_id").agg(F.max("high").alias("bar"), F.count("*").alias("places"))
    kept = candidates.join(kth, "query_id")
    return kept.where((F.col("low") <= F.col("bar")) | (F.col("places") < k)).drop("bar", "places")


def best(scored: DataFrame, k: int, descending: bool) -> DataFrame:
    """(query_id, rank, vec_id, score): the best k of each query, ties to the smaller id."""
    score = F.col("score").desc() if descending else F.col("score")
    order = Window.partitionBy("query_id").orderBy(score, "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
