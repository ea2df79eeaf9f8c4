"""Exact top-k inner products with vector-approximation files.

Every block of integer vectors has a grid of its own: per dimension the smallest value and a cell width that covers the
range with 2 ** bits cells. A vector is its cells, a byte a dimension. The edges of a cell bound the score from both
sides. The scan keeps what may still be among the best; exact vectors are then read in the order of their bounds,
first ``k`` a query, then those whose bound reaches the k-th exact score, after which the result is certain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import vector_grid as grid
from ledgerloom.llm.common import store

CELL_BITS = 8
SCALE = 256
WIDE = "decimal(38,0)"
# Beyond whole numbers that a double holds, bounds are this part of the sum of absolute products wider.
ROUNDING = 2.0**-40


def product(x: Column, y: Column) -> Column:
    """Exact inner product; null if it has more than 38 digits."""
    parts = F.zip_with(x, y, lambda a, b: F.try_multiply(a.cast("decimal(20,0)"), b.cast("decimal(20,0)")).cast(WIDE))
    return F.aggregate(parts, F.lit(0).cast(WIDE), lambda s, p: F.try_add(s, p).cast(WIDE))


def grid_of(matrix: np.ndarray, cell_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(smallest value and cell width of each dimension, cells) of 64-bit rows; differences are taken without sign."""
    low = matrix.min(axis=0)
    apart = matrix.view(np.uint64) - low.view(np.uint64)
    width = (apart.max(axis=0) >> np.uint64(cell_bits)) + np.uint64(1)
    return low, width, (apart // width).astype(np.uint8 if cell_bits <= 8 else np.uint16)


def score_bounds(low: np.ndarray, width: np.ndarray, cells: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible inner products of the cells (rows) with the queries (columns), as doubles."""
    dims, start, wide = len(low), low.astype(np.float64), width.astype(np.float64)
    asked = query.astype(np.float64)
    edge = start + cells * wide
    base, rise = edge @ asked.T, np.maximum(asked, 0) @ (wide - 1)
    fall = np.minimum(asked, 0) @ (wide - 1)
    most = max(abs(int(low.max())), abs(int(low.min()))) + (int(width.max()) << 16)
    largest = max(abs(int(query.max())), abs(int(query.min())))
    if most * largest * dims < 1 << 52:
        return base + fall, base + rise
    slack = ROUNDING * ((np.abs(edge) + wide) @ np.abs(asked).T)
    return base + fall - slack, base + rise + slack


def top_products(
    vectors: DataFrame, is_query: Column, k: int = 5, cell_bits: int = CELL_BITS, scale: int = SCALE
) -> DataFrame:
    """The k highest integer inner products of each query: (query_id, rank, vec_id, score decimal(38, 0)). Exact.

    Components become floor(scale * x), x as double. ``vectors`` has vec_id and embedding; ``is_query`` selects the
    queries; candidates are all other ids with as many dimensions. Null vectors and those with null or non-finite
    components take no part, nor do null ids. Zero vectors do. Scaled components beyond a long count as its ends; scores of
    more than 38 digits are null and come last. Repeated rows count once; if an id has several vectors, its best counts. Ties go to the smaller id. Other columns are not
    read; an empty table or one without queries gives an empty result.
    """
    doubles = vectors.withColumn("real", F.col("embedding").cast("array<double>")).where(grid.finite(F.col("real")))
    whole = F.transform("real", lambda x: F.floor(x * scale).cast("long"))
    valid = doubles.withColumn("vector", whole)
    asked = store(valid.where(is_query).select("vec_id", "vector").where("vec_id IS NOT NULL").distinct(), "va-queries")
    known = store(grid.without_spare_copies(valid, k), "va-vectors")
    rows, n_queries = known.count(), asked.count()

    def pack_cells(ids: np.ndarray, matrix: np.ndarray) -> dict[str, bytes]:
        low, width, cells = grid_of(matrix, cell_bits)
        return {"ids": ids.tobytes(), "low": low.tobytes(), "width": width.tobytes(), "cells": cells.tobytes()}

    def pack_queries(ids: np.ndarray, matrix: np.ndarray) -> dict[str, bytes]:
        return {"ids": ids.tobytes(), "vectors": matrix.tobytes()}

    index = grid.blocks_of(known, rows, grid.VECTOR_BLOCK, "block")
    index = grid.packed(index, "block", pack_cells, ["ids", "low", "width", "cells"])
    queries = grid.blocks_of(asked, n_queries, grid.QUERY_BLOCK, "qblock")
    queries = grid.packed(queries, "qblock", pack_queries, ["ids", "vectors"])

    def bounds(index: dict, asked: dict, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        ids = np.frombuffer(index["ids"], np.int64)
        cells = np.frombuffer(index["cells"], np.uint8 if cell_bits <= 8 else np.uint16).reshape(-1, dims)
        low, width = np.frombuffer(index["low"], np.int64), np.frombuffer(index["width"], np.uint64)
        query = np.frombuffer(asked["vectors"], np.int64).reshape(-1, dims)
        for at in range(0, len(ids), grid.SLICE):
            least, greatest = score_bounds(low, width, cells[at : at + grid.SLICE], query)
            yield ids[at : at + grid.SLICE], -greatest, -least

    candidates = store(grid.scan(index, queries, bounds, k), "va-candidates")
    ordered = Window.partitionBy("query_id").orderBy("low", "vec_id")
    chosen = grid.within_kth(candidates, k).groupBy("query_id", "vec_id").agg(F.min("low").alias("low"))
    chosen = store(chosen.withColumn("turn", F.row_number().over(ordered)), "va-order")
    here = asked.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("__here"))

    def read(pairs: DataFrame) -> DataFrame:
        exact = pairs.select("query_id", "vec_id").join(known, "vec_id").join(here, "query_id")
        exact = exact.where(F.size("__here") == F.size("vector"))
        scored = exact.select("query_id", "vec_id", product(F.col("__here"), F.col("vector")).alias("score"))
        return scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))

    first = store(read(chosen.where(F.col("turn") <= k)), "va-first")
    sure = first.groupBy("query_id").agg(F.min("score").alias("sure"), F.count("*").alias("places"))
    rest = chosen.where(F.col("turn") > k).join(sure, "query_id")
    may_be_better = (-F.col("low") >= F.col("sure").cast("double")) | F.col("sure").isNull()
    rest = rest.where(may_be_better | (F.col("places") < k))
    return grid.best(first.unionByName(read(rest)), k, descending=True)
