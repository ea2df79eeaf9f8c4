"""Approximate nearest neighbours with randomly rotated one-bit codes.

A vector minus the centre is scaled to length 1, padded to the length of the code and rotated; the code is the signs.
Two numbers go with it: the length and the inner product of the code with what it stands for. From the code's bits and
the rotated query follow an estimate of the distance and a bound of its error that holds with high probability;
vectors whose lower bound passes the k-th best upper bound are read and measured exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import vector_grid as grid
from ledgerloom.llm.common import store

CODE_BITS = 256
CONFIDENCE = 2.5
SEED = 2


def rotation(dims: int, bits: int, seed: int) -> np.ndarray:
    """dims x bits, orthonormal rows: the part of a random rotation that padded vectors meet."""
    gauss = np.random.default_rng([seed, dims, bits]).standard_normal((bits, dims))
    q, r = np.linalg.qr(gauss)
    return (q * np.sign(np.diag(r))).T


def code_length(dims: int, bits: int) -> int:
    return max(bits, -(-dims // 8) * 8)


def encode(vectors: np.ndarray, bits: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed codes, lengths and corrections of centred vectors."""
    length = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    unit = vectors / np.where(length > 0, length, 1.0)[:, None]
    turned = unit @ rotation(vectors.shape[1], bits, seed)
    fit = np.abs(turned).sum(axis=1) / np.sqrt(bits)
    return np.packbits(turned > 0, axis=1), length, np.where(length > 0, fit, 1.0)


def distance(x: Column, y: Column) -> Column:
    squares = F.zip_with(x, y, lambda a, b: (a - b) * (a - b))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, d: s + d))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    code_bits: int = CODE_BITS,
    confidence: float = CONFIDENCE,
    seed: int = SEED,
) -> DataFrame:
    """The k nearest found of each query: (query_id, rank, vec_id, score), score the Euclidean distance in double.

    ``vectors`` has vec_id and embedding; ``is_query`` selects the queries among them. Candidates are all other ids
    with as many dimensions. Null vectors, zero vectors and those with null or non-finite components take no part,
    nor do null ids. Repeated rows count once; if an id has several vectors, its nearest counts. Ties go to the
    smaller id. ``confidence`` is the width of the error bound; a candidate outside it is missed. Other columns are
    not read; an empty table or one without queries gives an empty result.
    """
    doubles = vectors.withColumn("vector", F.col("embedding").cast("array<double>"))
    nonzero = F.exists("vector", lambda x: x != 0)
    valid = doubles.where(grid.finite(F.col("vector"))).where(nonzero)
    asked = store(valid.where(is_query).select("vec_id", "vector").where("vec_id IS NOT NULL").distinct(), "ann-queries")
    known = store(grid.without_spare_copies(valid, k), "ann-vectors")
    rows, n_queries = known.count(), asked.count()
    centre = known.select(F.size("vector").alias("dims"), F.posexplode("vector").alias("pos", "x"))
    centre = centre.groupBy("dims", "pos").agg(F.avg("x").alias("x")).groupBy("dims")
    centre = centre.agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s.x).alias("centre"))
    centre = store(centre, "ann-centre")
    small = centre.limit(101).count() <= 100
    beside = F.broadcast(centre) if small else centre

    def centred(frame: DataFrame, count: int, most: int, name: str) -> DataFrame:
        placed = grid.blocks_of(frame, count, most, name).join(beside, "dims")
        return placed.withColumn("vector", F.zip_with("vector", "centre", lambda a, b: a - b)).drop("centre")

    def pack_codes(ids: np.ndarray, matrix: np.ndarray) -> dict[str, bytes]:
        codes, length, fit = encode(matrix, code_length(matrix.shape[1], code_bits), seed)
        return {"ids": ids.tobytes(), "codes": codes.tobytes(), "length": length.tobytes(), "fit": fit.tobytes()}

    def pack_queries(ids: np.ndarray, matrix: np.ndarray) -> dict[str, bytes]:
        return {"ids": ids.tobytes(), "vectors": matrix.tobytes()}

    index = centred(known, rows, grid.VECTOR_BLOCK, "block")
    index = grid.packed(index, "block", pack_codes, ["ids", "codes", "length", "fit"])
    queries = centred(asked, n_queries, grid.QUERY_BLOCK, "qblock")
    queries = grid.packed(queries, "qblock", pack_queries, ["ids", "vectors"])

    def bounds(index: dict, asked: dict, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        bits = code_length(dims, code_bits)
        ids = np.frombuffer(index["ids"], np.int64)
        codes = np.frombuffer(index["codes"], np.uint8).reshape(len(ids), -1)
        length, fit = np.frombuffer(index["length"]), np.frombuffer(index["fit"])
        query = np.frombuffer(asked["vectors"]).reshape(-1, dims)
        q_length = np.sqrt(np.einsum("ij,ij->i", query, query))
        unit = query / np.where(q_length > 0, q_length, 1.0)[:, None]
        turned = (unit @ rotation(dims, bits, seed)).T
        turned, sums = turned.astype(np.float32), turned.sum(axis=0)
        for at in range(0, len(ids), grid.SLICE):
            s = slice(at, at + grid.SLICE)
            ones = np.unpackbits(codes[s], axis=1, count=bits).astype(np.float32)
            product = (2 * (ones @ turned).astype(np.float64) - sums) / np.sqrt(bits) / fit[s, None]
            error = confidence * np.sqrt(np.maximum(0.0, 1 / fit[s] ** 2 - 1) / max(1, bits - 1))
            twice = 2 * length[s, None] * q_length[None, :]
            square = length[s, None] ** 2 + q_length[None, :] ** 2
            yield ids[s], square - twice * (product + error[:, None]), square - twice * (product - error[:, None])

    candidates = store(grid.scan(index, queries, bounds, k), "ann-candidates")
    chosen = grid.within_kth(candidates, k).select("query_id", "vec_id").distinct()
    exact = chosen.join(known, "vec_id").withColumnRenamed("vector", "__there")
    here = asked.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("__here"))
    exact = exact.join(here, "query_id").where(F.size("__here") == F.size("__there"))
    scored = exact.select("query_id", "vec_id", distance(F.col("__here"), F.col("__there")).alias("score"))
    return grid.best(scored.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")), k, descending=False)
