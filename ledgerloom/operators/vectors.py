"""Vector search: exact top-k, bucketed approximate top-k, retrieval context.

Scores are cosine similarities scaled to 0..1. Every task keeps only the best ``k`` per query, so what is
shuffled is ``tasks x queries x k`` small rows and never a pair per vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_K = 10
# Queries up to this many bytes of vectors are sent to the tasks; more take the grid path.
MAX_BROADCAST_BYTES = 8 * 1024 * 1024
MAX_BROADCAST_HITS = 100_000
# Queries scored at a time, which bounds the score matrix of a batch.
QUERY_SLICE = 256
# Grid path: vectors per block on either side, so a cell's two blocks fit one task.
GRID_QUERY_BLOCK = 4096
GRID_CORPUS_BLOCK = 65536
# Groups of tasks whose lists of best vectors are merged first, before the last rank.
MERGE_NODES = 32


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; a row that has no length or is not all numbers becomes NaN."""
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    with np.errstate(invalid="ignore", divide="ignore"):
        return matrix / norms[:, None]


@dataclass
class _Best:
    """The best ``k`` (score, id) per query seen so far in one task; ties go to the lower id."""

    k: int
    rows: dict
    decimals: int | None = None

    def add(self, query_ids: list, units: np.ndarray, matrix: np.ndarray, ids: np.ndarray) -> None:
        """Takes in unit vectors with their ids. Vectors an index would refuse have NaN for a score."""
        good = np.isfinite(units).all(axis=1)
        if not good.all():
            units, ids = units[good], ids[good]
        for at in range(0, len(query_ids) if len(ids) else 0, QUERY_SLICE):
            self._add_scores(query_ids[at : at + QUERY_SLICE], units @ matrix[at : at + QUERY_SLICE].T, ids)

    def _add_scores(self, query_ids: list, scores: np.ndarray, ids: np.ndarray) -> None:
        if self.decimals is not None:
            scores = np.round(scores, self.decimals)
        for q, column in zip(query_ids, scores.T):
            cut = column.size > self.k and np.partition(column, -self.k)[-self.k]
            near = np.flatnonzero(column >= cut) if column.size > self.k else np.arange(column.size)
            old_scores, old_ids = self.rows.get(q, (np.empty(0), ids[:0]))
            s, i = np.concatenate([old_scores, column[near]]), np.concatenate([old_ids, ids[near]])
            order = np.lexsort((i, -s))[: self.k]
            self.rows[q] = (s[order], i[order])

    def batch(self, id_type: pa.DataType, query_type: pa.DataType) -> pa.RecordBatch:
        items = [(q, found) for q, found in self.rows.items() if len(found[0])]
        lengths = [len(s) for _, (s, _) in items]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([q for (q, _), n in zip(items, lengths) for _ in range(n)], query_type),
                pa.array([x for _, (_, i) in items for x in i.tolist()], id_type),
                pa.array([x for _, (s, _) in items for x in s.tolist()], pa.float64()),
            ],
            names=["query_id", "id", "cosine"],
        )


def usable(vectors: DataFrame, vector: str, dims: int) -> DataFrame:
    """Vectors an index would take: right size, all numbers, some length."""
    v = F.col(vector)
    good = (F.size(v) == dims) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)) & F.exists(v, lambda x: x != 0)
    return vectors.filter(v.isNotNull() & good)


def _merged(candidates: DataFrame, k: int, nodes: int) -> DataFrame:
    """The best ``k`` of each query in each of ``nodes`` groups of tasks."""
    grouped = candidates.withColumn("_node", F.pmod(F.spark_partition_id(), F.lit(nodes)))
    best = Window.partitionBy("query_id", "_node").orderBy(F.desc("cosine"), "id")
    return grouped.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= k).drop("_node", "_place")


def _pick_k(candidates: DataFrame, k: int, nodes: int | None = None) -> DataFrame:
    """The best ``k`` of each query. The lists of tasks are merged in two levels, so at most ``nodes`` lists of ``k`` meet in
    one task for a query; a session of fewer cores than that has the last level only, unless ``nodes`` is given."""
    if nodes or candidates.sparkSession.sparkContext.defaultParallelism > MERGE_NODES:
        candidates = _merged(candidates, k, nodes or MERGE_NODES)
    best = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "id")
    return (
        candidates.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .withColumn("score", (1 + F.col("cosine")) / 2)
    )


def top_k(
    vectors: DataFrame,
    queries: list[tuple[object, list[float]]],
    id_column: str,
    vector: str,
    k: int = DEFAULT_K,
    decimals: int | None = None,
) -> DataFrame:
    """The ``k`` nearest vectors of each given query: query_id, id, cosine, rank, score.

    With ``decimals`` cosines are rounded before they are compared, so that copies tie and go by id.

    ``queries`` are (id, vector) pairs from the caller, e.g. one embedded question. See
    :func:`top_k_for_table` when they are a table.
    """
    if not queries:
        raise ValueError("no query vectors")
    return _pick_k(_search(vectors, queries, id_column, vector, k, decimals), k)


def _search(
    vectors: DataFrame, queries: list, id_column: str, vector: str, k: int, decimals: int | None = None
) -> DataFrame:
    """Each task's best ``k`` per query."""
    dims = len(queries[0][1])
    query_ids = [q for q, _ in queries]
    matrix = _unit(np.asarray([v for _, v in queries], dtype=np.float64))
    query_type, arrow_query = ("string", pa.string()) if isinstance(query_ids[0], str) else ("bigint", pa.int64())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, id_type = _Best(k, {}, decimals), None
        for b in batches:
            if not b.num_rows:
                continue
            id_type = b.schema.field(0).type
            ids = np.asarray(b.column(0).to_pylist())
            units = _unit(_matrix(b.column(1), dims))
            best.add(query_ids, units, matrix, ids)
        if best.rows:
            yield best.batch(id_type, arrow_query)

    # Only the size is checked here, cheaply; vectors without length or with NaN fall out of the arithmetic.
    slim = vectors.filter(F.size(vector) == dims).select(id_column, vector)
    id_type = vectors.schema[id_column].dataType.simpleString()
    return slim.mapInArrow(score, f"query_id {query_type}, id {id_type}, cosine double")


def collect_queries(queries: DataFrame, query_id: str, vector: str, dims: int) -> list | None:
    """The query table as a list if it is small, else null. Reads at most one row over the bound."""
    bound = max(1, MAX_BROADCAST_BYTES // (8 * dims))
    rows = queries.select(query_id, vector).limit(bound + 1).collect()
    return None if len(rows) > bound else [(r[0], list(r[1])) for r in rows]


def top_k_for_table(
    vectors: DataFrame,
    queries: DataFrame,
    id_column: str,
    query_id: str,
    vector: str,
    dims: int,
    k: int = DEFAULT_K,
    decimals: int | None = None,
) -> DataFrame:
    """Top-k for a table of query vectors of any size.

    A small table is sent to the tasks. A larger one is cut, like the vectors, into blocks by hash, and
    every (query block, vector block) cell is one group that gives back its best ``k`` per query.
    """
    good_queries = usable(queries, vector, dims)
    small = collect_queries(good_queries, query_id, vector, dims)
    if small is not None:
        if not small:
            found = vectors.limit(0).select(
                F.lit(None).cast(queries.schema[query_id].dataType).alias("query_id"),
                F.col(id_column).alias("id"),
                F.lit(0.0).alias("cosine"),
            )
            return _pick_k(found, k)
        return top_k(vectors, small, id_column, vector, k, decimals)
    return grid_top_k(vectors, good_queries, id_column, query_id, vector, dims, k, decimals=decimals)


def grid_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    id_column: str,
    query_id: str,
    vector: str,
    dims: int,
    k: int = DEFAULT_K,
    query_block: int = GRID_QUERY_BLOCK,
    corpus_block: int = GRID_CORPUS_BLOCK,
    decimals: int | None = None,
) -> DataFrame:
    """Exact top-k of every query over every vector, on a grid of bounded cells."""
    good = vectors.filter(F.size(vector) == dims)
    rows = -(-queries.count() // query_block) or 1
    columns = -(-good.count() // corpus_block) or 1

    def block(id_name: str, n: int) -> Column:
        return F.pmod(F.xxhash64(id_name), F.lit(n)).cast("int")

    q = queries.select(
        F.col(query_id).alias("query_id"),
        F.col(vector).alias("v"),
        block(query_id, rows).alias("qb"),
        F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("cb"),
    )
    c = good.select(
        F.col(id_column).alias("id"),
        F.col(vector).alias("v"),
        block(id_column, columns).alias("cb"),
        F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("qb"),
    )
    query_type, id_type = q.schema["query_id"].dataType, c.schema["id"].dataType

    def cell(qs: pd.DataFrame, cs: pd.DataFrame) -> pd.DataFrame:
        best = _Best(k, {}, decimals)
        if len(qs) and len(cs):
            left = _unit(np.stack(cs["v"].to_numpy()).astype(np.float64))
            right = _unit(np.stack(qs["v"].to_numpy()).astype(np.float64))
            best.add(qs["query_id"].tolist(), left, right, cs["id"].to_numpy())
        rows_out = [(q_, i, s) for q_, (ss, ii) in best.rows.items() for s, i in zip(ss.tolist(), ii.tolist())]
        return pd.DataFrame(rows_out, columns=["query_id", "id", "cosine"])

    schema = f"query_id {query_type.simpleString()}, id {id_type.simpleString()}, cosine double"
    found = q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInPandas(cell, schema)
    return _pick_k(found, k)


def mean_vectors(vectors: DataFrame, group: str, vector: str) -> DataFrame:
    """Mean vector per group, combined before the shuffle: group, vector."""
    mean = Summarizer.mean(array_to_vector(vector))
    return vectors.groupBy(group).agg(vector_to_array(mean).alias(vector))


# --- approximate search ------------------------------------------------------------------------------


def hyperplanes(dims: int, tables: int = 16, bits: int = 8, seed: int = 42) -> list[list[list[float]]]:
    """Random directions, tables x bits x dims, with four decimals so that they can be written down."""
    draws = np.random.default_rng(seed).standard_normal((tables, bits, dims))
    return np.round(draws, 4).tolist()


def with_buckets(vectors: DataFrame, planes: list[list[list[float]]], vector: str) -> DataFrame:
    """Adds ``buckets``: per table one key of all its signs, (table << bits) + signs. Store it as the index.

    A key is as selective as its table has bits; more tables find more neighbours.
    """
    dims, bits, tables = len(planes[0][0]), len(planes[0]), len(planes)
    matrix = np.asarray(planes, np.float64).reshape(tables * bits, dims).T
    weights = 1 << np.arange(bits)

    @F.arrow_udf("array<int>")
    def keys(column: pa.Array) -> pa.Array:
        """One matrix product for a batch of vectors; the signs of each table's products are its key."""
        above = (_matrix(column, dims) @ matrix > 0).reshape(-1, tables, bits)
        found = (above @ weights + np.arange(tables) * (1 << bits)).astype(np.int32)
        return pa.ListArray.from_arrays(np.arange(len(column) + 1, dtype=np.int32) * tables, found.reshape(-1))

    return usable(vectors, vector, dims).withColumn("buckets", keys(F.col(vector)))


def lsh_candidates(index: DataFrame, queries: DataFrame, id_column: str, query_id: str) -> DataFrame:
    """Distinct pairs (query_id, id) that share a bucket, from one equi-join on the bucket.

    ``index`` and ``queries`` come from :func:`with_buckets`. Ids alone are joined; a crowded bucket is split by the
    skew join.
    """
    left = index.select(F.col(id_column).alias("id"), F.explode("buckets").alias("bucket"))
    right = queries.select(F.col(query_id).alias("query_id"), F.explode("buckets").alias("bucket"))
    return left.join(right, "bucket").select("query_id", "id").distinct()


def top_k_lsh(
    index: DataFrame, queries: DataFrame, id_column: str, query_id: str, vector: str, k: int = DEFAULT_K
) -> DataFrame:
    """Approximate top-k: the nearest of the vectors that share a bucket with a query, scored exactly.

    One path for any number of queries. A query whose buckets are empty gets no hit.
    """
    pairs = lsh_candidates(index, queries, id_column, query_id)
    there = index.select(F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("_v"))
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(vector).cast("array<double>").alias("_q"))
    scored = pairs.join(there, "id").join(asked, "query_id").select("query_id", "id", _cosine("_v", "_q").alias("cosine"))
    return _pick_k(scored, k)


def _cosine(left: str, right: str) -> Column:
    def dot(x: str, y: str) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda s, p: s + p)

    return dot(left, right) / F.sqrt(dot(left, left) * dot(right, right))


def question_hits(
    questions: DataFrame,
    chunks: DataFrame,
    embed,
    question_id: str,
    chunk_id: str,
    dims: int,
    k: int = DEFAULT_K,
    text: str = "text",
    vector: str = "textEmbedding",
    decimals: int | None = None,
) -> DataFrame:
    """Question texts -> their k nearest chunks: query_id, id, rank, score, text, source.

    ``embed`` is the embedder that made the vectors of ``chunks`` (chunk_id, text, source, vector).
    """
    asked = embed(questions.select(question_id, text), text, vector).select(question_id, vector)
    hits = top_k_for_table(chunks.select(chunk_id, vector), asked, chunk_id, question_id, vector, dims, k, decimals)
    texts = chunks.select(F.col(chunk_id).alias("id"), text, "source")
    return hits.select("query_id", "id", "rank", "score").join(texts, "id")


def retrieval_context(
    hits: DataFrame, texts: DataFrame, id_column: str, separator: str = "\n\n", max_hits: int | None = None
) -> DataFrame:
    """All hits of a question joined to one text in rank order, with their sources.

    ``hits`` come from a top-k, so a question has at most ``k`` rows. A caller who knows how many hits
    there can be (queries x k) says so in ``max_hits``; if they are few they are sent to the texts.
    """
    slim = hits.select("query_id", "id", "rank")
    if max_hits is not None and max_hits <= MAX_BROADCAST_HITS:
        slim = F.broadcast(slim)
    joined = texts.select(F.col(id_column).alias("id"), "text", "source").join(slim, "id")
    ordered = F.array_sort(F.collect_list(F.struct("rank", "text")))
    return joined.groupBy("query_id").agg(
        F.array_join(F.transform(ordered, lambda x: x["text"]), separator).alias("context"),
        F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"),
    )
