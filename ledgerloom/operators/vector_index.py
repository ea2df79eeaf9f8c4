"""A stored vector index: k-means lists as partitions, searched list by list and extended without a rebuild.

A coarse quantiser is trained with Lloyd rounds: every task sums its vectors by nearest centre, Spark adds the sums up, so
the driver only holds the centres. Each vector is stored in the partition of its nearest centre. A search reads the
partitions that are nearest to its queries and nothing else; vectors that come later are put beside those that are there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import vectors as V

LISTS, PROBES, ROUNDS = 64, 8, 4
# Vectors of one list that meet in a task when queries are a large table.
BLOCK_VECTORS = 65536


def nearest_lists(matrix: np.ndarray, centres: np.ndarray, count: int = 1) -> np.ndarray:
    """The nearest centres of each row, nearest first, ties to the smaller number."""
    distance = (centres * centres).sum(axis=1) - 2 * (matrix @ centres.T)
    return np.argsort(distance, axis=1, kind="stable")[:, :count]


def _units(batch: pa.RecordBatch, vector: str, dims: int) -> np.ndarray:
    return V._unit(V._matrix(batch.column(batch.schema.get_field_index(vector)), dims))


def train(vectors: DataFrame, id_column: str, vector: str, dims: int, lists: int = LISTS, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of the vectors scaled to length 1, a row each; fewer if there are fewer different vectors to begin with.

    The first centres are the vectors whose ids have the smallest md5, so training is the same every time. Each round is one
    pass that shuffles a sum for each task and list. A list that loses all its vectors keeps its centre.
    """
    good = V.usable(vectors, vector, dims).select(F.col(id_column).alias("id"), F.col(vector).alias("v"))
    seeds = good.orderBy(F.md5(F.col("id").cast("string").cast("binary")), "id").limit(lists).collect()
    centres = V._unit(np.array([r.v for r in seeds], np.float64).reshape(-1, dims))
    schema = "list int, n long, total array<double>"
    for _ in range(rounds if len(centres) else 0):
        fixed = centres

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts, totals = np.zeros(len(fixed), np.int64), np.zeros(fixed.shape)
            for batch in batches:
                units = _units(batch, "v", dims)
                own = nearest_lists(units, fixed)[:, 0] if len(units) else np.empty(0, int)
                counts += np.bincount(own, minlength=len(fixed))
                np.add.at(totals, own, units)
            rows = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int32()), pa.array(counts[rows]), pa.array(list(totals[rows]), pa.list_(pa.float64()))], ["list", "n", "total"]
            )

        parts = good.select("v").mapInArrow(sums, schema).select("list", "n", F.posexplode("total").alias("i", "x"))
        mean = parts.groupBy("list", "i").agg((F.sum("x") / F.sum("n")).alias("x")).collect()
        centres = centres.copy()
        for r in mean:
            centres[r["list"], r["i"]] = r["x"]
    return centres


def placed(vectors: DataFrame, id_column: str, vector: str, centres: np.ndarray) -> DataFrame:
    """(id, list, vector) of the vectors that an index takes, each in the list of its nearest centre."""
    dims = centres.shape[1]
    good = V.usable(vectors, vector, dims).select(F.col(id_column).alias("id"), F.col(vector).alias("vector"))
    kinds = {f.name: f.dataType.simpleString() for f in good.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = nearest_lists(_units(batch, "vector", dims), centres)[:, 0]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(own, pa.int32()), batch.column("vector")], ["id", "list", "vector"])

    return good.mapInArrow(run, f"id {kinds['id']}, list int, vector {kinds['vector']}")


def _store(rows: DataFrame, folder: str) -> None:
    # A list lies in few files, yet a large one is written by several tasks.
    rows.repartition("list", F.pmod(F.xxhash64("id"), F.lit(4))).write.mode("append").partitionBy("list").parquet(f"{folder}/lists")


def build(vectors: DataFrame, id_column: str, vector: str, dims: int, folder: str, lists: int = LISTS, rounds: int = ROUNDS) -> None:
    """Trains the lists on the vectors and stores both below ``folder``, which must be new. Vectors without length, with NaN
    or nulls or of another size are left out, as everywhere in the search."""
    centres = train(vectors, id_column, vector, dims, lists, rounds)
    spark = vectors.sparkSession
    rows = [(k, c.tolist()) for k, c in enumerate(centres)]
    spark.createDataFrame(rows, "list int, centre array<double>").coalesce(1).write.parquet(f"{folder}/centres")
    _store(placed(vectors, id_column, vector, centres.reshape(-1, dims)), folder)


def add(vectors: DataFrame, id_column: str, vector: str, folder: str) -> None:
    """Puts more vectors into the stored lists; centres and files that are there stay as they are."""
    _store(placed(vectors, id_column, vector, centres_of(vectors.sparkSession, folder)), folder)


def centres_of(spark: SparkSession, folder: str) -> np.ndarray:
    rows = spark.read.parquet(f"{folder}/centres").orderBy("list").collect()
    return np.array([r.centre for r in rows], np.float64)


def search(spark: SparkSession, folder: str, queries: DataFrame, query_id: str, vector: str, k: int = V.DEFAULT_K, probes: int = PROBES) -> DataFrame:
    """The k nearest of the vectors in each query's ``probes`` nearest lists: query_id, id, cosine, rank, score.

    The scan is pruned to lists that some query probes. A small query table travels to the tasks; a larger one is joined list
    by list, in blocks, so that no list or query is cut short.
    """
    centres = centres_of(spark, folder)
    dims = centres.shape[1]
    good = V.usable(queries, vector, dims)
    index = spark.read.parquet(f"{folder}/lists")
    small = V.collect_queries(good, query_id, vector, dims)
    if small is None:
        return V._pick_k(_joined(index, good, query_id, vector, centres, k, probes), k)
    if not small:
        none = F.lit(None).cast(queries.schema[query_id].dataType).alias("query_id")
        return V._pick_k(index.limit(0).select(none, "id", F.lit(0.0).alias("cosine")), k)
    ids = [q for q, _ in small]
    matrix = V._unit(np.array([v for _, v in small], np.float64))
    wanted = nearest_lists(matrix, centres, probes)
    by_list = {int(x): np.flatnonzero((wanted == x).any(axis=1)) for x in np.unique(wanted)}
    arrow_query = pa.string() if isinstance(ids[0], str) else pa.int64()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, id_type = V._Best(k, {}), None
        for b in batches:
            if b.num_rows:
                id_type = b.schema.field(0).type
                own, lists = np.asarray(b.column(0).to_pylist()), b.column(1).to_numpy()
                units = V._unit(V._matrix(b.column(2), dims))
                for x in np.unique(lists).tolist():
                    rows, asking = lists == x, by_list[x]
                    best.add([ids[q] for q in asking], units[rows], matrix[asking], own[rows])
        if best.rows:
            yield best.batch(id_type, arrow_query)

    probed = index.where(F.col("list").isin(*by_list)).select("id", "list", "vector")
    kind = queries.schema[query_id].dataType.simpleString()
    found = probed.mapInArrow(score, f"query_id {kind}, id {index.schema['id'].dataType.simpleString()}, cosine double")
    return V._pick_k(found, k)


def _joined(index: DataFrame, queries: DataFrame, query_id: str, vector: str, centres: np.ndarray, k: int, probes: int) -> DataFrame:
    """Each (list, block of its vectors) with the queries that probe it, as one group."""
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("v"))
    kinds = {f.name: f.dataType.simpleString() for f in asked.schema}
    dims = centres.shape[1]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists = nearest_lists(_units(batch, "v", dims), centres, probes)
                each = pa.array(np.repeat(np.arange(batch.num_rows), lists.shape[1]))
                columns = [batch.column(c).take(each) for c in ("query_id", "v")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(lists.reshape(-1), pa.int32())], ["query_id", "v", "list"])

    pairs = asked.mapInArrow(probe, f"query_id {kinds['query_id']}, v {kinds['v']}, list int")
    blocks = index.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_VECTORS).cast("int").alias("blocks"))
    left = pairs.join(blocks, "list").select("query_id", "v", "list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    left = left.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(16)).cast("int"))
    right = index.join(blocks, "list").select(
        "id", "vector", "list", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(15))).alias("part")
    )

    def cell(qs: pd.DataFrame, cs: pd.DataFrame) -> pd.DataFrame:
        best = V._Best(k, {})
        if len(qs) and len(cs):
            there = V._unit(np.stack(cs["vector"].to_numpy()).astype(np.float64))
            asking = V._unit(np.stack(qs["v"].to_numpy()).astype(np.float64))
            best.add(qs["query_id"].tolist(), there, asking, cs["id"].to_numpy())
        rows = [(q, i, s) for q, (ss, ii) in best.rows.items() for s, i in zip(ss.tolist(), ii.tolist(), strict=True)]
        return pd.DataFrame(rows, columns=["query_id", "id", "cosine"])

    keys = ["list", "block", "part"]
    schema = f"query_id {kinds['query_id']}, id {index.schema['id'].dataType.simpleString()}, cosine double"
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(cell, schema)
