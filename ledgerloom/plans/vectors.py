"""Vector search over the given embeddings.

The query vectors are the mean vectors of the labels, so they too come from the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators import embedding, vector_index, vectors
from ledgerloom.plans import standins as S
from ledgerloom.plans.catalog import Tables, query, spread
from ledgerloom.plans.embedding_sql import embed_sql
from ledgerloom.session import work_folder

DIMS, K = 64, 10

MEANS_SQL = """m AS (SELECT CAST(label AS BIGINT) AS query_id, list(x ORDER BY i) AS q FROM (
  SELECT label, i, avg(x) AS x FROM (
    SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
  GROUP BY label, i) GROUP BY label),
s AS (SELECT query_id, vec_id AS id, list_cosine_similarity(embedding::DOUBLE[], q) AS cosine FROM embeddings, m),
k AS (SELECT query_id, id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, id) AS INTEGER) AS rank,
             cosine FROM s QUALIFY rank <= 10)"""


def label_queries(t: Tables) -> DataFrame:
    labelled = t.embeddings.withColumn("query_id", F.col("label").cast("bigint"))
    return vectors.mean_vectors(labelled, "query_id", "embedding")


def hits(t: Tables, k: int = K) -> DataFrame:
    return vectors.top_k_for_table(spread(t.embeddings), label_queries(t), "vec_id", "query_id", "embedding", DIMS, k)


@query(
    "vector_topk",
    f"WITH {MEANS_SQL} SELECT query_id, id, rank, round((1 + cosine) / 2, 4) AS score FROM k",
)
def vector_topk(t: Tables) -> DataFrame:
    return hits(t).select("query_id", "id", "rank", F.round("score", 4).alias("score"))


@query(
    "vector_topk_grid",
    f"WITH {MEANS_SQL} SELECT query_id, id, rank, round((1 + cosine) / 2, 4) AS score FROM k",
)
def vector_topk_grid(t: Tables) -> DataFrame:
    """The path for query tables too large to send to the tasks."""
    found = vectors.grid_top_k(t.embeddings, label_queries(t), "vec_id", "query_id", "embedding", DIMS, K)
    return found.select("query_id", "id", "rank", F.round("score", 4).alias("score"))


PLANES = vectors.hyperplanes(DIMS, tables=8, bits=5)


def _bucket_sql(vector: str) -> str:
    """The list of a vector's keys, with the hyperplanes as literals."""
    keys = []
    for number, table in enumerate(PLANES):
        signs = [
            f"(CASE WHEN list_inner_product({vector}, {plane}::DOUBLE[]) > 0 THEN {1 << at} ELSE 0 END)"
            for at, plane in enumerate(table)
        ]
        keys.append(f"{number << len(table)} + {' + '.join(signs)}")
    return f"[{', '.join(keys)}]"


@query(
    "vector_topk_lsh",
    f"""WITH {MEANS_SQL.split(", s AS" if ", s AS" in MEANS_SQL else ",\ns AS")[0]},
        i AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e, unnest({_bucket_sql("embedding::DOUBLE[]")}) AS bucket FROM embeddings),
        b AS (SELECT query_id, q, unnest({_bucket_sql("q")}) AS bucket FROM m),
        s AS (SELECT DISTINCT query_id, id, list_cosine_similarity(e, q) AS cosine FROM i JOIN b USING (bucket)),
        k AS (SELECT query_id, id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, id) AS INTEGER) AS rank,
                     cosine FROM s QUALIFY rank <= 10)
        SELECT query_id, id, rank, round((1 + cosine) / 2, 4) AS score FROM k""",
)
def vector_topk_lsh(t: Tables) -> DataFrame:
    index = vectors.with_buckets(t.embeddings, PLANES, "embedding")
    queries = vectors.with_buckets(label_queries(t), PLANES, "embedding")
    found = vectors.top_k_lsh(index, queries, "vec_id", "query_id", "embedding", K)
    return found.select("query_id", "id", "rank", F.round("score", 4).alias("score"))


LISTS, PROBES, ROUNDS = 16, 12, 2


def _round_sql(number: int) -> str:
    """One Lloyd round: the nearest centre of each vector, and the mean of each list."""
    return f"""a{number} AS (SELECT id, u, arg_min(list, (d, list)) AS list FROM (
          SELECT id, u, list, list_sum(list_transform(list_zip(u, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM t, c{number})
          GROUP BY id, u),
        c{number + 1} AS (SELECT list, list(x ORDER BY i) AS c FROM (
          SELECT list, i, avg(x) AS x FROM (SELECT list, unnest(u) AS x, generate_subscripts(u, 1) AS i FROM a{number}) GROUP BY list, i)
          GROUP BY list)"""


@query(
    "vector_index_topk",
    f"""WITH {MEANS_SQL.split(",\ns AS")[0]},
        w AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings),
        n AS (SELECT id, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS u FROM w),
        t AS (SELECT * FROM n WHERE id % 3 <> 0),
        c0 AS (SELECT CAST(row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR)), id) - 1 AS INTEGER) AS list, u AS c FROM t QUALIFY list < {LISTS}),
        {",".join(map(_round_sql, range(ROUNDS)))},
        p AS (SELECT id, u, arg_min(list, (d, list)) AS list FROM (
          SELECT id, u, list, list_sum(list_transform(list_zip(u, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM n, c{ROUNDS})
          GROUP BY id, u),
        b AS (SELECT query_id, q, list FROM (
          SELECT query_id, q, list, list_sum(list_transform(list_zip(c, q), lambda z: z[1] * z[1] - 2 * z[1] * z[2] / sqrt(list_inner_product(q, q)))) AS d
          FROM m, c{ROUNDS}) QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY d, list) <= {PROBES}),
        s AS (SELECT query_id, id, list_cosine_similarity(u, q) AS cosine FROM p JOIN b USING (list)),
        k AS (SELECT query_id, id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, id) AS INTEGER) AS rank,
                     cosine FROM s QUALIFY rank <= 10)
        SELECT query_id, id, rank, round((1 + cosine) / 2, 4) AS score FROM k""",
)
def vector_index_topk(t: Tables) -> DataFrame:
    """A stored index that two thirds of the vectors train, the rest is added to, and the queries search."""
    folder, known = work_folder(t.spark, "vector-index"), spread(t.embeddings)
    later = F.col("vec_id") % 3 == 0
    vector_index.build(known.where(~later), "vec_id", "embedding", DIMS, folder, LISTS, ROUNDS)
    vector_index.add(known.where(later), "vec_id", "embedding", folder)
    found = vector_index.search(t.spark, folder, label_queries(t), "query_id", "embedding", K, PROBES)
    return found.select("query_id", "id", "rank", F.round("score", 4).alias("score"))


@query(
    "retrieval_context",
    f"""WITH {MEANS_SQL}
        SELECT query_id, string_agg(text, '\n\n' ORDER BY rank) AS context,
               array_to_string(list_sort(list_distinct(list(source))), ',') AS sources
        FROM k JOIN documents ON id = doc_id GROUP BY query_id""",
)
def retrieval_context(t: Tables) -> DataFrame:
    texts = t.documents.select(F.col("doc_id").alias("id"), "text", "source")
    # Few enough queries to hold in a list have few hits too, which can then be sent to the texts.
    few = vectors.collect_queries(label_queries(t), "query_id", "embedding", DIMS)
    if not few:
        return vectors.retrieval_context(hits(t), texts, "id")
    found = vectors.top_k(spread(t.embeddings), few, "vec_id", "embedding", K)
    return vectors.retrieval_context(found, texts, "id", max_hits=len(few) * K)


@query(
    "missing_embeddings",
    f"""WITH {embed_sql("e", "documents", "doc_id", "text", DIMS)}
        SELECT doc_id, CASE WHEN vec_id IS NULL THEN 'computed' ELSE 'kept' END AS origin,
               array_to_string(list_transform(coalesce(embedding::DOUBLE[], v),
                 lambda x: CAST(CAST(round(x * 1000) AS BIGINT) AS VARCHAR)), ' ') AS vector
        FROM documents LEFT JOIN embeddings ON doc_id = vec_id JOIN e USING (doc_id)""",
)
def missing_embeddings(t: Tables) -> DataFrame:
    old = t.embeddings.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("textEmbedding"))
    nodes = spread(t.documents.select("doc_id", "text")).join(old, "doc_id", "left")
    marked = nodes.withColumn("origin", F.when(F.col("textEmbedding").isNull(), "computed").otherwise("kept"))
    filled = embedding.fill_missing(marked, embedding.hashing_embedder(DIMS))
    whole = F.transform("textEmbedding", lambda x: F.round(x.cast("double") * 1000).cast("bigint").cast("string"))
    return filled.select("doc_id", "origin", F.array_join(whole, " ").alias("vector"))


CONTEXT_DIMS = 256


@query(
    "question_context",
    f"""WITH {S.CHUNKS_SQL}, {embed_sql("ce", "c", '"chunkId"', "text", CONTEXT_DIMS)},
        {embed_sql("be", "benchmark", "item_id", "text", CONTEXT_DIMS)},
        e AS (SELECT "chunkId" AS id, text, source, v FROM c JOIN ce USING ("chunkId")),
        q AS (SELECT item_id AS query_id, v AS q FROM be),
        s AS (SELECT query_id, id, source, length(text) AS n, list_cosine_similarity(v, q) AS cosine FROM e, q
              WHERE list_sum(v) > 0 AND list_sum(q) > 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(cosine, 6) DESC, id) AS INTEGER) AS rank,
               id, source, n, round((1 + round(cosine, 6)) / 2, 4) AS score
        FROM s QUALIFY rank <= 3""",
)
def question_context(t: Tables) -> DataFrame:
    """Questions as text against embedded chunks, which are stored once. Equal scores go by chunk, so the search rounds."""
    embedder, folder = embedding.hashing_embedder(CONTEXT_DIMS), work_folder(t.spark, "chunks")
    embedding.embed(S.document_chunks(t), embedder).select("chunkId", "text", "source", "textEmbedding").write.parquet(folder)
    chunks, questions = t.spark.read.parquet(folder), t.benchmark.select("item_id", "text")
    hits = vectors.question_hits(questions, chunks, embedder, "item_id", "chunkId", CONTEXT_DIMS, 3, decimals=6)
    cosine = F.round(F.col("score") * 2 - 1, 6)
    return hits.select(
        "query_id", "rank", "id", "source", F.length("text").cast("bigint").alias("n"), F.round((1 + cosine) / 2, 4).alias("score")
    )
