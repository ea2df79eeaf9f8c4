import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from ledgerloom.operators import embedding, vectors

DIMS = 8


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    corpus = rng.normal(size=(400, DIMS)).astype(np.float32)
    # A third of all vectors are near copies of one, and two are unusable.
    corpus[:130] = corpus[0] + rng.normal(scale=0.01, size=(130, DIMS)).astype(np.float32)
    corpus[398], corpus[399] = 0, np.nan
    return corpus, rng.normal(size=(12, DIMS)).astype(np.float32)


@pytest.fixture()
def frames(spark, data):
    corpus, queries = data
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(corpus)], "id bigint, v array<float>").repartition(5)
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "q bigint, v array<float>")
    return c, q


def brute(data, k):
    corpus, queries = (x.astype(np.float64) for x in data)
    good = [i for i in range(len(corpus)) if np.isfinite(corpus[i]).all() and corpus[i].any()]
    unit = corpus[good] / np.linalg.norm(corpus[good], axis=1)[:, None]
    result = {}
    for n, q in enumerate(queries):
        scores = unit @ (q / np.linalg.norm(q))
        order = sorted(range(len(good)), key=lambda i: (-scores[i], good[i]))[:k]
        result[n] = [(good[i], round((1 + scores[i]) / 2, 9)) for i in order]
    return result


def collected(found):
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.id, round(r.score, 9)))
    return got


@pytest.mark.parametrize("k", [1, 7, 1000])
def test_exact_search_is_brute_force(frames, data, k):
    corpus, queries = frames
    want = brute(data, k)
    given = [(i, v.tolist()) for i, v in enumerate(data[1])]
    assert collected(vectors.top_k(corpus, given, "id", "v", k)) == want
    assert collected(vectors.top_k_for_table(corpus, queries, "id", "q", "v", DIMS, k)) == want
    assert collected(vectors.grid_top_k(corpus, queries, "id", "q", "v", DIMS, k, query_block=5, corpus_block=60)) == want


def test_a_large_query_table_takes_the_grid(frames, data, monkeypatch):
    monkeypatch.setattr(vectors, "MAX_BROADCAST_BYTES", 5 * 8 * DIMS)
    corpus, queries = frames
    found = vectors.top_k_for_table(corpus, queries, "id", "q", "v", DIMS, 3)
    assert "FlatMapCoGroupsInPandas" in found._jdf.queryExecution().executedPlan().toString()
    assert collected(found) == brute(data, 3)


def test_bucketed_search_scores_exactly(frames, data):
    corpus, queries = frames
    planes = vectors.hyperplanes(DIMS, tables=8, bits=3)
    index, asked = vectors.with_buckets(corpus, planes, "v"), vectors.with_buckets(queries, planes, "v")
    want = brute(data, 400)
    for q, found in collected(vectors.top_k_lsh(index, asked, "id", "q", "v", 5)).items():
        assert set(found) <= set(want[q])


@pytest.fixture()
def clustered(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 32))
    corpus = np.concatenate([c + 0.25 * rng.normal(size=(50, 32)) for c in centres]).astype(np.float32)
    queries = (centres + 0.25 * rng.normal(size=(40, 32))).astype(np.float32)
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(corpus)], "id bigint, v array<float>")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "q bigint, v array<float>")
    return c, q, (corpus, queries)


def test_bucketed_search_finds_most_and_scores_few(clustered, monkeypatch):
    corpus, queries, data = clustered
    planes = vectors.hyperplanes(32, tables=16, bits=8)
    index, asked = vectors.with_buckets(corpus, planes, "v"), vectors.with_buckets(queries, planes, "v")
    found = collected(vectors.top_k_lsh(index, asked, "id", "q", "v", 10))
    want = brute(data, 10)
    hits = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in want[q]}) for q in want)
    assert hits / (10 * len(want)) >= 0.8
    pairs = vectors.lsh_candidates(index, asked, "id", "q").count()
    assert pairs <= 0.2 * corpus.count() * queries.count()
    # No bound and no number of queries changes what is found.
    monkeypatch.setattr(vectors, "MAX_BROADCAST_BYTES", 1)
    some = collected(vectors.top_k_lsh(index, asked.filter("q < 7"), "id", "q", "v", 10))
    assert some == {q: hits_ for q, hits_ in found.items() if q < 7}


def test_no_query_vectors(frames):
    corpus, queries = frames
    assert vectors.top_k_for_table(corpus, queries.limit(0), "id", "q", "v", DIMS).count() == 0
    with pytest.raises(ValueError):
        vectors.top_k(corpus, [], "id", "v")


def test_text_ids(spark):
    corpus = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "id string, v array<float>")
    found = vectors.top_k(corpus, [("what?", [1.0, 0.1])], "id", "v", 1).first()
    assert (found.query_id, found.id, found["rank"]) == ("what?", "a", 1)


def test_embedding_is_deterministic_and_of_unit_length(spark):
    frame = spark.createDataFrame([(1, "Tools and tools"), (2, "tools AND tools!"), (3, ""), (4, None)], "id int, text string")
    got = {r.id: np.array(r.textEmbedding) for r in embedding.embed(frame, embedding.hashing_embedder(64)).collect()}
    assert all(len(v) == 64 for v in got.values())
    assert np.allclose(got[1], got[2]) and abs(np.linalg.norm(got[1]) - 1) < 1e-6
    assert not got[3].any() and not got[4].any()


def test_missing_vectors_are_filled_and_others_kept(spark, rows):
    data = [(1, "a b", [9.0, 9.0]), (2, "c", None), (3, None, None)]
    frame = spark.createDataFrame(data, "id int, text string, textEmbedding array<float>")
    assert rows(embedding.missing_vectors(frame), "id") == [(2,)]

    @F.pandas_udf(ArrayType(FloatType()))
    def lengths(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [float(len(t or "")), 1.0])

    filled = embedding.fill_missing(frame, embedding.batch_embedder(lengths))
    assert rows(filled, "id", "textEmbedding") == [(1, [9.0, 9.0]), (2, [1.0, 1.0]), (3, None)]


@pytest.mark.parametrize("max_hits", [None, 4])
def test_context_keeps_rank_order(spark, max_hits):
    hits = spark.createDataFrame([(0, 5, 2), (0, 6, 1), (1, 5, 1)], "query_id int, id int, rank int")
    texts = spark.createDataFrame([(5, "five", "s2"), (6, "six", "s1"), (7, "no", "s3")], "id int, text string, source string")
    got = {r.query_id: (r.context, r.sources) for r in vectors.retrieval_context(hits, texts, "id", max_hits=max_hits).collect()}
    assert got == {0: ("six\n\nfive", "s1,s2"), 1: ("five", "s2")}


def test_only_rows_without_a_vector_reach_the_embedder(spark):
    seen = []

    def spy(frame, text, vector):
        seen.append(frame.count())
        return embedding.hashing_embedder(8)(frame, text, vector)

    nodes = spark.createDataFrame([(1, "a", [1.0]), (2, "b", None), (3, None, None)], "id int, text string, textEmbedding array<float>")
    filled = {r.id: r.textEmbedding for r in embedding.fill_missing(nodes, spy).collect()}
    assert seen == [1] and filled[1] == [1.0] and len(filled[2]) == 8 and filled[3] is None


def test_questions_find_their_chunks(spark):
    embedder = embedding.hashing_embedder(64)
    texts = [("c1", "interest rates rise and fall", "s1"), ("c2", "tools and machines", "s2"), ("c3", "", "s3")]
    chunks = embedding.embed(spark.createDataFrame(texts, "id string, text string, source string"), embedder)
    questions = spark.createDataFrame([("q1", "Which machines and tools?"), ("q2", "rates")], "q string, text string")
    found = vectors.question_hits(questions, chunks, embedder, "q", "id", 64, 1).collect()
    assert {(r.query_id, r.id, r.source) for r in found} == {("q1", "c2", "s2"), ("q2", "c1", "s1")}
