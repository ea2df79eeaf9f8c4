"""The stored vector index and the bucketed store, batch and streaming."""

import math
import random

import numpy as np
import pytest

from ledgerloom.operators import upsert, vector_index, vectors
from ledgerloom.operators.bucket_store import BucketStore, Load
from ledgerloom.session import work_folder
from ledgerloom.streaming import merges

SCHEMA = "key long, name string, since long"


def batch(spark, rows):
    return spark.createDataFrame(rows, "key long, name string, since long, place long")


def new_store(spark, buckets=8):
    return BucketStore(spark, work_folder(spark, "test-store"), SCHEMA, ["key"], buckets)


def model(batches, policy=upsert.LAST):
    """What a dictionary makes of the same batches."""
    table = {}
    for rows in batches:
        seen = {}
        for key, name, since, place in sorted((r for r in rows if r[0] is not None), key=lambda r: r[3]):
            first = seen.get(key, (None, since))[1]
            kept = seen[key][0] if policy == upsert.FIRST and key in seen else name
            seen[key] = (kept, first)
        for key, (name, since) in seen.items():
            if key not in table:
                table[key] = (name, since)
            elif policy == upsert.LAST:
                table[key] = (name, table[key][1])
    return sorted((k, *v) for k, v in table.items())


def files_of(store):
    return {b: sorted(f for f in store._read([p]).inputFiles()) for b, p in store.places().items()}


@pytest.mark.parametrize("policy", [upsert.LAST, upsert.FIRST])
def test_merges_are_those_of_a_dictionary(spark, rows, policy):
    rng = random.Random(2)
    batches = [[(rng.choice([None, *range(60)]), f"n{b}-{k}", 100 * b + k, rng.randrange(10**6)) for k in range(80)] for b in range(3)]
    store = new_store(spark)
    known = set()
    for number, some in enumerate(batches):
        load = store.merge(batch(spark, some), f"b{number}", ["place"], policy, create_only=("since",))
        keys = {r[0] for r in some} - {None}
        assert load == Load(True, len(keys), len(keys - known), len(keys & known), load.buckets) and 0 < load.buckets <= 8
        known |= keys
        assert rows(store.read()) == sorted(model(batches[: number + 1], policy), key=repr)


def test_a_repeated_batch_and_untouched_buckets(spark, rows):
    store = new_store(spark)
    assert store.read().count() == 0 and store.version() == 0 and store.read().columns == ["key", "name", "since"]
    store.merge(batch(spark, [(k, "old", k, 1) for k in range(100)]), "first", ["place"])
    before, table = files_of(store), rows(store.read())
    assert store.merge(batch(spark, [(k, "again", 0, 2) for k in range(100)]), "first", ["place"]) == Load(False)
    assert files_of(store) == before and store.version() == 1 and rows(store.read()) == table
    load = store.merge(batch(spark, [(3, "new", 7, 1), (None, "lost", 0, 1)]), "second", ["place"])
    after = files_of(store)
    assert load == Load(True, 1, 0, 1, 1) and sum(before[b] != after[b] for b in before) == 1
    assert rows(store.read()) == sorted([(k, "new", 7) if k == 3 else (k, "old", k) for k in range(100)], key=repr)
    assert rows(store.read(1)) == table  # an old version is still whole
    store.merge(batch(spark, []), "nothing", ["place"])
    assert store.has("nothing") and rows(store.read(2)) == rows(store.read())
    store.forget_old()
    assert rows(store.read()) == sorted([(k, "new", 7) if k == 3 else (k, "old", k) for k in range(100)], key=repr) and store.has("first")


def test_a_crash_before_the_manifest_changes_nothing(spark, rows, monkeypatch):
    store = new_store(spark)
    store.merge(batch(spark, [(k, "old", k, 1) for k in range(20)]), "first", ["place"])
    table = rows(store.read())

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(BucketStore, "_commit", crash)
        with pytest.raises(OSError):
            store.merge(batch(spark, [(1, "new", 0, 1)]), "second", ["place"])
    assert rows(store.read()) == table and not store.has("second")
    assert store.merge(batch(spark, [(1, "new", 0, 1)]), "second", ["place"]).updated == 1


def test_streamed_batches_count_once_after_a_crash(spark, rows, monkeypatch):
    """The stream stops after a merge and before its own commit; the batch it runs again is known by then."""
    folder, store = work_folder(spark, "test-stream"), new_store(spark)
    some = [[(k, f"n{b}", b, b) for k in range(10 * b, 10 * b + 20)] for b in range(4)]
    for part in some:
        batch(spark, part).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(batch(spark, []).schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    merge, calls = BucketStore.merge, []

    def merge_then_crash(self, *args, **settings):
        calls.append(merge(self, *args, **settings))
        if len(calls) == 2:
            raise OSError("lost")
        return calls[-1]

    monkeypatch.setattr(BucketStore, "merge", merge_then_crash)
    start = lambda: merges.start_merges(stream, store, "s", f"{folder}/checkpoint", ["place"], create_only=("since",))
    with pytest.raises(Exception, match="lost"):
        start().awaitTermination()
    start().awaitTermination()
    assert [c.applied for c in calls] == [True, True, False, True, True] and store.version() == 4
    names = {k: [b for b in range(4) if 10 * b <= k < 10 * b + 20] for k in range(50)}
    got = {r[0]: r[1:] for r in rows(store.read())}
    assert set(got) == set(names) and all(got[k][1] in names[k] for k in names)


# --- vector index ------------------------------------------------------------------------------------


def vector_rows(count=900, dims=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    return [(n, (centres[n % 12] + 0.3 * rng.normal(size=dims)).astype(np.float32).tolist()) for n in range(count)]


def frame(spark, data):
    return spark.createDataFrame(data, "id long, v array<float>")


def brute(data, query, k):
    unit = lambda v: np.array(v, float) / np.linalg.norm(v)
    good = [(i, v) for i, v in data if v and len(v) == len(query) and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    return [i for i, _ in sorted(good, key=lambda x: (-round(float(unit(x[1]) @ unit(query)), 12), x[0]))[:k]]


def found_by(hits):
    found = {}
    for r in hits.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.id)
    return found


def test_index_finds_neighbours_and_grows(spark, monkeypatch):
    data = vector_rows()
    odd = [(5000, None), (5001, []), (5002, [0.0] * 16), (5003, [float("nan")] * 16), (5004, [None] + [1.0] * 15), (5005, [1.0, 2.0])]
    folder = work_folder(spark, "test-index")
    vector_index.build(frame(spark, data[:600] + odd), "id", "v", 16, folder, lists=12, rounds=3)
    files = set(spark.read.parquet(f"{folder}/lists").inputFiles())
    vector_index.add(frame(spark, data[600:] + odd), "id", "v", folder)
    assert files < set(spark.read.parquet(f"{folder}/lists").inputFiles())  # what was there stays
    stored = spark.read.parquet(f"{folder}/lists")
    assert stored.count() == 900 and stored.select("list").distinct().count() <= 12
    queries = frame(spark, [(q, v) for q, v in data[::37]] + odd[:3])
    hits = vector_index.search(spark, folder, queries, "id", "v", 10, probes=4)
    found = found_by(hits)
    want = {q: brute(data, v, 10) for q, v in data[::37]}
    recall = sum(len(set(found[q]) & set(w)) for q, w in want.items()) / sum(map(len, want.values()))
    assert recall >= 0.9
    assert found_by(vector_index.search(spark, folder, queries, "id", "v", 10, probes=12)) == want  # all lists: exact
    monkeypatch.setattr(vectors, "MAX_BROADCAST_BYTES", 64)
    monkeypatch.setattr(vector_index, "BLOCK_VECTORS", 50)
    assert found_by(vector_index.search(spark, folder, queries, "id", "v", 10, probes=4)) == found


def test_search_reads_probed_lists_only(spark):
    folder = work_folder(spark, "test-index")
    vector_index.build(frame(spark, vector_rows()), "id", "v", 16, folder, lists=12)
    hits = vector_index.search(spark, folder, frame(spark, vector_rows()[:1]), "id", "v", 10, probes=2)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [list" in plan
    assert vector_index.search(spark, folder, frame(spark, []), "id", "v").count() == 0


def test_recall_on_the_given_embeddings(spark):
    known = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    folder = work_folder(spark, "test-index")
    vector_index.build(known, "vec_id", "embedding", 64, folder, lists=16, rounds=3)
    queries = known.where("vec_id % 20 = 0")
    exact = found_by(vectors.top_k_for_table(known, queries, "vec_id", "vec_id", "embedding", 64, 10))
    found = found_by(vector_index.search(spark, folder, queries, "vec_id", "embedding", 10, probes=12))
    recall = sum(len(set(found[q]) & set(w)) for q, w in exact.items()) / sum(map(len, exact.values()))
    print("recall", recall)
    assert recall >= 0.9
