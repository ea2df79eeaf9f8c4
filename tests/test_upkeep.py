"""Lists kept up to date, sketches of stored keys, embedding in batches of a fixed size, merged best lists."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import embedding, key_sketch, quality, relink, vectors

NODES = "form string, item string, place long, id string"


def listed(spark, nodes):
    return spark.createDataFrame([(f, i, p, f"{f}-{i}-{p}-{v}") for (f, i, p), v in nodes.items()], NODES)


@pytest.mark.parametrize("seed", range(4))
def test_relinked_lists_equal_lists_built_anew(spark, rows, seed):
    choose = random.Random(seed)
    places = [(f, i, p) for f in ("a", None) for i in ("x", "y") for p in range(60)]
    before = {at: 0 for at in places if choose.random() < 0.5}
    after, changed = dict(before), []
    for _ in range(choose.choice([1, 5, 40])):
        at = choose.choice(places)
        changed.append(at)
        if choose.random() < 0.6:
            after.pop(at, None)
        else:
            after[at] = after.get(at, -1) + 1
    settings = dict(keys=["form", "item"], position="place", node_id="id", block_rows=4)
    moved = spark.createDataFrame([*changed, changed[0]], "form string, item string, place long")
    old = relink.linked(listed(spark, before), **settings)
    got = relink.relink(old, listed(spark, after), moved, **settings)
    assert rows(got) == rows(relink.linked(listed(spark, after), **settings)) != []


def test_a_whole_block_and_a_whole_list_may_go(spark, rows):
    settings = dict(keys=["form", "item"], position="place", node_id="id", block_rows=2)
    before = {("a", "x", p): 0 for p in range(8)} | {("b", "x", p): 0 for p in range(3)}
    after = {k: v for k, v in before.items() if k[0] == "a" and k[2] not in (2, 3, 4, 5)}
    gone = spark.createDataFrame([k for k in before if k not in after], "form string, item string, place long")
    got = relink.relink(relink.linked(listed(spark, before), **settings), listed(spark, after), gone, **settings)
    assert [(r.src, r.dst) for r in got.orderBy("block", "src").collect()] == [
        ("a-x-0-0", "a-x-1-0"), ("a-x-1-0", "a-x-6-0"), ("a-x-6-0", "a-x-7-0")
    ]


def test_edges_of_untouched_blocks_are_not_made_again(spark, rows):
    """Marked edges far from the change come through with their marks."""
    settings = dict(keys=["form", "item"], position="place", node_id="id", block_rows=4)
    nodes = {("a", "x", p): 0 for p in range(40)}
    marked = relink.linked(listed(spark, nodes), **settings).withColumn("dst", F.concat(F.lit("old "), "dst"))
    changed = spark.createDataFrame([("a", "x", 21)], "form string, item string, place long")
    got = {r.src: r.dst for r in relink.relink(marked, listed(spark, nodes), changed, **settings).collect()}
    fresh = sorted(int(src.split("-")[2]) for src, dst in got.items() if not dst.startswith("old"))
    assert len(got) == 39 and fresh == list(range(16, 24))


KEYS = "a long, b string"


def test_a_load_finds_what_a_full_check_finds(spark, rows):
    table = spark.createDataFrame([(n, "x") for n in range(2000)] + [(None, "x"), (5, None)], KEYS)
    batch = spark.createDataFrame([(n, "x") for n in range(1990, 4000)] + [(n, "y") for n in range(9)] + [(7, "y"), (None, "x"), (5, None)], KEYS)
    blocks = key_sketch.blocks_for(2002)
    known = key_sketch.sketch(table, ["a", "b"], blocks)
    got = key_sketch.load_violations(batch, table, known, ["a", "b"], blocks)
    both = quality.unique_key_violations(table.unionByName(batch), "a", "b")
    assert rows(got) == rows(both) and len(rows(got)) == 13
    maybe = key_sketch.suspects(batch, known, ["a", "b"], blocks).count()
    assert 12 <= maybe <= 12 + 2020 * 0.03
    later = key_sketch.extended(known, batch, ["a", "b"], blocks)
    assert key_sketch.suspects(batch, later, ["a", "b"], blocks).count() == batch.distinct().count()


def test_nothing_is_suspect_without_stored_keys(spark):
    empty = spark.createDataFrame([], KEYS)
    batch = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x")], KEYS)
    known = key_sketch.sketch(empty, ["a", "b"], 1)
    assert key_sketch.suspects(batch, known, ["a", "b"], 1).count() == 0
    assert [tuple(r) for r in key_sketch.load_violations(batch, empty, known, ["a", "b"], 1).collect()] == [(1, "x", 2)]


def test_texts_go_to_the_model_in_batches_of_one_size(spark, tmp_path):
    log = tmp_path / "calls"

    def load():
        with open(log, "a") as out:
            out.write("load\n")

        def model(texts):
            with open(log, "a") as out:
                out.write(f"{len(texts)}\n")
            assert None not in texts
            return np.array([[len(t), t.count("a")] for t in texts])

        return model

    texts = [None if n % 7 == 0 else "a" * (n % 5) + "b" for n in range(1000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "33")
    try:
        got = embedding.embed(frame, embedding.model_embedder(load, 100), vector="v").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert all(r.v is None if r.text is None else r.v == [len(r.text), r.text.count("a")] for r in got) and len(got) == 1000
    calls = log.read_text().split()
    wanted = sum(t is not None for t in texts)
    assert calls == ["load"] + ["100"] * (wanted // 100) + [str(wanted % 100)]


def test_rows_in_waiting_are_bounded(spark):
    frame = spark.createDataFrame([(0, "a")] + [(n, None) for n in range(1, 200)], "id long, text string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        made = embedding.embed(frame, embedding.model_embedder(lambda: lambda texts: [[1.0]] * len(texts), 100, most_waiting=3), vector="v")
        assert [r.id for r in made.where("v IS NOT NULL").collect()] == [0]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_lists_of_tasks_are_merged_in_two_levels(spark, rows):
    choose = random.Random(5)
    found = [(q, n, round(choose.random(), 2)) for q in range(3) for n in range(400)]
    frame = spark.createDataFrame(found, "query_id long, id long, cosine double").repartition(20)
    flat, tree = vectors._pick_k(frame, 5), vectors._pick_k(frame, 5, nodes=4)
    assert rows(tree) == rows(flat)
    assert vectors._merged(frame, 5, 4).count() <= 3 * 5 * 4
