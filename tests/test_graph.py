import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import chunks, graph, quality, upsert
from ledgerloom.operators.split_groups import next_in_group, ordered_text


@pytest.mark.parametrize("block_rows", [1, 3, 10_000])
def test_links_do_not_depend_on_the_block_size(spark, block_rows):
    # One group holds most rows; positions have gaps.
    rng = random.Random(5)
    data = [("hot", p, f"hot-{p}") for p in sorted(rng.sample(range(500), 120))]
    data += [(f"g{i}", 7, f"g{i}-7") for i in range(20)] + [("two", 3, "two-3"), ("two", 400, "two-400")]
    frame = spark.createDataFrame(data, "g string, p int, id string")
    want = set()
    for group in {r[0] for r in data}:
        ids = [r[2] for r in sorted(r for r in data if r[0] == group)]
        want |= set(zip(ids, ids[1:]))
    got = {tuple(r) for r in graph.next_edges(frame, ["g"], "p", "id", block_rows).collect()}
    assert got == want
    kept = next_in_group(frame, ["g"], "p", "id", block_rows)
    assert kept.count() == len(data) and set(kept.columns) == {"g", "p", "id", "next_value"}


def test_long_texts_go_on_in_parts(spark):
    data = [("a", i, f"{i},") for i in range(10)] + [("b", 0, "only")]
    frame = spark.createDataFrame(data, "g string, p int, t string")
    got = {(r.g, r.part): r.text for r in ordered_text(frame, ["g"], "p", "t", 4).collect()}
    assert got == {("a", 0): "0,1,2,3,", ("a", 1): "4,5,6,7,", ("a", 2): "8,9,", ("b", 0): "only"}
    assert ordered_text(frame, ["g"], "p", "t").count() == 2


@pytest.fixture()
def chunk_table(spark):
    texts = [("f1", "item1", "ab" * 2000, "s1"), ("f1", "item7", "short", "s1"), ("f2", "item1", "xy" * 900, "s2"), ("f3", "item1", "z", "s3")]
    sections = spark.createDataFrame(texts, "formId string, f10kItem string, text string, source string")
    return chunks.chunk_fixed(sections.withColumns({"cik": F.lit("1"), "cusip6": F.lit("c")}))


def test_document_graph(spark, chunk_table, rows):
    sections = chunk_table.select("formId", "f10kItem").distinct().count()
    assert graph.next_edges(chunk_table).count() == chunk_table.count() - sections
    forms = graph.build_forms(chunk_table)
    assert rows(forms) == [("f1", "s1", "1", "c"), ("f2", "s2", "1", "c"), ("f3", "s3", "1", "c")]
    existing = spark.createDataFrame([("old", "s1", "9", "z")], "formId string, source string, cik string, cusip6 string")
    assert rows(graph.build_forms(chunk_table, existing))[-1] == ("old", "s1", "9", "z")
    known = forms.filter("formId <> 'f3'").unionByName(existing)
    parts = graph.part_of_edges(chunk_table, known)
    assert parts.count() == parts.select("src").distinct().count() == chunk_table.filter("formId <> 'f3'").count()
    assert rows(graph.section_heads(chunk_table, known)) == [
        ("f1", "f1-item1-chunk0000", "item1"),
        ("f1", "f1-item7-chunk0000", "item7"),
        ("f2", "f2-item1-chunk0000", "item1"),
    ]
    whole = dict(graph.section_text(chunk_table, overlap=200).filter("f10kItem = 'item1'").select("formId", "text").collect())
    assert whole == {"f1": "ab" * 2000, "f2": "xy" * 900, "f3": "z"}
    listed = graph.section_listing(chunk_table, "item1", first_source_only=True).select("section_chunks.*")
    assert {r.source for r in listed.collect()} == {"s1"} and listed.count() == 3


def test_upsert_policies(spark, rows):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, p string, q string")
    batch = spark.createDataFrame(
        [(2, None, 10, "n"), (2, "late", 5, "n"), (3, "c", 1, "n"), (3, "d", 2, "m"), (None, "z", 1, "n")],
        "k int, p string, ord int, extra string",
    )
    last = upsert.upsert(old, batch, ["k"], ["ord"])
    # The last record sets even a null; columns the batch lacks stay.
    assert rows(last) == [(1, "a", "x", None), (2, None, "y", "n"), (3, "d", None, "m")]
    first = upsert.upsert(old, batch, ["k"], ["ord"], upsert.FIRST)
    assert rows(first) == [(1, "a", "x", None), (2, "b", "y", None), (3, "c", None, "n")]
    again = upsert.upsert(last, batch, ["k"], ["ord"])
    assert rows(again) == rows(last)


def test_bucketed_tables_merge_without_a_shuffle(spark, rows):
    base = spark.range(200).select(F.col("id").alias("k"), F.lit("a").alias("p"))
    spark.sql("DROP TABLE IF EXISTS nodes_bucketed")
    spark.sql("DROP TABLE IF EXISTS batch_bucketed")
    upsert.write_bucketed(base, "nodes_bucketed", ["k"], 4)
    upsert.write_bucketed(base.filter("k > 150").withColumn("p", F.lit("b")), "batch_bucketed", ["k"], 4)
    merged = upsert.merge_folded(spark.table("nodes_bucketed"), spark.table("batch_bucketed"), ["k"])
    assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()
    assert merged.filter("p = 'b'").count() == 49 and merged.count() == 200
    spark.sql("DROP TABLE nodes_bucketed")
    spark.sql("DROP TABLE batch_bucketed")


def test_relations_need_both_ends(spark, rows):
    nodes = spark.createDataFrame([("a",), ("b",)], "id string")
    rels = spark.createDataFrame([("a", "b", 1, "w1", 1), ("a", "b", 1, "w2", 2), ("a", "b", 2, "w3", 3), ("a", "x", 1, "w4", 4)], "s string, t string, rank int, w string, ord int")
    none = spark.createDataFrame([], "type string, src string, dst string, rank int, w string")
    got = graph.load_rels(none, rels, nodes, nodes, ("id", "s"), ("id", "t"), "LINKS", ["ord"], rel_key="rank")
    assert rows(got) == [("LINKS", "a", "b", 1, "w2"), ("LINKS", "a", "b", 2, "w3")]
    unkeyed = graph.load_rels(none.drop("rank"), rels.drop("rank"), nodes, nodes, ("id", "s"), ("id", "t"), "LINKS", ["ord"])
    assert rows(unkeyed) == [("LINKS", "a", "b", "w3")]


def test_counter_sees_all_rows(spark):
    frame, seen = upsert.counted(spark.range(57))
    frame.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 57}


def test_delete_takes_relations_along(spark, rows):
    nodes = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "id string, x int")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "c")], "src string, dst string")
    kept, left = graph.detach_delete(nodes, edges, "id", F.col("x") == 1)
    assert rows(kept, "id") == [("b",), ("c",)] and rows(left) == [("b", "c"), ("c", "c")]


def test_vectors_attach_by_key(spark, rows):
    nodes = spark.createDataFrame([("a", [1.0]), ("b", None), ("c", [3.0])], "id string, textEmbedding array<float>")
    new = spark.createDataFrame([("a", [9.0]), ("b", [2.0]), ("zz", [7.0])], "id string, textEmbedding array<float>")
    assert rows(graph.attach_vectors(nodes, new, "id")) == [("a", [9.0]), ("b", [2.0]), ("c", [3.0])]


def test_several_vectors_for_one_key_leave_one_node(spark, rows):
    nodes = spark.createDataFrame([("a",), ("b",)], "id string")
    vectors = spark.createDataFrame([("a", [1.0], 2), ("a", [9.0], 1), ("a", None, 3), (None, [4.0], 1)], "id string, v array<double>, version int")
    assert rows(graph.attach_vectors(nodes, vectors, "id", "v", ["version"])) == [("a", [1.0]), ("b", None)]
    assert rows(graph.attach_vectors(nodes, vectors, "id", "v")) == [("a", [9.0]), ("b", None)]


@pytest.mark.parametrize("block_rows", [100, 2])
def test_a_null_key_is_a_group_at_any_block_size(spark, block_rows):
    frame = spark.createDataFrame([(None, n, f"n{n}") for n in range(6)], "k string, p int, v string")
    linked = next_in_group(frame, ["k"], "p", "v", block_rows).filter("next_value IS NOT NULL")
    assert sorted((r.v, r.next_value) for r in linked.collect()) == [(f"n{n}", f"n{n + 1}") for n in range(5)]


def test_append_and_count_and_truncate(spark):
    people = spark.createDataFrame([("x", 1)], "name string, age int")
    more = graph.append_node(people, name="y")
    assert {tuple(r) for r in more.collect()} == {("x", 1), ("y", None)}
    assert graph.node_count(people, more).first()[0] == 3
    assert graph.truncate(more).count() == 0 and graph.truncate(more).schema == more.schema


def test_profile_and_unique_keys(spark, rows):
    nodes = spark.createDataFrame([("A", {"x": "1"}), ("A", {"y": "1"}), ("B", {})], "label string, properties map<string,string>")
    edges = spark.createDataFrame([("T", {"w": "1"})], "type string, properties map<string,string>")
    assert rows(graph.graph_profile(nodes, edges)) == [
        ("node", "A", "x", 1),
        ("node", "A", "y", 1),
        ("node", "A", None, 2),
        ("node", "B", None, 1),
        ("relation", "T", "w", 1),
        ("relation", "T", None, 1),
    ]
    assert rows(quality.unique_key_violations(nodes, "label")) == [("A", 2)]


def test_vector_violations(spark, rows):
    data = [(1, [1.0, 0.0]), (2, [1.0]), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, None), (6, [None, 1.0])]
    frame = spark.createDataFrame(data, "id int, v array<float>")
    assert rows(quality.vector_violations(frame, "id", "v", 2)) == [
        (2, "wrong size"), (3, "zero length"), (4, "not a number"), (5, "missing"), (6, "not a number"),
    ]


def test_a_hot_group_is_spread_over_tasks(spark):
    # One group holds a third of all rows, the others are small.
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 997).cast("string"))).alias("g"),
        F.col("id").cast("int").alias("p"),
        F.col("id").cast("string").alias("t"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        linked = next_in_group(rows, ["g"], "p", "t", 300)
        texts = ordered_text(rows, ["g"], "p", "t", 300).withColumn("n", F.length("text"))
        for frame, size, used in ((linked, F.count("*"), "next_value"), (texts, F.sum("n"), "text")):
            by_task = frame.groupBy(F.spark_partition_id().alias("task")).agg(size.alias("n"), F.max(used))
            loads = [r.n for r in by_task.collect()]
            assert max(loads) < sum(loads) / 5
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_graph_schema_of_mixed_and_missing_values(spark, rows):
    nodes = spark.createDataFrame(
        [
            (1, "A", {"n": "1", "x": "-2", "b": "TRUE", "d": "2024-02-29", "m": "1"}),
            (2, "A", {"n": "999999999999999999", "x": "2.5e3", "b": "false", "d": "2024-03-01", "m": "2024-03-01"}),
            (3, "B", {"n": "1" * 19, "x": None, "e": ""}),
            (4, "B", None),
            (5, None, {"n": ".5"}),
        ],
        "id long, label string, properties map<string, string>",
    )
    edges = spark.createDataFrame(
        [(1, 3, "T", {"w": "1"}), (1, 3, "T", {"w": "x"}), (2, 3, "T", None), (1, 2, "S", {}), (1, 9, "T", None), (None, 3, "T", None)],
        "src long, dst long, type string, properties map<string, string>",
    )
    assert rows(graph.property_types(nodes, "label")) == sorted(
        [
            ("A", "b", "boolean", 2), ("A", "d", "date", 2), ("A", "m", "string", 2), ("A", "n", "long", 2), ("A", "x", "double", 2),
            ("B", "e", "string", 1), ("B", "n", "double", 1), ("B", "x", "null", 0), (None, "n", "double", 1),
        ],
        key=repr,
    )
    assert rows(graph.relation_patterns(nodes, edges)) == [("A", "S", "A", 1), ("A", "T", "B", 3)]
    found = rows(graph.graph_schema(nodes, edges))
    assert ("relation", "T", "w", "string", 2) in found and ("pattern", "A", "T", "B", 3) in found and len(found) == 12
    assert rows(graph.graph_schema(nodes.limit(0), edges.limit(0))) == []
