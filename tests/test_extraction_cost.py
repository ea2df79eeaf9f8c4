"""An extraction is read once, by tasks of bounded size, and only properties that stay are cleaned."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import entities
from ledgerloom.plans import catalog
from ledgerloom.plans import entities as plan
from ledgerloom.plans.catalog import Tables

NONE = "label string, entityId string, properties map<string,string>"


def optimized(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def cleaned_behind_the_fold(frame):
    head, below = optimized(frame).split("Aggregate [", 1)
    own, below = below.split("\n", 1)
    return "map_from_entries(" in head + own and "map_from_entries(" not in below and "min_by(struct(properties, properties#" in own


def listed(**properties):
    return [{"key": k, "value": v} for k, v in properties.items()]


@pytest.fixture()
def stored(spark):
    a, b = ({"entityId": "a b", "type": "tHing", "properties": listed(Key=str(n), kEy="z")} for n in (1, 2))
    rels = [{"source": a, "target": {"entityId": "c", "type": "end"}, "type": "to", "properties": listed(First="1")}]
    data = [
        ("d2", 2, json.dumps({"nodes": [b, {"entityId": "e", "type": None}], "rels": rels})),
        ("d1", 1, json.dumps({"nodes": [a], "rels": rels})),
        ("d0", None, json.dumps({"nodes": [], "rels": [{**rels[0], "target": b}]})),
    ]
    return spark.createDataFrame(data, "documentId string, docOrder int, extraction string")


def test_the_text_is_read_once(stored):
    found = entities.read_extractions(stored)
    assert optimized(entities.extracted_nodes(found, "documentId")).count("from_json(") == 1
    assert optimized(entities.extracted_rels(found)).count("from_json(") == 1


def test_a_part_of_odd_text_is_read_as_in_the_whole_graph(spark, rows):
    node, odd = '{"entityId": "a", "type": "T", "properties": [{"key": "k", "value": 1}]}', '{"entityId": [1], "type": {"x": 2}}'
    part = ["", "null", "5", '"x"', "[]", "{}", f"[{node}]", f"[{node}, 7]", f"[{odd}]", f"[{node}, {odd}]", f"[{node}", f'[{{"source": {node}, "target": 3}}]']
    texts = [f'{{"nodes": {x}, "rels": {y}}}' for x in part for y in part] + ["", "[]", "{", "null", f'[{{"nodes": [{node}]}}]', f'{{"nodes": [{node}]}} x', f'{{"nodes": [{node}], "nodes": []}}']
    frame = spark.createDataFrame([(str(n), n, x) for n, x in enumerate(texts)], "documentId string, docOrder int, extraction string")
    whole = F.from_json("extraction", schemas.EXTRACTED_GRAPH, {"mode": "PERMISSIVE"})
    kept = spark.createDataFrame(frame.withColumn("graph", whole).drop("extraction").collect(), f"documentId string, docOrder int, graph struct<{schemas.EXTRACTED_GRAPH}>")
    found = entities.read_extractions(frame)
    assert rows(entities.extracted_nodes(found, "documentId")) == rows(entities.extracted_nodes(kept, "documentId"))
    assert rows(entities.extracted_rels(found)) == rows(entities.extracted_rels(kept))


def tables(spark, folder):
    """All orders under one customer."""
    orders = spark.range(1000).select(
        F.col("id").alias("o_orderkey"), F.lit(1).cast("long").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.lit(1.5).alias("o_totalprice"), F.lit("5-LOW").alias("o_orderpriority"),
    )
    orders.coalesce(1).write.parquet(f"{folder}/orders.parquet")
    spark.sql("SELECT 1L c_custkey, 'C' c_name, 1 c_nationkey, 'S' c_mktsegment").write.parquet(f"{folder}/customer.parquet")
    spark.sql("SELECT 1 n_nationkey, 'N' n_name, 1 n_regionkey").write.parquet(f"{folder}/nation.parquet")
    return Tables(spark, str(folder))


def test_tasks_hold_a_bounded_number_of_rows_also_under_one_key(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "TASK_ROWS", 50)
    made = plan.stored(tables(spark, tmp_path))
    sizes = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1000 and len(sizes) == 20 and max(sizes) <= 75


def test_listed_properties_merge_to_the_same_entities_and_relations(spark, stored, rows):
    found, none = entities.read_extractions(stored), spark.createDataFrame([], NONE)

    def merged(as_listed):
        nodes = entities.extracted_nodes(found, "documentId", listed=as_listed)
        rels = entities.extracted_rels(found, listed=as_listed)
        old = spark.createDataFrame([], ", ".join(f"{k} string" for k in entities.REL_KEYS) + ", properties map<string,string>")
        return [
            (f.schema, rows(f))
            for f in (entities.merge_entities(none, nodes), entities.merge_entities(none, nodes, rels), entities.merge_relations(old, rels))
        ]

    assert merged(True) == merged(False)
    assert merged(True)[0][1] == [("Node", "E", {}), ("Thing", "A B", {"key": "z"})]


def test_properties_are_cleaned_behind_the_fold(spark, stored):
    nodes = entities.extracted_nodes(entities.read_extractions(stored), "documentId", listed=True)
    assert cleaned_behind_the_fold(entities.merge_entities(spark.createDataFrame([], NONE), nodes))


@pytest.mark.parametrize("name", ["entity_nodes", "entity_nodes_with_ends", "entity_rels"])
def test_registered_merges_clean_properties_behind_the_fold(spark, tmp_path, name):
    assert cleaned_behind_the_fold(getattr(plan, name)(tables(spark, tmp_path)))


def test_mention_edges_read_the_extraction_once(spark, tmp_path, monkeypatch):
    spark.range(4).select(F.col("id").alias("o_orderkey")).write.parquet(f"{tmp_path}/orders.parquet")
    seen = spark.sparkContext.accumulator(0)

    def label(k):
        seen.add(1)
        return "Tradeplace" if k % 2 else "Building"

    made = F.udf(label).asNondeterministic()
    named = spark.range(4).select(F.col("id").alias("documentId"), made("id").alias("label"), F.lit("x").alias("entityId"))
    monkeypatch.setattr(plan, "extractions", lambda t: None)
    monkeypatch.setattr(plan.entities, "extracted_nodes", lambda frame, doc: named)
    got = plan.mention_edges(Tables(spark, str(tmp_path))).collect()
    assert sorted((r.src, r.label, r.creationTime[:4]) for r in got) == [
        (0, "Building", "2024"), (1, "Tradeplace", "2023"), (2, "Building", "2024"), (3, "Tradeplace", "2023")
    ]
    assert seen.value == 4
