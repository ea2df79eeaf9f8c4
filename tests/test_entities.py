import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import entities


def node(entity_id, kind, **properties):
    listed = [{"key": k, "value": v} for k, v in properties.items()] or None
    return {"entityId": entity_id, "type": kind, "properties": listed}


DOCS = [
    ("d1", 1, {"nodes": [node("at&t", "RiskFactor", birthDate="1"), node("o'neil", "person", age="7")],
               "rels": [{"source": node("o'neil", "person"), "target": node("3m", "organization"), "type": "works at", "properties": [{"key": "Start Date", "value": "x"}]}]}),
    ("d2", 2, {"nodes": [node("AT&T", "riskfactor", birthDate="2"), node("At&t", "Riskfactor")],
               "rels": [{"source": node("O'NEIL", "Person"), "target": node("3M", "ORGANIZATION"), "type": "Works At", "properties": None}]}),
]


@pytest.fixture()
def extracted(spark):
    data = [(d, n, json.dumps(g)) for d, n, g in DOCS] + [("d3", 3, "not json"), ("d4", 4, None)]
    return entities.read_extractions(spark.createDataFrame(data, "documentId string, docOrder int, extraction string"))


def test_entities_are_written_once_by_the_first(spark, extracted, rows):
    existing = spark.createDataFrame([("Person", "O'Neil", {"kept": "1"})], "label string, entityId string, properties map<string,string>")
    nodes, rels = entities.extracted_nodes(extracted, "documentId"), entities.extracted_rels(extracted)
    merged = entities.merge_entities(existing, nodes)
    assert rows(merged) == [("Person", "O'Neil", {"kept": "1"}), ("Riskfactor", "At&T", {"birthdate": "1"})]
    with_ends = entities.merge_entities(existing, nodes, rels)
    assert ("Organization", "3M", {}) in rows(with_ends) and with_ends.count() == 3


def test_relations_are_written_once(spark, extracted, rows):
    rels = entities.extracted_rels(extracted)
    none = spark.createDataFrame([], rels.drop("docOrder", "relOrder").schema)
    merged = entities.merge_relations(none, rels)
    assert rows(merged) == [("Person", "O'Neil", "WORKS_AT", "Organization", "3M", {"startDate": "x"})]
    assert rows(entities.merge_relations(merged, rels)) == rows(merged)


def test_mentions_are_created_once_and_updated_every_time(spark, extracted, rows):
    nodes = entities.extracted_nodes(extracted, "documentId")
    documents = spark.createDataFrame([("d1",), ("d2",)], "documentId string")
    none = spark.createDataFrame([], "src string, label string, entityId string, creationTime timestamp, lastUpdateDate timestamp")

    def at(day):
        return F.lit(f"2024-01-0{day}").cast("timestamp")

    first = entities.merge_mentions(none, nodes.filter("documentId = 'd1'"), documents, "documentId", at(1))
    second = entities.merge_mentions(first, nodes, documents.filter("documentId = 'd1'"), "documentId", at(2))
    got = [(r.src, r.entityId, r.creationTime.day, r.lastUpdateDate.day) for r in second.collect()]
    assert sorted(got) == [("d1", "At&T", 1, 2), ("d1", "O'Neil", 1, 2)]


def test_nodes_without_an_id_are_set_aside_and_merging_twice_is_once(spark):
    graph = {"nodes": [node(None, "person"), node("a", "person")], "rels": []}
    stored = spark.createDataFrame([("d1", 1, json.dumps(graph))], "documentId string, docOrder int, extraction string")
    nodes = entities.extracted_nodes(entities.read_extractions(stored), "documentId")
    documents = stored.select("documentId")
    none = spark.createDataFrame([], "src string, label string, entityId string, creationTime timestamp, lastUpdateDate timestamp")
    now = F.lit("2024-01-01").cast("timestamp")
    once = entities.merge_mentions(none, nodes, documents, "documentId", now)
    twice = entities.merge_mentions(once, nodes, documents, "documentId", now)
    assert [r.entityId for r in once.collect()] == [r.entityId for r in twice.collect()] == ["A"]
    assert [tuple(r) for r in entities.unkeyed_nodes(nodes, "documentId").collect()] == [("d1", 0, "no entity id")]


def test_properties_without_a_key_are_left_out(spark, rows):
    listed = [{"key": None, "value": "x"}, {"key": "Birth date", "value": "1"}, None]
    graph = {"nodes": [{"entityId": "a", "type": "T", "properties": listed}], "rels": []}
    stored = spark.createDataFrame([("d1", 1, json.dumps(graph))], "documentId string, docOrder int, extraction string")
    nodes = entities.extracted_nodes(entities.read_extractions(stored), "documentId")
    assert rows(nodes, "properties") == [({"birthDate": "1"},)]


def test_unreadable_extractions_are_named(spark, rows):
    data = [("d1", '{"nodes": []}'), ("d2", "{"), ("d3", None), ("d4", '{"x": 1}'), ("d5", "")]
    stored = spark.createDataFrame(data, "documentId string, extraction string")
    assert rows(entities.extraction_failures(stored, "documentId")) == [
        ("d2", "not readable"),
        ("d3", "no extraction"),
        ("d4", "no graph"),
        ("d5", "not readable"),
    ]


def test_restricted_labels_are_spelled_as_extracted(spark, extracted, rows):
    nodes, rels = entities.extracted_nodes(extracted, "documentId"), entities.extracted_rels(extracted)
    labels = ["RiskFactor", "person"]
    assert entities.allowed(nodes, labels).count() == 4
    assert entities.allowed_rels(rels, labels).count() == 0  # the other end is an organisation
    assert entities.allowed_rels(rels, [*labels, "ORGANIZATION"], ["works at"]).count() == 2
    none = spark.createDataFrame([], "label string, entityId string, properties map<string,string>")
    merged = entities.merge_entities(none, entities.allowed(nodes, labels), entities.allowed_rels(rels, labels))
    assert {r.label for r in merged.collect()} == {"Person", "Riskfactor"}


def test_labels_are_free_unless_restricted(extracted):
    nodes = entities.extracted_nodes(extracted, "documentId")
    assert entities.allowed(nodes).count() == 4
    assert entities.allowed(nodes, ["Person"]).count() == 1
