"""Extracted sub-graphs -> cleaned entities, relations and mentions.

Input is (doc id, ordinal, graph) where ``graph`` follows ``schemas.EXTRACTED_GRAPH``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ledgerloom import schemas
from ledgerloom.functions import text
from ledgerloom.functions.bind import computed_once
from ledgerloom.operators import upsert as merge

ENTITY_KEYS = ["label", "entityId"]
REL_KEYS = ["srcLabel", "src", "type", "dstLabel", "dst"]


def read_extractions(stored: DataFrame, json_column: str = "extraction") -> DataFrame:
    """Stored model output as JSON text -> ``graph``; text that does not parse gives a null graph."""
    # Without options Spark reads only the fields of the graph that are asked for.
    return stored.withColumn("graph", F.from_json(json_column, schemas.EXTRACTED_GRAPH)).drop(json_column)


def extraction_failures(stored: DataFrame, doc: str, json_column: str = "extraction") -> DataFrame:
    """Quarantine: documents whose stored model output gives no graph: doc, reason."""
    schema = f"{schemas.EXTRACTED_GRAPH}, _corrupt_record STRING"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    read = computed_once(stored.select(doc, json_column), _graph=F.from_json(json_column, schema, options))
    reason = (
        F.when(F.col(json_column).isNull(), "no extraction")
        .when(F.col("_graph").isNull() | F.col("_graph._corrupt_record").isNotNull(), "not readable")
        .when(F.col("_graph.nodes").isNull() & F.col("_graph.rels").isNull(), "no graph")
    )
    return read.select(doc, reason.alias("reason")).filter(F.col("reason").isNotNull())


def cleaned_label(name: Column) -> Column:
    return text.capitalise(F.coalesce(name, F.lit("Node")))


def _label(node: Column) -> Column:
    return cleaned_label(node["type"])


def _exploded(extractions: DataFrame, part: str, order: str, name: str) -> DataFrame:
    """One row per element of a part of ``graph``, the last column of the frame.

    Spark filters what it explodes by size first, which would read the text again for each filter.
    """
    listed = computed_once(extractions, _listed=F.col(f"graph.{part}")).drop("graph")
    return listed.select(*listed.columns[:-1], F.posexplode("_listed").alias(order, name))


def extracted_nodes(extractions: DataFrame, doc: str, listed: bool = False) -> DataFrame:
    """One cleaned row per extracted node: doc, docOrder, nodeOrder, label, entityId, properties.

    With ``listed``, properties stay the list they are in the extraction, for a merge that cleans those it keeps.
    """
    nodes = _exploded(extractions.select(doc, "docOrder", "graph"), "nodes", "nodeOrder", "n")
    # Keys are filtered on; properties are only carried, so they stay prunable.
    keyed = computed_once(nodes, label=_label(F.col("n")), entityId=text.title_case(F.col("n.entityId")))
    return _with_properties(keyed, F.col("n.properties"), listed).drop("n")


def extracted_rels(extractions: DataFrame, listed: bool = False) -> DataFrame:
    """One cleaned row per extracted relation; ``listed`` as in :func:`extracted_nodes`."""
    keyed = computed_once(
        _exploded(extractions.select("docOrder", "graph"), "rels", "relOrder", "r"),
        srcLabel=_label(F.col("r.source")),
        src=text.title_case(F.col("r.source.entityId")),
        type=text.relation_type(F.col("r.type")),
        dstLabel=_label(F.col("r.target")),
        dst=text.title_case(F.col("r.target.entityId")),
    )
    return _with_properties(keyed, F.col("r.properties"), listed).drop("r")


def _with_properties(frame: DataFrame, properties: Column, listed: bool = False) -> DataFrame:
    return frame.withColumn("properties", properties if listed else text.property_map(properties))


def _merged_first(existing: DataFrame, batch: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """First wins. Listed properties are cleaned behind the fold, so once for each key and not for each record."""
    folded = merge.fold_batch(batch, keys, order_by, merge.FIRST)
    if isinstance(batch.schema["properties"].dataType, ArrayType):
        folded = _with_properties(folded, F.col("properties"))
    return merge.merge_folded(existing, folded, keys, merge.FIRST)


def allowed(nodes: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """Optional restriction to a list of labels, spelled as in the extraction; all labels pass by default."""
    return nodes.filter(F.col("label").isin(*_cleaned(labels))) if labels else nodes


def allowed_rels(rels: DataFrame, labels: list[str] | None = None, types: list[str] | None = None) -> DataFrame:
    """Optional restriction of relations to types, and to those whose two ends have an allowed label.

    Merged with nodes of the same labels, no end of another label comes back.
    """
    if labels:
        names = _cleaned(labels)
        rels = rels.filter(F.col("srcLabel").isin(*names) & F.col("dstLabel").isin(*names))
    return rels.filter(F.col("type").isin(*[t.replace(" ", "_").upper() for t in types])) if types else rels


def _cleaned(labels: list[str]) -> list[str]:
    return [label[:1].upper() + label[1:].lower() for label in labels]


def unkeyed_nodes(nodes: DataFrame, doc: str) -> DataFrame:
    """Quarantine: extracted nodes that no merge takes, because they have no id: doc, nodeOrder, reason."""
    return nodes.filter(F.col("entityId").isNull()).select(doc, "nodeOrder", F.lit("no entity id").alias("reason"))


def merge_entities(existing: DataFrame, nodes: DataFrame, rels: DataFrame | None = None) -> DataFrame:
    """Entities by (label, entityId): properties are written by the first extraction, existing rows win.

    With ``rels``, ends that no extraction lists as a node are added without properties.
    """
    batch = nodes.select(*ENTITY_KEYS, "properties", "docOrder", "nodeOrder", F.lit(0).alias("bare"))
    if rels is not None:
        kind = nodes.schema["properties"].dataType
        none = F.lit(None).cast(kind) if isinstance(kind, ArrayType) else F.expr("CAST(map() AS MAP<STRING, STRING>)")
        both = [
            F.struct(F.col(label).alias("label"), F.col(end).alias("entityId"))
            for label, end in (("srcLabel", "src"), ("dstLabel", "dst"))
        ]
        ends = rels.select(
            F.inline(F.array(*both)),
            none.alias("properties"),
            "docOrder",
            F.lit(0).alias("nodeOrder"),
            F.lit(1).alias("bare"),
        )
        batch = batch.unionByName(ends)
    return _merged_first(existing, batch, ENTITY_KEYS, ["docOrder", "bare", "nodeOrder"])


def merge_relations(existing: DataFrame, rels: DataFrame) -> DataFrame:
    """Relations by (source, type, target): properties are written once, by the first extraction."""
    return _merged_first(existing, rels, REL_KEYS, ["docOrder", "relOrder"])


def merge_mentions(
    existing: DataFrame, nodes: DataFrame, documents: DataFrame, doc: str, now: Column | None = None
) -> DataFrame:
    """Document -> entity edges. creationTime is set once, lastUpdateDate every time.

    Edges are folded to one per document and entity first; documents that do not exist drop out, and so do nodes
    without an id, see :func:`unkeyed_nodes`. Merging the same nodes again changes the update date only.
    """
    now = F.current_timestamp() if now is None else now
    keys = ["src", *ENTITY_KEYS]
    pairs = nodes.select(F.col(doc).alias("src"), *ENTITY_KEYS).dropna(subset=keys).distinct()
    known = pairs.join(documents.select(F.col(doc).alias("src")).distinct(), "src", "left_semi")
    batch = known.withColumns({"creationTime": now, "lastUpdateDate": now})
    return merge.merge_folded(existing, batch, keys, merge.LAST, create_only=("creationTime",))
