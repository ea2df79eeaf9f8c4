"""The document graph as node and edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import upsert as merge
from ledgerloom.operators.split_groups import BLOCK_ROWS, next_in_group, ordered_text

SECTION_KEYS = ["formId", "f10kItem"]


def next_edges(
    chunks: DataFrame,
    keys: list[str] | None = None,
    position: str = "chunkSeqId",
    node_id: str = "chunkId",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every node linked to the one that follows it in its section: src, dst."""
    keys = keys or SECTION_KEYS
    slim = chunks.select(*keys, position, node_id)
    linked = next_in_group(slim, keys, position, node_id, block_rows)
    return linked.filter(F.col("next_value").isNotNull()).select(
        F.col(node_id).alias("src"), F.col("next_value").alias("dst")
    )


def build_forms(chunks: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One form per source, with the attributes of its first chunk; forms that exist stay as they are."""
    first = F.min_by(F.struct("formId", "cik", "cusip6"), F.struct("chunkSeqId", "f10kItem", "formId"))
    forms = chunks.groupBy("source").agg(first.alias("f")).select("f.formId", "source", "f.cik", "f.cusip6")
    if existing is None:
        return forms
    return existing.unionByName(forms.join(existing, "source", "left_anti"))


def part_of_edges(chunks: DataFrame, forms: DataFrame) -> DataFrame:
    """Chunk -> form for every chunk whose form exists. Chunk ids are unique, so no edge repeats."""
    known = forms.select("formId").distinct()
    return chunks.select("chunkId", "formId").join(known, "formId", "left_semi").select(
        F.col("chunkId").alias("src"), F.col("formId").alias("dst")
    )


def section_heads(chunks: DataFrame, forms: DataFrame) -> DataFrame:
    """Form -> first chunk of each of its sections: src, dst, f10kItem."""
    heads = chunks.filter(F.col("chunkSeqId") == 0).select("chunkId", "formId", "f10kItem")
    known = forms.select("formId").distinct()
    return heads.join(known, "formId", "left_semi").select(
        F.col("formId").alias("src"), F.col("chunkId").alias("dst"), "f10kItem"
    )


def distinct_sources(chunks: DataFrame, n: int = 10) -> DataFrame:
    return chunks.select("source").distinct().orderBy("source").limit(n)


def section_listing(chunks: DataFrame, item: str | None = None, first_source_only: bool = False) -> DataFrame:
    """Chunks as one struct column. Optionally one item, and only the first source there is."""
    rows = chunks.filter(F.col("f10kItem") == item) if item else chunks
    if first_source_only:
        # A one-row side by construction.
        rows = rows.join(F.broadcast(chunks.agg(F.min("source").alias("source"))), "source", "left_semi")
    return rows.select(F.struct("source", "f10kItem", "chunkSeqId").alias("section_chunks"))


def section_text(chunks: DataFrame, part_chunks: int = BLOCK_ROWS, overlap: int = 0) -> DataFrame:
    """Section text rebuilt from its chunks, as (formId, f10kItem, part, parts, text); whole where parts is 1.

    Overlaps stay doubled; ``overlap`` trims them for fixed-stride chunks.
    """
    if overlap:
        trimmed = F.when(F.col("chunkSeqId") == 0, F.col("text")).otherwise(F.substr("text", F.lit(overlap + 1)))
        chunks = chunks.withColumn("text", trimmed)
    return ordered_text(chunks, SECTION_KEYS, "chunkSeqId", "text", part_chunks)


def load_nodes(existing: DataFrame, batch: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """Node upsert: the last record of a key wins and sets every column it has."""
    return merge.upsert(existing, batch, [key], order_by, merge.LAST)


def resolve_endpoints(
    rels: DataFrame,
    sources: DataFrame,
    targets: DataFrame,
    source_key: str | tuple[str, str],
    target_key: str | tuple[str, str],
) -> DataFrame:
    """Relations whose two ends exist, ends renamed to src and dst.

    A key is one name, or a pair (name on the node, name on the relation).
    """
    node_src, rel_src = (source_key, source_key) if isinstance(source_key, str) else source_key
    node_dst, rel_dst = (target_key, target_key) if isinstance(target_key, str) else target_key
    named = rels.withColumnsRenamed({rel_src: "src", rel_dst: "dst"})
    return named.join(sources.select(F.col(node_src).alias("src")).distinct(), "src", "left_semi").join(
        targets.select(F.col(node_dst).alias("dst")).distinct(), "dst", "left_semi"
    )


def load_rels(
    existing: DataFrame,
    rels: DataFrame,
    sources: DataFrame,
    targets: DataFrame,
    source_key: str | tuple[str, str],
    target_key: str | tuple[str, str],
    rel_type: str,
    order_by: list[str],
    rel_key: str | None = None,
) -> DataFrame:
    """Relation upsert on (type, src, dst[, rel_key]); relations with a missing end drop out.

    The batch is folded to one row per relation before the ends are looked up, so a node with very many
    repeated relations is small by then; what is left of a hot end is split by the skew join.
    """
    node_src, rel_src = (source_key, source_key) if isinstance(source_key, str) else source_key
    node_dst, rel_dst = (target_key, target_key) if isinstance(target_key, str) else target_key
    named = rels.withColumnsRenamed({rel_src: "src", rel_dst: "dst"}).withColumn("type", F.lit(rel_type))
    keys = ["type", "src", "dst"] + ([rel_key] if rel_key else [])
    folded = merge.fold_batch(named, keys, order_by)
    known = resolve_endpoints(folded, sources, targets, (node_src, "src"), (node_dst, "dst"))
    return merge.merge_folded(existing, known, keys)


def attach_vectors(
    nodes: DataFrame, vectors: DataFrame, key: str, column: str = "textEmbedding", order_by: list[str] | None = None
) -> DataFrame:
    """Sets the vector of nodes that have a new one; vectors without a node are ignored.

    Of several vectors for one key the last in ``order_by`` order counts, without it the largest; null ones never do.
    """
    last = F.max_by(column, F.struct(*order_by)) if order_by else F.max(column)
    given = vectors.filter(F.col(column).isNotNull() & F.col(key).isNotNull())
    new = given.groupBy(key).agg(last.alias("_vector"))
    joined = nodes.join(new, key, "left")
    old = F.col(column) if column in nodes.columns else F.lit(None)
    return joined.withColumn(column, F.coalesce("_vector", old)).drop("_vector")


def detach_delete(
    nodes: DataFrame, edges: DataFrame, key: str, doomed, src: str = "src", dst: str = "dst"
) -> tuple[DataFrame, DataFrame]:
    """Nodes without those that meet the predicate, and edges without any that touched them."""
    gone = nodes.filter(doomed).select(F.col(key).alias("_gone")).distinct()
    kept_nodes = nodes.filter(~F.coalesce(doomed, F.lit(False)))
    kept_edges = edges.join(gone, edges[src] == gone["_gone"], "left_anti").join(
        gone, edges[dst] == gone["_gone"], "left_anti"
    )
    return kept_nodes, kept_edges


def truncate(table: DataFrame) -> DataFrame:
    """The table without rows; write it over every table of the graph to delete everything."""
    return table.limit(0)


def append_node(nodes: DataFrame, **properties) -> DataFrame:
    """The table with one more row; columns not given are null."""
    row = nodes.sparkSession.range(1).select(
        *[F.lit(v).cast(nodes.schema[k].dataType).alias(k) for k, v in properties.items()]
    )
    return nodes.unionByName(row, allowMissingColumns=True)


def node_count(*tables: DataFrame) -> DataFrame:
    """Number of nodes over all node tables."""
    per_table = [t.agg(F.count(F.lit(1)).alias("rows")) for t in tables]
    total = per_table[0]
    for one in per_table[1:]:
        total = total.unionByName(one)
    return total.agg(F.sum("rows").alias("rows"))


def graph_profile(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels and relation types with their row counts, and with the rows of each property: kind, name, property, rows.

    Expects nodes (label, properties MAP) and edges (type, properties MAP). property is null in the row that counts all
    rows of a name. One pass over each table; nothing is collected into a cell, however many properties there are.
    """

    def one(frame: DataFrame, kind: str, name: str) -> DataFrame:
        keys = F.coalesce(F.map_keys("properties"), F.array().cast("array<string>"))
        listed = frame.select(
            F.col(name).alias("name"), F.explode(F.concat(F.array(F.lit(None).cast("string")), keys)).alias("property")
        )
        counted = listed.groupBy("name", "property").agg(F.count(F.lit(1)).alias("rows"))
        return counted.select(F.lit(kind).alias("kind"), "name", "property", "rows")

    return one(nodes, "node", "label").unionByName(one(edges, "relation", "type"))


# Types of property values, and how a value's text shows them. A long is a double too; any other mixture is a string.
VALUE_TYPES = {
    "boolean": r"^(?i:true|false)$",
    "long": r"^[+-]?[0-9]{1,18}$",
    "double": r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
}


def property_types(frame: DataFrame, name: str) -> DataFrame:
    """The least type that holds every value of each property: ``name``, property, type, rows.

    Expects properties MAP<STRING, STRING>. Rows counts values that are not null; a property without any has the type
    ``null``. What is known of a property is one count for each type, so partial results of tasks, and of earlier
    loads, merge by sums.
    """
    text = F.col("value")
    kind = F.when(text.isNull(), "null")
    for type_name, pattern in VALUE_TYPES.items():
        kind = kind.when(text.rlike(pattern), type_name)
    values = frame.select(name, F.explode("properties").alias("property", "value"))
    values = values.select(name, "property", kind.otherwise("string").alias("kind"))

    def times(*kinds: str) -> Column:
        return F.count_if(F.col("kind").isin(*kinds))

    counted = values.groupBy(name, "property").agg(
        F.count_if(F.col("kind") != "null").alias("rows"),
        *[times(k).alias(f"_{k}") for k in VALUE_TYPES],
    )
    least = F.when(F.col("rows") == 0, "null")
    for type_name in VALUE_TYPES:
        fits = F.col("_long") + F.col("_double") if type_name == "double" else F.col(f"_{type_name}")
        least = least.when(fits == F.col("rows"), type_name)
    return counted.select(name, "property", least.otherwise("string").alias("type"), "rows")


def relation_patterns(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """How often each (label)-[type]->(label) occurs: source, type, target, rows; edges without both ends do not count.

    Expects nodes (id, label), one row per id and label, and edges (src, dst, type). Edges are folded to (type, src, dst)
    and, with the label of their end, to (type, src, label) before they are shuffled again, so a node with very many
    edges is a few rows in the second join.
    """
    ends = nodes.select("id", "label")
    folded = edges.groupBy("type", "src", "dst").agg(F.count(F.lit(1)).alias("rows"))
    to = folded.join(ends.select(F.col("id").alias("dst"), F.col("label").alias("target")), "dst")
    to = to.groupBy("type", "src", "target").agg(F.sum("rows").alias("rows"))
    both = to.join(ends.select(F.col("id").alias("src"), F.col("label").alias("source")), "src")
    return both.groupBy("source", "type", "target").agg(F.sum("rows").alias("rows"))


def graph_schema(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Property types of labels and relations, and relation patterns, as (kind, source, name, target, rows).

    ``node`` and ``relation`` rows have the label or relation type, the property and its type; ``pattern`` rows the label
    of the start, the relation type and the label of the end. Expects nodes (id, label, properties MAP) and edges
    (src, dst, type, properties MAP).
    """

    def shaped(frame: DataFrame, kind: str, *columns: str) -> DataFrame:
        source, name, target = (F.col(c) for c in columns)
        return frame.select(F.lit(kind).alias("kind"), source.alias("source"), name.alias("name"), target.alias("target"), "rows")

    return union_all_by_name(
        shaped(property_types(nodes, "label"), "node", "label", "property", "type"),
        shaped(property_types(edges.withColumnRenamed("type", "of"), "of"), "relation", "of", "property", "type"),
        shaped(relation_patterns(nodes, edges), "pattern", "source", "type", "target"),
    )


def union_all_by_name(*frames: DataFrame) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
