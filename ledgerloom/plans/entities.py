"""Stored extractions -> entities, relations, mentions.

Every order stands for a document whose extraction names its customer and the customer's nation, and says
where the customer is located. The JSON text is built per order and parsed back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import session
from ledgerloom.functions import text
from ledgerloom.operators import entities
from ledgerloom.operators.bucket_store import BucketStore
from ledgerloom.plans.catalog import Tables, dealt, query
from ledgerloom.streaming import merges

CREATED, UPDATED = "2023-01-01 00:00:00", "2024-06-01 12:00:00"


def _property(key: str | Column, value: Column) -> Column:
    return F.struct((F.lit(key) if isinstance(key, str) else key).alias("key"), value.alias("value"))


def stored(t: Tables) -> DataFrame:
    """Orders with their extraction as JSON text."""
    customer = F.struct(
        F.lower("c_name").alias("entityId"),
        F.col("c_mktsegment").alias("type"),
        F.array(
            _property("Order Total", F.col("o_totalprice").cast("string")),
            _property(F.col("o_orderpriority"), F.col("o_orderstatus")),
            # The same key twice: the last one wins.
            _property("order status", F.lit("unknown")),
            _property("Order Status", F.col("o_orderstatus")),
        ).alias("properties"),
    )
    nation = F.struct(
        F.col("n_name").alias("entityId"),
        F.lit("tradePlace").alias("type"),
        F.lit(None).cast("array<struct<key: string, value: string>>").alias("properties"),
    )
    # The region is an end of a relation but no extracted node.
    region = F.struct(
        F.concat(F.lit("region "), F.col("n_regionkey").cast("string")).alias("entityId"),
        F.lit("Region").alias("type"),
        F.lit(None).cast("array<struct<key: string, value: string>>").alias("properties"),
    )
    located = F.struct(
        customer.alias("source"),
        nation.alias("target"),
        F.lit("located in").alias("type"),
        F.array(_property("first order", F.col("o_orderkey").cast("string"))).alias("properties"),
    )
    within = F.struct(
        nation.alias("source"),
        region.alias("target"),
        F.lit("part of").alias("type"),
        F.lit(None).cast("array<struct<key: string, value: string>>").alias("properties"),
    )
    graph = F.struct(F.array(customer, nation).alias("nodes"), F.array(located, within).alias("rels"))
    orders = t.orders
    joined = (
        orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "c_name", "c_mktsegment", "n_name", "n_regionkey"
        )
    )
    return dealt(joined, orders.count()).select(
        F.col("o_orderkey").alias("documentId"), F.col("o_orderkey").alias("docOrder"), F.to_json(graph).alias("extraction")
    )


def extractions(t: Tables) -> DataFrame:
    return entities.read_extractions(stored(t))


def stored_mentions(t: Tables, folder: str) -> DataFrame:
    """Documents and the entities they name, cleaned once and stored, for queries that read them more than once."""
    extracted = entities.extracted_nodes(extractions(t), "documentId").select("documentId", "label", "entityId")
    extracted.write.parquet(f"{folder}/extracted")
    return t.spark.read.parquet(f"{folder}/extracted")


_TITLE_SQL = (
    "array_to_string(list_transform(string_split({x}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"
)
_CAP_SQL = "upper({x}[1]) || lower({x}[2:])"
_CAMEL_SQL = "lower(string_split({x}, ' ')[1]) || array_to_string(list_transform(string_split({x}, ' ')[2:], lambda w: upper(w[1]) || lower(w[2:])), '')"

# Properties as text, by sorted key.
ROWS_SQL = f"""o AS (
SELECT o_orderkey, {_CAP_SQL.format(x="c_mktsegment")} AS segment, c_name AS customer,
       {_TITLE_SQL.format(x="n_name")} AS nation, 'Region ' || n_regionkey AS region,
       array_to_string(list_sort([{_CAMEL_SQL.format(x="o_orderpriority")} || '=' || o_orderstatus,
         'orderStatus=' || o_orderstatus, 'orderTotal=' || CAST(o_totalprice AS VARCHAR)]), ';') AS properties
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

# Some entities exist before: the customers of one segment, without properties but one.
EXISTING_SQL = "e AS (SELECT 'Building' AS label, c_name AS \"entityId\", 'since=2020' AS properties FROM customer WHERE c_mktsegment = 'BUILDING')"

NODES_SQL = f"""{ROWS_SQL}, {EXISTING_SQL}, n AS (
SELECT segment AS label, customer AS "entityId", arg_min(properties, o_orderkey) AS properties FROM o GROUP BY ALL
UNION ALL SELECT DISTINCT 'Tradeplace', nation, '' FROM o)"""


def as_text(properties: str = "properties") -> Column:
    """A map as sorted ``key=value`` text."""
    pairs = F.transform(F.map_entries(properties), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(pairs), ";")


def existing_entities(t: Tables) -> DataFrame:
    return t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(
        F.lit("Building").alias("label"),
        F.col("c_name").alias("entityId"),
        F.create_map(F.lit("since"), F.lit("2020")).alias("properties"),
    )


@query(
    "property_keys",
    f"""SELECT o_orderkey, {_CAMEL_SQL.format(x="o_orderpriority")} AS camel,
               array_to_string(list_sort([{_CAMEL_SQL.format(x="o_orderpriority")} || '=' || o_orderstatus,
                 'orderStatus=' || o_orderstatus]), ';') AS properties
        FROM orders""",
)
def property_keys(t: Tables) -> DataFrame:
    listed = F.array(
        _property("order  status", F.lit("unknown")),
        _property(F.col("o_orderpriority"), F.col("o_orderstatus")),
        _property(" Order Status ", F.col("o_orderstatus")),
    )
    made = t.orders.select(
        "o_orderkey", text.camel_key(F.col("o_orderpriority")).alias("camel"), text.property_map(listed).alias("p")
    )
    return made.select("o_orderkey", "camel", as_text("p").alias("properties"))


@query(
    "entity_nodes",
    f"""WITH {NODES_SQL} SELECT coalesce(e.label, n.label) AS label, coalesce(e."entityId", n."entityId") AS "entityId",
          coalesce(e.properties, n.properties) AS properties
        FROM e FULL JOIN n ON e.label = n.label AND e."entityId" = n."entityId" """,
)
def entity_nodes(t: Tables) -> DataFrame:
    nodes = entities.extracted_nodes(extractions(t), "documentId", listed=True)
    merged = entities.merge_entities(existing_entities(t), nodes)
    return merged.withColumn("properties", as_text())


@query(
    "entity_nodes_with_ends",
    f"""WITH {NODES_SQL} SELECT coalesce(e.label, n.label) AS label, coalesce(e."entityId", n."entityId") AS "entityId",
          coalesce(e.properties, n.properties) AS properties
        FROM e FULL JOIN n ON e.label = n.label AND e."entityId" = n."entityId"
        UNION ALL SELECT DISTINCT 'Region', region, '' FROM o""",
)
def entity_nodes_with_ends(t: Tables) -> DataFrame:
    found = extractions(t)
    merged = entities.merge_entities(
        existing_entities(t), entities.extracted_nodes(found, "documentId", listed=True), entities.extracted_rels(found)
    )
    return merged.withColumn("properties", as_text())


@query(
    "entity_rels",
    f"""WITH {ROWS_SQL}
        SELECT segment AS "srcLabel", customer AS src, 'LOCATED_IN' AS type, 'Tradeplace' AS "dstLabel", nation AS dst,
               'firstOrder=' || min(o_orderkey) AS properties FROM o GROUP BY ALL
        UNION ALL SELECT DISTINCT 'Tradeplace', nation, 'PART_OF', 'Region', region, '' FROM o""",
)
def entity_rels(t: Tables) -> DataFrame:
    rels = entities.extracted_rels(extractions(t), listed=True)
    keys = ", ".join(f"{key} string" for key in entities.REL_KEYS)
    none = t.spark.createDataFrame([], f"{keys}, properties map<string, string>")
    return entities.merge_relations(none, rels).withColumn("properties", as_text())


@query(
    "mention_edges",
    f"""WITH {ROWS_SQL}, m AS (SELECT o_orderkey AS src, segment AS label, customer AS "entityId" FROM o
                               UNION ALL SELECT o_orderkey, 'Tradeplace', nation FROM o)
        SELECT src, label, "entityId", CASE WHEN label = 'Tradeplace' THEN '{CREATED}' ELSE '{UPDATED}' END
               AS "creationTime", '{UPDATED}' AS "lastUpdateDate" FROM m""",
)
def mention_edges(t: Tables) -> DataFrame:
    nodes = stored_mentions(t, session.work_folder(t.spark, "mention-edges"))
    created = F.lit(CREATED).cast("timestamp")
    # Mentions of places exist from an earlier run.
    old = nodes.filter(F.col("label") == "Tradeplace").select(
        F.col("documentId").alias("src"),
        "label",
        "entityId",
        created.alias("creationTime"),
        created.alias("lastUpdateDate"),
    )
    documents = t.orders.select(F.col("o_orderkey").alias("documentId"))
    merged = entities.merge_mentions(old, nodes, documents, "documentId", F.lit(UPDATED).cast("timestamp"))
    stamps = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("creationTime", "lastUpdateDate")}
    return merged.withColumns(stamps)


@query(
    "incremental_mentions",
    f"""WITH {ROWS_SQL}, m AS (SELECT o_orderkey AS src, segment AS label, customer AS "entityId" FROM o
                               UNION ALL SELECT o_orderkey, 'Tradeplace', nation FROM o)
        SELECT src, label, "entityId", CASE WHEN label = 'Tradeplace' THEN '{CREATED}' ELSE '{UPDATED}' END
               AS "creationTime", '{UPDATED}' AS "lastUpdateDate" FROM m""",
)
def incremental_mentions(t: Tables) -> DataFrame:
    """Mentions from a stream of extracted nodes in four arrivals: places first, then all of them, some twice."""
    folder = session.work_folder(t.spark, "mentions")
    nodes = stored_mentions(t, folder)  # every arrival reads it
    arrivals = [("label = 'Tradeplace'", CREATED)] + [(f"documentId % 2 = {k}", UPDATED) for k in (0, 1, 0)]
    for rows, stamp in arrivals:
        nodes.where(rows).withColumn("at", F.lit(stamp)).write.mode("append").parquet(f"{folder}/arriving")
    files = t.spark.read.parquet(f"{folder}/arriving")
    stream = t.spark.readStream.schema(files.schema).option("maxFilesPerTrigger", 16).parquet(f"{folder}/arriving")
    keys = ["src", "label", "entityId"]
    schema = f"src {files.schema['documentId'].dataType.simpleString()}, label string, entityId string, creationTime string, lastUpdateDate string"
    store = BucketStore(t.spark, f"{folder}/store", schema, keys, buckets=16)
    known = t.orders.select(F.col("o_orderkey").alias("src")).distinct()

    def mentions(batch: DataFrame) -> DataFrame:
        named = batch.select(F.col("documentId").alias("src"), "label", "entityId", "at", F.col("at").alias("creationTime"), F.col("at").alias("lastUpdateDate"))
        return named.join(known, "src", "left_semi")

    merges.start_merges(stream, store, "mentions", f"{folder}/checkpoint", ["at"], create_only=("creationTime",), prepare=mentions).awaitTermination()
    return store.read()


@query(
    "extraction_failures",
    """SELECT o_orderkey AS "documentId", CASE o_orderpriority WHEN '1-URGENT' THEN 'not readable' WHEN '2-HIGH'
              THEN 'no graph' ELSE 'no extraction' END AS reason
       FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
)
def extraction_failures(t: Tables) -> DataFrame:
    """One priority's text is cut off, one holds another object, one has no text."""
    whole = F.lit('{"nodes": [{"entityId": "a", "type": "T"}], "rels": []}')
    priority = F.col("o_orderpriority")
    text_ = (
        F.when(priority == "1-URGENT", F.substring(whole, 1, 30)).when(priority == "2-HIGH", F.lit('{"answer": 1}'))
        .when(priority != "3-MEDIUM", whole)
    )
    stored_text = t.orders.select(F.col("o_orderkey").alias("documentId"), text_.alias("extraction"))
    return entities.extraction_failures(stored_text, "documentId")


@query(
    "allowed_relations",
    f"""WITH {ROWS_SQL} SELECT o_orderkey AS "docOrder", segment AS "srcLabel", customer AS src FROM o
        WHERE segment IN ('Building', 'Machinery')""",
)
def allowed_relations(t: Tables) -> DataFrame:
    rels = entities.extracted_rels(extractions(t))
    kept = entities.allowed_rels(rels, ["BUILDING", "Machinery", "tradePlace"], ["located in"])
    return kept.select("docOrder", "srcLabel", "src")


@query(
    "entity_label_filter",
    f"""WITH {ROWS_SQL} SELECT o_orderkey AS "documentId", segment AS label, customer AS "entityId" FROM o
        WHERE segment IN ('Building', 'Machinery')
        UNION ALL SELECT o_orderkey, 'Tradeplace', nation FROM o""",
)
def entity_label_filter(t: Tables) -> DataFrame:
    nodes = entities.extracted_nodes(extractions(t), "documentId")
    return entities.allowed(nodes, ["BUILDING", "Machinery", "tradePlace"]).select("documentId", "label", "entityId")
