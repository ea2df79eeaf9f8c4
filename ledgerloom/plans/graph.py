"""The document graph: lists, forms, upserts, deletes, profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import graph, key_sketch, quality, relink, upsert
from ledgerloom.operators.bucket_store import BucketStore
from ledgerloom.plans import standins as S
from ledgerloom.plans.catalog import Tables, query
from ledgerloom.session import work_folder


@query(
    "next_edges",
    f"""WITH {S.CHUNKS_SQL} SELECT "chunkId" AS src, nxt AS dst FROM (
          SELECT "chunkId", lead("chunkId") OVER (PARTITION BY "formId", "f10kItem" ORDER BY "chunkSeqId") AS nxt
          FROM c) WHERE nxt IS NOT NULL""",
)
def next_edges(t: Tables) -> DataFrame:
    return graph.next_edges(S.document_chunks(t))


# Lists are linked, then some chunks come and others go. Blocks are small, since sections of the tables are.
LATE, GONE, LIST_BLOCK = "chunkSeqId % 11 = 3", "chunkSeqId % 13 = 5", 4


@query(
    "relinked_edges",
    f"""WITH {S.CHUNKS_SQL} SELECT "formId", "f10kItem", "chunkId" AS src, nxt AS dst FROM (
          SELECT "formId", "f10kItem", "chunkId",
                 lead("chunkId") OVER (PARTITION BY "formId", "f10kItem" ORDER BY "chunkSeqId") AS nxt
          FROM c WHERE NOT ("chunkSeqId" % 13 = 5)) WHERE nxt IS NOT NULL""",
)
def relinked_edges(t: Tables) -> DataFrame:
    """Lists as they are after a change, from the lists before it."""
    chunks = S.document_chunks(t).select("formId", "f10kItem", "chunkSeqId", "chunkId")
    before = relink.linked(chunks.filter(f"NOT ({LATE})"), block_rows=LIST_BLOCK)
    changed = chunks.filter(f"({LATE}) OR ({GONE})")
    after = relink.relink(before, chunks.filter(f"NOT ({GONE})"), changed, block_rows=LIST_BLOCK)
    return after.drop(relink.BLOCK)


@query(
    "load_violations",
    """WITH b AS (SELECT l_partkey * 7 + l_linenumber AS key FROM lineitem)
       SELECT key, count(*) AS rows FROM (SELECT key FROM b UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT key FROM b))
       GROUP BY key HAVING count(*) > 1""",
)
def load_violations(t: Tables) -> DataFrame:
    """Keys of a batch that are not unique in it and the stored table, found by a sketch of the stored keys."""
    stored, keys = t.orders.select(F.col("o_orderkey").alias("key")), ["key"]
    blocks = key_sketch.blocks_for(stored.count())
    path = work_folder(t.spark, "key-sketch")
    key_sketch.sketch(stored, keys, blocks).write.parquet(path)
    batch = t.lineitem.select((F.col("l_partkey") * 7 + F.col("l_linenumber")).alias("key"))
    return key_sketch.load_violations(batch, stored, t.spark.read.parquet(path), keys, blocks)


@query(
    "next_turns",
    """SELECT src, dst FROM (SELECT conv_id || '-' || turn AS src,
              lead(conv_id || '-' || turn) OVER (PARTITION BY conv_id ORDER BY turn) AS dst
       FROM (SELECT DISTINCT conv_id, turn FROM conversations)) WHERE dst IS NOT NULL""",
)
def next_turns(t: Tables) -> DataFrame:
    turns = t.conversations.select("conv_id", "turn").distinct()
    named = turns.withColumn("id", F.format_string("%d-%d", "conv_id", "turn"))
    return graph.next_edges(named, ["conv_id"], "turn", "id")


@query(
    "section_listing",
    f"""WITH {S.CHUNKS_SQL} SELECT source, "f10kItem", "chunkSeqId" FROM c""",
)
def section_listing(t: Tables) -> DataFrame:
    return graph.section_listing(S.document_chunks(t)).select("section_chunks.*")


@query(
    "first_section_listing",
    f"""WITH {S.CHUNKS_SQL} SELECT source, "f10kItem", "chunkSeqId" FROM c
        WHERE source = (SELECT min(source) FROM c) ORDER BY "chunkSeqId" """,
)
def first_section_listing(t: Tables) -> DataFrame:
    listed = graph.section_listing(S.document_chunks(t), first_source_only=True)
    return listed.select("section_chunks.*").orderBy("chunkSeqId")


@query(
    "section_text",
    f"""WITH {S.CHUNKS_SQL}
        SELECT "formId", "f10kItem", CAST("chunkSeqId" // {graph.BLOCK_ROWS} AS BIGINT) AS part,
               CAST(1 + max(max("chunkSeqId")) OVER (PARTITION BY "formId", "f10kItem") // {graph.BLOCK_ROWS} AS BIGINT) AS parts,
               string_agg(text, '' ORDER BY "chunkSeqId") AS text FROM c GROUP BY "formId", "f10kItem", "chunkSeqId" // {graph.BLOCK_ROWS}""",
)
def section_text(t: Tables) -> DataFrame:
    return graph.section_text(S.document_chunks(t))


@query(
    "section_text_trimmed",
    """SELECT CAST(doc_id AS VARCHAR) AS "formId", lang AS "f10kItem", CAST(0 AS BIGINT) AS part, CAST(1 AS BIGINT) AS parts, text
       FROM documents WHERE length(text) > 0""",
)
def section_text_trimmed(t: Tables) -> DataFrame:
    """Fixed-stride chunks without their overlaps give back the text."""
    return graph.section_text(S.document_chunks(t), overlap=S.chunks.CHUNK_OVERLAP)


@query(
    "distinct_sources",
    f"""WITH {S.CHUNKS_SQL} SELECT DISTINCT source FROM c ORDER BY source LIMIT 10""",
)
def distinct_sources(t: Tables) -> DataFrame:
    return graph.distinct_sources(S.document_chunks(t))


FORMS_SQL = """forms AS (SELECT arg_min("formId", "chunkSeqId") AS "formId", source,
                arg_min(cik, "chunkSeqId") AS cik, arg_min(cusip6, "chunkSeqId") AS cusip6 FROM c GROUP BY source)"""


@query("build_forms", f"""WITH {S.CHUNKS_SQL}, {FORMS_SQL} SELECT * FROM forms""")
def build_forms(t: Tables) -> DataFrame:
    return graph.build_forms(S.document_chunks(t))


# Forms exist for all documents but the German ones, so German chunks find no parent.
KNOWN_FORMS_SQL = """known AS (SELECT CAST(doc_id AS VARCHAR) AS "formId" FROM documents WHERE lang <> 'de')"""


def known_forms(t: Tables) -> DataFrame:
    return t.documents.filter(F.col("lang") != "de").select(F.col("doc_id").cast("string").alias("formId"))


@query(
    "part_of_edges",
    f"""WITH {S.CHUNKS_SQL}, {KNOWN_FORMS_SQL} SELECT DISTINCT "chunkId" AS src, "formId" AS dst
        FROM c JOIN known USING ("formId")""",
)
def part_of_edges(t: Tables) -> DataFrame:
    return graph.part_of_edges(S.document_chunks(t), known_forms(t))


@query(
    "section_heads",
    f"""WITH {S.CHUNKS_SQL}, {KNOWN_FORMS_SQL} SELECT DISTINCT "formId" AS src, "chunkId" AS dst, "f10kItem"
        FROM c JOIN known USING ("formId") WHERE "chunkSeqId" = 0""",
)
def section_heads(t: Tables) -> DataFrame:
    return graph.section_heads(S.document_chunks(t), known_forms(t))


@query("node_scan_project", "SELECT doc_id, source, text FROM documents")
def node_scan_project(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "source", "text")


@query(
    "param_query",
    """SELECT c_custkey, 'Hello ' || c_name AS message FROM customer WHERE c_mktsegment = 'BUILDING'""",
)
def param_query(t: Tables) -> DataFrame:
    return t.spark.sql(
        "SELECT c_custkey, :greeting || c_name AS message FROM {nodes} WHERE c_mktsegment = :segment",
        args={"greeting": "Hello ", "segment": "BUILDING"},
        nodes=t.customer,
    )


@query(
    "node_count",
    """SELECT CAST((SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier)
              + (SELECT count(*) FROM documents) AS BIGINT) AS rows""",
)
def node_count(t: Tables) -> DataFrame:
    return graph.node_count(t.customer, t.supplier, t.documents)


@query(
    "node_append",
    """SELECT c_custkey, c_name, c_mktsegment FROM customer
       UNION ALL SELECT CAST(-1 AS BIGINT), 'Ada', NULL""",
)
def node_append(t: Tables) -> DataFrame:
    people = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return graph.append_node(people, c_custkey=-1, c_name="Ada")


@query(
    "node_upsert",
    """WITH b AS (SELECT o_custkey * 2 AS c_custkey, arg_max(o_totalprice, o_orderkey) AS c_acctbal,
                         arg_max(o_orderpriority, o_orderkey) AS c_mktsegment, arg_max(o_orderstatus, o_orderkey) AS status
                  FROM orders GROUP BY 1)
       SELECT coalesce(c.c_custkey, b.c_custkey) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
              CASE WHEN b.c_custkey IS NOT NULL THEN b.c_acctbal ELSE c.c_acctbal END AS c_acctbal,
              CASE WHEN b.c_custkey IS NOT NULL THEN b.c_mktsegment ELSE c.c_mktsegment END AS c_mktsegment, status
       FROM customer c FULL JOIN b ON c.c_custkey = b.c_custkey""",
)
def node_upsert(t: Tables) -> DataFrame:
    batch = t.orders.select(
        (F.col("o_custkey") * 2).alias("c_custkey"),
        F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderpriority").alias("c_mktsegment"),
        F.col("o_orderstatus").alias("status"),
        "o_orderkey",
    )
    # A vector computed with the batch would be loaded on its own; wide columns stay out of the upsert.
    wide = batch.withColumn("textEmbedding", F.array(F.col("c_acctbal")))
    nodes = t.customer.withColumn("c_nationkey", F.col("c_nationkey").cast("string"))
    return graph.load_nodes(nodes, wide.drop("textEmbedding"), "c_custkey", ["o_orderkey"])


@query(
    "merge_twice",
    """WITH b AS (SELECT o_custkey AS key, o_totalprice AS price, o_orderpriority AS priority, o_orderkey AS place,
                         CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END AS part FROM orders),
            one AS (SELECT key, arg_max(price, place) AS price, arg_max(priority, place) AS priority, min(place) AS since FROM b WHERE part = 1 GROUP BY key),
            two AS (SELECT key, arg_max(price, place) AS price, arg_max(priority, place) AS priority, min(place) AS since FROM b
                    WHERE part = 2 AND key % 10 = 3 GROUP BY key)
       SELECT coalesce(two.key, one.key) AS key, coalesce(two.price, one.price) AS price,
              coalesce(two.priority, one.priority) AS priority, coalesce(one.since, two.since) AS since
       FROM one FULL JOIN two ON one.key = two.key""",
)
def merge_twice(t: Tables) -> DataFrame:
    """Two batches into a bucketed store, the first of them offered twice."""
    schema = "key bigint, price double, priority string, since bigint"
    store = BucketStore(t.spark, work_folder(t.spark, "merge-twice"), schema, ["key"], buckets=16)
    batch = t.orders.select(
        F.col("o_custkey").alias("key"),
        F.col("o_totalprice").cast("double").alias("price"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderkey").alias("since"),
        F.col("o_orderkey").alias("place"),
    )
    even = batch.where("place % 2 = 0")
    for name, part in (("even", even), ("odd", batch.where("place % 2 <> 0 AND key % 10 = 3")), ("even", even)):
        store.merge(part, name, ["place"], create_only=("since",))
    return store.read()


@query(
    "load_counts",
    """WITH b AS (SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey * 2 END AS k FROM orders),
            s AS (SELECT (SELECT count(*) FROM b) AS records, (SELECT count(*) FROM b WHERE k IS NULL) AS "no key",
              (SELECT count(DISTINCT k) FROM b) AS keys,
              (SELECT count(DISTINCT k) FROM b WHERE k NOT IN (SELECT c_custkey FROM customer)) AS created,
              (SELECT count(DISTINCT k) FROM b WHERE k IN (SELECT c_custkey FROM customer)) AS updated)
       SELECT step, rows FROM (UNPIVOT s ON COLUMNS(*) INTO NAME step VALUE rows)""",
)
def load_counts(t: Tables) -> DataFrame:
    key = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey") * 2)
    return upsert.load_counts(t.customer, t.orders.select(key.alias("c_custkey")), ["c_custkey"])


@query(
    "rel_upsert",
    f"""WITH old AS (SELECT l_suppkey AS src, l_partkey AS dst, l_returnflag AS flag, max(l_quantity) AS quantity
                     FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL),
             new AS (SELECT l_suppkey AS src, l_partkey AS dst, l_returnflag AS flag, l_quantity AS quantity,
                            l_extendedprice AS price
                     FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
                     WHERE l_linestatus = 'F' AND p_size <= 25
                     QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_partkey, l_returnflag ORDER BY
                       l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC, l_extendedprice DESC) = 1)
        SELECT 'SUPPLIES' AS type, src, dst, flag,
               CASE WHEN new.price IS NOT NULL THEN new.quantity ELSE old.quantity END AS quantity, price
        FROM old FULL JOIN new USING (src, dst, flag)""",
)
def rel_upsert(t: Tables) -> DataFrame:
    old = (
        t.lineitem.filter(F.col("l_linestatus") == "O")
        .groupBy(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_returnflag").alias("flag"))
        .agg(F.max("l_quantity").alias("quantity"))
        .withColumn("type", F.lit("SUPPLIES"))
    )
    batch = t.lineitem.filter(F.col("l_linestatus") == "F").select(
        "l_suppkey",
        "l_partkey",
        F.col("l_returnflag").alias("flag"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice").alias("ord"),
    )
    small_parts = t.part.filter(F.col("p_size") <= 25)
    return graph.load_rels(
        old,
        batch,
        t.supplier,
        small_parts,
        ("s_suppkey", "l_suppkey"),
        ("p_partkey", "l_partkey"),
        "SUPPLIES",
        ["ord"],
        rel_key="flag",
    )


def rounded_text(vector: str) -> Column:
    """A vector as whole ten-thousandths, so that its content can be compared."""
    whole = F.transform(vector, lambda x: F.round(x.cast("double") * 10000).cast("bigint").cast("string"))
    return F.array_join(whole, " ")


@query(
    "attach_embeddings",
    """SELECT doc_id, lang, array_to_string(list_transform(
                CASE WHEN vec_id % 7 = 0 THEN list_reverse(embedding) ELSE embedding END,
                lambda x: CAST(CAST(round(CAST(x AS DOUBLE) * 10000) AS BIGINT) AS VARCHAR)), ' ') AS vector
       FROM documents LEFT JOIN embeddings ON doc_id = vec_id""",
)
def attach_embeddings(t: Tables) -> DataFrame:
    nodes = t.documents.select("doc_id", "lang")
    fresh = t.embeddings.select(
        F.col("vec_id").alias("doc_id"), F.col("embedding").alias("textEmbedding"), F.lit(1).alias("version")
    )
    # Every seventh key has a second, later vector, and every fifth an older one.
    later = fresh.filter("doc_id % 7 = 0").withColumns({"textEmbedding": F.reverse("textEmbedding"), "version": F.lit(2)})
    older = fresh.filter("doc_id % 5 = 0").withColumns({"textEmbedding": F.reverse("textEmbedding"), "version": F.lit(0)})
    done = graph.attach_vectors(nodes, later.union(fresh).union(older), "doc_id", order_by=["version"])
    return done.select("doc_id", "lang", rounded_text("textEmbedding").alias("vector"))


@query(
    "detach_delete",
    """SELECT 'node' AS kind, CAST(c_custkey AS VARCHAR) AS src, NULL AS dst FROM customer WHERE c_mktsegment <> 'BUILDING'
       UNION ALL SELECT 'edge', CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR) FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
         AND o_orderkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def detach_delete(t: Tables) -> DataFrame:
    edges = t.orders.select(F.col("o_custkey").alias("src"), F.col("o_orderkey").alias("dst"))
    nodes, left = graph.detach_delete(t.customer, edges, "c_custkey", F.col("c_mktsegment") == "BUILDING")
    named = nodes.select(F.lit("node").alias("kind"), F.col("c_custkey").alias("src"))
    every = named.unionByName(left.withColumn("kind", F.lit("edge")), allowMissingColumns=True)
    return every.withColumns({c: F.col(c).cast("string") for c in ("src", "dst")})


@query(
    "truncate_graph",
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM {name}"
        for name in ("customer", "orders", "documents")
    ),
)
def truncate_graph(t: Tables) -> DataFrame:
    counts = []
    for name in ("customer", "orders", "documents"):
        table = getattr(t, name)
        marked = table.select(F.lit(0).alias("after")).unionByName(
            graph.truncate(table).select(F.lit(1).alias("after"))
        )
        counts.append(
            marked.agg(
                F.lit(name).alias("name"),
                F.count_if(F.col("after") == 0).alias("rows_before"),
                F.count_if(F.col("after") == 1).alias("rows_after"),
            )
        )
    return graph.union_all_by_name(*counts)


@query(
    "unique_key_violations",
    """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def unique_key_violations(t: Tables) -> DataFrame:
    return quality.unique_key_violations(t.lineitem, "l_orderkey", "l_linenumber")


@query(
    "graph_profile",
    """SELECT 'node' AS kind, event_type AS name, p AS property, count(*) AS rows
       FROM events, (VALUES (NULL), ('k')) AS v(p) GROUP BY ALL
       UNION ALL SELECT 'relation', 'PLACED_' || o_orderstatus, p, count(*)
       FROM orders, (VALUES (NULL), ('priority'), ('total')) AS v(p) GROUP BY ALL""",
)
def graph_profile(t: Tables) -> DataFrame:
    nodes = t.events.select(
        F.col("event_type").alias("label"), F.from_json("props", "MAP<STRING, STRING>").alias("properties")
    )
    edges = t.orders.select(
        F.concat(F.lit("PLACED_"), "o_orderstatus").alias("type"),
        F.create_map(
            F.lit("priority"), "o_orderpriority", F.lit("total"), F.col("o_totalprice").cast("string")
        ).alias("properties"),
    )
    return graph.graph_profile(nodes, edges)


SCHEMA_VALUES_SQL = """
    SELECT 'node' AS kind, c_mktsegment AS source, name, kind_of FROM (
      SELECT c_mktsegment, 'nation' AS name, 'long' AS kind_of FROM customer
      UNION ALL SELECT c_mktsegment, 'balance', CASE WHEN c_custkey % 3 = 0 THEN 'long' ELSE 'double' END FROM customer
      UNION ALL SELECT c_mktsegment, 'mixed', CASE c_custkey % 3 WHEN 0 THEN 'boolean' WHEN 1 THEN 'long' ELSE 'string' END FROM customer
      UNION ALL SELECT c_mktsegment, 'unset', NULL FROM customer)
    UNION ALL SELECT 'node', 'ORDER_' || o_orderstatus, 'day', 'date' FROM orders
    UNION ALL SELECT 'relation', 'PLACED', 'urgent', CASE WHEN o_orderkey % 2 = 0 THEN 'boolean' END FROM orders"""


@query(
    "graph_schema",
    f"""WITH v AS ({SCHEMA_VALUES_SQL}),
          k AS (SELECT kind, source, name, count(kind_of) AS rows, count(DISTINCT kind_of) AS kinds, min(kind_of) AS least, max(kind_of) AS most
                FROM v GROUP BY ALL)
        SELECT kind, source, name, CASE WHEN kinds = 0 THEN 'null' WHEN kinds = 1 THEN least
               WHEN kinds = 2 AND least = 'double' AND most = 'long' THEN 'double' ELSE 'string' END AS target, rows FROM k
        UNION ALL
        SELECT 'pattern', c_mktsegment, 'PLACED', 'ORDER_' || o_orderstatus, count(*)
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
)
def graph_schema(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    balance = F.when(key % 3 == 0, F.col("c_acctbal").cast("bigint").cast("string")).otherwise(F.col("c_acctbal").cast("string"))
    mixed = F.when(key % 3 == 0, "true").when(key % 3 == 1, key.cast("string")).otherwise(F.col("c_name"))
    people = t.customer.select(
        F.concat(F.lit("c"), key).alias("id"),
        F.col("c_mktsegment").alias("label"),
        F.create_map(
            F.lit("nation"), F.col("c_nationkey").cast("string"), F.lit("balance"), balance, F.lit("mixed"), mixed,
            F.lit("unset"), F.lit(None).cast("string"),
        ).alias("properties"),
    )
    placed = t.orders.select(
        F.concat(F.lit("o"), "o_orderkey").alias("id"),
        F.concat(F.lit("ORDER_"), "o_orderstatus").alias("label"),
        F.create_map(F.lit("day"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("properties"),
    )
    edges = t.orders.select(
        F.concat(F.lit("c"), "o_custkey").alias("src"),
        F.concat(F.lit("o"), "o_orderkey").alias("dst"),
        F.lit("PLACED").alias("type"),
        F.create_map(F.lit("urgent"), F.when(F.col("o_orderkey") % 2 == 0, "false")).alias("properties"),
    )
    return graph.graph_schema(people.unionByName(placed), edges)


@query(
    "vector_validation",
    """SELECT vec_id, CASE label WHEN 3 THEN 'wrong size' WHEN 4 THEN 'zero length' ELSE 'not a number' END AS reason
       FROM embeddings WHERE label IN (3, 4, 5)""",
)
def vector_validation(t: Tables) -> DataFrame:
    v, label = F.col("embedding"), F.col("label")
    # Three labels get a fault each: one value too few, all zeros, one value that is no number.
    faulty = (
        F.when(label == 3, F.slice(v, F.lit(2), F.size(v) - 1))
        .when(label == 4, F.transform(v, lambda x: F.lit(0).cast("float")))
        .when(label == 5, F.transform(v, lambda x, i: F.when(i == 7, F.lit(float("nan")).cast("float")).otherwise(x)))
        .otherwise(v)
    )
    return quality.vector_violations(t.embeddings.withColumn("embedding", faulty), "vec_id", "embedding", 64)


@query(
    "union_by_name",
    """SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_name, s_nationkey, NULL FROM supplier""",
)
def union_by_name(t: Tables) -> DataFrame:
    left = t.customer.select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    right = t.supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"))
    return graph.union_all_by_name(left, right)
