"""The registered queries of this folder and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    language,
    line_dedup,
    merkle,
    mixing,
    packing,
    pii,
    quality,
    rabitq,
    simhash,
    token_files,
    toxicity,
    vafile,
    whitening,
)
from ledgerloom.llm.common import in_fold
from ledgerloom.session import work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    classes = simhash.near_duplicates(table(spark, folder, "documents"), shingle_words=3, max_bits=2)
    return classes.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op2_nearest(spark: SparkSession, folder: str) -> DataFrame:
    found = rabitq.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)
    return found.select("query_id", "rank", "vec_id", "score")


@query
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op3_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
firsts AS (SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (
  SELECT k.*, length(k.key) >= 10 AND k.doc_id <> f.first_doc AS dropped
  FROM keyed k LEFT JOIN firsts f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT coalesce(dropped, false)), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = in_fold(F.col("doc_id"), folds=5, which=0)
    found = language.identify(docs.select("doc_id", "text"), language.learn(docs, may_learn=~held_out))
    return found.select(
        "doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), "lang_rejected"
    )


@query
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = in_fold(F.col("doc_id"), folds=3, which=1)
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return judged(quality.score(docs, quality.learn(docs, labels, may_learn=~held_out)), held_out)


def judged(scored: DataFrame, held_out: Column) -> DataFrame:
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted)


@query
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query
def op7_products(spark: SparkSession, folder: str) -> DataFrame:
    found = vafile.top_products(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
    return found.select("query_id", "rank", "vec_id", F.expr("try_cast(score AS BIGINT)").alias("score"))


ORACLES["op7_products"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM pairs)
SELECT * FROM ranked WHERE rank <= 5
"""


@query
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = in_fold(F.col("doc_id"), folds=5, which=0)
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("label"))
    return judged(toxicity.score(docs, toxicity.learn(docs, labels, may_learn=~held_out)), held_out)


@query
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents"))
    counts = [pii.count_of(F.col("base"), kind).alias(f"n_{name}") for kind, name in enumerate(pii.KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("found")).alias("spans")
    )


@query
def op11_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs, files = table(spark, folder, "documents"), work_folder(spark, "token-files")
    token_files.write(docs, public_tokenizers.path("word_bpe_49k.json"), files, end_id=2)
    found = token_files.read(token_files.keys_of(docs), files)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    tampered = [F.try_add("n_chars", F.lit(1)) if c == "n_chars" else F.col(c) for c in fields]
    leaves = docs.select(
        "doc_id",
        "lang",
        merkle.leaf_digest(*map(F.col, fields)).alias("leaf"),
        F.when(in_fold(F.col("doc_id"), folds=7, which=0), merkle.leaf_digest(*tampered)).alias("tampered"),
    )
    found, root = merkle.manifest(leaves, "lang", "doc_id")
    folded = found.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("witness")))
    return folded.select(
        "doc_id",
        "leaf",
        "subroot",
        F.lit(root).alias("root"),
        merkle.proof_digest(F.col("witness")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.lit(root)).alias("verified"),
    )


def crc_table() -> list[int]:
    """The table of the reflected polynomial 0xEDB88320, by its rule."""
    found = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        found.append(value)
    return found


def digest_sql(n_chars: str) -> str:
    fields = ("doc_id", "source", "lang", n_chars, "text")
    texts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END" for c in fields]
    return f"sha256({' || '.join(texts)})"


def tree_sql(name: str, group: str, leaves: str) -> str:
    """A recursive table of all nodes; one row with n = 1 in each group at the end."""
    return f"""{name} AS (
  {leaves}
  UNION ALL
  SELECT {group}, lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM {name} WHERE n > 1 GROUP BY {group}, lvl, idx // 2, n)"""


ORACLES["op12_merkle"] = f"""
WITH RECURSIVE
crc AS (
  SELECT doc_id, source, lang, n_chars, text, xor(list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, b: xor(a >> 8, {crc_table()}[CAST((xor(a, b) & 255) + 1 AS INTEGER)])), 4294967295) AS crc FROM documents),
leaves AS (
  SELECT doc_id, lang, {digest_sql("n_chars")} AS leaf,
         CASE WHEN crc % 7 = 0 THEN {digest_sql("(n_chars + 1)")} ELSE {digest_sql("n_chars")} END AS checked FROM crc),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM leaves),
{tree_sql("tree", "lang", "SELECT lang, 0 AS lvl, pos AS idx, n, leaf AS h FROM placed")},
subroots AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
{tree_sql("top", "one", "SELECT 1 AS one, 0 AS lvl, pos AS idx, n, subroot AS h FROM subroots")},
steps AS (
  SELECT p.doc_id, p.lang, p.pos, t.lvl, p.pos >> t.lvl AS spot, t.n FROM placed p
  JOIN (SELECT DISTINCT lang, lvl, n FROM tree WHERE n > 1) t ON p.lang IS NOT DISTINCT FROM t.lang),
low AS (
  SELECT s.lang, s.pos, list(CASE WHEN b.h IS NULL THEN '' WHEN spot % 2 = 1 THEN 'L' || b.h ELSE 'R' || b.h END ORDER BY s.lvl) AS w
  FROM steps s LEFT JOIN tree b ON s.lang IS NOT DISTINCT FROM b.lang AND s.lvl = b.lvl AND xor(s.spot, 1) = b.idx
  GROUP BY s.lang, s.pos),
high AS (
  SELECT r.lang, list(CASE WHEN b.h IS NULL THEN '' WHEN (r.pos >> t.lvl) % 2 = 1 THEN 'L' || b.h ELSE 'R' || b.h END ORDER BY t.lvl) AS w
  FROM subroots r JOIN (SELECT DISTINCT lvl, n FROM top WHERE n > 1) t ON true
  LEFT JOIN top b ON t.lvl = b.lvl AND xor(r.pos >> t.lvl, 1) = b.idx
  GROUP BY r.lang),
proofs AS (
  SELECT p.doc_id, p.leaf, p.checked, r.subroot, coalesce(low.w, CAST([] AS VARCHAR[])) || coalesce(high.w, CAST([] AS VARCHAR[])) AS w
  FROM placed p JOIN subroots r ON p.lang IS NOT DISTINCT FROM r.lang
  LEFT JOIN low ON p.lang IS NOT DISTINCT FROM low.lang AND p.pos = low.pos
  LEFT JOIN high ON p.lang IS NOT DISTINCT FROM high.lang),
folds AS (
  SELECT *, list_reduce(list_prepend(checked, w), lambda a, e: sha256(
    CASE WHEN e = '' THEN a WHEN e[1] = 'L' THEN e[2:] || a ELSE a || e[2:] END)) AS folded_root FROM proofs)
SELECT doc_id, leaf, subroot, (SELECT h FROM top WHERE n = 1) AS root,
       sha256(array_to_string(list_transform(w, lambda e: e[2:]), '')) AS proof_sha256, folded_root,
       folded_root = (SELECT h FROM top WHERE n = 1) AS verified
FROM folds
"""


@query
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    white = whitening.whiten(table(spark, folder, "embeddings"), components=4)
    deviation = F.expr("try_cast(deviation AS BIGINT)").alias("deviation")
    return white.select("vec_id", "component", "n", deviation, "whitened", "explained", "identity_error")
