"""Domain tables derived from the given tables, in Spark and as SQL text.

Nothing here groups rows into a filing or a history by an unbounded key: a derived document comes from one
row, and a derived history page from a bounded range of keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import ids
from ledgerloom.operators import chunks
from ledgerloom.plans.catalog import Tables, spread

STOCK_WORDS = ("RING", "BOLT", "GEAR")
STOCK_TYPE = "R"
SMALL_COMPANY = 10
PAGE_KEYS = 1000

# Nine digits that spread over all prefixes, from a dense key.
CUSIP_SQL = "printf('%09d', ({key} * 7919993) % 1000000000)"
CUSIP6_SQL = "CASE WHEN {c} LIKE '000%' THEN substr({c}, 2, 6) ELSE substr({c}, 1, 6) END"


def cusip_of(key: Column) -> Column:
    return F.lpad(((key * 7919993) % 1000000000).cast("string"), 9, "0")


def part_cusip_sql() -> str:
    return CUSIP_SQL.format(key="p_partkey")


def holding_lines(t: Tables) -> DataFrame:
    """View H before the security filter: one line per lineitem row, numbers still exact."""
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    cusip = cusip_of(F.col("l_partkey"))
    return lines.select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("source"),
        F.col("l_suppkey").cast("string").alias("managerCik"),
        F.concat(F.lit("Suite "), F.col("l_suppkey").cast("string")).alias("managerAddress"),
        F.concat(F.lit("Manager "), F.col("l_suppkey").cast("string")).alias("managerName"),
        F.trunc("l_shipdate", "quarter").alias("reportCalendarOrQuarter"),
        ids.cusip6(cusip).alias("cusip6"),
        cusip.alias("cusip"),
        F.col("p_name").alias("companyName"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("value"),
        F.col("l_quantity").cast("bigint").alias("shares"),
        F.upper("p_name").alias("title"),
        F.col("l_returnflag").alias("shareType"),
    )


LINES_SQL = f"""
SELECT 'o' || l_orderkey AS source, CAST(l_suppkey AS VARCHAR) AS "managerCik",
       'Suite ' || l_suppkey AS "managerAddress", 'Manager ' || l_suppkey AS "managerName",
       CAST(date_trunc('quarter', l_shipdate) AS DATE) AS "reportCalendarOrQuarter",
       {CUSIP6_SQL.format(c=CUSIP_SQL.format(key="l_partkey"))} AS cusip6,
       {CUSIP_SQL.format(key="l_partkey")} AS cusip, p_name AS "companyName",
       CAST(l_extendedprice AS DECIMAL(18,2)) AS value, CAST(l_quantity AS BIGINT) AS shares,
       upper(p_name) AS title, l_returnflag AS "shareType"
FROM lineitem JOIN part ON l_partkey = p_partkey"""

STOCK_SQL = (
    f"\"shareType\" = '{STOCK_TYPE}' AND (" + " OR ".join(f"contains(title, '{w}')" for w in STOCK_WORDS) + ")"
)

H_SQL = f"h AS (SELECT * EXCLUDE (title, \"shareType\") FROM ({LINES_SQL}) WHERE {STOCK_SQL})"

ROLLUP_SQL = f"""{H_SQL}, r AS (
SELECT source, "managerCik", "managerAddress", "managerName",
       CAST("reportCalendarOrQuarter" AS VARCHAR) AS "reportCalendarOrQuarter", cusip6, cusip,
       min("companyName") AS "companyName", CAST(sum(value) AS DOUBLE) AS value,
       CAST(sum(shares) AS BIGINT) AS shares
FROM h GROUP BY ALL)"""


def companies(t: Tables, listed_only: bool = True) -> DataFrame:
    """Company list with one URL each."""
    cusip = cusip_of(F.col("p_partkey"))
    parts = t.part.filter(F.col("p_size") <= SMALL_COMPANY) if listed_only else t.part
    return parts.select(
        ids.cusip6(cusip).alias("cusip6"),
        F.col("p_partkey").cast("string").alias("cik"),
        F.col("p_name").alias("names"),
        cusip.alias("cusip"),
        ids.filing_url("", F.col("p_partkey").cast("string"), F.format_string("%010d-23-000001", "p_partkey")).alias(
            "form10KUrls"
        ),
    )


ALL_COMPANIES_SQL = f"""c AS (
SELECT {CUSIP6_SQL.format(c=part_cusip_sql())} AS cusip6, CAST(p_partkey AS VARCHAR) AS cik, p_name AS names,
       {part_cusip_sql()} AS cusip,
       '/Archives/edgar/data/' || p_partkey || '/' || printf('%010d', p_partkey) || '23000001/'
         || printf('%010d', p_partkey) || '-23-000001.txt' AS "form10KUrls"
FROM part)"""
COMPANIES_SQL = ALL_COMPANIES_SQL.replace("FROM part)", f"FROM part WHERE p_size <= {SMALL_COMPANY})")


def document_sections(t: Tables) -> DataFrame:
    """Every document as a one-section form."""
    return spread(t.documents).select(
        F.col("doc_id").cast("string").alias("formId"),
        F.lpad(F.col("doc_id").cast("string"), 10, "0").alias("cik"),
        F.substring(cusip_of(F.col("doc_id")), 1, 6).alias("cusip6"),
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit("-index.htm")).alias("source"),
        F.col("lang").alias("f10kItem"),
        "text",
    )


def document_chunks(t: Tables) -> DataFrame:
    """View C."""
    return chunks.chunk_fixed(document_sections(t))


STRIDE = chunks.CHUNK_SIZE - chunks.CHUNK_OVERLAP

CHUNKS_SQL = f"""c AS (
SELECT CAST(doc_id AS VARCHAR) AS "formId", lpad(CAST(doc_id AS VARCHAR), 10, '0') AS cik,
       substr({CUSIP_SQL.format(key="doc_id")}, 1, 6) AS cusip6,
       source || '/' || doc_id || '-index.htm' AS source, lang AS "f10kItem", CAST(i AS INTEGER) AS "chunkSeqId",
       substr(text, CAST(1 + i * {STRIDE} AS BIGINT), {chunks.CHUNK_SIZE}) AS text,
       doc_id || '-' || lang || '-chunk' || printf('%04d', i) AS "chunkId"
FROM documents, LATERAL (SELECT unnest(range(CAST(
       1 + greatest(0, ceil((length(text) - {chunks.CHUNK_SIZE}) / {STRIDE}.0)) AS BIGINT))) AS i)
WHERE length(text) > 0)"""


def quarter_slices(text: Column) -> list[Column]:
    """A text as four consecutive parts that together are the whole."""
    step = F.ceil(F.length(text) / F.lit(4)).cast("int")
    return [
        F.substr(text, step * n + 1, step) if n < 3 else F.substr(text, step * 3 + 1, F.length(text)) for n in range(4)
    ]


def quarter_slices_sql(text: str = "text") -> list[str]:
    step = f"CAST(ceil(length({text}) / 4.0) AS BIGINT)"
    return [
        f"substr({text}, {step} * {n} + 1, {step if n < 3 else f'length({text})'})" for n in range(4)
    ]
