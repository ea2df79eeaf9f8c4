"""Annual report text: documents, sections, markup, chunks."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom import schemas, session
from ledgerloom.functions import markup, text
from ledgerloom.operators import chunks, embedding, sections
from ledgerloom.plans import standins as S
from ledgerloom.plans.catalog import Tables, query, spread
from ledgerloom.plans.embedding_sql import embed_sql
from ledgerloom.sources import files

# A bundle per document: an exhibit, then the annual report with a table of contents that repeats every
# header, four quarters of the text under the item headers, and items that end a section without being
# one. French documents have no item 7A; Spanish ones have no main document.
_Q = S.quarter_slices_sql()
CONTENTS = "<p>Item 1.</p><p>Item 1A.</p><p>Item&#160;7.</p>"
LAST_CONTENT = "<p>Item 7A.</p>"
HEADERS = ("<h2>Item 1.", "<h2>ITEM&nbsp;1A.", "<h2>Item&#160;7.", "<h2>Item 7A.")
LAST_CONTENT_SQL = f"CASE WHEN lang = 'fr' THEN '' ELSE '{LAST_CONTENT}' END || '<p>ITEM 8</p>'"
MAIN_SQL = f"""'\n<TYPE>10-K\n<TEXT>{CONTENTS}' || {LAST_CONTENT_SQL} || '{HEADERS[0]}</h2>' || {_Q[0]} || '{HEADERS[1]}</h2>' || {_Q[1]}
   || '<h2>Item 1B.</h2>none' || '{HEADERS[2]}</h2>' || {_Q[2]}
   || CASE WHEN lang = 'fr' THEN '' ELSE '{HEADERS[3]}</h2>' || {_Q[3]} END || '<p>ITEM 8 Statements</p></TEXT>\n'"""


def bundles(t: Tables) -> DataFrame:
    first, second, third, fourth = S.quarter_slices(F.col("text"))
    main = F.concat(
        F.when(F.col("lang") == "es", "\n<TYPE>10-K405\n").otherwise("\n<TYPE>10-K\n"),
        F.lit(f"<TEXT>{CONTENTS}"),
        F.when(F.col("lang") == "fr", "").otherwise(LAST_CONTENT),
        F.lit(f"<p>ITEM 8</p>{HEADERS[0]}</h2>"),
        first,
        F.lit(f"{HEADERS[1]}</h2>"),
        second,
        F.lit(f"<h2>Item 1B.</h2>none{HEADERS[2]}</h2>"),
        third,
        F.when(F.col("lang") == "fr", "").otherwise(F.concat(F.lit(f"{HEADERS[3]}</h2>"), fourth)),
        F.lit("<p>ITEM 8 Statements</p></TEXT>\n"),
    )
    exhibit = "<DOCUMENT>\n<TYPE>EX-21\nItem 1. subsidiaries\n</DOCUMENT>\n"
    raw = F.concat(F.lit(f"<SEC-HEADER>\r\n{exhibit}<DOCUMENT>"), main, F.lit("</DOCUMENT>\n"))
    return spread(t.documents).select("doc_id", text.unix_newlines(raw).alias("raw"))


@query(
    "tenk_main_document",
    f"""SELECT doc_id, CASE WHEN lang <> 'es' THEN regexp_replace({MAIN_SQL}, '\r\n?', '\n', 'g') END AS document
        FROM documents""",
)
def tenk_main_document(t: Tables) -> DataFrame:
    return sections.main_document(bundles(t)).drop("raw")


def _markup_sql(source: str) -> str:
    """The native markup chain, with the references that occur in the given tables."""
    cuts = (
        f"regexp_replace({source}, '(?is)(?:<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>"
        f"|<template\\b.*?</template\\s*>|<[!?][^>]*>|</?[a-z][^>]*(?:>|\\z))+', chr(1), 'g')"
    )
    sql = f"replace(trim({cuts}, chr(1)), chr(1), chr(10))"
    for name in ("lt", "gt", "quot", "nbsp", "copy", "middot"):
        sql = f"replace({sql}, '&{name};', chr({name2codepoint[name]}))"
    for number in (39, 160):
        sql = f"replace({sql}, '&#{number};', chr({number}))"
    # "&amp" is read without its semicolon too.
    return f"replace(replace(replace({sql}, '&amp;', chr(2)), '&amp', '&'), chr(2), '&')"


def tenk_urls(t: Tables) -> DataFrame:
    """The URL list for the bundles: one URL per document."""
    doc = F.col("doc_id").cast("string")
    return t.documents.select(
        doc.alias("cik"),
        F.substring(S.cusip_of(F.col("doc_id")), 1, 6).alias("cusip6"),
        F.array(S.cusip_of(F.col("doc_id"))).alias("cusip"),
        F.array("lang", "source").alias("names"),
        F.concat(F.lit("https://example.org/data/"), doc, F.lit(".txt")).alias("form10KUrls"),
    )


def _section_sql(head: str, part: str) -> str:
    body = f"substr('{head}', 5) || '</h2>' || {part}"
    return _markup_sql(f"replace(regexp_replace({body}, '\r\n?', '\n', 'g'), '{sections.BOOKMARK_ERROR}', '')")


# A section runs from its last header to the next kept one, with the markup around that header.
_ENDS = ("<h2", "<h2", "<h2", "<p")


@query(
    "tenk_sections",
    " UNION ALL ".join(
        f"""SELECT doc_id, '{item}' AS item, {_section_sql(head, part + f" || '{end}'")} AS text
            FROM documents WHERE lang NOT IN ('es', 'fr')"""
        for item, head, part, end in zip(sections.ITEMS, HEADERS, _Q, _ENDS)
    ),
)
def tenk_sections(t: Tables) -> DataFrame:
    return sections.sections(sections.main_document(bundles(t)))


@query(
    "tenk_json",
    f"""SELECT {", ".join(f"{_section_sql(head, part + f" || '{end}'")} AS {item}"
                          for item, head, part, end in zip(sections.ITEMS, HEADERS, _Q, _ENDS))},
               CAST(doc_id AS VARCHAR) AS cik, substr({S.CUSIP_SQL.format(key="doc_id")}, 1, 6) AS cusip6,
               {S.CUSIP_SQL.format(key="doc_id")} AS cusip, lang || ';' || source AS names,
               'https://example.org/data/' || doc_id || '-index.htm' AS source
        FROM documents WHERE lang NOT IN ('es', 'fr')""",
)
def tenk_json(t: Tables) -> DataFrame:
    """Raw reports and the URL list -> one JSON object per report, written and read again."""
    raw = bundles(t).withColumn("file_name", F.format_string("%d.txt", "doc_id")).drop("doc_id")
    made = sections.report_rows(sections.sections(sections.main_document(raw)), tenk_urls(t))
    path = session.work_folder(t.spark, "tenk")
    files.write_json(made, path)
    back = files.read_json_lines(t.spark, path, schemas.SECTIONS_JSON)
    return back.withColumns({c: F.array_join(c, ";") for c in ("cusip", "names")})


@query(
    "tenk_quarantine",
    """SELECT doc_id, CASE lang WHEN 'es' THEN 'no main document' ELSE 'missing item' END AS reason
       FROM documents WHERE lang IN ('es', 'fr')""",
)
def tenk_quarantine(t: Tables) -> DataFrame:
    return sections.section_failures(sections.main_document(bundles(t)))


_PIECES = [
    ("", f"'\n<TYPE>10-K\n<TEXT>{CONTENTS}' || {LAST_CONTENT_SQL} || '<h2'"),
    ("item1", f"'{HEADERS[0][3:]}</h2>' || {_Q[0]} || '<h2'"),
    ("item1a", f"'{HEADERS[1][3:]}</h2>' || {_Q[1]} || '<h2'"),
    ("item1b", "'>Item 1B.</h2>none<h2'"),
    ("item7", f"'{HEADERS[2][3:]}</h2>' || {_Q[2]} || CASE WHEN lang = 'fr' THEN '<p' ELSE '<h2' END"),
    ("item7a", f"CASE WHEN lang = 'fr' THEN '' ELSE '{HEADERS[3][3:]}</h2>' || {_Q[3]} || '<p' END"),
    ("item8", "'>ITEM 8 Statements</p></TEXT>\n'"),
]


@query(
    "section_end_lead",
    f"""WITH b AS (
          SELECT doc_id, lang, regexp_replace({MAIN_SQL}, '\r\n?', '\n', 'g') AS document,
                 [{", ".join(f"length(regexp_replace({sql}, '\r\n?', '\n', 'g'))" for _, sql in _PIECES)}] AS n
          FROM documents WHERE lang <> 'es'),
        p AS (SELECT doc_id, length(document) AS whole, unnest([{", ".join(f"'{name}'" for name, _ in _PIECES)}]) AS item,
                     unnest(list_transform(range(1, {len(_PIECES)} + 1), lambda i: list_sum(n[1:i - 1]))) AS start FROM b)
        SELECT doc_id, item, CAST(start AS INTEGER) AS start,
               CAST(coalesce(lead(start) OVER (PARTITION BY doc_id ORDER BY start), whole) AS INTEGER) AS "sectionEnd"
        FROM p JOIN documents USING (doc_id) WHERE NOT (lang = 'fr' AND item = 'item7a') QUALIFY item <> ''""",
)
def section_end_lead(t: Tables) -> DataFrame:
    return sections.section_bounds(sections.main_document(bundles(t)))


@query("html_to_text", f"SELECT page_id, {_markup_sql('html')} AS text FROM pages")
def html_to_text(t: Tables) -> DataFrame:
    return spread(t.pages).select("page_id", markup.html_to_text(F.col("html")).alias("text"))


@query("html_to_text_exact", f"SELECT page_id, {_markup_sql('html')} AS text FROM pages")
def html_to_text_exact(t: Tables) -> DataFrame:
    return spread(t.pages).select("page_id", markup.html_to_text_exact(F.col("html")).alias("text"))


@query(
    "chunk_fixed",
    f"""WITH {S.CHUNKS_SQL} SELECT * FROM c""",
)
def chunk_fixed(t: Tables) -> DataFrame:
    return S.document_chunks(t)


@query("chunk_recursive")
def chunk_recursive(t: Tables) -> DataFrame:
    return chunks.chunk_recursive(S.document_sections(t))


@query(
    "embed_chunks",
    f"""WITH {S.CHUNKS_SQL}, {embed_sql("e", "c", '"chunkId"', "text", 256)}
        SELECT "chunkId", array_to_string(list_transform(v,
          lambda x: CAST(CAST(round(x * 1000) AS BIGINT) AS VARCHAR)), ' ') AS vector FROM e""",
)
def embed_chunks(t: Tables) -> DataFrame:
    made = embedding.embed(S.document_chunks(t), embedding.hashing_embedder())
    whole = F.transform("textEmbedding", lambda x: F.round(x.cast("double") * 1000).cast("bigint").cast("string"))
    return made.select("chunkId", F.array_join(whole, " ").alias("vector"))


CHUNK_FAULTS = ("too_long", "not_in_text", "not_rising", "lost_text", "long_overlap")


@query(
    "chunk_recursive_properties",
    f"""SELECT doc_id, {", ".join(f"CAST(0 AS BIGINT) AS {name}" for name in CHUNK_FAULTS)}
        FROM documents WHERE trim(text, chr(32) || chr(10)) <> ''""",
)
def chunk_recursive_properties(t: Tables) -> DataFrame:
    """Faults of each document's chunks: above the size, other than the text at their place, not after the chunk before,
    text but white space that no chunk holds, overlaps above the limit."""
    pieces = chunks.chunk_recursive(S.document_sections(t), start="start").select(
        F.col("formId").cast("bigint").alias("doc_id"), "chunkSeqId", "start", (F.col("start") + F.length("text")).alias("end"), F.col("text").alias("piece")
    )
    in_order = Window.partitionBy("doc_id").orderBy("chunkSeqId")
    placed = pieces.withColumns({"before": F.lag("start").over(in_order), "held": F.lag("end").over(in_order), "next": F.lead("start").over(in_order)})
    joined = placed.join(t.documents.select("doc_id", "text"), "doc_id")

    def stretch(begin, end):
        return F.substr("text", begin + 1, F.greatest(end - begin, F.lit(0)))

    lost = F.regexp_like(stretch(F.coalesce("held", F.lit(0)), F.col("start")), F.lit(r"\S"))
    tail = F.col("next").isNull() & F.regexp_like(stretch(F.col("end"), F.length("text")), F.lit(r"\S"))
    faults = (
        F.length("piece") > chunks.CHUNK_SIZE,
        stretch(F.col("start"), F.col("end")) != F.col("piece"),
        F.col("start") <= F.col("before"),
        lost | tail,
        F.col("held") - F.col("start") > chunks.CHUNK_OVERLAP,
    )
    return joined.groupBy("doc_id").agg(*[F.count_if(f).alias(name) for name, f in zip(CHUNK_FAULTS, faults)])
