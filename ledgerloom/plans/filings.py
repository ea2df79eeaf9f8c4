"""Filing lists, identifiers, files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import schemas, session
from ledgerloom.functions import ids, text, values
from ledgerloom.operators import sections
from ledgerloom.plans import standins as S
from ledgerloom.plans.catalog import Tables, plain, query
from ledgerloom.sources import files, filings


@query(
    "csv_roundtrip",
    f"""SELECT CAST(p_partkey AS VARCHAR) AS cik,
               {S.CUSIP6_SQL.format(c=S.part_cusip_sql())} AS cusip6,
               {S.part_cusip_sql()} || ';' || printf('%09d', p_partkey) AS cusip,
               p_brand || ';' || p_name AS names
        FROM part""",
)
def csv_roundtrip(t: Tables) -> DataFrame:
    cusip = S.cusip_of(F.col("p_partkey"))
    mapping = t.part.select(
        F.col("p_partkey").cast("string").alias("cik"),
        ids.cusip6(cusip).alias("cusip6"),
        F.array(cusip, F.format_string("%09d", "p_partkey")).alias("cusip"),
        F.array("p_brand", "p_name").alias("names"),
    )
    path = session.work_folder(t.spark, "csv")
    files.write_csv(mapping, path)
    back = files.read_company_map(t.spark, path)
    return back.withColumns({c: F.array_join(c, ";") for c in ("cusip", "names")})


_Q = S.quarter_slices_sql()


def wide_sections(t: Tables) -> DataFrame:
    first, second, third, fourth = S.quarter_slices(F.col("text"))
    return t.documents.select(
        first.alias("item1"),
        second.alias("item1a"),
        third.alias("item7"),
        fourth.alias("item7a"),
        F.col("doc_id").cast("string").alias("cik"),
        F.substring(S.cusip_of(F.col("doc_id")), 1, 6).alias("cusip6"),
        F.array(S.cusip_of(F.col("doc_id"))).alias("cusip"),
        F.array("lang", "source").alias("names"),
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("source"),
    )


@query(
    "json_roundtrip",
    f"""SELECT {_Q[0]} AS item1, {_Q[1]} AS item1a, {_Q[2]} AS item7, {_Q[3]} AS item7a,
               CAST(doc_id AS VARCHAR) AS cik, substr({S.CUSIP_SQL.format(key="doc_id")}, 1, 6) AS cusip6,
               {S.CUSIP_SQL.format(key="doc_id")} AS cusip, lang || ';' || source AS names,
               source || '/' || doc_id AS source
        FROM documents""",
)
def json_roundtrip(t: Tables) -> DataFrame:
    path = session.work_folder(t.spark, "json")
    files.write_json(wide_sections(t), path)
    back = files.read_json_lines(t.spark, path, schemas.SECTIONS_JSON)
    return back.withColumns({c: F.array_join(c, ";") for c in ("cusip", "names")})


@query(
    "sections_unpivot",
    " UNION ALL ".join(
        f"SELECT CAST(doc_id AS VARCHAR) AS cik, '{item}' AS \"f10kItem\", {part} AS text FROM documents"
        for item, part in zip(sections.ITEMS, _Q)
    ),
)
def sections_unpivot(t: Tables) -> DataFrame:
    return sections.sections_unpivot(wide_sections(t).select("cik", *sections.ITEMS))


FORM_OF = {"F": "10-K", "O": "10-K/A", "P": "8-K"}
FORM_SQL = "CASE o_orderstatus WHEN 'F' THEN '10-K' WHEN 'O' THEN '10-K/A' ELSE '8-K' END"
ACCESSION_SQL = (
    "printf('%010d', o_custkey) || '-' || strftime(o_orderdate, '%y') || '-' || printf('%06d', o_orderkey)"
)


def order_filings(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    status = F.col("o_orderstatus")
    return (t.orders if orders is None else orders).select(
        F.col("o_custkey").cast("string").alias("cik"),
        F.concat_ws(
            "-",
            F.format_string("%010d", "o_custkey"),
            F.date_format("o_orderdate", "yy"),
            F.format_string("%06d", "o_orderkey"),
        ).alias("accessionNumber"),
        F.when(status == "F", "10-K").when(status == "O", "10-K/A").otherwise("8-K").alias("form"),
        F.to_date("o_orderdate").alias("filingDate"),
        "o_orderkey",
    )


@query(
    "filing_history_rows",
    f"""SELECT CAST(o_custkey AS VARCHAR) AS cik, {ACCESSION_SQL} AS "accessionNumber", {FORM_SQL} AS form,
               strftime(o_orderdate, '%Y-%m-%d') AS "filingDate"
        FROM orders""",
)
def filing_history_rows(t: Tables) -> DataFrame:
    # A history page holds one company's filings out of 1000 consecutive order keys, so at most 1000.
    page = F.floor(F.col("o_orderkey") / S.PAGE_KEYS)
    filed = F.struct(
        "accessionNumber", "form", F.date_format("filingDate", "yyyy-MM-dd").alias("filingDate")
    )
    pages = order_filings(t).groupBy("cik", page.alias("page")).agg(F.collect_list(filed).alias("f"))
    recent = F.struct(
        F.col("f.accessionNumber").alias("accessionNumber"),
        F.col("f.form").alias("form"),
        F.col("f.filingDate").alias("filingDate"),
    )
    histories = pages.select("cik", F.struct(recent.alias("recent")).alias("filings"))
    return plain(filings.filing_history_rows(histories))


@query(
    "filing_filter",
    f"""SELECT CAST(o_custkey AS VARCHAR) AS cik, {ACCESSION_SQL} AS "accessionNumber", {FORM_SQL} AS form,
               strftime(o_orderdate, '%Y-%m-%d') AS "filingDate"
        FROM orders
        WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-06-30' AND o_orderstatus = 'F'""",
)
def filing_filter(t: Tables) -> DataFrame:
    # The stored columns carry the range and the form, so that both reach the scan.
    orders = t.orders.filter((F.col("o_orderdate") >= "1996-01-01") & (F.col("o_orderdate") < "1998-07-01"))
    found = order_filings(t, orders.filter(F.col("o_orderstatus") == "F"))
    return plain(filings.annual_reports(found.drop("o_orderkey"), "1996-01-01", "1998-06-30"))


@query(
    "format_filing_url",
    f"""SELECT o_orderkey, 'CIK' || printf('%010d', o_custkey) AS padded_cik,
               '/Archives/edgar/data/' || o_custkey || '/' || replace({ACCESSION_SQL}, '-', '') || '/'
                 || {ACCESSION_SQL} || '.txt' AS url
        FROM orders""",
)
def format_filing_url(t: Tables) -> DataFrame:
    return filings.format_urls(order_filings(t)).select(
        "o_orderkey", ids.padded_cik(F.col("cik")).alias("padded_cik"), "url"
    )


@query(
    "file_id_from_url",
    r"""SELECT page_id, regexp_extract(url, '([^/]*)\.[^./]*$', 1) AS file_id,
               regexp_replace(url, '\.[^.]*$', '-index.htm') AS index_url,
               regexp_extract(url || '/doc_' || page_id || '.txt', '([^/]*)\.[^./]*$', 1) AS doc_file_id
        FROM pages""",
)
def file_id_from_url(t: Tables) -> DataFrame:
    doc = F.concat("url", F.lit("/doc_"), F.col("page_id").cast("string"), F.lit(".txt"))
    return t.pages.select(
        "page_id",
        ids.file_id(F.col("url")).alias("file_id"),
        ids.index_page_url(F.col("url")).alias("index_url"),
        ids.file_id(doc).alias("doc_file_id"),
    )


@query(
    "source_from_filename",
    """SELECT o_orderkey, '_edgar_data_' || o_custkey || '_' || o_orderkey || '.txt' AS file_name,
              'https://sec.gov/edgar/data/' || o_custkey || '/' || o_orderkey || '.txt' AS source
       FROM orders""",
)
def source_from_filename(t: Tables) -> DataFrame:
    path = F.concat_ws(
        "/", F.lit("/edgar/data"), F.col("o_custkey").cast("string"), F.format_string("%d.txt", "o_orderkey")
    )
    named = t.orders.select("o_orderkey", ids.flat_file_name(path).alias("file_name"))
    return named.withColumn("source", ids.source_from_file_name(F.col("file_name")))


@query(
    "daily_index_paths",
    """SELECT strftime(d, '%Y-%m-%d') AS day, '/Archives/edgar/daily-index/' || year(d) || '/QTR' || quarter(d)
              || '/master.' || strftime(d, '%Y%m%d') || '.idx' AS path
       FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d
             FROM (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders))""",
)
def daily_index_paths(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    bounds = t.orders.agg(F.min(day).alias("start_date"), F.max(day).alias("end_date"))
    return plain(filings.daily_index_paths(bounds))


@query(
    "master_index_filter",
    """SELECT '/Archives/edgar/data/' || o_custkey || '/' || o_orderkey || '.txt' AS path
       FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'""",
)
def master_index_filter(t: Tables) -> DataFrame:
    form = F.when(F.col("o_orderstatus") == "F", "13F-HR").when(F.col("o_orderstatus") == "O", "13F-HR/A")
    fields = [
        F.col("o_custkey").cast("string"),
        # A quoted field with a pipe in it for one status, a quote inside a name for the others.
        F.when(F.col("o_orderstatus") == "F", F.lit('"Smith | ""Co"""')).otherwise(F.lit('Smith "Co"')),
        F.coalesce(form, F.lit("10-K")),
        F.date_format("o_orderdate", "yyyyMMdd"),
        F.format_string("edgar/data/%d/%d.txt", "o_custkey", "o_orderkey"),
    ]
    # Header-like lines have a field too few.
    line = F.when(F.col("o_orderpriority") == "5-LOW", F.concat_ws("|", *fields[:4])).otherwise(
        F.concat_ws("|", *fields)
    )
    return filings.index_paths(t.orders.select(line.alias("line")))


@query(
    "parse_list_column",
    """SELECT p_partkey, p_brand || '|' || p_type || '|' || p_name AS parsed,
              '{''' || p_brand || ''', ''' || p_type || '''}' AS rendered FROM part""",
)
def parse_list_column(t: Tables) -> DataFrame:
    cell = F.concat(F.lit("{'"), "p_brand", F.lit("', '"), "p_type", F.lit("',  "), "p_name", F.lit("' }"))
    return t.part.select(
        "p_partkey",
        F.array_join(text.parse_list(F.btrim(cell)), "|").alias("parsed"),
        text.render_list(F.array("p_brand", "p_type")).alias("rendered"),
    )


@query(
    "cusip6",
    f"""SELECT p_partkey, {S.part_cusip_sql()} AS cusip,
               {S.CUSIP6_SQL.format(c=S.part_cusip_sql())} AS cusip6,
               {S.CUSIP6_SQL.format(c="printf('%09d', p_partkey)")} AS padded_cusip6,
               upper(substr(p_name, 1, 6)) AS lettered_cusip6
        FROM part""",
)
def cusip6(t: Tables) -> DataFrame:
    cusip = S.cusip_of(F.col("p_partkey"))
    return t.part.select(
        "p_partkey",
        F.upper(cusip).alias("cusip"),
        ids.cusip6(cusip).alias("cusip6"),
        ids.cusip6(F.format_string("%09d", "p_partkey")).alias("padded_cusip6"),
        ids.cusip6(F.col("p_name")).alias("lettered_cusip6"),
    )


@query(
    "value_scaling",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 1000 AS DOUBLE) AS scaled,
              CAST(l_orderkey AS DOUBLE) * 1000 + l_linenumber AS three_decimals, CAST(NULL AS DOUBLE) AS too_large,
              CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS compat_decimal,
              CAST(l_linenumber * 100 + CAST(l_quantity AS BIGINT) AS DOUBLE) * 1000 AS compat_whole
       FROM lineitem""",
)
def value_scaling(t: Tables) -> DataFrame:
    decimal = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    whole = F.format_string("%d %02d", "l_linenumber", F.col("l_quantity").cast("bigint"))
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        values.scaled_value(decimal).cast("double").alias("scaled"),
        values.scaled_value(F.format_string("%d.%03d", "l_orderkey", "l_linenumber")).cast("double").alias("three_decimals"),
        values.scaled_value(F.format_string("9%030d", "l_orderkey")).cast("double").alias("too_large"),
        values.scaled_value(decimal, compat=True).alias("compat_decimal"),
        values.scaled_value(whole, compat=True).alias("compat_whole"),
    )


@query(
    "company_urls",
    f"""SELECT printf('%010d', p_partkey) AS cik, p_name AS names,
               string_agg('/Archives/edgar/data/' || o_custkey || '/' || replace({ACCESSION_SQL}, '-', '') || '/' || {ACCESSION_SQL}
                 || '.txt', ';' ORDER BY CAST(o_orderdate AS DATE), {ACCESSION_SQL}) AS urls
        FROM part JOIN orders ON p_partkey = o_custkey
        WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-06-30' AND o_orderstatus = 'F'
        GROUP BY ALL""",
)
def company_urls(t: Tables) -> DataFrame:
    companies = t.part.select(F.format_string("%010d", "p_partkey").alias("cik"), F.col("p_name").alias("names"))
    found = filings.company_urls(companies, order_filings(t).drop("o_orderkey"), "1996-01-01", "1998-06-30")
    return found.select("cik", "names", F.array_join("form10KUrls", ";").alias("urls"))


@query(
    "ordered_sample",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""",
)
def ordered_sample(t: Tables) -> DataFrame:
    listed = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", (-F.col("o_totalprice")).alias("least"))
    return filings.preview(listed, 5, "least", "o_orderkey").drop("least")


# Two URLs, one or none per order, by its status.
@query(
    "explode_urls",
    f"""SELECT o_orderkey, {ACCESSION_SQL} || s AS "form10KUrls"
        FROM orders JOIN (VALUES ('F', '.txt'), ('F', '-index.htm'), ('O', '.txt')) v(st, s) ON o_orderstatus = st""",
)
def explode_urls(t: Tables) -> DataFrame:
    a = F.col("accessionNumber")
    text_url, page_url = F.concat(a, F.lit(".txt")), F.concat(a, F.lit("-index.htm"))
    urls = (
        F.when(F.col("form") == "10-K", F.array(text_url, page_url))
        .when(F.col("form") == "10-K/A", F.array(text_url))
        .otherwise(F.array().cast("array<string>"))
    )
    return filings.explode_urls(order_filings(t).select("o_orderkey", urls.alias("form10KUrls")))


@query(
    "url_listing",
    f"""WITH {S.ALL_COMPANIES_SQL} SELECT cik, cusip6, "form10KUrls", names, cusip FROM c""",
)
def url_listing(t: Tables) -> DataFrame:
    wrapped = S.companies(t, listed_only=False).withColumns(
        {c: text.render_list(F.array(c)) for c in ("names", "cusip")}
    )
    parsed = wrapped.withColumns({c: text.parse_list(F.col(c)) for c in ("names", "cusip")})
    return filings.listing(parsed).withColumns({c: F.array_join(c, ";") for c in ("names", "cusip")})


# Every document as a landed file: German ones have another ending, French ones of an odd size a byte that is no UTF-8.
LANDED_FAULT_SQL = "CASE WHEN coalesce(text, '') = '' AND NOT bad THEN 'empty file' WHEN bad THEN 'not UTF-8' END"


@query(
    "raw_files_roundtrip",
    f"""WITH d AS (SELECT *, coalesce(lang = 'fr' AND n_chars % 2 = 1, false) AS bad FROM documents WHERE lang IS DISTINCT FROM 'de')
        SELECT '_docs_' || doc_id || '.txt' AS file_name, {LANDED_FAULT_SQL} AS reason,
               CASE WHEN {LANDED_FAULT_SQL} IS NULL THEN md5(regexp_replace(text, '\r\n?', chr(10), 'g')) END AS md5 FROM d""",
)
def raw_files_roundtrip(t: Tables) -> DataFrame:
    """Files whose names begin with ``_``, written and read by the tasks, with the reason of those that cannot be read."""
    bad = F.coalesce((F.col("lang") == "fr") & (F.col("n_chars") % 2 == 1), F.lit(False))
    ending = F.when(F.col("lang") == "de", ".csv").otherwise(".txt")
    content = F.coalesce("text", F.lit("")).cast("binary")
    landed = t.documents.select(
        F.concat(F.lit("_docs_"), F.col("doc_id").cast("string"), ending).alias("file_name"),
        F.when(bad, F.concat(content, F.unhex(F.lit("FF")))).otherwise(content).alias("content"),
    )
    path = session.work_folder(t.spark, "landed")
    files.write_raw_files(landed, path)
    return files.landed_files(t.spark, path).select("file_name", "reason", F.md5(F.col("raw").cast("binary")).alias("md5"))
