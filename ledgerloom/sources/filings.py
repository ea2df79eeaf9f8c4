"""Filing lists: histories, the daily index, the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import ids, values

ANNUAL_REPORT = "10-K"
HOLDINGS_REPORT = "13F-HR"
INDEX_FIELDS = 5


def filing_history_rows(histories: DataFrame) -> DataFrame:
    """Parallel arrays -> one row per filing. A company without history gives no rows."""
    recent = "filings.recent"
    return histories.select(
        "cik",
        F.inline(
            F.arrays_zip(
                F.col(f"{recent}.accessionNumber").alias("accessionNumber"),
                F.col(f"{recent}.form").alias("form"),
                F.col(f"{recent}.filingDate").alias("filingDate"),
            )
        ),
    ).withColumn("filingDate", F.to_date("filingDate", "yyyy-MM-dd"))


def annual_reports(filings: DataFrame, start: str, end: str, form: str = ANNUAL_REPORT) -> DataFrame:
    """Filings of one exact form type, both dates inclusive."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    return filings.filter(F.col("filingDate").between(first, last) & (F.col("form") == form))


def company_urls(
    companies: DataFrame, filings: DataFrame, start: str, end: str, base: str = "", form: str = ANNUAL_REPORT
) -> DataFrame:
    """The company map with ``form10KUrls``, the URLs of a company's reports in a range of dates, oldest first.

    Companies and filings meet on the number that their cik is, whatever zeros lead it. Companies without a report drop
    out. A company files a report a year, so its list is short.
    """
    found = format_urls(annual_reports(filings, start, end, form), base)
    number = F.col("cik").try_cast("bigint").alias("_number")
    dated = F.struct("filingDate", "accessionNumber", "url")
    urls = found.groupBy(number).agg(F.transform(F.array_sort(F.collect_list(dated)), lambda f: f["url"]).alias("form10KUrls"))
    return companies.withColumn("_number", F.col("cik").try_cast("bigint")).join(urls, "_number").drop("_number")


def explode_urls(companies: DataFrame, column: str = "form10KUrls") -> DataFrame:
    """One row per URL; companies with no URL drop out."""
    return companies.filter(F.size(column) > 0).withColumn(column, F.explode(column))


def pipe_fields(line: Column) -> Column:
    """Fields of one pipe-delimited line. A field that begins with a quote may hold pipes."""
    quoted = F.regexp_extract_all(line, F.lit(r'(?:^|\|)("(?:[^"]|"")*+"|[^|]*)'), F.lit(1))
    unquoted = F.transform(
        quoted,
        lambda f: F.when(
            f.startswith('"') & f.endswith('"') & (F.length(f) > 1),
            F.replace(F.substr(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(f),
    )
    return F.when(line.rlike(r'(^|\|)"'), unquoted).otherwise(F.split(line, r"\|", -1))


def index_paths(lines: DataFrame, form: str = HOLDINGS_REPORT) -> DataFrame:
    """Archive paths of one exact form type; lines without five fields are headers."""
    fields = lines.select(pipe_fields(F.col("line")).alias("f"))
    return fields.filter((F.size("f") == INDEX_FIELDS) & (F.get("f", F.lit(2)) == form)).select(
        F.concat(F.lit("/Archives/"), F.get("f", F.lit(4))).alias("path")
    )


def calendar(bounds: DataFrame) -> DataFrame:
    """Every day from ``end_date`` back to ``start_date``, both inclusive."""
    days = F.when(
        F.col("end_date") >= F.col("start_date"), F.sequence("end_date", "start_date", F.expr("INTERVAL -1 DAY"))
    )
    return bounds.select(F.explode(days).alias("day"))


def daily_index_paths(bounds: DataFrame) -> DataFrame:
    return calendar(bounds).select("day", values.index_path(F.col("day")).alias("path"))


def listing(companies: DataFrame) -> DataFrame:
    """Readable listing of the URL list."""
    return companies.select("cik", "cusip6", "form10KUrls", "names", "cusip")


def preview(frame: DataFrame, rows: int = 5, *order_by: str) -> DataFrame:
    return frame.orderBy(*order_by).limit(rows) if order_by else frame.limit(rows)


def format_urls(filings: DataFrame, base: str = "") -> DataFrame:
    return filings.withColumn("url", ids.filing_url(base, F.col("cik"), F.col("accessionNumber")))
