"""Holdings: XML, roll-up, periods, and the overlap with companies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import session
from ledgerloom.functions.bind import computed_once
from ledgerloom.operators import holdings, link
from ledgerloom.plans import standins as S
from ledgerloom.plans.catalog import Tables, dealt, plain, query
from ledgerloom.sources import files

PERIODS = 4


def stock_lines(t: Tables) -> DataFrame:
    """View H."""
    return holdings.security_filter(S.holding_lines(t), S.STOCK_TYPE, S.STOCK_WORDS).drop("title", "shareType")


def rolled_up(t: Tables) -> DataFrame:
    return holdings.rollup(stock_lines(t))


@query(
    "security_filter",
    f"""SELECT * REPLACE (CAST(value AS DOUBLE) AS value,
               CAST("reportCalendarOrQuarter" AS VARCHAR) AS "reportCalendarOrQuarter") FROM ({S.LINES_SQL}) WHERE {S.STOCK_SQL}""",
)
def security_filter(t: Tables) -> DataFrame:
    return plain(holdings.security_filter(S.holding_lines(t), S.STOCK_TYPE, S.STOCK_WORDS))


@query("holdings_rollup", f"WITH {S.ROLLUP_SQL} SELECT * FROM r")
def holdings_rollup(t: Tables) -> DataFrame:
    return plain(rolled_up(t))


@query(
    "period_counts",
    f"""WITH {S.ROLLUP_SQL} SELECT "reportCalendarOrQuarter", count(value) AS rows FROM r GROUP BY 1 ORDER BY 1""",
)
def period_counts(t: Tables) -> DataFrame:
    return plain(holdings.period_counts(rolled_up(t)))


@query(
    "top_periods",
    f"""WITH {S.ROLLUP_SQL} SELECT * FROM r WHERE "reportCalendarOrQuarter" IN
        (SELECT DISTINCT "reportCalendarOrQuarter" FROM r ORDER BY 1 DESC LIMIT {PERIODS})""",
)
def top_periods(t: Tables) -> DataFrame:
    # A roll-up keeps the period in its keys, so recent periods can be picked before it.
    return plain(holdings.rollup(holdings.top_periods(stock_lines(t), PERIODS)))


@query(
    "tenk_with_holdings",
    f"""WITH {S.ROLLUP_SQL}, {S.COMPANIES_SQL}
        SELECT cusip6, cik, names, cusip, "form10KUrls" FROM c WHERE cusip6 IN (SELECT cusip6 FROM r)
        QUALIFY row_number() OVER (PARTITION BY cusip6 ORDER BY "form10KUrls") = 1""",
)
def tenk_with_holdings(t: Tables) -> DataFrame:
    # Only which prefixes are held matters, so the lines do as well as their roll-up.
    return link.companies_with_holdings(S.companies(t), stock_lines(t))


ORDER_SQL = 'source, "managerCik", "managerAddress", "managerName", "reportCalendarOrQuarter", r.cusip6, r.cusip'


@query(
    "holdings_with_tenk",
    f"""WITH {S.ROLLUP_SQL}, {S.COMPANIES_SQL}
        SELECT r.* FROM r JOIN c USING (cusip6)
        QUALIFY row_number() OVER (PARTITION BY "managerCik", cik ORDER BY {ORDER_SQL}) = 1""",
)
def holdings_with_tenk(t: Tables) -> DataFrame:
    return plain(link.holdings_with_companies(S.companies(t), rolled_up(t)))


@query(
    "join_funnel",
    f"""WITH {S.ROLLUP_SQL}, {S.COMPANIES_SQL}, l AS (SELECT c.cusip6, "managerCik" FROM c LEFT JOIN r USING (cusip6)),
        g AS (SELECT "managerCik", cik FROM c RIGHT JOIN r USING (cusip6)),
        s AS (SELECT (SELECT count(*) FROM c) AS companies, (SELECT count(*) FROM r) AS holdings,
          (SELECT count(*) FROM l) AS left_joined, (SELECT count("managerCik") FROM l) AS left_filtered,
          (SELECT count(DISTINCT cusip6) FROM l WHERE "managerCik" IS NOT NULL) AS left_deduped,
          (SELECT count(*) FROM g) AS right_joined, (SELECT count(cik) FROM g) AS right_filtered,
          (SELECT count(*) FROM (SELECT DISTINCT "managerCik", cik FROM g WHERE cik IS NOT NULL)) AS right_deduped)
        SELECT step, rows FROM (UNPIVOT (SELECT *, left_filtered - left_deduped AS left_removed,
          right_filtered - right_deduped AS right_removed FROM s) ON COLUMNS(*) INTO NAME step VALUE rows)""",
)
def join_funnel(t: Tables) -> DataFrame:
    return link.join_funnel(S.companies(t), rolled_up(t))


# One submission per lineitem row, with two reported lines for the same security: the row itself as a
# share, and a second one whose type depends on the line status. Rows with line number 7 are cut off in
# the middle, rows with line number 6 report shares with decimals, rows with line number 5 have a third line
# that lacks a part.
BROKEN_LINE, DECIMAL_LINE, LACKING_LINE = 7, 6, 5
LACKING = ("titleOfClass", "sshPrnamtType", "cusip")
LACKING_SQL = "CASE l_partkey % 3 WHEN 0 THEN 'no title' WHEN 1 THEN 'no share type' ELSE 'no cusip' END"


def submissions(t: Tables) -> DataFrame:
    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    def line(name, title, value, shares, share_type, lacking=None):
        def part(tag, value):
            whole = text(f"<n1:{tag}>", value, f"</n1:{tag}>")
            return whole if lacking is None or tag not in LACKING else F.when(lacking == tag, "").otherwise(whole)

        return text(
            "<n1:infoTable>", part("nameOfIssuer", name), part("titleOfClass", title), part("cusip", F.col("_cusip")),
            part("value", value), "<n1:shrsOrPrnAmt>", part("sshPrnamt", shares), part("sshPrnamtType", share_type),
            "</n1:shrsOrPrnAmt></n1:infoTable>",
        )

    suppkey, quantity = F.col("_suppkey"), F.col("_quantity")
    cover = text(
        '<XML>\n<?xml version="1.0"?><edgarSubmission xmlns="http://example.org/f"><headerData><filerInfo><filer>'
        "<credentials><cik>", suppkey, "</cik></credentials></filer></filerInfo></headerData><formData><coverPage>"
        "<reportCalendarOrQuarter>", F.date_format(F.trunc("l_shipdate", "quarter"), "MM-dd-yyyy"),
        "</reportCalendarOrQuarter><filingManager><name>Manager ", suppkey, "</name><address><street1>Suite ", suppkey,
        "</street1><city>Springfield</city></address></filingManager></coverPage></formData></edgarSubmission>\n</XML>\n",
    )
    # Which part the third line lacks depends on the row.
    lacking = F.element_at(F.array(*map(F.lit, LACKING)), (F.col("l_partkey") % len(LACKING)).cast("int") + 1)
    table = text(
        '<XML>\n<n1:informationTable xmlns:n1="http://example.org/t">',
        line(
            F.col("p_name"),
            "COM",
            F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
            F.when(F.col("l_linenumber") == DECIMAL_LINE, F.concat(quantity, F.lit(".5"))).otherwise(quantity),
            "SH",
        ),
        line(
            F.concat(F.lit("A "), F.col("p_name")),  # less than the first line's name, and not the first
            F.when(F.col("l_returnflag") == "N", "NOTE").otherwise("CL A"),
            F.concat(F.lit("1 "), F.lpad(quantity, 3, "0")),
            F.col("l_linenumber").cast("string"),
            F.when(F.col("l_linestatus") == "F", "SH").otherwise("PRN"),
        ),
        F.when(F.col("l_linenumber") == LACKING_LINE, line(F.col("p_name"), "COM", "1", "1", "SH", lacking)).otherwise(""),
        "</n1:informationTable>\n</XML>\n",
    )
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
        "l_shipdate", "p_name",
    )
    # Values that stand in the text more than once, and the text itself, are made once.
    named = computed_once(
        dealt(lines, t.lineitem.count()),
        _cusip=S.cusip_of(F.col("l_partkey")),
        _suppkey=F.col("l_suppkey").cast("string"),
        _quantity=F.col("l_quantity").cast("bigint").cast("string"),
    )
    whole = computed_once(named, _whole=text("<SEC-DOCUMENT>\n", cover, table))
    cut = F.substr("_whole", F.lit(1), F.length("_whole") - 60)
    raw = F.when(F.col("l_linenumber") == BROKEN_LINE, cut).otherwise(F.col("_whole"))
    return whole.select(F.format_string("_edgar_%d_%d.txt", "l_orderkey", "l_linenumber").alias("file_name"), raw.alias("raw"))


_XML_LINES_SQL = f"""x AS (
SELECT l_orderkey, l_suppkey, l_partkey, l_shipdate, p_name, l_linenumber, 0 AS line,
       CAST(l_extendedprice AS DECIMAL(18,2)) * 1000 AS value, CAST(l_quantity AS BIGINT) AS shares
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_linenumber NOT IN ({BROKEN_LINE}, {DECIMAL_LINE})
UNION ALL
SELECT l_orderkey, l_suppkey, l_partkey, l_shipdate, 'A ' || p_name, l_linenumber, 1,
       (1000 + CAST(l_quantity AS BIGINT)) * 1000, l_linenumber
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_linenumber <> {BROKEN_LINE} AND l_linestatus = 'F' AND l_returnflag <> 'N')"""


@query(
    "holdings_from_xml",
    f"""WITH {_XML_LINES_SQL}
    SELECT 'https://sec.gov/edgar/' || l_orderkey || '/' || l_linenumber || '.txt' AS source, CAST(l_suppkey AS VARCHAR) AS "managerCik",
           'Suite ' || l_suppkey || ', Springfield' AS "managerAddress", 'Manager ' || l_suppkey AS "managerName",
           CAST(CAST(date_trunc('quarter', l_shipdate) AS DATE) AS VARCHAR) AS "reportCalendarOrQuarter",
           {S.CUSIP6_SQL.format(c=S.CUSIP_SQL.format(key="l_partkey"))} AS cusip6,
           {S.CUSIP_SQL.format(key="l_partkey")} AS cusip, arg_min(p_name, line) AS "companyName",
           CAST(sum(value) AS DOUBLE) AS value, CAST(sum(shares) AS BIGINT) AS shares
    FROM x GROUP BY l_orderkey, l_linenumber, l_suppkey, l_partkey, date_trunc('quarter', l_shipdate)""",
)
def holdings_from_xml(t: Tables) -> DataFrame:
    """The name is that of the first line of the file that has one. A file is one row, so nothing is shuffled after the parse."""
    return plain(holdings.rollup_filings(submissions(t)))


@query(
    "parse_failures",
    f"""SELECT file, stage, reason, count(*) AS rows FROM (
          SELECT '_edgar_' || l_orderkey || '_' || l_linenumber || '.txt' AS file,
                 CASE l_linenumber WHEN {BROKEN_LINE} THEN 'parse' ELSE 'types' END AS stage,
                 CASE l_linenumber WHEN {BROKEN_LINE} THEN 'broken information table' ELSE 'bad shares' END AS reason
          FROM lineitem JOIN part ON l_partkey = p_partkey
          WHERE l_linenumber IN ({BROKEN_LINE}, {DECIMAL_LINE})
          UNION ALL
          SELECT '_edgar_' || l_orderkey || '_' || l_linenumber || '.txt', 'types', {LACKING_SQL}
          FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber = {LACKING_LINE}) GROUP BY ALL""",
)
def parse_failures(t: Tables) -> DataFrame:
    return holdings.parse_failures(submissions(t)).groupBy("file", "stage", "reason").agg(F.count("*").alias("rows"))


@query("holdings_csv", f"WITH {S.ROLLUP_SQL} SELECT * FROM r")
def holdings_csv(t: Tables) -> DataFrame:
    """The roll-up written as CSV and read again on its declared schema."""
    path = session.work_folder(t.spark, "holdings")
    files.write_csv(rolled_up(t), path)
    return plain(files.read_holdings(t.spark, path))


def flagship(t: Tables) -> DataFrame:
    """Roll-up over the most recent periods, kept for managers of listed companies."""
    recent = holdings.rollup(holdings.top_periods(stock_lines(t), PERIODS))
    return plain(link.holdings_with_companies(S.companies(t), recent))


@query(
    "recent_holdings_of_companies",
    f"""WITH {S.ROLLUP_SQL}, {S.COMPANIES_SQL}, p AS (SELECT * FROM r WHERE "reportCalendarOrQuarter" IN
          (SELECT DISTINCT "reportCalendarOrQuarter" FROM r ORDER BY 1 DESC LIMIT {PERIODS}))
        SELECT r.* FROM p AS r JOIN c USING (cusip6)
        QUALIFY row_number() OVER (PARTITION BY "managerCik", cik ORDER BY {ORDER_SQL}) = 1""",
)
def recent_holdings_of_companies(t: Tables) -> DataFrame:
    return flagship(t)
