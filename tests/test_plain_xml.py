"""Plain submissions are read by patterns, all others by the parser, with the same values."""

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions import plain_xml
from ledgerloom.operators import holdings

COVER = (
    '<?xml version="1.0"?>\n<edgarSubmission xmlns="http://example.org/f"><headerData><filerInfo><filer><credentials><cik>7</cik>'
    "</credentials></filer></filerInfo></headerData><formData><coverPage><reportCalendarOrQuarter>03-31-2023</reportCalendarOrQuarter>"
    "<filingManager><name>M 7</name><address><street1>Suite 7</street1><city>Springfield</city></address></filingManager>"
    "</coverPage></formData></edgarSubmission>"
)
LINE = (
    "<n:infoTable>\n <n:nameOfIssuer>A B</n:nameOfIssuer><n:titleOfClass>COM</n:titleOfClass><n:cusip>00012345a</n:cusip><n:value>5</n:value>"
    "<n:shrsOrPrnAmt><n:sshPrnamt>3</n:sshPrnamt><n:sshPrnamtType>SH</n:sshPrnamtType></n:shrsOrPrnAmt></n:infoTable>\n"
)
TABLE = '<n:informationTable xmlns:n="http://example.org/t">\n' + LINE + LINE.replace("<n:titleOfClass>COM</n:titleOfClass>", "") + "</n:informationTable>"
PLAIN = {"whole": TABLE, "declared": '<?xml version="1.0" encoding="UTF-8"?>\n' + TABLE, "no prefix": TABLE.replace("n:", "")}
ODD = {
    "cut": TABLE[:-30], "reference": TABLE.replace("A B", "A &amp; B"), "bare ampersand": TABLE.replace("A B", "A & B"),
    "comment": TABLE.replace("<n:cusip>", "<!-- x --><n:cusip>", 1), "cdata": TABLE.replace("A B", "<![CDATA[A <B]]>"),
    "text between": TABLE.replace(LINE, LINE + "x", 1), "unclosed": TABLE.replace("</n:cusip>", "", 1), "twice": TABLE.replace("<n:cusip>", "<n:cusip>9</n:cusip><n:cusip>", 1),
    "empty": TABLE.replace("A B", ""), "blanks": TABLE.replace("A B", " A B "), "letters": TABLE.replace("A B", "Ärzte"), "no lines": '<informationTable xmlns="u"></informationTable>',
    "other order": TABLE.replace("<n:value>5</n:value>", "", 1).replace("<n:nameOfIssuer>", "<n:value>5</n:value><n:nameOfIssuer>", 1),
    "other prefix": TABLE.replace(LINE, LINE.replace("n:", "m:"), 1), "root twice": TABLE + TABLE, "mark": TABLE.replace("A B", "\x02n:\x01>x\x03"),
    "attribute twice": TABLE.replace(' xmlns:n="', ' xmlns:n="u" xmlns:n="', 1), "no text": "", "wrong end": TABLE.replace("</n:informationTable>", "</n:table>"),
}


@pytest.fixture(scope="module")
def read(spark):
    texts = [(name, text) for name, text in {**PLAIN, **ODD}.items()]
    frame = spark.createDataFrame(texts, "name string, raw string")
    both = plain_xml.read_plain(frame.withColumn("cover", F.lit(COVER)), "cover", "raw", "c", "t")
    both = both.withColumn("xml", F.from_xml("raw", schemas.TABLE_XML, holdings.XML_OPTIONS))
    return {r.name: r for r in both.withColumn("cx", F.from_xml("cover", schemas.COVER_XML, holdings.XML_OPTIONS)).collect()}


def test_plain_texts_give_what_the_parser_gives(read):
    for name in PLAIN:
        assert read[name].t == read[name].xml and len(read[name].t.infoTable) == 2, name
        assert read[name].c == read[name].cx and read[name].c.headerData.filerInfo.filer.credentials.cik == "7"


def test_other_texts_are_left_to_the_parser(read):
    for name in ODD:
        assert read[name].t is None, name


def test_odd_tables_keep_their_reason(spark):
    raw = [(f"{n}.txt", f"<XML>{COVER}</XML><XML>{t}</XML>") for n, t in {**PLAIN, **ODD}.items()]
    frame = holdings.parse_submissions(spark.createDataFrame(raw, "file_name string, raw string"))
    reasons = {r.file_name[:-4]: r.reason for r in frame.select("file_name", "reason").collect()}
    assert {reasons[n] for n in PLAIN} == {None} and reasons["reference"] is None and reasons["comment"] is None
    assert reasons["cut"] == reasons["bare ampersand"] == reasons["unclosed"] == "broken information table"


def test_securities_are_folded_once(spark):
    raw = spark.createDataFrame([("a.txt", "x")], "file_name string, raw string")
    plan = holdings.rollup_filings(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_sort(") == 1
