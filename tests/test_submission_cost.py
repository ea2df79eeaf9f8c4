"""Submissions are made by tasks of bounded size, and what is cut off is told without the parser, with what it gives."""

import datetime

import pytest
from pyspark.sql import functions as F
from test_plain_xml import COVER, LINE, ODD, PLAIN, TABLE

from ledgerloom import schemas
from ledgerloom.functions import plain_xml
from ledgerloom.operators import holdings
from ledgerloom.plans import catalog
from ledgerloom.plans import holdings as plan
from ledgerloom.plans.catalog import Tables

MANY = TABLE.replace(LINE, LINE * 2000, 1)


def parsed_by_spark_alone(raw):
    """Both blocks of every submission, all read by the parser."""

    def read(n, schema):
        block = F.get(F.split(F.get(F.split("raw", "<XML>"), F.lit(n)), "</XML>", 2), F.lit(0))
        return F.from_xml(F.btrim(block, F.lit(" \t\r\n")), schema, holdings.XML_OPTIONS)

    return raw.select("file_name", read(1, schemas.COVER_XML).alias("cover"), read(2, schemas.TABLE_XML).alias("holdings"))


def same_as_the_parser(spark, rows, texts):
    raw = spark.createDataFrame([(str(n), text) for n, text in enumerate(texts)], "file_name string, raw string").cache()
    got, want = (rows(f, "file_name", "cover", "holdings") for f in (holdings.parse_submissions(raw), parsed_by_spark_alone(raw)))
    assert got == want and len(got) == len(texts)


def test_a_text_cut_anywhere_gives_what_the_parser_gives(spark, rows):
    whole = f"<A>\n<XML>\n{COVER}\n</XML>\n<XML>\n{TABLE}\n</XML>\n"
    same_as_the_parser(spark, rows, [whole[:n] for n in range(len(whole) + 1)])


def test_blocks_in_any_order_give_what_the_parser_gives(spark, rows):
    parts = ["", "x", "<XML>", "</XML>", "<XML>", "<B></XML", "\x01\x03"]
    texts = [f"{a}{b}{doc}{c}{d}{table}{a}{d}" for a in parts for b in parts[:3] for c in parts for d in parts[:5] for doc, table in ((COVER, TABLE), (TABLE, COVER))]
    odd = [f"<XML>{c}</XML><XML>{t}</XML>{end}" for c in (COVER, COVER.replace("M 7", "M &amp; 7"), COVER[:-9], "") for t in {**PLAIN, **ODD}.values() for end in ("", "<XML>x")]
    root = TABLE.replace("n:informationTable", "XML").replace(' xmlns:n="http://example.org/t"', "")
    forged = "\x01".join(["n:", "t", *"abcdef", "n:", "", *"ghijkl", "n:", "t", *[""] * 7])
    same_as_the_parser(spark, rows, [*texts, *odd, root, f"<XML>{COVER}</XML><XML>{root}", forged, f"<XML>{COVER}</XML>{forged}", f"{COVER}</XML>{TABLE}</XML>", None])


def test_long_tables(spark, rows):
    same_as_the_parser(spark, rows, [f"{'<B>' * 9000}<XML>{COVER}</XML><XML>{t}</XML>" for t in (MANY, MANY[:-9], MANY.replace("A B", "A & B", 1))])


def test_cut_texts_need_no_parser(spark):
    begun = TABLE.index("<n:infoTable>")
    cut = [*[(TABLE[:n], True) for n in range(begun, len(TABLE))], (TABLE, False), ("", False), (TABLE[:9], False), (TABLE.replace("A B", "<x>"), False)]
    frame = spark.createDataFrame(cut, "raw string, cut boolean")
    assert frame.filter(plain_xml.never_closed(F.col("raw")) != F.col("cut")).count() == 0


@pytest.fixture()
def tables(spark, tmp_path):
    day = datetime.datetime(1995, 5, 17)
    lines = [(n // 7, 1 if n % 10 else n, n % 3, n % 7 + 1, float(n % 50), 100.0 + n / 4, "NAR"[n % 3], "FO"[n % 2], day) for n in range(1000)]
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(lines, columns).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(1000).select(F.col("id").alias("p_partkey"), F.lit("red ring").alias("p_name")).write.parquet(f"{tmp_path}/part.parquet")
    return Tables(spark, str(tmp_path))


def test_submissions_are_made_by_tasks_of_bounded_size_also_under_one_part(spark, tables, monkeypatch):
    monkeypatch.setattr(catalog, "TASK_ROWS", 50)
    sizes = [r["count"] for r in plan.submissions(tables).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1000 and len(sizes) == 20 and max(sizes) <= 75


def test_submissions_have_the_lines_that_their_row_asks_for(tables, rows):
    made = plan.submissions(tables).filter(F.col("file_name").rlike("_edgar_[0-9]_"))
    raw = {r.file_name: r.raw for r in made.collect()}
    third = "<n1:infoTable><n1:nameOfIssuer>red ring</n1:nameOfIssuer>{}</n1:infoTable></n1:informationTable>\n</XML>\n"
    # Row 4 has part 1, whose third line lacks the share type; row 60 has part 60, whose third line would lack the title.
    lacking = "<n1:titleOfClass>COM</n1:titleOfClass><n1:cusip>007919993</n1:cusip><n1:value>1</n1:value><n1:shrsOrPrnAmt><n1:sshPrnamt>1</n1:sshPrnamt></n1:shrsOrPrnAmt>"
    assert raw["_edgar_0_5.txt"].endswith(third.format(lacking)) and raw["_edgar_0_5.txt"].count("infoTable>") == 6
    assert "<n1:sshPrnamt>5.5</n1:sshPrnamt>" in raw["_edgar_0_6.txt"] and raw["_edgar_0_6.txt"].count("infoTable>") == 4
    assert raw["_edgar_0_7.txt"].endswith("<n1:sshPrnamtType>SH</n1:sshPrnamtType></n")
