import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import holdings, link
from ledgerloom.sources import files
from ledgerloom.streaming import incremental


def line(cusip="037833100", title="COM", value="1 234", shares="10", kind="SH", name="APPLE INC", ns=""):
    return (
        f"<{ns}infoTable><{ns}nameOfIssuer>{name}</{ns}nameOfIssuer><{ns}titleOfClass>{title}</{ns}titleOfClass>"
        f"<{ns}cusip>{cusip}</{ns}cusip><{ns}value>{value}</{ns}value><{ns}shrsOrPrnAmt><{ns}sshPrnamt>{shares}"
        f"</{ns}sshPrnamt><{ns}sshPrnamtType>{kind}</{ns}sshPrnamtType></{ns}shrsOrPrnAmt></{ns}infoTable>"
    )


def submission(*lines, address="<c:street1>1 Main St</c:street1><c:city>X</c:city><c:zipCode>9</c:zipCode>", ns="", period="12-31-2022"):
    xmlns = f' xmlns:{ns[:-1]}="http://example.org/t"' if ns else ""
    return f"""<SEC-DOCUMENT>
<XML>
<?xml version="1.0" encoding="UTF-8"?>
<edgarSubmission xmlns="http://example.org/f" xmlns:c="http://www.sec.gov/edgar/common">
<headerData><filerInfo><filer><credentials><cik>0001</cik></credentials></filer></filerInfo></headerData>
<formData><coverPage><reportCalendarOrQuarter>{period}</reportCalendarOrQuarter>
<filingManager><name>Big &amp; Co</name><address>{address}</address></filingManager></coverPage></formData>
</edgarSubmission>
</XML>
<XML>
<{ns}informationTable{xmlns}>{"".join(lines)}</{ns}informationTable>
</XML>
"""


@pytest.fixture()
def raw(spark, tmp_path):
    contents = {
        "Archives_1.txt": submission(
            line(), line(value="1"), line(kind="PRN"), line(title="NOTE"), line(title="com"), line(title="CL A", cusip="000378331")
        ),
        "Archives_2.txt": submission(line(cusip="g1234567x", ns="n1:"), ns="n1:", address="<c:street1>2</c:street1><c:city/>"),
        "Archives_3.txt": submission(line())[:-40],
        "Archives_4.txt": "<XML>".join(submission(line()).split("<XML>")[:2]),
        "Archives_5.txt": submission(line(shares="12.0"), line(value="n/a")),
        "Archives_6.txt": "",
        "Archives_7.txt": submission(line(cusip="000000000"), period="2023-03-31"),
        "ignored.csv": submission(line()),
    }
    for name, content in contents.items():
        (tmp_path / name).write_text(content)
    return files.read_raw_files(spark, str(tmp_path))


def test_parse_filter_and_roll_up(raw, rows):
    parsed = holdings.holdings_from_xml(raw)
    rolled = holdings.rollup(parsed)
    got = rows(rolled.withColumn("value", F.col("value").cast("double")), "source", "managerCik", "managerAddress", "managerName", F.col("reportCalendarOrQuarter").cast("string"), "cusip6", "cusip", "value", "shares")
    main = ("0001", "1 Main St, X, 9", "Big & Co")
    assert got == sorted(
        [
            ("https://sec.gov/Archives/1.txt", *main, "2022-12-31", "003783", "000378331", 1234000.0, 10),
            ("https://sec.gov/Archives/1.txt", *main, "2022-12-31", "037833", "037833100", 1235000.0, 20),
            ("https://sec.gov/Archives/2.txt", "0001", got[2][2], "Big & Co", "2022-12-31", "G12345", "G1234567X", 1234000.0, 10),
            ("https://sec.gov/Archives/7.txt", *main, "2023-03-31", "000000", "000000000", 1234000.0, 10),
        ],
        key=repr,
    )
    assert got[2][2].startswith("2")


def test_zero_security_is_kept_unless_asked(raw):
    lines = holdings.holding_lines(holdings.parse_submissions(raw))
    assert holdings.security_filter(lines).filter("cusip = '000000000'").count() == 1
    assert holdings.security_filter(lines, drop_zero_cusip=True).filter("cusip = '000000000'").count() == 0


def test_empty_files_are_reported(raw, spark, tmp_path, rows):
    assert rows(files.empty_files(spark, str(tmp_path))) == [("Archives_6.txt", "parse", "empty file")]


def test_failures_name_file_stage_and_reason(raw, rows):
    assert rows(holdings.parse_failures(raw)) == [
        ("Archives_3.txt", "parse", "broken information table"),
        ("Archives_4.txt", "parse", "no information table"),
        ("Archives_5.txt", "types", "bad shares"),
        ("Archives_5.txt", "types", "bad value"),
    ]


KEYS = list(holdings.ROLLUP_KEYS)


def frame(spark, records):
    schema = "source string, managerCik string, managerAddress string, managerName string, reportCalendarOrQuarter date, cusip6 string, cusip string, companyName string, value double, shares bigint, pos int"
    fixed = [(*r[:4], pd.Timestamp(r[4]).date() if r[4] else None, *r[5:], i) for i, r in enumerate(records)]
    return spark.createDataFrame(fixed, schema)


RECORDS = [
    ("s1", "m1", "a", "n", "2022-03-31", "c1", "c1x", None, 1.0, 1),
    ("s1", "m1", "a", "n", "2022-03-31", "c1", "c1x", "Zed", 2.0, 2),
    ("s1", "m1", "a", "n", "2022-03-31", "c1", "c1x", "Abe", 3.0, 3),
    ("s2", "m1", "a", "n", "2022-06-30", "c1", "c1x", "Zed", 4.0, 4),
    ("s3", "m2", "a", "n", "2022-09-30", "c2", "c2x", "Two", 5.0, 5),
    ("s3", "m2", None, "n", "2022-09-30", "c2", "c2x", "Two", 6.0, 6),
    ("s4", "m3", "a", "n", "2022-12-31", None, "c9x", "Nine", 7.0, 7),
]


def test_rollup_sums_and_takes_the_first_name(spark, rows):
    got = rows(holdings.rollup(frame(spark, RECORDS), ("pos",)), "source", "managerCik", "cusip", "companyName", "value", "shares")
    # The first row of s1 has no name and the third a lesser one; rows with a null key are gone.
    assert got == [
        ("s1", "m1", "c1x", "Zed", 6.0, 6),
        ("s2", "m1", "c1x", "Zed", 4.0, 4),
        ("s3", "m2", "c2x", "Two", 5.0, 5),
    ]


def test_periods(spark, rows):
    lines = frame(spark, RECORDS)
    assert [r.rows for r in holdings.period_counts(lines).collect()] == [3, 1, 2, 1]
    # The newest period has nothing but a row without a prefix, so it is none of the two.
    assert {str(r[0]) for r in holdings.top_periods(lines, 2).select("reportCalendarOrQuarter").collect()} == {"2022-06-30", "2022-09-30"}
    assert holdings.top_periods(lines, 99).count() == len(RECORDS) - 2
    with pytest.raises(ValueError):
        holdings.top_periods(lines, 0)


COMPANIES = [
    ("c1", "1", "one", "c1x", "u2"),
    ("c1", "1", "one", "c1x", "u1"),
    ("c1", "11", "other", "c1y", "u3"),
    ("c2", "2", "two", "c2x", "u4"),
    ("c5", "5", "five", "c5x", "u5"),
    (None, "6", "six", "c6x", "u6"),
]


def test_companies_that_are_held(spark, rows):
    companies = spark.createDataFrame(COMPANIES, "cusip6 string, cik string, names string, cusip string, form10KUrls string")
    lines = frame(spark, RECORDS).drop("pos")
    # One company per prefix, the one with the least URL; a null prefix meets nothing unless asked.
    held = [("c1", "1", "one", "c1x", "u1"), ("c2", "2", "two", "c2x", "u4")]
    assert rows(link.companies_with_holdings(companies, lines)) == held
    assert rows(link.companies_with_holdings(companies, lines, compat=True)) == sorted([*held, (None, "6", "six", "c6x", "u6")], key=repr)


def test_holdings_of_companies(spark, rows):
    companies = spark.createDataFrame(COMPANIES, "cusip6 string, cik string, names string, cusip string, form10KUrls string")
    lines = frame(spark, RECORDS).drop("pos")
    columns = ("source", "managerCik", "cusip6", "cusip", "value")
    got = rows(link.holdings_with_companies(companies, lines), *columns)
    # One row per manager and company: m1 holds companies 1 and 11, m2 holds company 2.
    assert [r[:4] for r in got] == [("s1", "m1", "c1", "c1x"), ("s1", "m1", "c1", "c1x"), ("s3", "m2", "c2", "c2x")]
    steps = dict(link.join_funnel(companies, lines).collect())
    assert steps["companies"] == 6 and steps["holdings"] == 7
    # Three companies of c1 meet four lines, one of c2 meets two.
    assert steps["left_filtered"] == steps["right_filtered"] == 14
    assert steps["left_deduped"] == 2 and steps["left_removed"] == 12
    assert steps["right_deduped"] == 3 and steps["right_removed"] == 11


def test_no_line_is_lost(spark):
    part = {"titleOfClass": "no title", "sshPrnamtType": "no share type", "cusip": "no cusip"}
    files_of = {f"{tag}.txt": submission(re.sub(f"<{tag}>[^<]*</{tag}>", "", line())) for tag in part}
    files_of["cik.txt"] = submission(line()).replace("<cik>0001</cik>", "")
    files_of["mixed.txt"] = submission(line(), line(kind="PRN"), line(value="9" * 30), line(value="12.345"))
    raw = spark.createDataFrame(list(files_of.items()), "file_name string, raw string")
    failures = {(r.file, r.reason) for r in holdings.parse_failures(raw).collect()}
    want = {(f"{tag}.txt", reason) for tag, reason in part.items()} | {("cik.txt", "no manager"), ("mixed.txt", "bad value")}
    assert failures == want
    kept = holdings.holdings_from_xml(raw)
    assert sorted(float(r.value) for r in kept.collect()) == [12345.0, 1234000.0]
    lines = holdings.holding_lines(holdings.parse_submissions(raw)).count()
    assert kept.count() + len(failures) + 1 == lines  # one is no share


def test_keep_first_limits_before_the_shuffle(spark):
    plan = link.keep_first(frame(spark, RECORDS), ["cusip6"], ["pos"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_files_that_arrive_later_add_up(spark, tmp_path, rows):
    landing, store, checkpoint = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "cp")
    landing.mkdir()

    def run():
        arriving = holdings.holdings_from_xml(incremental.stream_raw_files(spark, str(landing)))
        incremental.start_rollup(arriving, store, checkpoint).awaitTermination()

    (landing / "a_1.txt").write_text(submission(line(), line()))
    run()
    (landing / "a_2.txt").write_text(submission(line(value="5")))
    run()
    run()
    whole = holdings.rollup(holdings.holdings_from_xml(files.read_raw_files(spark, str(landing))))
    columns = [c for c in whole.columns if c != "value"] + [F.col("value").cast("double")]
    assert rows(incremental.read_rollup(spark, store), *columns) == rows(whole, *columns)
    assert whole.count() == 2


def test_roll_up_in_the_row_equals_the_one_over_lines(spark, raw, rows, tmp_path_factory):
    import random

    choose = random.Random(3)
    lines = [
        line(
            cusip=choose.choice(["037833100", "g1234567x", "G1234567X", "000378331", "000000000"]), value=choose.choice(["1", "2 500", "0.125", "n/a"]),
            shares=choose.choice(["1", "7", "1.5"]), kind=choose.choice(["SH", "SH", "PRN"]), name=choose.choice(["B", "A", "C"]),
        )
        for _ in range(300)
    ]
    folder = tmp_path_factory.mktemp("many")
    (folder / "many_1.txt").write_text(submission(*lines))
    (folder / "many_2.txt").write_text(submission(line(title="NOTE")))
    many = files.read_raw_files(spark, str(folder))
    for settings in ({}, {"compat": True}, {"drop_zero_cusip": True}):
        for frame in (raw, many):
            want = holdings.rollup(holdings.holdings_from_xml(frame, **settings), ("line",))
            got = holdings.rollup_filings(frame, **settings)
            assert got.schema.simpleString() == want.schema.simpleString()
            assert rows(got) == rows(want) != []
    assert holdings.rollup_filings(many.limit(0)).count() == 0


def test_nothing_is_shuffled_between_parse_and_roll_up(raw):
    assert "Exchange" not in holdings.rollup_filings(raw)._jdf.queryExecution().executedPlan().toString()
