import html
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import ids, markup, text, values


@pytest.fixture()
def one(spark):
    """Value of an expression over one text value."""

    def get(build, value):
        frame = spark.createDataFrame([(value,)], "x string")
        return frame.select(build(F.col("x")).alias("y")).first()[0]

    return get


@pytest.mark.parametrize(
    "cell,want",
    [
        ("{'a', 'b'}", ["a", "b"]),
        ("{'x'}", ["x"]),
        ("{}", [""]),
        ("", [""]),
        ("{'O'Neil', 'b c'}", ["O'Neil", "b c"]),
    ],
)
def test_parse_list(one, cell, want):
    assert one(text.parse_list, cell) == want


def test_lists_survive_a_round_trip(one):
    assert one(lambda c: text.render_list(text.parse_list(c)), "{'a', 'b'}") == "{'a', 'b'}"


@pytest.mark.parametrize("value", ["o'neil", "AT&T", "3m", "élan vital", "x1y2", "", "JOHN McDONALD", "a-b_c"])
def test_title_case_is_pythons(one, value):
    assert one(text.title_case, value) == value.title()


@pytest.mark.parametrize("value", ["RiskFactor", "person", "", "ORGANIZATION unit"])
def test_capitalise_is_pythons(one, value):
    assert one(text.capitalise, value) == value.capitalize()


@pytest.mark.parametrize(
    "key,want",
    [
        ("birth date", "birthDate"),
        ("birthDate", "birthdate"),
        ("  Birth\tDATE  of ", "birthDateOf"),
        ("", ""),
        ("  ", "  "),
    ],
)
def test_camel_key(one, key, want):
    assert one(text.camel_key, key) == want


def test_property_map_keeps_the_last_duplicate(spark):
    kind = "array<struct<key: string, value: string>>"
    frame = spark.createDataFrame([([("birth date", "1"), ("Birth Date", "2"), ("x", "3")],), (None,)], f"p {kind}")
    got = [r[0] for r in frame.select(text.property_map(F.col("p"))).collect()]
    assert got == [{"birthDate": "2", "x": "3"}, {}]


@pytest.mark.parametrize(
    "cusip,want",
    [("037833100", "037833"), ("000378331", "003783"), ("g1234567x", "G12345"), ("000000000", "000000"), ("12", "12")],
)
def test_cusip6(one, cusip, want):
    assert one(ids.cusip6, cusip) == want


def test_ids_and_urls(one):
    assert one(ids.padded_cik, "320193") == "CIK0000320193"
    assert one(ids.padded_cik, "12345678901234") == "CIK12345678901234"
    url = one(lambda c: ids.filing_url("https://x", c, F.lit("0000320193-22-000108")), "0000320193")
    assert url == "https://x/Archives/edgar/data/320193/000032019322000108/0000320193-22-000108.txt"
    assert one(ids.file_id, url) == "0000320193-22-000108"
    assert one(ids.index_page_url, url).endswith("/0000320193-22-000108-index.htm")
    assert one(ids.file_id, "http://a.b/c") == ""
    path = "/Archives/edgar/data/1/2.txt"
    assert one(ids.flat_file_name, path) == "_Archives_edgar_data_1_2.txt"
    assert one(lambda c: ids.source_from_file_name(ids.flat_file_name(c)), path) == "https://sec.gov" + path
    assert one(lambda c: ids.chunk_id(c, F.lit("item1"), F.lit(12345)), "f") == "f-item1-chunk12345"


def test_scaled_values(one):
    assert one(lambda c: values.scaled_value(c).cast("double"), "12.5") == 12500.0
    assert one(lambda c: values.scaled_value(c, compat=True), "12.5") == 12.5
    assert one(lambda c: values.scaled_value(c, compat=True), "1 234") == 1234000.0
    assert one(lambda c: values.scaled_value(c, compat=True), "1e5") == float("inf")
    assert one(values.scaled_value, "n/a") is None


def test_periods_in_both_formats(one):
    assert str(one(values.parse_period, "12-31-2022")) == "2022-12-31"
    assert str(one(values.parse_period, "2022-12-31")) == "2022-12-31"
    assert one(values.parse_period, "31/12/2022") is None


@pytest.mark.parametrize(
    "page,want",
    [
        ("<p>a</p><p>b</p>", "a\nb"),
        ("a<!-- c -->b", "a\nb"),
        ("<script>x<y</script>t<style>q</style>", "t"),
        ("<p>a</p>\n<p>b</p>", "a\n\n\nb"),
        ("x &amp; y &#8217; &#x41; &unknown; &eacute;", "x & y ’ A &unknown; é"),
        ("&amp;lt;", "&lt;"),
        ("1 < 2 and <b>3</b>", "1 < 2 and \n3"),
        ("cut off <h2", "cut off "),
        ("\nfirst line", "\nfirst line"),
        ("", ""),
    ],
)
def test_html_to_text(one, page, want):
    assert one(markup.html_to_text, page) == want
    assert one(markup.html_to_text_exact, page) == want


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab&;#x1amp lt<>", max_size=30), min_size=50, max_size=50))
def test_known_references_decode_as_in_html(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "x string")
    safe = [t for t in texts if all(m in ("&amp;", "&lt;") for m in re.findall(r"&[#A-Za-z0-9]+;?", t))]
    got = dict(frame.select("x", markup.decode_entities(F.col("x"))).collect())
    assert all(got[t] == html.unescape(t) for t in safe)


def test_very_long_runs_of_tags(one):
    assert one(markup.html_to_text, "a" + "<td></td>" * 200_000 + "b") == "a\nb"
    assert one(markup.html_to_text, "<script>" * 300 + "x") == "x"


def test_newlines(one):
    assert one(text.unix_newlines, "a\r\nb\rc\n") == "a\nb\nc\n"


@pytest.mark.parametrize("text,want", [("12.345", 12345), ("0.0005", 0.5), ("1 234", 1234000), ("99999999999999999", 99999999999999999000), ("9" * 23, None), ("x", None), ("", None)])
def test_amounts_of_any_size_scale_or_give_null(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(values.scaled_value(F.col("t")).alias("v")).first().v
    assert (None if got is None else float(got)) == (None if want is None else float(want))


@pytest.mark.parametrize(
    "text",
    ["&#146;", "&#x92;", "&#00000000065;", "A&nbsp B", "&ampx", "&notit;", "&copy2", "&#65", "&#0;", "&#xD800;", "&#99999999999;", "&#x1;", "&#127;", "&#129;", "&unknown;", "&unknown", "&", "&;", "&#;", "&#x;", "&#xFFFF;", "&AMP;", "&gt", "&#13;"],
)
def test_references_are_read_as_in_html(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(markup.decode_entities(F.col("t")).alias("v")).first().v
    assert got == html.unescape(text)
