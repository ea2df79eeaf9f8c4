import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators import chunks, sections
from ledgerloom.operators.recursive_split import split_spans, split_text
from ledgerloom.sources import files

BODY = (
    "<TYPE>10-K\n<html>"
    "<p>Item 1.</p><p>Item 1A.</p><p>Item 7.</p><p>Item 7A.</p><p>Item 8.</p>"
    "<b>Item 1. Business</b><p>We make tools. Error! Bookmark not defined.</p>"
    "<b>ITEM&#160;1A. Risks</b><p>Many.</p><b>Item 1B</b><p>none</p>"
    "<b>Item&nbsp;7. Discussion</b><p>Good &amp; bad.</p>"
    "\nITEM 7A Market\n<p>Rates.</p>"
    "<b>Item 8. Statements</b></html>\n"
)


def bundle(body, kind=None):
    main = body if kind is None else body.replace("<TYPE>10-K\n", f"<TYPE>{kind}\n")
    return f"<HEAD>\n<DOCUMENT>\n<TYPE>EX-99\nItem 1. not this\n</DOCUMENT>\n<DOCUMENT>{main}</DOCUMENT>\n<DOCUMENT><TYPE>10-K\nsecond</DOCUMENT>"


@pytest.fixture()
def raw(spark, tmp_path):
    contents = {
        "good.txt": bundle(BODY),
        "crlf.txt": bundle(BODY).replace("\n", "\r\n"),
        "other.txt": "<DOCUMENT><TYPE>10-K405\nItem 1.</DOCUMENT>",
        "noheader.txt": "<DOCUMENT><TYPE>10-K\nplain text</DOCUMENT>",
        "missing.txt": bundle(BODY.replace("ITEM 7A", "ITEM 9A").replace("<p>Item 7A.</p>", "")),
        "newline.txt": bundle(BODY.replace("<b>Item 1. Business", "<b>Item\n1. Business").replace("<p>Item 1.</p>", "")),
    }
    for name, text in contents.items():
        (tmp_path / name).write_bytes(text.encode())
    return files.read_raw_files(spark, str(tmp_path))


def test_main_document_is_the_first_of_its_type(raw):
    got = dict(sections.main_document(raw).select("file_name", "document").collect())
    assert got["good.txt"] == BODY and got["crlf.txt"] == BODY and got["other.txt"] is None


def test_section_text(raw, rows):
    got = sections.sections(sections.main_document(raw))
    good = [r[1:] for r in rows(got, "file_name", "item", "text") if r[0] == "good.txt"]
    assert good == [
        ("item1", "Item 1. Business\nWe make tools. "),
        ("item1a", "ITEM\u00a01A. Risks\nMany."),
        ("item7", "Item\u00a07. Discussion\nGood & bad.\n\n"),
        ("item7a", "ITEM 7A Market\n\nRates."),
    ]
    exact = sections.sections(sections.main_document(raw), exact_markup=True)
    assert rows(exact, "file_name", "item", "text") == rows(got, "file_name", "item", "text")
    compat = sections.sections(sections.main_document(raw), compat=True).filter("item = 'item1'").first()
    assert compat.text.startswith(">Item 1.")


def test_incomplete_reports_are_quarantined(raw, rows):
    assert rows(sections.section_failures(sections.main_document(raw)), "file_name", "reason") == [
        ("missing.txt", "missing item"),
        ("newline.txt", "missing item"),
        ("noheader.txt", "no section header"),
        ("other.txt", "no main document"),
    ]


HEADERS = [">Item 1.", ">ITEM 1A", ">Item&#160;7.", ">item 7", "ITEM 7A", "ITEM 8", ">Item\n1B", ">ITEM&nbsp;7A.", "ITEM  8", ">Item 1"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from([*HEADERS, "x", " text ", "\n", "é", "𝒳", "<b", "."]), max_size=25), min_size=40, max_size=40))
def test_bounds_follow_each_other(spark, documents):
    texts = ["".join(d) for d in documents]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, document string")
    got = {}
    for r in sections.section_bounds(frame).collect():
        got.setdefault(r.id, []).append((r.start, r.sectionEnd, r.item))
    for n, text in enumerate(texts):
        bounds = sorted(got.get(n, []))
        # Each name once; a section ends where the next begins, the last at the end of the text.
        assert len({item for _, _, item in bounds}) == len(bounds)
        assert [end for _, end, _ in bounds] == [start for start, _, _ in bounds[1:]] + [len(text)] * bool(bounds)
        for start, _, item in bounds:
            assert text[start:].lstrip(">").lower().startswith("item")
            # No later header of the same plain form is left inside.
            assert "ITEM 8" not in text[start + 1 :] or item != "item8" or text.rindex("ITEM 8") <= start + 1


@pytest.mark.parametrize(
    "text,want",
    [
        ("no header", []),
        (">Item 1. a>Item 1. b", [("item1", 10, 20)]),
        ("x>Item 7. a>ITEM&nbsp;7A. b", [("item7", 1, 11), ("item7a", 11, 27)]),
        (">Item&#160;1A. é>Item 7 𝒳 ITEM 8", [("item1a", 0, 16), ("item7", 16, 26), ("item8", 26, 32)]),
        (">item 7>Item 8 and >Item 7.", [("item8", 7, 19), ("item7", 19, 27)]),
    ],
)
def test_bounds_of_written_cases(spark, text, want):
    found = sections.section_bounds(spark.createDataFrame([(text,)], "document string")).collect()
    assert sorted(((r.item, r.start, r.sectionEnd) for r in found), key=lambda x: x[1]) == want


def test_wide_and_long_are_inverse(spark, rows):
    wide = spark.createDataFrame([("f", "a", "b", "c", "d")], "formId string, item1 string, item1a string, item7 string, item7a string")
    long = sections.sections_unpivot(wide)
    assert rows(long)[0] == ("f", "item1", "a")
    back = sections.sections_wide(long.withColumnRenamed("f10kItem", "item"), ["formId"])
    assert rows(back) == rows(wide)


def section_frame(spark, texts):
    data = [(f"f{i}", "item1", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "formId string, f10kItem string, text string")


def brute_fixed(text, size, overlap):
    if not text:
        return []
    stride = size - overlap
    count = 1 + max(0, -(-(len(text) - size) // stride))
    return [text[i * stride : i * stride + size] for i in range(count)]


@pytest.mark.parametrize("size,overlap", [(2000, 200), (10, 3), (10, 7), (10, 0), (3, 2)])
def test_fixed_chunks(spark, size, overlap):
    texts = ["", "a", "ab\n" * (size * 3), "x" * size, "y" * (size + 1), "é𝒳" * size, "z" * (size * 2 - overlap)]
    got = {}
    for r in chunks.chunk_fixed(section_frame(spark, texts), size, overlap).orderBy("formId", "chunkSeqId").collect():
        assert r.chunkId == f"{r.formId}-item1-chunk{r.chunkSeqId:04d}"
        got.setdefault(r.formId, []).append(r.text)
    assert [got.get(f"f{i}", []) for i in range(len(texts))] == [brute_fixed(t, size, overlap) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n", max_size=300), st.integers(5, 40), st.integers(0, 4))
def test_recursive_pieces_fit_and_lose_no_word(text, size, overlap):
    got = split_text(text, size, overlap, ["\n\n", "\n", " ", ""])
    assert all(0 < len(c) <= size and c == c.strip() for c in got)
    at = 0
    for c in got:
        # Every piece is a stretch of the text, and each begins after the one before began.
        at = text.index(c, at)
    assert set("".join(got)) - set(" \n") == set(text) - set(" \n")


def test_recursive_pieces_prefer_paragraphs_and_overlap():
    text = "aaa bbb\n\nccc ddd\n\neee"
    assert split_text(text, 10, 0, ["\n\n", "\n", " ", ""]) == ["aaa bbb", "ccc ddd", "eee"]
    assert split_text("one two three four", 9, 4, ["\n\n", "\n", " ", ""]) == ["one two", "three", "four"]
    assert split_text("one two six ten", 11, 4, ["\n\n", "\n", " ", ""]) == ["one two six", "six ten"]
    assert split_text("abcdefghij", 4, 2, [""]) == ["abcd", "cdef", "efgh", "ghij"]


def test_recursive_chunks_run_in_batches(spark):
    texts = ["word " * 1000, "para\n\n" * 900, ""]
    got = chunks.chunk_recursive(section_frame(spark, texts)).collect()
    want = [c for t in texts for c in split_text(t, 2000, 200, list(chunks.SEPARATORS))]
    assert sorted(r.text for r in got) == sorted(want) and max(len(r.text) for r in got) <= 2000


def test_recursive_chunks_say_where_they_begin(spark):
    text = "é one two\n\nthree  " + "x" * 30 + " four"
    got = chunks.chunk_recursive(section_frame(spark, [text]), 10, 3, start="start").orderBy("chunkSeqId").collect()
    assert [text[r.start : r.start + len(r.text)] for r in got] == [r.text for r in got]
    assert [r.start for r in got] == sorted(r.start for r in got) and got[0].start == 0


def test_a_word_of_millions_of_letters_is_cut_by_arithmetic():
    spans = split_spans("x" * 5_000_000, 2000, 200, chunks.SEPARATORS)
    assert spans[:2] == [(0, 2000), (1800, 3800)] and spans[-1][1] == 5_000_000
