"""Annual reports: main document, four sections, quarantine.

Each filing is one row and all splitting happens inside the row with array expressions, so the raw text
is never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import ids, markup
from ledgerloom.functions.bind import computed_once, let

# The form type, the items that make up a report, the header pattern and the literal
# that is removed from the text. The pattern's two halves stand apart because only one of them needs a look-behind.
MAIN_TYPE = "10-K"
ITEMS = ("item1", "item1a", "item7", "item7a")
TAG_HEADER = r">(?:Item|ITEM)(?:\s|&#160;|&nbsp;)(?:1A|1B|1\.|7A|7|8)\.{0,1}"
PLAIN_HEADER = r"ITEM\s(?:1A|1B|1\.|7A|7|8)"
BOOKMARK_ERROR = "Error! Bookmark not defined."

# A plain header right after ">" is already part of a tag header. (?U) lets \s match every space character.
BEFORE_HEADER = rf"(?U)(?={TAG_HEADER})|(?=(?<!>){PLAIN_HEADER})"
HEADER_AT_START = rf"(?U)^(?:{TAG_HEADER}|{PLAIN_HEADER})"


def main_document(raw: DataFrame, doc_type: str = MAIN_TYPE) -> DataFrame:
    """Adds ``document``: the first embedded document of that exact type, null if there is none.

    Type and text come from the same embedded document.
    """
    # What stands before the first <DOCUMENT> is no document.
    wanted = F.filter(
        F.split("raw", "<DOCUMENT>"),
        lambda d, i: (i > 0)
        & F.contains(d, F.lit("</DOCUMENT>"))
        & (F.regexp_extract(F.substring_index(d, "</DOCUMENT>", 1), r"<TYPE>([^\n]+)", 1) == doc_type),
    )
    body = F.substring_index(F.get(wanted, F.lit(0)), "</DOCUMENT>", 1)
    return computed_once(raw, document=body)


def _header_name(header: Column) -> Column:
    """Other white space stays, so such a header names no item but still ends the section before it."""
    spaced = F.replace(F.replace(F.lower(header), F.lit("&#160;"), F.lit(" ")), F.lit("&nbsp;"), F.lit(" "))
    return F.translate(spaced, " .>", "")


def _split_sections(document: Column) -> Column:
    """Array of (item, start, end, text) for the last header of every name, in document order."""

    def sections(pieces: Column) -> Column:
        names = F.transform(pieces, lambda p: _header_name(F.regexp_extract(p, HEADER_AT_START, 0)))
        lengths = F.transform(pieces, F.length)
        starts = F.aggregate(
            lengths,
            F.array(F.lit(0)),
            lambda acc, n: F.array_append(acc, F.element_at(acc, -1) + n),
        )
        return let(F.struct(names.alias("names"), starts.alias("starts")), lambda x: _cut(pieces, x))

    def _cut(pieces: Column, x: Column) -> Column:
        count = F.size(pieces)
        distinct = F.array_distinct(F.filter(x["names"], lambda n: n != ""))
        last = F.array_sort(
            F.transform(distinct, lambda n: count - F.array_position(F.reverse(x["names"]), n).cast("int"))
        )

        def one(kept: Column) -> Column:
            return F.transform(
                kept,
                lambda begin, i: F.struct(
                    F.get(x["names"], begin).alias("item"),
                    F.get(x["starts"], begin).alias("start"),
                    F.get(x["starts"], F.coalesce(F.get(kept, i + 1), count)).alias("end"),
                    F.array_join(
                        F.slice(pieces, begin + 1, F.coalesce(F.get(kept, i + 1), count) - begin), ""
                    ).alias("text"),
                ),
            )

        return let(last, one)

    return let(F.split(document, BEFORE_HEADER), sections)


def section_bounds(documents: DataFrame) -> DataFrame:
    """One row per kept header: its start and the start of the next one, or the document's end."""
    parts = _split_sections(F.col("document"))
    return documents.select(
        *[c for c in documents.columns if c not in ("document", "raw")], F.explode(parts).alias("s")
    ).selectExpr("* EXCEPT (s)", "s.item AS item", "s.start AS start", "s.end AS sectionEnd")


def _report_parts(documents: DataFrame) -> DataFrame:
    """Adds the found items and ``reason``, which is null for a report that has all four."""
    parts = F.filter(_split_sections(F.col("document")), lambda s: s["item"].isin(*ITEMS))
    found = computed_once(
        documents, _parts=F.transform(parts, lambda s: F.struct(s["item"].alias("item"), s["text"].alias("text")))
    )
    reason = (
        F.when(F.col("document").isNull(), "no main document")
        .when(F.size("_parts") == 0, "no section header")
        .when(F.size("_parts") < len(ITEMS), "missing item")
    )
    return found.withColumn("reason", reason)


def sections(documents: DataFrame, exact_markup: bool = False, compat: bool = False) -> DataFrame:
    """Complete reports as one row per item: the other columns, item, text.

    ``compat`` keeps the ``>`` of the tag in front of the header.
    """
    carried = [c for c in documents.columns if c not in ("document", "raw")]
    rows = (
        _report_parts(documents)
        .filter(F.col("reason").isNull())
        .select(*carried, F.explode("_parts").alias("s"))
        .select(*carried, "s.item", F.replace("s.text", F.lit(BOOKMARK_ERROR), F.lit("")).alias("text"))
    )
    body = F.col("text") if compat else F.regexp_replace("text", "^>", "")
    clean = markup.html_to_text_exact(body) if exact_markup else markup.html_to_text(body)
    return rows.withColumn("text", clean)


def section_failures(documents: DataFrame) -> DataFrame:
    """Quarantine: reports without a main document, without headers or with an item missing."""
    carried = [c for c in documents.columns if c not in ("document", "raw")]
    return _report_parts(documents).filter(F.col("reason").isNotNull()).select(*carried, "reason")


def sections_wide(long: DataFrame, keys: list[str]) -> DataFrame:
    """One row per report with a column per item, as the cleaned JSON files have it."""
    picks = [F.max(F.when(F.col("item") == item, F.col("text"))).alias(item) for item in ITEMS]
    return long.groupBy(*keys).agg(*picks)


def report_rows(long: DataFrame, urls: DataFrame) -> DataFrame:
    """One row per report as the cleaned JSON files have it: its items, and its company's ids from the URL list.

    ``long`` has file_name, item and text; ``urls`` has cik, cusip6, cusip, names and one form10KUrls a row. The two
    meet on the file id. Reports without a URL and URLs without a report drop out; source is the index page.
    """
    wide = sections_wide(long.withColumn("_file", ids.file_id(F.concat(F.lit("/"), "file_name"))), ["_file"])
    listed = urls.select(
        ids.file_id(F.col("form10KUrls")).alias("_file"),
        "cik",
        "cusip6",
        "cusip",
        "names",
        ids.index_page_url(F.col("form10KUrls")).alias("source"),
    )
    return wide.join(listed, "_file").drop("_file")


def sections_unpivot(wide: DataFrame) -> DataFrame:
    """A column per item -> one row per item."""
    keys = [c for c in wide.columns if c not in ITEMS]
    return wide.unpivot(keys, list(ITEMS), "f10kItem", "text")
