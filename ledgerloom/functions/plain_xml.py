"""Submissions in plain XML, read by one pattern for each of their two documents.

``from_xml`` sets up a parser for every document, which costs many times what reading a short one does. Most submissions
are written by form software: known elements in the order of the form, printable ASCII without references, comments or
attributes below the root. The patterns hold exactly those and give the values that the parser gives. Every other text,
well-formed or not, fits none and is left to the parser.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.bind import computed_once

# Texts that fit have no control characters, so one of them ends every part of a result.
PART = "\x01"


def _chars(chars: str) -> str:
    """A class that lists its characters: one lookup each, where ranges are tried one after the other."""
    return "[" + "".join(c if c.isalnum() else "\\" + c for c in chars) + "]"


_PRINTED = "".join(map(chr, range(0x21, 0x7F)))
_LETTERS = "".join(c for c in _PRINTED if c.isalpha())
_TEXT = "".join(c for c in _PRINTED if c not in "<>&")
WS = r"[ \t\r\n]*+"
NAME = f"{_chars(_LETTERS + '_')}{_chars(_LETTERS + '0123456789_.-')}*+"
# A value without white space at its ends, which the parser would trim. The long pattern is compared for every row, so values
# that nobody reads have the short one.
VALUE = f"(?! ){_chars(_TEXT + ' ')}++(?<! )"
PASSED = "(?! )[ -%'-;=?-~]++(?<! )"
QUOTED = '(?:"' + _chars(_TEXT.replace('"', "")) + "++\"|'" + _chars(_TEXT.replace("'", "")) + "++')"
DECLARATION = r'(?:<\?xml version="1\.0"(?: encoding="(?:UTF-8|utf-8)")?(?: standalone="(?:yes|no)")?\?>[ \t\r\n]*+)?+'
ADDRESS = ("street1", "street2", "city", "stateOrCountry", "zipCode")
LINE = ("nameOfIssuer", "titleOfClass", "cusip", "value", "sshPrnamt", "sshPrnamtType")


def _opening() -> str:
    """Start of a document. The root may declare name spaces, each once; ``p`` is its own prefix with the colon, or empty."""
    attribute = rf"(?:[ \t\r\n]++(?<attribute>xmlns(?::{NAME})?+)={QUOTED}(?![^<>]*[ \t\r\n]\k<attribute>=))*+"
    prefix = rf"(?<p>(?:(?<prefix>{NAME}):(?=[^<>]*[ \t\r\n]xmlns:\k<prefix>=))?+)"
    return rf"{WS}{DECLARATION}<(?!XML>){prefix}(?<root>{NAME}){attribute}{WS}>{WS}"


CLOSING = rf"</\k<p>\k<root>>{WS}\z"


def _leaf(name: str, group: str = "", prefix: str = r"\k<p>") -> str:
    """An element with a value of at least one character, or none."""
    value = f"(?<{group}>{VALUE})" if group else PASSED
    return rf"(?:<{prefix}{name}>{value}</{prefix}{name}>{WS})?+"


def _leaves(*names: str, prefix: str = r"\k<p>") -> str:
    leaves = "".join(_leaf(name, prefix=prefix) for name in names)
    return f"(?:(?!</){leaves})?+"


def _nest(name: str, body: str, prefix: str = r"\k<p>") -> str:
    """An element that holds others, at least one."""
    return rf"<{prefix}{name}>{WS}(?!</){body}</{prefix}{name}>{WS}"


def _cover() -> str:
    credentials = _nest("credentials", _leaf("cik", "cik") + _leaves("ccc"))
    flags = _nest("flags", _leaves("confirmingCopyFlag", "returnCopyFlag", "overrideInternetFlag"))
    filer = _nest("filer", credentials + _leaves("fileNumber"))
    filer_info = _nest("filerInfo", _leaves("liveTestFlag") + f"(?:{flags})?+" + filer + _leaves("periodOfReport"))
    manager = _nest("filingManager", _leaf("name", "manager") + _nest("address", "".join(_leaf(a, a) for a in ADDRESS)))
    page = _leaf("reportCalendarOrQuarter", "period") + _leaves("isAmendment", "amendmentNo") + manager
    page += _leaves("reportType", "form13FFileNumber", "crdNumber", "secFileNumber", "provideInfoForInstruction5")
    signed = _nest("signatureBlock", _leaves("name", "title", "phone", "signature", "city", "stateOrCountry", "signatureDate"))
    totals = _nest("summaryPage", _leaves("otherIncludedManagersCount", "tableEntryTotal", "tableValueTotal", "isConfidentialOmitted"))
    form = _nest("formData", _nest("coverPage", page) + f"(?:{signed})?+(?:{totals})?+")
    header = _nest("headerData", _leaves("submissionType") + filer_info)
    return _opening() + _leaves("schemaVersion") + header + form + CLOSING


def _line() -> str:
    own = r"\k<own>"
    shares = _nest("shrsOrPrnAmt", "".join(_leaf(n, n, own) for n in LINE[4:]), own)
    parts = "".join(_leaf(n, n, own) for n in LINE[:3]) + _leaves("figi", prefix=own) + _leaf("value", "value", own) + shares
    votes = _nest("votingAuthority", _leaves("Sole", "Shared", "None", prefix=own), own)
    parts += _leaves("putCall", "investmentDiscretion", "otherManager", prefix=own) + f"(?:{votes})?+"
    return rf"<(?<own>(?:{NAME}:)?+)infoTable>{WS}{parts}</{own}infoTable>{WS}"


# Text up to the first mark, which is no root, and any text. The patterns have ``@`` where a mark may be asked for.
MARK, OTHER = "(?:[^<]++|<(?!XML>))*+<XML>", "(?s:.++)"
# Each pattern leaves nothing of a text but the groups of its matches, so no part of a result is the text's own.
COVER, COVER_GROUPS = rf"\A(?:@{_cover()}|{OTHER})", ("root", "cik", "period", "manager", *ADDRESS)
# One match for the start of a table, each line and the end, every one from where the one before ended.
CLOSE = rf"</(?<end>(?:{NAME}:)?+)(?<closed>{NAME})>{WS}\z"
TABLE = rf"\A(?:@{_opening()}|{OTHER})|\G(?!\A)(?:{_line()}|{CLOSE}|{OTHER})"
TABLE_GROUPS = ("p own end", "root closed", *LINE)
# The name of a root without an end tag behind its start: a parser meets the end of the text, or something worse before.
UNCLOSED = rf"\A{_opening()}(?:[^<]++|<(?!/\k<p>\k<root>[ \t\r\n>]))*+\z"


def _value(parts: Column, n: int) -> Column:
    """The value of a group, null if its element was not there."""
    return F.nullif(F.get(parts, F.lit(n)), F.lit(""))


def _cover_of(parts: Column) -> Column:
    none = F.array().cast("array<string>")
    at = {name: _value(parts, n) for n, name in enumerate(COVER_GROUPS)}
    # Without a lambda, so that code is generated for it.
    present = lambda values: F.flatten(F.array(*[F.when(at[a].isNotNull(), F.array(values(a))).otherwise(none) for a in ADDRESS]))
    address = F.map_from_arrays(present(F.lit), present(at.get))
    filer = F.struct(F.struct(at["cik"].alias("cik")).alias("credentials")).alias("filer")
    manager = F.struct(at["manager"].alias("name"), address.alias("address"))
    page = F.struct(at["period"].alias("reportCalendarOrQuarter"), manager.alias("filingManager"))
    return F.struct(
        F.struct(F.struct(filer).alias("filerInfo")).alias("headerData"),
        F.struct(page.alias("coverPage")).alias("formData"),
        F.lit(None).cast("string").alias("_corrupt_record"),
    )


def _line_of(parts: Column, first: Column) -> Column:
    at = {name: F.nullif(F.get(parts, first + (n + 2)), F.lit("")) for n, name in enumerate(LINE)}
    shares = F.struct(*[at[name].alias(name) for name in LINE[4:]])
    return F.struct(*[at[name].alias(name) for name in LINE[:4]], shares.alias("shrsOrPrnAmt"))


def _groups(pattern: str, fields: tuple[str, ...]) -> str:
    """A replacement of groups by number; all groups have names. A field is one group, or several of which one is there."""
    order = re.findall(r"\(\?<(\w+)>", pattern)
    return "".join("".join(f"${order.index(name) + 1}" for name in field.split()) + PART for field in fields)


def never_closed(document: Column) -> Column:
    """True for a text that begins as a plain document whose root is not closed, which no parser takes for XML."""
    return F.rlike(document, F.lit(UNCLOSED))


def read_plain(
    documents: DataFrame, cover: str, table: str, plain_cover: str, plain_table: str, marked: bool = False
) -> DataFrame:
    """Adds a plain cover page as ``schemas.COVER_XML`` and a plain table of at least one line as ``schemas.TABLE_XML``.

    Null for any other text. With ``marked``, both must begin behind the first ``<XML>`` of their text.
    Each step is a generator, so the next one reads its values and does not compute them again.
    Long texts are searched by patterns, which is much faster than by Spark's functions of strings.
    """
    first, lines = (p.replace("@", MARK if marked else "", 1) for p in (COVER, TABLE))
    width = len(TABLE_GROUPS)
    found = computed_once(
        documents,
        _cover_parts=F.split(F.regexp_replace(cover, first, _groups(first, COVER_GROUPS)), PART),
        _parts=F.split(F.regexp_replace(table, lines, _groups(lines, TABLE_GROUPS)), PART),
    )
    # Parts of the last match, behind which one empty part is left. A table is plain if that is the end of the root that the
    # first match began.
    last = F.size("_parts") - (width + 1)
    part = lambda at: F.get("_parts", at)
    begun = (last > width) & (part(F.lit(1)) != "")
    closed = begun & (part(F.lit(0)) == part(last)) & (part(F.lit(1)) == part(last + 1))
    cut = computed_once(
        found,
        _lines=F.when(closed, F.sequence(F.lit(width), last - width, F.lit(width))),
        **{plain_cover: F.when(F.get("_cover_parts", F.lit(0)) != "", _cover_of(F.col("_cover_parts")))},
    ).drop("_cover_parts")
    read = F.struct(
        F.transform("_lines", lambda at: _line_of(F.col("_parts"), at)).alias("infoTable"),
        F.lit(None).cast("string").alias("_corrupt_record"),
    )
    # Every line has the prefix of the root.
    own = F.forall("_lines", lambda at: part(at) == part(F.lit(0)))
    return computed_once(cut, **{plain_table: F.when(own, read)}).drop("_parts", "_lines")
