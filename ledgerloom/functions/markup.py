"""Markup removal as a chain of regular expressions, and an exact parser mode."""

from __future__ import annotations

from html.entities import html5, name2codepoint

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerloom.functions.bind import let
from ledgerloom.functions.markup_parser import text_nodes

# One run of anything that separates two text nodes: comments, blocks whose content is not text,
# declarations and tags. A tag that the end of the text cuts off counts too. The possessive ++ runs as a
# loop, so a run of very many tags needs no deep stack.
NON_TEXT_RUN = (
    r"(?is)(?:<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<template\b.*?</template\s*>"
    r"|<[!?][^>]*>|</?[a-z][^>]*(?:>|\z))++"
)
ENTITY_START = r"(?=&(?:#[0-9]|#[xX][0-9a-fA-F]|[A-Za-z]))"
ENTITY = r"^&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*)(;?)"
# Names that are read without a semicolon too, the longest first.
BARE_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
NAMES = {**{n: chr(c) for n, c in name2codepoint.items()}, **{n: html5[n] for n in BARE_NAMES}, "apos": "'"}
BARE = "^(?:" + "|".join(BARE_NAMES) + ")"
# What numbers 128 to 159 stand for in pages: the characters of Windows' western code page.
WINDOWS = [bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(128, 160)]
REPLACEMENT = "\ufffd"


def _code_point(number: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


def _numbered(name: Column) -> Column:
    """The character of a numeric reference: zero, surrogates and numbers too large give U+FFFD, controls nothing."""
    digits = F.regexp_replace(name, "^#[xX]?0*", "")
    n = F.when(name.rlike("^#[xX]"), F.conv(F.substring(digits, 1, 8), 16, 10)).otherwise(F.substring(digits, 1, 8))
    n = F.coalesce(n.try_cast("bigint"), F.lit(0))
    control = n.between(1, 8) | n.between(14, 31) | n.isin(11, 127) | n.between(0xFDD0, 0xFDEF) | (n % 0x10000 >= 0xFFFE)
    return (
        F.when((F.length(digits) > 7) | (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), REPLACEMENT)
        .when(n.between(128, 159), F.get(F.array(*map(F.lit, WINDOWS)), (n - 128).cast("int")))
        .when(control, "")
        .otherwise(_code_point(n))
    )


def decode_entities(text: Column) -> Column:
    """Named and numeric character references -> characters, as a page's reader takes them.

    Numbers may have any count of digits and lack their semicolon, and so may the names that allow it, also in front of
    more letters. Names are those of HTML 4; unknown ones stay as they are.
    """
    named = F.create_map(*[F.lit(x) for pair in NAMES.items() for x in pair])

    def one(piece: Column) -> Column:
        name, end = F.regexp_extract(piece, ENTITY, 1), F.regexp_extract(piece, ENTITY, 2)
        rest = F.substr(piece, F.length(name) + F.length(end) + 2)
        bare = F.regexp_extract(name, BARE, 0)
        whole = F.when(end == ";", F.try_element_at(named, name))
        after = F.concat(F.substr(name, F.length(bare) + 1), end, rest)
        return (
            F.when(name == "", piece)
            .when(name.startswith("#"), F.concat(_numbered(name), rest))
            .when(whole.isNotNull(), F.concat(whole, rest))
            .when(bare != "", F.concat(F.try_element_at(named, bare), after))
            .otherwise(piece)
        )

    def decoded(value: Column) -> Column:
        joined = F.array_join(F.transform(F.split(value, ENTITY_START), one), "")
        return F.when(F.contains(value, F.lit("&")), joined).otherwise(value)

    return let(text, decoded)


# HTML text never holds this character, so it can stand for a cut until the edges are trimmed.
CUT = "\0"


def html_to_text(html: Column) -> Column:
    """All text nodes joined by a newline."""
    cuts = F.regexp_replace(html, NON_TEXT_RUN, CUT)
    return decode_entities(F.translate(F.btrim(cuts, F.lit(CUT)), CUT, "\n"))


@F.pandas_udf(StringType())
def html_to_text_exact(html: pd.Series) -> pd.Series:
    """The same by an HTML parser, for input with unusual references or stray brackets."""
    return html.map(lambda page: None if page is None else "\n".join(text_nodes(page)))
