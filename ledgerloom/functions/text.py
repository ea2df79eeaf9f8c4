"""Text expressions: list cells, casing rules, property keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.bind import let


def parse_list(cell: Column) -> Column:
    """``{'a', 'b'}`` -> array of a, b. An empty cell gives one empty string."""
    return F.transform(
        F.split(F.btrim(cell, F.lit("{}")), ","), lambda part: F.btrim(part, F.lit("' "))
    )


def render_list(values: Column) -> Column:
    """Array -> ``{'a', 'b'}``, the inverse of :func:`parse_list`."""
    quoted = F.transform(values, lambda v: F.concat(F.lit("'"), v, F.lit("'")))
    return F.concat(F.lit("{"), F.array_join(quoted, ", "), F.lit("}"))


def capitalise(text: Column) -> Column:
    """First letter upper, all others lower."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))


def title_case(text: Column) -> Column:
    """A capital after every character that has no case, as in ``At&T`` and ``3M``."""
    cased = r"[\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}]"
    uncased = cased.replace("[", "[^", 1)
    runs = F.regexp_extract_all(text, F.lit(f"({cased}+|{uncased}+)"), F.lit(1))
    return F.array_join(F.transform(runs, capitalise), "")


def camel_key(key: Column) -> Column:
    """``Birth date`` -> ``birthDate``; a blank key stays as it is."""
    words = F.split(F.regexp_replace(key, r"(?U)^\s+|\s+$", ""), r"(?U)\s+")
    joined = F.array_join(
        F.transform(words, lambda w, i: F.when(i == 0, F.lower(w)).otherwise(capitalise(w))), ""
    )
    return F.when(key.rlike(r"(?U)^\s*$"), key).otherwise(joined)


def property_map(properties: Column) -> Column:
    """Array of (key, value) -> map with camel-case keys. The last duplicate wins; null gives an empty map.

    A property that is null or has no key is left out.
    """
    keyed = F.filter(properties, lambda p: p["key"].isNotNull())
    entries = F.transform(
        F.coalesce(keyed, F.expr("CAST(array() AS ARRAY<STRUCT<key: STRING, value: STRING>>)")),
        lambda p: F.struct(camel_key(p["key"]).alias("key"), p["value"].alias("value")),
    )

    def last_of_each_key(all_entries: Column) -> Column:
        return F.filter(
            all_entries,
            lambda e, i: ~F.exists(
                F.slice(all_entries, i + 2, F.size(all_entries)), lambda later: later["key"] == e["key"]
            ),
        )

    return F.map_from_entries(let(entries, last_of_each_key))


def relation_type(text: Column) -> Column:
    return F.upper(F.replace(text, F.lit(" "), F.lit("_")))


def unix_newlines(text: Column) -> Column:
    """CRLF and lone CR become LF, as when a file is read in text mode."""
    return F.regexp_replace(text, "\r\n?", "\n")
