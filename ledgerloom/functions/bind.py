"""Naming an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A value used inside a lambda would otherwise be inlined and computed again for every element.
    """
    return F.transform(F.array(value), body)[0]


def computed_once(frame: DataFrame, **columns: Column) -> DataFrame:
    """Adds costly columns through a generator of one row.

    A filter on a plain projected column is pushed below it and computes the column again; generated
    columns are computed once per row, whatever is built on them.
    """
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return frame.select("*", F.inline(F.array(made)))
