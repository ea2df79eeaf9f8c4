"""Date and number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


AMOUNT = "decimal(28,6)"


def index_path(day: Column) -> Column:
    """Path of the daily filing index, by year and quarter."""
    return F.concat(
        F.lit("/Archives/edgar/daily-index/"),
        F.year(day).cast("string"),
        F.lit("/QTR"),
        F.quarter(day).cast("string"),
        F.lit("/master."),
        F.date_format(day, "yyyyMMdd"),
        F.lit(".idx"),
    )


def parse_period(text: Column) -> Column:
    """Report period as ``MM-dd-yyyy`` or ``yyyy-MM-dd``; null if neither fits."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("MM-dd-yyyy")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))
    ).cast("date")


def scaled_value(text: Column, compat: bool = False) -> Column:
    """Reported thousands -> full amount.

    The default multiplies by 1000 and keeps up to six decimals of the result. Text that is no number, or one of more
    than 22 digits after scaling, gives null. ``compat`` appends three zeros to the text instead, which
    leaves a number with decimals unscaled.
    """
    digits = F.replace(text, F.lit(" "), F.lit(""))
    if compat:
        return F.concat(digits, F.lit("000")).try_cast("double")
    return F.try_multiply(digits.try_cast("decimal(34,12)"), F.lit(1000)).try_cast(AMOUNT)
