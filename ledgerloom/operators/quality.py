"""Checks that return the offending rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_key_violations(table: DataFrame, *keys: str) -> DataFrame:
    return table.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def vector_violations(table: DataFrame, key: str, column: str, dims: int) -> DataFrame:
    """Vectors that an index would refuse: missing, wrong size, not a number, zero length."""
    v = F.col(column)
    reason = (
        F.when(v.isNull(), "missing")
        .when(F.size(v) != dims, "wrong size")
        .when(F.exists(v, lambda x: x.isNull() | F.isnan(x)), "not a number")
        .when(F.forall(v, lambda x: x == 0), "zero length")
    )
    return table.select(key, reason.alias("reason")).filter(F.col("reason").isNotNull())
