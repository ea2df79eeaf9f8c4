"""Registry of queries and their SQL."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(frame: DataFrame) -> DataFrame:
    """Dates as ISO text and decimals as doubles, so results compare by value in any client."""
    kinds = {"date": "string", "decimal": "double"}
    casts = {
        f.name: F.col(f.name).cast(kinds[f.dataType.typeName()])
        for f in frame.schema
        if f.dataType.typeName() in kinds
    }
    return frame.withColumns(casts) if casts else frame


class Tables:
    """Tables of one folder by attribute, e.g. ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Registers ``fn(tables) -> DataFrame`` under a name, with its SQL if there is one."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def spread(frame: DataFrame) -> DataFrame:
    """Rows spread over the cores if the input has fewer splits than cores; otherwise as it is.

    For work that is heavy per row: a small table may be one split, a large one has enough of them.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores) if frame.rdd.getNumPartitions() < cores else frame


TASK_ROWS = 100_000


def dealt(frame: DataFrame, rows: int) -> DataFrame:
    """Rows dealt evenly to tasks of some ``TASK_ROWS``, but to every core, where ``rows`` is about their number.

    For work that is heavy per row behind a join: joined rows are small, so they come in few partitions however many
    they are, and one key may hold many of them.
    """
    return frame.repartition(max(frame.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / TASK_ROWS)))
