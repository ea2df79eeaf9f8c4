"""What several operators of this folder share: stored intermediate tables, connected components, column helpers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import ledgerloom
from ledgerloom.session import work_folder

# Tasks get the package's functions with their code, so executors need no copy of it on their path.
cloudpickle.register_pickle_by_value(ledgerloom)

ASCII_SPACE = "\t\n\x0b\x0c\r "
COARSE = 1024
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def store(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written as Parquet to the shared work folder and read again: computed once, lineage cut."""
    folder = work_folder(frame.sparkSession, purpose)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a task holds few texts as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def discard(frame: DataFrame) -> None:
    """Removes the files of a frame that ``store`` returned, once nothing reads them any more."""
    spark = frame.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else changed; the plain function serves texts that are ASCII alone."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def in_fold(doc_id: Column, folds: int, which: int) -> Column:
    """Whether crc32 of the id as text leaves ``which`` modulo ``folds``; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == which, F.lit(False))


def hash_join_small(large: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join on shuffled partitions that builds its hash table from ``small`` and leaves ``large`` unsorted."""
    return large.join(small.hint("shuffle_hash"), on, how)


def in_order(frame: DataFrame, order: list[str], purpose: str, rows_each: int = 20_000) -> DataFrame:
    """The frame stored in ranges of ``order``, ascending, nulls first, with the range's number as ``range``.

    Ranges hold about ``rows_each`` rows. Rows that agree in all of ``order`` share a range, so its last column should tell rows apart.
    """
    frame = store(frame, f"{purpose}-rows")
    ranges = max(1, -(-frame.count() // rows_each))
    placed = frame.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id())
    return store(placed, f"{purpose}-ranges")


def totals_before(frame: DataFrame, group: list[str], bucket: str, value: str) -> DataFrame:
    """Per group and bucket, the sum of ``value`` over the group's earlier buckets, summed in two levels."""
    sums = frame.groupBy(*group, bucket).agg(F.sum(value).alias("__sum"))
    sums = sums.withColumn("__coarse", F.expr(f"{bucket} div {COARSE}"))
    coarse = sums.groupBy(*group, "__coarse").agg(F.sum("__sum").alias("__total"))
    earlier = Window.partitionBy(*group).orderBy("__coarse").rowsBetween(Window.unboundedPreceding, -1)
    coarse = coarse.withColumn("__base", F.coalesce(F.sum("__total").over(earlier), F.lit(0)))
    within = Window.partitionBy(*group, "__coarse").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__before", F.coalesce(F.sum("__sum").over(within), F.lit(0)))
    same = F.col("__coarse") == F.col("__c")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__{g}"))
    right = coarse.select(*[F.col(g).alias(f"__{g}") for g in group], F.col("__coarse").alias("__c"), "__base")
    return sums.join(right, same).select(*group, bucket, (F.col("__base") + F.col("__before")).alias("before"))


def running(ranged: DataFrame, group: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the group's earlier rows. ``ranged`` comes from ``in_order`` by the same order.

    A window holds one range of a group, never the whole group.
    """
    before = totals_before(ranged, group, "range", value)
    same = F.col("range") == F.col("__range")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__of_{g}"))
    before = before.select(*[F.col(g).alias(f"__of_{g}") for g in group], F.col("range").alias("__range"), "before")
    inside = Window.partitionBy(*group, "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = ranged.withColumn("__inside", F.sum(value).over(inside)).join(before, same)
    total = (F.col("before") + F.col("__inside") - F.col(value)).alias(name)
    return rows.select(*[c for c in ranged.columns if c != "range"], total)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (a, b): every node with the smallest node of its component.

    Large-star and small-star steps in turn; each step is two aggregates and joins, so a node of any degree is
    summed before it is shuffled and its join may be split. Every round is a stored table. Null ends and loops are
    ignored; repeated edges count once. Returns (node, root) for nodes that have an edge to another node.
    """
    spark: SparkSession = edges.sparkSession
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    state, seen = store(pairs, "edges"), None
    while True:
        both = state.union(state.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        small = small.select("e.*").where("u <> v").distinct()
        after = store(small, "edges")
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(state)
        state = after
        if mark == seen:
            break
        seen = mark
    roots = state.groupBy("v").agg(F.first("v").alias("root")).select(F.col("v").alias("node"), "root")
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
