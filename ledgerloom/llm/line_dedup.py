"""Line dedup: of every repeated line the smallest document keeps its copies and all others lose theirs.

Only DataFrame functions. Text is split where it is read; what is shuffled is a 128-bit hash of each line, the
document and the position. Two steps find the first document of a hash. The first works on (hash, salt of the
document) and Spark limits its rank before the shuffle, so a line that a third of all documents hold leaves every
task once. The second range-partitions the few rows left of every hash, sorts them by document and position and
streams the first occurrences. What comes back to the documents is a bitmap of kept positions, 64 to a word, with
words that keep nothing left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import ASCII_SPACE, ascii_lower, hash_join_small

SALTS = 16
WORD_BITS = 64


def line_array(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(ASCII_SPACE)))


def row_version(text: Column) -> Column:
    """Tells rows of one doc_id with different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keep_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """Bitmaps of the lines each document keeps: (doc_id, version, keep array<struct<word, bits>>).

    A key is a line without surrounding ASCII white space, A-Z in lower case. Keys of ``min_chars`` code points or
    more stay in the smallest doc_id only; shorter lines stay everywhere. A null doc_id counts as the largest. Rows
    that share a doc_id are one document: all of them keep what the document keeps. A document that keeps no line
    has no row. Null text is one empty line; an empty table gives no row; other columns are not read.
    """
    lines = docs.select("doc_id", row_version(F.col("text")).alias("version"), F.posexplode(line_array(F.col("text"))))
    key = line_key(F.col("col"))
    lines = lines.select("doc_id", "version", F.col("pos"), key.alias("key"))
    short = F.char_length("key") < min_chars
    hashed = lines.select(
        "doc_id",
        "version",
        "pos",
        F.when(short, F.xxhash64("doc_id", "version", "pos")).otherwise(F.xxhash64("key")).alias("h1"),
        F.when(short, F.lit(None)).otherwise(F.xxhash64(F.lit(1), F.col("key"))).alias("h2"),
        F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"),
    )
    by_doc = F.col("doc_id").asc_nulls_last()
    salted = Window.partitionBy("h1", "h2", "salt").orderBy(by_doc)
    few = hashed.withColumn("rank", F.rank().over(salted)).where("rank = 1").drop("rank", "salt")
    ranged = few.repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2", by_doc, "pos")
    streamed = Window.partitionBy("h1", "h2").orderBy(by_doc)
    first = ranged.withColumn("rank", F.rank().over(streamed)).where("rank = 1")
    words = first.groupBy("doc_id", "version", F.floor(F.col("pos") / WORD_BITS).cast("int").alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, pos % {WORD_BITS}))").alias("bits")
    )
    return words.groupBy("doc_id", "version").agg(F.collect_list(F.struct("word", "bits")).alias("keep"))


def dedup_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """Documents with ``text`` made of the kept lines, and n_lines and n_dropped; other columns pass through.

    Rules for nulls, ties, repeated rows and short lines are those of ``keep_bitmaps``. Every input row comes back
    once. A null text comes back as an empty one. Columns of the input may carry any name but n_lines and n_dropped.
    """
    maps = keep_bitmaps(docs, min_chars).select(
        F.col("doc_id").alias("__doc"), F.col("version").alias("__version"), F.col("keep").alias("__keep")
    )
    own = docs.withColumn("__own", row_version(F.col("text")))
    joined = hash_join_small(
        own, maps, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__own") == F.col("__version")), "left"
    )
    bits = F.map_from_entries(F.coalesce(F.col("__keep"), F.array().cast("array<struct<word:int,bits:bigint>>")))
    lines = line_array(F.col("text"))
    joined = joined.withColumn("__lines", lines).withColumn("n_lines", F.size("__lines").cast("long"))
    joined = joined.withColumn("__bits", bits).withColumn(
        "__dense",
        F.expr(
            f"transform(sequence(0, cast((n_lines - 1) div {WORD_BITS} as int)), w -> coalesce(element_at(__bits, w), 0L))"
        ),
    )
    kept = F.expr(f"filter(__lines, (l, i) -> (shiftright(__dense[i div {WORD_BITS}], i % {WORD_BITS}) & 1) = 1)")
    joined = joined.withColumn("__kept", kept)
    columns = [F.array_join("__kept", "\n").alias(c) if c == "text" else F.col(c) for c in docs.columns]
    return joined.select(*columns, "n_lines", (F.col("n_lines") - F.size("__kept")).alias("n_dropped"))
