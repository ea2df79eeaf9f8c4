"""Landed files -> frames, and frames -> files. No reader infers a schema."""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import islice
from pathlib import Path

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions import ids, text


def read_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """CSV with a header line. ``multi_line`` allows line breaks inside cells, and makes each file one task."""
    # Backslash is ordinary text in these files; quotes are doubled. An empty cell is a null.
    return spark.read.schema(schema).options(header=True, escape='"', multiLine=multi_line).csv(path)


def read_holdings(spark: SparkSession, path: str) -> DataFrame:
    """Rolled-up holdings on their declared schema, split over as many tasks as their size needs."""
    return read_csv(spark, path, schemas.HOLDINGS)


def read_company_map(spark: SparkSession, path: str, schema: str = schemas.COMPANY_MAP_CSV) -> DataFrame:
    """Company mapping or URL list; the two list cells become arrays."""
    frame = read_csv(spark, path, schema, multi_line=True)
    return frame.withColumns({c: text.parse_list(F.col(c)) for c in ("cusip", "names")})


def write_csv(frame: DataFrame, path: str) -> None:
    """CSV with a header line. Array columns are written as ``{'a', 'b'}`` cells."""
    lists = {f.name: text.render_list(F.col(f.name)) for f in frame.schema if f.dataType.typeName() == "array"}
    flat = frame.withColumns(lists) if lists else frame
    flat.write.mode("overwrite").options(header=True, escape='"').csv(path)


def write_json(frame: DataFrame, path: str) -> None:
    """One JSON object per row, many rows per file."""
    frame.write.mode("overwrite").json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_section_files(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned annual reports, one pretty-printed JSON file each; the form id is the file name."""
    frame = spark.read.schema(schemas.SECTIONS_JSON).option("multiLine", True).json(path, pathGlobFilter="*.json")
    return frame.withColumn("formId", ids.form_id(F.col("_metadata.file_name")))


def read_raw_files(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """One row per raw file: file_name, raw.

    Spark hides files whose names begin with ``_``; for those see :func:`read_underscored_files`.
    """
    frame = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    return frame.select(
        F.col("_metadata.file_name").alias("file_name"), text.unix_newlines(F.col("value")).alias("raw")
    )


EMPTY, NOT_UTF8 = "empty file", "not UTF-8"
LISTED = "path STRING, file_name STRING, size BIGINT"
LANDED = "file_name STRING, size BIGINT, raw STRING, reason STRING"
NAMES_A_BATCH = 10_000
BYTES_A_BATCH = 4 << 20


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    path = path.removeprefix("file:") if path.startswith("file:/") else path
    return pafs.FileSystem.from_uri(path if "://" in path else Path(path).absolute().as_uri())


def _entries(store: pafs.FileSystem, folder: str, suffix: str) -> Iterator[tuple[str, str, int]]:
    """Path, name and size of each file of a folder. A mounted folder is read entry by entry; other stores give one list."""
    if isinstance(store, pafs.LocalFileSystem):
        with os.scandir(folder) as entries:
            for e in entries:
                if e.name.endswith(suffix) and e.is_file():
                    yield e.path, e.name, e.stat().st_size
        return
    for f in store.get_file_info(pafs.FileSelector(folder)):
        if f.type == pafs.FileType.File and f.base_name.endswith(suffix):
            yield f.path, f.base_name, f.size


def _listed(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """Names and sizes of the files of a folder, listed by a task and spread over the tasks that follow."""
    store, folder = _store(path)

    def names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = _entries(store, folder, suffix) if len(batch) else iter(())
            while some := list(islice(rows, NAMES_A_BATCH)):
                yield pd.DataFrame(some, columns=["path", "file_name", "size"])

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return spark.range(0, 1, 1, 1).mapInPandas(names, LISTED).repartition(tasks, "path")


def landed_files(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """Every file of a folder whose name ends with ``suffix``, also ``_`` names: file_name, size, raw, reason.

    Names never reach the driver: one task lists them, the tasks behind a shuffle of names open their files one at a
    time. ``reason`` says why ``raw`` is null: an empty file, or bytes that are no UTF-8. A file that cannot be opened
    fails its task, which Spark runs again.
    """
    store, _ = _store(path)

    def read(row) -> tuple:
        if not row.size:
            return row.file_name, row.size, None, EMPTY
        with store.open_input_stream(row.path) as stream:
            content = stream.read()
        try:
            return row.file_name, len(content), content.decode("utf-8"), None
        except UnicodeDecodeError:
            return row.file_name, len(content), None, NOT_UTF8

    def contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                held.append(read(row))
                size += held[-1][1]
                if size >= BYTES_A_BATCH or len(held) >= NAMES_A_BATCH:
                    yield pd.DataFrame(held, columns=["file_name", "size", "raw", "reason"])
                    held, size = [], 0
        if held:
            yield pd.DataFrame(held, columns=["file_name", "size", "raw", "reason"])

    found = _listed(spark, path, suffix).mapInPandas(contents, LANDED)
    return found.withColumn("raw", text.unix_newlines(F.col("raw")))


def empty_files(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """Quarantine rows for files without content, which no file scan returns: file, stage, reason."""
    empty = _listed(spark, path, suffix).filter(F.col("size") == 0)
    return empty.select(F.col("file_name").alias("file"), F.lit("parse").alias("stage"), F.lit(EMPTY).alias("reason"))


def unreadable_files(landed: DataFrame) -> DataFrame:
    """Quarantine rows of :func:`landed_files`: file, stage, reason."""
    bad = landed.filter(F.col("reason").isNotNull())
    return bad.select(F.col("file_name").alias("file"), F.lit("parse").alias("stage"), "reason")


def read_underscored_files(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """As :func:`read_raw_files`, for a folder of files named after paths, which begin with ``_``."""
    return landed_files(spark, path, suffix).filter(F.col("reason").isNull()).select("file_name", "raw")


def write_raw_files(frame: DataFrame, path: str) -> int:
    """Rows (file_name, content) as one file each, written by the tasks; the number of files. A task that runs again writes
    the same files again."""
    store, folder = _store(path)

    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store.create_dir(folder, recursive=True)
        for batch in batches:
            for row in batch.itertuples(index=False):
                with store.open_output_stream(f"{folder}/{row.file_name}") as stream:
                    stream.write(bytes(row.content))
            yield pd.DataFrame({"files": [len(batch)]})

    return frame.select("file_name", "content").mapInPandas(written, "files BIGINT").agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]


def read_filing_history(spark: SparkSession, path: str) -> DataFrame:
    """Filing history documents, one JSON file per company, company id from the file name."""
    frame = spark.read.schema(schemas.FILING_HISTORY).option("multiLine", True).json(path)
    return frame.withColumn("cik", F.regexp_extract(F.col("_metadata.file_name"), r"0*(\d+)\.json$", 1))


def read_index_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("line"))
