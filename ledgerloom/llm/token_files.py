"""Token ids in binary files, with a minimal perfect hash index for access by document key.

A folder holds payload shards and index files. Documents are range-partitioned in order, and each task cuts its range into
shards. A shard's file has a head (documents, ids, bytes an id), the length and the id of each document, and then the raw
ids, little endian. A document's key is its copy number, a colon and its id (without colon and id for a null one); copies
count rows that share an id. Keys are dealt over index files by hash. An index file has the number of such files, a minimal
perfect hash over its keys and, for each slot, a 32-bit fingerprint, the shard, the first id within it, the number of
ids and the number of ids of all documents before. So a key leads in constant time to its file and place, whatever the
number of documents, and unknown keys are told apart by the fingerprint. Files are written by Spark's text sink, one row
of bytes for each file and a line feed behind it, so that a lost task is written again and any store that Spark reaches will do.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import perfect_hash
from ledgerloom.llm.common import running, sliced, store, totals_before
from ledgerloom.llm.word_ids import encoded_column, id_kind, kept_words

END_ID = 2
SHARD_IDS = 1 << 21
INDEX_KEYS = 1 << 16
COPY_BLOCK = 4096
SHARD_MAGIC = b"LTOK0001"
PART_BITS = 24
NO_KEY = (1 << 32) - 1
#: Columns of an index file behind its perfect hash, each an array over the slots.
ENTRY = (("print", "<u4"), ("shard", "<u8"), ("first", "<u4"), ("length", "<u4"), ("start", "<u8"))


def key_text(doc_id: Column, copy: Column) -> Column:
    return F.concat_ws(":", copy.cast("string"), doc_id.cast("string"))  # which leaves a null id out


def key_hashes(key: Column) -> list[Column]:
    """XXH64 with seed 42 of the key and of the key behind a byte 1, as signed numbers."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.concat(F.lit("\x01"), key)).alias("h2")]


def write_files(frame: DataFrame, name: str, content: str, folder: str) -> None:
    """One file for each row: the bytes of ``content`` and a line feed, below ``folder/name=<value>``."""
    frame.select(name, F.col(content).cast("string").alias("value")).write.partitionBy(name).text(folder)


def read_files(spark: SparkSession, name: str, folder: str) -> DataFrame:
    """(name, content) of the files that ``write_files`` wrote, with the line feed that ends each."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.regexp_extract("path", rf"/{name}=(\d+)/", 1).cast("long").alias(name), "content")


def packed(batches: Iterator[pa.RecordBatch], column: str, codec: str = "zstd") -> Iterator[pa.RecordBatch]:
    """The batches with a text or binary column compressed, value by value; empty and null values stay as they are."""
    for batch in sliced(batches):
        values = [v and len(v).to_bytes(8, "little") + pa.compress(v, codec, asbytes=True) for v in batch.column(column).cast(pa.binary()).to_pylist()]
        at = batch.schema.get_field_index(column)
        yield batch.set_column(at, column, pa.array(values, pa.binary()))


def unpacked(value: bytes | None, codec: str = "zstd") -> bytes:
    return pa.decompress(value[8:], int.from_bytes(value[:8], "little"), codec, asbytes=True) if value else b""


def shard_bytes(ids: list[np.ndarray], keys: list[bytes | None], width: int) -> bytes:
    head = np.array([len(ids), sum(map(len, ids)), width], "<u8").tobytes()
    sizes = np.array([[len(x) for x in ids], [NO_KEY if k is None else len(k) for k in keys]], "<u4")
    return b"".join([SHARD_MAGIC, head, sizes.tobytes(), *(k for k in keys if k), *(x.tobytes() for x in ids)])


class Shard:
    """Reads what ``shard_bytes`` made."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != SHARD_MAGIC:
            raise ValueError("not a shard of token ids")
        count, ids, width = np.frombuffer(data, "<u8", 3, 8).tolist()
        self.lengths, sizes = np.frombuffer(data, "<u4", 2 * count, 32).reshape(2, count)
        self.firsts = np.cumsum(self.lengths.astype(np.int64)) - self.lengths
        none = sizes == NO_KEY
        ends = 32 + 8 * count + np.cumsum(np.where(none, 0, sizes.astype(np.int64)))
        at = int(ends[-1]) if count else 32
        self.keys = [None if x else data[e - n : e] for x, e, n in zip(none.tolist(), ends.tolist(), sizes.tolist(), strict=True)]
        self.ids = np.frombuffer(data, f"<u{width}", ids, at)


def write_payload(docs: DataFrame, tokenizer: str, folder: str, end_id: int, shard_ids: int) -> None:
    """Documents in order of doc_id, the text's hash and the row, in shards whose numbers ascend."""
    kind, kinds = id_kind(tokenizer), {f.name: f.dataType.simpleString() for f in docs.schema}
    order = ["doc_id", "tie", "row"]
    rows = docs.select("doc_id", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("string").alias("key"), "text")
    schema = f"doc_id {kinds['doc_id']}, tie long, row long, key string, text binary"
    small = rows.mapInArrow(lambda batches: packed(batches, "text"), schema)  # texts are shuffled compressed
    ranged = small.repartitionByRange(max(1, docs.rdd.getNumPartitions()), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        words, number = kept_words(tokenizer, kind), TaskContext.get().partitionId() << PART_BITS
        ids, keys, total = [], [], 0

        def shard() -> pa.RecordBatch:
            content = shard_bytes(ids, keys, np.dtype(kind).itemsize)
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([content], pa.binary())], ["shard", "content"])

        for batch in sliced(batches):
            texts = pa.array([unpacked(v) for v in batch.column("text").to_pylist()], pa.binary())
            found, _ = encoded_column(words, texts, end_id)
            for key, one in zip(batch.column("key").cast(pa.binary()).to_pylist(), found.to_pylist(), strict=True):
                ids.append(np.frombuffer(one, kind))
                keys.append(key)
                total += len(ids[-1])
                if total >= shard_ids:
                    yield shard()
                    ids, keys, total, number = [], [], 0, number + 1
        if ids:
            yield shard()

    write_files(ranged.select("key", "text").mapInArrow(run, "shard long, content binary"), "shard", "content", f"{folder}/payload")


def shard_entries(spark: SparkSession, folder: str) -> DataFrame:
    """(key, shard, first, length) of every document, from the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
                shard = Shard(content.as_py())
                columns = [pa.array(shard.keys, pa.binary()).cast(pa.string()), np.full(len(shard.keys), number), shard.firsts, shard.lengths.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], ["key", "shard", "first", "length"])

    return read_files(spark, "shard", f"{folder}/payload").mapInArrow(run, "key string, shard long, first long, length long")


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS, index_keys: int = INDEX_KEYS) -> None:
    """Encodes every whole text of ``docs`` (doc_id, text), puts ``end_id`` behind it and writes shards and index to ``folder``.

    Documents are in ascending order of doc_id, null first; rows that share an id go by their text's hash, equal rows one behind
    the other. Null and empty texts have the end id alone. A shard is full with ``shard_ids`` ids; a document is never
    cut. Other columns are not read; an empty table writes no file.
    """
    write_payload(docs, tokenizer, folder, end_id, shard_ids)
    entries = store(shard_entries(docs.sparkSession, folder), "token-entries")
    ranged = entries.withColumn("range", F.col("shard")).withColumn("one", F.lit(1).cast("long"))
    shared = ranged.groupBy("key").agg(F.count("*").alias("__rows")).where("__rows > 1").select(F.col("key").alias("__key"))
    repeated = ranged.join(shared, F.col("key").eqNullSafe(F.col("__key")), "left_semi")
    copies = running(repeated, ["key"], ["first"], "one", "copy").select(F.col("shard").alias("__shard"), F.col("first").alias("__first"), "copy")
    same = (F.col("shard") == F.col("__shard")) & (F.col("first") == F.col("__first"))
    placed = entries.join(copies, same, "left").withColumn("copy", F.coalesce("copy", F.lit(0).cast("long")))
    before = totals_before(ranged, [], "range", "length").select(F.col("range").alias("__range"), "before")
    placed = placed.join(before, F.col("shard") == F.col("__range"))
    parts = max(1, -(-entries.count() // index_keys))
    hashed = placed.select(
        *key_hashes(key_text(F.col("key"), F.col("copy"))), "shard", "first", "length", (F.col("before") + F.col("first")).alias("start")
    )
    hashed = hashed.withColumn("part", F.pmod("h1", F.lit(parts)))

    def index_file(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        h1, h2 = (table.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
        head = perfect_hash.build(h1, h2)
        slots = perfect_hash.PerfectHash(head).slots(h1, h2)
        columns = {"print": perfect_hash.fingerprints(h1, h2), **{c: table.column(c).to_numpy() for c, _ in ENTRY[1:]}}
        body = b""
        for c, width in ENTRY:
            values = np.zeros(len(h1), width)
            values[slots] = columns[c]
            body += values.tobytes()
        content = np.array([parts], "<u8").tobytes() + head + body
        return pa.table({"part": table.column("part").slice(0, 1), "content": pa.array([content], pa.binary())})

    index = hashed.groupBy("part").applyInArrow(index_file, "part long, content binary")
    write_files(index, "part", "content", f"{folder}/index")


def look_up(keys: DataFrame, folder: str) -> DataFrame:
    """Where documents are: ``keys`` (doc_id, copy long) with shard, first, length and start; unknown keys drop out.

    Each key goes to its index file; of rows that repeat a key one comes back.
    """
    spark = keys.sparkSession
    files = read_files(spark, "part", f"{folder}/index")
    one = files.select(F.substring("content", 1, 8).alias("parts")).first()
    if one is None:
        return keys.limit(0).selectExpr("doc_id", "copy", *(f"0L AS {c}" for c, _ in ENTRY[1:]))
    asked = keys.select("doc_id", "copy").distinct()
    asked = asked.select("doc_id", "copy", *key_hashes(key_text(F.col("doc_id"), F.col("copy"))))
    asked = asked.withColumn("part", F.pmod("h1", F.lit(int.from_bytes(one["parts"], "little"))))
    fields = ["doc_id", "copy"]
    kinds = [f"{c} {asked.schema[c].dataType.simpleString()}" for c in fields]
    names = [*fields, *(c for c, _ in ENTRY[1:])]

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        columns = [pa.array([], left.schema.field(c).type) for c in fields] + [pa.array([], pa.int64())] * (len(ENTRY) - 1)
        if left.num_rows and right.num_rows:
            left, data = left.combine_chunks(), right.column("content")[0].as_py()[8:]
            h1, h2 = (left.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
            table = perfect_hash.PerfectHash(data)
            slots = table.slots(h1, h2)
            widths = np.cumsum([0, *(np.dtype(w).itemsize for _, w in ENTRY)]).tolist()
            arrays = [np.frombuffer(data, w, table.keys, table.end + table.keys * x) for (_, w), x in zip(ENTRY, widths, strict=False)]
            known = np.flatnonzero(slots >= 0)
            known = known[arrays[0][slots[known]] == perfect_hash.fingerprints(h1[known], h2[known])]
            columns = [left.column(c).take(pa.array(known)) for c in fields]
            columns += [pa.array(a[slots[known]].astype(np.int64)) for a in arrays[1:]]
        return pa.table(columns, names)

    schema = ", ".join([*kinds, *(f"{c} long" for c, _ in ENTRY[1:])])
    return asked.groupBy("part").cogroup(files.groupBy("part")).applyInArrow(find, schema)


def read(keys: DataFrame, folder: str) -> DataFrame:
    """The documents of ``keys`` (doc_id, copy) from the files: (doc_id, copy, start, n_tokens, ids).

    ids are little-endian unsigned 32-bit numbers, start counts the ids of all documents before.
    """
    spark = keys.sparkSession
    places = look_up(keys, folder)
    shards = read_files(spark, "shard", f"{folder}/payload").mapInArrow(lambda batches: packed(batches, "content"), "shard long, content binary")
    kinds = [f"{c} {places.schema[c].dataType.simpleString()}" for c in ("doc_id", "copy")]

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        left, pieces = left.combine_chunks(), []
        if left.num_rows:
            ids = Shard(unpacked(right.column("content")[0].as_py())).ids
            places = zip(left.column("first").to_pylist(), left.column("length").to_pylist(), strict=True)
            pieces = [ids[a : a + n].astype("<u4").tobytes() for a, n in places]
        columns = [left.column(c) for c in ("doc_id", "copy", "start", "length")]
        return pa.table([*columns, pa.array(pieces, pa.binary())], ["doc_id", "copy", "start", "n_tokens", "ids"])

    schema = ", ".join([*kinds, "start long", "n_tokens long", "ids binary"])
    return places.groupBy("shard").cogroup(shards.groupBy("shard")).applyInArrow(cut, schema)


def keys_of(docs: DataFrame) -> DataFrame:
    """(doc_id, copy) of all rows of a table: as many copies of an id as it has rows, a block of them at a time."""
    counts = docs.groupBy("doc_id").agg(F.count("*").alias("rows"))
    blocks = counts.select("doc_id", "rows", F.explode(F.expr(f"sequence(0L, (rows - 1) div {COPY_BLOCK})")).alias("block"))
    copies = f"sequence(block * {COPY_BLOCK}, least(rows, (block + 1) * {COPY_BLOCK}) - 1)"
    return blocks.repartition("doc_id", "block").select("doc_id", F.explode(F.expr(copies)).alias("copy"))
