"""Uniqueness at load time: a stored sketch of the keys a table has, so that only suspect keys of a batch reach the table.

The sketch is a Bloom filter in blocks of 32,768 bits, one row (block, bits) each. A key has one block and two bits in it. A
key that the table holds always has its bits set; a key that it does not hold rarely has. Sketches are merged by OR, so a
load adds its own keys without a look at the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32_768
BITS_PER_KEY = 24


def blocks_for(keys: int) -> int:
    """Blocks for so many keys: some 0.7 % of keys that are not there are suspects then."""
    return max(1, -(-keys * BITS_PER_KEY // BLOCK_BITS))


def _block(keys: list[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(blocks))


def _bits(keys: list[str]) -> list[Column]:
    """Two bit numbers from a second hash of the key."""
    second = F.xxhash64(F.lit("bits"), *keys)
    return [F.pmod(F.shiftright(second, n * 20), F.lit(BLOCK_BITS)) for n in range(2)]


def sketch(table: DataFrame, keys: list[str], blocks: int) -> DataFrame:
    """Sketch of the keys of a table: block, bits. Bits are combined before the shuffle."""
    placed = table.select(_block(keys, blocks).alias("block"), F.explode(F.array(*_bits(keys))).alias("bit"))
    return placed.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def extended(known: DataFrame, batch: DataFrame, keys: list[str], blocks: int) -> DataFrame:
    """The sketch after a batch was loaded."""
    return known.unionByName(sketch(batch, keys, blocks)).groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def suspects(batch: DataFrame, known: DataFrame, keys: list[str], blocks: int) -> DataFrame:
    """Different keys of a batch that the table may hold; all that it does hold are among them."""

    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substr("bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (bit % 8).cast("int")) == 1

    first, second = "_bit0", "_bit1"
    placed = batch.select(*keys).distinct().withColumns({"_block": _block(keys, blocks), first: _bits(keys)[0], second: _bits(keys)[1]})
    found = placed.join(known.withColumnRenamed("block", "_known"), F.col("_block") == F.col("_known"))
    return found.filter(is_set(F.col(first)) & is_set(F.col(second))).select(*keys)


def load_violations(batch: DataFrame, table: DataFrame, known: DataFrame, keys: list[str], blocks: int) -> DataFrame:
    """Keys of a batch that would stand more than once in the table after it: keys, rows.

    Equal to a count over table and batch together, kept for keys of the batch; only rows of the table with a suspect
    key take part. Null keys are keys like any other.
    """
    maybe = suspects(batch, known, keys, blocks).withColumnsRenamed({name: f"_s{n}" for n, name in enumerate(keys)})
    same = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_s{n}")) for n, name in enumerate(keys)])
    stored = table.select(*keys).join(maybe, same, "left_semi")
    counted = batch.select(*keys).unionByName(stored).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return counted.filter(F.col("rows") > 1)
