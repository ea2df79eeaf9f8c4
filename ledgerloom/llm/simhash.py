"""SimHash near-dedup with pigeonring filtering.

A fingerprint bit is set if it is set in over half of the hashes of a text's word shingles. Two fingerprints link at
``max_bits`` or fewer differing bits. With 2 * max_bits + 1 segments in a ring, a linked pair has a segment from which
every chain of l segments differs in at most l * max_bits / segments bits. So the first two segments of the chain are
equal and so is the third or the fourth: three equal segments are the key of an equi-join, and the chain's budgets
prune its pairs before all bits are compared. Copies are one row before that. A key that more than ``BUCKET``
fingerprints share gives no pairs: there the fingerprints with ``max_bits`` of the free bits masked are grouped, whose
groups hold at most 2 ** max_bits members, and each links to the first of its group. Both ways give the same components.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import components, hash_join_small, store
from ledgerloom.llm.line_dedup import row_version

HASH_SEED = 42
BITS = 64
BUCKET = 256


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every shingle, repeats included; fewer words than a shingle are one shingle, none give none."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, HASH_SEED)], np.uint64)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends, digest, seed = (ends - lengths).tolist(), ends[words - 1 :].tolist(), xxhash.xxh64_intdigest, HASH_SEED
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends, strict=False)], np.uint64)


def fingerprint_of(hashes: np.ndarray) -> int:
    """The signed 64-bit fingerprint; zero without hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[at : at + (1 << 16)]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, words: int) -> Column:
    """Fingerprint of a text, as a long."""

    @F.pandas_udf("long")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(shingle_hashes(t, words)) for t in texts], dtype="int64")

    return udf(text)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """Start and width of each segment of the ring, as even as can be."""
    count = 2 * max_bits + 1
    bounds = [BITS * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:], strict=False)]


def chains(max_bits: int) -> list[tuple[int, tuple[int, ...]]]:
    """(start, segments that are equal) of every key: the first two of a chain with the third or the fourth."""
    count = 2 * max_bits + 1
    thirds = (2, 3) if max_bits > 1 else (None,)
    return [(i, tuple((i + k) % count for k in (0, 1, t) if k is not None)) for i in range(count) for t in thirds]


def part(fp: str, start: int, width: int) -> str:
    return f"(shiftrightunsigned({fp}, {start}) & {(1 << width) - 1}L)"


def viable(slot: int, start: int, max_bits: int) -> str:
    """SQL: from this start every chain stays within its proportional budget."""
    ring = segments(max_bits)
    bits = [f"bit_count({part('(x.fp ^ y.fp)', *ring[(start + k) % len(ring)])})" for k in range(len(ring))]
    tests = [f"{' + '.join(bits[:n])} <= {n * max_bits // len(ring)}" for n in range(2, len(ring) + 1)]
    return f"x.slot = {slot} AND {' AND '.join(tests)}"


def links(fingerprints: DataFrame, max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints (fp) that connect all pairs within ``max_bits`` bits.

    Every pair returned is within ``max_bits``. Within small keys all such pairs come back, within larger ones
    enough of them that the same fingerprints are connected. ``fingerprints`` holds each value once; nulls take no part.
    """
    if max_bits == 0:
        return fingerprints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    ring, slots = segments(max_bits), chains(max_bits)
    keys = []
    for slot, (_, equal) in enumerate(slots):
        key, shift = f"{slot}L", 0
        bits = sum(ring[s][1] for s in equal)
        key = f"shiftleft({slot}L, {bits})"
        for s in equal:
            key += f" | shiftleft({part('fp', *ring[s])}, {shift})"
            shift += ring[s][1]
        keys.append(f"struct({slot} AS slot, {key} AS key)")
    keyed = fingerprints.where("fp IS NOT NULL").selectExpr("fp", f"explode(array({', '.join(keys)})) AS k")
    keyed = keyed.select("fp", "k.slot", "k.key")
    counts = keyed.groupBy("key", "slot").agg(F.count("*").alias("n")).where("n > 1")
    shared = store(keyed.join(counts, ["key", "slot"]), "simhash-keys")
    few = shared.where(F.col("n") <= bucket)
    any_chain = " OR ".join(f"({viable(slot, start, max_bits)})" for slot, (start, _) in enumerate(slots))
    pairs = (
        few.alias("x")
        .join(few.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.slot") == F.col("y.slot")))
        .where("x.fp < y.fp")
        .where(any_chain)
        .where(f"bit_count(x.fp ^ y.fp) <= {max_bits}")
        .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    )
    return pairs.union(masked_links(shared.where(F.col("n") > bucket), max_bits)).distinct()


def masked_links(crowded: DataFrame, max_bits: int) -> DataFrame:
    """Links within crowded keys: equal after masking ``max_bits`` free bits, each to the first of its group."""
    ring, slots = segments(max_bits), chains(max_bits)
    fixed = [sorted(b for s in equal for b in range(ring[s][0], sum(ring[s]))) for _, equal in slots]
    free = [[b for b in range(BITS) if b not in set(f)] for f in fixed]
    signed = lambda m: m - (1 << BITS) if m >> (BITS - 1) else m
    spark = crowded.sparkSession
    masks = [(s, signed(sum(1 << b for b in bits))) for s, f in enumerate(free) for bits in combinations(f, max_bits)]
    table = spark.createDataFrame(masks, "slot int, mask long")  # its size depends on max_bits alone
    table = table.groupBy("slot").agg(F.collect_list("mask").alias("masks"))
    rows = crowded.join(F.broadcast(table), "slot").select("fp", "key", "slot", F.explode("masks").alias("mask"))
    rows = rows.withColumn("rest", F.expr("fp & ~mask"))
    group = Window.partitionBy("slot", "key", "mask", "rest")
    return rows.withColumn("a", F.min("fp").over(group)).where("a <> fp").select("a", F.col("fp").alias("b"))


def near_duplicates(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Every document with its fingerprint and component: (doc_id, fp long, component_id).

    component_id is the smallest doc_id that links of ``max_bits`` or fewer bits reach, itself included. Null and empty
    texts and texts of white space have fingerprint zero and link like any other. Null doc_ids belong to their
    component but never name it unless it holds no other. Repeated rows come back as often as they came. Other
    columns are not read; an empty table gives an empty result.
    """
    own = store(docs.select("doc_id", fingerprint(F.col("text"), shingle_words).alias("fp")), "fingerprints")
    distinct = store(own.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = store(components(links(distinct.select("fp"), max_bits, bucket)), "components")
    linked = distinct.join(roots, F.col("fp") == F.col("node"))
    least = linked.groupBy("root").agg(F.min("first_id").alias("least_id"))
    named = linked.join(least, "root").select("fp", "least_id")
    classes = distinct.join(named, "fp", "left").select(
        "fp", F.coalesce("least_id", "first_id").alias("component_id")
    )
    return own.join(classes, "fp").select("doc_id", "fp", "component_id")


def without_near_duplicates(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """One row of each component of ``near_duplicates``, with all its columns.

    The row with the smallest doc_id stays (null last); of rows that share it the one whose text has the smallest hash, and
    of equal rows any one. Null and empty texts and texts of white space are one component, of which one row stays. Other
    columns may carry any name but those that begin with ``__near_``. An empty table gives an empty result.
    """
    version = row_version(F.col("text"))
    name = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), version.alias("version"))
    found = near_duplicates(docs.select(name.alias("doc_id"), "text"), shingle_words, max_bits, bucket)
    kept = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    kept = kept.select(F.col("doc_id.id").alias("__near_doc"), F.col("doc_id.version").alias("__near_version"))
    own = docs.withColumn("__near_own", version)
    same = F.col("doc_id").eqNullSafe(F.col("__near_doc")) & (F.col("__near_own") == F.col("__near_version"))
    once = hash_join_small(own, kept, same).withColumn("__near_null", F.col("doc_id").isNull())
    return once.dropDuplicates(["__near_null", "__near_doc", "__near_own"]).select(*docs.columns)
