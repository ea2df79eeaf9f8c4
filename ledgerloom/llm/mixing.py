"""Mixing sources to target weights by balanced sampling (cube method).

Each document's expected number of copies is its source's target over its source's size. The whole part is taken
outright; the rest is an inclusion probability. The flight moves the probabilities of a block of documents of one
source along the null space of its constraints (words and documents), three documents at a time, until each is 0 or 1
but for two. Blocks hold a bounded number of documents, so a source with a third of all rows is many blocks. What is
left of all blocks flies again in blocks, level by level. Where one block per source remains, the landing rounds its
last two documents and repairs the difference in words that this makes, by changing a few single decisions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import hash_join_small, store

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 2048
FEW_SOURCES = 10_000
DUST = 1e-9
REPAIRS = 8


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """One row per source: source, source_size, units, target.

    Sources in code point order, null last, take the weights in turn. The targets sum to ``share`` of all sizes but
    stop at ``most`` times the source's size: what is above goes to the others by weight. The last capped source is
    found from running sums in order of cap over weight. The catalogue of sources has one row per source.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("units"))
    ranks = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(ranks) - 1) % len(weights)
    sources = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), turn + 1))
    sources = sources.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sources = sources.withColumn("goal", F.sum("source_size").over(everything) * F.lit(float(share)))
    left = F.col("goal") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    sources = sources.withColumn("level", left / open_weight)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    sources = sources.withColumn("level", F.coalesce(F.max(fits).over(everything), F.lit(float("inf"))))
    target = F.least(F.col("cap"), F.col("level") * F.col("weight"))
    return sources.select("source", "source_size", "units", target.alias("target"))


def fly(p: np.ndarray, size: np.ndarray, rng: np.random.Generator, land: bool) -> np.ndarray:
    """Probabilities after the flight: all 0 or 1 but for at most two, which ``land`` rounds."""
    p = p.astype(float).tolist()
    waiting = [k for k, x in enumerate(p) if DUST < x < 1 - DUST][::-1]
    draws = iter(rng.random(2 * len(waiting) + 8).tolist())
    active: list[int] = []
    while True:
        while len(active) < 3 and waiting:
            active.append(waiting.pop())
        if len(active) == 3:
            a, b, c = (size[k] for k in active)
            move = [b - c, c - a, a - b]  # keeps the sum and the sum of words
            if not any(move):
                move = [1.0, -1.0, 0.0]
        else:
            break
        up = min((1 - p[k]) / m if m > 0 else p[k] / -m for k, m in zip(active, move, strict=True) if m)
        down = min(p[k] / m if m > 0 else (1 - p[k]) / -m for k, m in zip(active, move, strict=True) if m)
        step = up if next(draws) * (up + down) < down else -down
        for k, m in zip(active, move, strict=True):
            p[k] += step * m
            if p[k] < DUST or p[k] > 1 - DUST:
                p[k] = float(round(p[k]))
        active = [k for k in active if 0 < p[k] < 1]
    for k in active if land else ():
        p[k] = float(round(p[k]))
    return np.array(p)


def landed(p: np.ndarray, words: np.ndarray, goal: float) -> np.ndarray:
    """Changes single decisions, the one that helps most at a time, while that brings the words nearer to ``goal``."""
    for _ in range(REPAIRS):
        off = float(p @ words) - goal
        moved = np.abs(off + np.where(p == 1, -words, words))
        best = int(moved.argmin())
        if moved[best] >= abs(off):
            break
        p[best] = 1 - p[best]
    return p


def flight(units: DataFrame, blocks: Column, level: int, seed: int, land: bool) -> DataFrame:
    """One level: the units of each block of each source fly together."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["words", "unit"], ascending=[False, True], kind="stable")  # small ones stay for the landing
        digest = int(rows["unit"].iloc[0]) & (2**64 - 1)  # of the block's first unit: reruns agree
        rng = np.random.default_rng([seed, level, digest, len(rows)])
        before, words = rows["p"].to_numpy(), rows["words"].to_numpy(np.float64)
        after = fly(before, words, rng, land)
        return rows.assign(p=landed(after, words, float(before @ words)) if land else after)

    salt = F.xxhash64(F.lit(level), F.col("unit"))
    placed = units.withColumn("block", F.pmod(salt, blocks))
    flown = placed.groupBy("source", "block").applyInPandas(run, placed.schema)
    return flown.drop("block")


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 6,
    block: int = BLOCK,
) -> DataFrame:
    """How often the mix takes each document: (doc_id, source, size, source_size, target, copies), a row per input row.

    size is the number of words (runs without ASCII white space; null text: 0). Null is a source of its own, the last.
    Rows that agree in doc_id, source and size are one unit: they share one decision, so ties cannot differ between
    runs. Texts without words are taken like the others of their source and add nothing. Sources without any word
    have target 0 and are not taken. Other columns are not read; an empty table gives an empty result.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    units = sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows"))
    units = units.withColumn("unit", F.xxhash64("doc_id", "source", "size")).withColumn(
        "words", F.col("size") * F.col("rows")
    )
    units = store(units, "mix-units")
    sources = source_targets(units.select("source", F.col("words").alias("size")), weights, share, most)
    sources = store(sources, "mix-sources")
    known = F.broadcast(sources) if sources.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES else sources
    known = known.withColumnRenamed("source", "__source")
    units = units.join(known, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    units = units.withColumn("whole", F.floor(rate + DUST).cast("int")).withColumn(
        "p", F.greatest(F.lit(0.0), rate - F.col("whole"))
    )
    most_units = sources.agg(F.max("units")).first()[0] or 0
    done, level, blocks = [], 0, F.greatest(F.lit(1), F.ceil(F.col("units") / block)).cast("int")
    while most_units > block:
        flown = store(flight(units, blocks, level, seed, land=False), "mix-flight")
        done.append(flown.where("p <= 0 OR p >= 1"))
        units = flown.where("p > 0 AND p < 1").withColumn("units", F.ceil(F.col("units") / block) * 2)
        level, most_units = level + 1, -(-most_units // block) * 2
    landed = flight(units, F.lit(1), level, seed, land=True)
    for part in done:
        landed = landed.unionByName(part)
    copies = F.col("whole") + F.round("p").cast("int")
    row = F.explode(F.expr("array_repeat(1, cast(rows AS int))"))
    taken = landed.withColumn("copies", copies).withColumn("__row", row)
    return taken.select("doc_id", "source", "size", "source_size", "target", F.col("copies").cast("int"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents that ``mix`` takes, each as often as it takes them, with all their columns."""
    decided = mix(docs, **settings).groupBy("doc_id", "source", "size").agg(F.first("copies").alias("__copies"))
    decided = decided.where("__copies > 0").toDF("__doc", "__source", "__size", "__copies")
    own = docs.withColumn("__words", word_count(F.col("text")))
    same = (
        F.col("doc_id").eqNullSafe(F.col("__doc"))
        & F.col("source").eqNullSafe(F.col("__source"))
        & (F.col("__words") == F.col("__size"))
    )
    kept = hash_join_small(own, decided, same)
    return kept.withColumn("__copy", F.explode(F.expr("array_repeat(1, __copies)"))).select(*docs.columns)
