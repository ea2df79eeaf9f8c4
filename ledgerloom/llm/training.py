"""Bounded samples of labelled documents, and small fits on them in numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by_hash(rows: DataFrame, group: str, most: int) -> DataFrame:
    """The ``most`` rows (doc_id, group) of each group that come first in the order of a hash of the id.

    The groups are counted first. Of a large one, only ids whose hash is below a bound that twice as many are expected
    to pass are sorted, so no group of any size meets in one task. There are few groups.
    """
    sizes = rows.groupBy(group).agg(F.count("*").alias("__rows")).withColumnRenamed(group, "__group")
    small = sizes.limit(1001).count() <= 1000
    counted = rows.join(F.broadcast(sizes) if small else sizes, F.col(group) == F.col("__group"))
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
    near = counted.where(place < (2.0 * most + 100) / F.col("__rows"))
    order = Window.partitionBy(group).orderBy(F.xxhash64("doc_id") < 0, F.xxhash64("doc_id"), "doc_id")
    return near.withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= most).select("doc_id", group)


def labelled_sample(labelled: DataFrame, docs: DataFrame, may_learn: Column, per_class: int, longest: int) -> pd.DataFrame:
    """Up to ``per_class`` documents of each label, first in the order of a hash of the id: (doc_id, label, text).

    ``labelled`` has doc_id and label; a document with several labels gets the largest. Null labels and ids, null texts
    and texts of more than ``longest`` bytes are not learned from, so the sample has a bounded size; ids without another
    text leave their places to the next. Rows that share a doc_id give one text, the smallest.
    """
    known = labelled.where(may_learn & F.col("label").isNotNull() & F.col("doc_id").isNotNull())
    texts = docs.select("doc_id", "text").where(F.octet_length("text") <= longest)
    one = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    one = one.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    picked = first_by_hash(one, "label", per_class)
    found = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(
        F.first("label").alias("label"), F.min("text").alias("text")
    )
    return found.toPandas().sort_values("doc_id", kind="stable").reset_index(drop=True)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def slope(margins: np.ndarray, labels: np.ndarray) -> float:
    """The factor that makes sigmoid(factor * margin) likeliest, with a smoothed label so that it stays finite."""
    target = np.where(labels == 1, 0.99, 0.01)
    tries = np.geomspace(0.1, 100, 61)
    loss = [-(target * np.log(p) + (1 - target) * np.log(1 - p)).mean() for p in (sigmoid(margins * t) for t in tries)]
    return float(tries[int(np.argmin(loss))])


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression with intercept last, by Newton steps; classes weigh the same."""
    full = np.column_stack([x, np.ones(len(x))])
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    ridge = np.diag([penalty] * x.shape[1] + [1e-3])
    w = np.zeros(full.shape[1])
    for _ in range(rounds):
        p = sigmoid(full @ w)
        gradient = full.T @ (weight * (p - y)) + ridge @ w
        curve = (full * (weight * p * (1 - p))[:, None]).T @ full + ridge
        step = np.linalg.solve(curve, gradient)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w
