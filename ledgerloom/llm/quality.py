"""Quality classifier: Naive Bayes support vectors.

n-gram indicators are scaled by class log-count ratios; a linear hinge-loss model on them is fitted by dual coordinate
descent. The n-grams are of words (one and two) and of word forms (one and two). A form is which kinds of characters a word holds, its length
to a power of two, and whether it repeats the word before.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text_arrays import Words, chunks, mixed
from ledgerloom.llm.training import labelled_sample, sigmoid, slope

BUCKET_BITS = 18
PER_CLASS = 3000
LONGEST = 32_768


def kinds() -> np.ndarray:
    """A bit per byte: small letter, capital, digit, beyond ASCII, or one of 12 kinds of other characters."""
    other = [1 << (4 + c % 12) for c in range(256)]
    ascii_kinds = [(97, 122, 1), (65, 90, 2), (48, 57, 4), (128, 255, 8)]
    for first, last, bit in ascii_kinds:
        other[first : last + 1] = [bit] * (last - first + 1)
    return np.array(other, np.uint32)


def forms(words: Words, hashes: np.ndarray) -> np.ndarray:
    if not len(hashes):
        return np.empty(0, np.uint64)
    ranges = np.stack([words.starts, words.ends], axis=1).ravel()
    held = np.bitwise_or.reduceat(kinds()[words.raw], ranges)[::2].astype(np.uint64)
    length = np.minimum(np.log2(words.ends - words.starts), 6).astype(np.uint64)
    again = np.zeros(len(hashes), np.uint64)
    again[1:] = (hashes[1:] == hashes[:-1]) & (words.text[1:] == words.text[:-1])
    return mixed(held | (length << np.uint64(32)) | (again << np.uint64(40)))


def indicators(texts: list[bytes], bucket_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every n-gram that occurs in the text, once each, in order of text."""
    words = Words(texts)
    hashes = words.hashes()
    grams = []
    for tag, units in enumerate((forms(words, hashes), hashes)):
        before = np.zeros(len(units), np.uint64)
        before[1:] = np.where(words.text[1:] == words.text[:-1], units[:-1], np.uint64(0))
        grams += [units * np.uint64(2) + np.uint64(tag), (units + before * np.uint64(3)) ^ np.uint64(5 + tag)]
    buckets = mixed(np.concatenate(grams)) >> np.uint64(64 - bucket_bits)
    pairs = np.unique((np.tile(words.text, len(grams)).astype(np.uint64) << np.uint64(bucket_bits)) | buckets)
    return (pairs >> np.uint64(bucket_bits)).astype(np.int64), (pairs & np.uint64((1 << bucket_bits) - 1)).astype(np.int64)


@dataclass
class Model:
    """ratio: log-count ratio of each bucket; weight: the linear model's; without both classes only ``prior`` speaks."""

    bucket_bits: int
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    factor: float
    prior: float | None = None

    def margins(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        for first, held in chunks(texts):
            text, bucket = indicators(held, self.bucket_bits)
            value = self.ratio[bucket]
            length = np.sqrt(np.bincount(text, value * value, minlength=len(held)))
            dot = np.bincount(text, value * self.weight[bucket], minlength=len(held))
            out[first : first + len(held)] = dot / np.where(length > 0, length, 1.0) + self.bias
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        return sigmoid(self.factor * self.margins(texts))


def descend(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int, cost: float, epochs: int, seed: int):
    """Dual coordinate descent for the hinge loss; the bias is the weight of a constant 1. Classes cost the same."""
    sign, weight, bias = 2.0 * labels - 1, np.zeros(size), 0.0
    most = cost * len(labels) / 2 / np.where(labels == 1, max(1, labels.sum()), max(1, (1 - labels).sum()))
    curve = [float(v @ v) + 1 for _, v in rows]
    alpha, rng = np.zeros(len(rows)), np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for k in rng.permutation(len(rows)):
            at, value = rows[k]
            gap = sign[k] * (weight[at] @ value + bias) - 1
            new = min(max(alpha[k] - gap / curve[k], 0.0), most[k])
            step = (new - alpha[k]) * sign[k]
            if step:
                weight[at] += step * value
                bias += step
                moved = max(moved, abs(step))
                alpha[k] = new
        if moved < 1e-4:
            break
    return weight, bias


def fit(texts: list[str | None], labels: np.ndarray, bucket_bits: int = BUCKET_BITS, seed: int = 5) -> Model:
    size, good = 1 << bucket_bits, int(labels.sum())
    if good in (0, len(labels)):
        prior = (good + 1) / (len(labels) + 2)
        return Model(bucket_bits, np.zeros(1), np.zeros(1), 0.0, 1.0, prior)
    rows: list[np.ndarray] = []
    for _, held in chunks(texts):
        text, bucket = indicators(held, bucket_bits)
        cut = np.searchsorted(text, np.arange(1, len(held)))
        rows += np.split(bucket, cut)
    counts = {label: np.ones(size) for label in (0, 1)}
    for bucket, label in zip(rows, labels, strict=True):
        counts[int(label)][bucket] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    scaled = [(b, ratio[b] / max(1e-12, np.sqrt((ratio[b] ** 2).sum()))) for b in rows]
    weight, bias = descend(scaled, labels, size, cost=1.0, epochs=30, seed=seed)
    model = Model(bucket_bits, ratio.astype(np.float32), weight.astype(np.float32), bias, 1.0)
    model.factor = slope(model.margins(texts), labels)
    return model


def learn(
    docs: DataFrame, labels: DataFrame, may_learn: Column, per_class: int = PER_CLASS, longest: int = LONGEST
) -> Model:
    """A model from a bounded sample of ``labels`` (doc_id, label 0 or 1), see ``labelled_sample``."""
    clear = labels.where(F.col("label").isin(0, 1))
    sample = labelled_sample(clear, docs, may_learn, per_class, longest)
    return fit(sample["text"].tolist(), sample["label"].to_numpy(np.int64))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Adds the likelihood of label 1. Null and empty texts get the score of a text without n-grams.

    Without labels of both classes every text gets the smoothed share of label 1 (0.5 without labels). Rows are
    scored one by one: repeated rows alike; other columns pass through; an empty table stays empty.
    """

    @F.pandas_udf("double")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.tolist()))

    return docs.withColumn(name, udf("text"))
