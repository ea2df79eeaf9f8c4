"""Language identification: averaged hashed subword embeddings with a linear softmax.

Subwords are the stretches of two to four bytes of the lower-case words, word edges included. A text is the mean of
their embeddings. Embeddings and softmax are trained by stochastic gradient descent in numpy on a bounded sample,
stratified by language. A part of the sample sets a temperature, so that scores are likelihoods, and the score below
which an answer is rejected. Since mean and softmax input are linear, a trained model is one table of class scores per
subword.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.text_arrays import MIX, chunks
from ledgerloom.llm.training import first_by_hash

PER_LANGUAGE = 600
LONGEST = 32_768
SAMPLE_BYTES = 128 << 20
BUCKET_BITS = 16
WIDTH = 16
UNKNOWN = "und"
TRUSTED = 0.99
PIECES = (20, 80, 400)


def letter_table() -> np.ndarray:
    """A byte's class: A-Z as a-z, a-z and bytes beyond ASCII as they are, everything else a space."""
    table = np.full(256, 32, np.uint8)
    table[97:123], table[65:91], table[128:] = np.arange(97, 123), np.arange(97, 123), np.arange(128, 256)
    return table


def subwords(texts: list[bytes], bucket_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every subword, repeats included, in order of text for each length in turn."""
    sizes = np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts))
    data = letter_table()[np.frombuffer(b"".join(b" " + t + b" " for t in texts), np.uint8)]
    text = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    blank = data == 32
    kept = ~(blank & np.concatenate([[False], blank[:-1] & (text[1:] == text[:-1])]))
    data, text, blank = data[kept].astype(np.uint64), text[kept], blank[kept]
    every_text, every_bucket = [], []
    code = data.copy()
    for n in (2, 3, 4):
        last = len(data) - n + 1
        if last < 1:
            break
        code = code[:last] | (data[n - 1 :] << np.uint64(8 * (n - 1)))
        inner = np.zeros(last, bool)
        for k in range(1, n - 1):
            inner |= blank[k : k + last]
        good = ~inner & (text[:last] == text[n - 1 :]) & ~(blank[:last] & blank[n - 1 :])
        hashed = (code[good] ^ np.uint64(n << 40)) * np.uint64(MIX)
        every_bucket.append((hashed >> np.uint64(64 - bucket_bits)).astype(np.int64))
        every_text.append(text[:last][good])
    if not every_text:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(every_text), np.concatenate(every_bucket)


def bags(texts: list[str | None], bucket_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text the subwords that occur and their shares."""
    out = []
    for _, held in chunks(texts):
        text, bucket = subwords(held, bucket_bits)
        pairs, counts = np.unique((text.astype(np.int64) << bucket_bits) | bucket, return_counts=True)
        cuts = np.searchsorted(pairs >> bucket_bits, np.arange(1, len(held)))
        for at, n in zip(np.split(pairs, cuts), np.split(counts, cuts), strict=True):
            out.append((at & ((1 << bucket_bits) - 1), n / max(1, n.sum())))
    return out


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(unicodedata.category(c)[0] == "L" for c in text)


@dataclass
class Model:
    """table: class scores of each subword; temperature and the score below which an answer is rejected.

    With more languages than an embedding is wide, table holds the embeddings and output makes scores of their mean.
    """

    languages: list[str]
    bucket_bits: int
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject: float = 0.0
    output: np.ndarray | None = None

    def logits(self, texts: list[str | None]) -> np.ndarray:
        out = np.tile(self.bias.astype(np.float64), (len(texts), 1))
        for first, held in chunks(texts):
            text, bucket = subwords(held, self.bucket_bits)
            count = np.maximum(1, np.bincount(text, minlength=len(held)))
            means = np.empty((len(held), self.table.shape[1]))
            for c in range(self.table.shape[1]):
                means[:, c] = np.bincount(text, self.table[:, c][bucket], minlength=len(held)) / count
            out[first : first + len(held)] += means if self.output is None else means @ self.output
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, likelihood and whether it is too low to be trusted."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        likely = softmax(self.logits(texts) / self.temperature)
        best, score = likely.argmax(axis=1), likely.max(axis=1)
        letters = np.array([has_letter(t) for t in texts], bool)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
        score = np.where(letters, score, 0.0)
        return names, score, ~letters | (score < self.reject)


def pieces(text: str) -> list[str]:
    """A text and stretches of it, so that short texts are learned too and count in the calibration."""
    at = len(text) // 3
    return [text] + [text[at : at + size] for size in PIECES if len(text) > 2 * size]


def fit(texts: list[str], languages: list[str], bucket_bits: int = BUCKET_BITS, width: int = WIDTH, seed: int = 4) -> Model:
    names = sorted(set(languages))
    if not names:
        return Model([], bucket_bits, np.zeros((1, 0)), np.zeros(0))
    place = {name: c for c, name in enumerate(names)}
    parts = [(p, place[lang], k) for k, (t, lang) in enumerate(zip(texts, languages, strict=True)) for p in pieces(t)]
    bag, label = bags([p for p, _, _ in parts], bucket_bits), np.array([c for _, c, _ in parts])
    checks = np.array([k % 5 == 4 for _, _, k in parts]) & (len(texts) >= 20)
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (1 << bucket_bits, width))
    output, bias = np.zeros((width, len(names))), np.zeros(len(names))
    share = np.bincount(label, minlength=len(names)) / len(label)
    pace = 1 / np.maximum(share, 1e-9) / len(names)  # rare languages step further
    turns, epochs, done = np.flatnonzero(~checks), 8, 0
    for _ in range(epochs):
        for k in rng.permutation(turns):
            rate = 1.0 * (1 - done / (epochs * len(turns)))
            done += 1
            at, part = bag[k]
            hidden = part @ vectors[at]
            error = softmax(hidden @ output + bias)
            error[label[k]] -= 1
            error *= rate * min(5.0, pace[label[k]])
            back = output @ error
            output -= np.outer(hidden, error)
            bias -= 0.1 * error
            vectors[at] -= (part / max(1e-9, part.max()))[:, None] * back * 0.5
    if len(names) <= width:
        model = Model(names, bucket_bits, (vectors @ output).astype(np.float32), bias)
    else:
        model = Model(names, bucket_bits, vectors.astype(np.float32), bias, output=output)
    tested = np.flatnonzero(checks) if checks.any() else np.arange(len(parts))
    logits, right = model.logits([parts[k][0] for k in tested]), label[tested]
    tries = np.geomspace(0.05, 20, 81)
    loss = [-np.log(softmax(logits / t)[np.arange(len(right)), right] + 1e-6).mean() for t in tries]
    model.temperature = float(tries[int(np.argmin(loss))])
    likely = softmax(logits / model.temperature)
    score, good = likely.max(axis=1), likely.argmax(axis=1) == right
    order = np.argsort(-score)
    trusted = np.flatnonzero(np.cumsum(good[order]) / np.arange(1, len(order) + 1) >= TRUSTED)
    model.reject = float(score[order][trusted[-1]]) if len(trusted) else 1.0
    return model


def learn(
    docs: DataFrame,
    may_learn: Column,
    per_language: int = PER_LANGUAGE,
    longest: int = LONGEST,
    sample_bytes: int = SAMPLE_BYTES,
) -> Model:
    """A model of every language, from texts first in the order of a hash of the id.

    All languages share ``sample_bytes`` evenly, so the sample that reaches the driver is bounded however many there
    are; each has at most ``per_language`` texts, all of its share together. Rows with null lang, id or text are not
    learned from, nor texts of more than ``longest`` bytes or of more than a language's share. Of texts with one id and
    language the least counts.
    """
    known = docs.where(may_learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    languages = known.select("lang").distinct().count()
    share = sample_bytes // max(1, languages)
    known = known.where(F.octet_length("text") <= min(longest, share))
    ids = first_by_hash(known.select("doc_id", "lang").distinct(), "lang", per_language)
    # At most per_language rows of each language from here on.
    found = known.select("doc_id", "lang", "text").join(F.broadcast(ids.select("doc_id", "lang")), ["doc_id", "lang"])
    found = found.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    turn = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id") < 0, F.xxhash64("doc_id"), "doc_id")
    found = found.withColumn("bytes", F.sum(F.octet_length("text")).over(turn.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("bytes") <= share)
    found = found.select("doc_id", "lang", "text").toPandas()
    found = found.sort_values(["doc_id", "lang"], kind="stable")
    return fit(found["text"].tolist(), found["lang"].tolist())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Adds lang_pred, lang_score (0 to 1) and lang_rejected (the score is too low to be trusted).

    Texts that are null, empty or without letters are ``und`` with score 0, rejected; so is everything when no
    language was learned. Texts are read whole. Repeated rows are alike; other columns pass through; an empty table
    stays empty.
    """

    @F.pandas_udf("lang_pred string, lang_score double, lang_rejected boolean")
    def udf(texts: pd.Series) -> pd.DataFrame:
        names, score, rejected = model.predict(texts.tolist())
        return pd.DataFrame({"lang_pred": names, "lang_score": score, "lang_rejected": rejected})

    found = docs.withColumn("__found", udf("text"))
    return found.select(*docs.columns, "__found.lang_pred", "__found.lang_score", "__found.lang_rejected")
