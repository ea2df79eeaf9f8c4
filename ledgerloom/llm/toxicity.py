"""Toxicity: Levenshtein automata intersected with a trie of a learned lexicon, scored in context windows.

The lexicon is learned from labelled documents: words whose share of toxic documents is far above the average. Words of
a text run through the intersection of the trie with a Levenshtein automaton, made deterministic as it is used: all
words of a chunk take a step at a time in numpy and most end after two or three letters. So misspelled terms are
found at the same price. Near words that are common in harmless documents are learned as exceptions. Hits within a
window of words add up; a hit inside quotation marks or behind a reporting word counts less, one beside a word of
address more. A logistic regression on window and document sums gives the score.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.training import labelled_sample, logistic, sigmoid

PER_CLASS = 3000
LONGEST = 32_768
WINDOW = 10
CHUNK_CHARS = 1 << 19
# Symbols that stand for letters inside words, quotation marks, reporting words, words of address.
INNER = "@$!*|+"
QUOTES = "\"“”„«»‟‹›"
REPORTING = "said says wrote writes quoted quote called calls sagte schrieb nannte zitiert dit écrit appelé dijo escribió llamó"
ADDRESS = "you your you're du dich dein ihr euch tu toi vous votre tú usted vosotros"
QUOTED, ADDRESSED, MISSPELLED = 0.35, 1.25, 0.7


def edits(term: str) -> int:
    """Errors allowed: none below 4 letters, one below 9, then two."""
    return 0 if len(term) < 4 else 1 if len(term) < 9 else 2


class Automaton:
    """The trie of terms with Levenshtein errors, determinised step by step.

    A state is a set of trie nodes with the fewest errors so far, as numbers 4 * node + errors, as far as a term below the
    node still allows them. State 0 is dead, state 1 the start. ``found[state]`` is (errors, term) of the best term.
    """

    def __init__(self, terms: list[str]) -> None:
        self.terms = terms
        self.child: list[dict[str, int]] = [{}]
        self.term: list[int] = [-1]
        self.allowed: list[int] = [0]
        for k, word in enumerate(terms):
            node, path = 0, [0]
            for letter in word:
                if letter not in self.child[node]:
                    self.child[node][letter] = len(self.child)
                    self.child.append({})
                    self.term.append(-1)
                    self.allowed.append(0)
                node = self.child[node][letter]
                path.append(node)
            self.term[node] = k
            for n in path:
                self.allowed[n] = max(self.allowed[n], edits(word))
        letters = sorted({c for w in terms for c in w})
        self.letters = ["", *letters]
        self.symbol = np.zeros(0x110000, np.int16)
        for k, c in enumerate(letters):
            self.symbol[ord(c)] = k + 1
        self.numbers: dict[frozenset, int] = {frozenset(): 0}
        self.states: list[frozenset] = [frozenset()]
        self.found: list[tuple[int, int] | None] = [None]
        self.table = np.full((64, len(self.letters)), -1, np.int32)
        self.table[0] = 0
        self.number(self.closed({0: 0}))

    def closed(self, nodes: dict[int, int]) -> frozenset:
        """With the nodes that missing letters reach, an error each."""
        queue = list(nodes.items())
        while queue:
            node, errors = queue.pop()
            if errors > nodes[node]:
                continue
            for below in self.child[node].values():
                if errors + 1 <= self.allowed[below] and errors + 1 < nodes.get(below, 9):
                    nodes[below] = errors + 1
                    queue.append((below, errors + 1))
        return frozenset(4 * n + e for n, e in nodes.items() if e <= self.allowed[n])

    def number(self, state: frozenset) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            at = [(s % 4, self.term[s // 4]) for s in state]
            ends = [(e, term) for e, term in at if term >= 0 and e <= edits(self.terms[term])]
            self.found.append(min(ends) if ends else None)
            if len(self.states) > len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
        return self.numbers[state]

    def step(self, state: int, symbol: int) -> int:
        letter, after = self.letters[symbol], {}
        for node, errors in (divmod(s, 4) for s in self.states[state]):
            moves = [(node, errors + 1)]
            moves += [(below, errors + (c != letter)) for c, below in self.child[node].items()]
            for n, e in moves:
                if e <= self.allowed[n] and e < after.get(n, 9):
                    after[n] = e
        return self.number(self.closed(after))

    def run(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The state in which each word ends; ``symbols`` are those of the text."""
        final = np.zeros(len(starts), np.int32)
        word, at, state = np.arange(len(starts)), starts, np.ones(len(starts), np.int32)
        while len(word):
            symbol = symbols[at]
            after = self.table[state, symbol]
            if (after < 0).any():
                new = np.flatnonzero(after < 0)
                for s, c in set(zip(state[new].tolist(), symbol[new].tolist(), strict=True)):
                    self.table[s, c] = self.step(s, c)  # step may replace the table by a longer one
                after = self.table[state, symbol]
            at = at + 1
            ended = at >= ends[word]
            final[word[ended]] = after[ended]
            going = ~ended & (after > 0)
            word, at, state = word[going], at[going], after[going]
        return final


def word_tables() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: whether words may hold it, and whether they may begin and end with it."""
    solid = np.zeros(0x110000, bool)
    solid[:0x10000] = [chr(c).isalnum() for c in range(0x10000)]
    solid[0x10000:] = True
    loose = solid.copy()
    loose[[ord(c) for c in INNER]] = True
    return loose, solid


class Reader:
    """Cuts texts into lower-case words of letters, digits and inner symbols."""

    def __init__(self) -> None:
        self.loose, self.solid = word_tables()

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Code points of all texts, and start, end and text of each word."""
        lower = [t.lower() for t in texts]
        codes = np.frombuffer(("\n".join(lower) + "\n").encode("utf-32-le", "replace"), np.uint32)
        edge = np.diff(self.loose[codes].astype(np.int8), prepend=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # The first and the last solid character of each stretch; none of the passes depends on how long a run is.
        solid = np.concatenate([np.flatnonzero(self.solid[codes]), [len(codes)]])
        starts = np.minimum(solid[np.searchsorted(solid, starts)], ends)
        before = np.searchsorted(solid, ends) - 1
        ends = np.maximum(np.where(before < 0, 0, solid[before] + 1), starts)
        kept = starts < ends
        starts, ends = starts[kept], ends[kept]
        limits = np.cumsum([len(t) + 1 for t in lower])
        return codes, starts, ends, np.searchsorted(limits, starts, side="right")


def spelled(codes: np.ndarray, start: int, end: int) -> str:
    return codes[start:end].tobytes().decode("utf-32-le", "replace")


@dataclass
class Model:
    """terms with their weights, spelled right and nearly right, exceptions with theirs, and the regression."""

    terms: list[str]
    weights: list[float]
    near: list[float]
    exceptions: dict[str, float]
    regression: np.ndarray
    window: int = WINDOW
    prior: float | None = None
    tools: dict = field(default_factory=dict)

    def __getstate__(self) -> dict:
        """The automaton travels with the states it has, the reader's tables are made anew."""
        return {**self.__dict__, "tools": {k: v for k, v in self.tools.items() if k != "reader"}}

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Per text: best window, sum of quoted hits, hits a hundred words by weight; misspelled hits count in each."""
        if "automaton" not in self.tools:
            self.tools["automaton"] = Automaton(self.terms)
        if "reader" not in self.tools:
            self.tools["reader"] = Reader()
        out, held, first, size = np.zeros((len(texts), 3)), [], 0, 0
        for k, text in enumerate(texts):
            held.append(text or "")
            size += len(held[-1])
            if size >= CHUNK_CHARS or k == len(texts) - 1:
                self.measure(held, out[first : k + 1])
                held, first, size = [], k + 1, 0
        return out

    def measure(self, texts: list[str], out: np.ndarray) -> None:
        automaton, reader = self.tools["automaton"], self.tools["reader"]
        codes, starts, ends, text_of = reader.read(texts)
        final = automaton.run(automaton.symbol[codes], starts, ends)
        accepted = np.array([f is not None for f in automaton.found])
        hits = np.flatnonzero(accepted[final])
        per_text = defaultdict(list)
        for h in hits.tolist():
            per_text[int(text_of[h])].append(h)
        n_words = np.bincount(text_of, minlength=len(texts))
        for text, own in per_text.items():
            out[text] = self.weigh(own, codes, starts, ends, text_of, final, int(n_words[text]))

    def weigh(self, hits, codes, starts, ends, text_of, final, n_words) -> list[float]:
        automaton, text = self.tools["automaton"], int(text_of[hits[0]])
        quoted = 0.0
        placed: list[tuple[int, float]] = []
        for h in hits:
            errors, term = automaton.found[final[h]]
            surface = spelled(codes, starts[h], ends[h])
            weight = self.exceptions.get(surface, self.weights[term] if not errors else self.near[term] / errors)
            if weight <= 0:
                continue
            around = range(max(0, h - self.window), min(len(starts), h + self.window + 1))
            around = [w for w in around if text_of[w] == text]
            left = spelled(codes, starts[around[0]], starts[h])
            right = spelled(codes, ends[h], ends[around[-1]])
            marks = [sum(side.count(q) for q in QUOTES) for side in (left, right)]
            said = any(w in self.reporting for w in left.split()) and marks[0] > 0
            within = said or (marks[0] % 2 == 1 and marks[1] > 0)
            if within:
                quoted += weight
                weight *= QUOTED
            elif any(w.strip(".,!?") in self.address for w in (left + " " + right).split()):
                weight *= ADDRESSED
            placed.append((h, weight))
        best = 0.0
        for k, (h, _) in enumerate(placed):
            best = max(best, sum(w for o, w in placed[max(0, k - self.window) : k + 1] if h - o <= self.window))
        strength = sum(w for _, w in placed) / max(self.weights)
        return [best, math.log1p(quoted), min(10.0, 100 * strength / max(1, n_words))]

    reporting = frozenset(REPORTING.split())
    address = frozenset(ADDRESS.split())

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        return sigmoid(self.features(texts) @ self.regression[:-1] + self.regression[-1])


def word_counts(texts: list[str], labels: np.ndarray) -> tuple[Counter, Counter]:
    """Documents that hold each word: all, and those with label 1."""
    every, toxic, reader = Counter(), Counter(), Reader()
    for text, label in zip(texts, labels.tolist(), strict=True):
        codes, starts, ends, _ = reader.read([text])
        words = {spelled(codes, s, e) for s, e in zip(starts, ends, strict=True)}
        every.update(words)
        if label:
            toxic.update(words)
    return every, toxic


def fit(texts: list[str], labels: np.ndarray, least: int = 3) -> Model:
    positive = int(labels.sum())
    if positive in (0, len(labels)):
        return Model([], [], [], {}, np.zeros(4), prior=(positive + 1) / (len(labels) + 2))
    every, toxic = word_counts(texts, labels)
    share = positive / len(labels)

    def odds(word: str) -> float:
        t, n = toxic[word], every[word]
        return math.log((t + 0.5) / (n - t + 0.5) / (share / (1 - share)))

    def z(word: str) -> float:
        n = every[word]
        return (toxic[word] - n * share) / math.sqrt(n * share * (1 - share) + 1)

    ranked = sorted(((z(w), w) for w, n in toxic.items() if n >= least and not w.isdigit()), reverse=True)
    terms = [w for value, w in ranked if value > 2.5 and odds(w) > 1.5 and len(w) > 1]
    weights = [odds(w) for w in terms]
    automaton, reader, exceptions = Automaton(terms), Reader(), {}
    close = np.zeros((len(terms), 2))  # documents with words near the term: harmless, toxic
    if terms:
        codes, starts, ends, _ = reader.read(list(every))
        final = automaton.run(automaton.symbol[codes], starts, ends)
        known = set(terms)
        for k in np.flatnonzero(np.array([f is not None for f in automaton.found])[final]).tolist():
            word = spelled(codes, starts[k], ends[k])
            if word not in known:
                close[automaton.found[final[k]][1]] += every[word] - toxic[word], toxic[word]
                if every[word] > toxic[word]:
                    exceptions[word] = odds(word) if odds(word) > 1.5 else 0.0
    base = math.log(share / (1 - share))
    near = []
    for weight, (harmless, bad) in zip(weights, close, strict=True):
        seen = math.log((bad + 0.5) / (harmless + 0.5)) - base if harmless + bad else math.inf
        near.append(max(0.0, min(MISSPELLED * weight, seen)))
    model = Model(terms, weights, near, exceptions, np.zeros(4), tools={"automaton": automaton, "reader": reader})
    model.regression = logistic(model.features(texts), labels)
    return model


def learn(
    docs: DataFrame, labels: DataFrame, may_learn: Column, per_class: int = PER_CLASS, longest: int = LONGEST
) -> Model:
    """A model from a bounded sample of ``labels`` (doc_id, label 0 or 1), see ``labelled_sample``."""
    clear = labels.where(F.col("label").isin(0, 1))
    sample = labelled_sample(clear, docs, may_learn, per_class, longest)
    return fit(sample["text"].tolist(), sample["label"].to_numpy(np.int64))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Adds the likelihood that a text is toxic. Null, empty and very long texts are scored whole like any other.

    A text without hits gets the regression's base. Without labels of both classes every text gets the smoothed share
    of label 1 (0.5 without labels). Repeated rows score alike; other columns pass through; an empty table stays empty.
    """

    @F.pandas_udf("double")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.tolist()))

    return docs.withColumn(name, udf("text"))
