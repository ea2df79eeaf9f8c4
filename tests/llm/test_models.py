"""Language, quality and toxicity: held-out accuracy on the given tables, and odd input."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import language, quality, queries, toxicity
from ledgerloom.llm.text_arrays import Words
from ledgerloom.llm.training import labelled_sample

FOLDER = "/root/testdata/sf0.1"
ODD = [None, "", " \n", "123 !?", "word " * 60_000, "é", "\U0001f600"]


@pytest.fixture(scope="module")
def truth():
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet", columns=["doc_id", "lang"])
    return docs.merge(pd.read_parquet(f"{FOLDER}/labels.parquet"), how="left")


def result(spark, name, truth):
    found = queries.QUERIES[name](spark, FOLDER).toPandas().merge(truth)
    assert len(found) == len(truth) and found["score"].between(0, 1).all()
    return found[found["held_out"]]


def test_language_on_held_out_documents(spark, truth):
    held = result(spark, "op4_language", truth)
    assert (held["lang"] == held["lang_pred"]).mean() > 0.99
    # Scores are likelihoods: on average as high as answers are right.
    assert abs(held["score"].mean() - (held["lang"] == held["lang_pred"]).mean()) < 0.02


def test_quality_on_held_out_documents(spark, truth):
    held = result(spark, "op5_quality", truth).dropna(subset=["quality"])
    assert (held["predicted"] == held["quality"]).mean() > 0.98
    assert held[held["quality"] == 1]["predicted"].mean() > 0.99


def test_toxicity_on_held_out_documents(spark, truth):
    held = result(spark, "op8_toxicity", truth).dropna(subset=["toxic"])
    assert held[held["toxic"] == 1]["predicted"].mean() > 0.9
    assert held[held["toxic"] == 0]["predicted"].mean() < 0.02


def insults():
    rng = random.Random(1)
    words = [f"{a}{b}ing" for a in ("ret", "san", "mol", "ked", "vur") for b in ("a", "o", "un", "es")]
    clean = [" ".join(rng.choices(words, k=60)) for _ in range(200)]
    toxic = []
    for _ in range(80):
        text = rng.choices(words, k=60)
        for _ in range(3):
            text[rng.randrange(60)] = rng.choice(["grumbold", "snarkwit"])
        toxic.append(" ".join(text))
    return clean + toxic, np.array([0] * 200 + [1] * 80), words


def test_toxicity_finds_misspelled_terms_and_spares_quotations():
    texts, labels, words = insults()
    model = toxicity.fit(texts, labels)
    filler = " ".join(words[:20])
    clean, plain, wrong, twice, quoted = model.scores(
        [filler, f"{filler} grumbold snarkwit {filler}", f"{filler} grumb0ld snarkwitt {filler}", f"{filler} Grumbold! SNARKWIT {filler}", f'{filler} he said "grumbold snarkwit" {filler}']
    )
    assert clean < 0.5 < plain and wrong > 0.5 and twice == plain and clean <= quoted < plain
    assert all(0 <= s <= 1 for s in model.scores(ODD))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row[0], last = i, i - 1
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_is_the_edit_distance():
    rng = random.Random(2)
    terms = ["".join(rng.choices("abc", k=rng.randint(2, 11))) for _ in range(30)]
    automaton, reader = toxicity.Automaton(terms), toxicity.Reader()
    words = ["".join(rng.choices("abcd", k=rng.randint(1, 12))) for _ in range(1500)] + terms
    codes, starts, ends, _ = reader.read(words)
    final = automaton.run(automaton.symbol[codes], starts, ends)
    for word, state in zip(words, final.tolist()):
        near = [d for t in terms if (d := distance(word, t)) <= toxicity.edits(t)]
        found = automaton.found[state]
        assert (found[0] if found else None) == (min(near) if near else None)


def test_words_are_hashed_alike_wherever_they_stand():
    words = Words([b"abc  Abc\tx", b"", b"abc", "é abc".encode()])
    h = words.hashes()
    assert h[0] == h[1] == h[3] == h[5] and len(set(h.tolist())) == 3 and words.text.tolist() == [0, 0, 0, 2, 3, 3]


def test_models_take_odd_texts_and_no_labels(spark):
    docs = spark.createDataFrame([(n, t, None) for n, t in enumerate(ODD)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, None)], "doc_id long, label int")
    everyone = F.lit(True)
    assert {r.score for r in quality.score(docs, quality.learn(docs, labels, everyone)).collect()} == {0.5}
    assert {r.score for r in toxicity.score(docs, toxicity.learn(docs, labels, everyone)).collect()} == {0.5}
    got = language.identify(docs, language.learn(docs, everyone)).collect()
    assert {(r.lang_pred, r.lang_score, r.lang_rejected) for r in got} == {("und", 0.0, True)}
    model = language.fit(["the house and the dog"] * 30 + ["das haus und der hund"] * 30, ["en"] * 30 + ["de"] * 30)
    names, scores, rejected = model.predict([*ODD, "und das haus", "and the house"])
    assert names[:4] == ["und"] * 4 and names[-2:] == ["de", "en"] and all(rejected[:4])
    texts, labels, _ = insults()
    assert all(0 <= s <= 1 for s in quality.fit(texts, labels).scores(ODD))
    empty = docs.limit(0)
    for scored in (quality.score(empty, quality.fit(texts, labels)), language.identify(empty, model), toxicity.score(empty, toxicity.fit(texts, labels))):
        assert scored.count() == 0


def test_labelled_sample_is_as_large_as_usable_texts_allow(spark):
    texts = [(n, None if n % 8 == 0 else "x" * (5 if n % 4 == 1 else 500)) for n in range(80)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(n, n // 40 % 2) for n in range(160)], "doc_id long, label int")
    sample = labelled_sample(labels, docs, F.lit(True), per_class=8, longest=100)
    assert sample["label"].value_counts().to_dict() == {0: 8, 1: 8} and set(sample["text"]) == {"xxxxx"}


def test_toxicity_keeps_every_telling_term():
    rng = random.Random(23)
    clean_words, telling = (["".join(rng.choices("bcdfghklmnprstvw", k=9)) for _ in range(n)] for n in (60, 800))
    texts = [rng.choices(clean_words, k=40) for _ in range(2000)]
    order = telling * 8
    for n, text in enumerate(texts[:800]):
        text[5:35:4] = order[8 * n : 8 * n + 8]
    texts, labels = [" ".join(t) for t in texts], np.array([1] * 800 + [0] * 1200)
    model = toxicity.fit(texts, labels)
    assert set(telling) <= set(model.terms)
    filler = " ".join(clean_words[:30])
    scores = model.scores([filler, *(f"{filler} {word} {word} {filler}" for word in telling)])
    assert scores[0] < 0.5 and (scores[1:] > scores[0]).all()


def test_every_language_is_learned_within_the_bytes_of_the_sample(spark):
    rng = random.Random(3)
    words = {f"l{n:03d}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)] for n in range(400)}
    rows = [(k * 400 + n, " ".join(rng.choices(w, k=12)), lang) for n, (lang, w) in enumerate(words.items()) for k in range(5)]
    docs = spark.createDataFrame([*rows, (-1, None, "l000"), (-2, "x", None), (None, "x", "none")], "doc_id long, text string, lang string")
    model = language.learn(docs, F.lit(True), per_language=4)
    assert model.languages == sorted(words) and model.table.shape[1] == language.WIDTH
    fresh = [(" ".join(rng.choices(w, k=20)), lang) for lang, w in words.items()]
    assert np.mean([p == lang for p, (_, lang) in zip(model.predict([t for t, _ in fresh])[0], fresh, strict=True)]) > 0.9
    # Each language's share of the bytes holds two of its texts.
    taken = []
    fit, language.fit = language.fit, lambda texts, languages: taken.extend(zip(texts, languages, strict=True))
    try:
        language.learn(docs, F.lit(True), sample_bytes=400 * 170)
    finally:
        language.fit = fit
    assert {lang for _, lang in taken} == set(words) and all(sum(len(t) for t, of in taken if of == lang) <= 170 for lang in list(words)[:40])


def test_words_are_trimmed_as_symbol_by_symbol():
    reader = toxicity.Reader()
    rng = random.Random(8)
    texts = ["".join(rng.choices("ab1*@$.-' \n", k=rng.randrange(60))) for _ in range(300)] + ["*" * 1_000_000 + " " + "word " * 100_000, "", "**"]
    codes, starts, ends, of = reader.read(texts)
    got = [(toxicity.spelled(codes, a, b), int(t)) for a, b, t in zip(starts, ends, of, strict=True)]
    want = []
    for n, text in enumerate(texts):
        run = ""
        for c in text.lower() + "\n":
            if reader.loose[ord(c)]:
                run += c
                continue
            while run and not reader.solid[ord(run[0])]:
                run = run.lstrip(run[0])
            while run and not reader.solid[ord(run[-1])]:
                run = run.rstrip(run[-1])
            want += [(run, n)] if run else []
            run = ""
    assert got == want
