"""Mixing, packing and personal data against brute force, and the pipeline's stages."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import mixing, packing, pii, queries, word_ids

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, row string, base string, p string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "a", "b", "c", "d") for i, t, s in rows], SCHEMA)


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Reshare what is above the caps until none is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    target, left, open_ = {}, share * sum(sizes.values()), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not above:
            return target | {s: level * weight[s] for s in open_}
        for s in above:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= above
    return target


def mix_rows(count=900):
    rng = random.Random(4)
    sources = ["b", "a", None, "É", "z", "aa"]
    rows = [(n, "w " * rng.choice([0, 1, 5, 40, 300, 2500]), "big" if n % 3 == 0 else rng.choice(sources)) for n in range(count)]
    return rows + [(count, None, "a"), (5, rows[5][1], rows[5][2]), (None, "x y", "b"), (count + 1, "  ", "blank")]


@pytest.mark.parametrize("block", [2048, 16])
def test_mix_meets_its_targets(spark, block):
    rows = mix_rows()
    got = mixing.mix(frame(spark, rows), block=block).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    assert len(got) == len(rows) and {r.source for r in got} == set(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r["size"] * r.copies
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.01 * want[s] + 60
    again = mixing.mix(frame(spark, rows).repartition(7), block=block).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_flight_keeps_words_and_documents():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 500, 2000).astype(float)
    p = np.full(2000, 0.37)
    flown = mixing.fly(p, size, rng, land=False)
    assert ((flown > 0) & (flown < 1)).sum() <= 2
    assert abs(flown.sum() - p.sum()) < 1e-6 and abs(flown @ size - p @ size) < 1e-3


def test_mix_of_odd_tables(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    assert [r.copies for r in mixing.mix(frame(spark, [(1, None, None), (2, "", "s")])).collect()] == [0, 0]
    rows = mix_rows(60)
    kept = mixing.mixed_documents(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    copies = {}
    for r in mixing.mix(frame(spark, rows)).collect():
        copies[r.doc_id, r.source] = copies.get((r.doc_id, r.source), 0) + r.copies
    counts = {}
    for r in kept.collect():
        counts[r.doc_id, r.source] = counts.get((r.doc_id, r.source), 0) + 1
    assert counts == {k: n for k, n in copies.items() if n}


WORDS = ["the", "The", "don't", "naïve", "Straße", "x1y2", "e.g.", "(so)", "...", "A" + chr(0x331), "H" + chr(0x331) + ".", "ΣΑΣ", "İx", "<|endoftext|>", "<|ENDOFTEXT|>", "日本語", "a b", " ", "\x1c", "😀!", "“q”", "I'LL,"]


def odd_strings(count):
    """Strings of letters whose small or normal forms are other characters, marks, punctuation, digits and white space."""
    rng = random.Random(6)
    letters = [chr(rng.randrange(0x80, 0x3000)) for _ in range(400)] + list("abcXYZ 019'\"!<|>_-.,\n\t\x1c\x85") + ["the", "'s"]
    letters += [chr(c) for c in (0x130, 0x131, 0x3A3, 0x3C3, 0x3C2, 0xA33, 0x9DD, 0xF69, 0xFB5, 0x4B3, 0x9DF, 0x327, 0x301, 0xFB01, 0xBD)]
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(12))) for _ in range(count)] + ["\u0130.", "\u0a32\u0a3c,", "\u09a2\u09bc,"]


def test_word_ids_are_the_tokenizers():
    tokenizer, rng = Tokenizer.from_file(PATH), random.Random(6)
    texts = ["", None, " \n"] + ["".join(rng.choice(WORDS) + rng.choice([" ", "\n", "", " ", "  "]) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    texts += odd_strings(25_000) + ["x" * 9000, "a b " * 3000]
    coder = word_ids.WordIds(PATH, "<u2")
    for slices in ([texts], [texts[:500], [], texts[500:900]]):  # the second time most are known
        for some in slices:
            found, counts = word_ids.encoded_column(coder, pa.array(some, pa.string()), 2)
            wanted = tokenizer.encode_batch_fast([t or "" for t in some], add_special_tokens=False)
            for want, ids, n in zip(wanted, found.to_pylist(), counts.to_pylist(), strict=True):
                want = want.ids + [2]
                assert np.frombuffer(ids, "<u2").tolist() == want and n == len(want)


def test_word_ids_forget_and_cut_long_texts(monkeypatch):
    monkeypatch.setattr(word_ids, "MOST_KEPT", 50)
    monkeypatch.setattr(word_ids, "CHUNK", 64)
    tokenizer, rng = Tokenizer.from_file(PATH), random.Random(9)
    texts = [" ".join(rng.choice(WORDS) + str(rng.randrange(900)) for _ in range(rng.randrange(80))) for _ in range(60)]
    found, _ = word_ids.encoded_column(word_ids.WordIds(PATH, "<u4"), pa.array(texts).slice(3, 50), 1)
    for t, ids in zip(texts[3:53], found.to_pylist(), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [1]


def test_units_that_share_half_their_hash_are_told_apart(monkeypatch):
    """With a first hash of three values every chunk falls back on both, and the result stays the tokenizer's."""
    whole = word_ids.UnitHash.__call__
    monkeypatch.setattr(word_ids.UnitHash, "__call__", lambda self, *a: (lambda x: (x[0] % np.uint64(3), x[1]))(whole(self, *a)))
    tokenizer, texts = Tokenizer.from_file(PATH), ["the cat, sat", "on 12 mats", "", "the end"]
    coder = word_ids.WordIds(PATH, "<u2")
    for _ in range(2):
        for t in texts:
            found, _ = word_ids.encoded_column(coder, pa.array([t]), 2)
            assert np.frombuffer(found[0].as_py(), "<u2").tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [2]


def pack_rows():
    rng = random.Random(8)
    rows = [(n, " ".join(rng.choices(WORDS[:8], k=rng.choice([0, 3, 60, 700]))), rng.choice(["a", "b", None]) if n % 3 else "big") for n in range(150)]
    return rows + [(200, None, "a"), (201, "", None), (None, "no id", "b"), (7, "another text", "a"), rows[3], (202, "long word " * 9000, "b")]


def test_packing_is_a_round_trip(spark):
    rows, tokenizer = pack_rows(), Tokenizer.from_file(PATH)
    pieces = packing.pack(frame(spark, rows), PATH).collect()
    want = {}
    for i, t, _ in rows:
        want.setdefault(i, []).append(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])
    windows, found = {}, {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length and p.offset + p.length <= 2048
        windows.setdefault(p.sequence_id, []).append((p.offset, p.length))
        found.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, ids))
    for places in windows.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
    full = [sum(n for _, n in w) == 2048 for k, w in sorted(windows.items())]
    assert sorted(windows) == list(range(len(windows))) and all(full[:-1])
    for (doc, n), parts in found.items():
        # Texts of one id and length are told apart by their ids.
        whole = [ids for ids in want[doc] if len(ids) == n]
        assert sorted(x for s, ids in parts for x in ids) == sorted(x for ids in whole for x in ids)
        if len(whole) == 1:
            assert [x for _, ids in sorted(parts) for x in ids] == whole[0]
    assert packing.pack(frame(spark, []), PATH).count() == 0


def test_windows_follow_the_proportions(spark):
    rows = [(n, " ".join(["the"] * 39), "a" if n % 4 else "b") for n in range(4000)]
    unweighted = packing.pack(frame(spark, rows), PATH, weights={"b": 1}).toPandas()  # a source left out is served last
    assert unweighted[unweighted["doc_id"] % 4 == 0]["sequence_id"].max() <= unweighted[unweighted["doc_id"] % 4 > 0]["sequence_id"].min()
    for weights, share in ((None, 0.25), ({"a": 1, "b": 1}, 0.5)):
        pieces = packing.pack(frame(spark, rows), PATH, weights=weights).toPandas()
        pieces["b"] = (pieces["doc_id"] % 4 == 0) * pieces["length"]
        part = pieces.groupby("sequence_id")["b"].sum().sort_index().iloc[:35] / 2048
        assert (abs(part - share) < 0.06).all() and abs(part.mean() - share) < 0.005


# The base patterns as they are stated.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def stated_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(STATED.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            if kind == "card":
                twice = [int(d) * (1 + n % 2) for n, d in enumerate(reversed(digits))]
                if not 14 <= len(digits) <= 19 or sum(x - 9 * (x > 9) for x in twice) % 10:
                    continue
            found.append((m.start(), order, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def pii_texts():
    rng = random.Random(9)
    bits = ["a@b.c", "a@b.c_d@e.f", "x@y", "@", ".", "1.2.3.4", "300.1.2.3.4", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1111", "41111111111111111112", "4111  1111 1111 1111", "+1 (555) 010-9999", "+49 30 123456", "+", "12", " ", "\n", "-", "5", "é", "😀", "a", "0000000001.2.3.4", "(", ")"]
    return ["".join(rng.choice(bits) + rng.choice(["", "", " "]) for _ in range(rng.randint(0, 40))) for _ in range(400)]


def test_base_spans_are_those_of_the_stated_patterns(spark):
    rows = [(n, t, "s") for n, t in enumerate(pii_texts())]
    rows += [(900, None, "s"), (901, "", None), (902, "1" * 60_000, "s"), (903, "1 2 " * 30_000, "s"), (904, "a" * 200_000 + "@b.c", "s"), (None, "a@b.c", "s"), rows[5]]
    found = pii.find(frame(spark, rows))
    got = found.select("doc_id", pii.listed(found["base"]).alias("spans")).collect()
    assert sorted(((r.doc_id, r.spans) for r in got), key=repr) == sorted(((i, stated_spans(t)) for i, t, _ in rows), key=repr)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert pii.find(frame(spark, [])).count() == 0


def brute_words(text, start, size):
    """The last two whole words on the line among the characters before a position."""
    first = max(0, start - size)
    words = [(m.start(), m.end()) for m in re.finditer(r"[^\W\d_]+", text[:start])]
    line = text.rfind("\n", 0, start) + 1
    return [text[a:b].lower() for a, b in words if a >= max(first, line)][-2:]


def test_mentions_and_their_contexts_are_those_of_brute_force(spark):
    rng = random.Random(11)
    bits = ["a@b.c", "mail", "x (at) y (dot) z", "555-010-9999", "1.2.3.4", "+1 555 010 9999", "4111 1111 1111 1111", "call é me", "\n", "ab:cd:ef:01:2", "😀 7", "q" * 30]
    shapes = pii.SHAPES.replace(r"(?:\G|(?<![A-Za-z0-9._%+-]))", "")  # the guard only saves time
    texts = ["".join(rng.choice(bits) + rng.choice([" ", " ", "", ", "]) for _ in range(rng.choice([3, 20, 700]))) for _ in range(60)]
    rows = [(n, t, "s") for n, t in enumerate([*texts, None, ""])]
    for size in (7, 200):
        for row in pii.scanned(frame(spark, rows), size).collect():
            text = rows[row.doc_id][1] or ""
            base = [(s.start, s.stop) for s in row.base]
            shaped = [(m.start(), m.end()) for m in re.finditer(shapes, text)]
            clear = [(a, b) for a, b in shaped if not any(c < b and a < d for c, d in base)]
            assert sorted((m.start, m.stop) for m in row.mentions if m.kind < 0) == clear
            assert [(m.start, m.stop) for m in row.mentions if m.kind >= 0] == base
            for m in row.mentions:
                assert text[m.start : m.stop] == m.value
                words = brute_words(text, m.start, size)
                assert m.contexts == [*words[-1:], *([" ".join(words)] if len(words) == 2 else [])]


def test_one_long_line_of_identifiers(spark):
    text = "".join(f"é mail ab{n}@cd.org or call +49 30 {1000000 + n} now, " for n in range(15_000))
    found = pii.find(frame(spark, [(1, text, "s")]))
    row = found.select(pii.listed(found["base"]).alias("spans"), pii.count_of(found["base"], 0).alias("mails")).collect()[0]
    assert row.mails == 15_000 and row.spans == stated_spans(text)


def test_patterns_discover_unseen_identifiers(spark):
    rows = [(n, f"note {n}\nplease call me +1 555 010 {1000 + n}\nthank you {n}", "s") for n in range(40)]
    rows += [(100, "please call me 555-010-9999 today", "s"), (101, "there were 555-010-9999 of them", "s"), (102, "please call me", "s")]
    rows += [(200 + n, f"reach me at user{n}@mail.example", "s") for n in range(12)] + [(300, "reach me at user(at)mail(dot)example", "s")]
    found = pii.find(frame(spark, rows))
    spans = {r.doc_id: r.spans for r in found.select("doc_id", pii.listed(found["found"]).alias("spans")).collect()}
    assert spans[100] == "phone:15:27" and spans[101] == "" and spans[102] == "" and spans[300] == "email:12:36"
    base = {r.doc_id: r.spans for r in found.select("doc_id", pii.listed(found["base"]).alias("spans")).collect()}
    assert all(base[n] == spans[n] != "" for n in [*range(40), *range(200, 212)])


def test_pipeline_stages_keep_the_columns_and_do_their_work(spark):
    import corpus_pipeline
    from ledgerloom.llm.common import store

    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    columns, counts = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, store(stage(spark, docs, folder), f"test-{name}")
        assert docs.columns == columns
        counts.append((before.count(), docs.count()))
        if name == "toxicity":
            kept = {r.doc_id for r in docs.select("doc_id").collect()}
            clean = [i for i, t in labels.items() if t == 0]
            assert sum(i in kept for i in clean) > 0.97 * len(clean)
        if name == "simhash_near_dedup":
            ids = [r.doc_id for r in docs.select("doc_id").collect()]
            assert len(ids) == len(set(ids))
    assert counts[0][0] > counts[0][1] == counts[1][1] > counts[2][1]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert last.count() > 0


def test_op6_and_op9_digest_columns(spark):
    taken = queries.QUERIES["op6_mixing"](spark, "/root/testdata/sf0.001")
    assert {"doc_id", "size", "source_size", "target", "taken"} <= set(taken.columns)
    pieces = queries.QUERIES["op9_packing"](spark, "/root/testdata/sf0.001")
    assert dict(pieces.dtypes)["ids_crc32"] == "bigint"
    found = queries.QUERIES["op10_pii"](spark, "/root/testdata/sf0.001").first()
    assert len(found.base_sha256) == len(hashlib.sha256(b"").hexdigest())
