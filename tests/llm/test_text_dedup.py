"""Line dedup and SimHash against brute force."""

import hashlib
import random
import re

import pytest
import xxhash

from ledgerloom.llm import line_dedup, simhash
from ledgerloom.llm.common import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, n_lines string, version string, rank string"


def frame(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "a", "b", "c") for i, t in rows], DOCS)


def brute_lines(rows):
    def key(line):
        return line.strip("\t\n\x0b\x0c\r ").translate(LOWER)

    owner = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            if len(k) >= 10:
                owner[k] = min(owner.get(k, i), i, key=lambda x: (x is None, x))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or owner[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


LINES = ["short", "  A line that REPEATS \t", "a line that repeats", "É une ligne répétée", "é une ligne répétée", "", " ", "other line here", "123456789", "1234567890"]


def line_rows():
    rng = random.Random(3)
    rows = [(n, "\n".join(rng.choices(LINES, k=rng.randint(0, 90)))) for n in range(60)]
    rows += [(60, None), (61, ""), (None, "a line that repeats\nonly in the one without id"), (7, rows[7][1]), (8, "another text\nother line here")]
    return rows + [(62, "word " * 50_000 + "\na line that repeats")]


def test_line_dedup_is_brute_force(spark):
    rows = line_rows()
    got = line_dedup.dedup_lines(frame(spark, rows).drop("n_lines"))
    assert {"lang", "version", "rank"} <= set(got.columns)
    seen = [(r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in got.collect()]
    assert sorted(seen, key=repr) == brute_lines(rows)
    assert line_dedup.dedup_lines(frame(spark, []).drop("n_lines")).count() == 0


def test_line_dedup_uses_no_python_and_limits_before_the_shuffle(spark):
    plan = line_dedup.keep_bitmaps(frame(spark, line_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "rangepartitioning" in plan
    assert plan.count("WindowGroupLimit") >= 3


def brute_fingerprint(text, n):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[k : k + n]) for k in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    bits = [sum(h >> b & 1 for h in hashes) for b in range(64)]
    return sum(1 << b for b in range(64) if bits[b] * 2 > len(hashes))


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def texts():
    rng = random.Random(5)
    words = [f"w{n}" for n in range(400)]
    base = [rng.choices(words, k=rng.randint(1, 120)) for _ in range(40)]
    out = [" ".join(b) for b in base]
    for b in base * 3:
        b = list(b)
        for _ in range(rng.randint(0, 2)):
            b[rng.randrange(len(b))] = rng.choice(words)
        out.append(" ".join(b))
    return out + [None, "", " \t\n", "one", "One", "one two", "É", "é"]


def test_simhash_components_are_those_of_brute_force(spark):
    rows = list(enumerate(texts()))
    prints = {i: brute_fingerprint(t, 3) for i, t in rows}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    want = union_find(list(prints), links)
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    assert {r.doc_id: r.fp & (2**64 - 1) for r in got} == prints
    assert {r.doc_id: r.component_id for r in got} == want and len(links) > 30


@pytest.mark.parametrize("max_bits,bucket", [(1, 256), (2, 256), (2, 1), (3, 256)])
def test_links_connect_all_pairs_within_reach(spark, max_bits, bucket):
    rng = random.Random(max_bits)
    values = {0}
    for _ in range(25):
        v = rng.getrandbits(64)
        values.add(v)
        for _ in range(8):
            w = v
            for b in rng.sample(range(64), rng.randint(1, 4)):
                w ^= 1 << b
            values.add(w)
    signed = [v - 2**64 if v >> 63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), max_bits, bucket).collect()
    close = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= max_bits]
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= max_bits for r in found)
    assert union_find(signed, [(r.a, r.b) for r in found]) == union_find(signed, close)


def test_simhash_of_odd_tables(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    got = simhash.near_duplicates(frame(spark, [(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (9, "x" * 200_000)]))
    assert sorted((r.doc_id or 0, r.component_id) for r in got.collect()) == [(0, 4), (4, 4), (4, 4), (9, 9)]


def test_components_of_paths_stars_and_rings(spark):
    edges = [(n, n + 1) for n in range(1, 40)] + [(100, n) for n in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    got = components(spark.createDataFrame([*edges, (None, 3)], "a long, b long")).collect()
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert {r.node: r.root for r in got} == union_find(nodes, edges) and len(got) == len(nodes)


def test_one_document_of_each_component_stays(spark):
    origin = " ".join(f"w{k}" for k in range(400))
    rows = [(n, origin.replace("w7 ", f"e{n % 3} ")) for n in range(30)] + [(50 + n, f"own text number {n} of its kind") for n in range(9)]
    rows += [(None, origin), (None, "no id"), (90, None), (91, ""), (92, " \t"), (60, "another text of id sixty"), (3, origin), rows[3], rows[33]]
    classes = {}
    for r in simhash.near_duplicates(frame(spark, rows)).collect():
        classes.setdefault((r.component_id, r.doc_id), 0)
    got = simhash.without_near_duplicates(frame(spark, rows))
    assert got.columns == frame(spark, []).columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    prints = {t: simhash.fingerprint_of(simhash.shingle_hashes(t, 3)) for _, t in rows}
    links = [(a, b) for a in set(prints.values()) for b in set(prints.values()) if a < b and (a ^ b).bit_count() <= 2]
    root = union_find(set(prints.values()), links)
    groups = {}
    for i, t in rows:
        groups.setdefault(root[prints[t]], set()).add((i is None, i if i is not None else 0))
    assert sorted((i is None, i or 0) for i, _ in kept) == sorted(min(g) for g in groups.values())
    assert len({root[prints[t]] for _, t in kept}) == len(kept)
    assert simhash.without_near_duplicates(frame(spark, [])).count() == 0
