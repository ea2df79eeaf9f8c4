"""Token files, the Merkle manifest and whitening against brute force."""

import math
import random
import zlib
from decimal import Decimal
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import merkle, perfect_hash, queries, token_files, whitening
from ledgerloom.session import work_folder

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n string, ids string, copy string, position string, witness string"


def frame(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t), "a", "b", "c", "d", "e") for i, t, lang in rows], DOCS)


def doc_rows():
    rng = random.Random(3)
    words = ["the", "Don't", "naïve", "x1", "İ.", "<|endoftext|>", "日本", "e.g.", "İ"]
    rows = [(n * 3 % 101, " ".join(rng.choices(words, k=rng.choice([0, 1, 9, 200]))), rng.choice(["de", "en", "en", "en", None, "é"])) for n in range(101)]
    rows += [(7, f"row {n} of one id", "en") for n in range(90)] + [rows[5]] * 3
    return rows + [(None, "no id", "en"), (None, None, "en"), (None, "no id", "en"), (200, None, "en"), (201, "", "fr"), (-5, "long " * 20_000, "en")]


# --- token files -------------------------------------------------------------------------------------


@pytest.mark.parametrize("count", [0, 1, 2, 700, 40_000])
def test_perfect_hash_is_minimal_and_perfect(count):
    rng = np.random.default_rng(count)
    first, second = (rng.integers(0, 1 << 64, count, np.uint64) for _ in range(2))
    first[: count // 3] = 5  # a shared half does not matter
    data = perfect_hash.build(first, second)
    table = perfect_hash.PerfectHash(data + b"behind")
    assert table.keys == count and (data + b"behind")[table.end :] == b"behind"
    assert sorted(table.slots(first, second).tolist()) == list(range(count))
    strange = rng.integers(0, 1 << 64, (2, 1000), np.uint64)
    slots = table.slots(*strange)
    assert slots.max() < max(1, count)
    if count == 40_000:
        assert len(data) * 8 < 5 * count
        known = np.empty(count, np.uint32)
        known[table.slots(first, second)] = perfect_hash.fingerprints(first, second)
        assert not np.any((slots >= 0) & (known[slots] == perfect_hash.fingerprints(*strange)))
    with pytest.raises(ValueError):
        perfect_hash.build(np.array([1, 1], np.uint64), np.array([2, 2], np.uint64))


@pytest.mark.parametrize("shard_ids,index_keys", [(token_files.SHARD_IDS, token_files.INDEX_KEYS), (300, 8)])
def test_token_files_are_a_round_trip(spark, shard_ids, index_keys):
    rows, folder, tokenizer = doc_rows(), work_folder(spark, "test-tokens"), Tokenizer.from_file(PATH)
    docs = frame(spark, rows)
    token_files.write(docs.repartition(5), PATH, folder, shard_ids=shard_ids, index_keys=index_keys)
    got = token_files.read(token_files.keys_of(docs), folder).collect()
    want = {}
    for i, t, _ in rows:
        want.setdefault(i, []).append(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])
    assert len(got) == len(rows)
    at = 0
    for r in sorted(got, key=lambda r: r.start):  # gapless, in order of doc_id, null first
        assert r.start == at and r.n_tokens * 4 == len(r.ids)
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    found = {}
    for r in got:
        found.setdefault(r.doc_id, []).append(np.frombuffer(r.ids, "<u4").tolist())
    assert {i: sorted(x) for i, x in found.items()} == {i: sorted(x) for i, x in want.items()}
    assert sorted((r.doc_id is None, r.doc_id or 0, r.copy) for r in got) == sorted((i is None, i or 0, k) for i, x in want.items() for k in range(len(x)))


def test_keyed_access_and_unknown_keys(spark):
    rows, folder = [(n, f"text {n}", "en") for n in range(500)], work_folder(spark, "test-tokens")
    token_files.write(frame(spark, rows), PATH, folder, shard_ids=100, index_keys=64)
    asked = spark.createDataFrame([(3, 0), (499, 0), (3, 0), (3, 1), (777, 0), (None, 0), (-1, 0)], "doc_id long, copy long")
    got = {(r.doc_id, r.copy): np.frombuffer(r.ids, "<u4").tolist() for r in token_files.read(asked, folder).collect()}
    tokenizer = Tokenizer.from_file(PATH)
    assert got == {(n, 0): tokenizer.encode(f"text {n}", add_special_tokens=False).ids + [2] for n in (3, 499)}


def test_token_files_of_an_empty_table(spark):
    folder = work_folder(spark, "test-tokens")
    token_files.write(frame(spark, []), PATH, folder)
    assert token_files.read(token_files.keys_of(frame(spark, [])), folder).count() == 0


# --- manifest ----------------------------------------------------------------------------------------


def H(text):
    return sha256(text.encode()).hexdigest()


def brute_tree(leaves):
    """(root, siblings of each leaf) by the stated rule."""
    proofs, members, nodes = [[] for _ in leaves], [[k] for k in range(len(leaves))], list(leaves)
    while len(nodes) > 1:
        pairs = [list(range(k, min(k + 2, len(nodes)))) for k in range(0, len(nodes), 2)]
        for pair in pairs:
            for k in pair:
                for m in members[k]:
                    proofs[m] += [("L" if j < k else "R", nodes[j]) for j in pair if j != k] or [("", "")]
        nodes, members = ["".join(nodes[k] for k in p) for p in pairs], [[m for k in p for m in members[k]] for p in pairs]
        nodes = [H(n) for n in nodes]
    return nodes[0], proofs


def brute_manifest(rows):
    groups = {}
    for i, leaf, lang in rows:
        groups.setdefault(lang, []).append(((i is not None, i or 0), leaf, i))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in langs:
        groups[g].sort(key=lambda x: x[:2])
        trees[g] = brute_tree([leaf for _, leaf, _ in groups[g]])
    root, tops = brute_tree([trees[g][0] for g in langs])
    found = [(i, leaf, trees[g][0], p + tops[k]) for k, g in enumerate(langs) for (_, leaf, i), p in zip(groups[g], trees[g][1], strict=True)]
    return root, found


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_manifest_is_that_of_brute_force(spark, levels):
    rows = doc_rows()
    leaves = frame(spark, rows).select("doc_id", "lang", F.sha2("text", 256).alias("leaf"))
    leaves = leaves.withColumn("leaf", F.coalesce("leaf", F.sha2(F.lit("-"), 256)))
    found, root = merkle.manifest(leaves.repartition(4), "lang", "doc_id", levels)
    want_root, want = brute_manifest([(i, H("-" if t is None else t), lang) for i, t, lang in rows])
    assert root == want_root
    got = found.select(
        "doc_id", "leaf", "subroot", "witness", merkle.proof_digest(F.col("witness")).alias("proof"), merkle.folded(F.col("leaf"), F.col("witness")).alias("folded")
    ).collect()
    brute = [(i, leaf, sub, [(s, h) for s, h in p], H("".join(h for _, h in p))) for i, leaf, sub, p in want]
    mine = [(r.doc_id, r.leaf, r.subroot, [(bytes(e[:1]).decode(), bytes(e[1:]).hex()) for e in r.witness], r.proof) for r in got]
    assert sorted(map(repr, mine)) == sorted(map(repr, brute)) and all(r.folded == root for r in got)


def test_witnesses_grow_with_every_append():
    """At any time a partial witness leads from its leaf to the root of its open subtree."""
    leaves, tree = [sha256(bytes([k])).digest() for k in range(21)], merkle.OpenTree()
    for count, leaf in enumerate(leaves, 1):
        tree.append(leaf)
        assert [len(s.leaves) for s in tree.open] == [1 << b for b in range(5, -1, -1) if count >> b & 1]
        for part in tree.open:
            for at in part.leaves:
                node = leaves[at]
                for e in tree.witnesses[at]:
                    node = merkle.node_digest(e[1:], node) if e[:1] == merkle.ON_LEFT else merkle.node_digest(node, e[1:])
                assert node == part.root
    root, proofs = brute_tree([x.hex() for x in leaves])
    assert tree.close().hex() == root
    assert [[e[1:].hex() for e in w] for w in tree.witnesses] == [[h for _, h in p] for p in proofs]


def test_manifest_of_small_tables(spark):
    empty = frame(spark, []).select("doc_id", "lang", F.lit("00" * 32).alias("leaf"))
    found, root = merkle.manifest(empty, "lang", "doc_id")
    assert found.count() == 0 and root is None
    leaf = H("x")
    found, root = merkle.manifest(frame(spark, [(1, "x", None)]).select("doc_id", "lang", F.lit(leaf).alias("leaf")), "lang", "doc_id")
    row = found.first()
    assert root == row.subroot == leaf and row.witness == []


def test_tampering_is_seen(spark):
    got = queries.QUERIES["op12_merkle"](spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(got) == len(docs) and len({r.root for r in got}) == 1
    for r in got:
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0 or docs[r.doc_id].n_chars is None)
        assert r.verified == (r.folded_root == r.root)


# --- whitening ---------------------------------------------------------------------------------------


VECTORS = "vec_id long, embedding array<float>, x string, n string, component string"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], VECTORS)


def vector_rows(count=400, dims=9, seed=3):
    rng = np.random.default_rng(seed)
    mixing = rng.normal(size=(dims, dims))
    rows = [(n, (rng.normal(size=dims) @ mixing).astype(np.float32).tolist()) for n in range(count)]
    rows += [(count + n, rows[7][1]) for n in range(150)] + [rows[9], (None, rows[3][1])]
    bad = [None, [], [float("nan")] * dims, [None] + [1.0] * (dims - 1), [math.inf] * dims]
    return rows + [(9000 + n, v) for n, v in enumerate(bad)]


def check_whitening(got, rows, tolerance=1e-9):
    """Against floating-point eigenvectors, per length."""
    good = [(i, tuple(math.floor(256 * np.float64(np.float32(c))) for c in v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    for dims in {len(x) for _, x in good}:
        own = [(i, x) for i, x in good if len(x) == dims]
        fit = sorted({x for _, x in own})
        n, matrix = len(fit), np.array(fit, float)
        values, vectors = np.linalg.eigh(np.cov(matrix.T, bias=True).reshape(dims, dims))
        values, vectors = values[::-1], vectors[:, ::-1]
        sums = [sum(x[d] for x in fit) for d in range(dims)]
        rank = int((values > 1e-9 * max(values[0], 1e-300)).sum()) if values[0] > 0 else 0
        mine = [r for r in got if r.dims == dims]
        assert len(mine) == len(own) * min(4, rank)
        white = {(i, x): (np.array(x) - matrix.mean(axis=0)) @ vectors[:, :4] / np.sqrt(np.maximum(values[:4], 1e-300)) for i, x in own}
        for k in range(min(4, rank)):
            rows_k = [r for r in mine if r.component == k + 1]
            assert all(r.n == n and abs(r.explained - values[k] / values.sum()) < tolerance and r.identity_error < 1e-9 for r in rows_k)
            signs = {round(float(r.whitened / white[r.vec_id, tuple(r.whole)][k]), 6) for r in rows_k if abs(r.whitened) > 1e-6}
            assert signs in ({1.0}, {-1.0})
            assert {(r.vec_id, tuple(r.whole), int(r.deviation)) for r in rows_k} == {(i, x, sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))) for i, x in own}


def whitened(spark, rows):
    """With the integer vector beside each row, to tell repeated ids apart."""
    vectors = vector_frame(spark, rows)
    named = vectors.withColumn("vec_id", F.struct("vec_id", "embedding"))
    out = whitening.whiten(named)
    whole = F.transform(F.col("vec_id.embedding").cast("array<double>"), lambda c: F.floor(c * 256).cast("long"))
    rest = [c for c in out.columns if c != "vec_id"]
    return out.select(F.col("vec_id.vec_id").alias("vec_id"), whole.alias("whole"), F.size(whole).alias("dims"), *rest).collect()


def test_whitening_is_that_of_floating_point(spark):
    rows = vector_rows() + vector_rows(60, 3, seed=8) + [(70_000, [1.5, 2.5]), (70_001, [0.5, 2.5])] + [(70_002, [4.0])]
    check_whitening(whitened(spark, rows), rows)
    got = whitening.whiten(vector_frame(spark, rows))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(vector_frame(spark, [])).count() == 0
    assert whitening.whiten(vector_frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # nothing to whiten


def test_whitening_of_huge_components_is_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(n, [float(np.float32(x)) for x in rng.normal(size=3) * (1e12, 1e9, 1e9)]) for n in range(40)]
    check_whitening(whitened(spark, rows), rows, 1e-7)


def test_moments_are_exact_for_all_longs():
    rng = np.random.default_rng(2)
    matrix = rng.integers(-(1 << 63), (1 << 63) - 1, (300, 4), np.int64, endpoint=True)
    matrix[0] = [-(1 << 63), (1 << 63) - 1, 0, -1]
    sums, second = whitening.moments(matrix)
    whole = matrix.astype(object)
    assert sums.tolist() == whole.sum(axis=0).tolist() and second.tolist() == (whole.T @ whole).tolist()
    for value in (0, -1, 1 << 40, -(1 << 40), 3 << 120, -(7 << 99) + 5):
        assert sum(d << (40 * k) for k, d in enumerate(whitening.digits(value))) == value


def faddeev(matrix):
    """The characteristic polynomial by exact traces: e with alternating signs taken out."""
    from fractions import Fraction

    d = len(matrix)
    power, found = [[Fraction(int(i == j)) for j in range(d)] for i in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        step = [[sum(matrix[i][m] * power[m][j] for m in range(d)) for j in range(d)] for i in range(d)]
        c = -sum(step[i][i] for i in range(d)) / k
        power = [[step[i][j] + (c if i == j else 0) for j in range(d)] for i in range(d)]
        found.append(c)
    return [int(c) * (-1) ** k for k, c in enumerate(found)]


def test_polynomial_roots_and_vectors(spark):
    rng = np.random.default_rng(4)
    for rank, dims in ((5, 5), (2, 6), (1, 3), (1, 1)):
        half = rng.integers(-50, 50, (dims, rank))
        matrix = (half @ half.T).tolist()
        e = whitening.characteristic_polynomial(spark, matrix)
        assert e == faddeev(matrix)
        roots = whitening.largest_roots(e, 4)
        values = np.linalg.eigvalsh(np.array(matrix, float))[::-1]
        assert len(roots) == min(4, rank) and np.allclose([float(r) for r in roots], values[: len(roots)], rtol=1e-9)


def test_equal_and_close_eigenvalues():
    equal = [[5, 0, 0, 0], [0, 5, 0, 0], [0, 0, 5, 0], [0, 0, 0, 2]]
    e = faddeev(equal)
    roots = whitening.largest_roots(e, 4)
    assert [round(float(r), 12) for r in roots] == [5, 5, 5, 2]
    vectors = np.array([[float(x) for x in v] for v in whitening.unit_vectors(equal, roots)])
    assert np.allclose(vectors @ vectors.T, np.eye(4), atol=1e-14) and np.allclose(abs(vectors[3]), [0, 0, 0, 1])
    big = 10**15
    close = [[big, 1, 0], [1, big, 0], [0, 0, big]]  # roots big + 1, big, big - 1, which doubles cannot tell apart well
    roots = whitening.largest_roots(faddeev(close), 3)
    assert [round(r) for r in roots] == [big + 1, big, big - 1]
    first = whitening.unit_vectors(close, roots)[0]
    assert all(abs(x - y) < Decimal("1e-25") for x, y in zip(first, [Decimal("0.5").sqrt()] * 2 + [Decimal(0)], strict=True))


def test_op11_and_op13_digest_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    tokenizer, at = Tokenizer.from_file(PATH), 0
    got = {r.doc_id: r for r in queries.QUERIES["op11_token_files"](spark, "/root/testdata/sf0.001").collect()}
    for d in docs:
        ids = np.array(tokenizer.encode(d.text or "", add_special_tokens=False).ids + [2], "<u4")
        assert (got[d.doc_id].start, got[d.doc_id].n_tokens, got[d.doc_id].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    white = queries.QUERIES["op13_whitening"](spark, "/root/testdata/sf0.001")
    assert dict(white.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
