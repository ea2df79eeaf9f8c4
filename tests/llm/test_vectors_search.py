"""Both vector searches against brute force."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import rabitq, vafile

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, block string, score string"


def rows(count=600, dims=24, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    made = [(n, (centres[n % 12] + 0.4 * rng.normal(size=dims)).astype(np.float32).tolist()) for n in range(count)]
    made += [(count + n, made[7][1]) for n in range(60)]  # a group of copies
    made += [(5000, None), (5050, []), (5100, [0.0] * dims), (5150, [float("nan")] * dims), (5200, [None] + [1.0] * (dims - 1))]
    made += [(5250, [1.0, 2.0]), (5260, [1.0, 2.5]), (None, made[3][1]), made[100], (5300, [math.inf] * dims)]
    random.Random(seed).shuffle(made)
    return made


def frame(spark, data):
    return spark.createDataFrame([(i, v, 1, "a", "b", "c") for i, v in data], SCHEMA)


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def test_nearest_finds_what_brute_force_finds(spark):
    data = rows()
    good = {i: np.array(v, float) for i, v in data if i is not None and usable(v) and any(v)}
    got = {}
    for r in rabitq.nearest(frame(spark, data), F.col("vec_id") % 10 == 0, k=10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {q for q in good if q % 10 == 0 and sum(len(v) == len(good[q]) for v in good.values()) > 1}
    hits = total = 0
    for q, found in got.items():
        found.sort()
        far = {i: math.dist(v, good[q]) for i, v in good.items() if i != q and len(v) == len(good[q])}
        want = sorted(far, key=lambda i: (round(far[i], 9), i))[:10]
        assert [rank for rank, _, _ in found] == list(range(1, len(want) + 1))
        assert all(abs(far[i] - s) < 1e-9 for _, i, s in found)
        hits += len(set(want) & {i for _, i, _ in found})
        total += len(want)
    assert hits >= 0.97 * total


def test_top_products_are_exact(spark):
    data = rows(seed=2)
    good = {i: [math.floor(256 * x) for x in v] for i, v in data if i is not None and usable(v)}
    for bits in (8, 3):
        found = {}
        for r in vafile.top_products(frame(spark, data), F.col("vec_id") % 10 == 0, k=5, cell_bits=bits).collect():
            found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        for q in (q for q in good if q % 10 == 0):
            score = {i: sum(a * b for a, b in zip(v, good[q])) for i, v in good.items() if i != q and len(v) == len(good[q])}
            want = sorted(score, key=lambda i: (-score[i], i))[:5]
            assert sorted(found.get(q, [])) == [(n + 1, i, score[i]) for n, i in enumerate(want)]


def test_searches_of_odd_tables(spark):
    for search in (rabitq.nearest, vafile.top_products):
        assert search(frame(spark, []), F.lit(True)).count() == 0
        assert search(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.5])]), F.lit(False)).count() == 0
        assert search(frame(spark, [(1, [1.0, 2.0])]), F.lit(True)).count() == 0
        assert [r.vec_id for r in search(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]), F.col("vec_id") == 1).collect()] == [2]
    # Products beyond what a double holds exactly.
    big = [(n, [float(131000 - n), 100000.0 + n]) for n in range(20)]
    got = vafile.top_products(frame(spark, big), F.col("vec_id") == 0, k=3).collect()
    whole = {n: [math.floor(256 * x) for x in v] for n, v in big}
    score = {n: sum(a * b for a, b in zip(whole[n], whole[0])) for n in range(1, 20)}
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(n, score[n]) for n in sorted(score, key=lambda n: (-score[n], n))[:3]]


def test_products_of_large_components_are_exact(spark):
    """No finite vector is left out, whatever its size, and sums that cancel are not lost in rounding."""
    rng = np.random.default_rng(9)
    for size in (1.4e5, 1e9, 1e15):
        data = [(n, (rng.normal(size=4) * (size if n % 3 else 1)).astype(np.float32).tolist()) for n in range(300)]
        data += [(400 + n, [size, -size, 1.0 + n, size]) for n in range(20)]
        good = {i: [math.floor(256 * x) for x in np.array(v, np.float32).astype(float).tolist()] for i, v in data}
        found = {}
        for r in vafile.top_products(frame(spark, data), F.col("vec_id") % 20 == 0, k=5).collect():
            found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, int(r.score)))
        assert set(found) == {i for i in good if i % 20 == 0}
        for q, rows_of in found.items():
            score = {i: sum(a * b for a, b in zip(v, good[q], strict=True)) for i, v in good.items() if i != q}
            want = sorted(score, key=lambda i: (-score[i], i))[:5]
            assert [(i, s) for _, i, s in sorted(rows_of)] == [(i, score[i]) for i in want]


def test_cells_bound_the_scores_of_all_longs():
    rng = np.random.default_rng(3)
    for top in (50, 1 << 30, (1 << 63) - 1):
        matrix = rng.integers(-top, top, (80, 6), np.int64, endpoint=True)
        low, width, cells = vafile.grid_of(matrix, 8)
        least, greatest = vafile.score_bounds(low, width, cells, matrix[:9])
        for k, row in enumerate(matrix.tolist()):
            for q, query in enumerate(matrix[:9].tolist()):
                assert least[k, q] <= sum(a * b for a, b in zip(row, query, strict=True)) <= greatest[k, q]
