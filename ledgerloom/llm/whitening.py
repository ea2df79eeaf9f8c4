"""Embedding whitening from the exact characteristic polynomial of the integer scatter.

Vectors become integers. Every task adds up its share of the moments in integers, whatever their size; Spark sums them by
place. With n vectors, sums S and second moments G, the scatter n * G - S S' is an integer matrix, n ** 2 times the
covariance. Its characteristic polynomial is computed modulo enough primes, each by Hessenberg reduction in a task of
Spark, and put together by the Chinese remainder theorem. All its roots are real, so the sign changes of the shifted
polynomial count the roots above any point: that isolates the largest ones and bisection narrows them down, both in
integers. Components are null vectors of the scatter minus the root, found by inverse iteration in decimals of many
digits. What the driver holds is a few numbers for each pair of dimensions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Context, Decimal, localcontext
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import vector_grid as grid
from ledgerloom.llm.common import store

COMPONENTS = 4
SCALE = 256
SLICE = 4096
# Products of two limbs, summed over a slice, are whole numbers that a double holds.
LIMB_BITS = 20
# Moments travel as digits of this base, so that sums of very many tasks fit a long.
PLACE_BITS = 40
PRIME_BITS = 31
ROOT_BITS = 160
DIGITS = 120


@dataclass(frozen=True)
class Fit:
    """What whitening needs: number and sums of the vectors, eigenvalues and unit vectors of the covariance."""

    n: int
    sums: list[int]
    values: list[float]
    vectors: list[list[float]]
    trace: float


# --- moments -----------------------------------------------------------------------------------------


def limbs(matrix: np.ndarray) -> list[np.ndarray]:
    """The matrix as a sum of parts times 2 ** (LIMB_BITS * k); all parts but the last are not negative."""
    most = max(abs(int(matrix.max())), abs(int(matrix.min()))) if matrix.size else 0
    parts = []
    while most >= 1 << LIMB_BITS:
        parts.append((matrix & ((1 << LIMB_BITS) - 1)).astype(np.float64))
        matrix, most = matrix >> LIMB_BITS, (most >> LIMB_BITS) + 1
    return [*parts, matrix.astype(np.float64)]


def moments(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and second moments of the rows as Python integers; exact for any 64-bit components."""
    dims = matrix.shape[1]
    sums, second = np.zeros(dims, object), np.zeros((dims, dims), object)
    for at in range(0, len(matrix), SLICE):
        parts = limbs(matrix[at : at + SLICE])
        for i, x in enumerate(parts):
            sums += x.sum(axis=0).astype(np.int64).astype(object) << (LIMB_BITS * i)
            for j, y in enumerate(parts):
                second += (x.T @ y).astype(np.int64).astype(object) << (LIMB_BITS * (i + j))
    return sums, second


def digits(value: int) -> list[int]:
    """Digits of base 2 ** PLACE_BITS, the last one with the sign."""
    found = []
    while not -(1 << PLACE_BITS) < value < 1 << PLACE_BITS:
        found.append(value & ((1 << PLACE_BITS) - 1))
        value >>= PLACE_BITS
    return [*found, value]


def vectors_by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimensions, rows, their vectors as a matrix) of a list column without nulls."""
    lists = batch.column(column)
    sizes = np.diff(lists.offsets.to_numpy())
    flat, starts = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes
    for dims in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dims)
        yield dims, rows, flat[starts[rows][:, None] + np.arange(dims)]


def summed_moments(fit: DataFrame) -> DataFrame:
    """(dims, i, j, place, value): moments of all vectors x, by dimension pair (j = -1: sums; i = -1: count) and digit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for dims, rows, matrix in vectors_by_length(batch, "x"):
                sums, second = moments(matrix)
                old = held.setdefault(dims, [0, np.zeros(dims, object), np.zeros((dims, dims), object)])
                held[dims] = [old[0] + len(rows), old[1] + sums, old[2] + second]
        for dims, (n, sums, second) in held.items():
            values = [(-1, -1, n), *((i, -1, s) for i, s in enumerate(sums))]
            values += [(i, j, second[i, j]) for i in range(dims) for j in range(i, dims)]
            found = [(dims, i, j, place, d) for i, j, v in values for place, d in enumerate(digits(v))]
            columns = zip(*found, strict=True)
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["dims", "i", "j", "place", "value"]
            )

    parts = fit.select("x").mapInArrow(run, "dims int, i int, j int, place int, value long")
    return parts.groupBy("dims", "i", "j", "place").agg(F.sum("value").alias("value"))


def scatter(places: pd.DataFrame, dims: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, S, n * G - S S') from the digits of all moments of one length."""
    total: dict[tuple[int, int], int] = {}
    for i, j, place, value in places[["i", "j", "place", "value"]].itertuples(index=False, name=None):
        total[i, j] = total.get((i, j), 0) + (int(value) << (PLACE_BITS * place))
    n, sums = total[-1, -1], [total[i, -1] for i in range(dims)]
    cell = lambda i, j: n * total[min(i, j), max(i, j)] - sums[i] * sums[j]
    return n, sums, [[cell(i, j) for j in range(dims)] for i in range(dims)]


# --- the polynomial ----------------------------------------------------------------------------------


def is_prime(n: int) -> bool:
    """Miller-Rabin, certain below 3.2e9 by these bases."""
    if n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if n == base or x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(matrix: list[list[int]]) -> list[int]:
    """Primes whose product is above every coefficient: the k-th is at most C(d, k) (trace / d) ** k, as no root is negative."""
    dims, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    bound = max(math.comb(dims, k) * trace**k // dims**k + 1 for k in range(dims + 1))
    found, product, candidate = [], 1, 1 << PRIME_BITS
    while product <= bound:
        candidate -= 1
        if is_prime(candidate):
            found.append(candidate)
            product *= candidate
    return found


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of the characteristic polynomial modulo p, the lowest first, by way of Hessenberg form."""
    a, d = matrix.copy(), len(matrix)
    for m in range(1, d - 1):
        pivots = np.flatnonzero(a[m:, m - 1])
        if not len(pivots):
            continue
        pivot = m + int(pivots[0])
        if pivot != m:
            a[[m, pivot]] = a[[pivot, m]]
            a[:, [m, pivot]] = a[:, [pivot, m]]
        factor = a[m + 1 :, m - 1] * pow(int(a[m, m - 1]), -1, p) % p
        a[m + 1 :] = (a[m + 1 :] - factor[:, None] * a[m] % p) % p
        a[:, m] = (a[:, m] + (a[:, m + 1 :] * factor % p).sum(axis=1)) % p
    polynomials = np.zeros((d + 1, d + 1), np.int64)  # of the leading k x k blocks
    polynomials[0, 0] = 1
    for k in range(1, d + 1):
        own = (np.roll(polynomials[k - 1], 1) - a[k - 1, k - 1] * polynomials[k - 1] % p) % p
        weights, product = [], 1
        for i in range(k - 1, 0, -1):
            product = product * int(a[i, i - 1]) % p
            weights.append(int(a[i - 1, k - 1]) * product % p)
        if weights:
            below = polynomials[k - 2 :: -1][: len(weights)]
            own = (own - (np.array(weights, np.int64)[:, None] * below % p).sum(axis=0)) % p
        polynomials[k] = own
    return polynomials[d]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """e with det(t - matrix) = sum of (-1) ** k e[k] t ** (d - k), exact; the matrix has no negative eigenvalue."""
    dims, primes = len(matrix), primes_for(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column("prime").to_pylist():
                reduced = np.array([[x % p for x in row] for row in matrix], np.int64)
                found = polynomial_modulo(reduced, p)
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([found.tolist()])], ["prime", "found"])

    tasks = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(tasks)
    residues = {r.prime: r.found for r in rows.mapInArrow(run, "prime long, found array<long>").collect()}
    product = math.prod(primes)
    unit = [product // p * pow(product // p, -1, p) for p in primes]
    e = []
    for k in range(dims + 1):
        sign = -1 if k % 2 else 1
        e.append(sum(u * (sign * residues[p][dims - k] % p) for p, u in zip(primes, unit, strict=True)) % product)
    return e


# --- roots -------------------------------------------------------------------------------------------


def scaled(e: list[int], shift: int) -> list[int]:
    """Coefficients, the highest first, of the polynomial whose roots are 2 ** shift times those of e."""
    return [(-c if k % 2 else c) << (shift * k) for k, c in enumerate(e)]


def roots_above(coefficients: list[int], point: int) -> int:
    """How many roots, as often as they occur, lie above the point: the sign changes after a shift, since all are real."""
    c = list(coefficients)
    for last in range(len(c), 1, -1):
        for k in range(1, last):
            c[k] += point * c[k - 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def sign_at(coefficients: list[int], point: int) -> int:
    value = 0
    for c in coefficients:
        value = value * point + c
    return (value > 0) - (value < 0)


def largest_roots(e: list[int], count: int) -> list[Fraction]:
    """The largest positive roots, with some ROOT_BITS bits each; fewer if there are fewer. Equal ones repeat."""
    rank = max(k for k, c in enumerate(e) if c)
    found = []
    for k in range(1, min(count, rank) + 1):
        low, high, shift = 0, e[1], 0  # no root is above the trace
        c = scaled(e, 0)
        above_low, above_high = rank, 0
        while True:
            # Until the interval is short against the root it may not hold zero.
            if low and (high - low) << ROOT_BITS <= low:
                break
            if high - low < 2:
                # A finer grid, a few bits at a time.
                low, high, shift = low << 32, high << 32, shift + 32
                c = scaled(e, shift)
            middle = (low + high) // 2
            if above_low - above_high == 1:  # one root, and the sign tells on which side
                on_right = sign_at(c, middle) * (-1) ** above_low > 0
                low, high = (middle, high) if on_right else (low, middle)
                continue
            above = roots_above(c, middle)
            if above >= k:
                low, above_low = middle, above
            else:
                high, above_high = middle, above
        found.append(Fraction(low + high, 2 << shift))
    return found


# --- components --------------------------------------------------------------------------------------


def solver(matrix: np.ndarray, least: Decimal):
    """Elimination with row exchanges on decimals; returns the function that solves for a right side."""
    a, d = matrix.copy(), len(matrix)
    steps = []
    for k in range(d):
        pivot = k + int(np.argmax(np.abs(a[k:, k])))
        a[[k, pivot]] = a[[pivot, k]]
        if abs(a[k, k]) < least:  # the matrix is singular by intention
            a[k, k] = least
        factor = a[k + 1 :, k] / a[k, k]
        a[k + 1 :, k:] = a[k + 1 :, k:] - factor[:, None] * a[k, k:]
        steps.append((pivot, factor))

    def solve(right: np.ndarray) -> np.ndarray:
        x = right.copy()
        for k, (pivot, factor) in enumerate(steps):
            x[[k, pivot]] = x[[pivot, k]]
            x[k + 1 :] = x[k + 1 :] - factor * x[k]
        for k in range(d - 1, -1, -1):
            x[k] = (x[k] - (a[k, k + 1 :] * x[k + 1 :]).sum()) / a[k, k]
        return x

    return solve


def unit_vectors(matrix: list[list[int]], roots: list[Fraction]) -> list[np.ndarray]:
    """A unit vector of decimals for each root, orthogonal also where roots are equal; the largest entry is positive."""
    found: list[tuple[Fraction, np.ndarray]] = []
    with localcontext(Context(prec=DIGITS, Emax=10**9, Emin=-(10**9))):
        exact = np.array([[Decimal(x) for x in row] for row in matrix], object)
        for number, root in enumerate(roots):
            value = Decimal(root.numerator) / Decimal(root.denominator)
            solve = solver(exact - np.diag([value] * len(matrix)), value.scaleb(-DIGITS + 10))
            equal = [v for r, v in found if abs(r - root) * 2 ** (ROOT_BITS // 2) <= root]
            rng = np.random.default_rng([13, number])
            x = np.array([Decimal(int(k)) for k in rng.integers(1, 1 << 20, len(matrix))], object)
            for _ in range(4):
                for v in equal:
                    x = x - v * (v * x).sum()
                x = solve(x / (x * x).sum().sqrt())
            for v in equal:
                x = x - v * (v * x).sum()
            x = x / (x * x).sum().sqrt()
            found.append((root, x if x[int(np.argmax(np.abs(x)))] > 0 else -x))
    return [v for _, v in found]


def fit_of(spark: SparkSession, n: int, sums: list[int], matrix: list[list[int]], components: int) -> Fit:
    """Eigenvalues and vectors of the covariance, which is the scatter over n ** 2; those above zero, the largest first."""
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    if not trace:
        return Fit(n, sums, [], [], 0.0)
    roots = largest_roots(characteristic_polynomial(spark, matrix), components)
    vectors = [[float(x) for x in v] for v in unit_vectors(matrix, roots)]
    return Fit(n, sums, [float(r / n**2) for r in roots], vectors, float(Fraction(trace, n**2)))


# --- whitening ---------------------------------------------------------------------------------------


def spread(matrix: np.ndarray, fit: Fit) -> tuple[np.ndarray, list]:
    """(x - S / n as doubles, exact sums of (n * x - S) ** 2) of integer rows."""
    most = max(abs(int(matrix.max())), abs(int(matrix.min()))) * fit.n + max(map(abs, fit.sums))
    if most < 1 << 62:
        apart = matrix * fit.n - np.array(fit.sums, np.int64)
    else:
        apart = matrix.astype(object) * fit.n - np.array(fit.sums, object)
    squares = apart if most**2 * matrix.shape[1] < 1 << 63 else apart.astype(object)
    return (apart / fit.n).astype(np.float64), (squares * squares).sum(axis=1).tolist()


def projected(matrix: np.ndarray, fit: Fit) -> tuple[np.ndarray, list]:
    apart, deviations = spread(matrix, fit)
    scale = np.array(fit.vectors).T / np.sqrt(np.array(fit.values))
    return apart @ scale, deviations


def identity_errors(fit: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """Per length the largest absolute entry of the whitened vectors' covariance minus the identity, as measured."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for dims, _, matrix in vectors_by_length(batch, "x"):
                if fits[dims].values:
                    white, _ = projected(matrix, fits[dims])
                    one = np.concatenate([white, np.ones((len(white), 1))], axis=1)
                    held[dims] = held.get(dims, 0) + one.T @ one
        rows = [(d, i, j, float(v)) for d, m in held.items() for (i, j), v in np.ndenumerate(m)]
        yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=["dims", "i", "j", "value"]).astype({"dims": "int32", "i": "int32", "j": "int32", "value": "float64"}), preserve_index=False)

    parts = fit.select("x").mapInArrow(run, "dims int, i int, j int, value double")
    found: dict[int, float] = {}
    sums = parts.groupBy("dims", "i", "j").agg(F.sum("value").alias("value")).toPandas()
    for dims, own in sums.groupby("dims"):
        side = int(own["i"].max()) + 1
        total = np.zeros((side, side))
        total[own["i"], own["j"]] = own["value"]
        mean = total[-1, :-1] / total[-1, -1]
        covariance = total[:-1, :-1] / total[-1, -1] - np.outer(mean, mean)
        found[int(dims)] = float(np.abs(covariance - np.eye(side - 1)).max())
    return found


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Whitened vectors, a row for each vector and component: (vec_id, component int from 1, n, deviation decimal(38, 0),
    whitened, explained, identity_error).

    ``vectors`` has vec_id and embedding. Entries become floor(scale * c), c as double. Null and empty vectors and those
    with null or non-finite entries take no part; null ids do. The fit is over distinct integer vectors, so repeated rows and
    equal vectors count once there, but all rows come back. Vectors of each length are whitened by a fit of their own; the
    lengths, of which there are few, are read by the driver. Components belong to eigenvalues above zero; if there are fewer than asked
    for, so are the rows, and a single distinct vector gives none. Equal eigenvalues share an arbitrary, fixed basis.
    deviation is null beyond 38 digits. Other columns are not read; an empty table gives no row.
    """
    spark = vectors.sparkSession
    real = F.col("embedding").cast("array<double>")
    whole = F.transform(real, lambda c: F.floor(c * scale).cast("long"))
    known = vectors.where(grid.finite(real)).select("vec_id", whole.alias("x"))
    fit = store(known.select("x").distinct(), "whitening-fit")
    places = summed_moments(fit).toPandas()
    fits = {int(d): fit_of(spark, *scatter(own, int(d)), components) for d, own in places.groupby("dims")}
    errors = identity_errors(fit, fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dims, rows, matrix in vectors_by_length(batch, "x"):
                own = fits[dims]
                count = len(own.values)
                if not count:
                    continue
                white, deviations = projected(matrix, own)
                exact = pa.array([Decimal(d) if d < 10**38 else None for d in deviations], pa.decimal128(38, 0))
                each = pa.array(np.repeat(np.arange(len(rows)), count))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(rows)).take(each),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(len(each), own.n, np.int64)),
                        exact.take(each),
                        pa.array(white.reshape(-1)),
                        pa.array(np.tile(np.array(own.values) / own.trace, len(rows))),
                        pa.array(np.full(len(each), errors[dims])),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    return known.mapInArrow(run, schema)
