"""Principal components and whitening of embeddings by an exact polynomial.

1. Entries become integers.  One pass sums the vectors and their products
   exactly; with n vectors, sums S and products P the integer scatter
   M = n P - S S' is n^2 times the covariance, centred without rounding.
2. M's characteristic polynomial has integer coefficients.  Spark tasks find it
   modulo many primes (reduction to Hessenberg form, then Hyman's recurrence);
   Chinese remaindering gives the coefficients.  Enough primes are taken for a
   bound on them, and one more whose residues must agree.
3. All roots are real, so the sign changes of the polynomial shifted to t count
   the roots above t (Descartes, exact for real roots).  Bisection on integers
   isolates the largest roots and narrows them to some hundred bits.
4. A component is the null space of M - e: inverse iteration with integers of
   fixed scale, orthogonal within equal roots.
5. A second pass takes the whitened values' covariance, a third returns them.

Only numbers by dimension leave the tasks: sums, residues and components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LARGEST = 1 << 52      # entries of a larger size do not pass through a double exactly
LIMB = 60              # bits of the low part of a sum
BITS = 128             # bits that roots are narrowed to, below the trace
GUARD = 192            # more bits of the arithmetic for components


# -- exact sums ---------------------------------------------------------------

def integers(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their entries less SHIFT as an int64 matrix).

    A vector that is null or empty, or holds a null, a non-finite entry or one
    whose integer is beyond 2^52, takes no part.
    """
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    n = len(lists)
    size = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
    flat = lists.flatten()
    value = np.asarray(flat.cast(pa.float64()).fill_null(np.nan)).astype(np.float64)
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(value * SCALE)
        bad = ~(np.abs(x) < LARGEST)
    row = np.repeat(np.arange(n), size)
    good = size > 0
    good[row[bad]] = False
    rows = np.flatnonzero(good)
    if not len(rows):
        return rows, np.zeros((0, 0), np.int64)
    if len(np.unique(size[rows])) > 1:
        raise ValueError(f"vectors of different lengths: {np.unique(size[rows]).tolist()}")
    return rows, x[good[row]].astype(np.int64).reshape(len(rows), -1)


def products(x: np.ndarray) -> np.ndarray:
    """x' x exactly, as Python integers."""
    d = x.shape[1]
    out = np.zeros((d, d), object)
    top = int(np.abs(x).max()) if x.size else 0
    if top * top >= 1 << 52:
        y = x.astype(object)
        return out + y.T.dot(y)
    step = max(1, (1 << 53) // max(1, top * top) - 1)  # sums stay exact in a double
    for i in range(0, len(x), step):
        y = x[i:i + step].astype(np.float64)
        out += (y.T @ y).astype(np.int64).astype(object)
    return out


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per entry of a task's sums: (i, j, high, low), i = -1 for the plain sums, j = -1 for the count."""
    n, total, product = 0, None, None
    for b in batches:
        _, x = integers(b.column(0))
        if not len(x):
            continue
        if total is not None and len(total) != x.shape[1]:
            raise ValueError(f"vectors of different lengths: {len(total)}, {x.shape[1]}")
        s = x.astype(object).sum(0) if np.abs(x).max() >= 1 << 31 else x.sum(0).astype(object)
        p = products(x)
        n, total, product = n + len(x), s if total is None else total + s, p if product is None else product + p
    if n:
        d = len(total)
        rows = [(-1, -1, n), *[(-1, j, total[j]) for j in range(d)], *[(i, j, product[i, j]) for i in range(d) for j in range(i, d)]]
        low = (1 << LIMB) - 1
        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
            pa.array([int(r[2]) >> LIMB for r in rows], pa.int64()), pa.array([int(r[2]) & low for r in rows], pa.int64())], names=["i", "j", "high", "low"])


@dataclass
class Scatter:
    n: int
    sums: list[int]          # of the integers less SHIFT
    matrix: list[list[int]]  # n^2 times the covariance


def scatter(vectors: DataFrame, column: str = "embedding") -> Scatter | None:
    """Exact sums over all vectors; None if none takes part."""
    parts = vectors.select(column).mapInArrow(_summed, "i int, j int, high long, low long")
    got = parts.groupBy("i", "j").agg(F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"),
                                      F.count("*").alias("parts")).collect()
    if not got:
        return None
    value = {(r["i"], r["j"]): (int(r["high"]) << LIMB) + int(r["low"]) for r in got}
    if len({r["parts"] for r in got}) > 1:
        raise ValueError("vectors of different lengths")
    n = value[-1, -1]
    d = sum(1 for i, j in value if i == -1) - 1
    s = [value[-1, j] for j in range(d)]
    return Scatter(n, s, [[n * value[min(i, j), max(i, j)] - s[i] * s[j] for j in range(d)] for i in range(d)])


# -- characteristic polynomial --------------------------------------------------

def is_prime(n: int) -> bool:
    """Miller-Rabin; these bases decide every number below 2^64."""
    if n < 2:
        return False
    bases = (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37)
    for p in bases:
        if n % p == 0:
            return n == p
    r = ((n - 1) & (1 - n)).bit_length() - 1
    for a in bases:
        x = pow(a, (n - 1) >> r, n)
        if x in (1, n - 1):
            continue
        for _ in range(r - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes(least_product: int) -> list[int]:
    """Primes below 2^31, falling, whose product passes the bound, and one more."""
    out, product, p = [], 1, (1 << 31) - 1
    while True:
        if is_prime(p):
            out.append(p)
            if product > least_product:
                return out
            product *= p
        p -= 2


def coefficient_bound(m: list[list[int]]) -> int:
    """Of a positive semidefinite matrix: sums of products of k roots are at most C(d, k) (trace / d)^k."""
    d, trace = len(m), sum(m[i][i] for i in range(len(m)))
    return max(math.comb(d, k) * -(-trace ** k // d ** k) for k in range(d + 1))


def polynomials_mod(matrix: np.ndarray, moduli: np.ndarray) -> np.ndarray:
    """Characteristic polynomials modulo each prime: coefficients of x^0 .. x^d.

    ``matrix`` is (prime, d, d), reduced.  All primes go through the same steps
    together; only pivots differ.
    """
    a = matrix.astype(np.int64).copy()
    k, d, _ = a.shape
    p = moduli.astype(np.int64)[:, None]
    each = np.arange(k)

    def inverse(x: np.ndarray) -> np.ndarray:
        return np.array([pow(int(v), -1, int(q)) if v else 0 for v, q in zip(x, moduli)], np.int64)[:, None]

    for c in range(d - 2):
        # A nonzero entry below the diagonal becomes the pivot: swap its row and column.
        pivot = c + 1 + (a[:, c + 1:, c] != 0).argmax(1)
        for side in (0, 1):
            x = a if side == 0 else a.transpose(0, 2, 1)
            held = x[each, pivot].copy()
            x[each, pivot] = x[:, c + 1]
            x[:, c + 1] = held
        factor = a[:, c + 2:, c] * inverse(a[:, c + 1, c]) % p
        # Rows below less factor times the pivot row; the pivot column plus the columns below times the factors.
        a[:, c + 2:, c:] = (a[:, c + 2:, c:] - factor[:, :, None] * a[:, c + 1, None, c:] % p[:, :, None]) % p[:, :, None]
        add = np.zeros((k, d), np.int64)
        for r in range(c + 2, d):
            add = (add + a[:, :, r] * factor[:, r - c - 2, None] % p) % p
        a[:, :, c + 1] = (a[:, :, c + 1] + add) % p
    polys = np.zeros((d + 1, k, d + 1), np.int64)
    polys[0, :, 0] = 1
    for m in range(1, d + 1):
        q = np.zeros((k, d + 1), np.int64)
        q[:, 1:] = polys[m - 1][:, :-1]
        q = (q - polys[m - 1] * a[:, m - 1, m - 1, None]) % p
        below = np.ones((k, 1), np.int64)
        for i in range(m - 1, 0, -1):  # products of the entries under the diagonal
            below = below * a[:, i, i - 1, None] % p
            q = (q - polys[i - 1] * (below * a[:, i - 1, m - 1, None] % p) % p) % p
        polys[m] = q
    return polys[d]


PRIMES_A_TASK = 16


def characteristic_polynomial(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """Integer coefficients of x^0 .. x^d of det(x - m)."""
    d = len(m)
    moduli = primes(2 * coefficient_bound(m))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = np.asarray(b.column(0)).astype(np.int64)
            reduced = np.array([[[v % int(q) for v in row] for row in m] for q in own], np.int64).reshape(len(own), d, d)
            found = polynomials_mod(reduced, own)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(list(found), pa.list_(pa.int64()))], names=["p", "poly"])

    rows = spark.createDataFrame([(q,) for q in moduli], "p long").repartition(-(-len(moduli) // PRIMES_A_TASK))
    residues = {r["p"]: r["poly"] for r in rows.mapInArrow(run, "p long, poly array<long>").collect()}
    poly, product = [0] * (d + 1), 1
    for q in moduli[:-1]:
        inverse = pow(product, -1, q)
        poly = [c + product * ((r - c) * inverse % q) for c, r in zip(poly, residues[q])]
        product *= q
    poly = [c - product if 2 * c > product else c for c in poly]
    if [c % moduli[-1] for c in poly] != residues[moduli[-1]]:
        raise ArithmeticError("the characteristic polynomial does not agree with the check prime")
    return poly


# -- roots ------------------------------------------------------------------------

def roots_above(poly: list[int], t: int) -> int:
    """How many roots of a polynomial with real roots alone are above ``t``."""
    c = list(poly)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += t * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def largest_roots(poly: list[int], count: int, trace: int, bits: int = BITS) -> tuple[list[int], int]:
    """The largest roots, repeated ones repeated, as integers over 2^f, each
    rounded up; f is chosen for about ``bits`` bits below the trace."""
    d = len(poly) - 1
    f = max(0, bits - trace.bit_length())
    scaled = [c << f * (d - i) for i, c in enumerate(poly)]
    top = (trace << f) + 1
    ends: dict[int, int] = {0: roots_above(scaled, 0), top: 0}

    def above(t: int) -> int:
        if t not in ends:
            ends[t] = roots_above(scaled, t)
        return ends[t]

    def value(t: int) -> int:
        out = 0
        for c in reversed(scaled):
            out = out * t + c
        return out

    found = []
    for k in range(1, count + 1):
        if ends[0] < k:        # the rest are zero
            found.append(0)
            continue
        low = max(t for t, n in ends.items() if n >= k)
        high = min(t for t, n in ends.items() if n < k)
        while high - low > 1 and not (above(low) == k and above(high) == k - 1):
            mid = (low + high) // 2
            low, high = (mid, high) if above(mid) >= k else (low, mid)
        sign = value(high) > 0
        while high - low > 1:  # isolated: the sign of the polynomial tells the side
            mid = (low + high) // 2
            v = value(mid)
            if v == 0:
                low, high = mid - 1, mid
            elif (v > 0) == sign:
                high = mid
            else:
                low = mid
        found.append(high)
    return found, f


# -- components -------------------------------------------------------------------

def _unit(v: np.ndarray, bits: int) -> np.ndarray:
    """``v`` (integers over 2^bits) with length one."""
    top = max(abs(int(x)) for x in v)
    up = max(0, bits + 32 - top.bit_length())
    v = np.array([int(x) << up for x in v], object)
    length = math.isqrt(sum(int(x) * int(x) for x in v))
    return np.array([(int(x) << bits) // length for x in v], object)


def _eliminated(a: np.ndarray, bits: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """LU with row pivoting of integers over 2^bits: per column the pivot's row, the factors and the row of U."""
    a, d, steps = a.copy(), len(a), []
    for c in range(d):
        at = c + max(range(d - c), key=lambda i: abs(a[c + i, c]))
        a[[c, at]] = a[[at, c]]
        if a[c, c] == 0:
            a[c, c] = 1  # a null direction: the least positive number stands for zero
        factor = np.array([(int(x) << bits) // int(a[c, c]) for x in a[c + 1:, c]], object)
        if len(factor):
            a[c + 1:, c:] -= (factor[:, None] * a[None, c, c:]) >> bits
        steps.append((at, factor, a[c].copy()))
    return steps


def _solved(steps: list[tuple[int, np.ndarray, np.ndarray]], b: np.ndarray, bits: int) -> np.ndarray:
    b, d = b.copy(), len(b)
    for c, (at, factor, _) in enumerate(steps):
        b[[c, at]] = b[[at, c]]
        if len(factor):
            b[c + 1:] -= (factor * b[c]) >> bits
    for c in range(d - 1, -1, -1):
        row = steps[c][2]
        b[c] = ((int(b[c]) - (int((row[c + 1:] * b[c + 1:]).sum() if c + 1 < d else 0) >> bits)) << bits) // int(row[c])
    return b


def eigenvectors(m: list[list[int]], roots: list[int], f: int) -> np.ndarray:
    """Unit vectors (rows, float64) of the roots (integers over 2^f), largest first.

    Roots within 2^-64 of the trace of each other share a null space: their
    vectors are made orthogonal.
    """
    d = len(m)
    trace = max(1, sum(m[i][i] for i in range(d)))
    bits = BITS + GUARD
    lead = trace.bit_length()
    # m over 2^lead, so that entries are at most one in size.
    base = np.array([[(v << bits) >> lead for v in row] for row in m], object)
    rng = np.random.default_rng(5)
    out: list[np.ndarray] = []
    for k, root in enumerate(roots):
        a = base.copy()
        for i in range(d):
            a[i, i] -= ((root << bits) >> f) >> lead
        steps = _eliminated(a, bits)
        twins = [out[i] for i in range(k) if abs(roots[i] - root) << 64 <= trace << f]
        v = _unit(np.array([int(x) for x in rng.integers(-1 << 40, 1 << 40, d)], object), bits)
        for _ in range(3):
            v = _unit(_solved(steps, v, bits), bits)
            for _ in range(2):
                for u in twins:
                    v = v - ((u * (int((u * v).sum()) >> bits)) >> bits)
            v = _unit(v, bits)
        out.append(v)
    return np.array([[int(x) / (1 << bits) for x in v] for v in out], np.float64).reshape(len(roots), d)


# -- whitening ----------------------------------------------------------------------

@dataclass
class Whitening:
    n: int
    sums: np.ndarray        # of the integers less SHIFT, as float64 and exactly
    exact: list[int]
    vectors: np.ndarray     # components, rows
    deviation: np.ndarray   # square root of each component's variance
    explained: list[float | None]


def fit(vectors: DataFrame, column: str = "embedding", count: int = COMPONENTS) -> Whitening | None:
    s = scatter(vectors, column)
    if s is None:
        return None
    d = len(s.sums)
    count = min(count, d)
    trace = sum(s.matrix[i][i] for i in range(d))
    if trace == 0:  # all vectors are equal: any directions will do
        roots, f = [0] * count, 0
    else:
        roots, f = largest_roots(characteristic_polynomial(vectors.sparkSession, s.matrix), count, trace)
    found = eigenvectors(s.matrix, roots, f)
    # e = root / (2^f n^2); its square root from integers, so that huge numbers do not pass through a double.
    deviation = np.array([math.isqrt((r << 128) >> f) / (s.n << 64) for r in roots])
    explained = [r / (trace << f) if trace else None for r in roots]
    return Whitening(s.n, np.array([float(x) for x in s.sums]), s.sums, found, deviation, explained)


def projected(w: Whitening, x: np.ndarray) -> np.ndarray:
    """Whitened values of integer rows (less SHIFT); NaN where a component has no variance."""
    top = int(np.abs(x).max(initial=0)) + max(map(abs, w.exact), default=0) // w.n + 1
    if w.n * top < 1 << 62:
        centred = w.n * x - np.array(w.exact, np.int64)          # exact
    else:
        centred = w.n * x.astype(object) - np.array(w.exact, object)
    with np.errstate(divide="ignore", invalid="ignore"):
        out = (centred.astype(np.float64) / w.n) @ w.vectors.T / w.deviation
    out[:, w.deviation == 0] = np.nan
    return out


def deviations(w: Whitening, x: np.ndarray) -> list[int]:
    """Sum over dimensions of (n x - S)^2, exactly."""
    top = w.n * (int(np.abs(x).max(initial=0)) + max(map(abs, w.exact), default=0) // w.n + 1)
    kind = np.int64 if top * top * max(1, x.shape[1]) < 1 << 62 else object
    c = w.n * x.astype(kind) - np.array(w.exact, kind)
    return [int(v) for v in (c * c).sum(1)]


def identity_error(vectors: DataFrame, w: Whitening, column: str = "embedding") -> float | None:
    """Largest absolute entry of the whitened values' covariance less the
    identity, over components with variance; None without any."""
    use = np.flatnonzero(w.deviation > 0)
    if not len(use):
        return None

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(use))
        for b in batches:
            _, x = integers(b.column(0))
            if len(x):
                total += projected(w, x)[:, use].sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(use), dtype=np.int32)), pa.array(total)], names=["i", "v"])

    rows = vectors.select(column)
    sums = {r["i"]: r["v"] for r in rows.mapInArrow(mean, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()}
    centre = np.array([sums[i] for i in range(len(use))]) / w.n

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(use), len(use)))
        for b in batches:
            _, x = integers(b.column(0))
            if len(x):
                y = projected(w, x)[:, use] - centre
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["i", "v"])

    got = {r["i"]: r["v"] for r in rows.mapInArrow(spread, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()}
    cov = np.array([got[i] for i in range(len(use) ** 2)]).reshape(len(use), -1) / w.n
    return float(np.abs(cov - np.eye(len(use))).max())


SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
          "deviation_whole decimal(38,0)")


def whiten(vectors: DataFrame, column: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """Per vector and component (the ``count`` largest): whitened value and the fit's figures.

    ``vectors`` needs vec_id and the vectors' column; other columns are ignored.
    Vectors that are null or empty, or hold a null, a non-finite entry or one of
    2^42 or more in size, take no part; vectors of different lengths are an
    error.  Rows that share a vec_id, or have none, are vectors each.  Fewer
    dimensions than ``count`` give as many components.  A component without
    variance has whitened null and explained 0 (null if no component has
    any); identity_error is over the others, null without any.  ``deviation`` is
    null where it does not fit a long; ``deviation_whole`` is exact to 38 digits
    (null beyond).
    """
    w = fit(vectors, column, count)
    spark = vectors.sparkSession
    if w is None:
        return spark.createDataFrame([], SCHEMA)
    error = identity_error(vectors, w, column)
    k = len(w.deviation)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import decimal

        with decimal.localcontext(prec=60):
            for b in batches:
                rows, x = integers(b.column(1))
                if not len(rows):
                    continue
                n = len(rows)
                white = projected(w, x).ravel()
                dev = deviations(w, x)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(pa.array(np.repeat(rows, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * k, w.n), pa.int64()),
                    pa.array([v if v < 1 << 63 else None for v in dev for _ in range(k)], pa.int64()),
                    pa.array(white, pa.float64(), mask=np.isnan(white)),
                    pa.array(w.explained * n, pa.float64()),
                    pa.array([error] * (n * k), pa.float64()),
                    pa.array([decimal.Decimal(v) if v < 10 ** 38 else None for v in dev for _ in range(k)], pa.decimal128(38, 0)),
                ], names=[c.split()[0] for c in SCHEMA.replace("(38,0)", "").split(", ")])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), column).mapInArrow(run, SCHEMA)
