from fractions import Fraction

import numpy as np
import pytest

from mirrorsmith.llm import whitening as w

SCHEMA = "vec_id long, embedding array<float>, component int, n long, label int"


def frame(spark, vectors, ids=None):
    return spark.createDataFrame([(ids[i] if ids else i, v, 7, -1, None) for i, v in enumerate(vectors)], SCHEMA).repartition(3)


def plain_polynomial(m):
    """Faddeev-LeVerrier with fractions: coefficients of x^0 .. x^d."""
    d = len(m)
    c, b = [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for k in range(1, d + 1):
        b = [[sum(m[i][t] * b[t][j] for t in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        c.append(-sum(sum(m[i][t] * b[t][i] for t in range(d)) for i in range(d)) / k)
    return [int(x) for x in reversed(c)]


def random_scatter(seed, d, rows, size=10 ** 6):
    rng = np.random.default_rng(seed)
    x = rng.integers(-size, size, (rows, d)).astype(object)
    return (x.T.dot(x)).tolist()


@pytest.mark.parametrize("d,rows", [(1, 3), (2, 5), (7, 20), (9, 4)])
def test_polynomial(spark, d, rows):
    m = random_scatter(d, d, rows)
    assert w.characteristic_polynomial(spark, m) == plain_polynomial(m)


def test_polynomial_with_zero_pivots(spark):
    m = [[2, 0, 0, 1], [0, 3, 0, 0], [0, 0, 3, 0], [1, 0, 0, 2]]
    assert w.characteristic_polynomial(spark, m) == plain_polynomial(m)
    roots, f = w.largest_roots(plain_polynomial(m), 4, 10)
    assert [r / 2 ** f for r in roots] == [3, 3, 3, 1]
    v = w.eigenvectors(m, roots, f)
    assert np.abs(v @ v.T - np.eye(4)).max() < 1e-15 and np.abs(np.array(m) @ v.T - v.T * [3, 3, 3, 1]).max() < 1e-15


def expected(vectors, count=8):
    c = np.array(vectors, np.float32).astype(np.float64)
    x = np.floor(1024 * c).astype(np.int64) + 100000
    n, s = len(x), x.sum(0)
    centred = x - s / n
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:count], q[:, ::-1][:, :count]
    return n, ((n * x - s).astype(object) ** 2).sum(1), centred @ q / np.sqrt(e), e / np.trace(v)


def check(rows, vectors, count):
    n, dev, white, explained = expected(vectors, count)
    by = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(rows) == len(by) == n * count
    signs = [np.sign(by[0, k + 1]["whitened"] * white[0, k]) for k in range(count)]
    for i in range(n):
        for k in range(count):
            r = by[i, k + 1]
            assert (r["n"], r["deviation"], int(r["deviation_whole"])) == (n, dev[i], dev[i])
            assert abs(r["whitened"] - signs[k] * white[i, k]) < 1e-9 and abs(r["explained"] / explained[k] - 1) < 1e-9
    assert {r["identity_error"] for r in rows} and max(r["identity_error"] for r in rows) < 1e-10


@pytest.mark.parametrize("d,count", [(12, 8), (5, 5), (1, 1)])
def test_against_floating_point(spark, d, count):
    rng = np.random.default_rng(d)
    vectors = (rng.normal(size=(60, d)) * np.arange(1, d + 1)).astype(np.float32).tolist()
    got = w.whiten(frame(spark, vectors))
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got.collect(), vectors, count)


def test_vectors_that_take_no_part(spark):
    rng = np.random.default_rng(8)
    good = rng.normal(size=(40, 4)).astype(np.float32).tolist()
    bad = [None, [], [1.0, None, 2.0, 3.0], [float("nan"), 1.0, 1.0, 1.0], [float("inf"), 1.0, 1.0, 1.0], [1e30, 0.0, 0.0, 0.0]]
    check(w.whiten(frame(spark, good + bad)).collect(), good, 4)


def test_repeated_rows_and_ids(spark):
    rng = np.random.default_rng(9)
    some = rng.normal(size=(10, 3)).astype(np.float32).tolist()
    got = w.whiten(frame(spark, some + some, [None, 1, 1, *range(3, 20)])).collect()
    assert len(got) == 60 and sum(r["vec_id"] is None for r in got) == 3
    assert {r["n"] for r in got} == {20}


def test_equal_components(spark):
    """A cross: both directions have the same variance."""
    vectors = [[1.0, 0.0, 5.0], [-1.0, 0.0, 5.0], [0.0, 1.0, 5.0], [0.0, -1.0, 5.0]]
    rows = w.whiten(frame(spark, vectors)).collect()
    assert max(r["identity_error"] for r in rows) < 1e-12
    assert all(r["whitened"] is None and r["explained"] == 0 for r in rows if r["component"] == 3)
    assert [r["explained"] for r in rows if r["component"] < 3] == [0.5] * 8


def test_no_variance_and_one_row(spark):
    rows = w.whiten(frame(spark, [[2.0, 3.0]])).collect()
    assert [(r["component"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in rows] == [(1, 0, None, None, None), (2, 0, None, None, None)]


def test_large_entries_stay_exact(spark):
    vectors = [[float(2 ** 40 * (i % 3)), float(i)] for i in range(6)]
    rows = w.whiten(frame(spark, vectors)).collect()
    _, dev, _, _ = expected(vectors, 2)
    assert {r["vec_id"]: int(r["deviation_whole"]) for r in rows} == dict(enumerate(dev))
    assert {r["deviation"] for r in rows} <= {None, *[v for v in dev if v < 2 ** 63]}


def test_lengths_differ(spark):
    with pytest.raises(Exception, match="different lengths"):
        w.whiten(frame(spark, [[1.0, 2.0], [1.0]]))


def test_empty_table(spark):
    got = w.whiten(frame(spark, [[1.0]]).limit(0))
    assert got.collect() == [] and got.columns[0] == "vec_id"
