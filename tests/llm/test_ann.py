import math

import numpy as np
import pytest

from mirrorsmith.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, ids int, block string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "b") for i, v in rows], SCHEMA).repartition(3)


def brute(rows, every=20, k=20):
    ok = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and v is not None and None not in v and all(map(math.isfinite, v)) and any(v)}
    out = {}
    for q in ok:
        if q % every == 0:
            out[q] = sorted(((i, float((ok[i] * ok[q]).sum())) for i in ok if i != q), key=lambda x: (-x[1], x[0]))[:k]
    return out


def test_recall_order_and_scores(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 24))
    x[:700] = x[0] + 0.05 * rng.normal(size=(700, 24))
    x[700:1100] = x[700]                      # equal vectors: ties to the smaller id
    x[1100:] *= rng.uniform(0.2, 3, (400, 1))  # lengths differ: largest product, not angle
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    want, got = brute(rows), {}
    for r in ann.nearest(frame(spark, rows)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(want)
    found = 0
    for q, g in got.items():
        g.sort()
        assert [r for r, *_ in g] == list(range(1, 21)) and q not in [i for _, i, _ in g]
        assert [(-s, i) for _, i, s in g] == sorted((-s, i) for _, i, s in g)
        exact = {i: s for i, s in brute(rows, k=len(rows))[q]} if q < 60 else None
        if exact:
            assert all(abs(exact[i] - s) < 1e-9 for _, i, s in g)
        found += len({i for _, i, _ in g} & {i for i, _ in want[q]})
    assert found >= 0.95 * 20 * len(want)


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 256, (600, ann.TABLES), dtype=np.uint8)
    codes[300:] = codes[0] ^ np.packbits(rng.random((300, ann.BITS)) < rng.random((300, 1)) / 2, axis=1)
    index = ann.Index(codes)
    for radius in (0, 5, 31, 32, 70, 101, 128, 255, 256):
        for q in (codes[0], codes[5]):
            apart = np.bitwise_count(codes ^ q).sum(axis=1)
            assert index.within(q, radius).tolist() == np.flatnonzero(apart <= radius).tolist()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (40, None), (60, [0.0, 0.0]), (None, [1.0, 0.0]), (7, [-1.0, 0.0]), (9, [])]
    got = {}
    for r in ann.nearest(frame(spark, rows + rows[:3])).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    want = {q: {i + 1: x for i, x in enumerate(v)} for q, v in brute([r for r in rows if r[1] is None or len(r[1]) == 2]).items()}
    assert got == want


def test_different_lengths_are_an_error(spark):
    with pytest.raises(ValueError, match="2 to 3"):
        ann.nearest(frame(spark, [(0, [1.0, 0.0]), (8, [1.0, 2.0, 3.0])]))


def test_blocks_are_copied_once_and_queries_stream(spark, monkeypatch):
    """Smaller blocks, more of them, and several groups of queries: the same neighbours."""
    rng = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 8)))]
    whole = sorted(map(tuple, ann.nearest(frame(spark, rows), every=4, k=5).collect()))
    want = brute(rows, 4, 5)
    for vectors, queries in ((100, 1000), (64, 30)):
        monkeypatch.setattr(ann, "VECTOR_BLOCK", vectors)
        monkeypatch.setattr(ann, "QUERY_BLOCK", queries)
        got = sorted(map(tuple, ann.nearest(frame(spark, rows), every=4, k=5).collect()))
        assert [g[:2] for g in got] == [w[:2] for w in whole]
        assert sum((i in {x for x, _ in want[q]}) for q, _, i, _ in got) >= 0.95 * 5 * len(want)


def test_no_vectors(spark):
    assert ann.nearest(frame(spark, [])).collect() == []
    assert ann.nearest(frame(spark, [(0, None), (20, [0.0])])).collect() == []
    assert ann.nearest(frame(spark, [(20, [1.0])])).collect() == []
