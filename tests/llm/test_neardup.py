import random

import numpy as np
import pytest

from mirrorsmith.llm import components, neardup
from tests.llm.util import WORD, empty, frame, odd_texts


def shingle_set(t, k):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(texts, ids, k, threshold=80):
    sets = [shingle_set(t, k) for t in texts]
    parent = {i: i for i in ids if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if None not in (ids[a], ids[b]) and sets[a] and sets[b] and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(ids[a]), root(ids[b])))
                parent[y] = x
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in zip(ids, sets)), key=repr)


def families(seed, groups=12, size=30, words=60):
    rnd = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{rnd.randint(0, 4000)}" for _ in range(words)]
        for _ in range(rnd.randint(1, size)):
            w = list(base)
            for _ in range(rnd.randint(0, 8)):
                w[rnd.randrange(len(w))] = f"v{rnd.randint(0, 4000)}"
            out.append(" ".join(w))
    rnd.shuffle(out)
    return out


def check(spark, texts, k, ids=None):
    got = neardup.near_duplicates(frame(spark, texts, ids=ids), k)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = got.collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=repr) == brute(texts, ids or list(range(len(texts))), k)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows if r["doc_id"] is not None)


@pytest.mark.parametrize("k", [2, 5])
def test_families(spark, k):
    check(spark, families(k) + odd_texts(), k)


def test_one_large_family_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 500)
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    texts = []
    for i in range(150):   # a chain of drifting copies and copies of its middle
        if i % 3 == 0:
            base[rnd.randrange(80)] = f"n{i}"
        w = list(base)
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(80)] = f"m{rnd.randint(0, 999)}"
        texts.append(" ".join(w))
    check(spark, texts + [texts[4]] * 40, 2)


def test_odd_ids_and_empty_table(spark):
    texts = ["a b c d e f", "a b c d e f", "A B c d e f", "", None, "z", "z y x w v u", "q"]
    check(spark, texts[:7], 2, ids=[5, 3, 9, 1, 2, 7, 8])
    rows = neardup.near_duplicates(frame(spark, texts, ids=[None, 3, 3, 4, 5, None, 6, 6])).collect()
    assert len(rows) == 8
    assert neardup.near_duplicates(empty(spark)).collect() == []
    assert neardup.keep_one(empty(spark)).collect() == []


def test_one_document_of_each_group_stays(spark):
    texts = families(4, groups=5) + odd_texts()
    df = frame(spark, texts)
    keep = {i for i, _, c in brute(texts, list(range(len(texts))), 5) if i == c}
    out = neardup.keep_one(df)
    assert out.dtypes == df.dtypes
    assert sorted(map(tuple, out.collect()), key=repr) == sorted((tuple(r) for r in df.collect() if r["doc_id"] in keep), key=repr)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    sig = lambda s: np.frombuffer(neardup.packed(neardup.minima(s)), np.uint8)
    for share in (0.0, 0.3, 0.6, 0.8, 1.0):
        errors = []
        for _ in range(30):
            p = rng.permutation(pool)
            n = int(400 * 2 * share / (1 + share))
            a, b = p[:400], np.concatenate([p[:n], p[400:800 - n]])
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append(neardup.estimates(sig(a), sig(b)[None, :])[0] - true)
        assert abs(np.mean(errors)) < 0.04 and np.max(np.abs(errors)) < neardup.MARGIN


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 300)] + [(400, 401), (401, 402), (402, 400), (500, 500)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 1 for i in range(2, 61)} | {i: 100 for i in range(101, 300)} | {401: 400, 402: 400}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []
