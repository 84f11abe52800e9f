import random

import numpy as np
import pytest
import xxhash

from mirrorsmith.llm import simhash
from tests.llm.util import WORD, empty, frame, odd_texts


def plain_fingerprint(text, k=4):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    s = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def groups(codes, distance):
    """Component of each position by all pairs; the smallest position names it."""
    parent = list(range(len(codes)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(codes)):
        for b in range(a):
            if (int(codes[a]) ^ int(codes[b])).bit_count() <= distance:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [root(i) for i in range(len(codes))]


def copies(seed, n):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        w = [f"w{rnd.randint(0, 500)}" for _ in range(rnd.randint(40, 120))]
        for _ in range(rnd.randint(1, 8)):
            x = list(w)
            for _ in range(rnd.randint(0, 3)):
                x[rnd.randrange(len(x))] = f"v{rnd.randint(0, 500)}"
            out.append(" ".join(x))
    return out


@pytest.mark.parametrize("ids", [None, "odd"])
def test_against_all_pairs(spark, ids):
    texts = copies(1, 25) + odd_texts()
    ids = list(range(len(texts))) if ids is None else [None, 7, 7, *range(100, 97 + len(texts))]
    got = simhash.simhash_groups(frame(spark, texts, ids=ids))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    codes = [plain_fingerprint(t) for t in texts]
    place = groups(codes, 4)
    least = {}
    for p, i in zip(place, ids):
        if i is not None:
            least[p] = min(i, least.get(p, i))
    want = [(i, f"{c:016x}", least.get(p)) for i, c, p in zip(ids, codes, place)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def dense(seed, n, free):
    """Codes that differ from one code in at most ``free`` bits: every segment is shared by most."""
    rnd = random.Random(seed)
    base = rnd.getrandbits(64)
    return sorted({base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, free))) for _ in range(n)})


@pytest.mark.parametrize("codes", [dense(1, 1500, 9), dense(2, 700, 20) + dense(3, 700, 3), [5], [0, (1 << 64) - 1]])
def test_links_of_shared_segments(spark, codes):
    """Runs that span ranges are blocks that meet; components equal those of all pairs."""
    df = spark.createDataFrame([(int(np.uint64(c).astype(np.int64)),) for c in codes], "code long")
    edges = [(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in simhash.links(df).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in edges)
    at = {c: i for i, c in enumerate(codes)}
    parent = np.arange(len(codes))
    simhash.joined(parent, np.array([at[a] for a, _ in edges], np.int64), np.array([at[b] for _, b in edges], np.int64))
    assert parent.tolist() == groups(codes, 4)


def test_search_prunes_groups():
    """The index looks at a small part of random codes and finds all near ones."""
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 1 << 63, 1 << 14, dtype=np.uint64)
    rank = codes.copy()
    for step in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(step)
    codes = codes[np.argsort(rank)]
    index = simhash.GrayIndex(codes)
    queries = codes[::997] ^ np.uint64(0b10010001)
    seen = []

    def count(level, q, node):
        if level == 0:
            seen.append(len(q))
        return np.zeros(len(q), bool)

    n = np.full(len(queries), len(codes))
    got = {(int(q), int(c)) for a, b in index.search(queries, n * 0, n, 4, count) for q, c in zip(a, b)}
    near = np.bitwise_count(queries[:, None] ^ codes[None, :]) <= 4
    assert got == {(int(q), int(c)) for q, c in zip(*np.nonzero(near))}
    assert sum(seen) < 0.5 * near.size


def test_empty_table(spark):
    assert simhash.simhash_groups(empty(spark)).collect() == []
