import hashlib

import numpy as np
from pyspark.sql import functions as F

from mirrorsmith.llm import fingerprint
from tests.llm.util import WORD, empty, frame, odd_texts


def shingle_set(t):
    w = WORD.findall(t)
    return set(zip(*[w[i:] for i in range(5)])) if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def texts():
    rng = np.random.default_rng(1)
    out = odd_texts()
    base = [f"w{i}" for i in rng.integers(0, 500, 200)]
    for i in range(60):
        w = list(base)
        for j in rng.integers(0, 200, i):
            w[j] = f"n{i}"
        out.append(" ".join(w))
    return out


def check(spark, t, ids, df):
    got = fingerprint.fingerprint_report(df).collect()
    assert len(got) == len(t)
    order = sorted(range(len(t)), key=lambda i: -ids[i])
    rows = {r["doc_id"]: r for r in got}
    errors, by_text = [], {}
    for k, i in enumerate(order):
        own, after = t[i] or "", t[order[(k + 1) % len(order)]] or ""
        half = len(own) // 2
        new = own[:len(own) - half] + after[:half]
        r = rows[ids[i]]
        assert r["n_chars"] == len(own) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert by_text.setdefault(own, r["fingerprint"]) == r["fingerprint"]
        assert by_text.setdefault(new, r["edited_fingerprint"]) == r["edited_fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if own == after:
            assert r["near_next"] == 1
        errors += [r["near_edited"] - jaccard(own, new), r["near_next"] - jaccard(own, after)]
    return errors


def test_against_plain_version(spark):
    t = texts()
    ids = [(i * 37) % 1009 - 300 for i in range(len(t))]
    errors = check(spark, t, ids, frame(spark, t, ids=ids))
    assert np.abs(errors).max() < 0.2 and abs(np.mean(errors)) < 0.03


def test_many_ranges_and_few_rows(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 29)
    try:
        t = texts()[:40]
        check(spark, t, list(range(40)), frame(spark, t))
        check(spark, t[8:10], [5, 3], frame(spark, t[8:10], ids=[5, 3]))
        check(spark, ["a b c"], [7], frame(spark, ["a b c"], ids=[7]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_slices(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "SLICE", 300)
    t = texts()[8:60]
    check(spark, t, list(range(len(t))), frame(spark, t).coalesce(1))


def test_missing_and_shared_ids(spark):
    df = frame(spark, ["a b", "c d", "e f", "e f", None, "g"], ids=[None, 4, 4, 4, None, 9])
    got = fingerprint.fingerprint_report(df).collect()
    assert len(got) == 6 and sorted(r["n_chars"] for r in got) == [0, 1, 3, 3, 3, 3]
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, fingerprint.fingerprint_report(df.repartition(5)).collect()), key=repr)
    assert fingerprint.fingerprint_report(empty(spark)).collect() == []


def test_shared_ids_spread_over_the_ranges(spark):
    """Half the rows without an id: no range holds more than twice the median."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    try:
        n = 2000
        df = frame(spark, [f"text {i} of {i * i}" for i in range(n)], ids=[None if i % 2 else i for i in range(n)])
        got = fingerprint.fingerprint_report(df)
        sizes = sorted(r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
        assert sum(sizes) == n and len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]
        want = {(i, f"text {j} of {j * j}") for i, j in zip(range(0, n, 2), range(-2, n - 2, 2)) if j >= 0}
        digest = {(r["doc_id"], r["edited_sha256"]) for r in got.collect()}
        for i, after in want:
            own = f"text {i} of {i * i}"
            half = len(own) // 2
            assert (i, hashlib.sha256((own[:len(own) - half] + after[:half]).encode()).hexdigest()) in digest
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_likeness_is_unbiased():
    rng = np.random.default_rng(3)
    for share in (0.0, 0.25, 0.5, 0.9, 1.0):
        for n in (8, 60, 2000):
            errors = []
            for _ in range(40):
                # Words of one letter class each: a shingle is five words, so lines of five distinct words are one shingle each.
                pool = [f"x{v}" for v in rng.integers(0, 1 << 40, 3 * n)]
                k = int(n * share)
                a, b = " ".join(pool[:n]), " ".join(pool[:k] + pool[n:2 * n - k])
                (la, lb), some = fingerprint.bin_values([a, b])[0], fingerprint.bin_values([a, b])[1]
                errors.append(fingerprint.likeness(la[None], some[:1], lb[None], some[1:])[0] - jaccard(a, b))
            assert abs(np.mean(errors)) < 0.05
