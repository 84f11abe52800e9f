from collections import Counter

import pytest

from mirrorsmith.llm import mix
from tests.llm.util import WORD, empty, frame, odd_texts


def plain_targets(sizes, weights=(5, 2, 1), budget=1.5, passes=2):
    """Targets by filling up and resharing until no source is above its limit."""
    total = sum(sizes.values())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    done, left = {}, dict(w)
    while left:
        share = (budget * total - sum(done.values())) / sum(left.values())
        over = [s for s in left if left[s] * share > passes * sizes[s]]
        if not over:
            return done | {s: left[s] * share for s in left}
        for s in over:
            done[s] = passes * sizes[s]
            del left[s]
    return done


def check(report, texts, sources):
    size = [len(WORD.findall(t or "")) for t in texts]
    by_source = Counter()
    for s, n in zip(sources, size):
        by_source[s] += n
    want = plain_targets(by_source)
    taken = Counter()
    for r in report:
        s = sources[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == by_source[s]
        assert r["target"] == pytest.approx(want[s])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[s] += r["taken"]
    longest = max(size, default=0)
    for s in by_source:
        assert abs(taken[s] - want[s]) <= 2 * longest


def test_targets_and_words_taken(spark):
    texts = ["w " * (1 + i * 7 % 50) for i in range(400)]
    sources = [None if i % 11 == 0 else "é" if i % 7 == 0 else "hot" if i % 3 else f"s{i % 5}" for i in range(400)]
    df = frame(spark, texts, sources=sources)
    one = mix.mix_report(df).collect()
    assert len(one) == 400
    check(one, texts, sources)
    assert sorted(map(tuple, one)) == sorted(map(tuple, mix.mix_report(df.repartition(7)).collect()))


def test_odd_rows(spark):
    texts = odd_texts()
    sources = [None if i % 2 else "a" for i in range(len(texts))]
    check(mix.mix_report(frame(spark, texts, sources=sources)).collect(), texts, sources)


def test_documents_are_taken_as_often_as_reported(spark):
    texts = odd_texts() + ["a b c"] * 20
    df = frame(spark, texts)
    want = Counter({r["doc_id"]: r["taken"] // r["size"] for r in mix.mix_report(df).collect() if r["taken"]})
    out = mix.mix_documents(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    got = out.collect()
    assert Counter(r["doc_id"] for r in got) == want
    assert {tuple(r) for r in got} <= {tuple(r) for r in df.collect()}


def test_rows_that_share_a_doc_id_go_together(spark):
    ids = [None, None, 5, 5, 5, 6, 7, 8]
    df = frame(spark, ["a b", "a b", "c", "c", "d e f", "g", "h", "i"], ids=ids, sources=["s"] * 8)
    got = {}
    for r in mix.mix_report(df).collect():
        got.setdefault(r["doc_id"], set()).add(r["taken"] // r["size"])
    assert all(len(v) == 1 for v in got.values())


def test_empty_table_and_all_blank(spark):
    assert mix.mix_report(empty(spark)).collect() == []
    assert mix.mix_documents(empty(spark)).collect() == []
    blank = mix.mix_report(frame(spark, ["", None, " "])).collect()
    assert [(r["size"], r["taken"]) for r in blank] == [(0, 0)] * 3


def test_no_python_in_the_plan(spark):
    for df in (mix.mix_report(frame(spark, ["a b", "c"])), mix.mix_documents(frame(spark, ["a b", "c"]))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
