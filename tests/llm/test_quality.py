import random
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa

from mirrorsmith.llm import quality, text
from tests.llm.util import WORD, empty, frame, labels, odd_texts


def plain_shape(word, last):
    upper = [c for c in word if "A" <= c <= "Z"]
    lower = [c for c in word if "a" <= c <= "z" or ord(c) > 127]
    digit = [c for c in word if "0" <= c <= "9"]
    stop = set(".,")
    punct = [c for c in word if 32 < ord(c) < 128 and not ("a" <= c.lower() <= "z") and not c.isdigit() and c not in stop]
    # Bytes of non-ASCII letters count; only whether there are any matters.
    case = (0 if lower else 1) if not upper else 2 if len(upper) == 1 and word[0] == upper[0] and lower else 3 if not lower else 4
    tail = 1 if word[-1] in stop else 2 if word[-1] in punct else 0
    length = sum(len(word) >= n for n in (2, 3, 4, 6, 9, 15, 30))
    shape = length
    for value, size in ((case, 5), (tail, 3), (min(len(punct), 3), 4), (min(len(digit), 2), 3), (int(word == last), 2)):
        shape = shape * size + value
    return shape


def plain_counts(t):
    out = Counter()
    last, before = None, None
    for w in WORD.findall(t or ""):
        s = plain_shape(w, last)
        out[s] += 1
        if before is not None:
            out[(before, s)] += 1
        last, before = w, s
    return out


def ngrams(texts):
    out = []
    for _, _, buf, off in text.chunks(pa.array(texts, pa.string())):
        bucket, doc = quality.ngram_buckets(buf, off)
        out += [Counter(bucket[doc == i].tolist()) for i in range(len(off) - 1)]
    return out


def test_shapes_and_ngrams():
    texts = odd_texts() + ["A b. C, DD dd dd dd 12 a1 $$$ x$$ É éa,", "LOUD!! LOUD!! x"]
    got = ngrams(texts)
    shape = {}
    for t, g in zip(texts, got):
        want = plain_counts(t)
        assert sum(want.values()) == sum(g.values())
    flat = [(s, row) for _, _, buf, off in text.chunks(pa.array(texts, pa.string())) for s, row in [quality.shapes(buf, off)]]
    all_shapes = [list(s[row[i]:row[i + 1]]) for s, row in flat for i in range(len(row) - 1)]
    for t, s in zip(texts, all_shapes):
        w = WORD.findall(t or "")
        assert s == [plain_shape(x, w[i - 1] if i else None) for i, x in enumerate(w)], (t, shape)


def corpus(n=600):
    rnd = random.Random(5)
    good = ["the", "of", "House", "river,", "walked.", "é", "along", "quickly"]
    out, lab = [], []
    for i in range(n):
        if i % 7 == 3:
            out.append(" ".join(rnd.choice(["BUY!!", "$$$", "NOW**", "x|", "|"]) for _ in range(rnd.randint(5, 60))))
        else:
            out.append(" ".join(rnd.choice(good) for _ in range(rnd.randint(5, 60))))
        if i % 2:
            lab.append((i, int(i % 7 != 3), 0))
    return out, lab


def test_scores_cut_and_draw(spark):
    texts, lab = corpus()
    texts += odd_texts()[:11]
    df, lb = frame(spark, texts), labels(spark, lab)
    model = quality.fit(df, lb)
    assert model.good == np.mean([q for _, q, _ in lab])
    total, good = Counter(), Counter()
    ids = {d for d, q, _ in lab if q}
    per = ngrams(texts)
    for i, c in enumerate(per):
        total.update(c)
        if i in ids:
            good.update(c)
    half = quality.BUCKETS // 2
    for lo in (0, half):
        t = sum(v for k, v in total.items() if lo <= k < lo + half)
        g = sum(v for k, v in good.items() if lo <= k < lo + half)
        for k in range(lo, lo + half, 97):
            want = np.log((good[k] + .5) / (g + .5 * half) / ((total[k] + .5) / (t + .5 * half)))
            assert abs(model.log_ratio[k] - want) < 1e-9
    rows = quality.quality_report(df, lb, effective=64).collect()
    assert len(rows) == len(texts)
    k = 0
    for r in rows:
        c = per[r["doc_id"]]
        plain = sum(model.log_ratio[b] * n for b, n in c.items())
        assert abs(r["log_importance"] - plain) < 1e-6 * max(1, abs(plain))
        want = 64 * plain / max(1, sum(c.values()))
        assert abs(r["log_weight"] - want) < 1e-6 * max(1, abs(want)) and r["n"] == sum(c.values())
        k += r["log_weight"] / 64 >= np.log(0.5 / model.good)
    keys = sorted((r["key"] for r in rows), reverse=True)
    assert all(r["kept"] == (r["key"] >= keys[k - 1]) for r in rows)
    kept = {r["doc_id"] for r in rows if r["kept"]}
    assert all((i in kept) == (i % 7 != 3) for i in range(600))
    drawn = quality.draw(df, lb, effective=64)
    assert drawn.dtypes == df.dtypes
    assert {tuple(r) for r in drawn.collect()} == {tuple(r) for r in df.collect() if r["doc_id"] in kept}
    assert sorted(map(tuple, rows)) == sorted(map(tuple, quality.quality_report(df.repartition(8), lb, effective=64).collect()))


def test_empty_tables_and_odd_labels(spark):
    lb = spark.createDataFrame([(None, 1, 0), (0, None, 0), (1, 1, 0), (1, 1, 0), (99, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.quality_report(empty(spark), lb).collect() == []
    assert quality.draw(empty(spark), lb).collect() == []
    docs = frame(spark, ["a b", None, "", "c"], ids=[None, 1, 1, 2])
    assert len(quality.quality_report(docs, lb).collect()) == 4
    assert quality.draw(docs, labels(spark, [])).count() == 4


def test_plain_importance_draws_by_the_sum(spark):
    texts, lab = corpus(300)
    df, lb = frame(spark, texts), labels(spark, lab)
    rows = quality.quality_report(df, lb).collect()
    noise = {r["doc_id"]: r["g"] for r in df.select("doc_id", quality.gumbel().alias("g")).collect()}
    model = quality.fit(df, lb)
    k = sum(r["log_importance"] / max(1, r["n"]) >= np.log(0.5 / model.good) for r in rows)
    keys = sorted((r["key"] for r in rows), reverse=True)
    for r in rows:
        assert r["log_weight"] == r["log_importance"] and abs(r["key"] - r["log_importance"] - noise[r["doc_id"]]) < 1e-9
        assert r["kept"] == (r["key"] >= keys[k - 1])
    drawn = quality.draw(df, lb)
    assert {r["doc_id"] for r in drawn.collect()} == {r["doc_id"] for r in rows if r["kept"]}


def test_held_out_labels(spark):
    texts, lab = corpus()
    df, lb = frame(spark, texts), labels(spark, lab)
    got = {(r["quality"], r["kept"]): r["documents"] for r in quality.judged(df, lb, effective=64).collect()}
    unseen = [q for d, q, _ in lab if crc32(str(d).encode()) % 5 == 0]
    assert got == {(1, True): sum(unseen), (0, False): len(unseen) - sum(unseen)}
    # what a held-out label says does not matter to the fit
    other = labels(spark, [(d, 1 - q if crc32(str(d).encode()) % 5 == 0 else q, t) for d, q, t in lab])
    turned = {(r["quality"], r["kept"]): r["documents"] for r in quality.judged(df, other, effective=64).collect()}
    assert turned == {(1 - q, kept): n for (q, kept), n in got.items()}
