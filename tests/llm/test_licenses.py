import random
import re

import numpy as np
import pyarrow as pa

from mirrorsmith.llm import licenses
from tests.llm.util import empty, frame, odd_texts

WORDS = re.compile(r"[^\s!-/:-@\[-`{-~]+")


def plain_bigrams(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D!-/:-@\[-`{-~]+", low)
    return list(zip(w, w[1:]))


def best_dice(text, template):
    """Over all passages, by trying each."""
    seq, want = plain_bigrams(text), set(plain_bigrams(template))
    best = 0.0
    for i in range(len(seq)):
        have = set()
        for x in seq[i:]:
            have.add(x)
            best = max(best, 2 * len(have & want) / (len(have) + len(want)))
            if len(have) > 4 * len(want):
                break
    return best


def texts():
    rnd = random.Random(2)
    filler = [f"w{i}" for i in range(30)] + ["the", "license", "under", "of", "this", "all", "rights"]
    out = []
    for name, t in licenses.TEMPLATES.items():
        for edits in (0, 1, 3, 6):
            w = t.split()
            for _ in range(edits):
                w[rnd.randrange(len(w))] = rnd.choice(filler)
            pad = lambda: " ".join(rnd.choice(filler) for _ in range(rnd.randint(0, 25)))
            out.append(f"{pad()}\n{' '.join(w).upper() if edits == 1 else ' '.join(w)}\n{pad()}")
    out += ["all rights all rights all rights reserved", "all rights reserved " * 3, "rights reserved all", "Released—under the MIT License!"]
    return out + [t for t in odd_texts() if len(t or "") < 1000]


def test_best_passage_of_every_template():
    ts = texts()
    sets = dict(zip(licenses.TEMPLATES, [np.unique(s[at[i]:at[i + 1]]) for s, at in licenses.bigrams(pa.array(list(licenses.TEMPLATES.values()))) for i in range(len(at) - 1)]))
    seqs = [s[at[i]:at[i + 1]] for s, at in licenses.bigrams(pa.array(ts, pa.string())) for i in range(len(at) - 1)]
    assert [len(s) for s in seqs] == [len(plain_bigrams(t)) for t in ts]
    for t, seq in zip(ts, seqs):
        for name, wanted in sets.items():
            want = best_dice(t, licenses.TEMPLATES[name])
            got = max((d for d, *_ in licenses.passages(seq, wanted, 0.8)), default=0.0)
            assert got == (want if want >= 0.8 else 0.0), (name, t)


def test_report(spark):
    ts = texts() + [t for t in odd_texts() if len(t or "") >= 1000]
    rows = {r["doc_id"]: r for r in licenses.license_report(frame(spark, ts)).collect()}
    assert len(rows) == len(ts)
    for i, t in enumerate(ts):
        if len(t or "") >= 1000:
            assert rows[i]["license"] is None
            continue
        scores = {n: best_dice(t, x) for n, x in licenses.TEMPLATES.items()}
        over = sorted(n for n, d in scores.items() if d >= 0.8)
        r = rows[i]
        assert r["licenses"] == over and r["dice"] == (max(scores[n] for n in over) if over else 0.0)
        if over:
            assert scores[r["license"]] == r["dice"] and 0 <= r["first_word"] < r["end_word"] and r["n_passages"] >= len(over)
        else:
            assert r["license"] is None and r["n_passages"] == 0


def test_empty_and_shared_ids(spark):
    assert licenses.license_report(empty(spark)).collect() == []
    rows = licenses.license_report(frame(spark, ["All rights reserved.", "x", None], ids=[1, 1, None])).collect()
    assert sorted((r["doc_id"] or 0, r["license"] or "") for r in rows) == [(0, ""), (1, ""), (1, "all-rights-reserved")]


SIBLINGS = {
    "This work is licensed under the GNU General Public License, version 2.": "gpl-2.0",
    "This work is licensed under the GNU Affero General Public License, version 3.": "agpl-3.0",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
    "by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.": "lgpl-2.1-header",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published "
    "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": "agpl-3.0-header",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
    "Free Software Foundation; either version 2 of the License, or (at your option) any later version.": "gpl-2.0-header",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": "cc-by-nc-4.0-notice",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.": "cc-by-nd-4.0",
    "Licensed under CC BY-NC-SA 4.0.": "cc-by-nc-sa-4.0-short",
    "Licensed under the Apache License, Version 1.1.": "apache-1.1",
}


def test_siblings_and_whole_texts(spark):
    whole = licenses.whole_texts()
    rnd = random.Random(5)
    texts, want = list(SIBLINGS), list(SIBLINGS.values())
    for name, t in whole.items():
        w = t.split()
        for _ in range(len(w) // 60):
            w[rnd.randrange(len(w))] = "changed"
        texts += [f"notes before it\n{t}\nand after", " ".join(w)]
        want += [name, name]
    at = whole["apache-2.0-whole"].index("2. Grant of Copyright License")
    texts.append(whole["apache-2.0-whole"][:at])   # a small part of a text is not the text
    want.append(None)
    rows = {r["doc_id"]: r for r in licenses.license_report(frame(spark, texts)).collect()}
    for i, name in enumerate(want):
        assert rows[i]["license"] == name, (name, rows[i]["license"], rows[i]["dice"])
    assert all(rows[i]["dice"] == 1.0 for i in range(len(SIBLINGS)))


def test_repetitive_texts_take_linear_time():
    """One notice very many times, alone and before other text; results as for few."""
    import time

    name = "all-rights-reserved"
    wanted = next(np.unique(s) for s, _ in licenses.bigrams(pa.array([licenses.TEMPLATES[name]])))
    seq = lambda t: next(s for s, _ in licenses.bigrams(pa.array([t], pa.large_string())))
    tail = " ".join(f"word{i}" for i in range(3000))
    for text, count in (("all rights reserved. " * 8000, 8000), ("all rights reserved. " * 4000 + tail + " all rights reserved", 4001), ("rights all " * 20_000, 0)):
        s = seq(text)
        start = time.process_time()
        found = licenses.passages(s, wanted, 0.8)
        assert time.process_time() - start < 3 and len(found) == count and all(d == 1.0 for d, *_ in found)


def test_first_occurrences_seen_from_any_place():
    rng = np.random.default_rng(6)
    for n, kinds in ((1, 1), (40, 5), (700, 3), (900, 400), (1500, 20)):
        seq = rng.integers(0, kinds, n).astype(np.uint64)
        seq[n // 3:2 * n // 3] = 1
        f = licenses.Firsts(seq)
        for a in range(0, n, 1 + n // 50):
            for most in (1, 3, 30):
                for end in (None, (a + n) // 2 + 1):
                    seen, want = set(), []
                    for x in range(a, n if end is None else end):
                        if seq[x] not in seen:
                            seen.add(seq[x])
                            want.append(x)
                    got = f.of(a, most, end).tolist()
                    assert got == want[:len(got)] and len(got) >= min(most, len(want))
