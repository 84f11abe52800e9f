import itertools
import math
import random
from collections import Counter
from zlib import crc32

import pyarrow as pa
import pytest

from mirrorsmith.llm import toxicity
from mirrorsmith.llm.toxicity import Lexicon
from tests.llm.util import empty, frame, labels, odd_texts


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[:], i + 1
        for j, y in enumerate(b):
            row[j + 1] = min(last[j + 1] + 1, row[j] + 1, last[j] + (x != y))
    return row[-1]


def test_automaton_accepts_what_the_distance_says():
    entries = ["idiot", "trash", "scum", "loser", "los*", "ab", "abcde", "abcdf"]
    lexicon = Lexicon(entries)
    whole = [e for e in entries if not e.endswith("*")]
    rnd = random.Random(1)
    words = ["".join(p) for p in itertools.product("abcde", repeat=4)] + ["loss", "lose", "los", "lo", "", "losser", "oser", "lozer", "xloser"]
    for e in whole:
        for _ in range(400):
            w = list(e)
            for _ in range(rnd.randint(0, 2)):
                i = rnd.randrange(len(w) + 1)
                w[i:i + rnd.randint(0, 1)] = rnd.choice(["", "x", "a", "d"])
            words.append("".join(w))
    for w in words:
        exact = [e for e in whole if e == w]
        begun = [e for e in entries if e.endswith("*") and w.startswith(e[:-1])]
        near = [e for e in whole if len(e) >= toxicity.FUZZY_FROM and distance(e, w) == 1]
        m = lexicon.match(w)
        if exact:
            assert (entries[m >> 1], m & 1) == (exact[0], 0), w
        elif begun:
            assert (entries[m >> 1], m & 1) == (begun[0], 0), w
        elif near:
            assert entries[m >> 1] in near and m & 1 == 1, w
        else:
            assert m == -1, w


@pytest.mark.parametrize("text,want", [
    ("you idiot go", False), ('he said "you idiot" and left', True), ("they called them idiot again", True), ('"fine" you idiot', False),
    ("«idiot»", True), ('"never" answered nobody, idiot "ever"', False), ("idiot", False)])
def test_quotation(text, want):
    found = list(toxicity.hits(pa.array([text]), Lexicon(["idiot"]), {}))
    assert found[0][1] == Counter({int(want): 1})


def test_terms():
    assert [toxicity.term(w) for w in ("Idiot!!", '"1d10t"', "(trash)", "12", "$cum,", "É.")] == ["idiot", "idiot", "trash", "12", "scum", "é"]


def corpus():
    rnd = random.Random(7)
    plain = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i % 7)}" for i in range(400)]
    bad = ["wretch", "vermin", "numbskull", "dimwit"]
    texts, lab = [], []
    for i in range(900):
        w = [rnd.choice(plain) for _ in range(rnd.randint(5, 40))]
        toxic = i % 6 == 1
        if toxic:
            for b in rnd.sample(bad, 2):
                w.insert(rnd.randrange(len(w)), b)
        texts.append(" ".join(w))
        lab.append((i, 1, int(toxic)))
    return texts, lab


def test_learns_and_scores_held_out_rows(spark):
    texts, lab = corpus()
    more = ["you numbskul wab wretchh", "a person wrote \"dimwit\" once wab", *odd_texts()]
    df, lb = frame(spark, texts + more), labels(spark, lab[:600])
    model = toxicity.fit(df, lb)
    assert set(model.lexicon.entries) == {"wretch", "vermin", "numbskull", "dimwit"}
    rows = {r["doc_id"]: r for r in toxicity.toxicity_report(df, lb).collect()}
    assert len(rows) == len(texts) + len(more)
    for i, r in rows.items():
        assert r["held_out"] == (crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if i < 900:
            assert r["predicted"] == lab[i][2]
    n = len(texts)
    assert rows[n]["predicted"] == 1                                  # misspelled
    told = "a person wrote dimwit once wab".replace("wrote ", "")
    alone = toxicity.toxicity_report(frame(spark, texts + [told]), lb).filter(f"doc_id = {n}").first()
    assert rows[n + 1]["score"] < alone["score"]                      # quoted counts less
    assert all(rows[n + 2 + k]["predicted"] == 0 for k in range(len(odd_texts())))


def test_score_depends_on_the_text_alone(spark):
    texts, lab = corpus()
    one = toxicity.toxicity_report(frame(spark, texts[:200], sources=["a"] * 200), labels(spark, lab))
    two = toxicity.toxicity_report(frame(spark, texts[:200], sources=[None] * 200).repartition(7), labels(spark, lab))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_empty_tables_and_odd_labels(spark):
    texts, lab = corpus()
    odd = spark.createDataFrame([(None, 1, 1), (3, 1, None), *lab[:300], lab[7], lab[7]], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity_report(empty(spark), odd).collect() == []
    assert toxicity.toxicity_report(frame(spark, texts[:9], ids=[None, 1, 1, 2, 3, 4, 5, 6, 7]), odd).count() == 9
    for lb in (labels(spark, []), labels(spark, [x for x in lab if not x[2]])):
        assert {r["predicted"] for r in toxicity.toxicity_report(frame(spark, texts[:9]), lb).collect()} == {0}


def test_misspelled_beginnings():
    short = Lexicon(["idio*"], forms={"idiots": "idio*", "idiotic": "idio*"})
    assert [short.match(w) for w in ("idiots", "idioms", "iddiots", "idjots", "diotic", "idxxots", "idols")] == [0, 0, 1, 1, 1, -1, -1]
    long = Lexicon(["idiot*", "trash"])
    assert [long.match(w) for w in ("idiotically", "iddiotically", "idjotically", "diotically", "idiom", "idxxtically", "trasch")] == [0, 1, 1, 1, -1, -1, 3]
    assert Lexicon(["idiot*", "idjots"]).match("idjots") == 2


def test_misspelled_inflected_term(spark):
    texts, lab = corpus()
    rnd = random.Random(3)
    texts = [" ".join(w for w in t.split() if w not in ("wretch", "vermin", "numbskull", "dimwit")) for t in texts]
    forms = ["idiot", "idiots", "idiotic", "idiotically", "idiocy"]
    texts = [f"{t} {rnd.choice(forms)}" if lab[i][2] else t for i, t in enumerate(texts)]
    more = ["waa iddiots wba", "waa idjots wba", "waa iddiotically wba"]
    df, lb = frame(spark, texts + more), labels(spark, lab)
    assert toxicity.fit(df, lb).lexicon.entries[0].endswith("*")
    rows = {r["doc_id"]: r for r in toxicity.toxicity_report(df, lb).collect()}
    assert [(rows[len(texts) + i]["n_hits"], rows[len(texts) + i]["predicted"]) for i in range(len(more))] == [(1, 1)] * 3


def plain_match(word, lexicon):
    """(entry, 1 if misspelled) by comparing the word with every entry."""
    whole = [(i, e) for i, e in enumerate(lexicon.entries) if not e.endswith("*")]
    begun = [(i, e[:-1]) for i, e in enumerate(lexicon.entries) if e.endswith("*")]
    place = {e: i for i, e in enumerate(lexicon.entries)}
    for i, e in whole:
        if e == word:
            return i, 0
    if sure := [(len(b), i) for i, b in begun if word.startswith(b)]:
        return min(sure)[1], 0
    near = [i for i, e in whole if len(e) >= toxicity.FUZZY_FROM and distance(e, word) == 1]
    near += [place[b] for w, b in lexicon.forms.items() if b in place and len(w) >= toxicity.FUZZY_FROM and distance(w, word) == 1]
    if near:
        return min(near), 1
    for k in range(1, len(word) + 1):
        if slips := [i for i, b in begun if len(b) >= toxicity.FUZZY_FROM and word[k - 1] == b[-1] and distance(word[:k - 1], b[:-1]) == 1]:
            return min(slips), 1
    return None


def plain_score(text, model):
    words = toxicity.WORD.findall(text or "")
    told = Counter()
    for i, w in enumerate(words):
        m = plain_match(toxicity.term(w), model.lexicon)
        if m:
            told[m, toxicity.quoted(words[max(0, i - toxicity.WINDOW):i], w, words[i + 1:i + 1 + toxicity.WINDOW])] += 1
    z = model.bias
    for ((entry, slip), in_quotes), n in told.items():
        z += model.slopes[in_quotes] * model.lexicon.weights[entry, slip] * (1 + math.log(n))
    return 1 / (1 + math.exp(-z)), sum(told.values())


@pytest.mark.parametrize("inflected", [False, True])
def test_scores_equal_a_plain_version(spark, inflected):
    texts, lab = corpus()
    if inflected:
        rnd = random.Random(3)
        texts = [" ".join(w for w in t.split() if w not in ("wretch", "vermin", "numbskull", "dimwit")) for t in texts]
        texts = [f"{t} {rnd.choice(['idiot', 'idiots', 'idiotic', 'idiotically', 'idiocy'])}" if lab[i][2] else t for i, t in enumerate(texts)]
    rnd = random.Random(9)
    for i in range(0, len(texts), 5):   # slips and quotations
        w = texts[i].split()
        at = rnd.randrange(len(w))
        w[at] = rnd.choice([w[at][1:], w[at] + "x", f'"{w[at]}"', "«idjots»", "said: vermiin", "w\u00a0retch", "wretch\u2003x"])
        texts[i] = " ".join(w)
    df, lb = frame(spark, texts + odd_texts()), labels(spark, lab[:600])
    model = toxicity.fit(df, lb)
    assert any(e.endswith("*") for e in model.lexicon.entries) == inflected
    for r in toxicity.toxicity_report(df, lb).collect():
        want, n = plain_score((texts + odd_texts())[r["doc_id"]], model)
        assert abs(r["score"] - want) < 1e-9 and r["n_hits"] == n


def test_chosen_entries_equal_a_plain_version():
    rnd = random.Random(2)
    for _ in range(50):
        rows = {}
        for _ in range(rnd.randint(1, 60)):
            w = "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 8)))
            rows[w] = rnd.randint(1, 30)
            for k in toxicity.PREFIXES:
                if len(w) > k:
                    rows[w[:k] + "*"] = rows.get(w[:k] + "*", 0) + rows[w]
        kept = {}
        for form, n in sorted(rows.items(), key=lambda r: (-r[1] * (0.8 if r[0].endswith("*") else 1.0), -len(r[0]), r[0])):
            if any(e.endswith("*") and form.startswith(e[:-1]) for e in kept):
                continue
            if form.endswith("*") and sum(c for e, c in kept.items() if e.startswith(form[:-1])) >= 0.9 * n:
                continue
            kept[form] = n
        assert toxicity.choose_entries(list(rows.items())) == list(kept)


def test_the_lexicon_has_no_size_limit(spark):
    """More terms than any fixed size: each toxic document holds its own group's words."""
    rnd = random.Random(4)
    groups = [[f"t{g:02d}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(100)] for g in range(30)]
    texts = [" ".join([*rnd.sample(["aa", "bb", "cc", "dd"], 3), *(groups[i // 2 % 30] if i % 2 else [])]) for i in range(1200)]
    rows = [(t, i % 2) for i, t in enumerate(texts)]
    counted = Counter(w for t, toxic in rows if toxic for w in t.split())
    often = [(w, n) for w, n in counted.items() if n >= 3 and w[0] == "t"]
    assert len(toxicity.choose_entries(often)) == len(often) == 3000
    lb = labels(spark, [(i, 1, toxic) for i, (_, toxic) in enumerate(rows)])
    report = toxicity.toxicity_report(frame(spark, texts), lb).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in report)
