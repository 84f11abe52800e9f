"""Toxicity: a learned lexicon, matched with misspellings, judged in context.

1. A bounded sample of labelled documents gives the lexicon: words and word
   beginnings that toxic documents hold far more often than others, and that
   are frequent or needed to tell the two apart (a sparse logistic regression
   drops those that only happen to stand in toxic documents).
2. The lexicon is a trie.  A Levenshtein automaton is run over it: a state is
   the set of (trie node, edits so far) that a word's letters can lead to, made
   when first needed and kept.  A word is read letter by letter through the
   states and accepted with the entry it spells or misspells.  A beginning is
   misspelled by a word one edit from a word that the sample holds under it,
   or, if long enough, by a word that spells it with one edit before its last
   letter.
3. A hit counts as quoted if quotation marks or words of reporting stand around
   it.  Evidence of a document is the sum over entries of their log odds, apart
   for plain and quoted hits; a logistic regression makes it a score.

Scores depend on the text alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorsmith.llm.common import stored
from mirrorsmith.llm.text import byte_values, chunks, hash_ranges, word_ranges

SAMPLE = 5_000        # labelled documents of each class at most that are learned from
PREFIXES = (4, 5, 6)  # lengths of word beginnings that can be entries
MIN_SHARE = 0.005     # an entry occurs in this share of the toxic documents at least
MIN_ODDS = math.log(20)
MISSPELLED = 0.75     # weight of a misspelling without odds of its own, as a share of its entry's
FUZZY_FROM = 5        # letters from which an entry may be misspelled by one edit
PENALTY = 0.005       # L1 penalty of an entry, as a share of the toxic documents of the sample
WINDOW = 8            # words on each side of a hit that make its context
CACHED_WORDS = 1 << 20
HELD_OUT = 5          # a row is held out if crc32(doc_id) mod HELD_OUT is 0

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MARKS = "\"'“”„«»‘’‚‹›`"
PUNCTUATION = MARKS + ".,;:!?()[]{}<>*_~|/\\-–—…¡¿#&%+="
REPORTING = frozenset("said says say called calls wrote writes quote quoted quotes word term sagte sagt nannte schrieb wort "
                      "dit disait appelé écrit mot dijo dice llamó escribió palabra".split())
LOOKALIKE = str.maketrans("013457@$", "oieastas")


def term(word: str) -> str:
    """A word in lower case without punctuation around it; look-alike signs among letters are letters."""
    w = word.lower().strip(PUNCTUATION)
    return w.translate(LOOKALIKE) if not w.isalpha() and any(c.isalpha() for c in w) else w


@dataclass
class Lexicon:
    """Entries: words, or beginnings (with a * at the end)."""

    entries: list[str]
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 2)))   # per entry: spelled, misspelled
    forms: dict[str, str] = field(default_factory=dict)                     # known words under a beginning: that beginning

    def __post_init__(self) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.whole: dict[int, int] = {}      # node: entry that ends there
        self.begun: dict[int, int] = {}      # node: entry whose beginning ends there
        self.formed: dict[int, int] = {}     # node: entry whose known word ends there
        for i, e in enumerate(self.entries):
            (self.begun if e.endswith("*") else self.whole)[self._node(e.rstrip("*"))] = i
        place = {e: i for i, e in enumerate(self.entries)}
        for w, e in self.forms.items():
            if e in place and len(w) >= FUZZY_FROM:
                self.formed[self._node(w)] = place[e]
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, tuple[int, tuple[int, int] | None]]] = []   # per letter: state, beginning misspelled there
        self.accepts: list[tuple[int, int] | None] = []
        self.sure: list[tuple[int, int] | None] = []
        self.start = self._state({(0, 0)})

    def _node(self, word: str) -> int:
        node = 0
        for c in word:
            if c not in self.children[node]:
                self.children.append({})
                self.children[node][c] = len(self.children) - 1
            node = self.children[node][c]
        return node

    def _state(self, nodes: set[tuple[int, int]]) -> int:
        """The number of the state of these (node, edits); a letter of the trie may be missing from the word."""
        nodes = nodes | {(c, 1) for n, e in nodes if e == 0 for c in self.children[n].values()}
        key = frozenset(x for x in nodes if x[1] == 0 or (x[0], 0) not in nodes)
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            spelled = [(e, self.whole[n]) for n, e in key if n in self.whole and (e == 0 or len(self.entries[self.whole[n]]) >= FUZZY_FROM)]
            spelled += [(1, self.formed[n]) for n, e in key if e == 1 and n in self.formed]
            begun = [(e, self.begun[n]) for n, e in key if e == 0 and n in self.begun]
            self.accepts.append(min(spelled, default=None))
            self.sure.append(min(begun, default=None))
        return self.ids[key]

    def _step(self, state: int, c: str) -> tuple[int, tuple[int, int] | None]:
        to, slips = set(), []
        for n, e in self.sets[state]:
            if c in self.children[n]:
                x = self.children[n][c]
                to.add((x, e))
                # the last letter has to be right, or any word with the letters before it would do
                if e == 1 and x in self.begun and len(self.entries[self.begun[x]]) > FUZZY_FROM:
                    slips.append((1, self.begun[x]))
            if e == 0:
                to.add((n, 1))
                to.update((x, 1) for x in self.children[n].values())
        return self._state(to) if to else -1, min(slips, default=None)

    def match(self, word: str) -> int:
        """2 x entry + (1 if misspelled) of the entry that a word matches, or -1."""
        state, found, near = self.start, None, None
        for c in word:
            step = self.steps[state].get(c)
            if step is None:
                step = self.steps[state][c] = self._step(state, c)
            if step[0] < 0:
                break
            state = step[0]
            found = found or self.sure[state]
            near = near or step[1]
        else:
            if self.accepts[state] is not None and (found is None or self.accepts[state][0] == 0):
                found = self.accepts[state]
        found = found or near
        return -1 if found is None else 2 * found[1] + found[0]


def quoted(before: list[str], word: str, after: list[str]) -> bool:
    """Whether a hit stands in quotation marks or after a word of reporting."""
    opened = word[:1] in MARKS
    for w in reversed(before):
        if opened:
            break
        if w.rstrip(".,;:!?")[-1:] in MARKS:   # a quotation has ended before the hit
            break
        opened = w[:1] in MARKS
    closed = any(w.rstrip(".,;:!?")[-1:] in MARKS for w in [word, *after])
    return (opened and closed) or any(term(w) in REPORTING for w in before[-3:])


def hits(texts: pa.Array, lexicon: Lexicon, seen: dict[int, int]) -> Iterator[tuple[int, Counter]]:
    """Per text: its number of words, and how often each (2 x match + quoted) occurs."""
    values = byte_values(61, lower=True)
    for _, _, buf, off in chunks(texts):
        starts, ends, row = word_ranges(buf, off)
        raw = buf.tobytes()
        keys, first, where = np.unique(hash_ranges(buf, starts, ends, values), return_index=True, return_inverse=True)
        found = np.empty(len(keys), np.int64)
        for j, (key, i) in enumerate(zip(keys.tolist(), first.tolist())):
            m = seen.get(key)
            if m is None:
                m = lexicon.match(term(raw[starts[i]:ends[i]].decode()))
                if len(seen) < CACHED_WORDS:
                    seen[key] = m
            found[j] = m
        match = found[where] if len(where) else np.zeros(0, np.int64)
        at = np.flatnonzero(match >= 0)
        doc = np.searchsorted(row, at, "right") - 1
        out = [Counter() for _ in range(len(off) - 1)]
        word = lambda i: raw[starts[i]:ends[i]].decode()
        for i, d in zip(at.tolist(), doc.tolist()):
            before = [word(x) for x in range(max(row[d], i - WINDOW), i)]
            after = [word(x) for x in range(i + 1, min(row[d + 1], i + 1 + WINDOW))]
            out[d][2 * int(match[i]) + quoted(before, word(i), after)] += 1
        yield from zip(np.diff(row).tolist(), out)


@dataclass
class Model:
    lexicon: Lexicon
    bias: float
    slopes: tuple[float, float]    # of plain and of quoted evidence

    def evidence(self, found: Counter) -> tuple[float, float]:
        total = [0.0, 0.0]
        for x, n in found.items():
            total[x & 1] += self.lexicon.weights[x >> 2, (x >> 1) & 1] * (1 + math.log(n))
        return total[0], total[1]

    def score(self, found: Counter) -> float:
        plain, told = self.evidence(found)
        z = self.bias + self.slopes[0] * plain + self.slopes[1] * told
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).cast("binary")) % HELD_OUT == 0


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of the partition, toxic and not, that hold each word and word beginning."""
    count: dict[str, list[int]] = {}
    for b in batches:
        for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            words = {term(w) for w in WORD.findall(text or "")} - {""}
            forms = words | {w[:n] + "*" for w in words if w.isalpha() for n in PREFIXES if len(w) > n}
            for w in forms:
                count.setdefault(w, [0, 0])[toxic] += 1
        while len(count) > 200_000:   # hand on what has been counted
            yield _count_rows(count)
            count = {}
    if count:
        yield _count_rows(count)


def _count_rows(count: dict[str, list[int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(count)), pa.array([c[1] for c in count.values()], pa.int64()),
                                       pa.array([c[0] for c in count.values()], pa.int64())], names=["term", "toxic", "clean"])


def choose_entries(rows: list[tuple[str, int]]) -> list[str]:
    """Entries from (form, toxic documents), without those that others cover.

    More frequent first, where a beginning has to be clearly more frequent than
    a word to come before it; longer beginnings before shorter ones.  A
    beginning is passed over if entries under it account for nearly all of it,
    a word if a beginning covers it.
    """
    kept: dict[str, int] = {}
    under: Counter = Counter()   # documents of the entries under each beginning
    for form, n in sorted(rows, key=lambda r: (-r[1] * (0.8 if r[0].endswith("*") else 1.0), -len(r[0]), r[0])):
        if any(form[:k] + "*" in kept for k in PREFIXES):
            continue
        if form.endswith("*") and under[form[:-1]] >= 0.9 * n:
            continue
        kept[form] = n
        under.update({form[:k]: n for k in PREFIXES})
    return list(kept)


def known_forms(counted: DataFrame, begun: list[str]) -> dict[str, str]:
    """The sample's words under these beginnings, each with its shortest."""
    if not begun:
        return {}
    under = F.coalesce(*[F.when((F.length("term") > n) & start.isin(begun), start) for n in PREFIXES for start in [F.concat(F.substring("term", 1, n), F.lit("*"))]])
    words = counted.filter((F.col("toxic") > 0) & ~F.col("term").endswith("*")).withColumn("under", under).filter("under IS NOT NULL")
    return {r["term"]: r["under"] for r in words.orderBy(F.col("toxic").desc(), "term").collect()}


def needed(doc: np.ndarray, entry: np.ndarray, entries: int, toxic: np.ndarray, penalty: float, rounds: int = 300) -> np.ndarray:
    """Weights (0 or more) of a logistic regression with an L1 penalty.  Document
    ``doc[i]`` holds entry ``entry[i]``; only these pairs are kept in memory."""
    per_doc = lambda v: np.bincount(doc, v[entry], minlength=len(toxic))
    per_entry = lambda v: np.bincount(entry, v[doc], minlength=entries)
    v, norm = np.ones(entries), 1.0
    for _ in range(100):   # largest eigenvalue of the entries' joint counts
        v = per_entry(per_doc(v))
        norm = max(1.0, np.linalg.norm(v))
        v = v / norm
    theta, bias = np.zeros(entries), -1.0
    rate = 4.0 / (1.01 * norm)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(per_doc(theta) + bias, -30, 30)))
        theta = np.maximum(0, theta - rate * (per_entry(p - toxic) + penalty))
        bias -= 4.0 / len(toxic) * (p - toxic).sum()
    return theta


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from labelled rows that are not held out; a document labelled twice counts as toxic if any label says so."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")) \
        .filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Bounded: ``sample`` documents of each class, the same in every run.
    drawn = [known.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for t in (0, 1)]
    drawn = drawn[0].union(drawn[1]).withColumnRenamed("doc_id", "_id")
    taught = stored(docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id").cast("long") == F.col("_id")).select("text", "toxic"), "toxicity-sample")
    size = {r["toxic"]: r["count"] for r in taught.groupBy("toxic").count().collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic or not clean:
        return Model(Lexicon([]), 5.0 if toxic else -5.0, (0.0, 0.0))
    odds = lambda t, c: F.log((t + 0.5) / (toxic + 1)) - F.log((c + 0.5) / (clean + 1))
    counted = taught.mapInArrow(_term_counts, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    often = counted.filter((F.col("toxic") >= max(3, MIN_SHARE * toxic)) & (odds(F.col("toxic"), F.col("clean")) >= MIN_ODDS))
    entries = choose_entries([(r["term"], r["toxic"]) for r in often.collect()])   # bounded by the sample and the support
    forms = known_forms(counted.filter(odds(F.col("toxic"), F.col("clean")) > 0), [e for e in entries if e.endswith("*")])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, seen = Lexicon(entries, forms=forms), {}
        for b in batches:
            got = list(hits(b.column(0), lexicon, seen))
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([list(c) for _, c in got], pa.list_(pa.int64())), pa.array([list(c.values()) for _, c in got], pa.list_(pa.int64()))], names=["toxic", "what", "times"])

    # One row per sampled document: bounded by the sample.
    seen_in = [(r["toxic"], Counter(dict(zip(r["what"], r["times"])))) for r in taught.mapInArrow(found, "toxic int, what array<long>, times array<long>").collect()]
    y = np.array([label for label, _ in seen_in], float)
    pairs = sorted({(i, k >> 2) for i, (_, c) in enumerate(seen_in) for k in c if not (k >> 1) & 1})
    doc, entry = np.array(pairs, np.int64).reshape(-1, 2).T
    with_toxic, with_clean = (np.bincount(entry[y[doc] == t], minlength=len(entries)).astype(float) for t in (1, 0))
    surprise = 2 * with_toxic * np.log(np.maximum(with_toxic, 0.5) / (with_toxic + with_clean + 1e-9) * (toxic + clean) / toxic + 1e-9)
    frequent = (with_toxic >= 0.2 * with_toxic.max(initial=0)) & (surprise >= 20)
    use = np.flatnonzero((surprise >= 12) & (frequent | (needed(doc, entry, len(entries), y, max(PENALTY * toxic, 1.5)) > 0))).tolist()
    lexicon = Lexicon([entries[i] for i in use], forms=forms)
    place = {e: i for i, e in enumerate(use)}
    seen_in = [(label, Counter({4 * place[k >> 2] + (k & 3): n for k, n in c.items() if k >> 2 in place})) for label, c in seen_in]
    count = np.zeros((2, len(use), 2))
    for label, c in seen_in:
        for x in {k >> 1 for k in c}:
            count[label, x >> 1, x & 1] += 1
    lexicon.weights = np.clip(np.log((count[1] + 0.5) / (toxic + 1)) - np.log((count[0] + 0.5) / (clean + 1)), 0, 8)
    # A misspelling that the sample hardly holds has no odds of its own: it counts for less than its entry.
    rare = (count[0][:, 1] == 0) & (count[1][:, 1] < 5)
    lexicon.weights[rare, 1] = lexicon.weights[rare, 0] * MISSPELLED
    model = Model(lexicon, -3.0, (1.0, 0.3))
    x = np.array([model.evidence(c) for _, c in seen_in])
    # Newton steps from a prior: slope 1 for plain, 0.3 for quoted evidence.
    prior = theta = np.array([-3.0, 1.0, 0.3])
    a = np.column_stack([np.ones(len(x)), x])
    # Both classes weigh alike.
    w = np.where(y == 1, len(y) / (2 * toxic), len(y) / (2 * clean))
    strength = np.array([1e-2, 1.0, 10.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ theta, -30, 30)))
        grad = a.T @ (w * (p - y)) + strength * (theta - prior)
        hess = (a * (w * p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(strength)
        step = np.linalg.solve(hess, grad)
        theta = theta - step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
    return Model(lexicon, float(theta[0]), (float(max(0, theta[1])), float(max(0, theta[2]))))


def scorer(entries: list[str], weights: np.ndarray, forms: dict[str, str], bias: float, slopes: tuple[float, float]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = Model(Lexicon(entries, weights, forms), bias, slopes), {}
        for b in batches:
            got = list(hits(b.column(2), model.lexicon, seen))
            score = [model.score(c) for _, c in got]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score, pa.float64()), pa.array([int(s >= 0.5) for s in score], pa.int32()),
                                              pa.array([sum(c.values()) for _, c in got], pa.int64())], names=["doc_id", "held_out", "score", "predicted", "n_hits"])
    return run


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, n_hits.

    ``docs`` needs doc_id and text, ``labels`` doc_id and toxic; other columns
    are ignored, and nothing but the text goes into a score.  A null or empty
    text has no hits.  A null doc_id counts as empty text in the hold-out rule.
    Without labels of both classes every document gets the same score.
    """
    model = fit(docs, labels)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text") \
        .mapInArrow(scorer(model.lexicon.entries, model.lexicon.weights, model.lexicon.forms, model.bias, model.slopes),
                    "doc_id long, held_out boolean, score double, predicted int, n_hits long")
