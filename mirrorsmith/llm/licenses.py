"""Licence scan: passages of a text that agree with a licence template.

A text is normalised (A-Z lower-cased, ASCII punctuation dropped) and read as a
sequence of word bigrams.  A passage agrees with a template if the Dice
coefficient of their sets of bigrams, 2 |A & B| / (|A| + |B|), reaches the
threshold.  Sizes prune what has to be compared: to reach t, a passage must
share at least t n / (2 - t) of a template's n bigrams and be at most
n (2 - t) / t long, so a template is a candidate only where that many of its
bigrams stand that close together.  Whole texts are read; a passage may start
and end anywhere.

Templates are short notices (``TEMPLATES``) and whole licence texts
(``whole_texts``), siblings included, so that the closest one wins.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from importlib.resources import files
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorsmith.llm.text import byte_values, chunks, hash_ranges, shingles, word_ranges

THRESHOLD = 0.8

# FIXED VALUES: licence notices as their licences word them.
_HEADER = "This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {}General Public License " \
          "as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."
_GNU = "This work is licensed under the GNU {}General Public License, version {}."
_CC = "This work is licensed under a Creative Commons {} 4.0 International License."
TEMPLATES = {
    "agpl-3.0": _GNU.format("Affero ", "3"),
    "agpl-3.0-header": _HEADER.format("program", ":", "Affero ", ",", "3"),
    "all-rights-reserved": "All rights reserved.",
    "apache-1.0": "Licensed under the Apache License, Version 1.0.",
    "apache-1.1": "Licensed under the Apache License, Version 1.1.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                         "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    # The BSD licences open alike; which one it is, their whole texts tell.
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
           "following conditions are met",
    "bsl-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "cc-by-4.0": _CC.format("Attribution"),
    "cc-by-4.0-short": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0": _CC.format("Attribution-ShareAlike"),
    "cc-by-sa-4.0-short": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-4.0-notice": _CC.format("Attribution-NonCommercial"),
    "cc-by-nc-nd-4.0": _CC.format("Attribution-NonCommercial-NoDerivatives"),
    "cc-by-nc-nd-4.0-short": "Licensed under CC BY-NC-ND 4.0.",
    "cc-by-nc-sa-4.0": _CC.format("Attribution-NonCommercial-ShareAlike"),
    "cc-by-nc-sa-4.0-short": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nd-4.0": _CC.format("Attribution-NoDerivatives"),
    "cc-by-nd-4.0-short": "Licensed under CC BY-ND 4.0.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "epl-1.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which "
               "accompanies this distribution",
    "epl-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
               "is available at",
    "gpl-1.0": _GNU.format("", "1"),
    "gpl-1.0-header": _HEADER.replace(" of the License,", ",").format("program", ";", "", ";", "1"),
    "gpl-2.0": _GNU.format("", "2"),
    "gpl-2.0-header": _HEADER.format("program", ";", "", ";", "2"),
    "gpl-3.0": _GNU.format("", "3"),
    "gpl-3.0-header": _HEADER.format("program", ":", "", ",", "3"),
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
           "provided that the above copyright notice and this permission notice appear in all copies.",
    "lgpl-2.0": _GNU.format("Library ", "2"),
    "lgpl-2.0-header": _HEADER.format("library", ";", "Library ", ";", "2"),
    "lgpl-2.1": _GNU.format("Lesser ", "2.1"),
    "lgpl-2.1-header": _HEADER.format("library", ";", "Lesser ", ";", "2.1"),
    "lgpl-3.0": _GNU.format("Lesser ", "3"),
    "lgpl-3.0-header": _HEADER.format("program", ":", "Lesser ", ",", "3"),
    "mit": "Released under the MIT License.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                "documentation files (the \"Software\"), to deal in the Software without restriction",
    "mpl-1.1": "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this "
               "file except in compliance with the License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def whole_texts() -> dict[str, str]:
    """The licence texts of ``license_texts``, named <licence>-whole."""
    found = (f for f in files("mirrorsmith.llm").joinpath("license_texts").iterdir() if f.name.endswith(".txt"))
    return {f"{f.name[:-4]}-whole": f.read_text(encoding="utf-8") for f in sorted(found, key=lambda f: f.name)}


def _plain() -> np.ndarray:
    """Byte table of the normalisation: punctuation becomes a space."""
    t = np.arange(256, dtype=np.uint8)
    for b in range(33, 127):
        if not chr(b).isalnum():
            t[b] = 32
    return t


def bigrams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per chunk of texts: hashes of the word bigrams in order, and row offsets.

    A text of one word has no bigram."""
    plain, values = _plain(), byte_values(71, lower=True)
    for _, _, buf, off in chunks(texts):
        buf = plain[buf]
        starts, ends, row = word_ranges(buf, off)
        s, at = shingles(hash_ranges(buf, starts, ends, values), row, 2)
        single = np.diff(row) == 1
        keep = np.ones(len(s), bool)
        keep[at[:-1][single]] = False
        yield s[keep], at - np.concatenate([[0], np.cumsum(single)])


class Firsts:
    """First occurrences of the bigrams of a sequence, seen from any place."""

    BLOCK = 256

    def __init__(self, seq: np.ndarray):
        n = len(seq)
        order = np.argsort(seq, kind="stable")
        same = seq[order][1:] == seq[order][:-1]
        self.before = np.full(n, -1, np.int64)            # where each bigram occurred last
        self.before[order[1:][same]] = order[:-1][same]
        after = np.full(n, n, np.int64)
        after[order[:-1][same]] = order[1:][same]
        # per place: the nearest repeat that ends after it, and the distinct bigrams from it on
        self.repeat = np.minimum.accumulate(after[::-1])[::-1]
        self.distinct = np.cumsum((after == n)[::-1])[::-1]
        pad = np.full(-n % self.BLOCK, n, np.int64)
        self.low = np.concatenate([self.before, pad]).reshape(-1, self.BLOCK).min(axis=1)

    def of(self, a: int, most: int, end: int | None = None) -> np.ndarray:
        """The first places from ``a`` on (before ``end``) where a bigram occurs
        that did not since ``a``: ``most`` at least, if there are.

        Blocks without such a place are passed over, so long repetitions cost nothing.
        """
        n = len(self.before) if end is None else end
        have, at, to = [], a, min(n, a + 4 * most)
        count = 0
        while True:
            x = at + np.flatnonzero(self.before[at:to] < a)
            have.append(x)
            count += len(x)
            if to >= n or count >= most or count >= self.distinct[a]:
                return np.concatenate(have)
            at = to
            block = at // self.BLOCK
            if self.before[at:(block + 1) * self.BLOCK].min(initial=n) >= a:
                ahead = np.flatnonzero(self.low[block + 1:] < a)[:1]
                if not len(ahead):
                    return np.concatenate(have)
                at = (block + 1 + int(ahead[0])) * self.BLOCK
            to = min(n, at + 4 * most)


def passages(seq: np.ndarray, wanted: np.ndarray, threshold: float) -> list[tuple[float, int, int]]:
    """Passages of a bigram sequence that agree with a template's sorted bigrams.

    Returns (dice, first bigram, end) without overlaps, the best first.  Only
    first occurrences change a passage's Dice coefficient, so each start looks
    at a few of them, however much the text repeats itself.
    """
    n = len(wanted)
    least, longest = math.ceil(threshold * n / (2 - threshold) - 1e-9), math.floor(n * (2 - threshold) / threshold + 1e-9)
    place = np.minimum(np.searchsorted(wanted, seq), n - 1)
    on = wanted[place] == seq
    hit = np.flatnonzero(on)
    if len(hit) < least:
        return []
    firsts = Firsts(seq)
    # Hits with enough hits in as many places as a passage may have; where bigrams repeat, it may have more.
    enough = np.searchsorted(hit, hit + longest) - np.arange(len(hit)) >= least
    starts = hit[enough | (firsts.repeat[hit] <= hit + longest)]

    def closest(a: int, end: int | None) -> tuple[float, int, int] | None:
        """The best passage from ``a`` that ends by ``end``, as (-dice, a, its end)."""
        at = firsts.of(a, longest + 1, end)
        mine = on[at]
        hits = np.cumsum(mine)
        if not len(at) or hits[-1] < least:
            return None
        dice = np.where(mine, 2 * hits / (n + np.arange(1, len(at) + 1)), 0)
        i = int(dice.argmax())
        return (-float(dice[i]), a, int(at[i]) + 1) if dice[i] >= threshold else None

    heap = [x for x in (closest(int(a), None) for a in starts) if x]
    heapify(heap)
    best: list[tuple[float, int, int]] = []
    begun: list[int] = []
    ends: list[int] = []
    while heap:
        d, a, b = heappop(heap)
        i = bisect_right(begun, a)
        if i and ends[i - 1] > a:
            continue
        if i < len(begun) and b > begun[i]:   # runs into a better one: what is best before that
            x = closest(a, begun[i])
            if x:
                heappush(heap, x)
            continue
        begun.insert(i, a)
        ends.insert(i, b)
        best.append((-d, a, b))
    return best


def licence_of(seq: np.ndarray, templates: list[tuple[str, np.ndarray]], threshold: float, whole: frozenset[str] = frozenset()) -> list[tuple[str, float, int, int]]:
    """All agreeing passages: (template, dice, first word, end word), best first.

    A notice inside a passage that agrees with a template of ``whole`` is part
    of that text and comes after all others.
    """
    out = [(name, d, a, b + 1) for name, wanted in templates for d, a, b in passages(seq, wanted, threshold)]
    texts = sorted((a, b) for name, _, a, b in out if name in whole)
    begins, reach = [a for a, _ in texts], list(accumulate((b for _, b in texts), max))

    def part(x: tuple[str, float, int, int]) -> bool:
        i = bisect_right(begins, x[2])   # of the texts that begin by then, does one reach its end
        return x[0] not in whole and i > 0 and reach[i - 1] >= x[3]

    return sorted(out, key=lambda x: (part(x), -x[1], -(x[3] - x[2]), x[0], x[2]))


SCHEMA = "doc_id long, license string, dice double, first_word long, end_word long, n_passages long, licenses array<string>"


def scanner(templates: dict[str, str], threshold: float, whole: frozenset[str] = frozenset()):
    names = list(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: list[tuple[str, np.ndarray]] = []
        for s, at in bigrams(pa.array([templates[n] for n in names], pa.large_string())):
            sets += [(names[len(sets) + i], np.unique(s[at[i]:at[i + 1]])) for i in range(len(at) - 1)]
        known = np.unique(np.concatenate([s for _, s in sets]))
        least = np.array([math.ceil(threshold * len(s) / (2 - threshold) - 1e-9) for _, s in sets])
        # The templates that hold each known bigram, one after the other.
        held = np.concatenate([np.searchsorted(known, s) for _, s in sets])
        owner = np.repeat(np.arange(len(sets)), [len(s) for _, s in sets])[np.argsort(held, kind="stable")]
        from_ = np.searchsorted(np.sort(held), np.arange(len(known) + 1))
        for b in batches:
            got = []
            for s, at in bigrams(b.column(1)):
                place = np.minimum(np.searchsorted(known, s), len(known) - 1)
                hit = np.flatnonzero(known[place] == s)
                # Distinct bigrams that each text shares with each template.
                doc, which = np.divmod(np.unique((np.searchsorted(at, hit, "right") - 1) * len(known) + place[hit]), len(known))
                many = from_[which + 1] - from_[which]
                step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                shared = np.bincount(np.repeat(doc, many) * len(sets) + owner[np.repeat(from_[which], many) + step], minlength=(len(at) - 1) * len(sets))
                near = shared.reshape(-1, len(sets)) >= least
                got += [licence_of(s[at[i]:at[i + 1]], [sets[t] for t in np.flatnonzero(near[i])], threshold, whole) if near[i].any() else [] for i in range(len(at) - 1)]
            first = [g[0] if g else (None, 0.0, None, None) for g in got]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([f[0] for f in first], pa.string()), pa.array([f[1] for f in first], pa.float64()),
                 pa.array([f[2] for f in first], pa.int64()), pa.array([f[3] for f in first], pa.int64()), pa.array([len(g) for g in got], pa.int64()),
                 pa.array([sorted({x[0] for x in g}) for g in got], pa.list_(pa.string()))], names=[x.split()[0] for x in SCHEMA.split(", ")])
    return run


def license_report(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: the template it agrees with best (license, dice, the words
    of the passage), how many passages agree, and all templates found.

    ``docs`` needs doc_id and text; other columns are ignored.  A null, blank
    or one-word text has no passage: license null, dice 0.  Ties go to the
    longer passage, then the smaller name; a notice inside a whole licence text
    does not stand for the document.  Templates need two words or more.  Texts
    are read once where they lie; nothing is shuffled.
    """
    whole = {} if templates else whole_texts()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(scanner(templates or TEMPLATES | whole, threshold, frozenset(whole)), SCHEMA)
