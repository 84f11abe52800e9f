import collections
import hashlib
import json

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from mirrorsmith.llm import alignment
from mirrorsmith.llm.alignment import CSR
from tests.llm.util import empty, frame, odd_texts

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    """Token ids and bytes by the files' own libraries, one text at a time."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    letters = alignment.byte_letters()
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def tokens(text):
        if not text:
            return [], []
        x = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            y.append((i, bytes.fromhex(p[3:5]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        raw = b" " + text.encode()
        return (x, y) if b"".join(t for _, t in x) == raw == b"".join(t for _, t in y) else ([], [])

    return tokens


def expected(texts, ids, tokens):
    rows, held = [], collections.Counter()
    for i, text in zip(ids, texts):
        x, y = tokens(text)
        spans = []
        for side in (x, y):
            at, s = 0, []
            for _, t in side:
                s.append((at, at + len(t)))
                at += len(t)
            spans.append(s)
        links = [(x[p][0], y[q][0]) for p, (a, b) in enumerate(spans[0]) for q, (c, d) in enumerate(spans[1]) if a < d and c < b]
        cuts = sorted({b for _, b in spans[0]} & {b for _, b in spans[1]})
        groups, lo = [], 0
        for hi in cuts:
            groups.append("|".join(",".join(str(t[0]) for t, (a, b) in zip(side, s) if lo <= a and b <= hi) for side, s in zip((x, y), spans)))
            lo = hi
        held.update(set(links))
        rows.append((i, len(x), len(y), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if cuts else ""))
    most = collections.defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    return [(i, a, b, g, len(k), sum(held[p] == most[p[0]] for p in k), sum(held[p] for p in k), h) for i, a, b, g, k, h in rows]


TEXTS = ["Hello world, hello words.", "naïve café — 日本語 \U0001F600!", "  two  spaces\tand\n\nlines ", "<|endoftext|> and </s> <unk> <0x41> are text", "▁odd▁",
         "Hello world, hello words.", "x", " ", "don't stop 12345 ₂ﬁ", "a\u0000b", "\r\n"]


def got(df):
    return sorted([tuple(r[c] for c in COLUMNS) for r in df.collect()], key=repr)


@pytest.mark.parametrize("pairs", [1 << 19, 40])
def test_against_plain_alignment(spark, plain, monkeypatch, pairs):
    """Also with most pairs beyond the broadcast."""
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", pairs)
    texts = TEXTS + [t for t in odd_texts() if t is None or len(t) < 2000]
    ids = [None, 3, 3, *range(10, 7 + len(texts))]
    report = alignment.alignment_report(frame(spark, texts, ids=ids))
    assert report.columns[:8] == COLUMNS
    assert got(report) == sorted(expected(texts, ids, plain), key=repr)


def test_long_texts(spark, plain):
    texts = [t for t in odd_texts() if t and len(t) >= 70_000]
    rows = alignment.alignment_report(frame(spark, texts)).collect()
    for r in rows:
        x, y = plain(texts[r["doc_id"]])
        assert (r["n_a"], r["n_b"]) == (len(x), len(y)) and r["n_links"] >= max(len(x), len(y)) and r["count_sum"] >= r["n_links"]


def test_fast_way_only_where_the_file_allows_it(spark):
    """Both ways find the same ids; another kind of file, or one that does more, goes the library's way."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    both = alignment.Tokenizers(path, public_tokenizers.path("piece_bpe_32k.model"))
    docs = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts = [" " + (t or "") for t in docs + odd_texts() + TEXTS] + ["\n" * 100_000 + "x", " \t" * 50_000, "é" * 50_000, "12" * 50_000]
    assert both.fast and both.encode_a(texts) == [x.ids for x in both.a.encode_batch(texts, add_special_tokens=False)]
    spec = json.load(open(path, encoding="utf-8"))
    for part, change in (("normalizer", {"type": "Lowercase"}), ("pre_tokenizer", {"type": "Whitespace"}), ("pre_tokenizer", None)):
        assert alignment.ranked_bytes({**spec, part: change}) is None
    merges = spec["model"]["merges"]
    assert alignment.ranked_bytes({**spec, "model": {**spec["model"], "merges": [merges[1], merges[0], *merges[2:]]}}) is None
    assert alignment.ranked_bytes(json.load(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8"))) is None


def dense(m):
    out = np.zeros((len(m.ptr) - 1, m.width), np.int64)
    out[m.rows(), m.cols] = m.vals
    return out


def test_products_of_sparse_matrices(monkeypatch):
    monkeypatch.setattr(alignment, "PRODUCTS", 50)
    rng = np.random.default_rng(1)
    for _ in range(20):
        n, k, m = rng.integers(1, 15, 3)
        mats = []
        for rows, cols in ((n, k), (k, m)):
            d = rng.integers(0, 4, (rows, cols)) * (rng.random((rows, cols)) < 0.4)
            r, c = np.nonzero(d)
            mats.append(CSR(np.concatenate([[0], np.cumsum(np.bincount(r, minlength=rows))]), c, d[r, c], int(cols)))
        out = np.zeros((n, m), np.int64)
        for i, j, v in alignment.product(*mats):
            assert (out[i, j] == 0).all()
            out[i, j] = v
        assert (out == dense(mats[0]) @ dense(mats[1])).all()
        assert (dense(mats[0].transposed()) == dense(mats[0]).T).all()


def test_links_are_products():
    """Overlaps and shared groups of tokens of lengths 2 3 1 | 4 and 1 4 1 | 3 1."""
    sizes = np.array([0, 1, 2, 3, 4])
    x = alignment.align([([2, 3, 1], [1, 4, 1]), ([], []), ([4], [3, 1])], sizes, sizes)
    assert [(int(i), int(j), int(v)) for t in x.links() for i, j, v in zip(*t)] == [(0, 0, 1), (0, 1, 1), (1, 1, 3), (2, 2, 1), (3, 3, 3), (3, 4, 1)]
    assert [(int(i), int(j)) for t in x.shared_group_links() for i, j, _ in zip(*t)] == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 2), (3, 3), (3, 4)]
    text = np.array([[f"{i}{s}" for i in range(5)] for s in (",", "|", ";", "")], object)
    assert alignment.group_texts(x, text) == ["2,3|1,4;1|1", "", "4|3,1"]


def test_empty_table(spark):
    assert alignment.alignment_report(empty(spark)).collect() == []
