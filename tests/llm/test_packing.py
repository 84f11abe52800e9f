import functools
import json
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from mirrorsmith.llm import packing
from tests.llm.util import empty, frame, odd_texts

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["don't WE'LL it's'tis 'S'T", "<|endoftext|>x <|startoftext|>", "İstanbul ΣΑΣ ﬁ é", "1234.5 a b\x1cb \x00 x​y", "ª µm ½ ×÷ ÀÉ ß ẞ ÿ Ÿ", "\U0001F600!! a--b ...'re"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@functools.cache
def words():
    return packing.Words(PATH)


def encoded(texts):
    out = []
    for a, b, ids, off in packing.token_chunks(pa.array(texts, pa.string()), words(), packing.Seen()):
        out += [ids[off[i]:off[i + 1]].tolist() for i in range(b - a)]
    return out


def test_ids_are_those_of_the_tokenizer(tokenizer):
    texts = odd_texts() + ODD
    assert encoded(texts) == [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_other_tokenizer_files(tmp_path):
    """Texts are cut into words only where the file allows it."""
    texts = ["Hello World 12", *ODD, *odd_texts()]
    other = public_tokenizers.path("byte_bpe_50k.json")
    changed = tmp_path / "changed.json"
    spec = json.load(open(PATH, encoding="utf-8"))
    spec["normalizer"]["normalizers"].pop()   # keeps capitals
    changed.write_text(json.dumps(spec), encoding="utf-8")
    merges = tmp_path / "merges.json"
    spec = json.load(open(PATH, encoding="utf-8"))
    spec["model"]["merges"] = spec["model"]["merges"][:1000]   # ids no longer follow the merges alone
    merges.write_text(json.dumps(spec), encoding="utf-8")
    for path, by_word, short in ((PATH, True, True), (other, False, False), (str(changed), False, False), (str(merges), True, False)):
        t, words = Tokenizer.from_file(path), packing.Words(path)
        assert (words.by_word, bool(words.short)) == (by_word, short)
        got = []
        for a, b, ids, off in packing.token_chunks(pa.array(texts, pa.string()), words, packing.Seen()):
            got += [ids[off[i]:off[i + 1]].tolist() for i in range(b - a)]
        assert got == [t.encode(x or "", add_special_tokens=False).ids + [1] for x in texts]


def test_forgotten_words(monkeypatch, tokenizer):
    """The cache starts anew when it is full; a chunk needs no other's words."""
    monkeypatch.setattr(packing, "CACHED_WORDS", 5)
    monkeypatch.setattr("mirrorsmith.llm.text.CHUNK", 60)
    texts = odd_texts()[:14] + ODD
    assert encoded(texts) == [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_ids_of_many_documents(spark, tokenizer):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    assert encoded(texts) == [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abzAZ'sdtlrem09.,!<|>-éÀßÿ×÷ µ̀Σİ日 \x1c \n", max_size=30), max_size=5))
def test_ids_of_any_text(texts):
    t = words().full
    assert encoded(texts) == [t.encode(x, add_special_tokens=False).ids + [1] for x in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 9000), max_size=60))
def test_every_sequence_is_full_and_every_id_in_one_piece(lengths):
    out = packing.pack(lengths)
    cover = defaultdict(list)
    for size, pieces in out:
        assert size & (size - 1) == 0 and size <= 2048 and sum(n for *_, n in pieces) == size
        for doc, start, n in pieces:
            cover[doc].append((start, n))
    for doc, total in enumerate(lengths):
        at = 0
        for start, n in sorted(cover[doc]):
            assert start == at
            at += n
        assert at == total


def test_few_cuts_and_whole_windows():
    rnd = random.Random(1)
    lengths = [int(rnd.lognormvariate(5.5, 1)) + 1 for _ in range(5000)]
    out = packing.pack(lengths)
    least = sum(-(-n // 2048) for n in lengths)
    assert sum(len(p) for _, p in out) <= 1.5 * least
    assert sum(s for s, _ in out if s < 256) < 512


def test_round_trip(spark, tokenizer):
    texts = odd_texts() + ODD + ["word " * n for n in (2046, 2047, 2048, 5000)]
    texts += texts[:4]
    df = frame(spark, texts)
    rows = packing.pack_documents(df).collect()
    ids = [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(range(len(texts)))
    for d, ps in pieces.items():
        at = 0
        for r in sorted(ps, key=lambda r: r["start"]):
            piece = np.array(ids[d][at:at + r["length"]], "<u4")
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids[d]) and r["ids_crc32"] == zlib.crc32(piece.tobytes())
            at += r["length"]
        assert at == len(ids[d])
    groups = defaultdict(set)
    for s, ps in sequences.items():
        at = 0
        for r in sorted(ps, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == ps[0]["sequence_length"] and at & (at - 1) == 0 and at <= 2048
        groups[ps[0]["step_group"]].add((s, at))
    for g in groups.values():
        assert len({n for _, n in g}) == 1 and sum(n for _, n in g) <= packing.STEP_TOKENS
    assert sorted(map(tuple, rows)) == sorted(map(tuple, packing.pack_documents(df).collect()))


def test_small_pools(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "POOL_TOKENS", 500)
    texts = ["a b c " * 30] * 40
    rows = packing.pack_documents(frame(spark, texts).coalesce(1)).collect()
    assert sum(r["length"] for r in rows) == 40 * 91 and len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)


def test_rows_that_share_a_doc_id(spark):
    rows = packing.pack_documents(frame(spark, ["a b", "a b", "c", None], ids=[1, 1, None, None])).collect()
    assert sum(r["length"] for r in rows) == 3 + 3 + 2 + 1 and len({r["row_id"] for r in rows}) == 4


def test_empty_table(spark):
    assert packing.pack_documents(empty(spark)).collect() == []
