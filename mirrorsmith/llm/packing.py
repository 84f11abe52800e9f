"""Hierarchical multi-length packing of token sequences.

Documents are routed by length to tiers of window sizes (powers of two).  Whole
windows are cut off long documents; each remainder goes to the smallest tier it
fits.  A tier packs its longest remainder first and fills the gap of the window
with the longest remainders, from its own or shorter tiers, that fit; if none
fits, one is cut to fill it.  What is left at the end fills windows of ever
shorter tiers, so every sequence is full.  Sequences of a tier are dealt into
step groups of equal tokens.

Packing is done inside the partitions that Spark reads, a bounded number of
tokens at a time, so no text or token is shuffled and a lost task repeats by
itself.  Tokens come from the ``tokenizers`` library; distinct words of a chunk
are tokenized once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorsmith.llm.text import byte_values, chunks, hash_ranges, word_ranges

WINDOW = 2048
TIERS = (2048, 1024, 512, 256)     # window sizes of full sequences
STEP_TOKENS = 1 << 16              # tokens of a step group
END = 1                            # id after each document
POOL_TOKENS = 1 << 21              # tokens packed at once
CACHED_WORDS = 1 << 19

# What the files do whose texts are tokenized word by word.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
WORD_END = "</w>"

# Words of printable ASCII and the letters À-ÿ alone go the short way: the
# normalizer above only lower-cases them and the splitter only tells letters,
# digits and others.
_STOP, _NEXT = "\0", "\1"   # stand for the end of a part and of a word; no such word holds them
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\x01]+")


def plain_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which byte ranges go the short way; none that may hold a special token does."""
    after, before = np.append(buf[1:], np.uint8(0)), np.insert(buf[:-1], 0, 0) if len(buf) else buf
    tail = lambda x: (x >= 0x80) & (x < 0xC0) & (x != 0x97) & (x != 0xB7)  # noqa: E731 - not the signs × and ÷
    good = (buf > 32) & (buf < 127) & ~((buf == 60) & (after == 124))
    good |= (buf == 0xC3) & tail(after) | tail(buf) & (before == 0xC3)
    bad = np.concatenate([[0], np.cumsum(~good)])
    return bad[ends] == bad[starts]


def cut_at_spaces(spec: dict) -> bool:
    """Whether a file's ids of a text are those of its words in turn: its
    normalizer and splitter are the ones above and no special token holds a space."""
    return spec.get("normalizer") == NORMALIZER and spec.get("pre_tokenizer") == SPLITTER \
        and all(t["content"].startswith("<|") and not re.search(r"\s", t["content"]) and not t["lstrip"] and not t["rstrip"]
                for t in spec.get("added_tokens", []))


def ranked_parts(spec: dict) -> dict[bytes, int] | None:
    """Bytes of each id, a word end as ``_STOP``, where ids are in the order of
    the merges after 256 bytes and 256 bytes at a word's end; None otherwise."""
    model = spec["model"]
    if model.get("type") != "BPE" or model.get("end_of_word_suffix") != WORD_END or \
            any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
        return None
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = [b for b in range(256) if b not in set(printable)]
    # Byte-level alphabet: printable bytes stand for themselves, the others follow 255 in order.
    letters = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in special}
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    if len(vocabulary) != 512 + len(merged) or any(vocabulary.get(c, 256) > 255 or not 256 <= vocabulary.get(c + WORD_END, 0) < 512 for c in letters) \
            or any(vocabulary.get(m) != 512 + i for i, m in enumerate(merged)):
        return None
    out = {}
    for t, i in vocabulary.items():
        end = t.endswith(WORD_END)
        raw = bytes(letters[c] for c in (t[:-len(WORD_END)] if end else t))
        if 0 not in raw and 1 not in raw:  # no plain word holds these bytes
            out[raw + _STOP.encode() * end] = i
    n = len(vocabulary) + len(special)
    return out | {_STOP.encode(): n, _NEXT.encode(): n + 1}


class Words:
    """Ids by a ``tokenizers`` file.

    If the file's ids of a text are those of its words in turn (`cut_at_spaces`),
    distinct words are tokenized once: plain ones (`plain_words`), all of a
    chunk in one call, by the file's ranks (`ranked_parts`), any other word, also
    one that may hold a special token, by the whole tokenizer.  With any other file each text is
    encoded whole.
    """

    def __init__(self, path: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_word = cut_at_spaces(spec)
        ranks = ranked_parts(spec) if self.by_word else None
        self.short = None
        if ranks:
            import tiktoken

            self.short = tiktoken.Encoding("parts", pat_str=r"[^\x00\x01]+\x00|\x01", mergeable_ranks=ranks, special_tokens={})
            self.next = ranks[_NEXT.encode()]

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts."""
        return [np.array(x.ids, np.uint32) for x in self.full.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words ``buf[start:end]``, word after word, the number of
        each word's ids, and which word it is (those of the short way come first)."""
        raw = buf.tobytes()
        short = plain_words(buf, starts, ends) if self.short else np.zeros(len(starts), bool)
        ids, size = [], np.zeros(len(starts), np.int64)
        if short.any():
            words = _NEXT.join([raw[i:j].decode() for i, j in zip(starts[short].tolist(), ends[short].tolist())]).lower() + _NEXT
            got = np.array(self.short.encode_ordinary(_PARTS.sub(r"\g<0>\0", words)), np.uint32)
            stop = np.flatnonzero(got == self.next)
            size[short] = np.diff(stop, prepend=-1) - 1
            ids.append(got[got != self.next])
        rest = np.flatnonzero(~short)
        if len(rest):
            other = self.texts([raw[i:j].decode() for i, j in zip(starts[rest].tolist(), ends[rest].tolist())])
            size[rest] = [len(x) for x in other]
            ids += other
        order = np.concatenate([np.flatnonzero(short), rest])
        return np.concatenate(ids) if ids else np.zeros(0, np.uint32), size[order], order


class Seen:
    """Ids of the words met so far, by two hashes of each word's bytes (128 bits)."""

    def __init__(self) -> None:
        self.one = np.zeros(0, np.uint64)    # sorted; the other arrays follow it
        self.two = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def find(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word is, and whether it is there."""
        if not len(self.one):
            return np.zeros(len(one), np.int64), np.zeros(len(one), bool)
        at = np.minimum(np.searchsorted(self.one, one), len(self.one) - 1)
        return at, (self.one[at] == one) & (self.two[at] == two)

    def add(self, one: np.ndarray, two: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        start = len(self.ids) + np.cumsum(size) - size
        all_one = np.concatenate([self.one, one])
        # a first hash that is there already with another second one: the new word takes its place
        order = np.argsort(all_one[::-1], kind="stable")
        order = len(all_one) - 1 - order
        keep = np.ones(len(order), bool)
        keep[1:] = all_one[order][1:] != all_one[order][:-1]
        order = order[keep]
        self.one, self.two = all_one[order], np.concatenate([self.two, two])[order]
        self.start, self.size = np.concatenate([self.start, start])[order], np.concatenate([self.size, size])[order]
        self.ids = np.concatenate([self.ids, ids])


def token_chunks(texts: pa.Array, words: Words, seen: Seen) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, ids, row offsets into the ids), each row closed by ``END``."""
    how, check, end = byte_values(41, lower=False), byte_values(42, lower=False), np.array([END], np.uint32)
    for a, b, buf, off in chunks(texts):
        if not words.by_word:
            raw = buf.tobytes()
            ids = [x for t in words.texts([raw[i:j].decode() for i, j in zip(off, off[1:])]) for x in (t, end)]
            at = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
            yield a, b, np.concatenate(ids), at[::2]
            continue
        starts, ends, row = word_ranges(buf, off)
        keys, first, where = np.unique(hash_ranges(buf, starts, ends, how), return_index=True, return_inverse=True)
        two = hash_ranges(buf, starts[first], ends[first], check)
        known = seen.find(keys, two)[1]
        if not known.all():
            if len(seen.one) > CACHED_WORDS:
                seen.__init__()
                known[:] = False
            new = np.flatnonzero(~known)
            ids, size, order = words(buf, starts[first[new]], ends[first[new]])
            seen.add(keys[new[order]], two[new[order]], ids, size)
        at = seen.find(keys, two)[0]
        # The words of each row, then the closing id (last of all ids here) as one more word.
        flat = np.append(seen.ids, end)
        start, size = np.append(seen.start[at], len(seen.ids)), np.append(seen.size[at], 1)
        order = np.insert(where, row[1:], len(keys))
        n = size[order]
        to = np.concatenate([[0], np.cumsum(n)])
        out = flat[np.repeat(start[order] - to[:-1], n) + np.arange(to[-1])]
        yield a, b, out, to[np.concatenate([[0], row[1:] + np.arange(1, b - a + 1)])]


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Pack documents of ``lengths`` into full sequences: (size, [(document, start, length), ...])."""
    out: list[tuple[int, list[tuple[int, int, int]]]] = []
    top = tiers[0]
    pool: dict[int, list[tuple[int, int]]] = {}   # remainder length: [(document, start)]
    have = 0                                      # bit n is set if a remainder of length n waits

    def put(doc: int, start: int, n: int) -> None:
        nonlocal have
        pool.setdefault(n, []).append((doc, start))
        have |= 1 << n

    def take(at_most: int) -> tuple[int, int, int] | None:
        """The longest remainder of at most this length."""
        nonlocal have
        n = (have & ((1 << (at_most + 1)) - 1)).bit_length() - 1
        if n <= 0:
            return None
        doc, start = pool[n].pop()
        if not pool[n]:
            have ^= 1 << n
        return doc, start, n

    for doc, n in enumerate(lengths):
        whole = n // top * top
        out += [(top, [(doc, s, top)]) for s in range(0, whole, top)]
        if n > whole:
            put(doc, whole, n - whole)
    left = sum(k * len(v) for k, v in pool.items())
    while left:
        # The tier of the longest remainder; at the end the largest power of two that can still be filled.
        n = have.bit_length() - 1
        size = min((t for t in tiers if t >= n), default=top)
        if size > left:
            size = 1 << (left.bit_length() - 1)
        left -= size
        gap, pieces = size, []
        while gap:
            got = take(gap)
            if got is None:  # all that wait are longer: cut the shortest
                short = (have & -have).bit_length() - 1
                doc, start, n = take(short)
                pieces.append((doc, start, gap))
                put(doc, start + gap, n - gap)
                break
            pieces.append(got)
            gap -= got[2]
        out.append((size, pieces))
    return out


SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_length long, step_group long, row_id long")


def packer(path: str, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = Words(path), Seen()
        base = TaskContext.get().partitionId() << 40
        made = {"sequence": 0, "row": 0}
        filled: dict[int, int] = {}   # sequences per window size so far

        def packed(docs: list[tuple[int | None, np.ndarray]]) -> pa.RecordBatch:
            rows = []
            for size, pieces in pack([len(ids) for _, ids in docs], tiers):
                at, k = 0, filled.get(size, 0)
                filled[size] = k + 1
                # Step groups: equal tokens of one window size; the size is in the low bits.
                group = base + (k // max(1, step_tokens // size) << 12) + size
                for doc, start, n in pieces:
                    doc_id, ids = docs[doc]
                    rows.append((doc_id, start, n, zlib.crc32(ids[start:start + n].astype("<u4").tobytes()), len(ids),
                                 base + made["sequence"], at, size, group, base + made["row"] + doc))
                    at += n
                made["sequence"] += 1
            made["row"] += len(docs)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=[x.split()[0] for x in SCHEMA.split(", ")])

        pool, tokens = [], 0
        for b in batches:
            doc_ids = b.column(0).to_pylist()
            for first, last, ids, off in token_chunks(b.column(1), words, seen):
                for i in range(last - first):
                    pool.append((doc_ids[first + i], ids[off[i]:off[i + 1]]))
                tokens += int(off[-1])
                if tokens >= POOL_TOKENS:
                    yield packed(pool)
                    pool, tokens = [], 0
        if pool:
            yield packed(pool)
    return run


def pack_documents(docs: DataFrame, tokenizer: str | None = None, tiers: tuple[int, ...] = TIERS,
                   step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Pieces of all documents and the sequences that hold them.

    ``docs`` needs doc_id and text; other columns are ignored.  A null or blank
    text has the closing id alone.  Rows that share a doc_id, or have none, are
    packed each for itself; ``row_id`` tells them apart.  ``sequence_length``
    is a power of two, and every sequence is full.  ``step_group`` holds
    sequences of one length and, but for the last of a partition, the same
    number of tokens.  ``tokenizer`` is the path of a tokenizers file that all
    executors can read.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(packer(tokenizer, tiers, step_tokens), SCHEMA)
