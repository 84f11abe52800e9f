"""Alignment of two tokenizers' tokens over the same bytes.

Each tokenization of a text is a sparse token-byte incidence matrix in CSR
form.  The product A B' by Gustavson's row products has an entry for each pair
of tokens that share a byte (its value: how many); offsets where tokens of both
end cut the text into groups, and the product of the token-group incidences has
an entry for each pair in the same group.  The texts of a chunk are one matrix
each: no token crosses a text.

A task emits a text's distinct linked id pairs with their numbers of links.
Spark counts the documents of each pair and joins the counts back; pairs that
many documents hold are broadcast (fewer than ``BROADCAST_PAIRS``, whatever the
input), all others meet by shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorsmith.llm.common import stored

CHUNK = 1 << 19             # bytes of text aligned at once (a longer text is its own chunk)
PRODUCTS = 1 << 20          # scalar products of a block of rows
BROADCAST_PAIRS = 1 << 19
PAIR = 32                   # an id pair is a * 2^32 + b


# -- sparse matrices ------------------------------------------------------------

@dataclass
class CSR:
    """Row i has the columns ``cols[ptr[i]:ptr[i + 1]]``, ascending, and their values."""
    ptr: np.ndarray
    cols: np.ndarray
    vals: np.ndarray
    width: int

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    def transposed(self) -> CSR:
        order = np.argsort(self.cols, kind="stable")  # radix or merge sort: linear on rows in order
        ptr = np.concatenate([[0], np.cumsum(np.bincount(self.cols, minlength=self.width))])
        return CSR(ptr, self.rows()[order], self.vals[order], len(self.ptr) - 1)


def token_bytes(lengths: np.ndarray) -> CSR:
    """Incidence of consecutive tokens and the bytes they cover."""
    ptr = np.concatenate([[0], np.cumsum(lengths)])
    return CSR(ptr, np.arange(ptr[-1]), np.ones(ptr[-1], np.int64), int(ptr[-1]))


def token_groups(group: np.ndarray, groups: int) -> CSR:
    """Incidence of tokens and groups: one group a token."""
    n = len(group)
    return CSR(np.arange(n + 1), group, np.ones(n, np.int64), groups)


def row_products(a: CSR, b: CSR) -> np.ndarray:
    """How many scalar products each row of a b takes; its entries, if none coincide."""
    size = np.diff(b.ptr)[a.cols]
    return np.diff(np.concatenate([[0], np.cumsum(size)])[a.ptr])


def product(a: CSR, b: CSR) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Entries (row, column, value) of a b by Gustavson's row products, in
    blocks of rows: each entry (i, k) of a adds its value times row k of b to row i."""
    work = np.concatenate([[0], np.cumsum(row_products(a, b))])
    i, n = 0, len(a.ptr) - 1
    row_of = a.rows()
    while i < n:
        j = max(i + 1, int(np.searchsorted(work, work[i] + PRODUCTS, "right")) - 1)
        lo, hi = a.ptr[i], a.ptr[j]
        k = a.cols[lo:hi]
        size = np.diff(b.ptr)[k]
        ends = np.cumsum(size)
        at = np.repeat(b.ptr[k] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        row, col, val = np.repeat(row_of[lo:hi], size), b.cols[at], np.repeat(a.vals[lo:hi], size) * b.vals[at]
        key = row * b.width + col
        if (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, row, col, val = key[order], row[order], col[order], val[order]
        if len(key):
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            yield row[first], col[first], np.add.reduceat(val, first)
        i = j


# -- tokenizers -------------------------------------------------------------------

def byte_letters() -> dict[str, int]:
    """Byte of each character of the byte-level alphabet: printable bytes stand
    for themselves, the others follow 255 in order."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}


# Fixed value: how a byte-level pre-tokenizer with ``use_regex`` splits a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def ranked_bytes(spec: dict) -> dict[bytes, int] | None:
    """Bytes of each id of a ``tokenizers`` file that does nothing but merge
    bytes in the order of its ids after the usual split; None of any other."""
    model, split, letters = spec["model"], spec.get("pre_tokenizer") or {}, byte_letters()
    plain = (model.get("type") == "BPE" and spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex")
             and not split.get("add_prefix_space") and all(t["special"] for t in spec.get("added_tokens", []))
             and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")))
    if not plain:
        return None
    extra = {t["content"] for t in spec.get("added_tokens", [])}
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in extra}
    pairs = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    if len(vocabulary) != 256 + len(pairs) or any(vocabulary.get(c, 256) > 255 for c in letters) \
            or any(vocabulary.get(m) != 256 + i for i, m in enumerate(pairs)):
        return None
    return {bytes(letters[c] for c in t): i for t, i in vocabulary.items()}


class Tokenizers:
    """Both tokenizers and the bytes of each of their ids.

    A byte-level file whose ids are in the order of its merges is run by
    ``tiktoken``, which finds the same ids in a fifth of the time; any other by
    ``tokenizers``.
    """

    def __init__(self, path_a: str, path_b: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        with open(path_a, encoding="utf-8") as f:
            ranks = ranked_bytes(json.load(f))
        self.fast = ranks and tiktoken.Encoding("ranked", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        ids = np.arange(max(len(self.a_bytes), len(self.b_bytes)))
        # Decimal ids with what follows them.
        self.text = np.array([[f"{i}{s}" for i in ids] for s in (",", "|", ";", "")], object)

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        if self.fast:
            return [self.fast.encode_ordinary(t) for t in texts]
        return [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids by both tokenizers; none where the joined bytes differ from space + text."""
        out = []
        for t, a, b in zip(texts, self.encode_a([" " + t for t in texts]), self.b.encode(texts, num_threads=1)):
            raw = b" " + t.encode()
            same = b"".join([self.a_bytes[i] for i in a]) == raw and b"".join([self.b_bytes[i] for i in b]) == raw
            out.append((a, b) if same else ([], []))
        return out


# -- alignment --------------------------------------------------------------------

@dataclass
class Aligned:
    """Tokens of a chunk of texts, one after the other, and what joins them."""
    a: np.ndarray            # ids
    b: np.ndarray
    a_at: np.ndarray         # per text, its first token (with the end)
    b_at: np.ndarray
    a_matrix: CSR            # token-byte incidences
    b_matrix: CSR
    a_groups: CSR            # token-group incidences
    b_groups: CSR
    groups_at: np.ndarray    # per text, its first group (with the end)

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(token of a, token of b, bytes they share)."""
        return product(self.a_matrix, self.b_matrix.transposed())

    def shared_group_links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(token of a, token of b, 1) for tokens in the same group."""
        return product(self.a_groups, self.b_groups.transposed())


def align(ids: list[tuple[list[int], list[int]]], a_size: np.ndarray, b_size: np.ndarray) -> Aligned:
    a, b = (np.concatenate([np.array(x[s], np.int64) for x in ids]) if ids else np.zeros(0, np.int64) for s in (0, 1))
    a_at, b_at = (np.concatenate([[0], np.cumsum([len(x[s]) for x in ids])]).astype(np.int64) for s in (0, 1))
    a_matrix, b_matrix = token_bytes(a_size[a]), token_bytes(b_size[b])
    a_end, b_end = a_matrix.ptr[1:], b_matrix.ptr[1:]
    cuts = np.intersect1d(a_end, b_end, assume_unique=True)
    a_groups, b_groups = (token_groups(np.searchsorted(cuts, e), len(cuts)) for e in (a_end, b_end))
    return Aligned(a, b, a_at, b_at, a_matrix, b_matrix, a_groups, b_groups, np.searchsorted(cuts, a_matrix.ptr[a_at], "right"))


def group_texts(x: Aligned, text: np.ndarray) -> list[str]:
    """Per text its groups as ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
    ga, gb, groups = x.a_groups.cols, x.b_groups.cols, x.a_groups.width
    na, nb = np.bincount(ga, minlength=groups), np.bincount(gb, minlength=groups)
    start = np.concatenate([[0], np.cumsum(na + nb)])
    a_first, b_first = (np.concatenate([[0], np.cumsum(n)[:-1]]) if groups else np.zeros(0, np.int64) for n in (na, nb))
    out = np.empty(len(ga) + len(gb), object)
    i, j = np.arange(len(ga)) - a_first[ga], np.arange(len(gb)) - b_first[gb]
    out[start[ga] + i] = text[np.where(i == na[ga] - 1, 1, 0), x.a]
    after = np.where(j == nb[gb] - 1, 2, 0)
    after[x.b_at[1:][np.diff(x.b_at) > 0] - 1] = 3  # nothing follows a text's last token
    out[start[gb] + na[gb] + j] = text[after, x.b]
    return ["".join(out[lo:hi].tolist()) for lo, hi in zip(start[x.groups_at[:-1]], start[x.groups_at[1:]])]


SCHEMA = ("row_id long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_shared long, groups_sha256 string, "
          "pairs array<long>, times array<int>")


def _aligned(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Tokenizers(path_a, path_b)
        next_row = TaskContext.get().partitionId() << 40

        def done(docs: list[tuple[int | None, str]]) -> pa.RecordBatch:
            nonlocal next_row
            n = len(docs)
            full = [i for i, (_, t) in enumerate(docs) if t]
            ids: list[tuple[list[int], list[int]]] = [([], [])] * n
            for i, x in zip(full, both.encode([docs[i][1] for i in full]) if full else []):
                ids[i] = x
            x = align(ids, both.a_size, both.b_size)
            doc_of = np.repeat(np.arange(n), np.diff(x.a_at))
            links = np.zeros(n, np.int64)
            keys = []
            for i, j, _ in x.links():
                links += np.bincount(doc_of[i], minlength=n)
                # One number for document and pair: a chunk has far fewer than 2^63 / (ids of a * ids of b) documents.
                keys.append((doc_of[i] * len(both.a_bytes) + x.a[i]) * len(both.b_bytes) + x.b[j])
            key, times = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64),) * 2
            rest, b_id = np.divmod(key, len(both.b_bytes))
            doc, a_id = np.divmod(rest, len(both.a_bytes))
            at = pa.array(np.searchsorted(doc, np.arange(n + 1)), pa.int32())
            shared = np.concatenate([[0], np.cumsum(row_products(x.a_groups, x.b_groups.transposed()))])[x.a_at]
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in group_texts(x, both.text)]
            row_ids = np.arange(next_row, next_row + n)
            next_row += n
            return pa.RecordBatch.from_arrays([
                pa.array(row_ids), pa.array([d for d, _ in docs], pa.int64()), pa.array(np.diff(x.a_at)), pa.array(np.diff(x.b_at)),
                pa.array(np.diff(x.groups_at).astype(np.int64)), pa.array(links), pa.array(np.diff(shared)), pa.array(digests, pa.string()),
                pa.ListArray.from_arrays(at, pa.array(a_id << PAIR | b_id, pa.int64())), pa.ListArray.from_arrays(at, pa.array(times, pa.int32())),
            ], names=[c.split()[0] for c in SCHEMA.split(", ")])

        held, size = [], 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                t = text.as_py() or ""
                if held and size + len(t) > CHUNK:
                    yield done(held)
                    held, size = [], 0
                held.append((doc_id, t))
                size += len(t) + 16
        if held:
            yield done(held)

    return run


def align_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Per document its tokens, groups and links, with the distinct linked id
    pairs (``a << 32 | b``) and how many links each has.

    ``path_a`` is a byte-level ``tokenizers`` file, ``path_b`` a sentencepiece
    model whose pieces begin with the space that is put before the text; all
    executors can read them.  ``n_shared`` counts the pairs of tokens in one group.
    """
    if path_a is None or path_b is None:
        import public_tokenizers

        path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
        path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_aligned(path_a, path_b), SCHEMA)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, docs (documents that hold the pair linked), best (no other pair of its a id has more)."""
    counts = stored(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs")), "pairs")
    a = F.shiftright("pair", PAIR).alias("a")
    most = counts.groupBy(a).agg(F.max("docs").alias("most"))
    return counts.select("pair", "docs", a).join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def alignment_report(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_shared.

    ``docs`` needs doc_id and text; other columns are ignored.  A text that is
    null or empty, or that either tokenizer does not give back byte by byte, has
    no tokens: zeros and ''.  Rows that share a doc_id, or have none, are
    documents each.
    """
    aligned = stored(align_documents(docs, path_a, path_b), "aligned")
    counts = stored(pair_counts(aligned), "pair-counts")
    # Fewer than BROADCAST_PAIRS pairs have more than that share of all (document, pair) rows.
    n, total = counts.agg(F.count("*"), F.coalesce(F.sum("docs"), F.lit(0))).first()
    least = total // BROADCAST_PAIRS if n >= BROADCAST_PAIRS else 0
    held = aligned.select("row_id", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row_id", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    common = F.broadcast(counts.filter(F.col("docs") > least))
    known = held.join(common, "pair")
    if least:
        known = known.unionByName(held.join(common, "pair", "left_anti").join(counts.filter(F.col("docs") <= least), "pair"))
    sums = known.groupBy("row_id").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                       F.sum(F.col("times") * F.col("docs")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return aligned.drop("pairs", "times").join(sums, "row_id", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256", "n_shared")
