"""SimHash near duplicates through a Gray-order hierarchical index.

1. A document's fingerprint has a bit set if over half of its word shingles'
   XXH64 hashes have it.  Equal fingerprints are one code.
2. Two codes that differ in at most ``distance`` bits agree in one of
   ``distance + 1`` segments of their bits.  So there are as many tables of all
   codes, each rotated to have another segment in front and sorted by Gray
   rank.  Gray order keeps equal leading bits together: a run of one front
   segment is a subtree of the table's index.
3. Every range of a sorted table gets an index: consecutive codes form nodes,
   nodes form nodes above.  A node keeps the bits that all its codes share; bits
   that its parent shares already are factored out.  A search goes down from the
   nodes of the query's run, adds up the differing bits of each node's pattern
   and drops the node, with all under it, once they pass the distance.  It also
   drops nodes whose codes are connected with the query already: only links
   that join two groups are wanted.
4. A run cut by range borders (a front segment that very many codes share) is
   several blocks; two blocks meet unless the patterns they share differ too
   much.
5. Components of the links.

No group is gathered: ranges are as large as a shuffle partition, whatever
their keys, and hold eight bytes a code.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorsmith.llm.common import join_counted, shuffle_partitions, stored
from mirrorsmith.llm.components import components

WORDS, DISTANCE = 4, 4
FAN = 16            # nodes under a node
QUERIES = 1 << 12   # codes searched at once
FRONTIER = 1 << 18  # (query, node) pairs expanded at once
HASHED = 1 << 14    # shingles whose bits are counted at once


def fingerprint(text: str | None, words: int = WORDS, seed: int = 42) -> int:
    """64-bit fingerprint of one text, unsigned; 0 without words."""
    import xxhash

    found = (text or "").encode().lower().split()  # bytes: lower-cases A-Z only, splits at space, \t, \n, \v, \f, \r
    if not found:
        return 0
    line = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found])
    k = min(words, len(found))
    starts = [0, *ends[:len(found) - k].tolist()]
    stops = (ends[k - 1:] - 1).tolist()
    set_in = np.zeros(64, np.int64)
    for i in range(0, len(starts), HASHED):
        h = np.array([xxhash.xxh64_intdigest(line[a:b], seed) for a, b in zip(starts[i:i + HASHED], stops[i:i + HASHED])], "<u8")
        set_in += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_in > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and code (the fingerprint's 64 bits as a signed long) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = np.array([fingerprint(t.as_py(), words) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(codes)], names=["doc_id", "code"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, code long")


class GrayIndex:
    """Hierarchical index over codes in Gray order."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        # levels[0] is the codes; each level above has the shared bits and their values of FAN nodes below.
        self.levels: list[tuple[np.ndarray, np.ndarray]] = [(np.full(len(codes), ~np.uint64(0)), codes)]
        low, high = codes, codes
        while len(low) > 1:
            cut = np.arange(0, len(low), FAN)
            low, high = np.bitwise_and.reduceat(low, cut), np.bitwise_or.reduceat(high, cut)
            shared = ~(low ^ high)
            self.levels.append((shared, low & shared))

    def tops(self, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(level, query, node): the few nodes that cover each query's codes first..last-1."""
        level = np.zeros(len(first), np.int64)
        a, b = first.copy(), last - 1
        wide = b - a >= FAN
        while wide.any():
            a, b = np.where(wide, a // FAN, a), np.where(wide, b // FAN, b)
            level += wide
            wide = b - a >= FAN
        for at in np.unique(level):
            q = np.flatnonzero((level == at) & (b >= a))
            n = b[q] - a[q] + 1
            yield int(at), np.repeat(q, n), np.repeat(a[q] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())

    def search(self, queries: np.ndarray, first: np.ndarray, last: np.ndarray, distance: int, done=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Yield (query, code) positions within ``distance``, among the codes
        first..last-1 of each query (and a few beside them).

        ``done(level, query, node)`` tells what need not be looked at.
        """
        stack = []
        for level, q, node in self.tops(first, last):
            shared, value = self.levels[level]
            acc = np.bitwise_count((queries[q] ^ value[node]) & shared[node])
            stack.append((level, q, node, acc))
        while stack:
            level, q, node, acc = stack.pop()
            if len(q) > FRONTIER:
                half = len(q) // 2
                stack += [(level, q[:half], node[:half], acc[:half]), (level, q[half:], node[half:], acc[half:])]
                continue
            near = acc <= distance
            if done is not None:
                near &= ~done(level, q, node)
            q, node, acc = q[near], node[near], acc[near]
            if not len(q):
                continue
            if level == 0:
                yield q, node
                continue
            above = self.levels[level][0][node]
            shared, value = self.levels[level - 1]
            child = (node[:, None] * FAN + np.arange(FAN)).ravel()
            q, acc, above = np.repeat(q, FAN), np.repeat(acc, FAN), np.repeat(above, FAN)
            real = child < len(shared)
            q, acc, above, child = q[real], acc[real], above[real], child[real]
            acc = acc + np.bitwise_count((queries[q] ^ value[child]) & shared[child] & ~above)
            stack.append((level - 1, q, child, acc))


def joined(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Join the groups of a[i] and b[i] in ``parent`` (roots point at
    themselves); the pairs that joined two groups."""
    out = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for x, y in zip(a.tolist(), b.tolist()):
        r, s = root(x), root(y)
        if r != s:
            parent[max(r, s)] = min(r, s)
            out.append((x, y))
    while True:
        up = parent[parent]
        if (up == parent).all():
            return out
        parent[:] = up


def spanning_links(queries: np.ndarray, codes: np.ndarray, first: np.ndarray, last: np.ndarray, distance: int,
                   same: bool) -> list[tuple[int, int]]:
    """Links (query, code) that connect what all links within ``distance`` do.

    With ``same`` the queries are the codes and a pair is looked at once.
    """
    index, n = GrayIndex(codes), len(codes)
    shift = 0 if same else n
    parent = np.arange(n if same else n + len(queries))
    out: list[tuple[int, int]] = []
    for at in range(0, len(queries), QUERIES):
        mine = np.arange(at, min(at + QUERIES, len(queries)))
        own = parent[mine + shift]
        # The one group that all codes of a node belong to, if so (roots do not change in this turn).
        least, most, groups = parent[:n], parent[:n], []
        for level in range(len(index.levels)):
            if level:
                cut = np.arange(0, len(least), FAN)
                least, most = np.minimum.reduceat(least, cut), np.maximum.reduceat(most, cut)
            groups.append(np.where(least == most, least, -1))

        def done(level: int, q: np.ndarray, node: np.ndarray) -> np.ndarray:
            skip = groups[level][node] == own[q]
            return skip | ((node + 1) * FAN ** level - 1 <= mine[q]) if same else skip

        start = np.maximum(first[mine], mine + 1) if same else first[mine]
        pairs = [np.zeros((0, 2), np.int64)]
        for q, c in index.search(queries[mine], start, last[mine], distance, done):
            # One link per pair of groups will do.
            key = np.stack([own[q], parent[c]], 1)
            _, one = np.unique(key, axis=0, return_index=True)
            pairs.append(np.stack([mine[q[one]], c[one]], 1))
        found = np.concatenate(pairs)
        if len(found):
            made = joined(parent, found[:, 0] + shift, found[:, 1])
            out += [(x - shift, y) for x, y in made]
    return out


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit from the top, bits) of the ``distance + 1`` segments."""
    cut = [64 * i // (distance + 1) for i in range(distance + 2)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def gray_rank(code: Column) -> Column:
    """Position of a 64-bit code in Gray order, as a long whose signed order is that of the positions."""
    for step in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, step))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


def tables(codes: DataFrame, distance: int) -> DataFrame:
    """tab, lead, rank, code: all codes once per table; codes of a table that share its front segment share lead."""
    rows = []
    for i, (at, bits) in enumerate(segments(distance)):
        turned = F.col("code") if at == 0 else F.shiftleft("code", at).bitwiseOR(F.shiftrightunsigned("code", 64 - at))
        rows.append(F.struct(F.lit(i).alias("tab"), F.shiftrightunsigned(turned, 64 - bits).alias("lead"), gray_rank(turned).alias("rank")))
    return codes.select("code", F.explode(F.array(*rows)).alias("x")).select("x.*", "code")


FOUND = "a long, b long, tab int, lead long, part long, shared long, value long, code long"
NAMES = [c.split()[0] for c in FOUND.split(", ")]
TYPES = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 5]


def _rows(n: int, **cols: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.nulls(n, t) if c not in cols else pa.array(np.asarray(cols[c]).astype(t.to_pandas_dtype()), t)
                                       for c, t in zip(NAMES, TYPES)], names=NAMES)


def _searched(distance: int):
    """Links within a sorted range; of its first and last run the codes (to
    meet the run's codes in other ranges) and the shared pattern."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.stack([b.column(i).to_numpy() for i in range(3)], 1) for b in batches if b.num_rows]
        if not parts:
            return
        got = np.concatenate(parts)
        tab, lead, code = got[:, 0], got[:, 1], got[:, 2].copy().view(np.uint64)
        cut = np.flatnonzero((tab[1:] != tab[:-1]) | (lead[1:] != lead[:-1])) + 1
        begin, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(code)]])
        first, last = np.repeat(begin, end - begin), np.repeat(end, end - begin)
        links = spanning_links(code, code, first, last, distance, True)
        if links:
            a, b = code[np.array(links)].view(np.int64).T
            yield _rows(len(links), a=a, b=b)
        part = TaskContext.get().partitionId()
        for lo, hi in {(int(begin[0]), int(end[0])), (int(begin[-1]), int(end[-1]))}:
            mine = code[lo:hi]
            low, high = np.bitwise_and.reduce(mine), np.bitwise_or.reduce(mine)
            shared = np.array([~(low ^ high)])
            where = {"tab": np.full(hi - lo, tab[lo]), "lead": np.full(hi - lo, lead[lo]), "part": np.full(hi - lo, part)}
            yield _rows(1, **{k: v[:1] for k, v in where.items()}, shared=shared.view(np.int64), value=(shared & low).view(np.int64))
            yield _rows(hi - lo, **where, code=mine.view(np.int64))

    return run


def _met(distance: int):
    """Links between the two blocks of each group of a sorted stream (tab, lead, i, j, side, code)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def links() -> Iterator[pa.RecordBatch]:
            rows = np.concatenate(held)
            side = rows[:, 4]
            a, b = (rows[side == s, 5].copy().view(np.uint64) for s in (0, 1))
            if len(a) and len(b):
                whole = np.full(len(a), len(b))
                got = spanning_links(a, b, np.zeros(len(a), np.int64), whole, distance, False)
                if got:
                    x, y = np.array(got).T
                    yield _rows(len(got), a=a[x].view(np.int64), b=b[y].view(np.int64))

        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy() for i in range(6)], 1).astype(np.int64) if batch.num_rows else np.zeros((0, 6), np.int64)
            cut = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(1)) + 1
            for piece in np.split(rows, cut):
                if len(piece) and held and (held[0][0, :4] != piece[0, :4]).any():
                    yield from links()
                    held = []
                if len(piece):
                    held.append(piece)
        if held:
            yield from links()

    return run


def links(codes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (a, b) between distinct codes whose components are those of all
    pairs that differ in at most ``distance`` bits."""
    parts = shuffle_partitions(codes.sparkSession)
    ranged = tables(codes, distance).repartitionByRange(parts, "tab", "rank").sortWithinPartitions("tab", "rank")
    found = stored(ranged.select(F.col("tab").cast("long"), "lead", "code").mapInArrow(_searched(distance), FOUND), "simhash-ranges")
    # At most two blocks a range; those of one run meet unless their shared patterns differ too much.
    blocks = found.filter("shared IS NOT NULL").select("tab", "lead", "part", "shared", "value")
    left, right = (blocks.toDF("tab", "lead", p, f"s{p}", f"v{p}") for p in ("i", "j"))
    apart = F.bit_count(F.col("vi").bitwiseXOR(F.col("vj")).bitwiseAND(F.col("si")).bitwiseAND(F.col("sj")))
    pairs = left.join(right, ["tab", "lead"]).filter((F.col("i") < F.col("j")) & (apart <= distance)).select("tab", "lead", "i", "j")
    rows = found.filter("code IS NOT NULL").select("tab", "lead", "part", "code")
    sides = [rows.withColumnRenamed("part", p).join(pairs, ["tab", "lead", p]).select("tab", "lead", "i", "j", F.lit(s).alias("side"), "code")
             for s, p in enumerate(("i", "j"))]
    turned = sides[0].union(sides[1]).select(F.col("tab").cast("long"), "lead", "i", "j", F.col("side").cast("long"), "code")
    key = ["tab", "lead", "i", "j"]
    # Within a block codes follow in Gray order of the unturned code: any order is right, this one shares patterns.
    met = turned.repartition(parts, *key).sortWithinPartitions(*key, "side", gray_rank(F.col("code"))).mapInArrow(_met(distance), FOUND)
    return found.filter("a IS NOT NULL").select("a", "b").union(met.select("a", "b"))


def simhash_groups(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hexadecimal digits), component_id.

    ``docs`` needs doc_id and text; other columns are ignored.  A null, empty
    or blank text has fingerprint zero and is linked like any other.  Rows are
    documents: rows that share a doc_id are linked by their fingerprints only.
    A row without a doc_id links others and gets their component_id, but never
    names one: component_id is null if no row of a component has a doc_id.
    """
    rows = stored(fingerprints(docs, words), "simhash")
    codes = stored(rows.groupBy("code").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "simhash-codes")
    found = components(links(codes.select("code"), distance))
    placed = stored(codes.join(found, F.col("code") == F.col("id"), "left").select("code", "least", "copies", F.coalesce("component", "code").alias("root")), "simhash-placed")
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("codes"))
    known = join_counted(placed, named, "root", "codes").select("code", "copies", "component_id")
    return join_counted(rows, known, "code", "copies").select("doc_id", F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id")
