"""Near-duplicate documents by b-bit MinHash and exact confirmation.

1. Every document becomes a profile: size and digest of its set of word
   shingles, the low bits of its MinHash minima packed into a signature, and
   keys of bands of the full minima.  Equal sets are one class; its smallest
   doc_id stands for it.
2. Classes that share a band key are candidates.  A bucket is not expanded to
   pairs: its most central member (the one with the most bucket mates over all
   bands) leads it, and a family is a leader with everything it shares a
   bucket with.
3. Members are confirmed against their leader on full sets.  Members that are
   no link of the leader are confirmed against the whole family, in blocks of
   bounded size; pairs whose signatures estimate a similarity far below the
   threshold are passed over.
4. Components of the confirmed links.

With 20 bands of 4 minima a pair at similarity 0.8 shares no band once in
38,000 pairs, at 0.85 once in 2.5 million.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorsmith.llm.common import renamed, shuffle_partitions, stored
from mirrorsmith.llm.components import components
from mirrorsmith.llm.text import mix64, seeds, shingle_sets

BANDS, ROWS, BITS = 20, 4, 4
MINIMA = BANDS * ROWS
THRESHOLD = 80            # per cent
BLOCK_SHINGLES = 1 << 20  # shingles of a family that one group confirms at once
# A pair is passed over if its estimate is this much below the threshold: over
# six standard errors of an estimate from 80 minima of 4 bits.
MARGIN = 0.33
SPREAD = 1 << 12          # shingles hashed at once for one document


def minima(s: np.ndarray) -> np.ndarray:
    """The MinHash minima (32 bits each) of one set."""
    a, b = seeds(MINIMA, 11) | np.uint64(1), seeds(MINIMA, 12)
    out = np.full(MINIMA, 0xFFFFFFFF, np.uint64)
    for i in range(0, len(s), SPREAD):
        out = np.minimum(out, ((s[None, i:i + SPREAD] * a[:, None] + b[:, None]) >> np.uint64(32)).min(axis=1))
    return out


def packed(m: np.ndarray) -> bytes:
    """The low ``BITS`` = 4 bits of each minimum, two to a byte."""
    low = (m & np.uint64(15)).astype(np.uint8)
    return (low[::2] << 4 | low[1::2]).tobytes()


def band_keys(m: np.ndarray) -> np.ndarray:
    k = seeds(BANDS, 13)
    for j in range(ROWS):
        k = mix64(k ^ m.reshape(BANDS, ROWS)[:, j] * np.uint64(0x9E3779B97F4A7C15))
    return k.astype(np.int64)


def estimates(sig: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarity of one signature to others: the share of equal 4-bit groups,
    counted on bits, less the 1/16 that agree by chance."""
    d = sig[None, :] ^ others
    d |= d >> 2
    d |= d >> 1
    differ = np.bitwise_count(d & 0x11).sum(axis=1, dtype=np.int64)
    chance = 1 / (1 << BITS)
    return ((1 - differ / MINIMA) - chance) / (1 - chance)


PROFILE = "doc_id long, n long, key binary, sig binary, bands array<long>"


def profiles(docs: DataFrame, k: int) -> DataFrame:
    """One row per document; a text without words has n = 0 and no key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, key, sig, bands = [], [], [], []
            for s in shingle_sets(b.column(1), k):
                n.append(len(s))
                if not len(s):
                    key.append(None), sig.append(None), bands.append(None)
                    continue
                m = minima(s)
                key.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sig.append(packed(m))
                bands.append(band_keys(m))
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(sig, pa.binary()),
                pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n", "key", "sig", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PROFILE)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """Rows in a sorted stream, gathered by equal (leader, ublock, block)."""
    have: dict[str, list] = {}
    at = None
    for b in batches:
        cols = {c: b.column(c) for c in b.schema.names}
        key = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in ("leader", "ublock", "block")], 1)
        if not len(key):
            continue
        cut = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
        for lo, hi in zip([0, *cut], [*cut, len(key)]):
            if at is not None and at != tuple(key[lo]):
                yield have
                have = {}
            at = tuple(key[lo])
            for c in ("doc", "role", "sig", "text"):
                have.setdefault(c, []).extend(cols[c][int(lo):int(hi)].to_pylist())
    if have:
        yield have


def confirm(docs: list[int], roles: list[int], sigs: list[bytes], texts: list[str], k: int, threshold: int,
            spanning: bool) -> tuple[list[tuple[int, int]], set[int]]:
    """Links between the rows of role 1 and all rows of a group, on full sets.

    Returns the links and the rows that have one.  With ``spanning``, a link
    between rows that are connected already is not looked for: rows of role 2
    are (through the leader), others by the links found so far.
    """
    sets = list(shingle_sets(pa.array(texts, pa.large_string()), k))
    size = np.array([len(s) for s in sets], np.int64)
    words, where = np.unique(np.concatenate(sets), return_inverse=True) if sets else (np.zeros(0), np.zeros(0, int))
    off = np.concatenate([[0], np.cumsum(size)])
    packed_sigs = np.frombuffer(b"".join(sigs), np.uint8).reshape(len(docs), -1)
    parent = list(range(len(docs)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    settled = [i for i, r in enumerate(roles) if r == 2]
    for i in settled[1:]:
        parent[i] = settled[0]
    links: list[tuple[int, int]] = []
    linked: set[int] = set()
    ids = np.array(docs)
    for u in [i for i, r in enumerate(roles) if r == 1]:
        near = (estimates(packed_sigs[u], packed_sigs) >= threshold / 100 - MARGIN) & (ids != ids[u]) \
            & (100 * np.minimum(size, size[u]) >= threshold * np.maximum(size, size[u]))
        if spanning:
            top = root(u)
            near &= np.array([root(i) != top for i in range(len(docs))])
        at = np.flatnonzero(near)
        if not len(at):
            continue
        mine = np.zeros(len(words), bool)
        mine[where[off[u]:off[u + 1]]] = True
        hit = np.concatenate([[0], np.cumsum(mine[where])])
        both = hit[off[at + 1]] - hit[off[at]]
        for i in at[100 * both >= threshold * (size[at] + size[u] - both)]:
            if spanning:
                a, b = root(u), root(int(i))
                if a == b:
                    continue
                parent[a] = b
            links.append((docs[u], docs[i]))
            linked.add(docs[i])
    return links, linked


def _confirmed(rows: DataFrame, texts: DataFrame, k: int, threshold: int, spanning: bool) -> DataFrame:
    """``rows``: leader, ublock, block, doc, role -> leader, a, b; b null for a member the leader has no link to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches):
            links, linked = confirm(g["doc"], g["role"], g["sig"], g["text"], k, threshold, spanning)
            if not spanning:
                links += [(d, None) for d, r in zip(g["doc"], g["role"]) if r == 0 and d not in linked]
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], names=["a", "b"])

    order = ["leader", "ublock", "block"]
    sent = rows.join(texts, rows["doc"] == texts["id"]).select(*order, "doc", "role", "sig", "text")
    return sent.repartition(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order, "role", "doc") \
        .mapInArrow(run, "a long, b long")


def links(docs: DataFrame, profile: DataFrame, k: int, threshold: int = THRESHOLD) -> DataFrame:
    """Edges (a, b) whose components are those of all links between documents."""
    known = profile.filter("n > 0 AND doc_id IS NOT NULL")
    classes = stored(known.groupBy("key").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"),
                                              F.first("sig").alias("sig"), F.first("bands").alias("bands")), "classes")
    copies = known.select("key", "doc_id").join(classes.select("key", "id"), "key").filter("doc_id <> id") \
        .select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    banded = classes.select("id", "n", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("mates")).filter("mates > 1")
    mates = stored(banded.join(shared, "band"), "mates")
    rank = mates.groupBy("id").agg(F.sum("mates").alias("rank"))
    leaders = mates.join(rank, "id").groupBy("band").agg(F.max(F.struct("rank", (-F.col("id")).alias("minus"))).alias("top")) \
        .select("band", (-F.col("top.minus")).alias("leader"))
    family = stored(mates.join(leaders, "band").filter("leader <> id").groupBy("leader", F.col("id").alias("doc"))
                    .agg(F.max("n").alias("n")), "family")
    wanted = family.select("doc").union(family.select("leader")).distinct()
    # A document's text is taken once more, and only if it has a candidate.
    texts = stored(docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(wanted.hint("shuffle_hash"), F.col("id") == F.col("doc"), "left_semi")
                   .join(classes.select("id", "sig").hint("shuffle_hash"), "id"), "texts")
    blocks = family.groupBy("leader").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("blocks"))
    placed = family.join(blocks, "leader").select("leader", F.lit(0).cast("long").alias("ublock"),
                                                  F.pmod(F.xxhash64("doc"), "blocks").alias("block"), "doc", F.lit(0).alias("role"))
    heads = blocks.select("leader", F.lit(0).cast("long").alias("ublock"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
                          F.col("leader").alias("doc"), F.lit(1).alias("role"))
    stars = stored(_confirmed(placed.union(heads), texts, k, threshold, False), "stars")
    # Left over: members without a link to a leader of theirs, with every family they are in.
    linked = stars.filter("b IS NOT NULL").select(F.col("a").alias("leader"), F.col("b").alias("doc"))
    loose = stored(family.join(stars.filter("b IS NULL").select(F.col("a").alias("doc")).distinct(), "doc", "left_semi")
                   .join(linked, ["leader", "doc"], "left_anti"), "loose")
    ublocks = loose.groupBy("leader").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("ublocks")).join(blocks, "leader")
    zero = F.lit(0).cast("long")
    rest = family.join(ublocks, "leader").join(linked.distinct().withColumn("settled", F.lit(2)), ["leader", "doc"], "left")
    rest = rest.select("leader", F.explode(F.sequence(zero, F.col("ublocks") - 1)).alias("ublock"),
                       F.pmod(F.xxhash64("doc"), "blocks").alias("block"), "doc", F.coalesce("settled", F.lit(0)).alias("role"))
    ask = loose.join(ublocks, "leader").select("leader", F.pmod(F.xxhash64("doc"), "ublocks").alias("ublock"),
                                               F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("block"), "doc", F.lit(1).alias("role"))
    more = _confirmed(rest.union(ask), texts, k, threshold, True)
    return copies.union(linked).union(more)


def near_duplicates(docs: DataFrame, k: int = 5, threshold: int = THRESHOLD) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.  A null
    or blank text has an empty set and is linked with nothing.  Rows that share
    a doc_id are one document with several texts.  A row without a doc_id is in
    no component (component_id null) and is kept.
    """
    profile = stored(profiles(docs, k), "profiles")
    found = components(links(docs, profile, k, threshold))
    return profile.join(found, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("component", "doc_id").eqNullSafe(F.col("doc_id")).alias("kept"))


def keep_one(docs: DataFrame, k: int = 5, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each group, that of the smallest doc_id."""
    rows, name = renamed(docs)
    dropped = near_duplicates(docs, k, threshold).filter("NOT kept").select(F.col("doc_id").alias("dropped")).distinct()
    return rows.join(dropped, F.col(name["doc_id"]).cast("long") == F.col("dropped"), "left_anti").toDF(*docs.columns)


ORACLE = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
  FROM (SELECT doc_id, w, UNNEST(range(1, greatest(len(w), 2))) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS r FROM t UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.r),
m AS (SELECT doc_id, MIN(r) AS component_id FROM r GROUP BY doc_id)
SELECT t.doc_id, CAST(COALESCE(n.n, 0) AS BIGINT) AS n_shingles, m.component_id, t.doc_id = m.component_id AS kept
FROM t JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)
"""
