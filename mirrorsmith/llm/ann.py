"""Nearest neighbours by multi-index hashing of learned binary codes.

Vectors become codes: signs after rotations that are learned (iterative
quantization) on a bounded sample.  A code is cut into substrings of one byte
and each substring is an index of its own.  By the pigeonhole principle a code
within Hamming radius r of a query lies within r // m of it in some substring
(r // m - 1 in the later ones), so probing the bytes within that distance
retrieves every code within r.  Codes within r are reranked by inner product of
the vectors in double precision.  The radius is the one that keeps ``RECALL``
of the sample's true neighbours; a query that finds too few in a block widens
its radius there.

A block of vectors is indexed in one task, through which the queries stream;
only more than ``QUERY_BLOCK`` queries take a second copy of it.  Equal vectors are one
entry with its smallest ids, so a vector that a third of the rows share costs
one entry.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mirrorsmith.llm.common import shuffle_partitions, stored

BITS = 256
TABLES = BITS // 8
SAMPLE = 8192          # vectors at most that rotations and radius are learned on
SAMPLE_QUERIES = 512
RECALL = 0.98          # of the sample's true neighbours within the radius
ROUNDS = 12            # of iterative quantization
VECTOR_BLOCK = 8_192   # vectors that are indexed together
QUERY_BLOCK = 1 << 18  # queries that stream through one copy of a block's index
K = 20


@dataclass
class Codes:
    """Learned codes for inner product search.

    A vector x gets a further component sqrt(norm**2 - |x|**2), a query 0 and
    the same norm; then the largest inner product is the nearest vector.
    """

    norm: float
    mean: np.ndarray
    turn: np.ndarray     # components x BITS
    radius: int = BITS

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        size = np.sqrt((x * x).sum(axis=1))
        if query:
            return np.column_stack([x * (self.norm / size)[:, None], np.zeros(len(x))])
        return np.column_stack([x, np.sqrt(np.maximum(0, self.norm ** 2 - size ** 2))])

    def of(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Codes, one byte a substring."""
        return np.packbits((self.lifted(x, query) - self.mean) @ self.turn > 0, axis=1)


def learn(sample: np.ndarray, norm: float, k: int = K) -> Codes:
    """Rotations and radius from a sample of vectors (rows in a fixed order)."""
    d = sample.shape[1] + 1
    codes = Codes(norm, np.zeros(d), np.zeros((d, BITS)))
    x = codes.lifted(sample, False)
    codes.mean = x.mean(axis=0)
    x = x - codes.mean
    turns = []
    for i in range(-(-BITS // d)):
        turn = np.linalg.qr(np.random.default_rng(i).normal(size=(d, d)))[0]
        for _ in range(ROUNDS):
            u, _, v = np.linalg.svd(np.where(x @ turn > 0, 1.0, -1.0).T @ x)
            turn = (u @ v).T
        turns.append(turn)
    codes.turn = np.concatenate(turns, axis=1)[:, :BITS]
    if len(sample) > k + 1:
        asked = np.arange(min(SAMPLE_QUERIES, len(sample)))
        near = sample[asked] @ sample.T
        near[asked, asked] = -np.inf
        best = np.argpartition(-near, k, axis=1)[:, :k]
        a, b = codes.of(sample[asked], True), codes.of(sample)
        far = np.bitwise_count(a[:, None, :] ^ b[best]).sum(axis=2, dtype=np.int64)
        codes.radius = int(np.ceil(np.quantile(far, RECALL)))
    return codes


_ALL = np.arange(256, dtype=np.uint8)
_APART = np.bitwise_count(_ALL[:, None] ^ _ALL[None, :])


class Index:
    """The substring indexes of a block of codes.

    The posting list of a byte value in a substring is a bitmap over the
    block.  Probing all values within some distance of a byte is one lookup:
    their united bitmaps are made once per substring and distance.
    """

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.words = np.ascontiguousarray(codes).view(np.uint64)
        self.reached: dict[tuple[int, int], np.ndarray] = {}

    def postings(self, j: int, reach: int) -> np.ndarray:
        """Per byte value: the codes whose substring ``j`` is within ``reach`` of it."""
        if (j, reach) not in self.reached:
            own = np.packbits(self.codes[:, j][None, :] == _ALL[:, None], axis=1)
            self.reached[j, reach] = np.stack([np.bitwise_or.reduce(own[_APART[v] <= reach], axis=0) for v in range(256)])
        return self.reached[j, reach]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All positions of codes within ``radius`` of ``code``."""
        whole, more = divmod(radius, TABLES)
        found = np.zeros(-(-len(self.codes) // 8), np.uint8)
        for j in range(TABLES):
            reach = whole if j <= more else whole - 1
            if reach >= 0:
                found |= self.postings(j, min(reach, 8))[code[j]]
        near = np.flatnonzero(np.unpackbits(found, count=len(self.codes)))
        apart = np.bitwise_count(self.words[near] ^ code.view(np.uint64)).sum(axis=1, dtype=np.int64)
        return near[apart <= radius]


def search(index: Index, codes: Codes, vectors: np.ndarray, ids: list[list[int]], query: np.ndarray, code: np.ndarray,
           own: int, k: int) -> list[tuple[int, float]]:
    """The k best (id, score) of a block among the codes within the radius."""
    radius = codes.radius
    while True:
        near = index.within(code, radius)
        if len(near) > k or radius >= BITS:
            break
        radius += TABLES   # every substring reaches one bit further
    score = (vectors[near] * query).sum(axis=1)
    if len(near) > k + 1:
        least = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
        near, score = near[score >= least], score[score >= least]
    found = [(i, float(s)) for n, s in zip(near, score) for i in ids[n] if i != own]
    return sorted(found, key=lambda x: (-x[1], x[0]))[:k]


def _searched(codes: Codes, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, vectors, ids, index, block = None, [], [], None, None
        for b in batches:
            out = []
            v = b.column(4).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) if b.num_rows else None
            for i, (vb, qb, role, own) in enumerate(zip(*[b.column(j).to_pylist() for j in (0, 1, 2, 3)])):
                if at != (vb, qb):
                    at, vectors, ids, index = (vb, qb), [], [], None
                if role == 0:   # the block's vectors come first
                    vectors.append(v[i])
                    ids.append(b.column(5)[i].as_py())
                elif vectors:
                    if index is None:
                        block = np.array(vectors)
                        index = Index(codes.of(block))
                    q = v[i]
                    out += [(own, n, s) for n, s in search(index, codes, block, ids, q, codes.of(q[None, :], True)[0], own, k)]
            if out:
                a, n, s = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(n, pa.int64()), pa.array(s, pa.float64())], names=["query_id", "vec_id", "score"])
    return run


def valid_vectors(table: DataFrame) -> DataFrame:
    """vec_id, embedding as doubles: the rows that take part.  Their vectors must be of one length."""
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")) \
        .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()) \
        .filter(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))) \
        .filter(F.exists("embedding", lambda x: x != 0))
    shortest, longest = rows.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if shortest != longest:
        raise ValueError(f"vectors of different lengths: {shortest} to {longest}")
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def nearest(table: DataFrame, every: int = 20, k: int = K) -> DataFrame:
    """The k nearest of each query: query_id, rank, vec_id, score.

    ``table`` needs vec_id and embedding; other columns are ignored.  Queries
    are the rows whose vec_id is divisible by ``every``, candidates all rows
    but the query's own.  Vectors that are null, zero, empty or hold null or
    non-finite components take no part, nor do rows without a vec_id; others of
    different lengths are an error.  Of rows that share a vec_id the smallest
    vector counts.  Ties go to the smaller vec_id.  With fewer than k candidates
    all are returned.
    """
    spark = table.sparkSession
    valid = stored(valid_vectors(table), "vectors")
    queries = valid.filter(F.col("vec_id") % every == 0)
    # No query needs more than k + 1 rows of one vector.
    first = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    entries = stored(valid.withColumn("nth", first).filter(F.col("nth") <= k + 1)
                     .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "entries")
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    count, longest = entries.agg(F.count("*"), F.max(norm)).first()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # A bounded sample, the same in every run.
    drawn = entries.orderBy(F.xxhash64(F.col("ids")[0]), F.col("ids")[0]).limit(SAMPLE).select("embedding").toArrow()
    sample = drawn["embedding"].combine_chunks()
    codes = learn(np.array(sample.flatten()).reshape(len(sample), -1), longest, k)
    vector_blocks, query_blocks = -(-count // VECTOR_BLOCK), max(1, -(-queries.count() // QUERY_BLOCK))
    zero = F.lit(0)
    sides = entries.select(F.pmod(F.xxhash64("embedding"), F.lit(vector_blocks)).cast("int").alias("vb"),
                           F.explode(F.sequence(zero, F.lit(query_blocks - 1))).alias("qb"), zero.alias("role"),
                           F.lit(None).cast("long").alias("own"), "embedding", "ids") \
        .unionByName(queries.select(F.explode(F.sequence(zero, F.lit(vector_blocks - 1))).alias("vb"),
                                    F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int").alias("qb"), F.lit(1).alias("role"),
                                    F.col("vec_id").alias("own"), "embedding", F.lit(None).cast("array<long>").alias("ids")))
    parts = max(shuffle_partitions(spark), vector_blocks * query_blocks)
    # one pair of blocks a task
    found = sides.repartitionById(parts, F.col("vb") * query_blocks + F.col("qb")).sortWithinPartitions("vb", "qb", "role").mapInArrow(_searched(codes, k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
