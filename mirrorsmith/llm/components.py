"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorsmith.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (id, component): the smallest id reachable.

    Each round hangs every vertex's larger neighbours, then its smaller ones,
    on its smallest neighbour; edges end as (vertex, smallest id).  The rounds
    grow with the logarithm of the size of a component, not its diameter.  A
    hub's neighbours stay rows of a join, they are never gathered.
    """
    e = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        both = e.union(e.select("b", "a"))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.distinct(), "edges")
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(low, F.col("a") == F.col("u")).select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")) \
            .select("x.*").filter("a > b")
        e = stored(small.distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return e.select(F.col("a").alias("id"), F.col("b").alias("component"))
        seen = now
