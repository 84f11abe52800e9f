"""Overlap dedup, first arrival wins (OP-03).

Pages overlap by half a page, so a row can arrive twice; the copy from the
earliest page (and earliest position in it) is kept.

Written as ``row_number() over (partition by key order by arrival) = 1``:
the input is evaluated once (the page bodies are parsed once), the rows are
shuffled once by key, and Spark's window group limit keeps only the first
row of each key per map task before the shuffle, so a key that arrives many
times (a hot key) is reduced map-side.  Page and position are packed into
one ``long`` so the sort compares a single number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

_INTS = (T.ByteType, T.ShortType, T.IntegerType)


def arrival_order(page_no: str = "page_no", pos: str = "pos"):
    """Arrival as one sortable ``long``: page number high, position low."""
    return F.col(page_no).cast("long") * F.lit(1 << 32) + F.col(pos).cast("long")


def first_arrival(df: DataFrame, key_cols: list[str], order_cols: tuple[str, ...] = ("page_no", "pos"),
                  keep_order_cols: bool = True) -> DataFrame:
    packed = (len(order_cols) == 2 and
              all(isinstance(df.schema[c].dataType, _INTS) for c in order_cols))
    order = [arrival_order(*order_cols)] if packed else [F.col(c) for c in order_cols]
    rank = F.row_number().over(Window.partitionBy(*key_cols).orderBy(*order))
    out = df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
    return out if keep_order_cols else out.drop(*order_cols)


def duplicate_keys(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """Keys that occur more than once (OP-45) with their counts."""
    return (df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))
