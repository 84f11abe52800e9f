"""Helpers shared by the operators: scratch tables in the shared folder and
running totals over a global order."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mirrorsmith.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the cluster's ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    Cuts the lineage and survives lost executors; later steps read the file,
    so a column such as a partition number keeps its value.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_total(df: DataFrame, order: list[Column], totals: dict[str, Column], name: str) -> DataFrame:
    """Running sums of ``totals`` (output name: value) over the global order.

    Rows are range-partitioned, each range is summed, the sums of the ranges
    before it (one row per partition) are added to a window within the range.
    No range is a key, so a key with a third of all rows spreads over several
    ranges.  Rows equal in ``order`` are peers and get the same total.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(shuffle_partitions(spark), *order).withColumn("_range", F.spark_partition_id())
    ranged = stored(ranged, name)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_range").agg(*[F.sum(v).alias(f"_sum_{k}") for k, v in totals.items()]) \
        .select("_range", *[F.coalesce(F.sum(f"_sum_{k}").over(before), F.lit(0)).alias(f"_before_{k}") for k in totals])
    within = Window.partitionBy("_range").orderBy(*order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per partition: bounded by the partition count, whatever the input.
    return ranged.join(F.broadcast(offsets), "_range") \
        .withColumns({k: F.sum(v).over(within) + F.col(f"_before_{k}") for k, v in totals.items()}) \
        .drop("_range", *[f"_before_{k}" for k in totals])


def join_counted(rows: DataFrame, keys: DataFrame, on: str, count: str) -> DataFrame:
    """``rows`` joined to the unique ``keys``, whose ``count`` says how many rows hold each.

    A key with more than a partition's share of all rows would make one task of
    a shuffle join long.  There are fewer such keys than partitions, so they are
    broadcast; the rows of all others meet by shuffle.
    """
    keys = stored(keys, "keys")
    share = (keys.agg(F.sum(count)).first()[0] or 0) / shuffle_partitions(rows.sparkSession)
    hot = F.broadcast(keys.filter(F.col(count) > share))
    return rows.join(hot, on).unionByName(
        rows.join(hot.select(on), on, "left_anti").join(keys.filter(F.col(count) <= share), on))


def renamed(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns called c0, c1, ... and the new name of each.

    Operators that carry all columns along work on these, so no column can
    clash with one they add.
    """
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names
