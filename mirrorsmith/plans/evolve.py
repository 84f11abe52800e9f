"""Schema evolution: compare expected and actual columns, apply (OP-42, OP-43).

The expected side is a table description, the actual side the schema of the
current snapshot.  Dropped columns keep the data of the others; any added
column (or changed section) means the snapshot has to be reloaded in full,
exactly as the source-driven mirror truncates and refreshes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from mirrorsmith.plans.description import TableDescription

SCHEMA_ROW = "name string, type string"


def schema_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """(name, type) of a Spark schema, types as simple strings."""
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields], SCHEMA_ROW)


def schema_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Full outer join of two (name, type) frames by name:
    ``add`` (missing), ``drop`` (extra), ``retype`` (drop and add), ``same``."""
    e = expected.select("name", F.col("type").alias("expected_type"))
    a = actual.select("name", F.col("type").alias("actual_type"))
    j = e.join(a, "name", "full_outer")
    action = (F.when(F.col("actual_type").isNull(), F.lit("add"))
              .when(F.col("expected_type").isNull(), F.lit("drop"))
              .when(F.col("expected_type") != F.col("actual_type"), F.lit("retype"))
              .otherwise(F.lit("same")))
    return j.select("name", "expected_type", "actual_type", action.alias("action"))


def plan_changes(spark: SparkSession, desc: TableDescription, current: T.StructType) -> dict[str, list[str]]:
    """Column names per action for one table (driver-side, one schema)."""
    diff = schema_diff(schema_rows(spark, desc.spark_schema()), schema_rows(spark, current)).collect()
    out: dict[str, list[str]] = {"add": [], "drop": [], "retype": [], "same": []}
    for r in diff:
        out[r["action"]].append(r["name"])
    return out


def apply_schema(df: DataFrame, desc: TableDescription) -> tuple[DataFrame, bool]:
    """Project ``df`` onto the description.

    Returns the projected frame and whether a full reload is needed (a column
    was added or changed type: its values are unknown until the source is
    read again, so the snapshot is emptied like the source-driven truncate).
    Types are compared by name, as `plan_changes` does: stored files say
    nothing about nullability.
    """
    target = desc.spark_schema()
    changes = plan_changes(df.sparkSession, desc, df.schema)
    if changes["add"] or changes["retype"]:
        return df.sparkSession.createDataFrame([], target), True
    return df.select(*[F.col(f.name) for f in target.fields]), False
