"""Soft merge of a complete or keyed load into the mirror (OP-30..35).

The mirror is made equal to the load, but rows are only rewritten when they
changed.  One full outer join on the key classifies each key as ``insert``,
``update``, ``delete`` or ``same``; everything else (merged snapshot, change
counts, inserted or deleted rows) is a projection of that change set.

At scale: the join shuffles both sides on the key once.  When the load comes
out of `first_arrival` (a window partitioned by the same key) Spark reuses
that hash partitioning, so only the mirror side is exchanged.  AQE splits
skewed key ranges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

INSERT, UPDATE, DELETE, SAME = "insert", "update", "delete", "same"


def old(name: str) -> Column:
    """A column of the mirror in a change set (NULL for an inserted key)."""
    return F.col(f"_old_{name}")


def new(name: str) -> Column:
    """A column of the load in a change set (NULL for a deleted key)."""
    return F.col(f"_new_{name}")


def changed_by_version(version: str) -> Column:
    """Version column differs (other columns are not compared)."""
    return ~old(version).eqNullSafe(new(version))


def changed_by_value(value_cols: list[str]) -> Column:
    """Any non-key column differs, NULL-safe (arrays and structs included)."""
    if not value_cols:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [~old(c).eqNullSafe(new(c)) for c in value_cols])


def change_set(cur: DataFrame, src: DataFrame, key_cols: list[str], version: str | None = None) -> DataFrame:
    """(key..., action, _old_<column>..., _new_<column>...) for every key of cur ∪ src.

    Columns stay apart (no row structs), so a query over the result reads only
    the columns it uses, plus the version.
    """
    value_cols = [c for c in src.columns if c not in key_cols]
    left = cur.select(*key_cols, F.lit(True).alias("_old"), *[F.col(c).alias(f"_old_{c}") for c in value_cols])
    right = src.select(*key_cols, F.lit(True).alias("_new"), *[F.col(c).alias(f"_new_{c}") for c in value_cols])
    joined = left.join(right, on=key_cols, how="full_outer")
    changed = changed_by_version(version) if version else changed_by_value(value_cols)
    action = (F.when(F.col("_old").isNull(), F.lit(INSERT))
              .when(F.col("_new").isNull(), F.lit(DELETE))
              .when(changed, F.lit(UPDATE))
              .otherwise(F.lit(SAME)))
    return joined.withColumn("action", action).drop("_old", "_new")


def apply_changes(changes: DataFrame, key_cols: list[str], with_action: bool = False) -> DataFrame:
    """Merged mirror: inserts and updates take the new row, unchanged keys keep
    the old row (with version detection other columns may differ), deletes go."""
    value_cols = [c[len("_new_"):] for c in changes.columns if c.startswith("_new_")]
    extra = ["action"] if with_action else []
    taken = F.col("action").isin(INSERT, UPDATE)
    return changes.filter(F.col("action") != DELETE).select(
        *key_cols, *extra, *[F.when(taken, new(c)).otherwise(old(c)).alias(c) for c in value_cols])


def merge_full(cur: DataFrame, src: DataFrame, key_cols: list[str], version: str | None = None,
               with_action: bool = False) -> DataFrame:
    return apply_changes(change_set(cur, src, key_cols, version), key_cols, with_action)


def change_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("action").agg(F.count(F.lit(1)).alias("n_rows"))


def inserts(cur: DataFrame, src: DataFrame, key_cols: list[str]) -> DataFrame:
    """Rows of the load whose key is not in the mirror (OP-32)."""
    return src.join(cur.select(*key_cols), on=key_cols, how="left_anti")


def deletes(cur: DataFrame, src: DataFrame, key_cols: list[str]) -> DataFrame:
    """Mirror rows whose key is absent from the load (OP-33): exactly those."""
    return cur.join(src.select(*key_cols), on=key_cols, how="left_anti")


def refresh_by_key(cur: DataFrame, fetched: DataFrame, keys: DataFrame, key_cols: list[str]) -> DataFrame:
    """Batch form of the per-key refresh (OP-34).

    ``keys`` are the requested keys, ``fetched`` what the source returned for
    them.  Found keys are upserted, missing ones deleted, other rows kept.

    Only the requested keys, each once and without other columns, are held in a
    task's memory; the rows of both sides stream past them unsorted.
    """
    requested = keys.select(*key_cols).distinct().hint("shuffle_hash")
    kept = cur.join(requested, on=key_cols, how="left_anti")
    found = fetched.join(requested, on=key_cols, how="left_semi")
    return kept.unionByName(found)


def enum_merge(existing: DataFrame, members: DataFrame, ref: str = "ref", order: str = "ord",
               pos: str = "pos") -> DataFrame:
    """Enumeration refresh (OP-35).

    Existing members keep their order number, absent ones are dropped, new
    ones get ``max(order) + their rank by position``; the maximum is taken over
    the table before deletion (one statement, one snapshot).
    """
    base = existing.agg(F.coalesce(F.max(order), F.lit(0)).cast("long")).scalar()
    kept = existing.join(members.select(ref), on=ref, how="left_semi").select(ref, order)
    new = members.join(existing.select(ref), on=ref, how="left_anti")
    # members of one enumeration are metadata (bounded by its definition), so
    # one window over the new members is the whole numbering
    rank = F.row_number().over(Window.orderBy(pos, ref))
    added = new.select(ref, (base + rank).cast("long").alias(order))
    return kept.unionByName(added)
