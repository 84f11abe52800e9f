"""Grouped views kept up from a change set (OP-54).

A view holds, per group, the number of rows and, per summed column, the sum and
the number of values.  A refresh's change set gives what it takes away (the old
row of each updated or deleted key) and adds (the new row of each inserted or
updated key); a group without rows left goes.  Neither the mirror nor the view's
definition is evaluated again: the work grows with the changes and the groups.

Sums are exact only of exact types, so floating-point columns are refused.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from mirrorsmith.operators.merge import DELETE, INSERT, UPDATE, new, old

ROW_COUNT, VALUE_COUNT = "n_rows", "_n_"
Expr = Callable[[Callable[[str], Column]], Column]   # a column of a row, given how to name the row's columns


def _terms(row: Callable[[str], Column], group: dict[str, Expr] | list[str], sums: dict[str, Expr]) -> list[Column]:
    keys = {g: (lambda r, g=g: r(g)) for g in group} if isinstance(group, list) else group
    return [f(row).alias(g) for g, f in keys.items()] + [f(row).alias(s) for s, f in sums.items()]


def _exact(df: DataFrame, sums: list[str]) -> None:
    for s in sums:
        if isinstance(df.schema[s].dataType, (T.FloatType, T.DoubleType)):
            raise TypeError(f"{s}: a sum of floating-point numbers cannot be kept up exactly; cast it to a decimal")


def grouped(df: DataFrame, group: dict[str, Expr] | list[str], sums: dict[str, Expr]) -> DataFrame:
    """The view over all rows: groups, `ROW_COUNT`, and per sum its value and number of values."""
    rows = df.select(*_terms(F.col, group, sums))
    _exact(rows, list(sums))
    return rows.groupBy(*list(group)).agg(F.count(F.lit(1)).alias(ROW_COUNT), *[F.sum(s).alias(s) for s in sums],
                                          *[F.count(s).alias(VALUE_COUNT + s) for s in sums])


def view_delta(changes: DataFrame, group: dict[str, Expr] | list[str], sums: dict[str, Expr]) -> DataFrame:
    """What a change set does to the view, one row per group it touches."""
    def side(row: Callable[[str], Column], sign: int) -> Column:
        return F.struct(F.lit(sign).alias("_sign"), *_terms(row, group, sums))

    # the key columns of a change set are common to both rows
    mine = lambda f: lambda c: f(c) if f"_old_{c}" in changes.columns else F.col(c)
    gone, come = side(mine(old), -1), side(mine(new), 1)
    rows = changes.filter(F.col("action").isin(INSERT, UPDATE, DELETE)).select(F.explode(
        F.when(F.col("action") == DELETE, F.array(gone)).when(F.col("action") == INSERT, F.array(come)).otherwise(F.array(gone, come))).alias("x")).select("x.*")
    _exact(rows, list(sums))
    # negated, not multiplied: a product of decimals has fewer places
    return rows.groupBy(*list(group)).agg(
        F.sum("_sign").cast("long").alias(ROW_COUNT), *[F.sum(F.when(F.col("_sign") < 0, -F.col(s)).otherwise(F.col(s))).alias(s) for s in sums],
        *[F.sum(F.when(F.col(s).isNotNull(), F.col("_sign"))).cast("long").alias(VALUE_COUNT + s) for s in sums])


def maintained(view: DataFrame, delta: DataFrame, group: list[str], sums: list[str]) -> DataFrame:
    """The view after the changes; a sum without values left is NULL, a group
    without rows left goes.  NULL is a group of its own."""
    wanted = [*group, ROW_COUNT, *sums, *[VALUE_COUNT + s for s in sums]]
    total = view.select(*wanted).unionByName(delta.select(*wanted)).groupBy(*group).agg(
        *[F.sum(c).alias(c) for c in wanted if c not in group]).filter(F.col(ROW_COUNT) > 0)
    kinds = {f.name: f.dataType for f in view.schema.fields}
    return total.select(*group, F.col(ROW_COUNT).cast(kinds[ROW_COUNT]).alias(ROW_COUNT),
                        *[F.when(F.col(VALUE_COUNT + s) > 0, F.col(s)).cast(kinds[s]).alias(s) for s in sums],
                        *[F.coalesce(VALUE_COUNT + s, F.lit(0)).cast("long").alias(VALUE_COUNT + s) for s in sums])
