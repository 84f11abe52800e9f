"""Identifier abbreviation (OP-17).

A long name is shortened step by step: each step cuts the lower-case tail of
the **last** capitalised (or ``_x``) word, ``КонтактнаяИнформация`` →
``КонтактнаяИ`` → ``КИ``.  The candidates are tried in that order; the first
one that fits the byte limit (only when short names are asked for) and is not
already taken is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

# FIXED VALUES: one step of the abbreviation, a word as it sees one, and the identifier byte limit.
STEP_PATTERN = "(.*)([А-Я]|[A-Z]|_[а-я]|_[a-z])([а-я]+|[a-z]+)(.*)"
WORD = "([А-Я]|[A-Z]|_[а-я]|_[a-z])([а-я]+|[a-z]+)"
STEP_REPLACEMENT = "$1$2$4"
MAX_IDENTIFIER_BYTES = 63


def abbreviation_candidates(name: Column) -> Column:
    """Array of candidates, longest first, without repeats.

    Every step removes one word tail, so the number of word matches bounds
    the number of steps; the fixpoint repeats are dropped by `array_distinct`.
    """
    steps = F.size(F.regexp_extract_all(name, F.lit(WORD), 0))
    chain = F.aggregate(
        F.sequence(F.lit(1), F.greatest(steps, F.lit(1))),
        F.array(name),
        lambda acc, _i: F.concat(acc, F.array(F.regexp_replace(F.element_at(acc, -1), STEP_PATTERN, STEP_REPLACEMENT))),
    )
    return F.array_distinct(chain)


def fits(name: Column, max_bytes: int = MAX_IDENTIFIER_BYTES) -> Column:
    return F.octet_length(name) <= F.lit(max_bytes)


def first_fitting(candidates: Column, max_bytes: int = MAX_IDENTIFIER_BYTES) -> Column:
    """First candidate within the byte limit (NULL when none fits)."""
    return F.element_at(F.filter(candidates, lambda c: fits(c, max_bytes)), 1)


def capitalised(words: Column) -> Column:
    """``'cold widget'`` → ``'ColdWidget'``."""
    return F.array_join(F.transform(F.split(words, " "),
                                    lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), "")


def assign_names(columns: DataFrame, group_cols: list[str], order_col: str, name_col: str,
                 short: bool = False, max_bytes: int = MAX_IDENTIFIER_BYTES) -> DataFrame:
    """Unique names per group (table): the first candidate not taken earlier.

    Taken names are compared case-insensitively (Spark resolves columns that
    way).  When the first candidates of a group are already distinct, every
    column simply takes its first one (exact, and JVM-only).  Groups with a
    collision need the sequential rule (a choice depends on the choices
    before it); they are resolved with `applyInPandas`, one table's columns
    per group, bounded by the metadata.
    """
    cand = F.filter(abbreviation_candidates(F.col(name_col)), lambda c: fits(c, max_bytes)) if short \
        else abbreviation_candidates(F.col(name_col))
    prepared = columns.withColumn("_cands", cand)
    first = F.lower(F.element_at("_cands", 1))
    w = Window.partitionBy(*group_cols)
    flagged = prepared.withColumn(
        "_clash", (F.size(F.collect_set(first).over(w)) < F.count(F.lit(1)).over(w)) | (F.size("_cands") == 0))
    simple = (flagged.filter(~F.col("_clash")).drop("_clash")
              .withColumn("name_out", F.element_at("_cands", 1)))
    out_schema = T.StructType(list(prepared.schema.fields) + [T.StructField("name_out", T.StringType())])

    def pick(pdf):
        pdf = pdf.sort_values(order_col, kind="stable")
        used: set[str] = set()
        chosen = []
        for cands in pdf["_cands"]:
            pick_one = next((c for c in list(cands) if c.lower() not in used), None)
            if pick_one is None:
                raise ValueError("no free identifier among candidates %r" % (list(cands),))
            used.add(pick_one.lower())
            chosen.append(pick_one)
        pdf = pdf.copy()
        pdf["name_out"] = chosen
        return pdf

    clashing = flagged.filter(F.col("_clash")).drop("_clash")
    resolved = clashing.groupBy(*group_cols).applyInPandas(pick, out_schema)
    return simple.unionByName(resolved).drop("_cands")


def numbered(df: DataFrame, group_cols: list[str], order_cols: list[str], name: str = "n") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group_cols).orderBy(*order_cols)))
