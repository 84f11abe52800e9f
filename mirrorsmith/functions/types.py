"""Source type → engine type (column expression and Spark schema)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from mirrorsmith.functions.constants import TYPE_DESCRIPTION

# Engine type names (what the mirror column is declared as).
COMPOSITE = "value_any"
SECTION = "section[]"

# FIXED VALUES: primitive source types and the engine type names they map to.
PRIMITIVE_TYPES: list[tuple[str, str]] = [
    ("Edm.Guid", "uuid"),
    ("Edm.Int16", "int2"),
    ("Edm.Int32", "int4"),
    ("Edm.Int64", "int8"),
    ("Edm.Double", "numeric"),
    ("Edm.DateTime", "timestamp"),
    ("Edm.Boolean", "bool"),
    ("Edm.Binary", "bytea"),
]
TEXT = "text"
TYPE_LIST = "varchar[]"

# Default precision for the unbounded numeric of the source; configurable.
NUMERIC_PRECISION = 38
NUMERIC_SCALE = 10
# Places that numbers are read with, so that one with more than the scale is seen.
READ_SCALE = 18
# Places of a column whose source prints doubles: seventeen digits, from 0.01 on.
DOUBLE_SCALE = 18

_ENGINE_TO_SPARK = {
    "uuid": T.StringType(),
    "int2": T.ShortType(),
    "int4": T.IntegerType(),
    "int8": T.LongType(),
    "numeric": T.DecimalType(NUMERIC_PRECISION, NUMERIC_SCALE),
    "timestamp": T.TimestampNTZType(),
    "bool": T.BooleanType(),
    "bytea": T.BinaryType(),
    TEXT: T.StringType(),
    TYPE_LIST: T.ArrayType(T.StringType(), containsNull=False),
    COMPOSITE: T.StructType([T.StructField("value", T.StringType()),
                             T.StructField("type", T.StringType())]),
}


def engine_type(type_src: str, composite: bool = False) -> str:
    """Engine type name of a source type (driver-side, for one description)."""
    if composite:
        return COMPOSITE
    for src, eng in PRIMITIVE_TYPES:
        if type_src == src:
            return eng
    if type_src.startswith("Collection("):
        return SECTION
    if type_src == TYPE_DESCRIPTION:
        return TYPE_LIST
    return TEXT


def engine_type_col(type_src: Column, composite: Column | None = None) -> Column:
    """The same mapping as a column expression over a DataFrame of properties."""
    expr = None
    if composite is not None:
        expr = F.when(composite, F.lit(COMPOSITE))
    for src, eng in PRIMITIVE_TYPES:
        expr = F.when(type_src == src, F.lit(eng)) if expr is None else expr.when(type_src == src, F.lit(eng))
    return (expr.when(type_src.startswith("Collection("), F.lit(SECTION))
            .when(type_src == TYPE_DESCRIPTION, F.lit(TYPE_LIST))
            .otherwise(F.lit(TEXT)))


def spark_type(engine: str) -> T.DataType:
    """Spark type of an engine type (sections are built separately)."""
    return _ENGINE_TO_SPARK[engine]
