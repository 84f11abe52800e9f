"""JSON row → typed columns with the source's empty-value rules (OP-11..16).

All of it is built from `pyspark.sql.functions`, so decoding stays inside
whole-stage code generation; no Python runs per row.

Rules (nullable = the column is not part of the key and not a section line):

* composite field (has a ``<name>_Type`` sibling) → ``struct(value, type)``
* Edm.Guid → lower-cased text; the zero GUID becomes NULL when nullable
* Edm.Int16/32/64, Edm.Double → missing becomes 0
* Edm.DateTime → TIMESTAMP_NTZ rounded to the second; the zero date becomes
  NULL when nullable
* Edm.Boolean → missing becomes false
* Edm.Binary → base64 decoded; '' becomes NULL when nullable
* type description → array of mapped type references, missing → []
* Collection → array of line structs, missing → []
* anything else → text, missing → ''
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from mirrorsmith.functions import types as ty
from mirrorsmith.functions.constants import (ENUM_LOCAL_NAME, ENUM_REF_PREFIX, KINDS,
                                             NULL_TYPE_NAME, SOURCE_PREFIX, UNDEFINED_TYPE,
                                             ZERO_DATETIME, ZERO_GUID)
from mirrorsmith.plans.description import ColumnDesc, SectionDesc, TableDescription

# A malformed object or a number its type cannot hold stops the job; with the
# default mode it would become NULL and then the type's empty value.
FAIL_FAST = {"mode": "FAILFAST"}
GUID_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
TYPE_SUFFIX = "_Type"


# --------------------------------------------------------------------------
# Composite values and type references (OP-13, OP-14, OP-15)
# --------------------------------------------------------------------------

def _primitive_type_name(type_src: Column) -> Column:
    return ty.engine_type_col(type_src)


def composite_type(type_src: Column) -> Column:
    """Type part of a composite value: local kind name for references."""
    rest = F.substr(type_src, F.lit(len(SOURCE_PREFIX) + 1))
    expr = None
    for kind, name in KINDS:
        prefix = kind + "_"
        branch = (rest.startswith(prefix), F.concat(F.lit(name + "."), F.substr(rest, F.lit(len(prefix) + 1))))
        expr = F.when(*branch) if expr is None else expr.when(*branch)
    reference = expr.otherwise(F.concat(F.lit(ENUM_LOCAL_NAME + "."), rest))
    return F.when(type_src.startswith(SOURCE_PREFIX), reference).otherwise(_primitive_type_name(type_src))


def value_any(value: Column, type_src: Column) -> Column:
    """Composite value ``struct(value, type)``; undefined → (NULL, 'null')."""
    undefined = value.isNull() | type_src.isNull() | (type_src == "") | (type_src == UNDEFINED_TYPE)
    return (F.when(undefined, F.struct(F.lit(None).cast("string").alias("value"), F.lit(NULL_TYPE_NAME).alias("type")))
            .otherwise(F.struct(value.cast("string").alias("value"), composite_type(type_src).alias("type"))))


def type_ref(ref: Column) -> Column:
    """``CatalogRef.X`` → ``Справочник.X``, ``EnumRef.X`` → ``Перечисление.X``."""
    expr = None
    for kind, name in KINDS:
        prefix = kind + "Ref."
        branch = (ref.startswith(prefix), F.concat(F.lit(name + "."), F.substr(ref, F.lit(len(prefix) + 1))))
        expr = F.when(*branch) if expr is None else expr.when(*branch)
    return (expr.when(ref.startswith(ENUM_REF_PREFIX),
                      F.concat(F.lit(ENUM_LOCAL_NAME + "."), F.substr(ref, F.lit(len(ENUM_REF_PREFIX) + 1))))
            .otherwise(ref))


def type_list(types: Column) -> Column:
    """Type description array: each element mapped by `type_ref`; missing → []."""
    return F.coalesce(F.transform(types, type_ref), F.array().cast("array<string>"))


# --------------------------------------------------------------------------
# Scalar decoding (OP-12)
# --------------------------------------------------------------------------

def guid(raw: Column, nullable: bool) -> Column:
    s = F.lower(raw)
    checked = F.when(s.isNotNull() & ~s.rlike(GUID_PATTERN),
                     F.raise_error(F.concat(F.lit("invalid GUID: "), s))).otherwise(s)
    return F.when(s == ZERO_GUID, F.lit(None).cast("string")).otherwise(checked) if nullable else checked


def round_to_second(ts: Column) -> Column:
    """TIMESTAMP_NTZ rounded half up to the whole second, without passing
    through the session time zone (``date_trunc`` would)."""
    # the sub-second part does not depend on the zone (offsets are whole seconds)
    micros = F.pmod(F.unix_micros(ts.cast("timestamp")), F.lit(1000000)).cast("int")
    whole = ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (micros / F.lit(1000000)).cast("decimal(18,6)"))
    return (F.when(micros == 0, ts)
            .when(micros >= 500000, whole + F.expr("INTERVAL 1 SECOND"))
            .otherwise(whole))


def datetime(raw: Column, nullable: bool) -> Column:
    parsed = F.to_timestamp_ntz(raw)
    # timestamp(0); the source normally sends whole seconds, so the rounding
    # only runs for texts that carry a fraction
    rounded = F.when(raw.contains("."), round_to_second(parsed)).otherwise(parsed)
    return F.when(raw == ZERO_DATETIME, F.lit(None).cast("timestamp_ntz")).otherwise(rounded) if nullable else rounded


def exact(raw: Column, col: ColumnDesc) -> Column:
    """A number in the mirror's type; one with more decimal places stops the job."""
    value = raw.cast(col.spark_type)
    # compared in the type that was read: the common type of both has fewer places
    return F.when(value.cast(col.read_type) == raw, value).when(raw.isNotNull(), F.raise_error(F.concat(
        F.lit(f"{col.name_src}: more than {col.scale} decimal places: "), raw.cast("string"))).cast(col.spark_type))


def decode_value(raw: Column, col: ColumnDesc, nullable: bool, type_sibling: Column | None = None) -> Column:
    """One typed value from the raw JSON field of ``col``."""
    e = col.engine
    if e == ty.COMPOSITE:
        return value_any(raw, type_sibling)
    if e == "uuid":
        return guid(raw, nullable)
    if e == "timestamp":
        return datetime(raw, nullable)
    if e in ("int2", "int4", "int8"):
        return F.coalesce(raw.cast(col.spark_type), F.lit(0).cast(col.spark_type))
    if e == "numeric":
        return F.coalesce(exact(raw, col), F.lit(0).cast(col.spark_type))
    if e == "bool":
        return F.coalesce(raw.cast("boolean"), F.lit(False))
    if e == "bytea":
        src = F.when(raw == "", F.lit(None).cast("string")).otherwise(raw) if nullable else raw
        return F.unbase64(src)
    if e == ty.TYPE_LIST:
        return type_list(raw.getField("Types"))
    return F.coalesce(raw, F.lit(""))


# --------------------------------------------------------------------------
# Read schema and row decoding (OP-11, OP-22)
# --------------------------------------------------------------------------

def _read_fields(columns: list[ColumnDesc], sections: dict[str, SectionDesc]) -> list[T.StructField]:
    fields: list[T.StructField] = []
    seen: set[str] = set()

    def add(name: str, dtype: T.DataType) -> None:
        if name not in seen:
            seen.add(name)
            fields.append(T.StructField(name, dtype))

    for c in columns:
        if c.engine == ty.COMPOSITE:
            add(c.name_src, T.StringType())
            add(c.name_src + TYPE_SUFFIX, T.StringType())
        elif c.engine == "numeric":
            add(c.name_src, c.read_type)            # exact: never via double
        elif c.engine == ty.SECTION:
            sec = sections[c.name]
            add(c.name_src, T.ArrayType(T.StructType(_read_fields(sec.columns[1:], {}))))
        elif c.engine == ty.TYPE_LIST:
            add(c.name_src, T.StructType([T.StructField("Types", T.ArrayType(T.StringType()))]))
        else:
            add(c.name_src, T.StringType())         # cast from the JSON text
    return fields


def read_schema(desc: TableDescription) -> T.StructType:
    """Schema for `from_json` of one source row (source property names)."""
    return T.StructType(_read_fields(desc.columns, desc.sections))


def _composite_fields(schema: T.DataType) -> set[str]:
    """Names of the composite fields of a read schema, at any depth."""
    if isinstance(schema, T.ArrayType):
        return _composite_fields(schema.elementType)
    if not isinstance(schema, T.StructType):
        return set()
    texts = {f.name for f in schema if f.dataType == T.StringType()}
    return {n for n in texts if n + TYPE_SUFFIX in texts}.union(*[_composite_fields(f.dataType) for f in schema])


def number_text(body: Column, schema: T.DataType) -> Column:
    """JSON text whose numbers in composite fields are quoted, so that parsing
    by ``schema`` keeps their text (`from_json` writes a number read as text
    anew: ``1.50`` would become ``1.5``).

    A quote that no backslash precedes opens or closes a string, and a closing
    one is not followed by a name: what is found is always a property, never
    part of a text.  Numbers with an exponent, and property names that the
    source escapes, are left to Spark's rendering.
    """
    names = sorted(_composite_fields(schema))
    if not names:
        return body
    quoted = "|".join(rf"\Q{n}\E" for n in names)
    return F.regexp_replace(body, rf'(?<!\\)"({quoted})"(\s*:\s*)(-?[0-9]+(?:\.[0-9]+)?)(?![0-9.eE])', '"$1"$2"$3"')


def _sibling(row: Column, c: ColumnDesc) -> Column | None:
    return row.getField(c.name_src + TYPE_SUFFIX) if c.engine == ty.COMPOSITE else None


def _line_builder(sec: SectionDesc, master_value: Column):
    """Lambda for `transform`: one decoded line, column 0 from the master."""
    def line(s: Column) -> Column:
        parts = [master_value.alias(sec.columns[0].name)]
        for lc in sec.columns[1:]:
            parts.append(decode_value(s.getField(lc.name_src), lc, False, _sibling(s, lc)).alias(lc.name))
        return F.struct(*parts)
    return line


def decode_some(row: Column, desc: TableDescription, names: list[str]) -> list[Column]:
    """Decoded expressions of the named (non-section) columns only."""
    key = set(desc.key)
    return [decode_value(row.getField(c.name_src), c, c.name not in key, _sibling(row, c)).alias(c.name)
            for c in desc.columns if c.name in names and c.engine != ty.SECTION]


def _master_field(sec: SectionDesc) -> str:
    return "_master_" + sec.columns[0].name


def decode_row(row: Column, desc: TableDescription, sections: bool = True,
               decoded: set[str] | frozenset = frozenset()) -> list[Column]:
    """Typed mirror columns, in description order, from a parsed source row.

    With ``sections=False`` a section column is returned raw, together with
    its decoded master key (``_master_<name>``), for `decode_sections`.
    Columns named in ``decoded`` are already present and passed through.
    """
    out = []
    key = set(desc.key)
    for c in desc.columns:
        if c.name in decoded:
            out.append(F.col(c.name))
            continue
        if c.engine == ty.SECTION:
            sec = desc.sections[c.name]
            first = sec.columns[0]
            master_value = decode_value(row.getField(first.name_src), first, False, _sibling(row, first))
            if sections:
                out.append(F.coalesce(F.transform(row.getField(c.name_src), _line_builder(sec, master_value)),
                                      F.array().cast(sec.spark_type())).alias(c.name))
            else:
                out.append(row.getField(c.name_src).alias(c.name))
                out.append(master_value.alias(_master_field(sec)))
        else:
            out.append(decode_value(row.getField(c.name_src), c, c.name not in key, _sibling(row, c)).alias(c.name))
    return out


def decode_sections(df: DataFrame, desc: TableDescription, keep: list[str]) -> DataFrame:
    """Second step of `decode_json`: lines decoded, master key taken from the
    already decoded column (evaluated once per row, not once per line)."""
    cols = []
    for c in desc.columns:
        if c.engine == ty.SECTION:
            sec = desc.sections[c.name]
            lines = F.transform(F.col(c.name), _line_builder(sec, F.col(_master_field(sec))))
            cols.append(F.coalesce(lines, F.array().cast(sec.spark_type())).alias(c.name))
        else:
            cols.append(F.col(c.name))
    return df.select(*keep, *cols)


def decode_json(df: DataFrame, json_col: str, desc: TableDescription, keep: list[str] | None = None) -> DataFrame:
    """Parse one JSON object per row and project the typed mirror columns."""
    keep = keep or []
    schema = read_schema(desc)
    parsed = df.select(*keep, F.from_json(number_text(F.col(json_col), schema), schema, FAIL_FAST).alias("_row"))
    if not desc.sections:
        return parsed.select(*keep, *decode_row(F.col("_row"), desc))
    staged = parsed.select(*keep, *decode_row(F.col("_row"), desc, sections=False))
    return decode_sections(staged, desc, keep)
