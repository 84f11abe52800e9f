"""Resolved description of one mirrored table.

A description is the small driver-side result of the catalog jobs in
`mirrorsmith.plans.catalog` (one row per column, a few hundred at most).  It
is what a Spark user turns into a schema and a `select` list.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

from mirrorsmith.functions import types as ty


@dataclass(frozen=True)
class ColumnDesc:
    name_src: str          # property name in the source
    type_src: str          # source type, e.g. Edm.Guid
    name: str              # mirror column name
    engine: str            # engine type name, see functions.types
    scale: int = ty.NUMERIC_SCALE   # decimal places of a numeric column

    @property
    def spark_type(self) -> T.DataType:
        return T.DecimalType(ty.NUMERIC_PRECISION, self.scale) if self.engine == "numeric" else ty.spark_type(self.engine)

    @property
    def read_type(self) -> T.DecimalType:
        """What a numeric column is read as: more places than it keeps."""
        return T.DecimalType(ty.NUMERIC_PRECISION, max(ty.READ_SCALE, self.scale + 2))


@dataclass
class SectionDesc:
    name_src: str                  # the Collection property of the master
    view: str                      # name of the detail view
    columns: list[ColumnDesc]      # column 0 is always taken from the master row

    def spark_type(self) -> T.ArrayType:
        fields = [T.StructField(c.name, c.spark_type, nullable=True) for c in self.columns]
        return T.ArrayType(T.StructType(fields), containsNull=False)


@dataclass
class TableDescription:
    table: str                             # e.g. Документ.Заказ
    kind: str                              # e.g. Document
    entity: str                            # source entity name (used in URLs)
    columns: list[ColumnDesc]
    key: list[str]                         # mirror column names, in key order
    sort: list[str] = field(default_factory=list)   # source names for $orderby
    version: str | None = None             # mirror name of the version column
    sections: dict[str, SectionDesc] = field(default_factory=dict)  # by column name
    view: str | None = None                # name of the view within its kind, if not the object's own

    def column(self, name: str) -> ColumnDesc:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def with_scale(self, scale: int) -> TableDescription:
        """The same table with so many decimal places in its numeric columns, of its sections too."""
        scaled = lambda columns: [replace(c, scale=scale) for c in columns]
        return replace(self, columns=scaled(self.columns), sections={k: replace(s, columns=scaled(s.columns)) for k, s in self.sections.items()})

    @property
    def value_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.name not in self.key]

    def spark_schema(self) -> T.StructType:
        fields = []
        for c in self.columns:
            if c.engine == ty.SECTION:
                fields.append(T.StructField(c.name, self.sections[c.name].spark_type()))
            else:
                fields.append(T.StructField(c.name, c.spark_type, nullable=c.name not in self.key))
        return T.StructType(fields)
