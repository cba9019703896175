"""Tables as the reconciliation engine sees them: columns with portable types, keys, and their JSON form."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields
from enum import Enum

from pyspark.sql import types as T

#: Portable type name -> Spark type.
SPARK_TYPES = {
    "binary": T.BinaryType(),
    "binary.varbinary": T.BinaryType(),
    "binary.fixed": T.BinaryType(),
    "text": T.StringType(),
    "text.varchar": T.StringType(),
    "text.fixed": T.StringType(),
    "json": T.StringType(),
    "json.binary": T.StringType(),
    "uuid": T.StringType(),
    "date": T.DateType(),
    "time": T.StringType(),
    "time.tz": T.StringType(),
    "datetime": T.TimestampNTZType(),
    "datetime.tz": T.TimestampType(),
    "datetime.mysqltimestamp": T.TimestampType(),
    "spatial": T.BinaryType(),
    "spatial.geography": T.BinaryType(),
    "enum": T.StringType(),
    "boolean": T.BooleanType(),
    "integer.8bit": T.ByteType(),
    "integer.16bit": T.ShortType(),
    "integer.24bit": T.IntegerType(),
    "integer": T.IntegerType(),
    "integer.64bit": T.LongType(),
    "integer.unsigned.8bit": T.ShortType(),
    "integer.unsigned.16bit": T.IntegerType(),
    "integer.unsigned.24bit": T.IntegerType(),
    "integer.unsigned": T.LongType(),
    "integer.unsigned.64bit": T.DecimalType(20, 0),
    "decimal": T.DecimalType(38, 18),
    "float": T.DoubleType(),
    "float.32bit": T.FloatType(),
    "mysql_specific": T.StringType(),
    "postgresql_specific": T.StringType(),
    "unknown": T.StringType(),
}


class Default(str, Enum):
    NONE = "none"
    VALUE = "value"
    EXPRESSION = "expression"
    SEQUENCE = "sequence"
    IDENTITY_ALWAYS = "identity always"
    IDENTITY_BY_DEFAULT = "identity by default"
    GENERATED_STORED = "generated stored"
    GENERATED_VIRTUAL = "generated virtual"


@dataclass(frozen=True)
class ColumnDef:
    name: str
    type_name: str
    nullable: bool = True
    size: int = 0
    scale: int = 0
    default_kind: Default = Default.NONE
    default_value: str = ""
    auto_update: bool = False
    subtype: str = ""
    srid: int = 0
    enum_values: tuple[str, ...] = ()

    @property
    def generated(self) -> bool:
        return self.default_kind in (Default.GENERATED_STORED, Default.GENERATED_VIRTUAL)

    @property
    def spark_type(self) -> T.DataType:
        if self.type_name == "decimal":
            return T.DecimalType(self.size, self.scale) if self.size else T.DecimalType(38, 18)
        return SPARK_TYPES[self.type_name]


class KeyKind(str, Enum):
    UNIQUE = "unique"
    STANDARD = "standard"
    SPATIAL = "spatial"


@dataclass(frozen=True, order=True)
class KeyDef:
    name: str
    kind: KeyKind = KeyKind.STANDARD
    columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class TableDef:
    name: str
    columns: tuple[ColumnDef, ...] = ()
    primary_key: tuple[str, ...] = ()
    keys: tuple[KeyDef, ...] = ()
    schema: str = ""

    @property
    def id(self) -> str:
        """schema.name with dots and backslashes escaped; the bare name in the default schema."""
        escape = lambda s: s.replace("\\", "\\\\").replace(".", "\\.")
        return f"{escape(self.schema)}.{escape(self.name)}" if self.schema else escape(self.name)

    def column(self, name: str) -> ColumnDef:
        return next(c for c in self.columns if c.name == name)

    @property
    def stored(self) -> list[str]:
        return [c.name for c in self.columns if not c.generated]


@dataclass(frozen=True)
class DatabaseDef:
    tables: tuple[TableDef, ...] = ()
    errors: tuple[str, ...] = field(default=())

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> DatabaseDef:
        """Attributes that this version does not know are ignored."""

        def build(kind, given: dict, /, **nested):
            known = {f.name for f in fields(kind)}
            values = {k: tuple(v) if isinstance(v, list) else v for k, v in given.items() if k in known}
            return kind(**{**values, **nested})

        given = json.loads(text)
        tables = []
        for t in given.get("tables", ()):
            columns = tuple(build(ColumnDef, c, default_kind=Default(c.get("default_kind", "none"))) for c in t.get("columns", ()))
            keys = tuple(build(KeyDef, k, kind=KeyKind(k.get("kind", "standard"))) for k in t.get("keys", ()))
            tables.append(build(TableDef, t, columns=columns, keys=keys))
        return DatabaseDef(tuple(tables), tuple(given.get("errors", ())))


def table_of(df, name: str, primary_key: tuple[str, ...] = (), keys: tuple[KeyDef, ...] = ()) -> TableDef:
    """A definition for a DataFrame; keys can't be read from files and must be declared."""
    simple = {
        T.StringType: "text", T.BinaryType: "binary", T.DateType: "date", T.TimestampNTZType: "datetime", T.TimestampType: "datetime.tz", T.BooleanType: "boolean",
        T.ByteType: "integer.8bit", T.ShortType: "integer.16bit", T.IntegerType: "integer", T.LongType: "integer.64bit", T.FloatType: "float.32bit", T.DoubleType: "float",
    }
    columns = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            columns.append(ColumnDef(f.name, "decimal", f.name not in primary_key, f.dataType.precision, f.dataType.scale))
        else:
            columns.append(ColumnDef(f.name, simple.get(type(f.dataType), "unknown"), f.name not in primary_key))
    return TableDef(name, tuple(columns), tuple(primary_key), tuple(keys))
