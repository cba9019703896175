"""Type spellings of SQL dialects and the portable types they stand for."""

from __future__ import annotations

import re
from dataclasses import replace

from concord.plans.model import SPARK_TYPES, ColumnDef, DatabaseDef, TableDef
from concord.plans.schema_diff import dedupe_names

#: Portable types without a form in a dialect, and what stands in for them there.
FALLBACKS = {
    "mysql": {
        "json.binary": "json",
        "time.tz": "time",
        "datetime.tz": "datetime",
    },
    "postgresql": {
        "binary.varbinary": "binary",
        "binary.fixed": "binary",
        "datetime.mysqltimestamp": "datetime",
        "integer.8bit": "integer.16bit",
        "integer.24bit": "integer",
        "integer.unsigned.8bit": "integer.16bit",
        "integer.unsigned.16bit": "integer.16bit",
        "integer.unsigned.24bit": "integer",
        "integer.unsigned": "integer",
        "integer.unsigned.64bit": "integer.64bit",
    },
    "derby": {
        "json": "text",
        "json.binary": "json",
        "time.tz": "time",
        "datetime.tz": "datetime",
        "datetime.mysqltimestamp": "datetime",
        "spatial": "binary",
        "spatial.geography": "spatial",
        "enum": "text.varchar",
        "uuid": "text.fixed",
        "binary.fixed": "binary.varbinary",
        "integer.8bit": "integer.16bit",
        "integer.24bit": "integer",
        "integer.unsigned.8bit": "integer.16bit",
        "integer.unsigned.16bit": "integer",
        "integer.unsigned.24bit": "integer",
        "integer.unsigned": "integer.64bit",
        "integer.unsigned.64bit": "decimal",
        "float.32bit": "float",
    },
}
#: The longest names.
NAME_LIMITS = {"mysql": 64, "postgresql": 63, "derby": 128}
#: Sizes of MySQL's text and blob types, and what types are called there.
MYSQL_SIZES = {"tiny": 255, "": 65535, "medium": 16777215, "long": 0}
MYSQL_INTEGERS = {"tinyint": ".8bit", "smallint": ".16bit", "mediumint": ".24bit", "int": "", "bigint": ".64bit"}
#: What types without a size are called.
POSTGRESQL_TYPES = {
    "bytea": "binary", "text": "text", "json": "json", "jsonb": "json.binary", "uuid": "uuid", "date": "date", "boolean": "boolean", "smallint": "integer.16bit", "integer": "integer",
    "bigint": "integer.64bit", "real": "float.32bit", "double precision": "float",
}


def supported_types(dialect: str) -> list[str]:
    other = {"mysql": ("postgresql_specific",), "postgresql": ("mysql_specific",), "derby": ("mysql_specific", "postgresql_specific")}[dialect]
    return [t for t in SPARK_TYPES if t not in FALLBACKS[dialect] and t not in other]


def negotiate(type_name: str, accepted: list[str], dialect: str) -> str:
    """The first of a type and its stand-ins that the other side accepts, else unknown."""
    while type_name not in accepted:
        if type_name not in FALLBACKS[dialect]:
            return "unknown"
        type_name = FALLBACKS[dialect][type_name]
    return type_name


def parse_mysql(name: str, spelling: str, nullable: bool = True) -> ColumnDef:
    s = spelling.strip().lower()
    size, scale = (int(x or 0) for x in (re.search(r"\((\d+)(?:,\s*(\d+))?\)", s) or re.match("()()", "")).groups())
    base = re.split(r"[( ]", s)[0]
    make = lambda kind, **more: ColumnDef(name, kind, nullable, **more)
    if s == "tinyint(1)":
        return make("boolean")
    if base in MYSQL_INTEGERS:
        return make(("integer.unsigned" if "unsigned" in s else "integer") + MYSQL_INTEGERS[base])
    if m := re.fullmatch(r"(tiny|medium|long|)(text|blob)", base):
        return make("text" if m[2] == "text" else "binary", size=MYSQL_SIZES[m[1]])
    if base == "enum":
        return make("enum", enum_values=tuple(x.replace("''", "'") for x in re.findall(r"'((?:[^']|'')*)'", spelling)))
    sized = {"varchar": "text.varchar", "char": "text.fixed", "varbinary": "binary.varbinary", "binary": "binary.fixed", "time": "time", "datetime": "datetime", "timestamp": "datetime.mysqltimestamp"}
    if base in sized:
        return make(sized[base], size=size)
    if base in ("decimal", "float", "double"):
        return make({"decimal": "decimal", "float": "float.32bit", "double": "float"}[base], size=size or (10 if base == "decimal" else 0), scale=scale)
    if base in ("json", "date"):
        return make(base)
    if base in ("geometry", "point", "linestring", "polygon", "multipoint", "multilinestring", "multipolygon", "geometrycollection"):
        return make("spatial", subtype="" if base == "geometry" else base)
    return make("mysql_specific", subtype=spelling)


def parse_postgresql(name: str, spelling: str, nullable: bool = True, enums: dict[str, tuple[str, ...]] | None = None) -> ColumnDef:
    s = spelling.strip().lower()
    size, scale = (int(x or 0) for x in (re.search(r"\((\d+)(?:,\s*(\d+))?\)", s) or re.match("()()", "")).groups())
    make = lambda kind, **more: ColumnDef(name, kind, nullable, **more)
    if s in POSTGRESQL_TYPES:
        return make(POSTGRESQL_TYPES[s])
    if s.startswith(("character varying", "varchar")):
        return make("text.varchar", size=size)
    if s.startswith(("character", "char(")):
        return make("text.fixed", size=size or 1)
    if s.startswith("numeric"):
        return make("decimal", size=size, scale=scale)
    if m := re.fullmatch(r"(time|timestamp)(?:\(\d\))? (with|without) time zone", s):
        return make({"time": "time", "timestamp": "datetime"}[m[1]] + (".tz" if m[2] == "with" else ""), size=6 if "(" not in s else size)
    if m := re.fullmatch(r"(geometry|geography)(?:\(\s*(\w+)\s*(?:,\s*(\d+)\s*)?\))?", s):
        return make("spatial" if m[1] == "geometry" else "spatial.geography", subtype=m[2] or "", srid=int(m[3] or (4326 if m[1] == "geography" else 0)))
    if enums and s in enums:
        return make("enum", enum_values=enums[s], subtype=s)
    return make("postgresql_specific", subtype=spelling)


def derby_sizes(was: ColumnDef, c: ColumnDef) -> ColumnDef:
    """Sizes of types that others have none for, or name otherwise; none where Derby has none."""
    if was.type_name == "enum":
        return replace(c, size=max([1, *map(len, was.enum_values)]), enum_values=(), subtype="")
    if was.type_name == "uuid":
        return replace(c, size=36)
    if was.type_name == "integer.unsigned.64bit":
        return replace(c, size=20, scale=0)
    if c.type_name == "text.varchar" and not c.size:
        return replace(c, type_name="text")
    if c.type_name == "decimal":
        return replace(c, size=min(c.size or 31, 31))
    sized = c.type_name in ("text.varchar", "text.fixed", "binary.varbinary")
    return c if sized else replace(c, size=0, scale=0)


def adapt_schema(database: DatabaseDef, dialect: str) -> DatabaseDef:
    """Definitions in the types and names a dialect can hold."""
    accepted = supported_types(dialect)
    if dialect == "mysql" and len({t.name for t in database.tables}) < len(database.tables):
        raise ValueError("the same table name is in two schemas, and MySQL has no schemas")

    def column(c: ColumnDef) -> ColumnDef:
        kind = negotiate(c.type_name, accepted, dialect)
        sized = kind != "unknown" and not (dialect == "postgresql" and kind in ("text", "binary", "float", "float.32bit"))
        was, c = c, replace(c, type_name=kind, size=c.size if sized else 0, scale=c.scale if sized else 0)
        if dialect == "derby":
            c = derby_sizes(was, c)
        if dialect == "mysql" and kind == "decimal" and not c.size:
            c = replace(c, size=10)
        if dialect == "mysql" and kind == "text.varchar" and not c.size:
            c = replace(c, type_name="text")
        return c

    def table(t: TableDef) -> TableDef:
        names = dedupe_names([k.name for k in t.keys], NAME_LIMITS[dialect])
        return replace(t, schema="" if dialect == "mysql" else t.schema, columns=tuple(map(column, t.columns)), keys=tuple(replace(k, name=n) for k, n in zip(t.keys, names)))

    return replace(database, tables=tuple(map(table, database.tables)))
