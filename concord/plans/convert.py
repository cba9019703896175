"""Rows between two definitions of a table, of one dialect or of two.

Each column has a pair of expressions for a database: what its rows mean (shown) and how it takes them (spelt).  Between them a value has
one form whatever database it is from: text without padding, EWKB for geometries, times of day as text without trailing zeros.
A conversion then is a cast from the type of one definition to that of the other; values that don't fit are errors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.functions.scalars import decode_boolean, trim_fractional_zeros
from concord.functions.spatial import from_ewkb, to_ewkb
from concord.plans.dialects import adapt_schema
from concord.plans.model import ColumnDef, DatabaseDef, TableDef

#: A day that times of day are given where a database is sent them as timestamps.
DAY = "1970-01-01"


def shown(c: Column, kind: T.DataType, column: ColumnDef, dialect: str) -> Column:
    """What a column as a database's reader gives it means."""
    if column.type_name in ("time", "time.tz") and isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return trim_fractional_zeros(F.date_format(c, "HH:mm:ss.SSSSSS"))
    if column.type_name == "text.fixed" and isinstance(kind, T.StringType):
        return F.rtrim(c)
    if column.type_name.startswith("spatial") and dialect == "mysql" and isinstance(kind, T.BinaryType):
        return to_ewkb(c)
    if column.type_name == "uuid" and isinstance(kind, T.StringType):
        return F.lower(F.rtrim(c))
    if column.type_name == "boolean" and not isinstance(kind, T.BooleanType):
        return decode_boolean(c.cast("string"))
    return c if kind == column.spark_type else c.cast(column.spark_type)


def spelt(c: Column, column: ColumnDef, dialect: str) -> Column:
    """What a database's writer is given."""
    if column.type_name in ("time", "time.tz"):
        return F.to_timestamp_ntz(F.concat(F.lit(f"{DAY} "), c))
    if column.type_name.startswith("spatial") and dialect == "mysql":
        return from_ewkb(c)
    return c


def converted(c: Column, source: ColumnDef, target: ColumnDef) -> Column:
    """A value of one definition as one of the other."""
    if source.spark_type == target.spark_type:
        return c
    if target.type_name == "boolean":
        return decode_boolean(c.cast("string"))
    return c.cast(target.spark_type)


def show(df: DataFrame, table: TableDef, dialect: str) -> DataFrame:
    """Rows as a database's reader gives them, in the form they have between databases."""
    known = {c.name: c for c in table.columns}
    new = {f.name: shown(F.col(f"`{f.name}`"), f.dataType, known[f.name], dialect) for f in df.schema.fields if f.name in known}
    return df.withColumns({n: c for n, c in new.items() if str(c) != str(F.col(f"`{n}`"))}) if new else df


def spell(df: DataFrame, columns: Sequence[ColumnDef], dialect: str) -> DataFrame:
    """Rows as a database's writer takes them."""
    new = {c.name: spelt(F.col(f"`{c.name}`"), c, dialect) for c in columns if c.name in df.columns}
    return df.withColumns({n: c for n, c in new.items() if str(c) != str(F.col(f"`{n}`"))}) if new else df


def convert(df: DataFrame, source: TableDef, target: TableDef) -> DataFrame:
    """Rows of one definition as rows of the other; columns that only one has stay as they are."""
    to = {c.name: c for c in target.columns}
    changed = {c.name: converted(F.col(f"`{c.name}`"), c, to[c.name]) for c in source.columns if c.name in to and c.name in df.columns and c.spark_type != to[c.name].spark_type}
    return df.withColumns(changed) if changed else df


def adapted(tables: Sequence[TableDef], dialect: str) -> dict[str, TableDef]:
    """Definitions as a database of the dialect can hold them."""
    return {t.name: t for t in adapt_schema(DatabaseDef(tuple(tables)), dialect).tables}


def same_in(dialect: str, stored: TableDef, found: TableDef) -> bool:
    """Whether a stored definition, of whatever dialect, is what a database of the dialect shows as `found`."""
    return plain(adapted([stored], dialect)[stored.name]) == plain(found)


def plain(table: TableDef) -> TableDef:
    """Without what catalogs tell otherwise than definitions: how identities are made, sizes of types that have none."""
    columns = tuple(replace(c, default_kind=c.default_kind, enum_values=(), subtype="", srid=0) for c in table.columns)
    return replace(table, columns=columns, schema="")
