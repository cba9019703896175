"""Scalar helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim_fractional_zeros(c: Column) -> Column:
    """12:00:00.500 -> 12:00:00.5, 12:00:00.000 -> 12:00:00; texts without a fraction stay."""
    return F.when(c.contains("."), F.regexp_replace(c, r"\.?0+$", "")).otherwise(c)


def quote_identifier(c: Column, quote: str = '"') -> Column:
    return F.concat(F.lit(quote), F.replace(c, F.lit(quote), F.lit(quote * 2)), F.lit(quote))


def parse_enum_list(c: Column) -> Column:
    """enum('a','it''s') -> [a, it's]"""
    return F.transform(F.regexp_extract_all(c, F.lit(r"'((?:[^']|'')*)'"), F.lit(1)), lambda x: F.replace(x, F.lit("''"), F.lit("'")))


def type_length(c: Column) -> Column:
    """varchar(10) -> 10, decimal(9,3) -> 9; null without one."""
    return F.nullif(F.regexp_extract(c, r"\((\d+)", 1), F.lit("")).cast("int")


def type_scale(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r",\s*(\d+)\)", 1), F.lit("")).cast("int")


def spatial_subtype(c: Column) -> Column:
    """geometry(Point,4326) -> point; empty without one."""
    return F.lower(F.regexp_extract(c, r"\(\s*([A-Za-z]+)", 1))


def spatial_srid(c: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(c, r",\s*(\d+)\s*\)", 1), F.lit("")).cast("int"), F.lit(0))


def decode_boolean(c: Column) -> Column:
    """1, t and true are true, 0, f and false are false, all else null."""
    v = F.lower(c)
    return F.when(v.isin("1", "t", "true"), True).when(v.isin("0", "f", "false"), False)


def hex_decode(c: Column) -> Column:
    return F.unhex(c)


def enum_type_name(values: Column) -> Column:
    """A name for an enum type that depends on its values alone."""
    return F.concat(F.lit("enum_"), F.left(F.sha2(F.array_join(values, ","), 256), F.lit(8)))
