"""Key ranges (prev, last]: start-exclusive, end-inclusive, either end open where it is None."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.plans.model import TableDef


def compare(key: Sequence[str], op: str, bound: Sequence) -> Column:
    """Lexicographic comparison, expanded to comparisons of single columns, which reach the scan.

    For (a, b) > (x, y): a >= x AND (a > x OR (a = x AND b > y)).  op: >, >=, < or <=.
    """
    if len(bound) != len(key):
        raise ValueError(f"{len(bound)} values for a key of {len(key)} columns")
    strict = op.rstrip("=")
    more = (lambda c, v: c > F.lit(v)) if strict == ">" else (lambda c, v: c < F.lit(v))
    out = None
    for name, value in reversed(list(zip(key, bound))):
        c = F.col(name)
        if out is None:
            out = more(c, value) if op == strict else (more(c, value) | (c == F.lit(value)))
            out = out if op == strict else ((c >= F.lit(value)) if strict == ">" else (c <= F.lit(value)))
        else:
            outer = (c >= F.lit(value)) if strict == ">" else (c <= F.lit(value))
            out = outer & (more(c, value) | ((c == F.lit(value)) & out))
    return out


def key_range(key: Sequence[str], prev: Sequence | None = None, last: Sequence | None = None) -> Column:
    out = F.lit(True)
    if prev is not None:
        out = compare(key, ">", prev)
    if last is not None:
        out = out & compare(key, "<=", last) if prev is not None else compare(key, "<=", last)
    return out


def range_rows(df: DataFrame, table: TableDef, prev=None, last=None, limit: int | None = None) -> DataFrame:
    """The stored columns of the rows in a range, in key order; with `limit` only the first so many."""
    key = list(table.primary_key)
    rows = df.where(key_range(key, prev, last)) if key else df
    rows = rows.orderBy(*key) if key else rows
    rows = rows.limit(limit) if limit is not None else rows
    return rows.select(*table.stored)


def key_bounds(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: first_<column> and last_<column> of the least and the greatest key; nulls for no rows."""
    k = F.struct(*key)
    found = df.agg(F.min(k).alias("first"), F.max(k).alias("last"))
    return found.select(*[F.col(f"{end}.{c}").alias(f"{end}_{c}") for end in ("first", "last") for c in key])


def next_key(df: DataFrame, key: Sequence[str], at: Sequence, prev=None, last=None, default: Sequence | None = None) -> DataFrame:
    """One row: the least key not before `at`, within (prev, last]; `default` (or nulls) if there is none."""
    found = df.where(compare(key, ">=", at) & key_range(key, prev, last)).agg(F.min(F.struct(*key)).alias("k"))
    return found.select(*[F.coalesce(F.col(f"k.{c}"), F.lit(None if default is None else default[i])).alias(c) for i, c in enumerate(key)])


def count_range(df: DataFrame, key: Sequence[str], prev=None, last=None) -> DataFrame:
    return df.where(key_range(key, prev, last)).agg(F.count("*").alias("n"))


def is_subdividable(table: TableDef) -> bool:
    """Ranges are halved only for a key of one integer or UUID column."""
    if len(table.primary_key) != 1:
        return False
    kind = table.column(table.primary_key[0]).type_name
    return kind == "uuid" or kind.startswith("integer")


def midpoint(prev: int | str, last: int | str) -> int | str:
    """Halfway between two keys, rounded towards prev; UUIDs as 128-bit numbers."""
    if isinstance(prev, str):
        a, b = uuid.UUID(prev).int, uuid.UUID(str(last)).int
        return str(uuid.UUID(int=a + (b - a) // 2))
    return prev + (last - prev) // 2


def range_split(df: DataFrame, key: str, parts: int) -> DataFrame:
    """(part, first, last, n): the key span cut into equal widths."""
    low, high = df.agg(F.min(key)).scalar(), df.agg(F.max(key)).scalar()
    width = F.call_function("div", high - low, F.lit(parts)) + 1
    part = F.call_function("div", F.col(key) - low, width).cast("int")
    return df.select(part.alias("part"), key).groupBy("part").agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count("*").alias("n"))


def key_columns(df: DataFrame, table: TableDef) -> DataFrame:
    return df.select(*table.primary_key)


def page(df: DataFrame, key: str | Sequence[str], after: Column | Sequence | None, size: int) -> DataFrame:
    """The first `size` rows after a key (None: from the first on), in key order; for a key of one column `after` may be a scalar subquery."""
    names = [key] if isinstance(key, str) else list(key)
    if after is not None:
        df = df.where(F.col(key) > after if isinstance(key, str) else compare(names, ">", after))
    return df.orderBy(*names).limit(size)


def pages(df: DataFrame, key: Sequence[str], size: int) -> Iterator[DataFrame]:
    """All pages, one after the other, each from the last key of the one before it: a row of it comes to the driver."""
    after = None
    while True:
        found = page(df, key, after, size)
        last = key_bounds(found, key).first()[len(key) :]
        if None in last:
            return
        yield found
        after = last
