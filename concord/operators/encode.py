"""Canonical row encoding, and digests of rows, blocks and ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical(df: DataFrame, column: str, scale: int | None = None) -> Column:
    """A column as text: equal values, and only those, are equal; null stays null.

    Floats are the shortest text that reads back as the same value, 0 for -0; binary is hex; nested values are JSON.  With `scale`
    floats are rounded to so many decimals where these fit, for comparison with engines that print them otherwise.
    """
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        exact = (c.cast("double") + F.lit(0.0)).cast("string")
        return exact if scale is None else F.coalesce(c.try_cast(T.DecimalType(38, scale)).cast("string"), exact)
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(F.struct(c), {"ignoreNullFields": "false"})
    return c.cast("string")


def encoded_row(df: DataFrame, columns: Sequence[str], scale: int | None = None) -> Column:
    """Values with their length before them, so that neighbours can't run together; ~ for null."""
    parts = []
    for name in columns:
        text = canonical(df, name, scale)
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.concat(*parts)


#: Digests, the fastest first.
DIGESTS = ("xxhash64", "md5", "sha256")


def choose_digest(*sides: Sequence[str]) -> str:
    """The fastest digest that all sides can compute."""
    for d in DIGESTS:
        if all(d in s for s in sides):
            return d
    raise ValueError(f"no digest that all sides can compute: {sides}")


def digest(text: Column, algorithm: str = "md5") -> Column:
    if algorithm == "md5":
        return F.md5(text)
    if algorithm == "sha256":
        return F.sha2(text, 256)
    if algorithm == "xxhash64":
        return F.hex(F.xxhash64(text))
    raise ValueError(f"digest {algorithm!r}: md5, sha256 or xxhash64")


def row_hashes(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row's values.  Null marks stand beside the values, as hashing passes over nulls; -0 equals 0."""
    parts = []
    for name in columns:
        c = F.col(f"`{name}`")
        nested = isinstance(df.schema[name].dataType, (T.ArrayType, T.MapType, T.StructType))
        parts += [c.isNull(), canonical(df, name) if nested else c]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (1, 2)]


def block_of(key: Sequence[str], width: int, blocks: int | None = None) -> Column:
    """The block of a key: its value div `width` for one integer column; else one of `blocks` by a hash of the key."""
    if blocks is None:
        return F.expr(f"`{key[0]}` div {width}")
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in key]), F.lit(blocks))


def block_bytes(df: DataFrame, key: str, column: str, width: int) -> DataFrame:
    """(block, bytes) of a text or binary column."""
    return df.groupBy(block_of([key], width).alias("block")).agg(F.sum(F.octet_length(column)).cast("long").alias("bytes"))


def block_digest(df: DataFrame, key: str, columns: Sequence[str], width: int, algorithm: str = "md5", scale: int | None = None) -> DataFrame:
    """(block, n, bytes, first, last, digest) per block of `width` keys, in key order; a block has at most `width` rows of a unique key, block 0
    with keys on both sides of 0 at most 2 * width - 1."""
    rows = df.select(F.col(key).alias("k"), encoded_row(df, columns, scale).alias("row"))
    rows = rows.select("k", F.expr(f"k div {width}").alias("block"), F.octet_length("row").alias("size"), digest(F.col("row"), algorithm).alias("h"))
    return rows.groupBy("block").agg(
        F.count("*").alias("n"),
        F.sum("size").cast("long").alias("bytes"),
        F.min("k").alias("first"),
        F.max("k").alias("last"),
        digest(F.expr("listagg(h, '') WITHIN GROUP (ORDER BY k)"), algorithm).alias("digest"),
    )


def range_hash(df: DataFrame, key: str, columns: Sequence[str], levels: int = 3, width: int = 1024, algorithm: str = "md5", scale: int | None = None) -> DataFrame:
    """One row (n, digest) of a range: a tree of digests, so that no task ever holds more than `width` of them.

    levels: width ** levels keys are covered by one root; digests of two sides compare if both use the same numbers.
    """
    found = block_digest(df, key, columns, width, algorithm, scale).select("block", "n", "digest")
    for _ in range(levels - 1):
        found = found.groupBy(F.expr(f"block div {width}").alias("up")).agg(F.sum("n").cast("long").alias("n"), digest(F.expr("listagg(digest, '') WITHIN GROUP (ORDER BY block)"), algorithm).alias("digest"))
        found = found.withColumnRenamed("up", "block")
    return found.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"), digest(F.expr("listagg(digest, '') WITHIN GROUP (ORDER BY block)"), algorithm).alias("digest"))
