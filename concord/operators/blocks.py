"""Blocks of keys that keep the order of the keys, whatever their types, so that some blocks are ranges that reach a scan."""

from __future__ import annotations

import json
import math
from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.operators.encode import block_of
from concord.operators.ranges import key_range

#: Ranges that keys other than one integer are parted into, at most, and keys of the sample for each: what the driver holds.
MOST_RANGES, SAMPLED = 4_096, 20
#: Ranges that become a predicate; where more apart are wanted, the one from the first to the last is.
MOST_PREDICATES = 64


def textual(df: DataFrame, name: str) -> bool:
    """Whether a column of a key reads back from its text."""
    return isinstance(df.schema[name].dataType, (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))


@dataclass(frozen=True)
class KeyBlocks:
    """width: keys of a block, of a key of one integer column.  Else ranges (prev, last] end at `bounds`, rows of texts, and each is cut
    into `parts` blocks by a hash of the key.  kinds: the types of the key's columns."""

    key: tuple[str, ...]
    kinds: tuple[str, ...]
    width: int
    bounds: tuple[tuple[str, ...], ...] = ()
    parts: int = 1

    @property
    def by_value(self) -> bool:
        return len(self.key) == 1 and self.kinds[0] in ("tinyint", "smallint", "int", "bigint")

    def of(self) -> Column:
        """The block of a row."""
        if self.by_value:
            return block_of(self.key, self.width)
        part = F.pmod(F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in self.key]), F.lit(self.parts))
        return self.range_of().cast("long") * self.parts + part

    def range_of(self) -> Column:
        """How many bounds are below a key, by binary search.  The bounds are one constant: made in the plan, once, and not for each row."""
        if not self.bounds:
            return F.lit(0)
        fields = [f"k{i}" for i in range(len(self.kinds))]
        texts = json.dumps([dict(zip(fields, b)) for b in self.bounds])
        typed = lambda kinds: f"array<struct<{', '.join(f'{f}: {k}' for f, k in zip(fields, kinds))}>>"
        bounds = F.from_json(F.lit(texts), typed(["string"] * len(fields))).cast(typed(self.kinds))
        own = F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(self.key)])
        steps = F.sequence(F.lit(1), F.lit(math.ceil(math.log2(len(self.bounds) + 1))))

        def halve(s: Column, _: Column) -> Column:
            middle = F.shiftright(s["low"] + s["high"], 1)
            above = F.get(bounds, middle) < own
            after, before = F.struct((middle + 1).alias("low"), s["high"].alias("high")), F.struct(s["low"].alias("low"), middle.alias("high"))
            return F.when(s["low"] >= s["high"], s).when(above, after).otherwise(before)

        return F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.lit(len(self.bounds)).alias("high")), halve)["low"]

    def bound(self, i: int) -> list[Column] | None:
        return [F.lit(v).cast(k) for v, k in zip(self.bounds[i], self.kinds)] if 0 <= i < len(self.bounds) else None

    def predicate(self, blocks: Collection[int]) -> Column:
        """What rows of some blocks, none of them or more, meet: ranges of the key, which reach the scan, and the blocks themselves."""
        inside = self.of().isin(list(blocks))
        if self.by_value:
            return key_span(self.key[0], self.width, min(blocks), max(blocks)) & inside
        runs: list[list[int]] = []
        for r in sorted({b // self.parts for b in blocks}):
            if runs and runs[-1][1] + 1 == r:
                runs[-1][1] = r
            else:
                runs.append([r, r])
        if len(runs) > MOST_PREDICATES:
            runs = [[runs[0][0], runs[-1][1]]]
        ranges = None
        for first, last in runs:
            one = key_range(self.key, self.bound(first - 1), self.bound(last))
            ranges = one if ranges is None else ranges | one
        return ranges & inside


def key_span(key: str, width: int, first: int, last: int) -> Column:
    """The keys of the blocks `first` to `last`; as div rounds towards 0, block 0 has keys on both sides of it."""
    low = first * width if first > 0 else (first - 1) * width + 1
    high = (last + 1) * width - 1 if last >= 0 else last * width
    return F.col(key).between(low, high)


def key_blocks(df: DataFrame, key: Sequence[str], width: int) -> KeyBlocks:
    """Blocks of about `width` rows of df.  Bounds are quantiles of a sample of the keys, by hash, of SAMPLED for each of MOST_RANGES ranges at
    most; where these are longer than `width` rows, they are cut by hash."""
    kinds = tuple(df.schema[c].dataType.simpleString() for c in key)
    plain = KeyBlocks(tuple(key), kinds, width)
    if plain.by_value:
        return plain
    n = df.count()
    blocks = max(1, n // width)
    if not all(textual(df, c) for c in key):
        return KeyBlocks(tuple(key), kinds, width, parts=blocks)
    ranges = min(MOST_RANGES, blocks)
    share = min(1.0, ranges * SAMPLED / max(n, 1))
    sampled = df.where(F.pmod(F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in key], F.lit(7)), F.lit(1_000_000)) < share * 1_000_000)
    found = [tuple(r) for r in sampled.select(*key).distinct().orderBy(*key).select(*[F.col(f"`{c}`").cast("string") for c in key]).toLocalIterator()]
    step = len(found) / ranges
    bounds = tuple(dict.fromkeys(found[int(i * step)] for i in range(1, ranges))) if step >= 1 else tuple(found[1:])
    bounds = tuple(b for b in bounds if None not in b)
    return KeyBlocks(tuple(key), kinds, width, bounds, max(1, math.ceil(blocks / (len(bounds) + 1))))
