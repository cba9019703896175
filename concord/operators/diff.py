"""What must change in a target to make it equal a source."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from concord.operators.blocks import KeyBlocks, key_blocks, key_span  # noqa: F401
from concord.operators.encode import block_of, row_hashes
from concord.operators.ranges import compare, key_bounds


def same(columns: Sequence[str], left: str = "s", right: str = "t") -> Column:
    """All columns equal, null equalling null."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def diff(source: DataFrame, target: DataFrame, key: Sequence[str], unchanged: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """(key, action, other source columns): insert, replace or delete, and with `unchanged` also keep.

    Keys must be unique and free of nulls on both sides; columns are matched by name and compared null-safely.
    One full outer sort-merge join on the key; a delete has null source columns.  carry: columns that either side or both have besides
    and that are not compared; they come as they are for the source's and with t_ before their name for the target's.
    """
    rest = [c for c in source.columns if c not in key and c not in carry]
    s, t = source.withColumn("_s", F.lit(True)).alias("s"), target.withColumn("_t", F.lit(True)).alias("t")
    on = [F.col(f"s.{c}") == F.col(f"t.{c}") for c in key]
    action = F.when(F.col("_t").isNull(), "insert").when(F.col("_s").isNull(), "delete").when(same(rest), "keep").otherwise("replace")
    joined = s.join(t, on, "full_outer").select(
        *[F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c) for c in key], action.alias("action"), *[F.col(f"s.{c}").alias(c) for c in rest],
        *[F.col(f"s.{c}").alias(c) for c in carry if c in source.columns], *[F.col(f"t.{c}").alias(f"t_{c}") for c in carry if c in target.columns],
    )
    return joined if unchanged else joined.where("action <> 'keep'")


def inserts(source: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    return source.join(target.select(*key), list(key), "left_anti").select(*source.columns)


def deletes(source: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    return inserts(target, source, key).select(*key)


def matched(source: DataFrame, target: DataFrame, key: Sequence[str], equal: bool) -> DataFrame:
    """Source rows whose key is in the target, with all other columns equal, or not."""
    rest = [c for c in source.columns if c not in key]
    joined = source.alias("s").join(target.alias("t"), [F.col(f"s.{c}") == F.col(f"t.{c}") for c in key])
    return joined.where(same(rest) if equal else ~same(rest)).select("s.*")


def counting(changes: DataFrame) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The changes, and their number by action once they have been written: they are counted in the same pass."""
    seen = Observation()
    counts = [F.count(F.when(F.col("action") == a, 1)).alias(a) for a in ("insert", "replace", "delete")]
    return changes.observe(seen, *counts), lambda: {a: n for a, n in seen.get.items() if n}


def summary(changes: DataFrame) -> DataFrame:
    """(action, n): all deletes count, wherever in the key range they are."""
    return changes.groupBy("action").agg(F.count("*").alias("n"))


def tail_inserts(source: DataFrame, target: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Source rows after the target's last key: they need no comparison.  A key of several columns is looked up at once."""
    if not isinstance(key, str):
        last = key_bounds(target, key).first()[len(key) :]
        return source if None in last else source.where(compare(key, ">", last))
    last = target.agg(F.max(key)).scalar()
    return source.where(last.isNull() | (F.col(key) > last))


def out_of_range(source: DataFrame, target: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Target keys before the source's first or after its last; all of them if the source is empty.  A key of several columns is looked up at once."""
    if not isinstance(key, str):
        found = key_bounds(source, key).first()
        first, last = found[: len(key)], found[len(key) :]
        return target.select(*key) if None in last else target.select(*key).where(compare(key, "<", first) | compare(key, ">", last))
    first, last = source.agg(F.min(key)).scalar(), source.agg(F.max(key)).scalar()
    return target.select(key).where(first.isNull() | (F.col(key) < first) | (F.col(key) > last))


# -- blocks --------------------------------------------------------------------------------------


def block_compare(source: DataFrame, target: DataFrame, key: str | Sequence[str], columns: Sequence[str], width: int, block: Column | None = None) -> DataFrame:
    """(block, source_n, target_n) of the blocks whose rows differ, a count being null for a side without rows.

    Equal rows of both sides cancel out in an exclusive or of their hashes, which needs no order: one row a block and task is
    shuffled, once for both sides.  Rows of one side can't cancel out, as their keys are unique.
    """
    block = key_blocks(source, [key] if isinstance(key, str) else list(key), width).of() if block is None else block
    one = lambda df, s, t: df.select(block.alias("block"), *[h.alias(n) for h, n in zip(row_hashes(df, columns), "ab")], F.lit(s).alias("s"), F.lit(t).alias("t"))
    sums = one(source, 1, 0).unionAll(one(target, 0, 1)).groupBy("block").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("s").alias("s"), F.sum("t").alias("t"))
    return sums.where("a <> 0 OR b <> 0 OR s <> t").select("block", F.nullif("s", F.lit(0)).alias("source_n"), F.nullif("t", F.lit(0)).alias("target_n"))


#: Differing blocks that become part of the scans' predicates, and those that are broadcast as a list of numbers; more are joined.
LITERAL_BLOCKS, BROADCAST_BLOCKS = 1_000, 1_000_000


def pruned_diff(source: DataFrame, target: DataFrame, key: str | Sequence[str], columns: Sequence[str], width: int, exact: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """diff() over the blocks that differ; `exact` compares everything.

    Blocks keep the order of the key, whatever its types.  They are compared at once, so that a few that differ can become
    predicates, key ranges among them which reach the scans; more are broadcast after their number is checked, and very many are
    joined.
    """
    key = [key] if isinstance(key, str) else list(key)
    if exact:
        return diff(source, target, key, carry=carry)
    blocks = key_blocks(source, key, width)
    return diff_within(source, target, blocks, block_compare(source, target, key, columns, width, blocks.of()), carry)


def diff_within(source: DataFrame, target: DataFrame, blocks: KeyBlocks, differing: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """diff() of the rows of some blocks (block, ..).  Their numbers come to the driver once, BROADCAST_BLOCKS at most; only if there are
    more is the comparison computed again, as a side of the joins."""
    key, wanted = list(blocks.key), differing.select(F.col("block").cast("long").alias("_block"))
    few = wanted.limit(BROADCAST_BLOCKS + 1).toPandas()["_block"].tolist()
    if not few:
        return diff(source.where(F.lit(False)), target.where(F.lit(False)), key, carry=carry)
    if len(few) <= LITERAL_BLOCKS:
        inside = blocks.predicate(few)
        return diff(source.where(inside), target.where(inside), key, carry=carry)
    listed = listed_blocks(source, few) if len(few) <= BROADCAST_BLOCKS else wanted
    part = lambda df: df.withColumn("_block", blocks.of().cast("long")).join(listed, "_block", "left_semi").drop("_block")
    return diff(part(source), part(target), key, carry=carry)


def listed_blocks(df: DataFrame, numbers: list[int]) -> DataFrame:
    """Numbers, no more than BROADCAST_BLOCKS, as a table that is broadcast."""
    return F.broadcast(df.sparkSession.createDataFrame(pd.DataFrame({"_block": pd.Series(numbers, dtype="int64")})))


def block_refine(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str], coarse: int, fine: int) -> DataFrame:
    """block_compare() of the fine blocks within the coarse blocks that differ.  fine must divide coarse."""
    if coarse % fine:
        raise ValueError("fine blocks must nest in coarse ones")
    wanted = block_compare(source, target, key, columns, coarse).select(F.col("block").alias("_block"))
    part = lambda df: df.withColumn("_block", block_of([key], coarse)).join(wanted, "_block", "left_semi").drop("_block")
    return block_compare(part(source), part(target), key, columns, fine)


def coalesce_ranges(blocks: DataFrame, span: int = 1_048_576) -> DataFrame:
    """(first_block, last_block, n): adjacent blocks joined.  The window runs within spans of `span` blocks, so that no task
    sees all; islands that meet at a span's edge, two a span at most, are then joined within spans of span ** 2 blocks, and so on."""
    from pyspark.sql import Window as W

    within = lambda c, size: F.col(c) - F.pmod(F.col(c), F.lit(size)) if size < 2**63 else F.lit(0)
    w = W.partitionBy("span").orderBy("block")
    marked = blocks.select("block", within("block", span).alias("span")).withColumn("island", F.col("block") - F.row_number().over(w))
    out = marked.groupBy("span", "island").agg(F.min("block").alias("first_block"), F.max("block").alias("last_block"), F.count("*").alias("n")).drop("span", "island")
    edge = span
    while edge < 2**63:
        at_edge = (F.pmod("first_block", F.lit(edge)) == 0) | (F.pmod(F.col("last_block") + 1, F.lit(edge)) == 0)
        keyed = out.select("*", within("first_block", edge * span).alias("span"), F.when(~at_edge, F.col("first_block")).alias("own"))
        w = W.partitionBy("span", "own").orderBy("first_block")
        meets = F.lag("last_block").over(w) + 1 == F.col("first_block")
        chains = keyed.withColumn("new", F.when(meets, 0).otherwise(1)).withColumn("island", F.sum("new").over(w))
        out = chains.groupBy("span", "own", "island").agg(F.min("first_block").alias("first_block"), F.max("last_block").alias("last_block"), F.sum("n").alias("n")).drop("span", "own", "island")
        edge *= span
    return out


# -- whole rows ----------------------------------------------------------------------------------


def multiset_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def multiset_diff(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(columns, action, source_n, target_n): rows as their own key, nulls equal, a changed count is a replace."""
    s, t = multiset_counts(source, columns).alias("s"), multiset_counts(target, columns).alias("t")
    on = [F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")) for c in columns]
    action = F.when(F.col("t.n").isNull(), "insert").when(F.col("s.n").isNull(), "delete").otherwise("replace")
    out = s.join(t, on, "full_outer").select(
        *[F.when(F.col("s.n").isNotNull(), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in columns],
        action.alias("action"), F.coalesce(F.col("s.n"), F.lit(0)).alias("source_n"), F.coalesce(F.col("t.n"), F.lit(0)).alias("target_n"),
    )
    return out.where("source_n <> target_n")


def multiset_blocks(source: DataFrame, target: DataFrame, columns: Sequence[str], blocks: int) -> DataFrame:
    """(block, source_n, target_n) of the blocks, dealt by a hash of the rows, that hold other rows on one side than on the other.

    Repeats would cancel out in an exclusive or, so the halves of two 64-bit hashes are added up, the target's with a minus: sums stay
    within 64 bits below 2 ** 31 rows a block, and only they are shuffled, once for both sides.
    """

    def one(df: DataFrame, sign: int) -> DataFrame:
        a, b = row_hashes(df, columns)
        halves = [x for h in (a, b) for x in (h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32))]
        held = df.select(F.pmod(a, F.lit(blocks)).alias("block"), *[(x * sign).alias(f"h{i}") for i, x in enumerate(halves)])
        return held.withColumns({"s": F.lit(int(sign > 0)).cast("long"), "t": F.lit(int(sign < 0)).cast("long")})

    sums = one(source, 1).unionAll(one(target, -1)).groupBy("block").agg(*[F.sum(c).alias(c) for c in ("h0", "h1", "h2", "h3", "s", "t")])
    return sums.where("h0 <> 0 OR h1 <> 0 OR h2 <> 0 OR h3 <> 0 OR s <> t").select("block", F.col("s").alias("source_n"), F.col("t").alias("target_n"))


def pruned_multiset_diff(source: DataFrame, target: DataFrame, columns: Sequence[str], width: int) -> DataFrame:
    """multiset_diff() of the blocks of about `width` rows that differ: the rows of all others are read, but neither shuffled nor counted."""
    blocks = max(1, source.count() // width)
    wanted = multiset_blocks(source, target, columns, blocks).select(F.col("block").alias("_block"))
    few = wanted.limit(BROADCAST_BLOCKS + 1).toPandas()["_block"].tolist()
    within = lambda df: F.pmod(row_hashes(df, columns)[0], F.lit(blocks))
    if len(few) <= LITERAL_BLOCKS:
        part = lambda df: df.where(within(df).isin(few) if few else F.lit(False))
    else:
        listed = listed_blocks(source, few) if len(few) <= BROADCAST_BLOCKS else wanted
        part = lambda df: df.withColumn("_block", within(df)).join(listed, "_block", "left_semi").drop("_block")
    return multiset_diff(part(source), part(target), columns)


def multiset_expand(counts: DataFrame) -> DataFrame:
    """Each row n times, numbered by copy."""
    from concord.operators.apply import copied

    return copied(counts, "n").withColumnRenamed("_copy", "copy").drop("n")


def unique_conflicts(incoming: DataFrame, target: DataFrame, key: Sequence[str], unique: Sequence[Sequence[str]]) -> DataFrame:
    """Target rows that hold a unique value some incoming row of another key needs.  A null in a unique key conflicts with nothing.

    One equi-join per unique key, and a union; never joins over alternatives.
    """
    found = None
    for columns in unique:
        other = incoming.select(*[F.col(c).alias(f"_u{i}") for i, c in enumerate(columns)], *[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)])
        on = [F.col(c) == F.col(f"_u{i}") for i, c in enumerate(columns)]
        differs = F.lit(False)
        for i, c in enumerate(key):
            differs = differs | ~F.col(c).eqNullSafe(F.col(f"_k{i}"))
        rows = target.join(other, [*on, differs], "left_semi")
        found = rows if found is None else found.unionByName(rows)
    return found.dropDuplicates(list(key))


def verify(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row (missing, extra): rows, as multisets, that only one side has."""
    sided = source.select(*source.columns, F.lit(1).alias("_n")).unionAll(target.select(*source.columns, F.lit(-1)))
    over = sided.groupBy(*source.columns).agg(F.sum("_n").alias("_n"))
    total = lambda n: F.coalesce(F.sum(F.greatest(n, F.lit(0))), F.lit(0)).cast("long")
    return over.agg(total(F.col("_n")).alias("missing"), total(-F.col("_n")).alias("extra"))
