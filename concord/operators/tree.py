"""Trees of digests kept with a table, so that a side which has not changed need not be read again.

A leaf has the number of a block's rows and the exclusive or of two hashes of each; a node has the same of FANOUT nodes below it.
Order does not matter, so changes are folded in by what they take away and bring.  Two trees are compared from the top, and only
children of nodes that differ are looked at.  A stored tree names the files that its table had and the sum of its leaves:
if either no longer holds, it is built anew.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.operators.blocks import KeyBlocks
from concord.operators.commit import read_text, write_text
from concord.operators.diff import LITERAL_BLOCKS
from concord.operators.encode import row_hashes

FANOUT = 64


def sums() -> list[Column]:
    return [F.sum("n").alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")]


def with_hashes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """df with _a and _b, two hashes of a row."""
    a, b = row_hashes(df, columns)
    return df.withColumns({"_a": a, "_b": b})


def leaves(df: DataFrame, blocks: KeyBlocks, columns: Sequence[str]) -> DataFrame:
    """(block, n, a, b)"""
    a, b = row_hashes(df, columns)
    return df.select(blocks.of().cast("long").alias("block"), F.lit(1).cast("long").alias("n"), a.alias("a"), b.alias("b")).groupBy("block").agg(*sums())


def parent(levels: int = 1) -> Column:
    return F.floor(F.col("block") / F.lit(FANOUT**levels)).cast("long")


def depth_of(blocks: int) -> int:
    """Levels above the leaves, so that the highest has about FANOUT nodes."""
    return max(1, math.ceil(math.log(max(blocks, 2), FANOUT)) - 1)


def levels(leaf: DataFrame, depth: int) -> DataFrame:
    """(level, block, n, a, b): the leaves, level 0, and the nodes above them; each is summed up from the leaves."""
    every = leaf.select(F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level"), "block", "n", "a", "b")
    node = F.when(F.col("level") == 0, F.col("block"))
    for k in range(1, depth + 1):
        node = F.when(F.col("level") == k, parent(k)).otherwise(node)
    return every.withColumn("block", node).groupBy("level", "block").agg(*sums())


def unlike(source: DataFrame, target: DataFrame) -> DataFrame:
    """(block, source_n, target_n) of the nodes of one level that differ, a count being null where a side has none."""
    s, t = source.alias("s"), target.alias("t")
    same = F.col("s.n").eqNullSafe(F.col("t.n")) & F.col("s.a").eqNullSafe(F.col("t.a")) & F.col("s.b").eqNullSafe(F.col("t.b"))
    found = s.join(t, F.col("s.block") == F.col("t.block"), "full_outer").where(~same)
    return found.select(F.coalesce("s.block", "t.block").alias("block"), F.col("s.n").alias("source_n"), F.col("t.n").alias("target_n"))


def descend(source: DataFrame, target: DataFrame, depth: int) -> DataFrame:
    """unlike() of the leaves of two trees: from the top, within what differs; as soon as that is more than a predicate can hold, the leaves at once."""
    of = lambda tree, level: tree.where(F.col("level") == level).drop("level")
    inside = F.lit(True)
    for level in range(depth, 0, -1):
        found = unlike(of(source, level).where(inside), of(target, level).where(inside)).select("block").limit(LITERAL_BLOCKS + 1).collect()
        if len(found) > LITERAL_BLOCKS:
            inside = F.lit(True)
            break
        inside = parent().isin([r.block for r in found]) if found else F.lit(False)
    return unlike(of(source, 0).where(inside), of(target, 0).where(inside))


def updated(leaf: DataFrame, changes: DataFrame, blocks: KeyBlocks) -> DataFrame:
    """The leaves after changes, of diff() with hashes carried: what a row was goes out by another exclusive or, what it is comes in."""
    zero, plus = F.lit(0).cast("long"), F.when(F.col("action") == "insert", 1).when(F.col("action") == "delete", -1).otherwise(0).cast("long")
    new = lambda c: F.coalesce(F.col(f"_{c}"), zero).bitwiseXOR(F.coalesce(F.col(f"t__{c}"), zero)).alias(c)
    delta = changes.select(blocks.of().cast("long").alias("block"), plus.alias("n"), new("a"), new("b"))
    return leaf.select("block", "n", "a", "b").unionByName(delta).groupBy("block").agg(*sums()).where("n > 0")


@dataclass(frozen=True)
class Tree:
    """A stored tree: what it is of, and where."""

    blocks: KeyBlocks
    columns: tuple[str, ...]
    depth: int
    files: str
    root: tuple[int, int, int]
    path: str = ""

    def levels(self, spark) -> DataFrame:
        return spark.read.schema("level int, block long, n long, a long, b long").parquet(f"{self.path}/levels")

    def leaf(self, spark) -> DataFrame:
        return self.levels(spark).where("level = 0").drop("level")

    def sound(self, spark) -> bool:
        """Whether all levels add up to the root."""
        try:
            found = {r.level: (r.n, r.a, r.b) for r in self.levels(spark).groupBy("level").agg(*sums()).collect()}  # a row a level
        except Exception:  # files that are gone or can't be read: the tree is damaged whatever they say
            return False
        return found == (dict.fromkeys(range(self.depth + 1), self.root) if self.root[0] else {})

    def of_same(self, other: Tree) -> bool:
        return (self.blocks, self.columns, self.depth) == (other.blocks, other.columns, other.depth)


def load(spark, path: str, files: str, key: Sequence[str], columns: Sequence[str]) -> Tree | None:
    """The tree stored at path, if it is of this key and these columns, its table has the same files, and it is sound."""
    text = read_text(spark, f"{path}/tree.json")
    if text is None:
        return None
    given = json.loads(text)
    blocks = {k: tuple(map(lambda x: tuple(x) if isinstance(x, list) else x, v)) if isinstance(v, list) else v for k, v in given["blocks"].items()}
    found = Tree(KeyBlocks(**blocks), tuple(given["columns"]), given["depth"], given["files"], tuple(given["root"]), path)
    fits = found.files == files and found.blocks.key == tuple(key) and found.columns == tuple(columns)
    return found if fits and found.sound(spark) else None


def store(leaf: DataFrame, blocks: KeyBlocks, columns: Sequence[str], depth: int, files: str, folder: str) -> str:
    """Write a tree aside; where it lies."""
    path, spark = f"{folder}/.tree-{uuid.uuid4().hex}", leaf.sparkSession
    levels(leaf, depth).repartition(1, "level").write.partitionBy("level").parquet(f"{path}/levels")
    n, a, b = spark.read.schema("level int, block long, n long, a long, b long").parquet(f"{path}/levels").where("level = 0").agg(*sums()).first()
    tree = Tree(blocks, tuple(columns), depth, files, (n or 0, a or 0, b or 0))
    write_text(spark, f"{path}/tree.json", json.dumps({k: v for k, v in asdict(tree).items() if k != "path"}))
    return path
