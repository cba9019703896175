"""Making the target equal the source: new states as DataFrames, and staged writes."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.operators.commit import commit
from concord.operators.ranges import key_range


def apply_diff(target: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """The target after the changes of diff(): rows whose key is changed go, inserts and replaces come."""
    kept = target.join(changes.select(*key), list(key), "left_anti").select(*target.columns)
    return kept.unionByName(changes.where("action IN ('insert', 'replace')").select(*target.columns))


def apply_multiset(target: DataFrame, changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The target after the changes of multiset_diff(): changed groups go wholly and come source_n times."""
    c = changes.select(*[F.col(x).alias(f"_{x}") for x in columns])
    kept = target.join(c, [F.col(x).eqNullSafe(F.col(f"_{x}")) for x in columns], "left_anti").select(*columns)
    return kept.unionByName(copied(changes.where("source_n > 0"), "source_n").select(*columns))


#: Copies that one row of a task expands to.
CHUNK = 65_536


def chunks(df: DataFrame, n: str) -> DataFrame:
    """df with _from and _to: each row's copies from 1 to n, CHUNK of them a row; rows of more than one chunk are dealt over all tasks."""
    number = F.expr(f"ceil(`{n}` / {CHUNK})").cast("long")
    few = df.where(F.col(n) <= CHUNK).withColumn("_chunk", F.lit(0).cast("long"))
    many = df.where(F.col(n) > CHUNK).withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), number - 1)))
    many = many.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_chunk")  # a number that is given is kept, few bytes as they are
    first = F.col("_chunk") * CHUNK + 1
    return few.unionByName(many).withColumns({"_from": first, "_to": F.least(first + CHUNK - 1, F.col(n).cast("long"))}).drop("_chunk")


def copied(df: DataFrame, n: str) -> DataFrame:
    """Each row n times, with _copy from 1 to n."""
    return chunks(df.where(F.col(n) > 0), n).withColumn("_copy", F.explode(F.sequence("_from", "_to"))).drop("_from", "_to")


def clear_range(target: DataFrame, key: Sequence[str], prev=None, last=None) -> DataFrame:
    """The target without the rows of a key range."""
    return target.where(~key_range(key, prev, last))


def next_sequence_value(df: DataFrame, column: str) -> DataFrame:
    return df.agg((F.coalesce(F.max(column), F.lit(0)) + 1).alias("next_value"))


def write_staged(df: DataFrame, path: str) -> None:
    """Replace a parquet folder by renaming: the new state is written beside it first, so a failed job changes nothing."""
    aside = f"{path}.new-{uuid.uuid4().hex}"
    df.write.parquet(aside)
    swap(df.sparkSession, [(aside, path)])


def swap(spark: SparkSession, pairs: Sequence[tuple[str, str]]) -> None:
    """Rename each written folder to its final place; if one can't be, all that were there before are put back."""
    commit(spark, pairs[0][1].rstrip("/").rpartition("/")[0] or "/", pairs)


def rewritten(affected: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """What takes the place of the files that hold changed keys: their other rows, and all new ones."""
    gone = changes.where("action <> 'insert'").select(*key)
    kept = affected.join(gone, list(key), "left_anti").select(*affected.columns)
    return kept.unionByName(changes.where("action <> 'delete'").select(*affected.columns))
