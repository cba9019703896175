"""Structured Streaming: keep a target up to date from a stream of source rows, batch by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from concord.operators.apply import write_staged
from concord.sources.tables import ParquetSource


def upsert(target: DataFrame, rows: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """The target with the latest row of each key, by `order`; a target row stays where no row of the batch has its key, or only earlier ones."""
    new = latest(target, rows, key, order)
    return target.join(new.select(*key), list(key), "left_anti").unionByName(new.select(*target.columns))


def latest(target: DataFrame, rows: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """The latest row of each key, by `order`, unless the target has a later one."""
    new = rows.groupBy(*key).agg(F.max_by(F.struct(*rows.columns), order).alias("r")).select("r.*")
    if order not in target.columns:
        return new
    had = target.select(*[F.col(c).alias(f"_had_{c}") for c in (*key, order)])
    late = F.col(f"_had_{order}") > F.col(order)
    for c in key:
        late = late & (F.col(f"_had_{c}") == F.col(c))
    return new.join(had, late, "left_anti")


def changes(target: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """new as changes of diff(): inserts, and replaces with t__file, the file (_file) of the target's row."""
    had = target.select(*key, F.col("_file").alias("t__file"))
    return new.join(had, list(key), "left").withColumn("action", F.when(F.col("t__file").isNull(), "insert").otherwise("replace"))


def refresh(stream: DataFrame, path: str, key: Sequence[str], order: str, checkpoint: str) -> StreamingQuery:
    """Upsert a stream into a parquet folder; a batch that is replayed after a failure leads to the same rows.  Of a folder <name>.parquet only
    files that hold keys of the batch are written anew, in one journalled commit; another is written anew as a whole."""
    folder, _, name = path.rstrip("/").rpartition("/")

    def batch(rows: DataFrame, _: int) -> None:
        if not name.endswith(".parquet"):
            write_staged(upsert(rows.sparkSession.read.schema(rows.schema).parquet(path), rows, key, order), path)
            return
        source, table = ParquetSource(rows.sparkSession, folder), name.removesuffix(".parquet")
        source.recover()
        target = source.read_with_files(table)
        held = source.hold(table, changes(target, latest(target.drop("_file"), rows, key, order), key))
        source.publish([*(source.stage_changes(table, held, key) if not held.isEmpty() else []), (held.held_path, None)])

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
