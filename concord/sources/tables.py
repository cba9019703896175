"""Where tables are read from and written to: folders of parquet tables, with their definitions, and catalog listings."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.operators.apply import rewritten, write_staged
from concord.operators.commit import Pair, commit, exists, read_text, recover, write_text
from concord.plans.model import DatabaseDef, TableDef, table_of

DEFINITIONS = "_definitions.json"


@dataclass(frozen=True)
class ParquetSource:
    """A folder with one <table>.parquet for each table."""

    spark: SparkSession
    path: str

    def _fs(self):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def tables(self) -> list[str]:
        """Names, largest table first, equal ones by name."""
        fs, p = self._fs()
        if not fs.exists(p):
            return []
        sized = [(-fs.getContentSummary(s.getPath()).getLength(), s.getPath().getName().removesuffix(".parquet")) for s in fs.listStatus(p) if s.getPath().getName().endswith(".parquet")]
        return [name for _, name in sorted(sized)]

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{table}.parquet")

    def write(self, table: str, df: DataFrame) -> None:
        write_staged(df, f"{self.path}/{table}.parquet")

    def stage(self, table: str, df: DataFrame) -> tuple[str, str]:
        """Write a table aside; publish() puts it in place."""
        aside = f"{self.path}/.new-{table}-{uuid.uuid4().hex}"
        df.write.parquet(aside)
        return aside, f"{self.path}/{table}.parquet"

    def is_folder(self, table: str) -> bool:
        fs, p = self._fs()
        p = self.spark._jvm.org.apache.hadoop.fs.Path(p, f"{table}.parquet")
        return fs.exists(p) and fs.getFileStatus(p).isDirectory()

    def files(self, table: str, staged: Sequence[Pair] = ()) -> str:
        """A digest of the names, lengths and times of a table's files, as they will be after what is staged."""
        fs, p = self._fs()
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        folder = path(p, f"{table}.parquet")
        told = lambda f: f"{f.getLen()}:{f.getModificationTime()}"
        found = {f.getPath().getName(): told(f) for f in fs.listStatus(folder) if f.getPath().getName().endswith(".parquet")} if fs.exists(folder) else {}
        for a, b in staged:
            if b is None:
                found.pop(path(a).getName(), None)
            elif path(b).getParent().getName() == folder.getName():
                found[path(b).getName()] = told(fs.getFileStatus(path(a)))
        return hashlib.sha256(repr(sorted(found.items())).encode()).hexdigest()

    def tree_path(self, table: str) -> str:
        return f"{self.path}/_digests/{table}"

    def read_with_files(self, table: str) -> DataFrame:
        """The rows with `_file`, where each lies."""
        return self.read(table).select("*", F.col("_metadata.file_path").alias("_file"))

    def stage_changes(self, table: str, changes: DataFrame, key: Sequence[str]) -> list[Pair]:
        """Write the files anew that hold changed or deleted rows, with all new ones; publish() puts them in place of the old.

        changes: of diff(), with t__file, the file of the target's row; written, as it is read twice.  The files' names come to the driver.
        """
        uri, path = self.spark._jvm.java.net.URI, self.spark._jvm.org.apache.hadoop.fs.Path
        touched = [path(uri(r[0])).toString() for r in changes.where("action <> 'insert'").select("t__file").distinct().toLocalIterator()]
        schema = self.read(table).schema
        affected = self.spark.read.schema(schema).parquet(*touched) if touched else self.spark.createDataFrame([], schema)
        aside = f"{self.path}/.new-{table}-{uuid.uuid4().hex}"
        rewritten(affected, changes, key).write.parquet(aside)
        fs, _ = self._fs()
        new = [f.getPath().getName() for f in fs.listStatus(path(aside)) if f.getPath().getName().endswith(".parquet")]
        return [*((f, None) for f in touched), *((f"{aside}/{n}", f"{self.path}/{table}.parquet/{n}") for n in new), (aside, None)]

    def publish(self, staged: Sequence[Pair]) -> None:
        """Put all that is staged in place, in one commit."""
        if staged:
            commit(self.spark, self.path, staged)

    def recover(self) -> None:
        """Complete the commit of a run that has died, if there is one."""
        recover(self.spark, self.path)

    def hold(self, table: str, changes: DataFrame) -> DataFrame:
        """Changes written aside, so that they are computed once; held_path is to be dropped."""
        path = f"{self.path}/.changes-{table}-{uuid.uuid4().hex}"
        changes.write.parquet(path)
        out = self.spark.read.schema(changes.schema).parquet(path)
        out.held_path = path
        return out

    # -- definitions, in a file beside the tables -------------------------------------------------

    def definitions(self) -> DatabaseDef:
        text = read_text(self.spark, f"{self.path}/{DEFINITIONS}")
        return DatabaseDef.from_json(text) if text else DatabaseDef()

    def stored(self, table: str) -> bool:
        return any(t.name == table for t in self.definitions().tables)

    def definition(self, table: str) -> TableDef:
        """As stored; without one, the columns that the files show."""
        return next((t for t in self.definitions().tables if t.name == table), None) or table_of(self.read(table), table)

    def stage_definitions(self, tables: Mapping[str, TableDef], gone: Collection[str] = ()) -> list[Pair]:
        """Definitions beside those of other tables, written aside; nothing if all are stored already."""
        had = self.definitions()
        kept = {t.name: t for t in had.tables if t.name not in gone} | dict(tables)
        new = DatabaseDef(tuple(kept[n] for n in sorted(kept)))
        if new == had:
            return []
        aside = f"{self.path}/.definitions-{uuid.uuid4().hex}"
        write_text(self.spark, aside, new.to_json())
        return [(aside, f"{self.path}/{DEFINITIONS}")]

    def define(self, tables: Mapping[str, TableDef], gone: Collection[str] = ()) -> None:
        """Store definitions beside those of other tables."""
        self.publish(self.stage_definitions(tables, gone))

    def exists(self) -> bool:
        fs, p = self._fs()
        return fs.exists(p)

    def drop(self, table: str) -> None:
        """The table and its digest tree."""
        self.publish([(p, None) for p in (f"{self.path}/{table}.parquet", self.tree_path(table)) if exists(self.spark, p)])


def enum_labels(rows: DataFrame) -> DataFrame:
    """(enum, labels): the labels of each enum type in order, from (enum, pos, label) of a catalog."""
    held = rows.groupBy("enum").agg(F.array_sort(F.collect_list(F.struct("pos", "label"))).alias("l"))
    return held.select("enum", F.transform("l", lambda x: x["label"]).alias("labels"))
