"""Token counts by source, language and tokenizer version, maintained from signed deltas.

A batch of changes is reduced to one signed row per group and written aside; it is committed by creating the marker of its id,
which only one writer can, so committing the id again changes nothing.  Totals are the sum of what is committed, so inserts,
deletes and revised counts cost what they change, never a recount.  compact() folds committed batches into one table
and remembers their ids in another; neither is ever brought to the driver whole.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "tokenizer_version"]
SUMS = "docs long, tokens long"


def inserted(counts: DataFrame) -> DataFrame:
    """Signed rows of new documents, from KEYS and tokens; a null count is 0."""
    return counts.select(*KEYS, F.lit(1).cast("long").alias("docs"), F.coalesce(F.col("tokens").cast("long"), F.lit(0)).alias("tokens"))


def deleted(counts: DataFrame) -> DataFrame:
    """Signed rows of documents that go, with the counts they were inserted with."""
    return inserted(counts).withColumns({"docs": -F.col("docs"), "tokens": -F.col("tokens")})


def revised(before: DataFrame, after: DataFrame) -> DataFrame:
    """Signed rows of documents whose count, source, language or version is corrected."""
    return deleted(before).unionByName(inserted(after))


@dataclass(frozen=True)
class TokenRollup:
    """path: a folder that all executors share.

    data/<batch>-<writer> holds a writer's rows of a batch, commits/<batch> is the marker that names the writer, and
    base/<number> holds totals and the ids folded into them.
    """

    spark: SparkSession
    path: str

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, folder: str) -> list[str]:
        fs, p = self._fs(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _base(self) -> str | None:
        return max(self._names("base"), default=None)

    def _folded(self, ids: list[str]) -> set[str]:
        """Which of a few ids are folded into the base already."""
        base = self._base()
        if not base or not ids:
            return set()
        known = self.spark.read.schema("batch string").parquet(f"{self.path}/base/{base}/batches")
        return {r.batch for r in known.where(F.col("batch").isin(ids)).distinct().collect()}

    def _writer(self, batch_id: str) -> str:
        """Who has committed a batch, by its marker; empty if its writer died before naming itself."""
        fs, p = self._fs(f"{self.path}/commits/{batch_id}")
        stream = fs.open(p)
        try:
            return bytes(stream.readNBytes(64)).decode()
        finally:
            stream.close()

    def commit(self, batch_id: str, signed: DataFrame) -> bool:
        """Add a batch of signed rows (KEYS, docs, tokens); False if a batch of that id is committed already.  Repeated rows all count, other columns
        are ignored, and a batch without rows changes no total but takes its id.

        The marker is created only where there is none, so of two writers of one id only one takes effect, and a batch counts
        wholly or not at all.  A marker without a name is what a writer that died has left: the id is free again.
        """
        if not re.fullmatch(r"[\w-]+", batch_id):
            raise ValueError(f"batch id {batch_id!r}")
        fs, marker = self._fs(f"{self.path}/commits/{batch_id}")
        if self._folded([batch_id]) or (fs.exists(marker) and self._writer(batch_id)):
            return False
        writer = uuid.uuid4().hex
        data = f"{self.path}/data/{batch_id}-{writer}"
        sums(signed).write.parquet(data)
        if fs.exists(marker) and not self._writer(batch_id):
            fs.delete(marker, False)
        try:
            stream = fs.create(marker, False)
        except Py4JJavaError:
            fs.delete(self._fs(data)[1], True)
            if not fs.exists(marker):
                raise
            return False
        stream.write(bytearray(writer.encode()))
        stream.close()
        return True

    def _committed(self) -> tuple[DataFrame, list[str]]:
        """What counts, and the ids that are not folded yet."""
        names = self._names("commits")
        folded = self._folded(names)
        new = {n: w for n in names if n not in folded if (w := self._writer(n))}
        schema = f"source string, lang string, tokenizer_version string, {SUMS}"
        base = self._base()
        paths = [f"{self.path}/base/{base}/totals"] * bool(base) + [f"{self.path}/data/{n}-{w}" for n, w in new.items()]
        found = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return found, list(new)

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer_version, docs, tokens) of all committed batches; groups that are empty again are left out.
        Nulls are groups of their own."""
        return sums(self._committed()[0]).where("docs <> 0 or tokens <> 0")

    def compact(self) -> None:
        """Fold the committed batches into a new base; the base is found once its folder is renamed into place.  Markers of batches
        that a base has folded go last: until then they are known to be folded."""
        found, new = self._committed()
        if not new:
            return
        aside = f"{self.path}/aside/{uuid.uuid4().hex}"
        sums(found).write.parquet(f"{aside}/totals")
        ids = self.spark.createDataFrame([(b,) for b in new], "batch string")
        base = self._base()
        if base:
            ids = self.spark.read.schema("batch string").parquet(f"{self.path}/base/{base}/batches").unionByName(ids)
        ids.write.parquet(f"{aside}/batches")
        fs, final = self._fs(f"{self.path}/base/{int(base or '0') + 1:012d}")
        fs.mkdirs(final.getParent())
        if fs.exists(final) or not fs.rename(self._fs(aside)[1], final):
            raise RuntimeError("another writer has compacted meanwhile")
        for name in new:
            data = self._fs(f"{self.path}/data/{name}-{self._writer(name)}")[1]
            fs.delete(self._fs(f"{self.path}/commits/{name}")[1], False)
            fs.delete(data, True)
        for older in self._names("base"):  # who reads now reads this base or the one before
            if int(older) < int(base or "0"):
                fs.delete(self._fs(f"{self.path}/base/{older}")[1], True)


def sums(signed: DataFrame) -> DataFrame:
    return signed.groupBy(*KEYS).agg(F.sum("docs").cast("long").alias("docs"), F.sum("tokens").cast("long").alias("tokens"))
