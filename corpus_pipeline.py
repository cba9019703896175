"""Corpus cleaning in five stages over `documents`; each returns a DataFrame that is written before the next reads it."""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.byte_bpe import default_bpe
from concord.llm.common import remove, scratch, shared_dir
from concord.llm.decontaminate import Decontaminator
from concord.llm.jaccard_join import JaccardJoin
from concord.llm.language_id import LanguageProfiles
from concord.llm.queries import remainder
from concord.llm.substring_dedup import SubstringDedup


def shielded(stage):
    """A stage in which columns besides those of documents pass through, whatever their names are."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        extra = {c: f"__concord_extra_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "lang", "source", "n_chars")}
        return stage(spark, docs.withColumnsRenamed(extra), sf_dir).withColumnsRenamed({v: k for k, v in extra.items()})

    return run


@shielded
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the others, null and letterless texts among them, go.  Rows that repeat are judged
    alike; no table, no result.  Columns besides doc_id, text and lang pass through."""
    model = LanguageProfiles()
    profiles = model.fit(docs.where(remainder(4) != 2).select("doc_id", "text", "lang"))
    return model.accept(model.predict(docs, profiles)).select(*docs.columns)


@shielded
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least doc_id.  Null and wordless texts are no copies of each
    other and stay.  Of rows with the same doc_id and text one stays; texts that differ stay under the doc_id they share.
    Rows without doc_id stay."""
    found = JaccardJoin(k=5, percent=80).apply(docs.select("doc_id", "text"))
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("__concord_id")).distinct()
    stays = docs.join(kept, docs["doc_id"] == kept["__concord_id"]).withColumn("__concord_text", F.xxhash64("text"))
    stays = stays.dropDuplicates(["doc_id", "__concord_text"]).select(*docs.columns)
    return stays.unionByName(docs.where("doc_id is null"))


@shielded
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines and passages are cut from all documents but the first that has them; n_chars is counted anew.  Null texts,
    empty texts and rows without doc_id stay as they are; every document stays, be it empty.  Of rows that repeat each other the first
    keeps its text."""
    return SubstringDedup().apply(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@shielded
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut from the texts, n_chars is counted anew.  Null texts stay null; every document stays."""
    found = Decontaminator().apply(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), texts=True)
    return found.withColumn("text", F.col("clean")).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to, in place of the text; a null text has no tokens.  Rows that repeat are
    encoded alike and stay.  Columns named like these are replaced, others pass through."""
    return default_bpe().digests(docs).drop("text")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what the stages before have written is removed as soon as the next has read it.

    Each stage says what it does with nulls, repeats and columns of its own names; an empty table gives an empty result.  Needs documents and
    benchmark in sf_dir.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with scratch(spark):
            path = f"{shared_dir(spark).rstrip('/')}/stage-{name}-{uuid.uuid4().hex}"
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.schema(out.schema).parquet(path), path
    return docs
