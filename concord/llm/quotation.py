"""Quotation linking: quoted passages are hashed and joined to the messages they quote; threads follow from the links.

DataFrame functions only.  A line's quote level is the number of > it starts with (blanks between them allowed).  A run of
lines of one level is a passage.  A message offers its unquoted passages, and each of their lines, to be quoted by later turns
of its conversation; a quoted passage of any level is linked by the digest of its normalised text (lower case, single
blanks) to the latest earlier turn that offers it, or else by that of its first line.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from concord.llm.common import discard, materialise

QUOTE = r"^[ \t]*(?:>[ \t]*)+"


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def digest(text: Column) -> Column:
    return F.when(normal(text) != "", F.sha2(normal(text), 256))


@dataclass(frozen=True)
class QuotationLinks:
    """most_rounds: rounds of pointer doubling, enough for threads of 2 ** most_rounds messages.  stretch: turns of a conversation
    that are looked through at once for what a passage quotes."""

    most_rounds: int = 40
    stretch: int = 1_024

    def lines(self, messages: DataFrame) -> DataFrame:
        """(conv_id, turn, mid, pos, level, line)"""
        every = messages.select("conv_id", "turn", "mid", F.posexplode(F.split("text", "\r?\n")).alias("pos", "raw"))
        prefix = F.regexp_extract("raw", QUOTE, 0)
        return every.select("conv_id", "turn", "mid", "pos", F.length(F.regexp_replace(prefix, "[^>]", "")).alias("level"), F.regexp_replace("raw", QUOTE, "").alias("line"))

    def passages(self, lines: DataFrame) -> DataFrame:
        """(conv_id, turn, mid, run, level, passage, first): runs of lines of one level; a message's lines only."""
        one = W.partitionBy("mid", "conv_id", "turn").orderBy("pos")
        runs = lines.withColumn("run", F.sum(F.when(F.col("level") == F.lag("level").over(one), 0).otherwise(1)).over(one))
        joined = runs.groupBy("conv_id", "turn", "mid", "run", "level").agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("held"))
        first = F.element_at(F.filter("held", lambda x: normal(x["line"]) != ""), 1)["line"]
        with_first = F.when(F.exists("held", lambda x: normal(x["line"]) != ""), first)
        return joined.select("conv_id", "turn", "mid", "run", "level", F.array_join(F.transform("held", lambda x: x["line"]), "\n").alias("passage"), with_first.alias("first"))

    def apply(self, messages: DataFrame) -> DataFrame:
        """Per row of `messages` (conv_id, turn, role, text): conv_id, turn, role, body, n_quoted, reply_to, thread, in reply
        order: by conversation, thread and turn.

        body: the text without quoted lines.  n_quoted: quoted passages, of any level.  reply_to: the latest turn that the quoted passages of
        the lowest level with a link link to, null if none.  thread: the turn that the chain of replies starts from, the own turn if none.
        Null texts have a null body and quote nothing.  A null conv_id or turn neither links nor is linked; repeated rows are
        judged alike; where rows share a turn, any of them is what is quoted.  Other columns are ignored.
        """
        rows = messages.select("conv_id", "turn", "role", "text").withColumn("mid", F.xxhash64("role", "text"))
        quoting = rows.where(F.col("text").rlike("(?m)" + QUOTE))
        plain = rows.where(~F.coalesce(F.col("text").rlike("(?m)" + QUOTE), F.lit(False)))
        runs = materialise(self.passages(self.lines(quoting.dropDuplicates(["conv_id", "turn", "mid"]))), "passages")
        quoted = runs.where("level > 0")
        wanted = quoted.where("conv_id is not null and turn is not null").select("conv_id", "turn", "mid", "run", "level", digest(F.col("passage")).alias("whole"), digest(F.col("first")).alias("line"))
        keys = wanted.select("conv_id", F.explode(F.array("whole", "line")).alias("key")).where("key is not null").distinct()
        # originals are only cut up in conversations that quote
        inside = plain.where("turn is not null and text is not null").join(keys.select("conv_id").distinct(), "conv_id", "left_semi")
        offered = inside.select("conv_id", "turn", F.explode(F.concat(F.array("text"), F.split("text", "\r?\n"))).alias("said"))
        offered = offered.unionByName(runs.where("level = 0 and turn is not null").select("conv_id", "turn", F.explode(F.concat(F.array("passage"), F.split("passage", "\n"))).alias("said")))
        offers = offered.select("conv_id", "turn", digest(F.col("said")).alias("key")).join(keys, ["conv_id", "key"], "left_semi").distinct()
        offers = materialise(offers, "offers")
        links = self.linked(wanted, offers)
        reply = materialise(links.groupBy("conv_id", "turn", "mid").agg(F.max(F.struct(-F.col("level"), "original"))["original"].alias("reply_to")), "replies")
        threads = self.threads(reply.groupBy("conv_id", "turn").agg(F.max("reply_to").alias("up")))
        body = runs.where("level = 0").groupBy("conv_id", "turn", "mid").agg(F.array_sort(F.collect_list(F.struct("run", "passage"))).alias("held"))
        body = body.select("conv_id", "turn", "mid", F.array_join(F.transform("held", lambda x: x["passage"]), "\n").alias("body"))
        number = quoted.groupBy("conv_id", "turn", "mid").agg(F.count("*").alias("n_quoted"))
        told = self._attach(quoting.drop("text"), body, number, reply)
        told = told.withColumn("body", F.coalesce("body", F.lit("")))
        flat = plain.withColumn("body", F.col("text")).withColumn("n_quoted", F.lit(0).cast("long")).withColumn("reply_to", F.lit(None).cast(dict(reply.dtypes)["reply_to"])).drop("text")
        out = told.unionByName(flat).join(threads, ["conv_id", "turn"], "left")
        out = out.select("conv_id", "turn", "role", "body", F.coalesce("n_quoted", F.lit(0)).cast("long").alias("n_quoted"), "reply_to", F.coalesce("thread", "turn").alias("thread"))
        return out.repartitionByRange("conv_id", "thread", "turn").sortWithinPartitions("conv_id", "thread", "turn")

    def _attach(self, rows: DataFrame, *tables: DataFrame) -> DataFrame:
        """Left joins on conv_id, turn and mid in which nulls are equal."""
        for i, t in enumerate(tables):
            t = t.withColumnsRenamed({"conv_id": "_c", "turn": "_t", "mid": "_m"})
            rows = rows.join(t, rows["mid"].eqNullSafe(t["_m"]) & rows["conv_id"].eqNullSafe(t["_c"]) & rows["turn"].eqNullSafe(t["_t"]), "left").drop("_c", "_t", "_m")
        return rows

    def linked(self, wanted: DataFrame, offers: DataFrame) -> DataFrame:
        """(conv_id, turn, mid, run, level, original): the latest earlier turn that offers the passage, or its first line."""
        kind = dict(offers.dtypes)["turn"]
        asked = wanted.select("conv_id", "turn", F.explode(F.array("whole", "line")).alias("key")).where("key is not null").distinct()
        latest = self.latest(asked, offers).withColumn("original", F.col("original").cast(kind))
        one = lambda key: latest.select("conv_id", "turn", F.col("key").alias(key), F.col("original").alias(f"by_{key}"))
        found = wanted.join(one("whole"), ["conv_id", "turn", "whole"], "left").join(one("line"), ["conv_id", "turn", "line"], "left")
        return found.select("conv_id", "turn", "mid", "run", "level", F.coalesce("by_whole", "by_line").alias("original")).where("original is not null")

    def latest(self, asked: DataFrame, offers: DataFrame) -> DataFrame:
        """(conv_id, turn, key, original): for each (conv_id, turn, key) asked for, the latest earlier turn that offers the key.

        Both sides are sorted together instead of joined, as many turns may ask for what many turns have said.  Windows run within
        stretches of `stretch` turns; what earlier stretches offer last reaches them by one row a stretch.
        """
        block = F.floor(F.col("turn") / self.stretch)
        both = asked.select("conv_id", "key", F.col("turn").cast("long").alias("turn"), F.lit(True).alias("asks")).unionByName(offers.select("conv_id", "key", F.col("turn").cast("long").alias("turn"), F.lit(False).alias("asks")))
        both = both.withColumn("block", block)
        said = F.when(~F.col("asks"), F.col("turn"))
        within = W.partitionBy("conv_id", "key", "block").orderBy("turn").rangeBetween(W.unboundedPreceding, -1)
        near = both.withColumn("near", F.max(said).over(within)).where("asks").drop("asks")
        last = both.groupBy("conv_id", "key", "block").agg(F.max(said).alias("last"))
        earlier = W.partitionBy("conv_id", "key").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
        far = last.select("conv_id", "key", "block", F.max("last").over(earlier).alias("far"))
        found = near.join(far, ["conv_id", "key", "block"], "left")
        return found.select("conv_id", "turn", "key", F.coalesce("near", "far").alias("original")).where("original is not null")

    def threads(self, up: DataFrame) -> DataFrame:
        """(conv_id, turn, thread) of the turns that reply, by pointer doubling over (conv_id, turn, up)."""
        cur = materialise(up, "up")
        for _ in range(self.most_rounds):
            above = cur.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("next"))
            new = materialise(cur.select("conv_id", "turn", "up").join(above, ["conv_id", "up"], "left").select("conv_id", "turn", F.coalesce("next", "up").alias("up"), F.col("next").isNotNull().alias("moved")), "up")
            discard(cur)
            cur = new
            if cur.where("moved").isEmpty():
                break
        return cur.select("conv_id", "turn", F.col("up").alias("thread"))
