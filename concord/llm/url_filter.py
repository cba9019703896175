"""URL rules by Bloom filter cascades: exact membership of the corpus's own keys, without joins when urls are judged.

A url's keys are every suffix of its host at a label boundary with no more labels than some rule's host, joined to every
prefix of its path that is as long as some rule's path; the corpus's key universe is all keys of all urls.  A cascade for a list alternates
levels: the first filter holds the listed keys, the second the universe's false positives of the first, the third
the listed keys that the second takes in, and so on until a level takes in nothing wrong.  On the universe it is
exact.  Filters are sized for the list, not the corpus: the first level's error rate falls as the universe grows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.llm.common import mix

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty for null or where there is no ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def keys_of(host: Column, path: Column, lengths: list[int], most_labels: int) -> Column:
    """array<string>: the keys of a url, longest first, equal lengths by the longer host."""
    labels = F.split(host, r"\.")
    labels = F.slice(labels, F.greatest(F.size(labels) - most_labels + 1, F.lit(1)), most_labels)
    hosts = F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    )
    known = F.lit(lengths) if lengths else F.array().cast("array<int>")
    paths = F.transform(F.filter(known, lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n))
    every = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.struct(F.length(F.concat(h, p)).alias("n"), F.length(h).alias("hn"), F.concat(h, p).alias("key")))))
    return F.transform(F.reverse(F.array_sort(every)), lambda k: k["key"])


@dataclass
class Level:
    bits: np.ndarray  # uint64 words
    m: int
    k: int
    seed: int

    def holds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.ones(len(a), bool)
        for i in range(self.k):
            at = positions(a, b, self.seed + i, self.m)
            out &= (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def positions(a: np.ndarray, b: np.ndarray, seed: int, m: int) -> np.ndarray:
    return (mix(a, 2 * seed + 1) + mix(b, 2 * seed + 2)) % np.uint64(m)


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    def passed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Levels passed before the first miss."""
        out, alive = np.zeros(len(a), np.int64), np.arange(len(a))
        for level in self.levels:
            alive = alive[level.holds(a[alive], b[alive])]
            out[alive] += 1
        return out

    def listed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.passed(a, b) % 2 == 1


def hashed(df: DataFrame) -> DataFrame:
    """(key) -> (key, a, b): two 64-bit hashes."""
    return df.select("key", F.xxhash64(F.lit(1), "key").alias("a"), F.xxhash64(F.lit(2), "key").alias("b"))


def where_passed(keys: DataFrame, cascade: Cascade, levels: int) -> DataFrame:
    """The (key, a, b) that pass all of the cascade's `levels`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_numpy().view(np.uint64) for i in (1, 2))
            yield batch.filter(pa.array(cascade.passed(a, b) == levels))

    return keys.mapInArrow(run, keys.schema)


def build_level(keys: DataFrame, n: int, rate: float, seed: int) -> Level:
    """A filter over n distinct keys; tasks send set words, merged by bit_or, at most m / 64 of them."""
    k = max(1, round(math.log2(1 / rate)))
    m = max(64, math.ceil(n * k / math.log(2)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_numpy().view(np.uint64) for i in (1, 2))
            at = np.concatenate([positions(a, b, seed + i, m) for i in range(k)])
            word, back = np.unique(at >> np.uint64(6), return_inverse=True)
            bits = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(bits, back, np.uint64(1) << (at & np.uint64(63)))
            yield pa.RecordBatch.from_pydict({"word": pa.array(word.view(np.int64)), "bits": pa.array(bits.view(np.int64))})

    words = keys.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    bits = np.zeros(m // 64 + 1, np.uint64)
    for r in words.toLocalIterator():
        bits[r.word] = np.int64(r.bits).view(np.uint64)
    return Level(bits, m, k, seed)


def build_cascade(listed: DataFrame, universe: DataFrame, universe_size: int, most_levels: int = 40) -> Cascade:
    """listed: distinct (key, a, b).  universe: (key, a, b) of all urls, repeats allowed."""
    cascade, seed = Cascade(), 0
    n = listed.count()
    if not n:
        return cascade
    rate = min(0.5, max(2.0**-30, n / max(universe_size, 1)))
    inside, outside, held = listed, None, []
    for depth in range(most_levels):
        cascade.levels.append(build_level(inside, n, rate, seed))
        seed += cascade.levels[-1].k
        if outside is None:  # false positives of the first level: distinct keys beside the list
            outside = where_passed(universe, cascade, 1).distinct().join(listed.select("key"), "key", "left_anti").select("key", "a", "b")
        else:
            outside = where_passed(outside, cascade, depth + 1)
        outside = outside.cache()  # about as many as the list; lost parts are computed again
        held.append(outside)
        n = outside.count()
        if not n:
            for df in held:
                df.unpersist()
            return cascade
        inside, outside, rate = outside, inside, 0.5
    raise RuntimeError("keys that agree in 128 bits of hash can't be told apart")


@dataclass(frozen=True)
class UrlFilter:
    """default: verdict where no rule fits.  filter_rules: rules whose filters are sent to tasks at once; a longer list is
    dealt by hash into several cascades that are probed one after the other."""

    default: str = "allow"
    filter_rules: int = 4_000_000

    def apply(self, pages: DataFrame, rules: DataFrame) -> DataFrame:
        """All columns of pages (with `url`) and host, path, rule, verdict.

        rules: (host, path, verdict allow or block); a rule fits its host and all subdomains where the path starts with
        its path; the longest (host and path together) wins, then the longer host; of equal rules that disagree, block.  Rules with a null
        or an empty host fit nothing; repeated rules count once.  A null url, or one without ://, has empty host and path and no rule.
        Repeated pages are judged alike, each for itself.  Columns of pages named like a result are replaced, others pass through.
        """
        pages = pages.drop("host", "path", "rule", "verdict")
        rules = rules.where("host is not null and path is not null and host <> ''").select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
        lengths = sorted(r.n for r in rules.select(F.length("path").alias("n")).distinct().toLocalIterator())
        verdicts = rules.groupBy(F.concat("host", "path").alias("key")).agg(F.max("verdict").alias("verdict"))
        most_labels = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 1
        parsed = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}).withColumn("__concord_keys", keys_of(F.col("host"), F.col("path"), lengths, most_labels))
        universe = hashed(parsed.select(F.explode("__concord_keys").alias("key")))
        size = universe.agg(F.approx_count_distinct("a")).first()[0]
        shards = 1 + rules.count() // self.filter_rules
        found = parsed.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(None).cast("string"))
        for s in range(shards):
            mine = lambda df: df.where(F.pmod("a", F.lit(shards)) == s)  # noqa: E731, B023
            cascades = {v: build_cascade(mine(hashed(verdicts.where(F.col("verdict") == v).select("key"))), mine(universe), size // shards) for v in ("block", "allow")}
            found = self.probe(found, cascades, s, shards)
        return found.drop("__concord_keys").withColumn("verdict", F.coalesce("verdict", F.lit(self.default)))

    def probe(self, df: DataFrame, cascades: dict[str, Cascade], shard: int, shards: int) -> DataFrame:
        """Set rule and verdict where a listed key is longer than the rule found before."""
        given = df.withColumn("__concord_hashes", F.transform("__concord_keys", lambda k: F.struct(F.xxhash64(F.lit(1), k).alias("a"), F.xxhash64(F.lit(2), k).alias("b"))))
        names = df.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = batch.column(batch.num_columns - 1)
                flat = lists.flatten()
                a, b = (flat.field(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1))
                mine = a.view(np.int64) % shards == shard
                verdict = np.full(len(a), "", object)
                for v in ("allow", "block"):
                    verdict[mine & cascades[v].listed(a, b)] = v
                sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy()
                rules, verdicts = batch.column(names.index("rule")).to_pylist(), batch.column(names.index("verdict")).to_pylist()
                keys = batch.column(names.index("__concord_keys"))
                row = np.repeat(np.arange(len(sizes)), sizes)
                start = np.cumsum(sizes) - sizes
                hit = np.flatnonzero(verdict != "")
                first = hit[np.unique(row[hit], return_index=True)[1]]  # keys are longest first
                for at in first.tolist():
                    r = int(row[at])
                    key = keys[r][int(at - start[r])].as_py()
                    if rules[r] is None or len(key) > len(rules[r]):
                        rules[r], verdicts[r] = key, verdict[at]
                columns = {n: batch.column(i) for i, n in enumerate(names)} | {"rule": pa.array(rules, pa.string()), "verdict": pa.array(verdicts, pa.string())}
                yield pa.RecordBatch.from_pydict(columns)

        return given.mapInArrow(run, df.schema)
