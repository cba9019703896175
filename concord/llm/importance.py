"""Importance resampling towards a target: documents are drawn by how much their n-grams' hash buckets are commoner in the target.

Distinct words are mapped to integer ids and n-grams are tuples of ids.  Texts are read once, in stretches: a stretch sends each of its
distinct tuples with its counts, those of one word with the word, and per document the numbers of its tuples within the stretch.  Words of
all stretches meet in the dictionary (id, word); equal tuples of all stretches meet in one row, whose bytes are put together
from the dictionary and hashed once.  Counts of the buckets give gains; a tuple's gain is joined back to the stretches that have the
tuple, and by stretch to the documents, which add up gain times count.

An id is a 63-bit hash of its word.  The dictionary shows whether two words share one; if so, all is done again with other hashes, so
that ids are one to one whenever results are made.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.llm.common import LOWER, Alphabet, bytes_of, discard, materialise, mix, pieces, slim_batches

#: A place is a stretch's number (partition and count) above the number of a tuple within the stretch.
AT_BITS, COUNT_BITS = 28, 13
KINDS = np.array([chr(b).isalnum() or b >= 0x80 for b in range(256)], np.uint8)
LOWERED = np.frombuffer(LOWER, np.uint8)


def alphabet(salt: int) -> Alphabet:
    """Words are runs of a-z, A-Z, 0-9 and bytes from 0x80 on; A-Z count as a-z; another salt gives other hashes."""
    return Alphabet(KINDS, mix(LOWERED.astype(np.uint64), salt + 1) if salt else LOWERED)


def numbered(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct row of some columns first stands, and each row's number among them."""
    if len(columns) == 1:
        _, first, number = np.unique(columns[0], return_index=True, return_inverse=True)
        return first, number
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


class Stretch:
    """Successive texts: words as ids, and the letters of each."""

    def __init__(self, longest: int):
        self.longest, self.known, self.size = longest, np.empty(0, np.int64), 0
        self.letters: list[tuple[np.ndarray, list[bytes]]] = []
        self.ids: list[np.ndarray] = []
        self.words: list[np.ndarray] = []
        self.docs: list[int | None] = []
        self.target: list[bool] = []

    def add(self, doc_id: pa.Array, text: pa.Array, target: pa.Array, by: Alphabet) -> None:
        codes, rows = bytes_of(text)
        h, start, end, first = by.words(codes, rows)
        ids = (h >> np.uint64(1)).astype(np.int64)
        seen, at = np.unique(ids, return_index=True)
        new = ~np.isin(seen, self.known, assume_unique=True)
        letters = LOWERED[codes].tobytes()
        self.known = np.union1d(self.known, seen[new])
        self.ids.append(ids)
        self.words.append(np.diff(first))
        self.docs += doc_id.to_pylist()
        self.target += target.to_pylist()
        self.size += len(codes)
        self.letters.append((seen[new], [letters[s:e] for s, e in zip(start[at[new]].tolist(), end[at[new]].tolist())]))

    def dictionary(self) -> list[bytes]:
        """The letters of the distinct words, in the order of their ids, which is that of the tuples of one word."""
        order = np.argsort(np.concatenate([ids for ids, _ in self.letters])).tolist()
        words = [w for _, part in self.letters for w in part]
        return [words[i] for i in order]

    def tuples(self) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """The distinct tuples, column by column and with -1 past their end; and the row and tuple number of each occurrence."""
        ids, n = np.concatenate(self.ids), np.concatenate(self.words)
        self.ids.clear()
        doc = np.repeat(np.arange(len(n), dtype=np.int32), n)
        columns: list[list[np.ndarray]] = [[] for _ in range(self.longest)]
        docs, numbers, above = [], [], 0
        for length in range(1, self.longest + 1):
            m = max(len(ids) - length + 1, 0)
            whole = doc[:m] == doc[length - 1 :][:m] if length > 1 else slice(None)
            here = [ids[i : i + m][whole] for i in range(length)]
            first, number = numbered(here)
            for i, c in enumerate(columns):
                c.append(here[i][first] if i < length else np.full(len(first), -1, np.int64))
            docs.append(doc[:m][whole])
            numbers.append((number + above).astype(np.int32))
            above += len(first)
            del here, number
        joined = lambda x: x[0] if len(x) == 1 else np.concatenate(x)
        return [joined(c) for c in columns], joined(docs), joined(numbers)


@dataclass(frozen=True)
class ImportanceResampler:
    """longest: features are runs of 1 to so many words.  buckets: of features.  percent: of the documents with at least `least_words`
    words that are drawn.  seed: of the draw.  stretch_bytes: text that a task holds the words of at once (or one piece of 1 MB, or one longer text)."""

    longest: int = 1
    buckets: int = 10_000
    percent: int = 10
    least_words: int = 20
    seed: int = 2024
    stretch_bytes: int = 16 << 20

    @property
    def gram(self) -> list[str]:
        return [f"g{i}" for i in range(self.longest)]

    # -- reading ---------------------------------------------------------------------------------

    def read(self, texts: DataFrame, salt: int) -> DataFrame:
        """Rows of two kinds, from (doc_id, text, target).  Tuples: (place, g0.., n, t, word), with their counts in documents and target rows
        of a stretch, and the letters of those that are one word.  Documents: (place, doc_id, n_words, tuples, counts), the last two as
        bytes of 32-bit integers."""
        longest, most, gram = self.longest, self.stretch_bytes, self.gram
        kinds = {"place": pa.int64(), "doc_id": pa.int64(), "n_words": pa.int64(), "tuples": pa.binary(), "counts": pa.binary(), **{g: pa.int64() for g in gram}, "n": pa.int64(), "t": pa.int64(), "word": pa.binary()}

        def rows(count: int, **given) -> Iterator[pa.RecordBatch]:
            table = pa.RecordBatch.from_pydict({c: pa.array(given[c], k) if c in given else pa.nulls(count, k) for c, k in kinds.items()})
            return (table.slice(a, 20_000) for a in range(0, count, 20_000))

        def told(s: Stretch, number: int) -> Iterator[pa.RecordBatch]:
            """The tuples and documents of a finished stretch."""
            columns, doc, tuple_ = s.tuples()
            if len(columns[0]) >> AT_BITS or number >> COUNT_BITS:
                raise ValueError("a stretch holds too many tuples, or a task too many stretches")
            target = np.array(s.target, bool)
            t = np.bincount(tuple_[target[doc]], minlength=len(columns[0]))
            n = np.bincount(tuple_[~target[doc]], minlength=len(columns[0]))
            place = ((TaskContext.get().partitionId() << COUNT_BITS) + number) << AT_BITS
            words = s.dictionary()
            words += [None] * (len(n) - len(words))
            yield from rows(len(n), place=place + np.arange(len(n)), n=n, t=t, word=words, **dict(zip(gram, columns)))
            key = doc * np.int64(max(len(n), 1)) + tuple_
            del doc, tuple_
            held, count = np.unique(key, return_counts=True)
            del key
            cut = np.searchsorted(held // max(len(n), 1), np.arange(len(target) + 1)).tolist()
            held, count, words = (held % max(len(n), 1)).astype(np.int32), count.astype(np.int32), np.concatenate(s.words)
            mine = np.flatnonzero(~target).tolist()
            for a in range(0, len(mine), 500):
                some = mine[a : a + 500]
                packed = {name: [x[cut[i] : cut[i + 1]].tobytes() for i in some] for name, x in (("tuples", held), ("counts", count))}
                yield from rows(len(some), place=[place + i for i in some], doc_id=[s.docs[i] for i in some], n_words=words[some], **packed)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            by, s, number = alphabet(salt), Stretch(longest), 0
            for batch in batches:
                for piece in pieces(batch):
                    s.add(*piece.columns, by)
                    if s.size >= most:
                        yield from told(s, number)
                        s, number = Stretch(longest), number + 1
            if s.docs:
                yield from told(s, number)

        return texts.mapInArrow(run, "place long, doc_id long, n_words long, tuples binary, counts binary, " + ", ".join(f"{g} long" for g in gram) + ", n long, t long, word binary")

    # -- hashing ---------------------------------------------------------------------------------

    def hashed(self, held: DataFrame) -> DataFrame | None:
        """(g0.., n, t, bucket) of each distinct tuple; null if two words share an id."""
        tuples = held.where("n is not null")
        counts = [F.sum("n").alias("n"), F.sum("t").alias("t")]
        words = tuples.where("word is not null").groupBy("g0").agg(F.min("word").alias("word"), F.max("word").alias("other"), *counts)
        dictionary = materialise(words, "dictionary")
        if not dictionary.where("word <> other").isEmpty():
            discard(dictionary)
            return None
        bucket = lambda feature: (F.crc32(feature) % self.buckets).alias("bucket")
        out = dictionary.select("g0", *[F.lit(-1).cast("long").alias(g) for g in self.gram[1:]], "n", "t", bucket(F.col("word")))
        if self.longest > 1:
            longer = tuples.where("word is null").groupBy(*self.gram).agg(*counts)
            for i, g in enumerate(self.gram):
                longer = longer.join(dictionary.select(F.col("g0").alias(g), F.col("word").alias(f"w{i}")), g, "left")
            feature = F.concat("w0", *[F.coalesce(F.concat(F.lit(b" "), f"w{i}"), F.lit(b"")) for i in range(1, self.longest)])
            out = out.unionByName(longer.select(*self.gram, "n", "t", bucket(feature)))
        out = materialise(out, "hashed")
        discard(dictionary)
        return out

    def gains(self, hashed: DataFrame) -> DataFrame:
        """(bucket, gain), a row for each bucket that has features: `buckets` rows at most."""
        tallies = hashed.groupBy("bucket").agg(F.sum("n").cast("double").alias("s"), F.sum("t").cast("double").alias("t"))
        n, m = tallies.agg(F.coalesce(F.sum("s"), F.lit(0.0)), F.coalesce(F.sum("t"), F.lit(0.0))).first()
        ratio = (F.col("t") + 1) * F.lit(n + self.buckets) / ((F.col("s") + 1) * F.lit(m + self.buckets))
        return tallies.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))

    def weighed(self, held: DataFrame, hashed: DataFrame) -> DataFrame:
        """(place, doc_id, n_words, n_features, weight) per document."""
        priced = hashed.join(F.broadcast(self.gains(hashed)), "bucket").select(*self.gram, "gain")
        stretch = F.shiftright("place", AT_BITS).alias("stretch")
        back = held.where("n > 0").select("place", *self.gram).join(priced, self.gram).select(stretch, F.col("place").bitwiseAND(2**AT_BITS - 1).cast("int").alias("at"), "gain")
        docs = held.where("n_words is not null").select(stretch, "place", "doc_id", "n_words", "tuples", "counts")

        def add_up(docs: pa.Table, back: pa.Table) -> pa.Table:
            at = back.column("at").to_numpy()
            gain = np.zeros(int(at.max(initial=-1)) + 1, np.int64)
            gain[at] = back.column("gain").to_numpy()
            weight, features = [], []
            for t, c in zip(docs.column("tuples").to_pylist(), docs.column("counts").to_pylist()):
                c = np.frombuffer(c, np.int32).astype(np.int64)
                features.append(int(c.sum()))
                weight.append(int(gain[np.frombuffer(t, np.int32)] @ c))
            kept = [docs.column(c) for c in ("place", "doc_id", "n_words")]
            return pa.table([*kept, pa.array(features, pa.int64()), pa.array(weight, pa.int64())], ["place", "doc_id", "n_words", "n_features", "weight"])

        return docs.groupBy("stretch").cogroup(back.groupBy("stretch")).applyInArrow(add_up, "place long, doc_id long, n_words long, n_features long, weight long")

    # -- drawing ---------------------------------------------------------------------------------

    def score(self) -> Column:
        h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{self.seed}:"), F.col("doc_id").cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
        return F.col("weight") + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))

    def drawn(self, scored: DataFrame) -> DataFrame:
        """scored with rank: place in the order by score, downwards, then doc_id; null where it is below the draw.  A sort by ranges: no task
        sees all rows; the driver sees a count for each task."""
        order = [F.col("score").desc(), F.col("doc_id").asc(), F.col("place").asc()]
        sorted_ = scored.repartitionByRange(*order).sortWithinPartitions(*order)
        spot = F.monotonically_increasing_id()  # the task, and the row's number in it in the lower 33 bits
        placed = materialise(sorted_.withColumn("spot", spot), "placed")
        part = F.shiftright("spot", 33)
        sizes = sorted((r.part, r.n) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
        keep = sum(n for _, n in sizes) * self.percent // 100
        before, starts = 0, []
        for p, n in sizes:
            starts.append((p, before))
            before += n
        starts = scored.sparkSession.createDataFrame(starts, "part long, above long")
        rank = F.col("above") + F.col("spot").bitwiseAND(2**33 - 1) + 1
        ranked = placed.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("rank", rank)
        return ranked.withColumn("rank", F.when(F.col("rank") <= keep, F.col("rank")))

    def apply(self, docs: DataFrame, target: DataFrame) -> DataFrame:
        """Per row of `docs` (doc_id, text): doc_id, n_features, weight, score, rank; `target` has a column text.

        Null and wordless texts have no features, weight 0, and are not drawn if least_words is above 0.  Repeated rows count, and are drawn,
        each for itself.  A row without doc_id counts as text but has no score and is not drawn.  With no target rows, or no documents, all
        gains follow from empty counts.  Other columns are ignored.
        """
        slim_batches(docs.sparkSession)
        of = lambda df, doc_id, is_target: df.select(doc_id.cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), F.lit(is_target).alias("target"))
        texts = of(docs, F.col("doc_id"), False).unionByName(of(target, F.lit(None), True))
        salt = 0
        held = materialise(self.read(texts, salt), "held")
        while (hashed := self.hashed(held)) is None:
            discard(held)
            salt += 1
            held = materialise(self.read(texts, salt), "held")
        scored = materialise(self.weighed(held, hashed).withColumn("score", self.score()), "scored")
        discard(held)
        discard(hashed)
        may = (F.col("n_words") >= self.least_words) & F.col("doc_id").isNotNull()
        out = self.drawn(scored.where(may)).unionByName(scored.where(~may).withColumn("rank", F.lit(None).cast("long")), allowMissingColumns=True)
        return out.select("doc_id", "n_features", "weight", "score", "rank")
