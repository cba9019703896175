"""Toxicity by two Kneser-Ney models, one of toxic and one of ordinary texts, over shared backoff counts.

P_c(w | v) = max(n_c(v w) - D2, 0) / n_c(v .) + b_c(v) P_c(w)
P_c(w)     = max(m_c(w) - D1, 0) / m_c(.) + b_c P(w),   P(w) = N(. w) / N(. .), distinct left neighbours in the whole corpus

b_c is what the discounts leave, so that each model sums to 1 over the words of the corpus; it is 1 where the class has not met v.  n_c counts the distinct words before a bigram in texts of class c, and m_c the distinct left neighbours of a word in them, so
that copies of a text count as one.  An expression met in fewer than `least` contexts of the labelled sample has no class
counts of its own: its mass goes to the backoff, so what is rare is smoothed by the shared counts alone.  The discounts are
n1 / (n1 + 2 n2), from how many expressions are met once and twice.  The shared counts are of the distinct pairs of
neighbours of all texts, whatever words they are of: N(. w) is kept of the words with class counts, as other words are as
likely, up to b_c, in both classes, and N(. .) is the number of all pairs.  Words and pairs are told apart by hashes.

A text is judged by the difference of its two log-likelihoods, each divided by its number of words: that of the whole text, and
the greatest of its passages of 2, 4 and 8 words.  A logistic curve fitted on labelled rows that the counts have not seen
turns these into a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.common import ODD, Alphabet, bucket_of, bucketwise, characters_of, discard, extend, joined, lower_codes, materialise, mix, packed, pieces, slim_batches

PASSAGES = (2, 4, 8)
FEATURES = ["__whole", *[f"__passage{n}" for n in PASSAGES]]
#: Stands before the first word of a text.
START = np.uint64(1)


@lru_cache(1)
def worded() -> Alphabet:
    """Over code points: words are runs of letters, digits and underscores."""
    kinds = np.zeros(0x110000, np.uint8)
    kinds[[c for c in range(0x110000) if chr(c).isalnum() or c == 95]] = 1
    return Alphabet(kinds, lower_codes())


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words, where each text's words begin)."""
    h, _, _, first = worded().words(*characters_of(texts))
    return h, first


def before(h: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """The word n places before each word, START where the text begins in between."""
    place = np.arange(len(h)) - np.repeat(first[:-1], np.diff(first))
    return np.where(place >= n, np.roll(h, n), START)


def pair_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(v * ODD + w, 3)


def distinct(rows: np.ndarray) -> np.ndarray:
    """Distinct rows of a matrix."""
    rows = rows[np.lexsort(rows.T)]
    return rows[np.concatenate(([True], (rows[1:] != rows[:-1]).any(1)))[: len(rows)]]


@dataclass
class Ratios:
    """log P_toxic - log P_ordinary: of words and bigrams with class counts, sorted by hash, and of all other words; a bigram without
    has that of its word and of b(v) of its context, which is 0 for contexts that are not listed."""

    words: np.ndarray
    word_ratio: np.ndarray
    pairs: np.ndarray
    pair_ratio: np.ndarray
    contexts: np.ndarray
    context_ratio: np.ndarray
    other: float

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Per text: the mean ratio of its words, and the greatest of its passages; 0 without words."""
        h, first = words_of(texts)
        out = np.zeros((len(texts), len(FEATURES)))
        some = np.flatnonzero(np.diff(first))
        if not len(h) or not len(some):
            return out
        v = before(h, first, 1)
        x = looked_up(pair_key(v, h), self.pairs, self.pair_ratio, np.nan)
        x = np.where(np.isnan(x), looked_up(h, self.words, self.word_ratio, self.other) + looked_up(v, self.contexts, self.context_ratio, 0.0), x)
        starts, sizes = first[:-1][some], np.diff(first)[some]
        sums = np.concatenate(([0.0], np.cumsum(x)))
        out[some, 0] = (sums[first[1:][some]] - sums[starts]) / sizes
        begin = np.repeat(starts, sizes)
        for i, n in enumerate(PASSAGES):
            low = np.maximum(np.arange(1, len(x) + 1) - n, begin)
            out[some, i + 1] = np.maximum.reduceat((sums[1:] - sums[low]) / n, starts)
        return out


def looked_up(x: np.ndarray, keys: np.ndarray, values: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(x), missing)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return np.where(keys[at] == x, values[at], missing)


@dataclass(frozen=True)
class KneserNeyToxicity:
    """fit_rows: labelled rows of a class that are expected in the fitted sample; a class with more has each row taken with
    probability fit_rows / rows, by a hash of doc_id.  least: contexts in the sample from which an expression has class counts.
    order: 1 for words alone, 2 for bigrams too.  bucket: pairs that a task holds at once, on average.  threshold: least score that
    is predicted toxic."""

    fit_rows: int = 6_000
    least: int = 8
    order: int = 2
    bucket: int = 2_000_000
    threshold: float = 0.7

    def fit(self, docs: DataFrame, labels: DataFrame) -> tuple[Ratios, np.ndarray]:
        """docs: the whole corpus (doc_id, text).  labels: (doc_id, toxic) to learn from; a document labelled twice is toxic
        if any label says so, null labels teach nothing."""
        slim_batches(docs.sparkSession)
        labels = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        rows = {r.toxic: r.n for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).toLocalIterator()}
        share = {y: min(1.0, self.fit_rows / max(rows.get(y, 0), 1)) for y in (0, 1)}
        taken = labels.where(F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(1_000_000)) < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]) * 1_000_000)
        # about 2 * fit_rows ids, whatever the corpus holds
        sample = docs.join(F.broadcast(taken), "doc_id").select("toxic", F.col("text").cast("string").alias("text"), (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(10)) < 7).alias("counted"))
        sample = materialise(sample, "sample")
        ratios = self.ratios(docs, sample.where("counted").select("toxic", "text"))
        weights = self.calibrate(ratios, sample.where("not counted").select("toxic", "text"), share)
        discard(sample)
        return ratios, weights

    # -- counts ----------------------------------------------------------------------------------

    def counts(self, sample: DataFrame) -> DataFrame:
        """(v, w, n0, n1): distinct words before the bigram v w in texts of each class, as hashes; v is null for the distinct left
        neighbours of w."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[np.ndarray] = []

            def flush() -> pa.RecordBatch:
                rows = distinct(np.concatenate([np.empty((0, 4), np.uint64), *held])).view(np.int64)
                held.clear()
                return pa.RecordBatch.from_arrays([pa.array(rows[:, i].copy()) for i in range(4)], ["u", "v", "w", "toxic"])

            for batch in batches:
                for piece in pieces(batch):
                    h, first = words_of(piece.column(1).to_pylist())
                    toxic = np.repeat(np.array(piece.column(0).to_pylist()) == 1, np.diff(first))
                    held.append(distinct(np.stack((before(h, first, 2), before(h, first, 1), h, toxic.astype(np.uint64)), 1)))
                    if sum(map(len, held)) > 500_000:
                        yield flush()
            yield flush()

        found = sample.mapInArrow(run, "u long, v long, w long, toxic long").distinct()
        each = [F.sum(F.when(F.col("toxic") == y, 1).otherwise(0)).alias(f"n{y}") for y in (0, 1)]
        bigrams = materialise(found.groupBy("v", "w").agg(*each), "bigrams")
        lefts = bigrams.groupBy(F.lit(None).cast("long").alias("v"), "w").agg(*[F.sum(F.when(F.col(f"n{y}") > 0, 1).otherwise(0)).alias(f"n{y}") for y in (0, 1)])
        out = materialise(lefts if self.order == 1 else bigrams.unionByName(lefts), "class-counts")
        discard(bigrams)
        return out

    def ratios(self, docs: DataFrame, sample: DataFrame) -> Ratios:
        """Only expressions with class counts come to the driver: fewer than the sample's words / `least`."""
        counts = self.counts(sample)
        kinds = counts.groupBy(F.col("v").isNull().alias("single")).agg(*[F.sum(F.when(F.col(f"n{y}") == k, 1).otherwise(0)).alias(f"met{k}_{y}") for y in (0, 1) for k in (1, 2)])
        discount = {True: 0.5, False: 0.5}
        for r in kinds.collect():  # two rows
            once, twice = r.met1_0 + r.met1_1, r.met2_0 + r.met2_1
            discount[r.single] = once / (once + 2 * twice) if once and twice else 0.5
        own = F.col("n0") + F.col("n1") >= self.least
        d = F.when(F.col("v").isNull(), discount[True]).otherwise(discount[False])
        spare = [F.sum(F.when(own, F.least(d, F.col(f"n{y}"))).otherwise(F.col(f"n{y}"))).alias(f"spare{y}") for y in (0, 1)]
        context = counts.groupBy("v").agg(F.sum("n0").alias("sum0"), F.sum("n1").alias("sum1"), *spare)
        context = materialise(context, "contexts")
        kept = counts.where(own).join(context, counts["v"].eqNullSafe(context["v"])).select(counts["v"].isNull().alias("single"), F.coalesce(counts["v"], F.lit(0)).alias("v"), "w", "n0", "n1", "sum0", "sum1", "spare0", "spare1").toPandas()
        masses = context.where("v is null").first()
        discard(counts)
        discard(context)
        if masses is None:
            none = np.empty(0, np.uint64), np.empty(0)
            return Ratios(*none, *none, *none, 0.0)
        single = kept[kept["single"].astype(bool)]
        words, order = np.unique(single["w"].to_numpy(np.int64).view(np.uint64), return_index=True)
        single = single.iloc[order]
        shared = self.shared(docs, words)
        back = {y: masses[f"spare{y}"] / masses[f"sum{y}"] if masses[f"sum{y}"] else 1.0 for y in (0, 1)}
        p = {y: np.maximum(single[f"n{y}"].to_numpy(float) - discount[True], 0) / max(masses[f"sum{y}"], 1) + back[y] * shared for y in (0, 1)}
        other = float(np.log(back[1]) - np.log(back[0]))
        double = kept[~kept["single"].astype(bool)]
        v, w = (double[c].to_numpy(np.int64).view(np.uint64) for c in ("v", "w"))
        at = np.minimum(np.searchsorted(words, w), max(len(words) - 1, 0))
        q, left = {}, {}
        for y in (0, 1):
            met = double[f"sum{y}"].to_numpy(float)
            left[y] = np.where(met > 0, double[f"spare{y}"].to_numpy(float) / np.maximum(met, 1), 1.0)
            q[y] = np.maximum(double[f"n{y}"].to_numpy(float) - discount[False], 0) / np.maximum(met, 1) + left[y] * (p[y][at] if len(words) else 1.0)
        keys, order = np.unique(pair_key(v, w), return_index=True)
        contexts, some = np.unique(v, return_index=True)
        return Ratios(words, np.log(p[1] / p[0]), keys, np.log(q[1] / q[0])[order], contexts, np.log(left[1] / left[0])[some], other)

    def shared(self, docs: DataFrame, words: np.ndarray) -> np.ndarray:
        """P(w) of the words: their distinct left neighbours among the distinct pairs of neighbours of all rows of docs.

        A pair is sent as 63 bits: a hash of both words, or, if the right one is among `words`, its number and a hash of the left one.
        """
        sent = docs.sparkSession.sparkContext.broadcast(words)  # fewer than the sample's words / least
        number_bits = np.uint64(max(1, len(words)).bit_length())
        known = np.uint64(1 << 63)
        buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), (docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0) // (6 * self.bucket))

        def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[np.ndarray] = []

            def flush() -> Iterator[pa.RecordBatch]:
                codes = np.concatenate([np.empty(0, np.uint64), *held])
                held.clear()
                codes.sort()
                codes = codes[np.concatenate(([True], codes[1:] != codes[:-1]))[: len(codes)]]
                for at in range(0, len(codes), 500_000):
                    part = codes[at : at + 500_000]
                    yield packed(bucket_of(part, buckets), True, part.view(np.int64), None, None)

            for batch in batches:
                for piece in pieces(batch):
                    h, first = words_of(piece.column(0).to_pylist())
                    left = before(h, first, 1)
                    number = looked_up(h, sent.value, np.arange(len(sent.value)), -1)
                    own = mix(left, 9) >> (number_bits + np.uint64(1)) << number_bits | number.astype(np.int64).astype(np.uint64)
                    held.append(np.unique(np.where(number >= 0, own | known, pair_key(left, h) & ~known)))
                    if sum(map(len, held)) > 4_000_000:
                        yield from flush()
            yield from flush()

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, rows in bucketwise(batches):
                codes = np.unique(joined([x[1:2] for x in rows], 1)[0].view(np.uint64))
                own = codes[codes >= known]
                word, n = np.unique(own & np.uint64((1 << int(number_bits)) - 1), return_counts=True)
                word, n = np.append(word.astype(np.int64), -1), np.append(n, len(codes) - len(own))
                yield pa.RecordBatch.from_pydict({"word": pa.array(word), "n": pa.array(n.astype(np.int64))})

        dealt = docs.select(F.col("text").cast("string")).mapInArrow(pairs, "bucket long, info boolean, a binary, b binary, c binary").repartition("bucket").sortWithinPartitions("bucket")
        found = dealt.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toPandas()  # a row a word of `words`, one for all others
        sent.destroy()
        n, number = np.zeros(len(words) + 1), found["word"].to_numpy(np.int64)
        n[number] = found["n"].to_numpy(float)
        return np.maximum(n[: len(words)], 1.0) / max(n.sum(), 1.0)

    # -- scores ----------------------------------------------------------------------------------

    def _features(self, rows: DataFrame, ratios: Ratios) -> DataFrame:
        """All columns but the last, a text, and its FEATURES."""
        known = rows.sparkSession.sparkContext.broadcast(ratios)  # fewer entries than the sample's words / least

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch):
                    x = known.value.features(piece.column(piece.num_columns - 1).to_pylist())
                    yield pa.RecordBatch.from_arrays([*piece.columns[:-1], *[pa.array(x[:, i].copy()) for i in range(len(FEATURES))]], [*piece.schema.names[:-1], *FEATURES])

        return rows.mapInArrow(run, extend(rows.drop(rows.columns[-1]).schema, ", ".join(f"{f} double" for f in FEATURES)))

    def calibrate(self, ratios: Ratios, rows: DataFrame, share: dict[int, float]) -> np.ndarray:
        """Weights of 1 and FEATURES, by damped Newton steps; rows count as many as they stand for."""
        got = self._features(rows, ratios).toPandas()
        y = (got["toxic"].to_numpy() == 1).astype(float)
        x = got[FEATURES].to_numpy(float).reshape(len(got), len(FEATURES))
        middle, spread = (x.mean(0), x.std(0) + 1e-9) if len(x) else (np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
        x = np.column_stack([np.ones(len(got)), (x - middle) / spread])
        w = np.array([-2.0] + [0.0] * len(FEATURES))
        weight = np.where(y == 1, 1 / share[1], 1 / share[0])
        for _ in range(200 if len(x) else 0):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            gradient = x.T @ (weight * (p - y)) + 0.5 * np.concatenate(([0.0], w[1:]))
            step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 0.5 * np.eye(len(w)), gradient)
            w = w - step * min(1.0, 1 / max(np.abs(step).max(), 1e-9))
        return np.concatenate(([w[0] - (w[1:] * middle / spread).sum()], w[1:] / spread))

    def score(self, docs: DataFrame, ratios: Ratios, weights: np.ndarray) -> DataFrame:
        """All columns of docs with score and predicted.  A null text, or one without words, scores like one whose words are as
        likely in both classes.  Columns of docs named score or predicted are replaced; repeated rows score alike."""
        slim_batches(docs.sparkSession)
        rows = docs.drop("score", "predicted").withColumn("__concord_text", F.col("text").cast("string"))
        logit = F.lit(float(weights[0]))
        for f, w in zip(FEATURES, weights[1:]):
            logit = logit + float(w) * F.col(f)
        score = 1 / (1 + F.exp(-F.greatest(F.least(logit, F.lit(30.0)), F.lit(-30.0))))
        return self._features(rows, ratios).withColumn("score", score).drop(*FEATURES).withColumn("predicted", (F.col("score") >= self.threshold).cast("int"))
