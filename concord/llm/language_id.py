"""Language identification by rank-order profiles of character n-grams and out-of-place distance."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.common import STRETCH, characters_of, extend, letters, materialise, pieces, slim_batches

Counts = tuple[np.ndarray, np.ndarray]  # sorted n-grams and how often each is there
BLANK = np.uint64(32)


def grams(codes: np.ndarray, rows: np.ndarray, longest: int) -> Iterator[np.ndarray]:
    """Per row, the n-grams of its words, each word padded by a blank on both sides; an n-gram is its code points, 21 bits each."""
    alphabet = letters()
    _, start, end, first = alphabet.words(codes, rows)
    # every row: blank, word, blank, word, .. blank
    size = end - start
    low = alphabet.lowered[codes[alphabet.kinds[codes] > 0]].astype(np.uint64)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(first))
    word_at = np.cumsum(size) - size + np.arange(len(size)) + 1 + row  # a blank after each word and one before each row
    padded = np.full(int(size.sum()) + len(size) + len(rows) - 1, BLANK)
    padded[np.arange(len(low)) + np.repeat(word_at - (np.cumsum(size) - size), size)] = low
    letters_before = np.concatenate(([0], np.cumsum(size)))[first]
    bounds = letters_before + first + np.arange(len(rows))
    is_blank = padded == BLANK
    crossing = np.zeros(len(padded) + 1, bool)
    crossing[bounds] = True  # where a row begins
    parts, value, broken = [], np.zeros(len(padded), np.uint64), np.zeros(len(padded), bool)
    for n in range(1, longest + 1):
        inner = len(padded) - n + 1
        if inner <= 0:
            break
        value = value[:inner] | (padded[n - 1 :] << np.uint64(21 * (n - 1)))
        if n > 1:  # neither over a row's end nor over a blank inside
            broken = broken[:inner] | crossing[n - 1 : len(padded)] | (is_blank[n - 2 : len(padded) - 1] if n > 2 else False)
        good = np.flatnonzero(~is_blank[:inner] if n == 1 else ~broken)
        parts.append((value[good], np.searchsorted(good, bounds)))
    for r in range(len(rows) - 1):
        yield np.concatenate([np.empty(0, np.uint64), *[v[b[r] : b[r + 1]] for v, b in parts]])


def counted(values: np.ndarray) -> Counts:
    x = np.sort(values)
    new = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))[: len(x)])
    return x[new], np.diff(np.concatenate((new, [len(x)])))


def added(parts: list[Counts]) -> Counts:
    g, c = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.uint64), np.empty(0, np.int64))
    order = np.argsort(g, kind="stable")
    g, c = g[order], c[order]
    new = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1]))[: len(g)])
    return g[new], np.add.reduceat(c, new) if len(g) else c


def gram_counts(texts: list[str | None], longest: int) -> Iterator[Counts]:
    """Counts of each whole text; long texts are worked through in stretches that end between words."""
    codes, rows = characters_of(texts)
    i = 0
    while i < len(texts):
        if rows[i + 1] - rows[i] <= STRETCH:
            j = max(i + 1, int(np.searchsorted(rows, rows[i] + STRETCH, "right")) - 1)
            yield from map(counted, grams(codes[rows[i] : rows[j]], rows[i : j + 1] - rows[i], longest))
            i = j
            continue
        held, at = [], int(rows[i])
        while at < rows[i + 1]:
            stop = min(letters().pause(codes, rows, at + STRETCH), int(rows[i + 1]))
            held.append(counted(next(grams(codes[at:stop], np.array([0, stop - at]), longest))))
            held, at = ([added(held)] if len(held) > 7 else held), stop
        yield added(held)
        i += 1


def ranked(found: Counts, size: int) -> np.ndarray:
    """The most frequent grams, most frequent first; ties by code points."""
    return found[0][np.argsort(-found[1], kind="stable")[:size]]


@dataclass(frozen=True)
class LanguageProfiles:
    """longest: n-grams of 1 to `longest` characters, 3 at most.  size: grams in a profile.  fit_rows: labelled rows of a language
    that a profile is expected to be fitted on; a language with more has each row taken with probability fit_rows / rows,
    by a hash of its doc_id.  min_score: a document scoring less is rejected by accept()."""

    longest: int = 3
    size: int = 300
    fit_rows: int = 2_000
    min_score: float = 0.02

    def fit(self, labelled: DataFrame) -> dict[str, np.ndarray]:
        """Profiles by language from (doc_id, text, lang); rows without text or lang teach nothing."""
        if not 1 <= self.longest <= 3:
            raise ValueError("longest: 1 to 3")
        longest, size = self.longest, self.size
        slim_batches(labelled.sparkSession)
        labelled = labelled.where("lang is not null and text is not null")
        # written first, so that its size is known and few languages are joined by broadcast
        rates = materialise(labelled.groupBy("lang").agg((F.lit(1_000_000.0) * self.fit_rows / F.count("*")).alias("rate")), "rates")
        chosen = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.lit(7)), F.lit(1_000_000)) < F.col("rate")
        taken = labelled.select("doc_id", "text", "lang").join(rates, "lang").where(chosen)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[str, list[Counts]] = {}
            for batch in batches:
                for piece in pieces(batch):
                    for found, lang in zip(gram_counts(piece.column(0).to_pylist(), longest), piece.column(1).to_pylist()):
                        mine = total.setdefault(lang, [])
                        mine.append(found)
                        if len(mine) > 63:
                            mine[:] = [added(mine)]
            for lang, mine in total.items():
                g, c = added(mine)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(g), pa.string()), "gram": pa.array(g.view(np.int64)), "n": pa.array(c, pa.int64())})

        counts = taken.select(F.col("text").cast("string"), "lang").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        top = counts.groupBy("lang").agg(F.expr(f"slice(array_sort(collect_list(struct(-n as n, gram))), 1, {size})").alias("grams"))
        return {r.lang: np.array([g.gram for g in r.grams], np.int64).view(np.uint64) for r in top.toLocalIterator()}

    def predict(self, docs: DataFrame, profiles: dict[str, np.ndarray]) -> DataFrame:
        """All columns of docs, with lang_pred and score (0 to 1: how much nearer than a document that shares no gram
        with the profile).  lang_pred is `und`, with score 0, for null texts, texts without letters, or no profiles;
        ties go to the first language by name.  Columns of docs named lang_pred or score are replaced."""
        longest, size = self.longest, self.size
        slim_batches(docs.sparkSession)
        langs = sorted(profiles)
        docs = docs.drop("lang_pred", "score")
        everything = np.unique(np.concatenate([profiles[x] for x in langs])) if langs else np.empty(0, np.uint64)
        place = np.full((len(langs), len(everything) + 1), -1, np.int64)
        for i, lang in enumerate(langs):
            place[i, np.searchsorted(everything, profiles[lang])] = np.arange(len(profiles[lang]))

        def judge(found: Counts) -> tuple[str, float]:
            top = ranked(found, size)
            if not len(top) or not len(everything):
                return "und", 0.0
            at = np.minimum(np.searchsorted(everything, top), len(everything) - 1)
            at = np.where(everything[at] == top, at, len(everything))
            there = place[:, at]
            out = np.where(there >= 0, np.abs(there - np.arange(len(top))), size).sum(1)
            best = int(np.argmin(out))
            return langs[best], float(1 - out[best] / (size * len(top)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch):
                    got = [judge(found) for found in gram_counts(piece.column(piece.num_columns - 1).to_pylist(), longest)]
                    yield pa.RecordBatch.from_arrays(
                        [*piece.columns[:-1], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                        [*piece.schema.names[:-1], "lang_pred", "score"],
                    )

        given = docs.withColumn("__concord_text", F.col("text").cast("string"))
        return given.mapInArrow(run, extend(docs.schema, "lang_pred string, score double"))

    def accept(self, judged: DataFrame) -> DataFrame:
        """Rows of predict() in a known language."""
        return judged.where((F.col("lang_pred") != "und") & (F.col("score") >= self.min_score))
