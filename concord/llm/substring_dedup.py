"""Substring dedup: hash lines and runs of words, keep the earliest ranked occurrence of each digest, remove the rest.

Units are the lines of a text, of any length, normalised (lower case, single blanks), and runs of window // 2 + 1 words: of each
`window` consecutive words the run with the least hash is a unit too, wherever lines end, so two places with the same
`window` words hold a common run (winnowing).  Runs found in a longer passage leave no gap; fewer than window // 2 words at
either end may stay.  In scripts written without blanks each character is a word.  Digests of 128 bits are grouped over the
whole corpus.  The rank of an occurrence is (doc_id, start); all but the first are removed, by their offsets in the original text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.common import ODD, Alphabet, characters_of, discard, extend, lower_codes, materialise, mix, pieces, rolling, slim_batches

#: Scripts without blanks between words: Thai, Lao, Myanmar, Khmer, kana, Han.
BARE = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]
SPANS = "array<struct<start: int, end: int>>"
NEWLINE = 10


@lru_cache(1)
def spaced() -> Alphabet:
    """Over code points: words are what blanks part; a character of a bare script is a word."""
    kinds = np.ones(0x110000, np.uint8)
    for low, high in BARE:
        kinds[low : high + 1] = 2
    kinds[[c for c in range(0x3001) if chr(c).isspace()]] = 0
    return Alphabet(kinds, lower_codes())


Units = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # text, digest in two halves, start, end


def units(texts: list[str | None], window: int) -> Units:
    """The lines and runs of whole texts; offsets in characters.  A line's span holds its newline."""
    codes, rows = characters_of(texts)
    h, start, end, first = spaced().words(codes, rows)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    if not len(h):
        return tuple(np.empty(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64))
    newline = np.flatnonzero(codes == NEWLINE)
    line = np.searchsorted(newline, start)
    new = np.flatnonzero(np.concatenate(([True], (line[1:] != line[:-1]) | (text[1:] != text[:-1]))))
    size = np.diff(np.concatenate((new, [len(h)])))
    placed = h + (np.arange(len(h)) - np.repeat(new, size)).astype(np.uint64) * ODD
    found = [(text[new], *(mix(np.add.reduceat(mix(placed, s), new), s + 4) for s in (1, 2)), *line_spans(newline, line[new], rows[text[new]], rows[text[new] + 1]))]
    length = window // 2 + 1
    width = window - length + 1
    halves = [rolling(x, length, s) for x, s in ((h, 7), (mix(h, 9), 8))]
    for r in np.flatnonzero(np.diff(first) >= window).tolist():
        a, n = int(first[r]), int(first[r + 1] - first[r]) - length + 1
        # of equal ones the last of a window
        least = np.unique(np.arange(width - 1, n) - sliding_window_view(halves[0][a : a + n], width)[:, ::-1].argmin(1)) + a
        found.append((np.full(len(least), r), halves[0][least], halves[1][least], start[least], end[least + length - 1]))
    text, hi, lo, start, end = (np.concatenate(x) for x in zip(*found))
    return text, hi, lo, start - rows[text], end - rows[text]


def line_spans(newline: np.ndarray, line: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where lines begin and end, by the number of newlines before them, within texts from `low` to `high`."""
    marks = np.concatenate(([-1], newline, [np.iinfo(np.int64).max - 1]))
    return np.maximum(marks[line] + 1, low), np.minimum(marks[line + 1] + 1, high)


def without(text: str, spans: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """The text without the spans, and the spans merged."""
    merged: list[list[int]] = []
    for s, e in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        elif merged and text[merged[-1][1] : s].strip(" ") == "":
            merged[-1][1] = e
        else:
            merged.append([s, e])
    out, at = [], 0
    for s, e in merged:
        out.append(text[at:s])
        at = e
    return "".join([*out, text[at:]]), [(s, e) for s, e in merged]


@dataclass(frozen=True)
class SubstringDedup:
    """window: words that no two places have in common afterwards, wherever they start.  hot: a digest that holds more than
    1 / hot of all repeated units (there are fewer than `hot` of these) is joined in `salts` parts."""

    window: int = 50
    hot: int = 1_000
    salts: int = 64

    def occurrences(self, docs: DataFrame) -> DataFrame:
        """(hi, lo, doc_id, body, start, end, again): the units of every document; body is a hash of its text, `again` where the same
        text has the unit before."""
        window = self.window

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch):
                    text, hi, lo, start, end = units(piece.column(2).to_pylist(), window)
                    order = np.lexsort((end, start, lo, hi, text))
                    text, hi, lo, start, end = (x[order] for x in (text, hi, lo, start, end))
                    again = np.concatenate(([False], (text[1:] == text[:-1]) & (hi[1:] == hi[:-1]) & (lo[1:] == lo[:-1])))[: len(text)]
                    head = np.maximum.accumulate(np.where(again, 0, np.arange(len(text)))) if len(text) else text
                    start = np.where(again, np.maximum(start, end[head]), start)  # what overlaps the first one starts after it
                    good = start < end
                    columns = [hi.view(np.int64), lo.view(np.int64), piece.column(0).to_numpy()[text], piece.column(1).to_numpy()[text], start.astype(np.int32), end.astype(np.int32), again]
                    yield pa.RecordBatch.from_arrays([pa.array(x[good]) for x in columns], ["hi", "lo", "doc_id", "body", "start", "end", "again"])

        given = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), F.xxhash64("text"), F.col("text").cast("string"))
        return given.mapInArrow(run, "hi long, lo long, doc_id long, body long, start int, end int, again boolean")

    def removals(self, docs: DataFrame) -> DataFrame:
        """(doc_id, body, spans): what to remove, one row per text that has anything."""
        found = materialise(self.occurrences(docs), "units")
        once = found.where("not again")
        groups = once.groupBy("hi", "lo").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n")).where("first <> last")
        repeated = materialise(groups.drop("last"), "repeated")
        is_hot = F.col("n") * self.hot > (repeated.agg(F.sum("n")).first()[0] or 0)
        salted = repeated.withColumn("salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(self.salts - 1))).otherwise(F.array(F.lit(0))))).drop("n")
        hot = repeated.where(is_hot).select("hi", "lo", F.lit(True).alias("is_hot"))  # fewer than self.hot rows
        salt = F.when(F.col("is_hot"), F.pmod(F.xxhash64("doc_id", "start"), F.lit(self.salts)).cast("int")).otherwise(0)
        dealt = once.join(F.broadcast(hot), ["hi", "lo"], "left").withColumn("salt", salt).drop("is_hot")
        later = dealt.join(salted, ["hi", "lo", "salt"]).where("doc_id <> first").select("doc_id", "body", "start", "end")
        later = later.unionByName(found.where("again").select("doc_id", "body", "start", "end"))
        out = materialise(later.groupBy("doc_id", "body").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans")
        discard(found)
        discard(repeated)
        return out

    def apply(self, docs: DataFrame) -> DataFrame:
        """All columns of docs with `text` cleaned, and n_removed (merged spans), removed_chars, spans (in the original).

        Null and wordless texts and rows without doc_id stay as they are.  Rows that share a doc_id share its
        rank: a unit that no smaller doc_id has stays in each of them once.  Columns of docs named like a result are replaced.
        """
        slim_batches(docs.sparkSession)
        results = ["n_removed", "removed_chars", "spans"]
        docs = docs.drop(*results)
        gone = self.removals(docs).withColumnsRenamed({"doc_id": "__concord_doc", "body": "__concord_body", "spans": "__concord_spans"})
        on = (docs["doc_id"] == gone["__concord_doc"]) & (F.xxhash64(docs["text"]) == gone["__concord_body"])
        marked = docs.join(gone, on, "left").drop("__concord_doc", "__concord_body")
        names, at = docs.columns, docs.columns.index("text")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch):
                    texts, merged, chars = [], [], []
                    for text, spans in zip(piece.column(at).to_pylist(), piece.column(piece.num_columns - 1).to_pylist()):
                        clean, cut = without(text, [(x["start"], x["end"]) for x in spans]) if spans else (text, [])
                        texts.append(clean)
                        merged.append([{"start": s, "end": e} for s, e in cut])
                        chars.append(len(text or "") - len(clean or ""))
                    columns = [pa.array(texts, pa.string()) if i == at else piece.column(i) for i in range(len(names))]
                    columns += [pa.array([len(x) for x in merged], pa.int64()), pa.array(chars, pa.int64()), pa.array(merged, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
                    yield pa.RecordBatch.from_arrays(columns, [*names, *results])

        return marked.mapInArrow(run, extend(docs.schema, f"n_removed long, removed_chars long, spans {SPANS}"))
