"""Benchmark decontamination: an FM-index per shard of documents, searched backwards for benchmark windows.

A word outside the benchmark's vocabulary, or a pair of neighbours that is no benchmark pair, can't be in an
occurrence.  So a shard (a bounded stretch of whole documents) only indexes runs of words whose neighbours are
benchmark pairs; nothing is lost by that.  Windows are searched through the ranks of a wavelet matrix over the
runs' Burrows-Wheeler transform, all windows at once; occurrences are located from sampled suffix positions and
their spans merged.  Whole documents stay in one task and nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from concord.llm.common import discard, extend, materialise, pieces, slim_batches

#: ASCII bytes that are no word characters become spaces, A-Z become a-z; bytes from 0x80 on are word characters.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 0x80 else 32 for b in range(256)
)
WORD = re.compile(rb"[^ ]+")


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


class WaveletMatrix:
    """rank(symbol, position) over an integer sequence, for arrays of symbols and positions at once."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.bits = max(1, int(symbols - 1).bit_length())
        self.levels: list[tuple[np.ndarray, int]] = []
        for b in range(self.bits - 1, -1, -1):
            bit = (seq >> b) & 1
            ones = np.concatenate(([0], np.cumsum(bit))).astype(np.int32)
            self.levels.append((ones, len(seq) - int(ones[-1])))
            seq = np.concatenate((seq[bit == 0], seq[bit == 1]))
        starts = np.zeros(1 << self.bits, np.int64)
        values, first = np.unique(seq, return_index=True)
        starts[values] = first
        self.starts = starts

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for depth, (ones, zeros) in enumerate(self.levels):
            up = (symbol >> (self.bits - 1 - depth)) & 1
            at = np.where(up == 1, zeros + ones[at], at - ones[at])
        return at - self.starts[symbol]

    def access(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        for ones, zeros in self.levels:
            up = ones[at + 1] - ones[at]
            out = out * 2 + up
            at = np.where(up == 1, zeros + ones[at], at - ones[at])
        return out


class FMIndex:
    """Over a sequence of symbols >= 1; symbol 0 is the end mark it adds."""

    def __init__(self, seq: np.ndarray, symbols: int, sample: int = 8):
        seq = np.concatenate((seq, [0])).astype(np.int64)
        n = len(seq)
        rank = np.unique(seq, return_inverse=True)[1].astype(np.int64)
        step = 1
        while True:  # prefix doubling
            after = np.zeros(n, np.int64)
            after[: max(n - step, 0)] = rank[step:] + 1
            pair = rank * (n + 1) + after
            order = np.argsort(pair, kind="stable")
            new = np.empty(n, np.int64)
            new[order] = np.concatenate(([0], np.cumsum(np.diff(pair[order]) != 0)))
            rank = new
            if rank[order[-1]] == n - 1:
                break
            step *= 2
        self.n = n
        self.wavelet = WaveletMatrix(seq[order - 1], symbols)
        self.below = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=symbols))))
        self.sampled = (order % sample == 0)
        self.sample_rank = np.concatenate(([0], np.cumsum(self.sampled)))
        self.samples = order[self.sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of the rows of `patterns` (all of one length)."""
        lo = np.zeros(len(patterns), np.int64)
        hi = np.full(len(patterns), self.n, np.int64)
        for c in patterns.T[::-1]:
            lo = self.below[c] + self.wavelet.rank(c, lo)
            hi = self.below[c] + self.wavelet.rank(c, hi)
            lo = np.minimum(lo, self.n)
            hi = np.clip(hi, lo, self.n)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step backwards to the nearest sampled position."""
        rows, out, back = rows.copy(), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            r = rows[todo]
            at = self.sampled[r]
            out[todo[at]] = self.samples[self.sample_rank[r[at]]] + back[todo[at]]
            todo, r = todo[~at], r[~at]
            c = self.wavelet.access(r)
            rows[todo] = self.below[c] + self.wavelet.rank(c, r)
            back[todo] += 1
        return out


class Windows:
    """The distinct windows of a block of benchmark items, as rows of word numbers grouped by length.  An item without id has
    windows, but is in no list of items."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], size: int):
        self.vocabulary: dict[bytes, int] = {}
        by: dict[tuple[int, ...], set[str]] = {}
        for item, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            for at in range(max(1, len(ids) - size + 1) if ids else 0):
                by.setdefault(tuple(ids[at : at + size]), set()).update([item] if item is not None else [])
        self.symbols = len(self.vocabulary) + 1
        self.groups = [(n, np.array([w for w in by if len(w) == n], np.int64), [sorted(by[w]) for w in by if len(w) == n]) for n in sorted({len(w) for w in by})]
        pairs = {a * self.symbols + b for w in by for a, b in zip(w, w[1:])}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.single = np.array(sorted({w[0] for w in by if len(w) == 1}), np.int64)
        self.shortest = min((n for n, _, _ in self.groups), default=0)


def runs(ids: np.ndarray, windows: Windows) -> list[tuple[int, int]]:
    """Stretches [start, end) of a document that may hold an occurrence."""
    if not windows.groups or not ids.any():
        return []
    known = ids > 0
    joined = known[:-1] & known[1:]
    at = np.flatnonzero(joined)
    if len(at) and len(windows.pairs):
        pair = ids[at] * windows.symbols + ids[at + 1]
        found = windows.pairs[np.minimum(np.searchsorted(windows.pairs, pair), len(windows.pairs) - 1)] == pair
        joined = np.zeros(len(joined), bool)
        joined[at[found]] = True
    elif len(at):
        joined = np.zeros(len(joined), bool)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], joined.astype(np.int8), [0]))))
    out = [(s, e + 1) for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()) if e + 1 - s >= max(windows.shortest, 2)]
    if len(windows.single):
        out += [(p, p + 1) for p in np.flatnonzero(np.isin(ids, windows.single)).tolist()]
    return out


def occurrences(shard: list[np.ndarray], windows: Windows) -> list[tuple[list[tuple[int, int]], set[str]]]:
    """Per document of a shard: merged spans [start, end) of word positions, and the items that occur."""
    spans: list[list[tuple[int, int]]] = [[] for _ in shard]
    items: list[set[str]] = [set() for _ in shard]
    parts, docs, starts, at = [], [], [], []
    total = 0
    separator = np.array([windows.symbols], np.int64)
    for d, ids in enumerate(shard):
        for s, e in runs(ids, windows):
            parts += [ids[s:e], separator]
            docs.append(d)
            starts.append(s)
            at.append(total)
            total += e - s + 1
    if parts:
        index = FMIndex(np.concatenate(parts), windows.symbols + 1)
        at_arr = np.array(at)
        for length, rows, owners in windows.groups:
            lo, hi = index.search(rows)
            n = hi - lo
            which = np.repeat(np.arange(len(rows)), n)
            suffix = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            place = index.locate(suffix)
            run = np.searchsorted(at_arr, place, side="right") - 1
            for w, p, r in zip(which.tolist(), place.tolist(), run.tolist()):
                s = starts[r] + p - at[r]
                spans[docs[r]].append((s, s + length))
                items[docs[r]].update(owners[w])
    return [(merged(s), i) for s, i in zip(spans, items)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans, nor what separates the words within a span."""
    places = [m.span() for m in WORD.finditer(text.translate(WORD_BYTES))]
    out, at = [], 0
    for s, e in spans:
        out.append(text[at : places[s][0]])
        at = places[e - 1][1]
    return b"".join([*out, text[at:]])


PAIR = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


@dataclass(frozen=True)
class Decontaminator:
    """window: words in a window.  shard_words: words of the documents an index covers (a longer document is a shard
    of its own).  benchmark_bytes: benchmark text that the driver and a task hold at once (or one item, if that is longer); a larger
    benchmark is searched in several passes over the documents, one for each block of items."""

    window: int = 10
    shard_words: int = 400_000
    benchmark_bytes: int = 32 << 20

    def search(self, rows: DataFrame, block: DataFrame, judge: Callable[[pa.RecordBatch], pa.RecordBatch], schema: StructType) -> DataFrame:
        """rows (.., __spans, __items, __concord_text) with what a block of items (item, text) adds to spans and items, as `judge` turns
        them into rows of `schema`."""
        items = sorted(((r.item, words_of(bytes(r.text))) for r in block.toLocalIterator()), key=lambda x: (x[0] is None, x))
        sent, most = rows.sparkSession.sparkContext.broadcast(Windows(items, self.window)), self.shard_words  # about benchmark_bytes

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            windows = sent.value
            number = windows.vocabulary.get
            for batch in batches:
                for piece in pieces(batch, 6 * most):
                    *rest, spans, items, text = piece.columns
                    spans = [[(s["start"], s["end"]) for s in x] for x in spans.to_pylist()]
                    items = [set(x) for x in items.to_pylist()]
                    shard, first, held = [], 0, 0
                    for i in range(piece.num_rows):
                        words = words_of(text[i].as_py())
                        shard.append(np.fromiter((number(w, 0) for w in words), np.int64, len(words)))
                        held += len(words)
                        if held >= most or i == piece.num_rows - 1:
                            for k, (new, names) in enumerate(occurrences(shard, windows)):
                                spans[first + k] = merged(spans[first + k] + new) if new else spans[first + k]
                                items[first + k] |= names
                            shard, first, held = [], i + 1, 0
                    out = [pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], PAIR), pa.array([sorted(x) for x in items], pa.list_(pa.string()))]
                    yield from map(judge, pieces(pa.RecordBatch.from_arrays([*rest, *out, text], piece.schema.names)))

        return rows.mapInArrow(run, schema)

    def apply(self, docs: DataFrame, benchmark: DataFrame, texts: bool = False) -> DataFrame:
        """Per row of `docs`: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans; with `texts` all columns
        of docs too and `clean`, the text without its spans.

        spans: merged [start, end) word positions.  Null or wordless texts have no words and are clean.  Items without
        words or text match nothing; items without id count in n_hit, not in n_items; repeated rows are judged alike.  Columns
        of docs named like a result are replaced.
        """
        slim_batches(docs.sparkSession)
        results = {"n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans", "clean"}
        own = [c for c in docs.columns if c.lower() not in results] if texts else ["doc_id"]
        names = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"] + ["clean"] * texts

        def judge(piece: pa.RecordBatch) -> pa.RecordBatch:
            *rest, spans, items, raw = piece.columns
            raw, items, places = raw.to_pylist(), items.to_pylist(), spans.to_pylist()
            hits = [sum(s["end"] - s["start"] for s in x) for x in places]
            out = [
                pa.array([len(words_of(t)) for t in raw], pa.int64()),
                pa.array(hits, pa.int64()),
                pa.array(list(map(len, items)), pa.int64()),
                pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items], pa.string()),
                pa.array([h > 0 for h in hits], pa.bool_()),
                spans,
            ]
            if texts:
                out.append(pa.array([None if t is None else (cut(t, [(s["start"], s["end"]) for s in x]) if x else t).decode("utf-8", "replace") for t, x in zip(raw, places)], pa.string()))
            return pa.RecordBatch.from_arrays([*rest, *out], [*own, *names])

        items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")).where("text is not null").distinct()
        size = items.agg(F.sum(F.length("text"))).first()[0] or 0
        blocks = 1 + int(size // self.benchmark_bytes)
        none = [F.array().cast("array<struct<start: long, end: long>>").alias("__spans"), F.array().cast("array<string>").alias("__items")]
        rows = docs.select(*own, *none, F.col("text").cast("binary").alias("__concord_text"))
        kinds = ["long", "long", "long", "string", "boolean", "array<struct<start: long, end: long>>", "string"]
        judged = extend(docs.select(*own).schema, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
        for b in range(blocks):
            last = b == blocks - 1  # judges in the same task
            before, rows = rows, self.search(rows, items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b), judge if last else lambda x: x, judged if last else rows.schema)
            if not last:  # written, so that a pass ends before the next block is read
                rows = materialise(rows, "searched")
                if b:
                    discard(before)
        return rows
