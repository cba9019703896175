"""Ranked lexical search: a tree of maxima over document ranges for each term, searched best first.

A pass over the documents keeps what they hold of the queries' vocabulary, as packed arrays per document, with document
frequencies per stretch of input.  The second pass cuts these into shards of successive documents.  A shard has, for each term,
the greatest contribution of any document in ranges of `leaf` documents, in ranges of `fanout` of those, and so on up.  A query
adds up its terms' maxima; the range with the highest sum is opened first, down to single documents, until the highest sum left
is below the k-th score; ranges whose sum equals it are opened, as they may hold a smaller doc_id.  Each shard sends its k best,
of which Spark keeps the k best.  Nothing but these is shuffled.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from concord.llm.common import byte_alphabet, bytes_of, discard, materialise, pieces, slim_batches

#: Cells of a shard's lowest maxima that a task holds at once: with more terms at once, ranges are longer.
CELLS = 1 << 22
#: Words are runs of a-z, A-Z, 0-9 and bytes from 0x80 on; A-Z count as a-z.
WORDS = byte_alphabet(bytes(b for b in range(0x80) if not chr(b).isalnum()))
NO_ID = 2**63 - 1


def vocabulary(texts: list[bytes | None]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sorted word hashes of all texts, and the numbers of each text's distinct words among them."""
    h, _, _, first = WORDS.words(*bytes_of(pa.array([t or b"" for t in texts], pa.binary())))
    words, number = np.unique(h, return_inverse=True)
    return words, [np.unique(number[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]


class Shard:
    """Successive documents with the contributions of the terms asked for: posting i is of document doc[i] (in order) and term[i]."""

    def __init__(self, ids: list[int | None], doc: np.ndarray, term: np.ndarray, value: np.ndarray, leaf: int, fanout: int):
        self.ids, self.doc, self.term, self.value, self.leaf, self.fanout = ids, doc, term, value, leaf, fanout

    def trees(self, terms: np.ndarray) -> list[np.ndarray]:
        """By level, leaves first: the maxima of each of `terms` in each range; the last level has at most `fanout` ranges."""
        row = np.searchsorted(terms, self.term)
        here = (row < len(terms)) & (terms[np.minimum(row, len(terms) - 1)] == self.term)
        row, range_, value = row[here], self.doc[here] // self.leaf, self.value[here]
        level = np.zeros((len(terms), -(-len(self.ids) // self.leaf)), np.int64)
        np.maximum.at(level, (row, range_), value)
        out = [level]
        while out[-1].shape[1] > self.fanout:
            out.append(np.maximum.reduceat(out[-1], np.arange(0, out[-1].shape[1], self.fanout), axis=1))
        return out

    def search(self, query: np.ndarray, rows: np.ndarray, trees: list[np.ndarray], k: int) -> list[tuple[int, int]]:
        """The k best (score, doc_id), an id that is null as NO_ID; query: the terms, rows: their places in the trees."""
        asked = np.zeros(max(int(self.term.max(initial=0)), int(query.max())) + 1, bool)
        asked[query] = True
        top = len(trees) - 1
        open_ = [(-int(b), top, i) for i, b in enumerate(trees[top][rows].sum(0)) if b > 0]
        heapq.heapify(open_)
        best: list[tuple[int, int]] = []  # (score, -doc_id), the worst first
        while open_:
            bound, level, i = heapq.heappop(open_)
            if len(best) == k and -bound < best[0][0]:
                break
            if level:
                a = i * self.fanout
                for j, b in enumerate(trees[level - 1][rows, a : a + self.fanout].sum(0)):
                    if b > 0 and (len(best) < k or b >= best[0][0]):
                        heapq.heappush(open_, (-int(b), level - 1, a + j))
                continue
            a, z = np.searchsorted(self.doc, [i * self.leaf, (i + 1) * self.leaf])
            hit = asked[self.term[a:z]]
            # whole numbers below 2 ** 53, exact as doubles
            score = np.bincount(self.doc[a:z][hit] - i * self.leaf, weights=self.value[a:z][hit]).astype(np.int64)
            for j in np.flatnonzero(score > (0 if len(best) < k else best[0][0] - 1)).tolist():
                doc = self.ids[i * self.leaf + j]
                found = (int(score[j]), -(NO_ID if doc is None else doc))
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        return [(s, -d) for s, d in best]


@dataclass(frozen=True)
class LexicalSearch:
    """k: results of a query.  length_percent: weight of a document's length.  shard_docs, shard_postings: documents and postings that a
    task holds at once, at most (a longer document is a shard of its own).  leaf, fanout: documents of the least range, ranges of the next.
    query_bytes: query text that the driver and a task hold at once; more is searched in several passes.  group_terms: terms that have
    trees at once, about."""

    k: int = 10
    length_percent: int = 90
    shard_docs: int = 4_096
    shard_postings: int = 2_000_000
    leaf: int = 16
    fanout: int = 8
    query_bytes: int = 8 << 20
    group_terms: int = 8_192

    def postings(self, docs: DataFrame, words: np.ndarray) -> DataFrame:
        """(doc_id, n, terms, tfs, term, df): a row per document with its number of words and what it holds of `words`, as bytes of 32-bit
        integers; and rows with term and df only, a term's documents in a stretch of input."""
        sent = docs.sparkSession.sparkContext.broadcast(words)

        def note(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words = sent.value
            df = np.zeros(len(words), np.int64)
            for batch in batches:
                for piece in pieces(batch):
                    h, _, _, first = WORDS.words(*bytes_of(piece.column(1)))
                    n = np.diff(first)
                    doc = np.repeat(np.arange(len(n)), n)
                    at = np.minimum(np.searchsorted(words, h), len(words) - 1)
                    hit = words[at] == h
                    held, tf = np.unique(doc[hit] * len(words) + at[hit], return_counts=True)
                    doc, term = held // len(words), held % len(words)
                    df += np.bincount(term, minlength=len(words))
                    cut = np.searchsorted(doc, np.arange(len(n) + 1)).tolist()
                    packed = [[x.astype(np.int32)[a:z].tobytes() for a, z in zip(cut, cut[1:])] for x in (term, tf)]
                    none = pa.nulls(len(n), pa.int64())
                    yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(n, pa.int64()), *[pa.array(x, pa.binary()) for x in packed], none, none], ["doc_id", "n", "terms", "tfs", "term", "df"])
            some = np.flatnonzero(df)
            for a in range(0, len(some), 50_000):
                part = some[a : a + 50_000]
                none = [pa.nulls(len(part), t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.binary())]
                yield pa.RecordBatch.from_arrays([*none, pa.array(part, pa.int64()), pa.array(df[part])], ["doc_id", "n", "terms", "tfs", "term", "df"])

        return docs.mapInArrow(note, "doc_id long, n long, terms binary, tfs binary, term long, df long")

    def groups(self, queries: list[tuple[int, np.ndarray]]) -> list[tuple[np.ndarray, list[tuple[int, np.ndarray]]]]:
        """Successive queries with about `group_terms` words, and their distinct words."""
        out, part, held = [], [], 0
        for q, terms in queries:
            part.append((q, terms))
            held += len(terms)
            if held >= self.group_terms:
                out.append((np.unique(np.concatenate([t for _, t in part])), part))
                part, held = [], 0
        return [*out, (np.unique(np.concatenate([t for _, t in part])), part)] if part else out

    def best(self, postings: DataFrame, words: int, queries: list[tuple[int, np.ndarray]]) -> DataFrame:
        """(q, doc_id, score): the k best of each shard for each query, scores above 0."""
        n_docs, n_words = postings.where("n > 0").agg(F.count("*"), F.sum("n")).first()
        weight = np.zeros(words, np.int64)
        for r in postings.where("df is not null").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():  # a row per query word
            weight[r.term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.df + 1)))
        share, per_doc = self.length_percent, self
        sent = postings.sparkSession.sparkContext.broadcast((weight, self.groups(queries)))

        def results(ids: list[int | None], n: list[int], terms: list[bytes], tfs: list[bytes]) -> pa.RecordBatch:
            weight, groups = sent.value
            doc = np.repeat(np.arange(len(ids)), [len(t) // 4 for t in terms])
            term, tf = (np.frombuffer(b"".join(x), np.int32).astype(np.int64) for x in (terms, tfs))
            m = 100 - share + (share * np.array(n, np.int64) * n_docs) // n_words
            value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
            shard = Shard(ids, doc, term, value, per_doc.leaf, per_doc.fanout)
            out: list[list] = [[], [], []]
            there = np.unique(term)
            for names, asked in groups:
                names = names[np.isin(names, there, assume_unique=True)]
                if not len(names):
                    continue
                shard.leaf = max(per_doc.leaf, -(-len(ids) * len(names) // CELLS))
                trees = shard.trees(names)
                for q, query in asked:
                    row = np.searchsorted(names, query)
                    held = (row < len(names)) & (names[np.minimum(row, len(names) - 1)] == query)
                    for score, d in shard.search(query[held], row[held], trees, per_doc.k) if held.any() else ():
                        for column, v in zip(out, (q, None if d == NO_ID else d, score)):
                            column.append(v)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["q", "doc_id", "score"])

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[list] = [[], [], [], []]
            size = 0
            for batch in batches:
                for row in zip(*[c.to_pylist() for c in batch.columns]):
                    if not row[2]:
                        continue
                    for column, v in zip(held, row):
                        column.append(v)
                    size += len(row[2]) // 4
                    if len(held[0]) == per_doc.shard_docs or size >= per_doc.shard_postings:
                        yield results(*held)
                        held, size = [[], [], [], []], 0
            if held[0]:
                yield results(*held)

        return postings.where("n > 0").select("doc_id", "n", "terms", "tfs").mapInArrow(search, "q long, doc_id long, score long")

    def apply(self, docs: DataFrame, items: DataFrame) -> DataFrame:
        """(item_id, rank, doc_id, score): for each row of `items` (item_id, text) its k best of `docs` (doc_id, text), best first,
        equal scores by doc_id; fewer where fewer have a score above 0.

        Null or wordless texts have no terms: such documents do not count and are not found, such items find nothing.  Repeated rows are
        documents, or items, of their own; ranks are unique within a row of items.  Documents without doc_id come last among equals.
        Other columns are ignored; item_id keeps its type.  Words are told apart by 64-bit hashes.
        """
        slim_batches(docs.sparkSession)
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
        asked = materialise(items.select("item_id", F.col("text").cast("binary").alias("text"), F.monotonically_increasing_id().alias("q")), "items")
        blocks = 1 + int((asked.agg(F.sum(F.length("text"))).first()[0] or 0) // self.query_bytes)
        found = None
        for b in range(blocks):
            rows = [(r.q, bytes(r.text)) for r in asked.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b).where("text is not null").toLocalIterator()]  # about query_bytes
            words, terms = vocabulary([t for _, t in rows])
            if not len(words):
                continue
            postings = materialise(self.postings(texts, words), "postings")
            if not postings.where("n > 0").isEmpty():
                queries = [(q, t) for (q, _), t in zip(rows, terms) if len(t)]
                new = materialise(self.best(postings, len(words), queries), "best")
                found = new if found is None else found.unionByName(new)
            discard(postings)
        if found is None:
            found = docs.sparkSession.createDataFrame([], "q long, doc_id long, score long")
        order = W.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= self.k)
        return ranked.join(asked.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")
