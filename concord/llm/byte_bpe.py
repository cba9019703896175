"""Byte-level BPE by the ranks of a tiktoken file.

Frequent distinct words are encoded by Spark's higher-order functions: a fold over a word's byte characters
merges, again and again, the leftmost neighbours of least rank, looked up in a literal map of ranks (an array
of small maps, as a map's lookup is linear).  Their number is bounded (`dictionary_words`), so the finished
dictionary is sent to all tasks.  Words outside it are merged in the task that meets them, by the same ranks,
once per task while its cache lasts.  Decoding joins the binary pieces of the ids.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.common import extend, pieces, slim_batches

BUCKETS = 1 << 15
NO_RANK = 1 << 30
#: What a task's words may take, roughly.
CACHE_BYTES = 96 << 20


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def latin(column: Column) -> Column:
    """A string whose characters are the bytes of the UTF-8 form."""
    return F.decode(F.encode(column, "UTF-8"), "ISO-8859-1")


@dataclass(frozen=True)
class ByteBPE:
    """path: rank file.  pattern: what is encoded separately.  dictionary_words: frequent words encoded ahead, at most."""

    path: str
    pattern: str
    dictionary_words: int = 20_000

    @cached_property
    def ranks(self) -> dict[bytes, int]:
        with open(self.path, "rb") as f:
            return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}

    # -- higher-order functions ------------------------------------------------------------------

    def buckets(self) -> str:
        """JSON: bucket of a key -> map of key to rank; keys as strings of byte characters."""
        buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
        for token, rank in self.ranks.items():
            key = token.decode("latin-1")
            buckets[zlib.crc32(key.encode()) % BUCKETS][key] = rank
        return json.dumps(buckets)

    def rank_map(self, text: Column) -> Column:
        """The buckets as an array of maps."""
        return F.from_json(text, "array<map<string,int>>")

    def fold(self, word: Column, ranks: Column | None = None) -> Column:
        """array<int>: the ids of a word.  ranks: a column of rank_map(), else it is a literal of the plan."""

        def encode(table: Column) -> Column:
            def rank(key: Column) -> Column:
                return F.element_at(F.get(table, (F.crc32(key.cast("binary")) % BUCKETS).cast("int")), key)

            def pair(a: Column, b: Column) -> Column:
                return F.coalesce(rank(F.concat(a, b)), F.lit(NO_RANK))

            def merge(state: Column, _: Column) -> Column:
                parts, ranks = state["parts"], state["ranks"]
                none = F.array().cast("array<int>")

                def at(p: Column) -> Column:  # p: 1-based place of the left neighbour
                    new = F.concat(F.get(parts, p - 1), F.get(parts, p))
                    left = F.when(p > 1, F.array(pair(F.get(parts, p - 2), new))).otherwise(none)
                    right = F.when(p + 1 < F.size(parts), F.array(pair(new, F.get(parts, p + 1)))).otherwise(none)
                    return F.struct(
                        F.concat(F.slice(parts, 1, p - 1), F.array(new), F.slice(parts, p + 2, F.size(parts))).alias("parts"),
                        F.concat(F.slice(ranks, 1, F.greatest(p - 2, F.lit(0))), left, right, F.slice(ranks, p + 2, F.size(parts))).alias("ranks"),
                    )

                least = F.coalesce(F.array_min(ranks), F.lit(NO_RANK))
                return F.when(least >= NO_RANK, state).otherwise(let(F.array_position(ranks, F.array_min(ranks)).cast("int"), at))

            def start(chars: Column) -> Column:
                n = F.size(chars)
                return F.struct(chars.alias("parts"), F.zip_with(F.slice(chars, 1, n - 1), F.slice(chars, 2, n), pair).alias("ranks"))

            whole = latin(word)
            turns = F.sequence(F.lit(2), F.greatest(F.octet_length(word), F.lit(2)))
            folded = F.aggregate(turns, let(F.split(whole, ""), start), merge)["parts"]
            return F.when(rank(whole).isNotNull(), F.array(rank(whole))).otherwise(F.transform(folded, rank))

        return F.when(F.octet_length(word) == 0, F.array().cast("array<int>")).otherwise(let(self.rank_map(F.lit(self.buckets())) if ranks is None else ranks, encode))

    # -- words -----------------------------------------------------------------------------------

    def frequent_words(self, docs: DataFrame) -> DataFrame:
        """(word): the most frequent words, at most dictionary_words, none over 64 bytes.  Counted are runs of letters between blanks,
        which the pattern matches with the blank before; all others are left to the tasks.  A word that is frequent overall is
        so in some stretch of input; each stretch sends its dictionary_words most frequent words with their counts."""
        most = self.dictionary_words

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: Counter = Counter()

            def flush() -> pa.RecordBatch:
                top = heapq.nlargest(most, ((c, w) for w, c in held.items() if c > 1 and w.isalpha()))
                held.clear()
                return pa.RecordBatch.from_pydict({"word": pa.array([" " + w for _, w in top], pa.string()), "n": pa.array([c for c, _ in top], pa.int64())})

            for batch in batches:
                for piece in pieces(batch):
                    for text in piece.column(0).to_pylist():
                        held.update((text or "").split(" "))
                    if len(held) > 150_000:
                        yield flush()
            yield flush()

        found = docs.select(F.col("text").cast("string")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
        return found.where(F.octet_length("word") <= 64).orderBy(F.desc("n"), "word").limit(most).select("word")

    def folded_words(self, docs: DataFrame) -> DataFrame:
        """(word, ids) of the most frequent words.  The ranks come as a row that is broadcast to some hundred words at a time: as a literal they
        would be spelled out, megabytes each time, wherever Spark describes the plan, and fill the driver."""
        ranks = F.broadcast(docs.sparkSession.createDataFrame([(self.buckets(),)], "j string").select(self.rank_map(F.col("j")).alias("ranks")))
        words = self.frequent_words(docs).withColumn("part", F.pmod(F.xxhash64("word"), F.lit(64))).repartition(8, "part").groupBy("part").agg(F.collect_list("word").alias("words"))
        folded = F.transform("words", lambda w: F.struct(w.alias("word"), self.fold(w, F.col("ranks")).alias("ids")))
        return words.crossJoin(ranks).select(F.explode(folded).alias("found")).select("found.*")

    def dictionary(self, docs: DataFrame) -> dict[str, tuple[int, ...]]:
        return {r.word: tuple(r.ids) for r in self.folded_words(docs).toLocalIterator()}

    def encode(self, docs: DataFrame) -> DataFrame:
        """All columns of docs with ids (array<int>); a null text has no ids.  A column named ids is replaced."""

        def finish(spelled: list[str], _: list[bytes]) -> list[pa.Array]:
            return [pa.array([list(map(int, s.split())) for s in spelled], pa.list_(pa.int32()))]

        return self._map(docs, ["ids"], "ids array<int>", finish)

    def digests(self, docs: DataFrame) -> DataFrame:
        """All columns of docs with n_tokens, ids_sha256 (of the decimal ids joined by blanks), decoded_sha256.  A word's ids are
        spelled and decoded once while it is held; a text's are joined from those of its words.  A null text counts as an empty one: no ids, and the
        digests of nothing; repeated rows are encoded alike, each for itself; columns named like a result are replaced, others pass through."""

        def finish(spelled: list[str], decoded: list[bytes]) -> list[pa.Array]:
            sha = lambda b: hashlib.sha256(b).hexdigest()
            return [pa.array([s.count(" ") + (s != "") for s in spelled], pa.int64()), pa.array([sha(s.encode()) for s in spelled], pa.string()), pa.array(list(map(sha, decoded)), pa.string())]

        return self._map(docs, ["n_tokens", "ids_sha256", "decoded_sha256"], "n_tokens long, ids_sha256 string, decoded_sha256 string", finish)

    def decode(self, encoded: DataFrame) -> DataFrame:
        """All columns with `decoded` (binary), the joined pieces of ids; null ids give null, unknown ids fail."""
        literal = F.from_json(F.lit(json.dumps([t.hex() for t in self.pieces])), "array<string>")
        joined = let(literal, lambda table: F.array_join(F.transform("ids", lambda i: F.element_at(table, i + 1)), ""))
        return encoded.withColumn("decoded", F.unhex(joined))

    @cached_property
    def pieces(self) -> list[bytes]:
        out = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            out[rank] = token
        return out

    def _map(self, docs: DataFrame, names: list[str], kinds: str, finish) -> DataFrame:
        slim_batches(docs.sparkSession)
        docs = docs.drop(*names)
        known = docs.sparkSession.sparkContext.broadcast((self.dictionary(docs), PairRanks(self.ranks), self.pieces))
        pattern = self.pattern

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find = regex.compile(pattern).findall
            cache = Merged(*known.value)
            for batch in batches:
                for piece in pieces(batch):
                    texts = [find(t) if t else [] for t in piece.column(piece.num_columns - 1).to_pylist()]
                    spelled, decoded = cache.learn(texts)
                    out = finish([" ".join(map(spelled, t)) for t in texts], [b"".join(map(decoded, t)) for t in texts])
                    yield pa.RecordBatch.from_arrays([*piece.columns[:-1], *out], [*piece.schema.names[:-1], *names])

        return docs.withColumn("__concord_text", F.col("text").cast("string")).mapInArrow(run, extend(docs.schema, kinds))


class Merged:
    """What words are encoded to, as decimal ids joined by blanks, and what these decode to; words beyond the dictionary are merged
    when a text holds them.  When the words take half of CACHE_BYTES they are set aside, and those of them that come again
    are taken back until the next time."""

    def __init__(self, words: dict[str, tuple[int, ...]], pairs: PairRanks, pieces_of: list[bytes]):
        self.words, self.pairs, self.held = words, pairs, 0
        self.spelled: dict[str, str] = {}
        self.decoded: dict[str, bytes] = {}
        self.aside = self.spelled, self.decoded
        self.piece, self.number = pieces_of.__getitem__, list(map(str, range(len(pieces_of)))).__getitem__

    def learn(self, texts: list[list[str]]) -> tuple:
        """Look-ups of (spelled, decoded) for all words of the texts."""
        if self.held > CACHE_BYTES // 2:
            self.aside, self.spelled, self.decoded, self.held = (self.spelled, self.decoded), {}, {}, 0
        spelled, decoded, (old, old_decoded) = self.spelled, self.decoded, self.aside
        new = set().union(*texts).difference(spelled)
        for w in new.intersection(old):
            spelled[w], decoded[w] = old[w], old_decoded[w]
        rest = list(new.difference(old))
        found = [(w, self.words[w]) for w in rest if w in self.words]
        rare = [w for w in rest if w not in self.words]
        number, piece = self.number, self.piece
        for w, ids in [*found, *zip(rare, self.pairs.merged([w.encode() for w in rare]))]:
            spelled[w] = " ".join(map(number, ids))
            decoded[w] = b"".join(map(piece, ids))
        self.held += 320 * len(new) + 8 * sum(map(len, new))
        return spelled.__getitem__, decoded.__getitem__


class PairRanks:
    """Ranks of two neighbouring ids as sorted arrays, and merging many words at once by them."""

    longest = 64  # bytes of words that are merged together

    def __init__(self, ranks: dict[bytes, int]):
        get, keys, values = ranks.get, [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = get(token[:i]), get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        order = np.argsort(keys)
        self.keys, self.values = np.array(keys, np.int64)[order], np.array(values, np.int32)[order]
        self.ranks = ranks
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs; NO_RANK where a pair has none or an id is missing (below 0)."""
        key = a.astype(np.int64) << 32 | np.maximum(b, 0)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.values[at], NO_RANK).astype(np.int32)

    def merged(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of each word: in every turn each word merges its leftmost neighbours of least rank, until none has a rank."""
        out: list[tuple[int, ...]] = [()] * len(words)
        several = []
        for i, w in enumerate(words):
            if w in self.ranks:
                out[i] = (self.ranks[w],)
            elif len(w) > self.longest:
                out[i] = merge(w, self.ranks)
            elif w:
                several.append(i)
        several.sort(key=lambda i: len(words[i]))
        for at in range(0, len(several), 4_096):
            part = several[at : at + 4_096]
            self._turns([words[i] for i in part], np.array(part), out)
        return out

    def _turns(self, words: list[bytes], places: np.ndarray, out: list[tuple[int, ...]]) -> None:
        sizes = np.array([len(w) for w in words])
        width = int(sizes.max())
        ids = np.full((len(words), width), -1, np.int32)
        ids[np.arange(width) < sizes[:, None]] = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        ranks = self.of(ids[:, :-1], ids[:, 1:])
        while len(ids):
            at = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(ids), np.int64)
            least = ranks[np.arange(len(ids)), at] if ranks.shape[1] else np.full(len(ids), NO_RANK)
            done = least >= NO_RANK
            if done.any():
                last = ids[done]
                for place, row, n in zip(places[done].tolist(), last.tolist(), (last >= 0).sum(1).tolist()):
                    out[place] = tuple(row[:n])
            live = ~done
            ids, ranks, places, at, least = ids[live], ranks[live], places[live], at[live], least[live]
            if not len(ids):
                return
            n, rows = ids.shape[1], np.arange(len(ids))
            ids[rows, at] = least  # a token's id is its rank
            column = np.arange(n - 1)
            ids = np.take_along_axis(ids, column + (column > at[:, None]), 1)
            column = np.arange(n - 2)
            ranks = np.take_along_axis(ranks, column + (column >= at[:, None]), 1)
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < n - 2)
            ranks[left, at[left] - 1] = self.of(ids[left, at[left] - 1], ids[left, at[left]])
            ranks[right, at[right]] = self.of(ids[right, at[right]], ids[right, at[right] + 1])


def merge(word: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Merge the leftmost neighbours of least rank until none has a rank.  A heap keeps long words from a quadratic cost."""
    if word in ranks:
        return (ranks[word],)
    get, n = ranks.get, len(word)
    if n < 40:
        parts = [word[i : i + 1] for i in range(n)]
        pair = [get(word[i : i + 2], NO_RANK) for i in range(n - 1)]
        while pair and (least := min(pair)) < NO_RANK:
            i = pair.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pair[i]
            if i:
                pair[i - 1] = get(parts[i - 1] + parts[i], NO_RANK)
            if i < len(pair):
                pair[i] = get(parts[i] + parts[i + 1], NO_RANK)
        return tuple(ranks[p] for p in parts)
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := get(word[i : i + 2], NO_RANK)) < NO_RANK]
    heapq.heapify(heap)
    while heap:
        _, i, mid, stop = heapq.heappop(heap)
        if not (alive[i] and end[i] == mid and mid < n and alive[mid] and end[mid] == stop):
            continue
        alive[mid], end[i] = False, stop
        if stop < n:
            before[stop] = i
            if (r := get(word[i : end[stop]], NO_RANK)) < NO_RANK:
                heapq.heappush(heap, (r, i, stop, end[stop]))
        if (b := before[i]) >= 0 and (r := get(word[b:stop], NO_RANK)) < NO_RANK:
            heapq.heappush(heap, (r, b, i, stop))
    return tuple(ranks[word[i : end[i]]] for i in range(n) if alive[i])


def default_bpe(spark: SparkSession | None = None) -> ByteBPE:
    import public_tokenizers

    return ByteBPE(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
