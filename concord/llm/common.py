"""What several corpus operators share: shared-folder tables, connected components, word hashing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Lower-cases A-Z and leaves every other byte.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Folders that materialise() has written and nobody has discarded.
WRITTEN: list[str] = []
#: Code units that are parted into words at once.
STRETCH = 1 << 18
#: Combines word hashes in order.
ODD = np.uint64(0xD6E8FEB86659FD93)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share.  Only a session with a local master may leave spark.checkpoint.dir unset: there it is a new
    temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="concord-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def slim_batches(spark: SparkSession) -> None:
    """Let a batch that Spark hands to Python hold about 4 MB, not 10,000 texts of any length.  Fewer rows, if set, stay."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= 2_000:
        spark.conf.set(rows, 2_000)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts lineage, survives lost executors, is computed once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    WRITTEN.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.shared_path = path
    return out


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Remove a table written by materialise(), once nothing reads it any more."""
    remove(df.sparkSession, df.shared_path)
    WRITTEN.remove(df.shared_path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What materialise() writes within is removed at the end, when results that read it must have been written."""
    begun = len(WRITTEN)
    try:
        yield
    finally:
        for path in WRITTEN[begun:]:
            remove(spark, path)
        del WRITTEN[begun:]


def extend(schema: StructType, ddl: str) -> StructType:
    """The schema with the columns of `ddl` after its own."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(id, component): the smallest id reachable from each id that occurs in `edges` (u, v).

    Alternates large-star and small-star steps over edge tables in the shared folder, until the
    edges no longer change: then every edge goes from an id to its component.  Hub ids are only ever
    reduced by min() with map-side combining, or probed by joins whose other side has one row per id.
    Nulls and loops are dropped; an empty input gives an empty result.
    """
    cur = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        low = cur.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        large = cur.join(low, F.col("v") == F.col("w"), "left").select("u", F.coalesce("m", "v").alias("v")).distinct()
        least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        small = (
            large.join(least, F.col("u") == F.col("w"))
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        new = materialise(small, "edges")
        discard(cur)
        state = new.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
        cur = new
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    ids = cur.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ids.unionByName(ids.select(F.col("component").alias("id"), "component").distinct())


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A permutation of the 64-bit integers (splitmix finaliser)."""
    x = x ^ np.uint64(seed * 0x9E3779B97F4A7C15 & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Alphabet:
    """How code units make words: kinds[c] is 0 between words, 1 within a word, 2 for a unit that is a word alone; lowered[c] is c
    as it counts in a word's hash."""

    def __init__(self, kinds: np.ndarray, lowered: np.ndarray):
        self.kinds, self.lowered = kinds, lowered

    def words(self, codes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, start, end, first): the words of texts that lie one after the other in `codes`, row i from rows[i] to rows[i + 1],
        and where each row's words begin among them.  Texts are worked through in stretches that end between words, so that
        scratch memory does not grow with them."""
        found, at = [], 0
        while at < len(codes):
            stop = self.pause(codes, rows, at + STRETCH)
            found.append(self._part(codes, rows, at, stop))
            at = stop
        h, start, end = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))
        return h, start, end, np.searchsorted(start, rows)

    def pause(self, codes: np.ndarray, rows: np.ndarray, at: int) -> int:
        """The first place from `at` on where no word runs on."""
        last = len(codes)
        if at >= last:
            return last
        row = int(rows[np.searchsorted(rows, at)])  # the last of rows is len(codes)
        while at < row:
            gap = np.flatnonzero(self.kinds[codes[at : at + 4096]] != 1)
            if len(gap):
                return min(at + int(gap[0]), row)
            at += 4096
        return row

    def _part(self, codes: np.ndarray, rows: np.ndarray, at: int, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        part = codes[at:stop]
        kind = self.kinds[part]
        fresh = np.zeros(len(part) + 1, bool)
        fresh[rows[np.searchsorted(rows, at) : np.searchsorted(rows, stop, "right")] - at] = True
        fresh[[0, -1]] = True
        one, alone = kind == 1, kind == 2
        start = np.flatnonzero(alone | (one & (np.concatenate(([False], ~one[:-1])) | fresh[:-1])))
        end = np.flatnonzero(alone | (one & (np.concatenate((~one[1:], [False])) | fresh[1:]))) + 1
        if not len(start):
            return np.empty(0, np.uint64), start, end
        size = end - start
        first = np.cumsum(size) - size
        place = np.arange(int(size.sum()), dtype=np.uint64) - np.repeat(first, size).astype(np.uint64)
        x = self.lowered[part[kind > 0]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + place * np.uint64(0xC2B2AE3D27D4EB4F)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        return mix(np.add.reduceat(x, first) + size.astype(np.uint64) * ODD), start + at, end + at


def byte_alphabet(between: bytes) -> Alphabet:
    """Over bytes: those of `between` part words, A-Z count as a-z."""
    kinds = np.ones(256, np.uint8)
    kinds[list(between)] = 0
    return Alphabet(kinds, np.frombuffer(LOWER, np.uint8))


#: Words between space and tab..CR.
BLANKED = byte_alphabet(b" \t\n\x0b\x0c\r")


@lru_cache(1)
def lower_codes() -> np.ndarray:
    """Code point -> that of its lower-case form, where that is one character."""
    out = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x20000):
        low = chr(c).lower()
        if len(low) == 1:
            out[c] = ord(low)
    return out


@lru_cache(1)
def letters() -> Alphabet:
    """Over code points: words are runs of letters."""
    kinds = np.zeros(0x110000, np.uint8)
    kinds[[c for c in range(0x110000) if chr(c).isalpha()]] = 1
    return Alphabet(kinds, lower_codes())


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(codes, rows) of a binary or string column; nulls are empty."""
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    _, places, data = column.buffers()
    rows = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    codes = np.frombuffer(data, np.uint8)[rows[0] : rows[-1]] if data is not None else np.empty(0, np.uint8)
    return codes, rows - rows[0]


def characters_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, rows): code points of the texts, one after the other."""
    rows = np.concatenate(([0], np.cumsum([len(t) if t else 0 for t in texts], dtype=np.int64)))
    return np.frombuffer("".join(t for t in texts if t).encode("utf-32-le", "surrogatepass"), np.uint32), rows


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Per text, the sorted 64-bit hashes of its distinct k-word shingles.

    Words are what lies between space and tab..CR after A-Z are lower-cased.  Fewer than k words
    give one shingle, the whole sequence; null or no words give none.
    """
    h, _, _, first = BLANKED.words(*bytes_of(column))
    acc = rolling(h, k)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            s = np.sort(acc[a : b - k + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        else:
            out.append(mix(rolling(h[a:b], b - a), b - a) if b > a else np.empty(0, np.uint64))
    return out


def rolling(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hashes of each k successive words."""
    n = max(len(h) - k + 1, 0)
    acc = h[:n].copy()
    for i in range(1, k):
        acc *= ODD
        acc += h[i : n + i]
    return mix(acc, seed)


def pieces(batch: pa.RecordBatch, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a piece holds about `limit` bytes; a single long row stays whole."""
    rows = max(1, min(batch.num_rows, int(batch.num_rows * limit / max(batch.nbytes, 1))))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def by_key(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """Rows of one key at a time, from batches sorted by `keys`."""
    last, rows = None, []
    for batch in batches:
        for piece in pieces(batch):
            for row in piece.to_pylist():
                key = [row[k] for k in keys]
                if key != last and rows:
                    yield rows
                    rows = []
                last = key
                rows.append(row)
    if rows:
        yield rows


def bucket_of(x: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(x, 5) % np.uint64(buckets)).astype(np.int64)


def bucketwise(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """(bucket, its rows) from batches sorted by bucket, their first column."""
    last, rows = None, []
    for batch in batches:
        for bucket, *row in zip(*[c.to_pylist() for c in batch.columns]):
            if bucket != last and rows:
                yield last, rows
                rows = []
            last = bucket
            rows.append(row)
    if rows:
        yield last, rows


def joined(rows: list[list[bytes]], columns: int) -> list[np.ndarray]:
    """Columns of 64-bit integers from rows of their parts as bytes."""
    return [np.frombuffer(b"".join(r[i] for r in rows), np.int64) for i in range(columns)]


def packed(bucket: np.ndarray, info: bool, *columns: np.ndarray | None) -> pa.RecordBatch:
    """A row (bucket, info, a, b, c) per bucket, with its parts of three arrays as bytes, in their order; null for an array not given."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))[: len(bucket)]).tolist()
    cut = list(zip(at, [*at[1:], len(bucket)]))
    out = {"bucket": pa.array([int(bucket[s]) for s, _ in cut], pa.int64()), "info": pa.array([info] * len(cut), pa.bool_())}
    for name, x in zip("abc", columns):
        x = None if x is None else x[order]
        out[name] = pa.nulls(len(cut), pa.binary()) if x is None else pa.array([x[s:e].tobytes() for s, e in cut], pa.binary())
    return pa.RecordBatch.from_pydict(out)
