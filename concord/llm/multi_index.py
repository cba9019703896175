"""Embedding near-dedup by an inverted multi-index.

Two codebooks, one per half of the vectors, make a product grid of cells; every vector is listed in the cell of its nearest
centroids.  Codebooks grow with the root of the vectors of a label, so that a cell holds about `cell` of them whatever there are.
A vector visits cells in multi-sequence order, by the sum of its squared distances to the two centroids, nearest first, as far as
the rank within which the wanted share of neighbours lies; the rank is measured on the fitted sample, on its own neighbours and on
vectors moved to exactly the threshold.  Cells that no neighbour can lie in (by the bisector of the nearest centroids, half
by half) are passed over.  With recall 1 the walk stops at that bound alone, so that nothing is lost.  Of two vectors the one
in the lower cell visits the other, so each pair of cells meets once.  All candidates are verified in double precision.

Only vectors of equal label meet.  Equal vectors are one entry with a count.  Large cells are cut into blocks whose
pairs are spread over tasks; tasks return counts and spanning forests, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.common import connected_components, discard, materialise
from concord.llm.jaccard_join import roots


def kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    x_distinct = np.unique(x, axis=0)
    centres = x_distinct[rng.permutation(len(x_distinct))[:k]]
    for _ in range(rounds):
        near = np.argmin((centres**2).sum(1) - 2 * x @ centres.T, axis=1)
        sums, n = np.zeros_like(centres), np.bincount(near, minlength=len(centres))
        np.add.at(sums, near, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


@dataclass
class Codebook:
    centres: np.ndarray

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Squared distances to the centroids."""
        return np.maximum((x**2).sum(1)[:, None] + (self.centres**2).sum(1) - 2 * x @ self.centres.T, 0)

    def bounds(self, d: np.ndarray) -> np.ndarray:
        """Lower bounds of the squared distance to each centroid's region, by its bisector with the nearest centroid."""
        c, near = self.centres, d.argmin(1)
        gap = np.sqrt(np.maximum((c[near] ** 2).sum(1)[:, None] + (c**2).sum(1) - 2 * c[near] @ c.T, 1e-30))
        away = np.maximum(d - d[np.arange(len(d)), near][:, None], 0) / (2 * gap) - 1e-9
        away[np.arange(len(d)), near] = 0
        return np.maximum(away, 0) ** 2


def first_pairs(k: int, l: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The places (i, j) in two sorted lists of k and l numbers that can be among the n least sums: (i + 1)(j + 1) <= n."""
    i = np.arange(min(k, n))
    sizes = np.minimum(l, n // (i + 1))
    i = np.repeat(i, sizes)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


@dataclass
class Grid:
    """The fitted index: cells are numbered u * len(right) + v.  steps: cells a vector visits at most, 0 for as many as the bound asks for."""

    left: Codebook
    right: Codebook
    half: int
    radius2: float
    steps: int = 0

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.left.distances(x[:, : self.half]), self.right.distances(x[:, self.half :])

    def cell(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves(x)
        return a.argmin(1) * b.shape[1] + b.argmin(1)

    def rank(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How many cells come before `cells` in the order of each x."""
        a, b = self.halves(x)
        width, out = b.shape[1], np.zeros(len(x), np.int64)
        b_sorted = np.sort(b, 1)
        for r, c in enumerate(cells.tolist()):
            out[r] = np.searchsorted(b_sorted[r], a[r, c // width] + b[r, c % width] - a[r]).sum()
        return out

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of the cells a vector visits that come after its own in number."""
        a, b = self.halves(x)
        k, width = a.shape[1], b.shape[1]
        own = a.argmin(1) * width + b.argmin(1)
        low_a, low_b = self.left.bounds(a), self.right.bounds(b)
        n = min(self.steps or k * width, k * width)
        i, j = first_pairs(k, width, n)
        rows, cells = [], []
        some = max(1, 1_000_000 // len(i))
        for at in range(0, len(x), some):
            s = slice(at, at + some)
            order_a, order_b = a[s].argsort(1), b[s].argsort(1)
            u, v = order_a[:, i], order_b[:, j]
            line = np.arange(len(u))[:, None]
            if n < len(i):
                total = a[s][line, u] + b[s][line, v]
                first = np.argpartition(total, n - 1, axis=1)[:, :n]
                u, v = u[line, first], v[line, first]
            good = (low_a[s][line, u] + low_b[s][line, v] <= self.radius2) & (u * width + v > own[s][:, None])
            row, place = np.nonzero(good)
            rows.append(row + at)
            cells.append((u * width + v)[row, place])
        return np.concatenate([np.empty(0, np.int64), *rows]), np.concatenate([np.empty(0, np.int64), *cells])


@dataclass(frozen=True)
class MultiIndex:
    """cosine: least similarity of a link.  centroids: of each codebook, at least.  cell: vectors of a label that a cell holds on
    average, where that takes more centroids.  fit_rows: vectors expected in the fitted sample, or 32 for each centroid, if these
    are more.  recall: wanted share of neighbours.  block: entries of a cell that a task holds at once."""

    cosine: float = 0.98
    centroids: int = 16
    cell: int = 256
    fit_rows: int = 20_000
    recall: float = 0.995
    block: int = 1_024
    seed: int = 1

    def hashed(self, vectors: DataFrame) -> DataFrame:
        """(vec_id, label, embedding, a, b) of all rows; a and b are hashes that stand for the vector in joins, null where it is not usable."""
        finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        some = F.exists("embedding", lambda x: x != 0)
        rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
        usable = F.expr("vec_id is not null and label is not null and embedding is not null") & finite & some
        return rows.withColumns({n: F.when(usable, F.xxhash64(F.lit(i), F.size("embedding"), "embedding")) for i, n in enumerate("ab")})

    def valid(self, vectors: DataFrame) -> DataFrame:
        """(vec_id, label, embedding, a, b): usable vectors once each."""
        return self.hashed(vectors).where("a is not null").dropDuplicates(["vec_id", "label", "a", "b"])

    def fit(self, entries: DataFrame, dims: int) -> Grid:
        n, most = entries.groupBy("label").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
        k = max(self.centroids, math.ceil(math.sqrt(most / self.cell)))
        share = min(1.0, max(self.fit_rows, 32 * k) / max(n, 1))
        taken = entries.where(F.pmod(F.xxhash64("vec_id", F.lit(self.seed)), F.lit(1_000_000)) < share * 1_000_000).orderBy("vec_id").select("label", "embedding").toPandas()
        x = unit(np.array(taken["embedding"].tolist(), np.float64).reshape(len(taken), dims))
        rng, half = np.random.default_rng(self.seed), dims // 2
        if not len(x):
            x, taken = np.eye(1, dims), taken.reindex([0])
        grid = Grid(Codebook(kmeans(x[:, :half], k, 12, rng)), Codebook(kmeans(x[:, half:], k, 12, rng)), half, 2 - 2 * self.cosine + 1e-9)
        if self.recall < 1:
            real = self.neighbours(x, taken["label"].astype("category").cat.codes.to_numpy(), rng)
            some = x[rng.integers(0, len(x), 2_000)]
            away = rng.standard_normal(some.shape)
            away -= (away * some).sum(1, keepdims=True) * some
            grid.steps = 1 + max(self.steps(grid, x, y) for x, y in (real, (some, self.cosine * some + np.sqrt(1 - self.cosine**2) * unit(away))))
        return grid

    def neighbours(self, x: np.ndarray, label: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
        """Linked vectors of the sample: for 2,000 of its vectors one neighbour each, if there is any."""
        asked, found = [], []
        for q in np.array_split(rng.permutation(len(x))[:2_000], 20):
            near = (x[q] @ x.T >= self.cosine) & (label[q][:, None] == label[None, :]) & (q[:, None] != np.arange(len(x))[None, :])
            some = near.any(1)
            asked.append(q[some])
            found.append((near[some] * rng.random(near[some].shape)).argmax(1) if some.any() else q[some])
        return x[np.concatenate(asked)], x[np.concatenate(found)]

    def steps(self, grid: Grid, x: np.ndarray, y: np.ndarray) -> int:
        """The rank in the walk of the vector in the lower cell within which the wanted share of neighbours lies."""
        if not len(x):
            return 0
        u, v = grid.cell(x), grid.cell(y)
        swap = u > v
        rank = grid.rank(np.where(swap[:, None], y, x), np.where(swap, u, v))
        return int(np.quantile(np.where(u == v, 0, rank), self.recall, method="higher"))

    def placed(self, entries: DataFrame, grid: Grid) -> DataFrame:
        """(vec_id, label, copies, cell, visitor, embedding): each entry in its own cell and as a visitor of others."""
        sent = entries.sparkSession.sparkContext.broadcast(grid)  # as many numbers as the root of a label's vectors, times the dimensions

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grid = sent.value
            for whole in batches:
                for at in range(0, whole.num_rows, 1_000):
                    batch = whole.slice(at, 1_000)
                    x = unit(matrix(batch.column(3)))
                    row, cell = grid.visits(x)
                    rows = np.concatenate((np.arange(len(x)), row))
                    cells = np.concatenate((grid.cell(x), cell))
                    for start in range(0, len(rows), 4_000):
                        part = slice(start, start + 4_000)
                        out = batch.take(pa.array(rows[part]))
                        yield pa.RecordBatch.from_arrays(
                            [out.column(0), out.column(1), out.column(2), pa.array(cells[part].astype(np.int64)), pa.array(np.arange(len(rows))[part] >= len(x)), out.column(3)],
                            ["vec_id", "label", "copies", "cell", "visitor", "embedding"],
                        )

        kind = dict(entries.dtypes)["label"]
        return entries.select("vec_id", "label", "copies", "embedding").mapInArrow(run, f"vec_id long, label {kind}, copies long, cell long, visitor boolean, embedding array<double>")

    def verify(self, placed: DataFrame) -> DataFrame:
        """(vec_id, root, links) by task."""
        least, block = self.cosine, self.block
        size = placed.where("not visitor").groupBy("label", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
        rows = placed.join(size, ["label", "cell"]).withColumn("b", F.when(F.col("visitor"), -1).otherwise(F.pmod(F.xxhash64("vec_id"), F.col("blocks"))).cast("int"))
        rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = rows.select("label", "cell", F.when(F.col("visitor"), F.col("o")).otherwise(F.least("b", "o")).alias("i"), F.greatest("b", "o").alias("j"), "visitor", "b", "vec_id", "copies", "embedding")
        # visitors meet each block once, in the group of the block with itself
        rows = rows.repartition("label", "cell", "i", "j").sortWithinPartitions("label", "cell", "i", "j", "visitor")

        def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, own, done = None, [], False
            for k, visitor, part in stretches(batches, 2 * block):
                if k != key:
                    if own and not done:
                        yield from among(own, key, least)
                    key, own, done = k, [], False
                if not visitor:
                    own.append(part)
                    continue
                if own and not done:
                    yield from among(own, key, least)
                    done = True
                if own:
                    yield from across(part, own, least)
            if own and not done:
                yield from among(own, key, least)

        return rows.mapInArrow(tasks, "vec_id long, root long, links long")

    def apply(self, vectors: DataFrame) -> DataFrame:
        """Per row of `vectors` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

        Vectors that are null, zero or hold null or non-finite components, and rows with a null label, link with
        nothing.  Vectors of different lengths do not link.  Repeats of a vector under one vec_id are one vector.  Rows that share a
        vec_id but not a vector or label each have their own links, and are one for reachability.  A row without vec_id has no
        component and is kept.  Other columns are ignored.
        """
        good = materialise(self.valid(vectors), "vectors")
        keys = ["label", "a", "b"]
        counted = self.numbered(good.groupBy(*keys).agg(F.min("vec_id").alias("first"), F.count("*").alias("copies")))
        held = good.join(counted.withColumnRenamed("first", "vec_id"), [*keys, "vec_id"])
        entries = materialise(held.select(F.col("entry").alias("vec_id"), *keys, "copies", "embedding"), "entries")
        found = None
        for dims in sorted(r.d for r in entries.select(F.size("embedding").alias("d")).distinct().toLocalIterator()):
            own = entries.where(F.size("embedding") == dims)
            placed = materialise(self.placed(own, self.fit(own, dims)), "placed")
            links = materialise(self.verify(placed), "links")
            discard(placed)
            found = links if found is None else found.unionByName(links)
        if found is None:
            found = vectors.sparkSession.createDataFrame([], "vec_id long, root long, links long")
        counts = found.groupBy(F.col("vec_id").alias("entry")).agg(F.sum("links").alias("links"))
        several = good.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").select("vec_id")
        same = good.join(several, "vec_id", "left_semi").join(counted, keys).select(F.col("vec_id").alias("u"), F.col("entry").alias("v"))
        extra = counted.where("entry <> first").select(F.col("entry").alias("u"), F.col("first").alias("v"))
        edges = found.select(F.col("vec_id").alias("u"), F.col("root").alias("v")).unionByName(same).unionByName(extra)
        component = connected_components(edges)
        classes = counted.join(counts, "entry", "left").join(component.withColumnRenamed("id", "entry"), "entry", "left")
        links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
        told = classes.select(*keys, links.cast("long").alias("n_links"), F.coalesce("component", "first").alias("component_id"))
        every = self.hashed(vectors)
        usable = every.where("a is not null").join(told, keys).select("vec_id", "n_links", "component_id")
        ids = good.join(told, keys).groupBy(F.col("vec_id").alias("__id")).agg(F.min("component_id").alias("component_id"))
        rest = every.where("a is null").join(ids, F.col("vec_id") == F.col("__id"), "left").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
        return usable.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

    def numbered(self, counted: DataFrame) -> DataFrame:
        """counted (label, a, b, first, copies) with entry: first, but for all but one of those that have it in common a number above all vec_ids."""
        counted = materialise(counted, "counted")
        shared = counted.groupBy("first").agg(F.min(F.struct("a", "b", F.xxhash64("label"))).alias("main"), F.count("*").alias("n")).where("n > 1").drop("n")
        if shared.isEmpty():
            return counted.withColumn("entry", F.col("first"))
        above = counted.agg(F.max("first")).first()[0] + 1
        own = F.col("main").isNull() | (F.struct("a", "b", F.xxhash64("label")) == F.col("main"))
        return materialise(counted.join(shared, "first", "left").withColumn("entry", F.when(own, F.col("first")).otherwise(F.monotonically_increasing_id() + above)).drop("main"), "numbered")


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(1, keepdims=True), 1e-300) if x.size else x  # no overflow of squares
    return x / np.maximum(np.sqrt((x**2).sum(1, keepdims=True)), 1e-300)


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


Part = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # ids, copies, block, unit vectors


def stretches(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[tuple, bool, Part]]:
    """(key, visitor, part): stretches of rows of one key and kind, from sorted batches."""
    for batch in batches:
        keys = list(zip(*[batch.column(c).to_pylist() for c in range(5)]))
        start = 0
        for at in range(1, len(keys) + 1):
            if at == len(keys) or keys[at] != keys[start] or at - start == most:
                part = batch.slice(start, at - start)
                yield keys[start][:4], keys[start][4], (part.column(6).to_numpy(), part.column(7).to_numpy(), part.column(5).to_numpy(), unit(matrix(part.column(8))))
                start = at


def among(own: list[Part], key: tuple, least: float) -> Iterator[pa.RecordBatch]:
    """Links within a block, or between two."""
    ids, copies, side, x = (np.concatenate(p) for p in zip(*own))
    own[:] = [(ids, copies, side, x)]
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    if key[2] != key[3]:
        near &= side[:, None] != side[None, :]
    yield from answer(near, ids, copies)


def across(part: Part, own: list[Part], least: float) -> Iterator[pa.RecordBatch]:
    """Links between visitors and a block."""
    ids, copies, _, x = (np.concatenate(p) for p in zip(part, own[0]))
    n = len(part[0])
    between = part[3] @ own[0][3].T >= least
    rows, columns = between.any(1), between.any(0)
    near = np.zeros((len(ids), len(ids)), bool)
    near[:n, n:] = between
    near[n:, :n] = between.T
    some = np.concatenate((rows, columns))
    yield from answer(near[np.ix_(some, some)], ids[some], copies[some])


def answer(near: np.ndarray, ids: np.ndarray, copies: np.ndarray) -> Iterator[pa.RecordBatch]:
    some = near.any(1) if near.size else np.zeros(0, bool)
    if some.any():
        near, ids, copies = near[np.ix_(some, some)], ids[some], copies[some]
        yield pa.RecordBatch.from_pydict({"vec_id": pa.array(ids), "root": pa.array(roots(near, ids)), "links": pa.array(near @ copies)})
