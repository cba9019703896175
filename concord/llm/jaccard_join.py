"""N-gram Jaccard join: prefix filtering under several global token orders, intersected before verification.

A document's set holds its distinct k-word shingles.  Whatever the total order of all shingles, two sets with Jaccard
similarity >= t share a shingle among the first n - ceil(t * n) + 1 of each.  Both orders here begin with a fixed share of
the shingles (by hash) whose document counts are gathered: the first takes the rarest of them first, the second those of one half by
hash, rarest first, and then the other half.  Two documents that share a few rare shingles share one in both prefixes only if some
of these are in the first half, while similar ones always do.  Shingles without counts follow, and a bounded list of very
frequent ones comes last.  A document whose first shingles are its own alone has an empty prefix and drops out.

Under each order, documents that share a prefix shingle are joined into clusters; the next order only looks within the
clusters of those before it.  No pair is written: a shared prefix shingle links each holder to the smallest one.  Within a
cluster two documents are candidates if they share a prefix shingle under every order; only candidates are verified.

A cluster goes to tasks whole, cut into pairs of blocks, or by the shingles of the first order (a pair is judged under its
least common one), whichever sends fewer rows: a group of near copies goes whole, a chain of documents of which only
neighbours share a shingle goes link by link, in work that grows with the chain.  Tasks return per-document counts and a
spanning forest, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.common import bucket_of, bucketwise, by_key, connected_components, discard, joined, materialise, mix, packed, pieces, shingle_sets, slim_batches
from concord.llm.url_filter import build_level


@dataclass(frozen=True)
class JaccardJoin:
    """k: words in a shingle.  percent: similarity in hundredths.  frequent: a shingle in more than this share of the texts of some stretch of input is a heavy hitter.
    block: documents in a verification block.  bucket: shingles that a task holds at once, on average."""

    k: int = 5
    percent: int = 80
    frequent: float = 1 / 200
    block: int = 256
    bucket: int = 200_000

    def prefix(self, n: int) -> int:
        return n - -(-n * self.percent // 100) + 1

    # -- signatures ------------------------------------------------------------------------------

    def signatures(self, docs: DataFrame) -> DataFrame:
        """(doc_id, n, digest, h, c): set size and 128-bit digest of the set; and, in rows without doc_id, shingles that are in
        more than `frequent` of the texts of some stretch of input, with their counts there.

        A shingle that is this frequent overall is so in some stretch, and a stretch has at most (mean set size / frequent)
        of them, so that little is sent whatever the corpus holds.
        """
        k, share = self.k, self.frequent
        kinds = {"doc_id": pa.int64(), "n": pa.int64(), "digest": pa.binary(), "h": pa.int64(), "c": pa.int64()}

        def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sets, words = [], 0

            def rows(count: int, **given) -> pa.RecordBatch:
                return pa.RecordBatch.from_pydict({c: pa.array(given[c], t) if c in given else pa.nulls(count, t) for c, t in kinds.items()})

            def flush() -> pa.RecordBatch:
                h, c = np.unique(np.concatenate([np.empty(0, np.uint64), *sets]), return_counts=True)
                few = c >= max(3, share * len(sets))
                return rows(int(few.sum()), h=h[few].view(np.int64), c=c[few].astype(np.int64))

            for batch in batches:
                for piece in pieces(batch):
                    held = shingle_sets(piece.column(1), k)
                    yield rows(len(held), doc_id=piece.column(0), n=[len(s) for s in held], digest=[xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in held])
                    sets += held
                    words += sum(map(len, held))
                    if words > 1_000_000:
                        yield flush()
                        sets, words = [], 0
            yield flush()

        return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(sign, "doc_id long, n long, digest binary, h long, c long")

    def heavy_hitters(self, signed: DataFrame) -> np.ndarray:
        """Shingles in more than `frequent` of all texts; they only shape the orders, results do not depend on them."""
        total = signed.where("doc_id is not null").count()
        found = signed.where("doc_id is null").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= max(3, self.frequent * total))
        return np.sort(found.select("h").toPandas()["h"].to_numpy(np.int64).view(np.uint64))

    # -- entities --------------------------------------------------------------------------------

    def entities(self, docs: DataFrame, signed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
        """docs as (id, text), signed as (doc_id, n, digest, id), and (id, doc_id, digest) of the ids that rows with different
        sets share, null if there are none.  Their least set by hash keeps the doc_id as its id, the others get numbers after the greatest."""
        texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
        h = F.xxhash64("digest")
        shared = signed.where("n > 0").groupBy("doc_id").agg(F.min(h).alias("least"), F.max(h).alias("most")).where("least <> most")
        if shared.isEmpty():
            return texts, signed.withColumn("id", F.col("doc_id")), None
        shared = materialise(shared.select("doc_id", "least"), "shared")
        above = signed.agg(F.max("doc_id")).first()[0] + 1
        parts = signed.join(shared, "doc_id").where("n > 0").select("doc_id", "digest", (h == F.col("least")).alias("main")).distinct()
        split = materialise(parts.select("doc_id", "digest", F.when(F.col("main"), F.col("doc_id")).otherwise(F.monotonically_increasing_id() + above).alias("id")), "split")
        k = self.k

        def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch):
                    digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in shingle_sets(piece.column(1), k)]
                    yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(digests, pa.binary()), piece.column(1)], ["doc_id", "digest", "text"])

        ids = shared.select(F.col("doc_id").alias("id"))
        several = texts.join(ids, "id", "left_semi").mapInArrow(sign, "doc_id long, digest binary, text binary").join(split, ["doc_id", "digest"]).select("id", "text")
        known = signed.join(split, ["doc_id", "digest"], "left").withColumn("id", F.coalesce("id", "doc_id"))
        return texts.join(ids, "id", "left_anti").unionByName(several), known, split

    # -- prefixes --------------------------------------------------------------------------------

    def prefixes(self, texts: DataFrame, frequent: np.ndarray, buckets: int) -> DataFrame:
        """(id, p0, p1): the shared shingles of a document's prefix, by order, as bytes; documents without any are left out.

        Three steps: shingles go to buckets of shingles, where those of one document alone are dropped; the others go back to
        buckets of documents with their counts, where each document's rarest are taken.  All rows are packed arrays; a task
        holds one bucket at a time.  Of equal sets in one piece of input, only the least document takes part.
        """
        k, prefix = self.k, self.prefix
        counted = np.uint64(1)  # shingles whose hash ends in a zero bit are counted; in two, where prefixes are short
        if self.percent >= 85:
            counted = np.uint64(3)
        sent_schema = "bucket long, info boolean, a binary, b binary, c binary"

        def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch, 4 << 20):
                    sets: dict[bytes, tuple[int, np.ndarray]] = {}
                    for doc, s in zip(piece.column(0).to_pylist(), shingle_sets(piece.column(1), k)):
                        if len(s):
                            key = xxhash.xxh3_128_digest(s.tobytes())
                            if key not in sets or doc < sets[key][0]:
                                sets[key] = (doc, s)
                    ids, tokens, sizes, need, early = [], [], [], [], []
                    for doc, s in sets.values():
                        p = prefix(len(s))
                        rare = np.ones(len(s), bool)
                        if len(frequent):
                            rare = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] != s
                        first = ((s & counted) == 0) & rare
                        own = s[first]
                        if len(own) < p:  # uncounted ones follow, the very frequent last
                            rest = s[~first]
                            order = np.lexsort((mix(rest, 1), ~rare[~first]))
                            own = np.concatenate((own, rest[order[: p - len(own)]]))
                        ids.append(doc)
                        tokens.append(own)
                        sizes.append(len(own))
                        need.append(p)
                        early.append(int((~later(own[: int(first.sum())])).sum()))
                    if ids:
                        ids, token = np.array(ids, np.int64), np.concatenate(tokens)
                        yield packed(bucket_of(ids.view(np.uint64), buckets), True, ids, np.array(sizes, np.int64) << 32 | np.array(early, np.int64), np.array(need, np.int64))
                        yield packed(bucket_of(token, buckets), False, np.repeat(ids, sizes), token.view(np.int64), None)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bucket, rows in bucketwise(batches):
                for a, b, c in (x[1:] for x in rows if x[0]):
                    yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int64()), "info": pa.array([True]), "a": pa.array([a], pa.binary()), "b": pa.array([b], pa.binary()), "c": pa.array([c], pa.binary())})
                doc, token = joined([x[1:3] for x in rows if not x[0]], 2)
                order = np.argsort(token, kind="stable")
                doc, token = doc[order], token[order]
                new = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))[: len(token)])
                n = np.diff(np.concatenate((new, [len(token)])))
                n = np.repeat(n, n)
                many = n > 1
                doc, token, n = doc[many], token[many], n[many]
                yield packed(bucket_of(doc.view(np.uint64), buckets), False, doc, token, n)

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, rows in bucketwise(batches):
                ids, sizes, need = joined([x[1:] for x in rows if x[0]], 3)
                sent = dict(zip(ids.tolist(), zip((sizes >> 32).tolist(), (sizes & 0xFFFFFFFF).tolist(), need.tolist())))
                doc, token, n = joined([x[1:] for x in rows if not x[0]], 3)
                order = np.lexsort((token, doc))
                order = order[np.concatenate(([True], (doc[order][1:] != doc[order][:-1]) | (token[order][1:] != token[order][:-1])))[: len(order)]]  # repeated rows
                doc, token, n = doc[order], token[order], n[order]
                at = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))[: len(doc)]).tolist()
                out: list[list] = [[], [], []]
                for s, e in zip(at, [*at[1:], len(doc)]):
                    size, early, p = sent[int(doc[s])]
                    found = two_prefixes(token[s:e].view(np.uint64), n[s:e], size, early, p, counted)
                    if len(found[0]) and len(found[1]):  # else no document shares the prefixes of both orders
                        out[0].append(int(doc[s]))
                        out[1].append(found[0].tobytes())
                        out[2].append(found[1].tobytes())
                for start in range(0, len(out[0]), 2_000):
                    part = [x[start : start + 2_000] for x in out]
                    yield pa.RecordBatch.from_pydict({"id": pa.array(part[0], pa.int64()), "p0": pa.array(part[1], pa.binary()), "p1": pa.array(part[2], pa.binary())})

        deal = lambda df: df.repartition("bucket").sortWithinPartitions("bucket")
        sent = texts.mapInArrow(scatter, sent_schema)
        return deal(deal(sent).mapInArrow(count, sent_schema)).mapInArrow(choose, "id long, p0 binary, p1 binary")

    # -- clusters --------------------------------------------------------------------------------

    def clusters(self, prefixes: DataFrame, buckets: int) -> DataFrame:
        """(id, cluster): documents that may be similar to another one under every order."""
        found = None
        for o in range(2):
            inside = prefixes.select("id", F.col(f"p{o}").alias("tokens"))
            inside = inside.withColumn("cluster", F.lit(0).cast("long")) if found is None else inside.join(found, "id")
            new = materialise(connected_components(stars(inside.select("id", "cluster", "tokens"), buckets)).select("id", F.col("component").alias("cluster")), "clusters")
            if found is not None:
                discard(found)
            found = new
        return found

    # -- verification ----------------------------------------------------------------------------

    def members(self, prefixes: DataFrame, clusters: DataFrame, copies: DataFrame) -> DataFrame:
        """(id, copies, p0, p1, cluster, token, blocks): where each document is verified; token is null where its cluster goes whole."""
        whole = clusters.join(copies.select(F.col("first").alias("id"), "copies"), "id")
        sizes = whole.groupBy("cluster").agg(F.count("*").alias("m")).where("m > 1")
        blocks = F.ceil(F.col("m") / self.block)
        held = materialise(whole.join(sizes, "cluster").join(prefixes, "id").withColumn("blocks", blocks.cast("int")), "held")
        groups = materialise(exploded(held.where("blocks > 1").select("id", "cluster", "p0")).groupBy("cluster", "token").agg(F.count("*").alias("m")).where("m > 1").withColumn("blocks", blocks.cast("int")), "groups")
        cost = groups.groupBy("cluster").agg(F.sum(F.col("m") * F.col("blocks")).alias("cost"))
        split = held.where("blocks > 1").groupBy("cluster").agg(F.sum("blocks").alias("all")).join(cost, "cluster").where("cost < all").select("cluster")
        split = materialise(split, "split-clusters")
        columns = ["id", "copies", "p0", "p1", "cluster"]
        out = held.join(split, "cluster", "left_anti").select(*columns, F.lit(None).cast("long").alias("token"), "blocks")
        some = held.where("blocks > 1").join(split, "cluster", "left_semi")
        by_token = exploded(some.select("id", "cluster", "p0")).join(groups.drop("m"), ["cluster", "token"])
        return out.unionByName(by_token.join(some.drop("blocks", "m", "cluster"), "id").select(*columns, "token", "blocks"))

    def verify(self, texts: DataFrame, members: DataFrame) -> DataFrame:
        """(id, root, links): per task and document, documents linked to it and the least id of its links' closure."""
        k, percent = self.k, self.percent
        member = members.withColumn("b", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        rows = likely(texts, members.select("id")).join(member, "id")
        rows = rows.withColumn("o", F.explode(F.expr("sequence(0, blocks - 1)")))
        rows = rows.select("cluster", "token", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "b", "id", "copies", "p0", "p1", "text")
        rows = rows.repartition("cluster", "token", "i", "j").sortWithinPartitions("cluster", "token", "i", "j")

        def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out: dict[str, list] = {"id": [], "root": [], "links": []}
            for group in by_key(batches, ["cluster", "token", "i", "j"]):
                group = list({r["id"]: r for r in group}.values())  # repeated rows count in copies
                may = candidates([np.frombuffer(r["p0"], np.uint64) for r in group], [np.frombuffer(r["p1"], np.uint64) for r in group], group[0]["token"])
                if group[0]["i"] != group[0]["j"]:
                    side = np.array([r["b"] for r in group])
                    may &= side[:, None] != side[None, :]
                some = np.flatnonzero(may.any(1))
                if len(some):
                    ids = np.array([group[i]["id"] for i in some], np.int64)
                    near = similar(shingle_sets(pa.array([group[i]["text"] for i in some], pa.binary()), k), percent) & may[np.ix_(some, some)]
                    linked = near.any(1)
                    out["id"] += ids[linked].tolist()
                    out["root"] += roots(near, ids)[linked].tolist()
                    out["links"] += (near @ np.array([group[i]["copies"] for i in some], np.int64))[linked].tolist()
                if len(out["links"]) > 20_000:
                    yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in out.items()})
                    out = {c: [] for c in out}
            yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in out.items()})

        return rows.mapInArrow(links, "id long, root long, links long")

    def apply(self, docs: DataFrame) -> DataFrame:
        """Per row of `docs` (doc_id, text): doc_id, n_shingles, n_links, component_id.

        n_links: other rows within the similarity, equal sets included.  component_id: least doc_id reachable by links.
        Null or wordless texts have no shingles and link with nothing.  Rows that share a doc_id are one document for
        reachability, but each has its own set and links.  A row without doc_id links with nothing and has no component.
        Other columns are ignored.
        """
        slim_batches(docs.sparkSession)
        known = docs.where("doc_id is not null")
        every = materialise(self.signatures(known), "signatures")
        texts, signed, split = self.entities(known, every.where("doc_id is not null").select("doc_id", "n", "digest"))
        partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(partitions, (signed.agg(F.sum("n")).first()[0] or 0) // self.bucket)
        prefixes = materialise(self.prefixes(texts, self.heavy_hitters(every), buckets), "prefixes")
        full = signed.where("n > 0")
        copies = full.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
        clusters = self.clusters(prefixes, buckets)
        members = materialise(self.members(prefixes, clusters, copies), "members")
        found = materialise(self.verify(texts, members), "links")
        for done in (prefixes, clusters, members):
            discard(done)
        linked = found.groupBy("id").agg(F.sum("links").alias("links"))
        edges = found.select(F.col("id").alias("u"), F.col("root").alias("v"))
        if split is not None:
            edges = edges.unionByName(split.join(copies, "digest").select(F.col("first").alias("u"), F.col("doc_id").alias("v")))
        component = connected_components(edges)
        first = copies.join(linked.withColumnRenamed("id", "first"), "first", "left").join(component.withColumnRenamed("id", "first"), "first", "left")
        out = signed.join(first, "digest", "left").select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            (F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
            F.coalesce("component", "first", "doc_id").alias("component_id"),
        )
        if split is not None:  # a row of no words under an id that others share
            own = component.select(F.col("id").alias("doc_id"), F.col("component").alias("__own"))
            out = out.join(own, "doc_id", "left").withColumn("component_id", F.coalesce("__own", "component_id")).drop("__own")
        rest = docs.where("doc_id is null")
        return out.unionByName(self.signatures_of_size(rest))

    def signatures_of_size(self, docs: DataFrame) -> DataFrame:
        """Rows without doc_id: their set sizes only."""
        k = self.k

        def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch):
                    yield pa.RecordBatch.from_pydict({"n_shingles": pa.array([len(s) for s in shingle_sets(piece.column(0), k)], pa.int64())})

        sized = docs.select(F.col("text").cast("binary")).mapInArrow(size, "n_shingles long")
        return sized.select(F.lit(None).cast("long").alias("doc_id"), "n_shingles", F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"))


def later(token: np.ndarray) -> np.ndarray:
    """Which counted shingles the second order takes last."""
    return (mix(token, 6) & np.uint64(1)) == 1


def two_prefixes(token: np.ndarray, n: np.ndarray, size: int, early: int, p: int, counted: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that others have too, of n documents each, within the first p of a document's `size` under each order.  early: how
    many of its counted shingles are not later(); shingles of one document alone are the rarest and no longer here."""
    left = p - (size - len(token))
    uncounted = (token & counted) != 0
    first = token[np.lexsort((mix(token, 1), n, uncounted))[: max(left, 0)]]
    if size <= p:  # all are in both prefixes
        return first, first
    late = later(token)
    halves = [token[half][np.lexsort((mix(token[half], 1), n[half]))] for half in (~late, late)]
    alone = early - len(halves[0])
    second = halves[0][: max(p - alone, 0)]
    left = p - early - (size - early - len(halves[1]))  # after the first half, and what is alone in the second
    return first, np.concatenate((second, halves[1][: max(left, 0)]))


def exploded(held: DataFrame) -> DataFrame:
    """(id, cluster, token) from (id, cluster, tokens as bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column(2).to_pylist()
            sizes = [len(t) // 8 for t in tokens]
            yield pa.RecordBatch.from_pydict({"id": np.repeat(batch.column(0).to_numpy(), sizes), "cluster": np.repeat(batch.column(1).to_numpy(), sizes), "token": np.frombuffer(b"".join(tokens), np.int64)})

    return held.mapInArrow(run, "id long, cluster long, token long")


def stars(held: DataFrame, buckets: int) -> DataFrame:
    """(u, v): every document with the least document of those that share a token with it in its cluster, by token; from (id, cluster,
    tokens as bytes).

    Documents of one stretch that share a token are linked at once, and only the least of them goes on, so a token brings
    each bucket at most one row per stretch.  Rows go to buckets of tokens as packed arrays.
    """

    def to_least(doc: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (document, least document of its token) that differ, the tokens and their least documents."""
        order = np.lexsort((doc, token))
        doc, token = doc[order], token[order]
        new = np.concatenate(([True], token[1:] != token[:-1]))[: len(token)]
        first = doc[new][np.cumsum(new) - 1] if len(doc) else doc
        return np.unique(np.stack((doc, first), 1)[doc != first], axis=0), token[new], doc[new]

    def stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                tokens = piece.column(2).to_pylist()
                sizes = [len(t) // 8 for t in tokens]
                doc = np.repeat(piece.column(0).to_numpy(), sizes)
                token = mix(np.frombuffer(b"".join(tokens), np.uint64)) ^ mix(np.repeat(piece.column(1).to_numpy(), sizes).view(np.uint64), 3)
                near, token, doc = to_least(doc, token)
                yield packed(bucket_of(near[:, 0].copy().view(np.uint64), buckets), True, near[:, 0], near[:, 1], None)
                yield packed(bucket_of(token, buckets), False, token.view(np.int64), doc, None)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in bucketwise(batches):
            u, v = joined([x[1:3] for x in rows if x[0]], 2)
            yield pa.RecordBatch.from_pydict({"u": pa.array(u), "v": pa.array(v)})
            token, doc = joined([x[1:3] for x in rows if not x[0]], 2)
            near = to_least(doc, token)[0]
            yield pa.RecordBatch.from_pydict({"u": pa.array(near[:, 0]), "v": pa.array(near[:, 1])})

    sent = held.mapInArrow(stretch, "bucket long, info boolean, a binary, b binary, c binary").repartition("bucket").sortWithinPartitions("bucket")
    return sent.mapInArrow(gather, "u long, v long")


def likely(docs: DataFrame, ids: DataFrame, most_bits: int = 1 << 28) -> DataFrame:
    """Rows of docs whose first column (long) may be among `ids`: a Bloom filter of at most `most_bits`, which a longer
    list fills more densely, so that it lets more rows through but never loses one."""
    keys = ids.select(F.col(ids.columns[0]).cast("string").alias("key"), F.col(ids.columns[0]).alias("a"), F.col(ids.columns[0]).alias("b"))
    level = build_level(keys, max(1, min(keys.count(), most_bits // 10)), 1 / 64, 11)
    sent = docs.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                x = piece.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                yield piece.filter(pa.array(sent.value.holds(x, x)))

    return docs.mapInArrow(run, docs.schema)


def common(sets: list[np.ndarray], columns: int = 16_384) -> np.ndarray:
    """How many elements each two sets share, in a matrix."""
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    doc, token = doc[many := count[token] > 1], token[many]
    _, token = np.unique(token, return_inverse=True)
    shared = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(token, kind="stable")
    doc, token = doc[order], token[order]
    for start in range(0, int(token[-1]) + 1 if len(token) else 0, columns):
        lo, hi = np.searchsorted(token, [start, start + columns])
        width = min(columns, int(token[hi - 1]) - start + 1)
        m = np.zeros((len(sets), width), np.float32)
        m[doc[lo:hi], token[lo:hi] - start] = 1
        shared += m @ m.T  # whole numbers, exact below 2 ** 24 elements
    return shared.astype(np.int64)


def candidates(p0: list[np.ndarray], p1: list[np.ndarray], token: int | None) -> np.ndarray:
    """Which documents share a prefix shingle under both orders; with a token, those whose least common one of the first order it is."""
    may = (common(p0) > 0) & (common(p1) > 0)
    if token is not None:
        least = np.array([token], np.int64).view(np.uint64)[0]
        may &= common([p[p < least] for p in p0]) == 0
    np.fill_diagonal(may, False)
    return may


def similar(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets have 100 * |intersection| >= percent * |union|; no set is similar to itself or to an empty one."""
    sizes, shared = np.array([len(s) for s in sets], np.int64), common(sets)
    near = (100 * shared >= percent * (sizes[:, None] + sizes[None, :] - shared)) & (shared > 0)
    np.fill_diagonal(near, False)
    return near


def roots(near: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The least id reachable from each row of a symmetric relation."""
    least = ids.copy()
    while True:
        new = least.copy()
        for i in range(len(ids)):
            if near[i].any():
                new[i] = min(least[i], least[near[i]].min())
        if (new == least).all():
            return least
        least = new
