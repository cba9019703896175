"""Importance resampling, license scans and ranked search: against brute force, and on nulls, empties, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from concord.llm import importance, lexical_search
from concord.llm.importance import ImportanceResampler
from concord.llm.lexical_search import LexicalSearch
from concord.llm.license_scan import BELIEF, LicenseScan, Rule, method_rules, phrase_rule, signature

DOCS = "doc_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]


def prose(n, rng, words=60):
    return " ".join(rng.choice([f"w{i}", f"W{i}", f"ü{i}é"]) for i in (int(words * rng.random() ** 2) for _ in range(n)))


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(31)
    out = [(i, prose(rng.randrange(0, 60), rng)) for i in range(120)]
    out += [(200, None), (201, ""), (202, " .,\n"), (203, "one"), (204, prose(30_000, rng)), (205, "StraßeK İx_y Ab9-9bA"), (7 * 10**15, prose(25, rng))]
    return [*out, out[5], out[5], (None, prose(30, rng))]


# -- 11 ------------------------------------------------------------------------------------------


def drawn(documents, target, longest=1, buckets=10_000, percent=10, least=20, seed=2024):
    grams = lambda w: [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = (Counter(bucket(g) for x in texts for g in grams(words_of(x))) for texts in ([x for _, x in documents], target))
    n, m = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (n + buckets) / ((s[b] + 1) * (m + buckets)))) for b in s}
    rows = []
    for d, x in documents:
        w = words_of(x)
        weight = sum(gain[bucket(g)] for g in grams(w))
        h = None if d is None else int(hashlib.sha256(f"{seed}:{d}".encode()).hexdigest()[:8], 16)
        rows.append([d, len(grams(w)), weight, None if d is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(w)])
    may = sorted((r for r in rows if r[5] >= least and r[0] is not None), key=lambda r: (-r[3], r[0]))
    for i, r in enumerate(may[: len(may) * percent // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


TARGET = ["W1 w2 w3 w4", "ü1é ü2é w1 w2", None, "", "nowhere else"]


@pytest.mark.parametrize("how", [{}, {"longest": 3, "buckets": 50, "percent": 40, "stretch_bytes": 2_000}, {"least_words": 0, "percent": 100}])
def test_importance_against_brute_force(spark, documents, how):
    docs = spark.createDataFrame(documents, DOCS).withColumn("weight", F.lit("clash")).withColumn("place", F.lit(1)).repartition(3)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string").withColumn("doc_id", F.lit("clash"))
    got = ImportanceResampler(**how).apply(docs, target)
    given = {"least" if k == "least_words" else k: v for k, v in how.items() if k != "stretch_bytes"}
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and set(dict(got.dtypes).values()) == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=str) == drawn(documents, TARGET, **given)


def test_importance_of_empty_tables(spark, documents):
    docs, target = spark.createDataFrame(documents[:40], DOCS), spark.createDataFrame([(t,) for t in TARGET], "text string")
    assert ImportanceResampler().apply(docs.limit(0), target).count() == 0
    got = ImportanceResampler().apply(docs, target.limit(0)).collect()
    assert sorted(map(tuple, got), key=str) == drawn(documents[:40], [])


def test_words_that_share_an_id_get_other_ids(spark, documents, monkeypatch):
    """With a hash of which the first gives all words of a length one id, results are those of others."""
    alphabet = importance.alphabet
    monkeypatch.setattr(importance, "alphabet", lambda salt: importance.Alphabet(importance.KINDS, np.zeros(256, np.uint8)) if salt == 0 else alphabet(salt))
    salts = []
    read = ImportanceResampler.read

    def seen(self, texts, salt):
        salts.append(salt)
        return read(self, texts, salt) if salt else with_one_id(self, texts)

    def with_one_id(self, texts):  # workers don't see the patch: words lose their letters before they are hashed
        held = read(self, texts, 0)
        return held.withColumn("g0", F.when(F.col("g0").isNotNull(), F.length(F.col("word").cast("string")).cast("long")))

    monkeypatch.setattr(ImportanceResampler, "read", seen)
    docs, target = spark.createDataFrame(documents[:40], DOCS), spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = ImportanceResampler().apply(docs, target).collect()
    assert salts == [0, 1] and sorted(map(tuple, got), key=str) == drawn(documents[:40], TARGET)


# -- 12 ------------------------------------------------------------------------------------------

LICENSES = [
    ("Released under the MIT License.", 1, 1, 1, "mit", "mit"),
    ("under the mit license under the mit-license", 2, 0, 4, "mit", "mit"),
    ("Licensed under the Apache License, Version 2.0.", 1, 3, 3, "apache-2", "apache-2,apache-2.0"),
    ("cc by nc by nc cc-by-nc", 2, 0, 5, "cc-by-nc", "cc-by-nc"),
    ("CC BY-NC-SA 4.0 International", 1, 0, 0, "cc-by-nc", "cc-by-nc,cc-by-nc-sa-4.0"),
    ("SPDX-License-Identifier: GPL-3.0-or-later", 0, None, None, "", "gpl-3.0-or-later"),
    ("GNU Lesser General Public License v2.1 or (at your option) any later version", 0, None, None, "", "lgpl-2.1-or-later"),
    ("the GNU General Public Licence", 0, None, None, "", "gpl"),
    ("Mozilla Public License 2.0 and the BSD 3-Clause License", 0, None, None, "", "bsd-3-clause,mpl-2.0"),
    ("Creative Commons Attribution-NonCommercial-ShareAlike 3.0", 0, None, None, "", "cc-by-nc-sa-3.0"),
    ("unlicensed undergraduates mitigate bsds", 0, None, None, "", ""),
    ("a license of no kind; all copyright", 0, None, None, "", ""),
    ("All rights reserved.", 0, None, None, "", "proprietary"),
    (None, 0, None, None, "", ""), ("", 0, None, None, "", ""), (" \n.", 0, None, None, "", ""),
    ("mit license " * 30_000 + "under the mit license", 1, 60_000, 60_000, "mit", "mit"),
]


def test_license_scan(spark):
    rows = [(i, t) for i, (t, *_) in enumerate(LICENSES)] + [(1, LICENSES[1][0]), (None, LICENSES[0][0])]
    docs = spark.createDataFrame(rows, DOCS).withColumn("labels", F.lit("clash")).withColumn("rid", F.lit(7)).withColumn("found", F.lit(7))
    got = sorted(map(tuple, LicenseScan().apply(docs).collect()), key=str)
    belief = lambda t, labels, base: 0.0 if not labels else 1.0 if base else None
    by_id = {r[0]: r for r in got}
    for i, (t, n, first, last, base, labels) in enumerate(LICENSES):
        r = by_id[i]
        assert r[1:7] == (len(words_of(t)), n, first, last, base, labels), (t, r)
        assert belief(t, labels, base) in (None, r[7]) and 0 <= r[7] <= 1 and (r[7] > 0) == bool(labels)
    assert len(got) == len(rows) and sum(r[0] == 1 for r in got) == 2 and by_id[None][1:] == by_id[0][1:]
    assert LicenseScan().apply(docs.limit(0)).count() == 0


def brute_scan(scan, text):
    """Detections one by one, and each against each."""
    words = words_of(text)
    line = " " + "  ".join(words) + " " if words else ""
    found = []
    for i, r in enumerate(scan.all_rules()):
        if all(k in line for k in r.keywords):
            for m in re.finditer(r.regex, line):
                start = line[: m.start()].count(" ") // 2
                found.append((start, start + (r.width or m[0].count(" ") // 2), r.priority, i, r.label))
    def hidden(d):
        return d[2] > 0 and any(e is not d and e[0] <= d[0] and e[1] >= d[1] and (e[2] < d[2] or e[2] == d[2] and (e[1] - e[0], -e[3]) > (d[1] - d[0], -d[3])) for e in found)

    kept = [d for d in found if not hidden(d)]
    base = [d for d in kept if d[2] == 0]
    join = lambda x: ",".join(sorted({d[4] for d in x}))
    return (len(words), len(base), min((d[0] for d in base), default=None), max((d[0] for d in base), default=None), join(base), join(kept), max((BELIEF[d[2]] for d in kept), default=0.0))


def test_license_scan_against_brute_force(spark):
    rng = random.Random(12)
    pieces = [t for t, *_ in LICENSES[:13]] + ["GPL v2", "version 2.0", "or later", "cc0 1.0 universal", "public domain", "licensed under the terms of the", "GNU", "Apache", "license", "x", "ü"]
    texts = [" ".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9))) for _ in range(150)]
    rules = [Rule("a-b", 1, ("licen",), signature("a ~b licen[sc]e")), Rule("b", 2, ("b",), signature("b licen[sc]e")), Rule("wide", 2, ("licen",), signature("~x a b licen[sc]e ~x")), Rule("b-too", 2, ("b",), signature("b licen[sc]e"))]
    own = LicenseScan((("aa", "a a"), ("one", "a")), tuple(rules))
    texts_ab = [" ".join(rng.choice(["a", "b", "license", "x", "licence"]) for _ in range(rng.randrange(0, 14))) for _ in range(150)]
    for scan, given in ((LicenseScan(), texts), (own, texts_ab)):
        got = {r.doc_id: tuple(r)[1:] for r in scan.apply(spark.createDataFrame(list(enumerate(given)), DOCS)).collect()}
        for i, t in enumerate(given):
            assert got[i] == brute_scan(scan, t), (t, got[i], brute_scan(scan, t))


def test_rules():
    rules = method_rules()
    assert len(rules) > 300 and len({r.regex for r in rules}) == len(rules) and all(r.keywords and 1 <= r.priority < len(BELIEF) for r in rules)
    assert phrase_rule("x", "a a") == Rule("x", 0, ("a",), " a (?= a )", 2)


# -- 13 ------------------------------------------------------------------------------------------


def ranked(documents, items, k=10):
    docs = [(d, Counter(words_of(t))) for d, t in documents]
    docs = [(d, c) for d, c in docs if c]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(w for _, c in docs for w in c)
    weight = {w: math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for w, x in df.items()}
    out = []
    for item, text in items:
        scores = []
        for d, c in docs:
            m = 100 - 90 + (90 * sum(c.values()) * n) // total
            score = sum(weight[w] * ((1_000_000_000 * c[w]) // (1000 * c[w] + 8 * m)) for w in set(words_of(text)) if w in c)
            scores += [(-score, d is None, d, score)] * (score > 0)
        out += [(item, i + 1, d, s) for i, (_, _, d, s) in enumerate(sorted(scores, key=lambda x: x[:2] + ((x[2],) if x[2] is not None else (0,)))[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("how", [{}, {"shard_docs": 7, "leaf": 2, "fanout": 2, "group_terms": 5, "query_bytes": 60}, {"k": 3, "shard_postings": 40, "leaf": 1}])
def test_lexical_search_against_brute_force(spark, documents, how):
    rng = random.Random(13)
    items = [(i, prose(rng.randrange(1, 25), rng)) for i in range(15)] + [(50, None), (51, ""), (52, "unheard-of"), (53, "w1 W1 w1"), (53, "w2"), (None, "w3 w4"), (54, prose(3_000, rng))]
    docs = spark.createDataFrame(documents, DOCS).withColumn("n", F.lit("clash")).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("q", F.lit("clash")).withColumn("score", F.lit("clash"))
    got = LexicalSearch(**how).apply(docs, asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert sorted(map(tuple, got.collect()), key=str) == ranked(documents, items, how.get("k", 10))


def test_lexical_search_with_longer_ranges_for_many_terms(spark, monkeypatch):
    rng = random.Random(14)
    docs = [(i, " ".join(f"t{rng.randrange(3_000)}" for _ in range(40))) for i in range(300)]
    items = [(1, " ".join(f"t{i}" for i in range(3_000))), (2, "t1 t2 t3")]
    shards, shard = [], lexical_search.Shard.trees
    one = lexical_search.Shard(list(range(300)), np.repeat(np.arange(300), 10), np.tile(np.arange(10), 300), np.ones(3_000, np.int64), 1, 8)
    for one.leaf in (1, 7, 300, 1_000):
        trees = shard(one, np.arange(10))
        shards.append(one.search(np.arange(10), np.arange(10), trees, 3))
    assert all(sorted(s) == [(10, 0), (10, 1), (10, 2)] for s in shards)
    got = LexicalSearch(group_terms=10).apply(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == ranked(docs, items)


def test_lexical_search_opens_ranges_of_equal_bounds(spark):
    """Many documents with one score: the smallest ids win, wherever they lie."""
    docs = [(1_000 - i, "same words here") for i in range(200)] + [(5, "same words here"), (2, None)]
    got = LexicalSearch(shard_docs=64, leaf=4, fanout=4).apply(spark.createDataFrame(docs, DOCS).coalesce(1), spark.createDataFrame([("a", "words same")], "item_id string, text string"))
    assert [(r.item_id, r.rank, r.doc_id) for r in got.orderBy("rank").collect()] == [("a", 1, 5)] + [("a", i + 1, 799 + i + 1) for i in range(1, 10)]


def test_lexical_search_of_empty_tables(spark, documents):
    docs, items = spark.createDataFrame(documents, DOCS), spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert LexicalSearch().apply(docs.limit(0), items).count() == 0 and LexicalSearch().apply(docs, items.limit(0)).count() == 0
    assert LexicalSearch().apply(docs.where("text is null"), items).count() == 0


def test_a_search_leaves_ranges_closed():
    """Best first: with one document far above all others, few ranges are opened."""
    n = 4_096
    doc, term = np.arange(n), np.zeros(n, np.int64)
    value = np.full(n, 10)
    value[3_000] = 1_000
    shard = lexical_search.Shard(list(range(n)), doc, term, value, 16, 8)
    trees = shard.trees(np.array([0]))
    assert [t.shape[1] for t in trees] == [256, 32, 4]
    opened, bincount = [], np.bincount
    try:
        np.bincount = lambda *a, **b: opened.append(1) or bincount(*a, **b)
        assert shard.search(np.array([0]), np.array([0]), trees, 1) == [(1_000, 3_000)]
    finally:
        np.bincount = bincount
    assert len(opened) == 1


def test_ranks_are_no_part_of_the_plan(spark):
    """Else each description of the plan that the driver holds takes megabytes."""
    from concord.llm.byte_bpe import default_bpe

    bpe = default_bpe()
    docs = spark.createDataFrame([("the straße the straße überall überall the of of",)] * 3, "text string")
    found = bpe.folded_words(docs)
    assert len(found._jdf.queryExecution().toString()) < 200_000
    literal = found.select("word", "ids", bpe.fold(F.col("word")).alias("want")).collect()
    assert {r.word for r in literal} == {" straße", " the", " überall", " of"} and all(r.ids == r.want for r in literal)
