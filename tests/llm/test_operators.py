"""The corpus operators on small tables: results against brute force, and nulls, empties, ties, repeats, extra columns."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from concord.llm.byte_bpe import default_bpe
from concord.llm.common import connected_components
from concord.llm.decontaminate import Decontaminator
from concord.llm.jaccard_join import JaccardJoin
from concord.llm.language_id import LanguageProfiles
from concord.llm.multi_index import MultiIndex
from concord.llm.quotation import QuotationLinks
from concord.llm.substring_dedup import SubstringDedup
from concord.llm.token_counts import TokenRollup, deleted, inserted, revised
from concord.llm.toxicity import KneserNeyToxicity, pair_key, words_of
from concord.llm.url_filter import UrlFilter
from tests.llm.test_local_parts import grams_of

DOCS = "doc_id long, text string"
RNG = random.Random(7)
WORDS = ["".join(RNG.choice("abcdefghij") for _ in range(RNG.randrange(2, 9))) for _ in range(400)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def documents():
    """Exact and near copies, chains of copies, nulls, empties, a very long text, repeated rows."""
    rng = random.Random(8)
    out = [(1, None), (2, ""), (3, "\n \t"), (4, "one"), (5, "One"), (6, "two words"), (7, prose(20_000, rng)), (7 * 10**15, prose(30, rng))]
    for g in range(6):
        words = prose(80, rng).split()
        for i in range(8):
            words = list(words)
            if i % 3:
                words[rng.randrange(80)] = rng.choice(WORDS)
            out.append((100 + 10 * g + i, " ".join(words)))
    shared = prose(60, rng)
    out += [(200 + i, prose(20, rng) + " " + shared) for i in range(20)]
    return [*out, out[10], out[10]]


def closure(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = random.Random(9)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)] + [(5, 5), (7, None)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    real = [(a, b) for a, b in pairs if b is not None and a != b]
    assert got == closure({x for p in real for x in p}, real)
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize(("k", "percent", "block"), [(3, 90, 256), (5, 80, 3)])
def test_jaccard_join(spark, documents, k, percent, block):
    df = spark.createDataFrame(documents, DOCS).withColumn("component_id", F.lit("clash"))
    got = sorted(tuple(r) for r in JaccardJoin(k=k, percent=percent, block=block).apply(df).collect())
    sets = []
    for _, t in documents:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    n, links = [0] * len(sets), []
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a & b and 100 * len(a & b) >= percent * len(a | b):
                n[i] += 1
                n[j] += 1
                links.append((documents[i][0], documents[j][0]))
    root = closure([d for d, _ in documents], links)
    assert got == sorted((d, len(s), c, root[d]) for (d, _), s, c in zip(documents, sets, n))


def test_jaccard_join_without_rows_or_ids(spark):
    assert JaccardJoin().apply(spark.createDataFrame([], DOCS)).count() == 0
    assert [tuple(r) for r in JaccardJoin(k=1).apply(spark.createDataFrame([(None, "a b")], DOCS)).collect()] == [(None, 2, 0, None)]


def test_jaccard_join_of_rows_that_share_an_id(spark):
    a = prose(60)
    docs = [(1, a), (2, a + " end"), (1, prose(4_000)), (3, "quite other"), (3, a), (3, None), (4, prose(50)), (4, prose(50))]
    got = [tuple(r) for r in JaccardJoin(k=3, percent=90).apply(spark.createDataFrame(docs, DOCS)).collect()]
    assert sorted(got) == sorted([(1, 58, 2, 1), (2, 59, 2, 1), (1, 3998, 0, 1), (3, 1, 0, 1), (3, 58, 2, 1), (3, 0, 0, 1), (4, 48, 0, 4), (4, 48, 0, 4)])


def test_jaccard_join_verifies_a_chain_link_by_link(spark):
    """Documents of which only neighbours share shingles, far fewer than similarity needs: work that grows with the chain."""
    rng = random.Random(16)
    shared = [prose(3, rng) for _ in range(401)]
    docs = [(i, f"{shared[i]} {' '.join(f'u{i}x{j}' for j in range(30))} {shared[i + 1]}") for i in range(400)]
    docs += [(1000 + i, docs[7 * i][1] + " z") for i in range(20)]
    join = JaccardJoin(k=3, percent=80, block=8)
    got = {r.doc_id: (r.n_links, r.component_id) for r in join.apply(spark.createDataFrame(docs, DOCS)).collect()}
    assert all(got[1000 + i] == got[7 * i] == (1, 7 * i) for i in range(20))
    assert all(got[i][0] == 0 for i in range(400) if i % 7 or i >= 140)


@pytest.mark.parametrize(("percent", "k"), [(80, 1), (90, 1), (80, 3)])
def test_both_orders_together_leave_fewer_pairs_than_either(spark, percent, k):
    """Documents that share some of their words, rare ones among them, and near copies, which no order may lose."""
    rng = random.Random(23)
    docs = [(i, " ".join(rng.sample([f"w{j}" for j in range(1_200)], 90) + [f"own{i}x{j}" for j in range(i % 4)])) for i in range(150)]
    docs += [(1000 + i, t + f" more{i}") for i, t in docs[:40]]
    join = JaccardJoin(k=k, percent=percent)
    rows = join.prefixes(spark.createDataFrame(docs, DOCS).select("doc_id", F.col("text").cast("binary")), np.empty(0, np.uint64), 4).collect()
    by = {o: {frozenset((x.id, y.id)) for i, x in enumerate(rows) for y in rows[:i] if set(np.frombuffer(x[o], np.uint64)) & set(np.frombuffer(y[o], np.uint64))} for o in ("p0", "p1")}
    both = by["p0"] & by["p1"]
    assert all(frozenset((1000 + i, i)) in both for i in range(40))
    if k == 1:
        assert len(both) < 0.9 * min(map(len, by.values()))


def test_byte_bpe(spark, documents):
    import public_tokenizers as P
    import tiktoken

    bpe = default_bpe()
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    rows = [*documents, (8, "naïve café — 日本語 🙂 \r\n  x   "), (9, "a" * 5000), (10, "<|endoftext|> it's"), (11, "nbsp\u00a0\u2003wide\u0085")]
    df = spark.createDataFrame(rows, DOCS).withColumn("n_tokens", F.lit("clash"))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = sorted((d, len(i), sha(" ".join(map(str, i)).encode()), sha((t or "").encode())) for d, t in rows for i in [enc.encode_ordinary(t or "")])
    assert sorted(tuple(r) for r in bpe.digests(df).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == expected
    back = bpe.decode(bpe.encode(df)).select("text", "decoded").collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back)
    words = spark.createDataFrame([(w,) for w in ["hello", " world", "", "ß", "qzxj" * 6, "日本"]], "w string")
    assert all(list(r.ids) == enc.encode_ordinary(r.w) for r in words.select("w", bpe.fold(F.col("w")).alias("ids")).collect())
    assert bpe.digests(spark.createDataFrame([], DOCS)).count() == 0


def test_decontamination(spark):
    items = [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short one"), (3, None), (4, "..."), (10, "short one")]
    docs = [(1, "x alpha, BETA gamma delta epsilon zeta eta theta iota kappa lambda y"), (2, "a short one here"), (3, None), (4, ""), (5, "clean"), (5, "clean")]
    b, d = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, DOCS).withColumn("other", F.lit(1))
    got = {r.doc_id: r for r in Decontaminator().apply(d, b, texts=True).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (got[1].n_words, got[1].n_hit, got[1].n_items, got[1].items_sha256, got[1].clean) == (13, 11, 1, sha("1"), "x  y")
    assert (got[2].n_hit, got[2].n_items, got[2].items_sha256, got[2].other) == (2, 2, sha("10,2"), 1)
    assert (got[3].n_words, got[3].contaminated, got[3].clean) == (0, False, None) and got[4].items_sha256 == sha("")
    split = Decontaminator(benchmark_bytes=20, shard_words=3).apply(d, b).drop("spans").collect()
    assert sorted(map(tuple, split)) == sorted(map(tuple, Decontaminator().apply(d, b).drop("spans").collect()))
    assert Decontaminator().apply(d, b.limit(0)).where("contaminated").count() == 0
    assert Decontaminator().apply(d.limit(0), b).count() == 0
    unnamed = spark.createDataFrame([(None, "short one"), (7, "short one here")], "item_id long, text string")
    r = Decontaminator().apply(d, unnamed).where("doc_id = 2").first()
    assert (r.n_hit, r.n_items, r.items_sha256) == (3, 1, sha("7"))
    long = spark.createDataFrame([(1, "pad " * 2_500_000 + items[0][1]), (2, None)], DOCS)
    assert Decontaminator().apply(long, b).where("doc_id = 1").first().n_hit == 12
    assert Decontaminator().apply(d.withColumn("clean", F.lit(1)), b, texts=True).where("doc_id = 1").first().clean == "x  y"


def test_substring_dedup(spark):
    passage = prose(60).replace(" a", ". A") + "."
    docs = [(3, "First " + passage + " End of three."), (1, "Zero.\n" + passage), (2, passage), (4, None), (5, ""), (6, "Clean text stays as it is."), (None, passage)]
    got = {r.doc_id: r for r in SubstringDedup().apply(spark.createDataFrame(docs, DOCS).withColumn("spans", F.lit(0))).collect()}
    assert got[1].text == docs[1][1] and got[6].text == docs[5][1] and got[4].text is None and got[5].text == "" and got[None].text == passage
    assert got[2].text == "" and got[2].n_removed == 1
    assert len(got[3].text.split()) < 35 and got[3].text.startswith("First")
    cut = [(s.start, s.end) for s in got[3].spans]
    assert sum(e - s for s, e in cut) == got[3].removed_chars
    assert SubstringDedup().apply(spark.createDataFrame([], DOCS)).count() == 0


def test_substring_dedup_against_brute_force(spark):
    """Lines alone (no window is that long): the earliest occurrence of each normalised line stays."""
    rng = random.Random(17)
    lines = [*(prose(rng.randrange(1, 6), rng) for _ in range(25)), "", "  ", "}", "Ähem  ÉTÉ", "ähem été"]
    docs = [(i, "\n".join(rng.choice(lines).upper() if rng.random() < 0.3 else rng.choice(lines) for _ in range(rng.randrange(0, 9)))) for i in range(60)]
    docs += [(100, None), (None, lines[0]), (101, "x" * 10_000_000 + "\n" + lines[0]), (102, lines[1]), (102, lines[1])]
    seen, expected = set(), []
    for i, text in docs:
        out = []
        for line in (text or "").split("\n"):
            key = " ".join(line.lower().split())
            if i is None or i == 102 or not key or key not in seen:
                out.append(line)
            if i is not None and i != 102:
                seen.add(key)
        expected.append((i, text, "\n".join(out)))
    df = spark.createDataFrame(docs, DOCS).withColumn("body", F.lit(1)).withColumn("start", F.lit("clash"))
    got = SubstringDedup(window=10**6).apply(df).collect()
    norm = lambda s: [x.strip() for x in (s or "").split("\n") if x.strip()]
    result = {r.doc_id: r for r in got if r.doc_id != 102}
    for i, text, clean in expected:
        if i != 102:
            assert norm(result[i].text) == norm(clean), i
            at, kept = 0, []
            for s in result[i].spans:
                kept.append(text[at : s.start])
                at = s.end
            assert "".join([*kept, (text or "")[at:]]) == (result[i].text or "")
    assert [r.text for r in got if r.doc_id == 102] == ["", ""] and len(got) == len(docs)
    assert got[0].start == "clash" and got[0].body == 1


def test_substring_dedup_of_hot_units(spark):
    hot, rare = prose(12) + ".", prose(12) + "."
    docs = [(i, f"{prose(12)}.\n{hot}\n{hot}" + f"\n{rare}" * (i % 50 == 7)) for i in range(200)]
    df = spark.createDataFrame(docs, DOCS)
    got = {hot_in: sorted(map(tuple, SubstringDedup(hot=hot_in, salts=5).apply(df).select("doc_id", "text").collect())) for hot_in in (1, 2, 1_000)}
    assert got[1] == got[2] == got[1_000]
    for (d, text), (_, before) in zip(got[2], docs):
        assert text.count(hot) == (d == 0) and text.count(rare) == (d == 7) and text.startswith(before.split("\n")[0])


@pytest.mark.parametrize("script", ["prose", "han", "devanagari"])
def test_substring_dedup_leaves_no_long_repeat(spark, script):
    """Passages of 51 words at any word offset, also without sentence marks or blanks: no 50 words stand twice afterwards."""
    rng = random.Random(15)
    blank = "" if script == "han" else " "
    if script == "prose":
        word = lambda: rng.choice(WORDS)
    else:
        low, high = (0x4E00, 0x9000) if script == "han" else (0x915, 0x939)
        word = lambda: "".join(chr(rng.randrange(low, high)) for _ in range(1 if script == "han" else 4))
    shared = [[word() for _ in range(51)] for _ in range(6)]
    docs = []
    for i in range(36):
        words = [word() for _ in range(rng.randrange(3, 90))] + shared[i % 6] + [word() for _ in range(rng.randrange(3, 90))]
        docs.append((i, blank.join(words).capitalize()))
    docs.append((90, blank.join(shared[0][:1] * 200)))  # one word over and over
    got = sorted(map(tuple, SubstringDedup().apply(spark.createDataFrame(docs, DOCS)).select("doc_id", "text").collect()))
    before = dict(docs)
    seen = {}
    for i, text in got:
        words = list(text.lower()) if script == "han" else text.lower().split()
        assert i >= 6 or text == before[i]  # the first of each passage is whole
        for at in range(len(words) - 49) if i != 90 else []:
            assert seen.setdefault(tuple(words[at : at + 50]), (i, at)) == (i, at)
    assert 26 <= len(dict(got)[90].replace(" ", "")) // len(shared[0][0]) < 76
    assert all(len(text) > 20 * (1 + (blank == " ")) for _, text in got)


def test_language_profiles(spark):
    rng = random.Random(3)
    make = {"xx": "aeiou", "yy": "bcdfg", "zz": "äöüßé"}
    rows = [(i, " ".join("".join(rng.choice(a) for _ in range(rng.randrange(1, 8))) for _ in range(40)), lang) for i in range(60) for lang, a in [list(make.items())[i % 3]]]
    rows += [(100, None, "xx"), (101, "123 !! ½ ² ①", "yy"), (102, "a", None), (103, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    model = LanguageProfiles()
    judged = model.predict(df, model.fit(df))
    got = {r.doc_id: r for r in judged.collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows[:60])
    assert got[100].lang_pred == got[101].lang_pred == got[103].lang_pred == "und" and got[102].lang_pred == "xx"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {r.doc_id for r in model.accept(judged).collect()} == {*range(60), 102}
    assert model.predict(df, {}).where("lang_pred <> 'und'").count() == 0


def test_language_profiles_against_brute_force(spark):
    rng = random.Random(18)
    make = {"xx": "aeioubcdÄ", "yy": "bcdfgaeß", "zz": "äöüßéaeio"}
    word = lambda a: "".join(rng.choice(a) for _ in range(rng.randrange(1, 8)))
    rows = [(i, " ".join(word(list(make.values())[i % 3]) for _ in range(rng.randrange(1, 60))), list(make)[i % 3]) for i in range(45)]
    rows += [(200, " ".join(word("aeiouß") for _ in range(200_000)), "xx"), (201, None, None), (3, rows[3][1], "xx"), (3, rows[3][1], "xx")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    rank = lambda c: sorted(c, key=lambda g: (-c[g], g))[:50]
    total = {}
    for _, text, lang in rows:
        if lang and text:
            total.setdefault(lang, Counter()).update(grams_of(text))
    profiles = {lang: rank(c) for lang, c in total.items()}
    model = LanguageProfiles(size=50)
    for r in model.predict(df, model.fit(df)).collect():
        top = rank(grams_of(r.text))
        away = {lang: sum(abs(p.index(g) - i) if g in p else 50 for i, g in enumerate(top)) for lang, p in profiles.items()}
        best = min(sorted(away), key=away.get)
        assert (r.lang_pred, round(r.score, 9)) == ((best, round(1 - away[best] / (50 * len(top)), 9)) if top else ("und", 0.0))


def test_toxicity_against_brute_force(spark):
    """The class counts, discounts, backoff weights and shared counts of both models, word by word."""
    rng = random.Random(19)
    few = WORDS[:40]
    texts = [(i, " ".join(rng.choice(few[: 40 if i % 2 else 25]) for _ in range(rng.randrange(0, 60)))) for i in range(80)]
    corpus = [*texts, *[(1000 + i, " ".join(rng.choice(WORDS) for _ in range(40))) for i in range(40)], (7, texts[7][1])]
    model = KneserNeyToxicity(least=3)
    docs = spark.createDataFrame(corpus, DOCS)
    got = model.ratios(docs, spark.createDataFrame([(i % 2, t) for i, t in texts], "toxic int, text string"))
    grams = {y: {(u, v, w) for i, t in texts if i % 2 == y for x in [["^", "^", *t.split()]] for u, v, w in zip(x, x[1:], x[2:])} for y in (0, 1)}
    pair = {y: Counter((v, w) for _, v, w in grams[y]) for y in (0, 1)}
    single = {y: Counter(w for _, w in pair[y]) for y in (0, 1)}
    total = lambda c, k: c[0][k] + c[1][k]

    def discount(c):
        once, twice = (sum(n == k for y in (0, 1) for n in c[y].values()) for k in (1, 2))
        return once / (once + 2 * twice) if once and twice else 0.5

    d1, d2 = discount(single), discount(pair)
    own = {w for y in (0, 1) for w in single[y] if total(single, w) >= 3}
    left = {(v, w) for _, t in corpus for x in [["^", *t.split()]] for v, w in zip(x, x[1:])}
    types = {w for _, w in left}
    p = {}
    for y in (0, 1):
        mass = sum(single[y].values())
        back = sum(min(d1, n) if w in own else n for w, n in single[y].items()) / mass
        shared = Counter(b for _, b in left)
        p[y] = {w: (max(single[y][w] - d1, 0) / mass if w in own else 0) + back * shared[w] / len(left) for w in types}
        assert math.isclose(sum(p[y].values()), 1)
    h = lambda w: int(words_of([w])[0][0])
    found = dict(zip(got.words.tolist(), got.word_ratio.tolist()))
    assert found.keys() == {h(w) for w in own}
    assert all(math.isclose(found[h(w)], math.log(p[1][w] / p[0][w]), rel_tol=1e-9) for w in own)
    pairs = {k for y in (0, 1) for k in pair[y] if total(pair, k) >= 3}
    found = dict(zip(got.pairs.tolist(), got.pair_ratio.tolist()))
    assert len(found) == len(pairs)
    b = {v: [] for v, _ in pairs}
    for v in b:
        for y in (0, 1):
            met = {k: n for (a, k), n in pair[y].items() if a == v}
            spare = sum(min(d2, n) if (v, k) in pairs else n for k, n in met.items())
            b[v].append(spare / sum(met.values()) if met else 1.0)
            whole = sum((max(n - d2, 0) if (v, k) in pairs else 0) / sum(met.values()) for k, n in met.items()) + b[v][y] * sum(p[y].values())
            assert math.isclose(whole, 1)
    key = lambda v: 1 if v == "^" else h(v)
    contexts = dict(zip(got.contexts.tolist(), got.context_ratio.tolist()))
    assert contexts.keys() == {key(v) for v in b} and all(math.isclose(contexts[key(v)], math.log(b[v][1] / b[v][0]), rel_tol=1e-9, abs_tol=1e-12) for v in b)
    for v, w in pairs:
        sums = [sum(n for (a, _), n in pair[y].items() if a == v) for y in (0, 1)]
        q = [max(pair[y][v, w] - d2, 0) / max(sums[y], 1) + b[v][y] * p[y][w] for y in (0, 1)]
        k = int(pair_key(np.array([key(v)], np.uint64), np.array([h(w)], np.uint64))[0])
        assert math.isclose(found[k], math.log(q[1] / q[0]), rel_tol=1e-9)
    # features of a text, and of the empty, repeated and very long
    some = texts[3][1].split()
    x = [got.features([" ".join(some[: i + 1])])[0][0] * (i + 1) for i in range(len(some))]
    x = np.diff(np.concatenate(([0.0], x)))
    f = got.features([None, texts[3][1], "", texts[3][1] + " ", "zz " * 1_000_000])
    assert np.allclose(f[1], [x.mean(), *[max(x[max(0, i + 1 - n) : i + 1].sum() / n for i in range(len(x))) for n in (2, 4, 8)]])
    assert (f[0] == 0).all() and (f[2] == 0).all() and np.allclose(f[1], f[3]) and np.allclose(f[4][1:], got.other) and np.isclose(f[4][0], got.other, atol=1e-5)


def test_toxicity(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        words = prose(60, rng).split()
        if i % 8 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vile", "foul", "nasty"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 8 == 0)))
    docs = spark.createDataFrame([*rows, (900, None), (901, "")], DOCS).withColumn("predicted", F.lit("clash")).withColumn("x0", F.lit("kept"))
    marks = spark.createDataFrame([*labels, (5, None), (None, 1), (7, 0)], "doc_id long, toxic int")
    model = KneserNeyToxicity()
    got = {r.doc_id: r for r in model.score(docs, *model.fit(docs, marks.where("doc_id % 3 <> 1"))).collect()}
    held = [i for i in range(400) if i % 3 == 1]
    assert np.mean([got[i].predicted == labels[i][1] for i in held]) > 0.95
    assert got[900].predicted == got[901].predicted == 0 and all(0 <= r.score <= 1 for r in got.values())
    assert got[1].x0 == "kept"
    empty = model.fit(docs, marks.limit(0))
    assert model.score(docs, *empty).count() == 402


def brute(vectors, least):
    links = [[] for _ in vectors]
    for i, (_, a, x) in enumerate(vectors):
        for j, (_, b, y) in enumerate(vectors):
            if i != j and a is not None and a == b and x and y and len(x) == len(y):
                nx, ny = math.sqrt(sum(v * v for v in x)), math.sqrt(sum(v * v for v in y))
                if nx and ny and math.isfinite(nx) and math.isfinite(ny) and sum(p * q for p, q in zip(x, y)) / nx / ny >= least:
                    links[i].append(j)
    return links


def test_multi_index(spark):
    rng = np.random.default_rng(5)
    vectors = []
    for g in range(40):
        base = rng.standard_normal(16)
        for _ in range(5):
            vectors.append((len(vectors), g % 3, [float(np.float32(v)) for v in base + rng.standard_normal(16) * 0.06]))
    base = vectors[0][2]
    vectors += [(300 + i, 1, base) for i in range(30)] + [(400, 1, [2 * v for v in base]), (401, None, base), (402, 1, None), (403, 1, [0.0] * 16), (404, 1, [float("nan")] * 16), (405, 1, [float("inf")] + [0.0] * 15), (406, 1, []), (407, 1, [1.0, 2.0])]
    df = spark.createDataFrame(vectors, "vec_id long, label int, embedding array<float>").withColumn("links", F.lit("clash"))
    for index in (MultiIndex(recall=1.0), MultiIndex(recall=1.0, block=7)):
        got = {r.vec_id: r for r in index.apply(df).collect()}
        links = brute(vectors, 0.98)
        root = closure([v[0] for v in vectors], [(vectors[i][0], vectors[j][0]) for i, x in enumerate(links) for j in x])
        true, found = sum(map(len, links)), sum(r.n_links for r in got.values())
        assert all(got[v[0]].n_links == len(links[i]) for i, v in enumerate(vectors)) and found == true
        assert all(got[v].component_id == root[v] for v in root)
        assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert MultiIndex().apply(df.limit(0)).count() == 0


def test_multi_index_of_rows_that_share_an_id(spark):
    a, b, near = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 1.0, 0.01]
    rows = [(3, 0, a), (7, 0, a), (7, 0, b), (9, 0, near), (9, 0, near), (20, 0, [0.0, 0.0, 1.0]), (20, 1, [0.0, 0.0, 1.0]), (21, 1, [0.0, 0.1, 9.0]), (20, 0, None), (30, None, a), (31, 0, [1.0, None, 0.0]), (None, 0, a)]
    got = [tuple(r) for r in MultiIndex().apply(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect()]
    expected = [(3, 1, 3, True), (7, 1, 3, False), (7, 1, 3, False), (9, 1, 3, False), (9, 1, 3, False), (20, 0, 20, True), (20, 1, 20, True), (21, 1, 20, False), (20, 0, 20, True), (30, 0, 30, True), (31, 0, 31, True), (None, 0, None, True)]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_multi_index_finds_the_wanted_share(spark):
    """The registered recall, on clusters whose members lie at all distances around the threshold."""
    rng = np.random.default_rng(6)
    vectors = []
    for g in range(150):
        base = rng.standard_normal(24)
        base /= np.linalg.norm(base)
        for _ in range(10):
            away = rng.standard_normal(24)
            vectors.append((len(vectors), g % 2, [float(v) for v in base + away / np.linalg.norm(away) * rng.uniform(0, 0.25)]))
    x = np.array([v[2] for v in vectors])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([v[1] for v in vectors])
    near = (x @ x.T >= 0.98) & (label[:, None] == label[None, :]) & ~np.eye(len(x), dtype=bool)
    df = spark.createDataFrame([*vectors, vectors[0], vectors[0]], "vec_id long, label int, embedding array<double>")
    for index, least in ((MultiIndex(), 0.98), (MultiIndex(centroids=40, recall=0.95), 0.93), (MultiIndex(recall=1.0), 1.0)):
        rows = index.apply(df).collect()
        got = {r.vec_id: r.n_links for r in rows}
        assert len(rows) == len(df.collect()) and all(got[i] <= near[i].sum() for i in got)
        assert sum(got.values()) >= least * near.sum()


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("NET", "/fr/", "block"), ("twice.org", "/", "allow"), ("twice.org", "/", "block"), (None, "/", "block")]
URLS = [
    ("https://Example.COM/en/x?q#f", "example.com", "/en/x", "example.com/en/", "block"),
    ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("http://a.b.example.com/en/y", "a.b.example.com", "/en/y", "example.com/en/", "block"),
    ("http://notexample.com/en/y", "notexample.com", "/en/y", "com/", "allow"),
    ("http://example.com", "example.com", "", None, "allow"),
    ("http://x.net/es/1", "x.net", "/es/1", "net/es/", "block"),
    ("http://x.net/fr/1", "x.net", "/fr/1", "net/fr/", "block"),
    ("http://twice.org/", "twice.org", "/", "twice.org/", "block"),
    ("no scheme", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("x://h?a://b/c", "h", "", None, "allow"),
    ("://com/", "com", "/", "com/", "allow"),
]


def test_url_filter(spark):
    pages = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)], "page_id long, url string").withColumn("rule", F.lit(1))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    for f in (UrlFilter(), UrlFilter(filter_rules=2)):
        assert [tuple(r)[1:] for r in f.apply(pages, rules).orderBy("page_id").select("page_id", "host", "path", "rule", "verdict").collect()] == [u[1:] for u in URLS]
    assert UrlFilter().apply(pages, rules.limit(0)).where("rule is not null").count() == 0
    assert UrlFilter().apply(pages.limit(0), rules).count() == 0


def test_url_filter_of_repeats_and_many_path_lengths(spark):
    rules = [("a.org", "/" + "x" * n, "block" if n % 2 else "allow") for n in range(1, 300)] + [("a.org", "/x", "block")]
    pages = [(1, "http://a.org/" + "x" * 250 + "y"), (1, "http://a.org/" + "x" * 250 + "y"), (2, "http://a.org/x"), (3, "http://a.org/")]
    got = UrlFilter().apply(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert sorted((r.page_id, r.rule and len(r.rule), r.verdict) for r in got.collect()) == [(1, 256, "allow"), (1, 256, "allow"), (2, 7, "block"), (3, None, "allow")]


def test_url_cascade_is_exact_on_many_keys(spark):
    hosts = [f"h{i}.org" for i in range(3000)]
    pages = spark.createDataFrame([(i, f"http://{h}/x") for i, h in enumerate(hosts)], "page_id long, url string")
    rules = spark.createDataFrame([(h, "/", "block") for h in hosts[::10]], "host string, path string, verdict string")
    got = {r.page_id for r in UrlFilter().apply(pages, rules).where("verdict = 'block'").collect()}
    assert got == set(range(0, 3000, 10))


def test_url_filter_on_long_hosts_and_clashing_columns(spark):
    host = ".".join(["a"] * 5_000) + ".example.com"
    pages = spark.createDataFrame([(1, f"http://{host}/en/" + "x" * 1_000_000)], "page_id long, url string").withColumns({"_keys": F.lit(1), "_hashes": F.lit(2)})
    r = UrlFilter().apply(pages, spark.createDataFrame(RULES, "host string, path string, verdict string")).first()
    assert (r.host, r.rule, r.verdict, r._keys, r._hashes) == (host, "example.com/en/", "block", 1, 2)


def test_token_rollup_of_two_writers(spark, tmp_path):
    """Of two writers of one id the first to name itself counts; a writer that died before that leaves the id free."""
    schema = "source string, lang string, tokenizer_version string, tokens long"
    rows = lambda n: inserted(spark.createDataFrame([("s", "en", "1", n)], schema))
    a, b = (TokenRollup(spark, str(tmp_path / "rollup")) for _ in range(2))
    assert a.commit("x", rows(1)) and not b.commit("x", rows(100))
    (tmp_path / "rollup" / "commits" / "y").write_bytes(b"")
    assert [r.tokens for r in a.totals().collect()] == [1]
    assert b.commit("y", rows(10)) and not a.commit("y", rows(1000))
    a.compact()
    assert not b.commit("y", rows(1000)) and [r.tokens for r in b.totals().collect()] == [11]
    assert not list((tmp_path / "rollup" / "commits").glob("[xy]"))


def test_token_rollup(spark, tmp_path):
    schema = "source string, lang string, tokenizer_version string, tokens long"
    counts = lambda *x: spark.createDataFrame(x, schema)
    r = TokenRollup(spark, str(tmp_path / "rollup"))
    assert r.totals().count() == 0
    assert r.commit("a", inserted(counts(("s", "en", "1", 10), ("s", "en", "1", 5), (None, None, "1", None))))
    assert not r.commit("a", inserted(counts(("s", "en", "1", 999))))
    assert r.commit("b", deleted(counts(("s", "en", "1", 5))))
    r.compact()
    assert not r.commit("b", deleted(counts(("s", "en", "1", 5))))
    assert r.commit("c", revised(counts(("s", "en", "1", 10)), counts(("s", "de", "2", 12))))
    get = lambda: sorted(((x.source, x.lang, x.tokenizer_version, x.docs, x.tokens) for x in r.totals().collect()), key=str)
    expected = sorted([("s", "de", "2", 1, 12), (None, None, "1", 1, 0)], key=str)
    assert get() == expected
    r.compact()
    r.compact()
    assert get() == expected
    with pytest.raises(ValueError, match="batch id"):
        r.commit("../x", counts())
    assert r.commit("none", inserted(counts())) and not r.commit("none", inserted(counts(("s", "en", "1", 1)))) and get() == expected
    assert r.commit("clash", inserted(counts(("s", "fr", "1", 2), ("s", "fr", "1", 2)).withColumn("docs", F.lit("clash"))).withColumn("batch", F.lit("clash")))
    expected = sorted([*expected, ("s", "fr", "1", 2, 4)], key=str)
    assert get() == expected
    r.compact()
    assert get() == expected and len(list((tmp_path / "rollup" / "base").iterdir())) <= 2


def test_quotation_links(spark):
    m = [
        (1, 0, "user", "Hello there.\nHow are   you?"),
        (1, 1, "assistant", "Other words."),
        (1, 2, "user", "> hello THERE.\n> how are you?\nFine, thanks."),
        (1, 3, "user", ">> hello there.\n>> how are you?\n> Fine, thanks.\nGood."),
        (1, 4, "user", "> How are you?\n> and more that nobody said\nPartly."),
        (1, 5, "user", "> nobody said this\nHm."),
        (1, 6, "user", None), (1, 7, "user", ""), (2, 0, "user", "> Other words."), (None, 0, "user", "> Good."), (1, None, "user", "> Good."),
        (1, 1, "assistant", "Other words."),
    ]
    df = spark.createDataFrame(m, "conv_id long, turn long, role string, text string").withColumn("thread", F.lit("clash"))
    got = {(r.conv_id, r.turn): (r.body, r.n_quoted, r.reply_to, r.thread) for r in QuotationLinks().apply(df).collect()}
    assert QuotationLinks().apply(df).count() == len(m)
    assert got[1, 0] == (m[0][3], 0, None, 0)
    assert got[1, 2] == ("Fine, thanks.", 1, 0, 0)
    assert got[1, 3] == ("Good.", 2, 2, 0)
    assert got[1, 4] == ("Partly.", 1, 0, 0)
    assert got[1, 5] == ("Hm.", 1, None, 5)
    assert got[1, 6] == (None, 0, None, 6) and got[1, 7] == ("", 0, None, 7)
    assert got[2, 0] == ("", 1, None, 0) and got[None, 0] == ("", 1, None, 0) and got[1, None] == ("", 1, None, None)
    assert QuotationLinks().apply(df.limit(0)).count() == 0


def test_quotation_links_of_many_turns_that_say_the_same(spark):
    """Every turn says and quotes one line: each links to the turn before, also over the edge of a stretch; a very long text too."""
    m = [(1, t, "user", ("> Same line.\n" if t else "") + "Same line.") for t in range(60)] + [(1, 70, "user", "> Same line.\n" + "x" * 3_000_000)]
    df = spark.createDataFrame(m, "conv_id long, turn int, role string, text string")
    for stretch in (1_024, 4):
        got = {r.turn: (r.reply_to, r.thread) for r in QuotationLinks(stretch=stretch).apply(df).collect()}
        assert got == {0: (None, 0), 70: (59, 0)} | {t: (t - 1, 0) for t in range(1, 60)}


def test_quotation_links_of_deeper_levels(spark):
    m = [
        (1, 0, "user", "The first word.\nAnd more."),
        (1, 1, "assistant", "The second word."),
        (1, 2, "user", "> > the FIRST word.\n> > and more.\nDeep only."),
        (1, 3, "user", "> edited words\n>> The second word.\nSo be it."),
        (1, 4, "user", "> Deep only.\n>>> The second word.\nLowest level wins."),
        (1, 5, "user", ">> The first word.\n>>> The second word.\nTwo deep ones."),
    ]
    got = {r.turn: (r.body, r.n_quoted, r.reply_to, r.thread) for r in QuotationLinks().apply(spark.createDataFrame(m, "conv_id long, turn long, role string, text string")).collect()}
    assert got[2] == ("Deep only.", 1, 0, 0)
    assert got[3] == ("So be it.", 2, 1, 1)
    assert got[4] == ("Lowest level wins.", 2, 2, 0)
    assert got[5] == ("Two deep ones.", 2, 0, 0)
