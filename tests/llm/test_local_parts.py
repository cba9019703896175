"""The parts of the corpus operators that run within a task, against plain versions."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import tiktoken

from concord.llm import common, language_id
from concord.llm import decontaminate as dc
from concord.llm.byte_bpe import PairRanks, default_bpe, merge
from concord.llm.common import BLANKED, bytes_of, characters_of, shingle_sets
from concord.llm.jaccard_join import JaccardJoin, candidates, common as shared, roots, similar
from concord.llm.substring_dedup import units, without


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers as P

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=default_bpe().ranks, special_tokens={})


@pytest.mark.parametrize("word", ["", "hello", " Straße", "x" * 300, "ab" * 200, "日本語テキスト", "🙂🙂", "\r\n", "antidisestablishmentarianism" * 5])
def test_merge_is_what_tiktoken_does(reference, word):
    assert list(merge(word.encode(), default_bpe().ranks)) == reference._core_bpe.encode_single_piece(word.encode()) if word else merge(b"", default_bpe().ranks) == ()


def test_merge_on_random_words(reference):
    rng = random.Random(1)
    for _ in range(300):
        w = bytes(rng.choice(b"aabbeinrst hg") for _ in range(rng.randrange(1, 120)))
        assert list(merge(w, default_bpe().ranks)) == reference._core_bpe.encode_single_piece(w)


def test_merging_many_words_is_merging_each(reference):
    rng = random.Random(11)
    ranks = default_bpe().ranks
    words = [bytes(rng.choice(b"aabbeinrst hg\xc3\xa9") for _ in range(rng.randrange(0, 90))) for _ in range(2000)]
    assert PairRanks(ranks).merged(words) == [merge(w, ranks) for w in words]


@pytest.mark.parametrize("stretch", [1 << 18, 7])
def test_words_are_what_blanks_part(monkeypatch, stretch):
    monkeypatch.setattr(common, "STRETCH", stretch)
    texts = ["One two  three", None, "", " \n ", "one", "x" * 50 + " TWO", "a\x0bé\u00a0b", "one two three"]
    column = pa.array([None if t is None else t.encode() for t in texts], pa.binary())
    for cut in (0, 2):  # a slice of a column
        h, start, end, first = BLANKED.words(*bytes_of(column.slice(cut)))
        codes = bytes_of(column.slice(cut))[0].tobytes()
        expected = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts[cut:]]
        assert [codes[s:e] for s, e in zip(start, end)] == [w for x in expected for w in x]
        assert np.diff(first).tolist() == list(map(len, expected))
        same = {w.lower() for x in expected for w in x}
        assert len(set(h.tolist())) == len(same)
        assert all(len({k for k, v in zip(h.tolist(), [w for x in expected for w in x]) if v.lower() == s}) == 1 for s in same)


def test_shingles():
    sets = lambda *x: shingle_sets(pa.array(x, pa.binary()), 3)
    assert list(map(len, sets(None, b" \t\n", b"One two", b"a b c d a b c", b"", b"a b c"))) == [0, 0, 1, 4, 0, 1]
    assert (sets(b"One two")[0] == sets(b"one\x0btwo")[0]).all()
    a, b, c = sets(b"a b c", b"c b a", b"x\na b c")
    assert not (a == b).any() and a[0] in c


def grams_of(text):
    """n-grams of a text's words, by code points as the operator packs them."""
    out = collections.Counter()
    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text or "")
    for word in "".join(c if c.isalpha() else " " for c in low).split(" "):
        for gram in list(word) + [f" {word} "[i : i + n] for n in (2, 3) for i in range(len(word) + 3 - n) if word]:
            out[sum(ord(c) << 21 * i for i, c in enumerate(gram))] += 1
    return out


@pytest.mark.parametrize("stretch", [1 << 18, 40, 7])
def test_gram_counts(monkeypatch, stretch):
    monkeypatch.setattr(common, "STRETCH", stretch)
    monkeypatch.setattr(language_id, "STRETCH", stretch)
    rng = random.Random(12)
    texts = ["Hello World", None, "", "½ ² ①", "a", "Ünï-cödé Straße 日本 x1y2", "İstanbul I", " ".join("".join(rng.choice("abcÄé ½-\n") for _ in range(rng.randrange(9))) for _ in range(200))]
    got = [dict(zip(g.tolist(), n.tolist())) for g, n in language_id.gram_counts(texts, 3)]
    assert got == [dict(grams_of(t)) for t in texts]


def test_prefix_lengths_lose_no_pair():
    rng = random.Random(2)
    for k, percent in ((3, 90), (5, 80)):
        join = JaccardJoin(k=k, percent=percent)
        for _ in range(500):
            n = rng.randrange(1, 60)
            a = set(rng.sample(range(80), min(n, 80)))
            b = set(a)
            for _ in range(rng.randrange(0, 6)):
                b.symmetric_difference_update({rng.randrange(80)})
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                assert set(sorted(a)[: join.prefix(len(a))]) & set(sorted(b)[: join.prefix(len(b))])


def test_similar_and_roots():
    rng = random.Random(3)
    base = [rng.sample(range(10_000), 40) for _ in range(5)]
    sets = [np.array(sorted({*b[rng.randrange(4) :], rng.randrange(10_000)}), np.uint64) for b in base for _ in range(6)] + [np.empty(0, np.uint64)]
    near = similar(sets, 85)
    assert (shared(sets, columns=16) == shared(sets)).all()
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            common = len(np.intersect1d(a, b))
            assert near[i, j] == (i != j and common > 0 and 100 * common >= 85 * (len(a) + len(b) - common))
    ids = np.array(rng.sample(range(1000), len(sets)))
    got = roots(near, ids)
    for i in range(len(sets)):
        seen, todo = {i}, [i]
        while todo:
            new = set(np.flatnonzero(near[todo.pop()]).tolist()) - seen
            seen |= new
            todo += new
        assert got[i] == min(ids[list(seen)])


def test_fm_index():
    rng = np.random.default_rng(4)
    for symbols, n in ((2, 1), (3, 50), (5, 400), (40, 1000)):
        seq = rng.integers(1, symbols + 1, n)
        index = dc.FMIndex(seq, symbols + 2)
        patterns = rng.integers(1, symbols + 2, (50, 3))
        lo, hi = index.search(patterns)
        for p, a, b in zip(patterns, lo, hi):
            expected = [i for i in range(n - 2) if (seq[i : i + 3] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == expected


def test_occurrences_against_brute_force():
    rng = random.Random(5)
    vocabulary = [b"w%d" % i for i in range(12)]
    for size in (1, 2, 3, 10):
        items = [(str(i), [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2, 4, 12]))]) for i in range(6)]
        docs = [[rng.choice([*vocabulary, b"other"]) for _ in range(rng.randrange(0, 60))] + items[rng.randrange(6)][1] for _ in range(20)]
        windows = dc.Windows(items, size)
        got = dc.occurrences([np.array([windows.vocabulary.get(w, 0) for w in d], np.int64) for d in docs], windows)
        for d, (spans, found) in zip(docs, got):
            hit, names = set(), set()
            for name, words in items:
                for w in [words[i : i + size] for i in range(len(words) - size + 1)] if len(words) >= size else [words] if words else []:
                    for at in range(len(d) - len(w) + 1):
                        if d[at : at + len(w)] == w:
                            hit.update(range(at, at + len(w)))
                            names.add(name)
            assert {p for s, e in spans for p in range(s, e)} == hit
            assert found == names


def test_cut():
    text = "One, two THREE four-five six.".encode()
    assert dc.words_of(text) == [b"one", b"two", b"three", b"four", b"five", b"six"]
    assert dc.cut(text, [(1, 3), (4, 5)]) == b"One,  four- six."


def test_candidates_share_prefixes_under_both_orders():
    p0 = [np.array(x, np.uint64) for x in ([1, 2], [2, 3], [1, 2], [9])]
    p1 = [np.array(x, np.uint64) for x in ([5], [5, 6], [6], [5])]
    pairs = lambda m: {(int(i), int(j)) for i, j in zip(*np.nonzero(m)) if i < j}
    assert pairs(candidates(p0, p1, None)) == {(0, 1), (1, 2)}
    assert pairs(candidates(p0, p1, 2)) == {(0, 1), (1, 2)} and pairs(candidates(p0, p1, 3)) == set()
    assert pairs(candidates(p0, [np.array([5], np.uint64)] * 4, 2)) == {(0, 1), (1, 2)}  # 0 and 2 share 1 as well


def test_units_are_lines_and_runs():
    text, hi, lo, start, end = units(["A b\n\n c  D \nA  B", None, "x\na b"], 50)
    spans = list(zip(text.tolist(), start.tolist(), end.tolist()))
    assert spans == [(0, 0, 4), (0, 5, 12), (0, 12, 16), (2, 0, 2), (2, 2, 5)]
    assert len(set(zip(hi.tolist(), lo.tolist()))) == 3 and hi[0] == hi[2] == hi[4]
    words = [f"w{i}" for i in range(200)]
    inside, other = " ".join(words[50:110]), " ".join(["y"] * 30 + words[50:110] + ["z"] * 30)
    _, a, *_ = units([inside], 50)
    _, b, *_ = units([other], 50)
    assert set(a.tolist()) & set(b.tolist())
    assert len(units([], 50)[0]) == len(units([None, ""], 50)[0]) == 0
    codes, rows = characters_of(["ab", None, "c"])
    assert codes.tolist() == [97, 98, 99] and rows.tolist() == [0, 2, 2, 3]


def test_without():
    assert without("ab cd ef", [(0, 2), (6, 8)]) == (" cd ", [(0, 2), (6, 8)])
    assert without("ab cd ef", [(0, 2), (3, 5)]) == (" ef", [(0, 5)])
