"""The pipeline's stages one after the other, each on what the one before kept, and each against brute force on a small table."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from concord.llm import queries as llm
from tests.test_oracle import NAMES, SF, plain


@pytest.fixture(scope="module")
def states(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).toPandas(), stage(spark, docs, SF).schema)
        out.append(docs)
    return out


def test_stages(spark, states):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "substring_dedup", "decontaminate", "encode"]
    start, known, distinct, cut, clean, encoded = states
    assert all(s.columns == start.columns for s in states[:-1])
    assert 0.95 * start.count() <= known.count() <= start.count()
    again = corpus_pipeline.near_duplicates(spark, distinct, SF)
    assert again.count() == distinct.count() < known.count()
    assert cut.count() == clean.count() == encoded.count() == distinct.count()
    found = llm.Decontaminator().apply(clean, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert found.where("contaminated").count() == 0
    assert encoded.where("n_tokens is null").count() == 0


def test_run_gives_the_last_stage(spark, states):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(r.ids_sha256 for r in got.collect()) == sorted(r.ids_sha256 for r in states[-1].collect())


# -- each stage on nulls, empties, repeats, a long text and clashing columns -----------------------

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["lang_pred", "score", "component_id", "body", "start", "spans", "clean", "n_hit", "ids_sha256", "bucket", "__spans_"]


@pytest.fixture(scope="module")
def awkward(spark):
    """Real texts, near copies of them, a benchmark passage, and rows that are null, empty, repeated or without id."""
    rng = random.Random(31)
    real = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) between 400 and 4000").orderBy("doc_id").limit(12).collect()]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(i, t, "en", "a") for i, t in enumerate(real)]
    for i, t in enumerate(real[:4]):
        words = t.split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append((100 + i, " ".join(words), None, "b"))
    rows += [(200, None, "en", None), (201, "", None, "c"), (202, "½ ② 12", "en", "c"), (203, " \n\t", "de", "c"), (None, real[0], "en", "c"), (None, None, None, None)]
    rows += [(3, real[3], "en", "a"), (5, "other words under an id that is there already", "en", "a"), (210, "Before. " + item + " After.", "en", "c"), (211, real[6] * 400, "en", "c")]
    return [(*r, len(r[1]) if r[1] is not None else None) for r in rows]


def staged(spark, awkward, stage):
    df = spark.createDataFrame(awkward, COLUMNS).withColumns({c: F.lit("kept") for c in CLASHES})
    out = dict(corpus_pipeline.STAGES)[stage](spark, df, SF)
    if stage != "encode":
        assert out.columns == df.columns and out.schema["doc_id"].dataType == df.schema["doc_id"].dataType
    got = out.collect()
    assert all(r[c] == "kept" for r in got for c in CLASHES if c != "ids_sha256" or stage != "encode")
    return got


@pytest.mark.parametrize("stage", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_tables(spark, stage):
    df = spark.createDataFrame([], COLUMNS)
    assert dict(corpus_pipeline.STAGES)[stage](spark, df, SF).count() == 0


def test_language_stage(spark, awkward):
    got = staged(spark, awkward, "language_id")
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(((d, t) for d, t, *_ in awkward if t and any(c.isalpha() for c in t)), key=str)


def test_near_duplicate_stage_against_brute_force(spark, awkward):
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    rows = [(d, t, shingles(t)) for d, t, *_ in awkward if d is not None]
    root = {d: d for d, *_ in rows}
    changed = True
    while changed:
        changed = False
        for a, _, x in rows:
            for b, _, y in rows:
                if (a == b or (x & y and 100 * len(x & y) >= 80 * len(x | y))) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    expected = sorted({(d, t) for d, t, *_ in awkward if d is not None and root[d] == d}, key=str) + [(d, t) for d, t, *_ in awkward if d is None]
    assert sorted(((r.doc_id, r.text) for r in staged(spark, awkward, "near_duplicates")), key=str) == sorted(expected, key=str)


def test_substring_stage(spark, awkward):
    """Of lines, and of 50 successive words, no place but the first stays; what is unlike all else stays whole."""
    got = staged(spark, awkward, "substring_dedup")
    assert len(got) == len(awkward) and all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)
    alone = {200, 201, 202, 203, 210, None}
    assert all(r.text in {t for d, t, *_ in awkward if d == r.doc_id} for r in got if r.doc_id in alone or (r.doc_id is not None and r.doc_id < 3))
    lines, runs = {}, {}
    for r in got:
        if r.doc_id in (None, 3, 5):  # rows that share an id keep what only they have
            continue
        words = (r.text or "").lower().split()
        for at in range(len(words) - 49):
            assert runs.setdefault(tuple(words[at : at + 50]), (r.doc_id, at)) == (r.doc_id, at)
        for n, line in enumerate(" ".join(x.lower().split()) for x in (r.text or "").split("\n")):
            whole = {" ".join(x.lower().split()) for d, t, *_ in awkward if d == r.doc_id for x in (t or "").split("\n")}
            if line and line in whole:  # not what a cut has left of a line
                assert lines.setdefault(line, (r.doc_id, n)) == (r.doc_id, n)


def test_decontamination_stage_against_brute_force(spark, awkward):
    words = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[i : i + 10]) for i in range(len(w) - 9)} if len(w) >= 10 else {tuple(w)} if w else set()
    sizes = {len(w) for w in windows}
    got = staged(spark, awkward, "decontaminate")
    assert len(got) == len(awkward) and [r.text for r in got if r.doc_id == 210] == ["Before. . After."]
    expected = []
    for d, t, *_ in awkward:
        w, hit = words(t), set()
        for n in sizes:
            hit |= {p for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in windows for p in range(i, i + n)}
        expected.append((d, None if t is None else [x for i, x in enumerate(w) if i not in hit]))
    assert sorted(((r.doc_id, None if r.text is None else words(r.text)) for r in got), key=str) == sorted(expected, key=str)


def test_encoding_stage_against_tiktoken(spark, awkward):
    import public_tokenizers as P
    import tiktoken

    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=corpus_pipeline.default_bpe().ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = [(d, len(i), sha(" ".join(map(str, i)).encode()), sha((t or "").encode())) for d, t, *_ in awkward for i in [enc.encode_ordinary(t or "")]]
    got = staged(spark, awkward, "encode")
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got), key=str) == sorted(expected, key=str)
    assert "text" not in got[0].asDict()


# -- queries -------------------------------------------------------------------------------------


def test_every_operator_has_a_query():
    found = {int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op")}
    assert found == set(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(llm.ORACLE_SQL))
def test_queries_with_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for n in NAMES:
        c.execute(f"CREATE VIEW {n} AS SELECT * FROM '{SF}/{n}.parquet'")
    got = entry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    cursor = c.execute(llm.ORACLE_SQL[name])
    theirs = [d[0] for d in cursor.description]
    expected = sorted(tuple(plain(r[theirs.index(x)]) for x in columns) for r in cursor.fetchall())
    assert sorted(tuple(plain(r[x]) for x in columns) for r in got.collect()) == expected
