"""Queries over the synthetic tables, one per corpus operator, and SQL for those that it can express."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.byte_bpe import default_bpe
from concord.llm.common import materialise, shared_dir
from concord.llm.decontaminate import Decontaminator
from concord.llm.importance import ImportanceResampler
from concord.llm.jaccard_join import JaccardJoin
from concord.llm.language_id import LanguageProfiles
from concord.llm.lexical_search import LexicalSearch
from concord.llm.license_scan import BELIEF, LicenseScan, phrase_rule, signature
from concord.llm.multi_index import MultiIndex
from concord.llm.quotation import QuotationLinks
from concord.llm.substring_dedup import SubstringDedup
from concord.llm.token_counts import TokenRollup, deleted, inserted, revised
from concord.llm.toxicity import KneserNeyToxicity
from concord.llm.url_filter import UrlFilter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(n: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


#: Tokenizer versions of op1 as patterns of a token.
TOKEN = {"words-1": r"[^ \t\n\r]+", "marks-2": r"[\p{L}\p{N}]+|[^\p{L}\p{N} \t\n\r]", "letters-2": r"[\p{L}\p{N}]+"}


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches: all documents under two versions, the low-quality ones deleted, the toxic ones' second
    counts revised to leave out marks; the third batch is committed twice."""
    docs = table(spark, sf_dir, "documents")
    counts = materialise(docs.select("doc_id", "source", "lang", *[F.coalesce(F.regexp_count("text", F.lit(p)), F.lit(0)).alias(v) for v, p in TOKEN.items()]), "counts")
    labels = table(spark, sf_dir, "labels")

    def version(rows: DataFrame, name: str, column: str) -> DataFrame:
        return rows.select("source", "lang", F.lit(name).alias("tokenizer_version"), F.col(column).alias("tokens"))

    poor = counts.join(labels.where("quality = 0").select("doc_id").distinct(), "doc_id", "left_semi")
    toxic = counts.join(labels.where("toxic = 1 and quality = 1").select("doc_id").distinct(), "doc_id", "left_semi")
    rollup = TokenRollup(spark, f"{shared_dir(spark).rstrip('/')}/rollup-{uuid.uuid4().hex}")
    rollup.commit("load-words-1", inserted(version(counts, "words-1", "words-1")))
    rollup.commit("load-marks-2", inserted(version(counts, "marks-2", "marks-2")))
    gone = deleted(version(poor, "words-1", "words-1").unionByName(version(poor, "marks-2", "marks-2")))
    for _ in range(2):
        rollup.commit("drop-poor", gone)
    rollup.compact()
    rollup.commit("revise-toxic", revised(version(toxic, "marks-2", "marks-2"), version(toxic, "marks-2", "letters-2")))
    return rollup.totals()


OP1_SQL = r"""
WITH counted AS (SELECT d.source, d.lang,
       l.poor, l.toxic,
       coalesce(len(regexp_extract_all(d.text, '[^ \t\n\r]+')), 0) AS w,
       coalesce(len(regexp_extract_all(d.text, '[\p{L}\p{N}]+|[^\p{L}\p{N} \t\n\r]')), 0) AS m,
       coalesce(len(regexp_extract_all(d.text, '[\p{L}\p{N}]+')), 0) AS p
       FROM documents d LEFT JOIN (SELECT doc_id, bool_or(quality = 0) AS poor, bool_or(toxic = 1 AND quality = 1) AS toxic
                                   FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id),
kept AS (SELECT source, lang, 'words-1' AS tokenizer_version, w AS tokens FROM counted WHERE NOT coalesce(poor, false)
         UNION ALL
         SELECT source, lang, 'marks-2', CASE WHEN toxic THEN p ELSE m END FROM counted WHERE NOT coalesce(poor, false))
SELECT source, lang, tokenizer_version, count(*)::BIGINT AS docs, sum(tokens)::BIGINT AS tokens
FROM kept GROUP BY ALL
"""


#: The rules of op2, in order.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return UrlFilter().apply(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = """
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
       ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (SELECT page_id,
       translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
       regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fits AS (SELECT p.page_id, r.host || r.path AS rule, r.verdict,
       row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS place
       FROM parsed p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parsed p LEFT JOIN fits f ON p.page_id = f.page_id AND f.place = 1
"""


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = LanguageProfiles()
    profiles = model.fit(docs.where(remainder(4) != 2))
    return model.predict(docs.select("doc_id", "text"), profiles).select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = KneserNeyToxicity()
    ratios, weights = model.fit(docs, table(spark, sf_dir, "labels").where(remainder(3) != 1).select("doc_id", "toxic"))
    return model.score(docs, ratios, weights).select("doc_id", (remainder(3) == 1).alias("held_out"), "score", "predicted")


def op5_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and messages that quote them: every second turn is quoted by a later one, every fourth by one more, a level deeper."""
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")

    def quoting(rows: DataFrame, later: int, mark: str, rest: str) -> DataFrame:
        text = F.concat(F.lit(mark), F.replace("text", F.lit("\n"), F.lit("\n" + mark)), F.lit(rest))
        return rows.where("text is not null").select("conv_id", (F.col("turn") + later).alias("turn"), F.lit("quotes").alias("role"), text.alias("text"))

    once, twice = quoting(said.where("turn % 2 = 0"), 1_000_000, "> ", "\nagreed"), quoting(said.where("turn % 4 = 0"), 2_000_000, "> > ", "\n> agreed\nso do I")
    return QuotationLinks().apply(said.unionByName(once).unionByName(twice))


OP5_SQL = r"""
WITH talk AS (SELECT conv_id, turn, role, text FROM conversations
         UNION ALL SELECT conv_id, turn + 1000000, 'quotes', '> ' || replace(text, chr(10), chr(10) || '> ') || chr(10) || 'agreed' FROM conversations WHERE turn % 2 = 0 AND text IS NOT NULL
         UNION ALL SELECT conv_id, turn + 2000000, 'quotes', '> > ' || replace(text, chr(10), chr(10) || '> > ') || chr(10) || '> agreed' || chr(10) || 'so do I' FROM conversations WHERE turn % 4 = 0 AND text IS NOT NULL),
m AS (SELECT conv_id, turn, role, text, row_number() OVER () AS id FROM talk),
raw AS (SELECT m.id, conv_id, turn, u.pos, u.raw FROM m, LATERAL (SELECT unnest(l) AS raw, generate_subscripts(l, 1) AS pos
        FROM (SELECT regexp_split_to_array(text, '\r?\n') AS l)) u WHERE text IS NOT NULL),
lines AS (SELECT id, conv_id, turn, pos, len(regexp_replace(regexp_extract(raw, '^[ \t]*(?:>[ \t]*)+'), '[^>]', '', 'g')) AS level,
          regexp_replace(raw, '^[ \t]*(?:>[ \t]*)+', '') AS line FROM raw),
marked AS (SELECT *, CASE WHEN level = lag(level) OVER (PARTITION BY id ORDER BY pos) THEN 0 ELSE 1 END AS new FROM lines),
runs AS (SELECT *, sum(new) OVER (PARTITION BY id ORDER BY pos) AS run FROM marked),
norm AS (SELECT id, conv_id, turn, pos, level, run, line, trim(regexp_replace(lower(line), '\s+', ' ', 'g')) AS n FROM runs),
passages AS (SELECT id, conv_id, turn, run, any_value(level) AS level, string_agg(line, chr(10) ORDER BY pos) AS passage,
             trim(regexp_replace(lower(string_agg(line, chr(10) ORDER BY pos)), '\s+', ' ', 'g')) AS whole,
             arg_min(n, pos) FILTER (n <> '') AS first FROM norm GROUP BY id, conv_id, turn, run),
offers AS (SELECT conv_id, turn, whole AS key FROM passages WHERE level = 0 UNION SELECT conv_id, turn, n FROM norm WHERE level = 0),
links AS (SELECT p.id, p.run, p.level, max(a.turn) AS by_whole, max(b.turn) AS by_line FROM passages p
          LEFT JOIN offers a ON a.conv_id = p.conv_id AND a.key = p.whole AND p.whole <> '' AND a.turn < p.turn
          LEFT JOIN offers b ON b.conv_id = p.conv_id AND b.key = p.first AND p.first <> '' AND b.turn < p.turn
          WHERE p.level > 0 GROUP BY p.id, p.run, p.level),
lowest AS (SELECT id, coalesce(by_whole, by_line) AS original, level, min(level) OVER (PARTITION BY id) AS least FROM links WHERE coalesce(by_whole, by_line) IS NOT NULL),
replies AS (SELECT id, max(original) AS reply_to FROM lowest WHERE level = least GROUP BY id),
up AS (SELECT conv_id, turn, max(reply_to) AS up FROM m JOIN replies USING (id) WHERE reply_to IS NOT NULL GROUP BY conv_id, turn),
chain AS (WITH RECURSIVE c AS (SELECT conv_id, turn, up FROM up UNION ALL
          SELECT c.conv_id, c.turn, u.up FROM c JOIN up u ON u.conv_id = c.conv_id AND u.turn = c.up) SELECT conv_id, turn, min(up) AS thread FROM c GROUP BY conv_id, turn),
told AS (SELECT id, string_agg(passage, chr(10) ORDER BY run) FILTER (level = 0) AS body, count(*) FILTER (level > 0) AS n_quoted FROM passages GROUP BY id)
SELECT m.conv_id, m.turn, m.role, CASE WHEN m.text IS NULL THEN NULL WHEN t.n_quoted = 0 THEN m.text ELSE coalesce(t.body, '') END AS body,
       coalesce(t.n_quoted, 0) AS n_quoted, r.reply_to, coalesce(c.thread, m.turn) AS thread
FROM m LEFT JOIN told t ON t.id = m.id LEFT JOIN replies r ON r.id = m.id LEFT JOIN chain c ON c.conv_id = m.conv_id AND c.turn = m.turn
"""


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MultiIndex().apply(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return default_bpe().digests(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return JaccardJoin(k=3, percent=90).apply(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Decontaminator().apply(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = SubstringDedup().apply(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_removed", "removed_chars", "text", "spans")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ImportanceResampler().apply(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


#: Lower-cased words of a text, in DuckDB.
SQL_WORDS = r"coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

OP11_SQL = f"""
WITH steps AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
d AS (SELECT doc_id, {SQL_WORDS} AS words, row_number() OVER () AS id FROM documents),
dw AS (SELECT id, unnest(words) AS word FROM d),
bw AS (SELECT unnest({SQL_WORDS}) AS word FROM benchmark),
spelt AS (SELECT word, hex(word) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
bytes AS (SELECT word, list_transform(range(1, len(h), 2), lambda i: (strpos('0123456789ABCDEF', h[i]) - 1) * 16 + strpos('0123456789ABCDEF', h[i + 1]) - 1) AS b FROM spelt),
hashed AS (SELECT word, xor(list_reduce([4294967295] || b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, steps),
s AS (SELECT bucket, count(*)::DOUBLE AS s FROM dw JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*)::DOUBLE AS t FROM bw JOIN hashed USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS n, (SELECT coalesce(sum(t), 0) FROM t) AS m),
gains AS (SELECT s.bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (n + 10000) / ((s + 1) * (m + 10000))))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket), totals),
weights AS (SELECT id, sum(gain)::BIGINT AS weight FROM dw JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY id),
scored AS (SELECT d.id, doc_id, len(words)::BIGINT AS n, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score
           FROM (SELECT *, list_reduce([0] || list_transform(range(1, 9), lambda i: strpos('0123456789abcdef', sha256('2024:' || doc_id)[i]) - 1), lambda a, x: a * 16 + x)::DOUBLE AS h FROM d) d LEFT JOIN weights USING (id)),
ranked AS (SELECT id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS many FROM scored WHERE n >= 20)
SELECT doc_id, n AS n_features, weight, score, CASE WHEN place <= 10 * many // 100 THEN place END AS rank FROM scored LEFT JOIN ranked USING (id)
"""


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LicenseScan().apply(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_sql() -> str:
    """The rules as a table.  DuckDB's regexes look at nothing ahead, so phrases match whole; those here overlap nowhere."""
    scan = LicenseScan()
    regexes = [signature(p) for _, p in scan.phrases] + [r.regex for r in scan.all_rules()[len(scan.phrases) :]]
    quoted = lambda v: "'" + v.replace("'", "''") + "'"
    rules = ", ".join(f"({i}, {quoted(r.label)}, {r.priority}, {BELIEF[r.priority]}, {quoted(x)}, [{', '.join(map(quoted, r.keywords))}])" for i, (r, x) in enumerate(zip(scan.all_rules(), regexes)))
    reach = " ".join(f"WHEN {p} THEN max(CASE WHEN priority <= {p} THEN e END) OVER w" for p in range(len(BELIEF)))
    count = lambda x: f"list_transform({x}, lambda p: (len(p) - len(replace(p, ' ', ''))) // 2)"
    return f"""
WITH rules(rule, label, priority, belief, regex, keywords) AS (VALUES {rules}),
d AS (SELECT doc_id, {SQL_WORDS} AS words, row_number() OVER () AS id FROM documents),
lines AS (SELECT *, CASE WHEN len(words) = 0 THEN '' ELSE ' ' || array_to_string(words, '  ') || ' ' END AS line FROM d),
hits AS (SELECT id, rule, label, priority, belief, line, regex FROM lines JOIN rules ON len(list_filter(keywords, lambda k: NOT contains(line, k))) = 0 WHERE regexp_matches(line, regex)),
parts AS (SELECT id, rule, label, priority, belief, {count("string_split_regex(line, regex)")} AS gaps, {count("regexp_extract_all(line, regex)")} AS widths FROM hits),
one AS (SELECT id, rule, label, priority, belief, unnest(widths) AS width, unnest(gaps[1:len(widths)]) AS gap, generate_subscripts(widths, 1) AS pos FROM parts),
spots AS (SELECT *, sum(gap + width) OVER (PARTITION BY id, rule ORDER BY pos) - width AS s FROM one),
ends AS (SELECT *, s + width AS e FROM spots),
reached AS (SELECT *, CASE priority {reach} END AS reach FROM ends WINDOW w AS (PARTITION BY id ORDER BY s, e DESC, priority, rule ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
kept AS (SELECT * FROM reached WHERE priority = 0 OR reach IS NULL OR reach < e),
told AS (SELECT id, count(*) FILTER (priority = 0) AS n_base, min(s) FILTER (priority = 0) AS first_word, max(s) FILTER (priority = 0) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (priority = 0) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(belief) AS score FROM kept GROUP BY id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score FROM d LEFT JOIN told USING (id)
"""


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LexicalSearch().apply(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


OP13_SQL = f"""
WITH d AS (SELECT doc_id, {SQL_WORDS} AS words, row_number() OVER () AS id FROM documents),
dw AS (SELECT id, word, count(*) AS tf FROM (SELECT id, unnest(words) AS word FROM d) GROUP BY ALL),
totals AS (SELECT count(*) FILTER (len(words) > 0) AS n, sum(len(words))::BIGINT AS l FROM d),
w AS (SELECT word, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT word, count(*) AS df FROM dw GROUP BY word), totals),
m AS (SELECT id, doc_id, 100 - 90 + (90 * len(words) * n) // l AS m FROM d, totals WHERE len(words) > 0),
q AS (SELECT item_id, words, row_number() OVER () AS q FROM (SELECT item_id, {SQL_WORDS} AS words FROM benchmark)),
qw AS (SELECT DISTINCT item_id, q, unnest(words) AS word FROM q),
scored AS (SELECT q, item_id, doc_id, id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM qw JOIN dw USING (word) JOIN w USING (word) JOIN m USING (id) GROUP BY ALL),
ranked AS (SELECT item_id, (row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""


#: (a, b) of all b reachable from each a, over links (u, v) in both directions between the ids of nodes.
REACHED = "reached(a, b) AS (SELECT id, id FROM nodes UNION SELECT r.a, e.v FROM reached r JOIN links e ON r.b = e.u)"

OP6_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
nodes AS (SELECT vec_id AS id FROM embeddings), {REACHED},
found AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a),
n AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN found ON a = vec_id LEFT JOIN n ON u = vec_id
"""

OP8_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, row_number() OVER () AS row,
     coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT row, doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d),
n AS (SELECT row, count(*) AS n FROM s GROUP BY row),
pairs AS (SELECT a.row AS x, b.row AS y, any_value(a.doc_id) AS u, any_value(b.doc_id) AS v, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.row <> b.row GROUP BY a.row, b.row),
links AS (SELECT x, u, v FROM pairs JOIN n p ON p.row = x JOIN n q ON q.row = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
nodes AS (SELECT doc_id AS id FROM documents), {REACHED},
found AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a),
many AS (SELECT x, count(*) AS many FROM links GROUP BY x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(many, 0)::BIGINT AS n_links, component_id FROM d LEFT JOIN n USING (row) LEFT JOIN many ON x = row JOIN found ON a = doc_id
"""

OP9_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row, {SQL_WORDS} AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item, {SQL_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 10) AS k, unnest(list_transform(range(1, greatest(len(w) - 10, 0) + 2), lambda p: array_to_string(w[p:p + 9], ' '))) AS win FROM i WHERE len(w) > 0),
own AS (SELECT row, k, unnest(range(1, len(w) - k + 2)) AS p, w FROM d JOIN (SELECT DISTINCT k FROM win) ON len(w) >= k),
at_ AS (SELECT row, k, p, array_to_string(w[p:p + k - 1], ' ') AS win FROM own),
hits AS (SELECT row, k, p, item FROM at_ JOIN win USING (k, win)),
hit AS (SELECT row, count(DISTINCT q) AS n_hit FROM (SELECT row, unnest(range(p, p + k)) AS q FROM (SELECT DISTINCT row, p, k FROM hits)) GROUP BY row),
found AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT row, item FROM hits) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (row) LEFT JOIN found USING (row)
"""


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_url_filter, op3_language_id, op4_toxicity, op5_quotation_links, op6_embedding_near_dedup, op7_byte_bpe, op8_jaccard_join, op9_decontamination, op10_substring_dedup, op11_importance_resampling, op12_license_scan, op13_lexical_search)}
ORACLE_SQL: dict[str, str] = {"op1_token_counts": OP1_SQL, "op2_url_filter": OP2_SQL, "op5_quotation_links": OP5_SQL, "op6_embedding_near_dedup": OP6_SQL, "op8_jaccard_join": OP8_SQL, "op9_decontamination": OP9_SQL, "op11_importance_resampling": OP11_SQL, "op12_license_scan": op12_sql(), "op13_lexical_search": OP13_SQL}
