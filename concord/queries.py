"""A query per operator over the driver's tables, and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concord.functions import scalars, spatial
from concord.operators import apply, diff, encode, filters, keys, ranges
from concord.operators import catalog as catalogs
from concord.plans import schema_diff
from concord.plans.model import TableDef, table_of
from concord.sources.tables import enum_labels

ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
FLAGS = ["l_returnflag", "l_linestatus", "l_linenumber"]
WIDTH = 64
#: Decimals of floats in digests, as engines print floats differently.
SCALE = 4

QUERIES = {}
SQL = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select(*ORDERS)


def customer(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "customer").select(*CUSTOMER)


def derived(df: DataFrame, key: str, number: str, text: str) -> DataFrame:
    """A target that differs from its source in every way: rows missing, tail missing, values changed and nulled, extra rows."""
    last = df.agg(F.max(key)).scalar()
    kept = df.where((F.col(key) % 97 != 0) & (F.col(key) <= F.call_function("div", last * 19, F.lit(20))))
    kept = kept.withColumns({number: F.when(F.col(key) % 89 == 0, F.col(number) + 1).otherwise(F.col(number)), text: F.when(F.col(key) % 83 == 0, F.lit(None)).otherwise(F.col(text))})
    return kept.unionByName(df.where(F.col(key) % 101 == 0).withColumn(key, -F.col(key) - 1))


def derived_sql(table: str, columns: list[str], key: str, number: str, text: str) -> str:
    item = lambda c: f"CASE WHEN {key} % 89 = 0 THEN {c} + 1 ELSE {c} END AS {c}" if c == number else f"CASE WHEN {key} % 83 = 0 THEN NULL ELSE {c} END AS {c}" if c == text else c
    again = lambda c: f"-{key} - 1 AS {key}" if c == key else c
    return (
        f"SELECT {', '.join(map(item, columns))} FROM {table} WHERE {key} % 97 <> 0 AND {key} <= (SELECT max({key}) * 19 // 20 FROM {table}) "
        f"UNION ALL SELECT {', '.join(map(again, columns))} FROM {table} WHERE {key} % 101 = 0"
    )


def t_orders(spark: SparkSession, sf: str) -> DataFrame:
    return derived(orders(spark, sf), "o_orderkey", "o_totalprice", "o_orderstatus")


def t_customer(spark: SparkSession, sf: str) -> DataFrame:
    return derived(customer(spark, sf), "c_custkey", "c_acctbal", "c_mktsegment")


O, C = ", ".join(ORDERS), ", ".join(CUSTOMER)
T_ORDERS = derived_sql("orders", ORDERS, "o_orderkey", "o_totalprice", "o_orderstatus")
T_CUSTOMER = derived_sql("customer", CUSTOMER, "c_custkey", "c_acctbal", "c_mktsegment")


def diff_sql(source: str, target: str, key: str, columns: list[str]) -> str:
    rest = [c for c in columns if c != key]
    differs = " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in rest)
    return f"""WITH s AS ({source}), t AS ({target})
SELECT coalesce(s.{key}, t.{key}) AS {key}, CASE WHEN t.{key} IS NULL THEN 'insert' WHEN s.{key} IS NULL THEN 'delete' ELSE 'replace' END AS action,
       {', '.join(f's.{c}' for c in rest)}
FROM s FULL JOIN t ON s.{key} = t.{key} WHERE s.{key} IS NULL OR t.{key} IS NULL OR {differs}"""


DIFF_ORDERS = diff_sql(f"SELECT {O} FROM orders", T_ORDERS, "o_orderkey", ORDERS)

# -- scans ---------------------------------------------------------------------------------------

ORDERS_DEF = TableDef("orders", primary_key=("o_orderkey",))


def scan(spark, sf, **how) -> DataFrame:
    df = orders(spark, sf)
    return ranges.range_rows(df, table_of(df, "orders", ("o_orderkey",)), **how)


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def full_scan(spark, sf):
    df = read(spark, sf, "nation")
    return ranges.range_rows(df, table_of(df, "nation", ("n_nationkey",)))


@query(f"SELECT {O} FROM orders WHERE o_orderkey > 1000 AND o_orderkey <= 2000")
def range_scan(spark, sf):
    return scan(spark, sf, prev=[1000], last=[2000])


@query(f"SELECT {O} FROM orders WHERE o_orderkey > 1000 AND o_orderkey <= 2000 ORDER BY o_orderkey LIMIT 100")
def range_scan_limit(spark, sf):
    return scan(spark, sf, prev=[1000], last=[2000], limit=100)


@query(
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE (l_orderkey > 10 OR (l_orderkey = 10 AND l_linenumber > 2)) "
    "AND (l_orderkey < 20 OR (l_orderkey = 20 AND l_linenumber <= 3))"
)
def range_scan_composite(spark, sf):
    df = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return df.where(ranges.key_range(["l_orderkey", "l_linenumber"], [10, 2], [20, 3]))


@query("SELECT min(o_orderkey) AS first_o_orderkey, max(o_orderkey) AS last_o_orderkey FROM orders")
def key_range(spark, sf):
    return ranges.key_bounds(orders(spark, sf), ["o_orderkey"])


@query("SELECT min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderkey >= 1500 AND o_orderkey > 1000 AND o_orderkey <= 2000")
def not_earlier_key(spark, sf):
    return ranges.next_key(orders(spark, sf), ["o_orderkey"], [1500], [1000], [2000])


@query("SELECT coalesce(min(o_orderkey), 1000) AS o_orderkey FROM orders WHERE o_orderkey >= 1000 + (2001 - 1000) // 2 AND o_orderkey > 1000 AND o_orderkey <= 2001")
def midpoint_key(spark, sf):
    return ranges.next_key(orders(spark, sf), ["o_orderkey"], [ranges.midpoint(1000, 2001)], [1000], [2001], default=[1000])


@query("SELECT count(*) AS n FROM orders WHERE o_orderkey > 1000 AND o_orderkey <= 2000")
def count_range(spark, sf):
    return ranges.count_range(orders(spark, sf), ["o_orderkey"], [1000], [2000])


@query("SELECT o_orderkey FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 1000)) ORDER BY o_orderkey LIMIT 1000")
def keyset_page(spark, sf):
    """The second page of a thousand keys, found from the last key of the first."""
    df = orders(spark, sf).select("o_orderkey")
    return ranges.page(df, "o_orderkey", df.orderBy("o_orderkey").limit(1000).agg(F.max("o_orderkey")).scalar(), 1000)


@query("""WITH n AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) AS i FROM conversations) SELECT conv_id, turn FROM n WHERE i > 40 AND i <= 80""")
def keyset_page_composite(spark, sf):
    """The second page of forty keys of two columns, if there is one."""
    df = read(spark, sf, "conversations").select("conv_id", "turn")
    return next((p for i, p in enumerate(ranges.pages(df, ["conv_id", "turn"], 40)) if i == 1), df.limit(0))


@query("SELECT turn, conv_id FROM conversations")
def key_projection(spark, sf):
    df = read(spark, sf, "conversations")
    return ranges.key_columns(df, table_of(df, "conversations", ("turn", "conv_id")))


@query("SELECT c_custkey, c_name FROM customer")
def skip_generated(spark, sf):
    from concord.plans.model import ColumnDef, Default

    df = read(spark, sf, "customer").withColumn("twice", F.col("c_custkey") * 2)
    table = TableDef("customer", (ColumnDef("c_custkey", "integer.64bit", False), ColumnDef("twice", "integer.64bit", default_kind=Default.GENERATED_STORED), ColumnDef("c_name", "text")), ("c_custkey",))
    return ranges.range_rows(df, table)


# -- keys ----------------------------------------------------------------------------------------


@query("""SELECT 'lineitem' AS name, count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS n_keys, 0::BIGINT AS n_null, false AS is_key FROM lineitem
UNION ALL SELECT 'orders', count(*), count(DISTINCT o_orderkey), 0, true FROM orders""")
def verify_key(spark, sf):
    a = keys.verify_key(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]).select(F.lit("lineitem").alias("name"), "*")
    return a.unionByName(keys.verify_key(orders(spark, sf), ["o_orderkey"]).select(F.lit("orders").alias("name"), "*"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return keys.duplicate_keys(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# -- row diff ------------------------------------------------------------------------------------


@query(DIFF_ORDERS)
def diff_actions(spark, sf):
    return diff.diff(orders(spark, sf), t_orders(spark, sf), ["o_orderkey"])


@query(f"WITH t AS ({T_CUSTOMER}) SELECT {C} FROM customer s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.c_custkey = s.c_custkey)")
def diff_inserts(spark, sf):
    return diff.inserts(customer(spark, sf), t_customer(spark, sf), ["c_custkey"])


@query(f"WITH t AS ({T_CUSTOMER}) SELECT c_custkey FROM t WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)")
def diff_deletes(spark, sf):
    return diff.deletes(customer(spark, sf), t_customer(spark, sf), ["c_custkey"])


DIFFERS = " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in CUSTOMER[1:])


@query(f"WITH t AS ({T_CUSTOMER}) SELECT {', '.join('s.' + c for c in CUSTOMER)} FROM customer s JOIN t ON s.c_custkey = t.c_custkey WHERE {DIFFERS}")
def diff_replaces(spark, sf):
    return diff.matched(customer(spark, sf), t_customer(spark, sf), ["c_custkey"], equal=False)


@query(f"WITH t AS ({T_CUSTOMER}) SELECT {', '.join('s.' + c for c in CUSTOMER)} FROM customer s JOIN t ON s.c_custkey = t.c_custkey WHERE NOT ({DIFFERS})")
def diff_unchanged(spark, sf):
    return diff.matched(customer(spark, sf), t_customer(spark, sf), ["c_custkey"], equal=True)


@query(f"SELECT action, count(*) AS n FROM ({DIFF_ORDERS}) GROUP BY action")
def diff_summary(spark, sf):
    return diff.summary(diff.diff(orders(spark, sf), t_orders(spark, sf), ["o_orderkey"]))


@query(f"WITH t AS ({T_ORDERS}) SELECT {O} FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) FROM t)")
def tail_inserts(spark, sf):
    return diff.tail_inserts(orders(spark, sf), t_orders(spark, sf), "o_orderkey")


@query(f"WITH t AS ({T_ORDERS}) SELECT o_orderkey FROM t WHERE o_orderkey < (SELECT min(o_orderkey) FROM orders) OR o_orderkey > (SELECT max(o_orderkey) FROM orders)")
def out_of_range_deletes(spark, sf):
    return diff.out_of_range(orders(spark, sf), t_orders(spark, sf), "o_orderkey")


CUT = "SELECT * FROM conversations WHERE conv_id > 3 AND (conv_id < 40 OR (conv_id = 40 AND turn < 2))"


@query(f"WITH t AS ({CUT}), l AS (SELECT max((conv_id, turn)) AS k FROM t) SELECT conv_id, turn FROM conversations, l WHERE (conv_id, turn) > k")
def tail_inserts_composite(spark, sf):
    df = read(spark, sf, "conversations").select("conv_id", "turn")
    return diff.tail_inserts(df, df.where("conv_id > 3 AND (conv_id < 40 OR (conv_id = 40 AND turn < 2))"), ["conv_id", "turn"])


@query(f"WITH t AS ({CUT}), l AS (SELECT min((conv_id, turn)) AS a, max((conv_id, turn)) AS b FROM t) SELECT conv_id, turn FROM conversations, l WHERE (conv_id, turn) < a OR (conv_id, turn) > b")
def out_of_range_deletes_composite(spark, sf):
    df = read(spark, sf, "conversations").select("conv_id", "turn")
    return diff.out_of_range(df.where("conv_id > 3 AND (conv_id < 40 OR (conv_id = 40 AND turn < 2))"), df, ["conv_id", "turn"])


# -- encoding and digests ------------------------------------------------------------------------


def encoded_sql(columns: list[str], doubles: set[str]) -> str:
    text = lambda c: f"CAST(CAST({c} AS DECIMAL(38,4)) AS VARCHAR)" if c in doubles else f"CAST({c} AS VARCHAR)"
    return " || ".join(f"coalesce(CAST(length({text(c)}) AS VARCHAR) || ':' || {text(c)}, '~')" for c in columns)


ENC_ORDERS = encoded_sql(ORDERS, {"o_totalprice"})


@query(f"SELECT s_suppkey, {encoded_sql(['s_suppkey', 's_name', 's_nationkey', 's_acctbal'], {'s_acctbal'})} AS encoded FROM supplier")
def canonical_encode(spark, sf):
    df = read(spark, sf, "supplier")
    return df.select("s_suppkey", encode.encoded_row(df, ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"], SCALE).alias("encoded"))


def block_sql(rows: str, width: int = WIDTH, h: str = "md5", encoded: str = ENC_ORDERS) -> str:
    return f"""SELECT k // {width} AS block, count(*) AS n, sum(size)::BIGINT AS bytes, min(k) AS first, max(k) AS last, {h}(string_agg(h, '' ORDER BY k)) AS digest
FROM (SELECT k, octet_length(encode(row)) AS size, {h}(row) AS h FROM (SELECT o_orderkey AS k, {encoded} AS row FROM ({rows}))) GROUP BY block"""


def tree_sql(rows: str) -> str:
    return f"""WITH a AS ({block_sql(rows, 1024)}),
b AS (SELECT block // 1024 AS block, sum(n) AS n, md5(string_agg(digest, '' ORDER BY block)) AS digest FROM a GROUP BY block // 1024),
c AS (SELECT block // 1024 AS block, sum(n) AS n, md5(string_agg(digest, '' ORDER BY block)) AS digest FROM b GROUP BY block // 1024)
SELECT sum(n)::BIGINT AS n, md5(string_agg(digest, '' ORDER BY block)) AS digest FROM c"""


@query(tree_sql("SELECT * FROM orders WHERE o_orderkey > 1000 AND o_orderkey <= 9000"))
def range_hash(spark, sf):
    return encode.range_hash(orders(spark, sf).where(ranges.key_range(["o_orderkey"], [1000], [9000])), "o_orderkey", ORDERS, scale=SCALE)


@query(tree_sql("SELECT * FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 500"))
def range_hash_limit(spark, sf):
    return encode.range_hash(scan(spark, sf, prev=[1000], limit=500), "o_orderkey", ORDERS, scale=SCALE)


@query(block_sql("SELECT * FROM orders"))
def block_digest(spark, sf):
    return encode.block_digest(orders(spark, sf), "o_orderkey", ORDERS, WIDTH, scale=SCALE)


@query(block_sql("SELECT * FROM orders", h="sha256"))
def block_digest_sha256(spark, sf):
    return encode.block_digest(orders(spark, sf), "o_orderkey", ORDERS, WIDTH, "sha256", SCALE)


@query()
def block_digest_xxhash64(spark, sf):
    return encode.block_digest(orders(spark, sf), "o_orderkey", ORDERS, WIDTH, "xxhash64")


@query("SELECT doc_id // 64 AS block, sum(octet_length(encode(text)))::BIGINT AS bytes FROM documents GROUP BY ALL")
def block_bytes(spark, sf):
    return encode.block_bytes(read(spark, sf, "documents"), "doc_id", "text", WIDTH)


def compare_sql(width: int) -> str:
    return f"""SELECT coalesce(s.block, t.block) AS block, s.n AS source_n, t.n AS target_n
FROM ({block_sql('SELECT * FROM orders', width)}) s FULL JOIN ({block_sql(T_ORDERS, width)}) t ON s.block = t.block
WHERE s.digest IS DISTINCT FROM t.digest OR s.n IS DISTINCT FROM t.n"""


@query(compare_sql(WIDTH))
def block_compare(spark, sf):
    return diff.block_compare(orders(spark, sf), t_orders(spark, sf), "o_orderkey", ORDERS, WIDTH)


@query(DIFF_ORDERS)
def block_pruned_diff(spark, sf):
    return diff.pruned_diff(orders(spark, sf), t_orders(spark, sf), "o_orderkey", ORDERS, WIDTH)


TALK = ["conv_id", "turn", "role", "text"]
T_TALK = """SELECT conv_id, turn, CASE WHEN conv_id % 17 = 0 THEN NULL ELSE role END AS role, CASE WHEN (conv_id + turn) % 19 = 0 THEN text || '!' ELSE text END AS text
FROM conversations WHERE (conv_id * 7 + turn) % 23 <> 0 UNION ALL SELECT conv_id + 1000000, turn, role, text FROM conversations WHERE (conv_id + turn) % 29 = 0"""


def talk(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Conversations, keyed by two columns, and a target that differs from them."""
    df = read(spark, sf, "conversations").select(*TALK)
    kept = df.where("(conv_id * 7 + turn) % 23 <> 0").withColumns({"role": F.when(F.expr("conv_id % 17 <> 0"), F.col("role")), "text": F.when(F.expr("(conv_id + turn) % 19 = 0"), F.concat("text", F.lit("!"))).otherwise(F.col("text"))})
    return df, kept.unionByName(df.where("(conv_id + turn) % 29 = 0").withColumn("conv_id", F.col("conv_id") + 1_000_000))


def keyed_diff_sql(source: str, target: str, key: list[str], columns: list[str]) -> str:
    rest = [c for c in columns if c not in key]
    differs = " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in rest)
    on = " AND ".join(f"s.{c} = t.{c}" for c in key)
    return f"""WITH s AS ({source}), t AS ({target})
SELECT {', '.join(f'coalesce(s.{c}, t.{c}) AS {c}' for c in key)}, CASE WHEN t.{key[0]} IS NULL THEN 'insert' WHEN s.{key[0]} IS NULL THEN 'delete' ELSE 'replace' END AS action,
       {', '.join(f's.{c}' for c in rest)}
FROM s FULL JOIN t ON {on} WHERE s.{key[0]} IS NULL OR t.{key[0]} IS NULL OR {differs}"""


@query(keyed_diff_sql(f"SELECT {', '.join(TALK)} FROM conversations", T_TALK, ["conv_id", "turn"], TALK))
def pruned_diff_composite(spark, sf):
    """Blocks of a key of two columns are ranges of it."""
    s, t = talk(spark, sf)
    return diff.pruned_diff(s, t, ["conv_id", "turn"], TALK, 16)


T_NAMES = """SELECT c_custkey, c_name, CASE WHEN c_custkey % 89 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey FROM customer WHERE c_custkey % 97 <> 0
UNION ALL SELECT c_custkey, c_name || '-x', c_nationkey FROM customer WHERE c_custkey % 101 = 0"""


@query(keyed_diff_sql("SELECT c_custkey, c_name, c_nationkey FROM customer", T_NAMES, ["c_name"], ["c_custkey", "c_name", "c_nationkey"]))
def pruned_diff_text(spark, sf):
    """Blocks of a text key are ranges of it."""
    s = customer(spark, sf).select("c_custkey", "c_name", "c_nationkey")
    t = s.where("c_custkey % 97 <> 0").withColumn("c_nationkey", F.when(F.expr("c_custkey % 89 <> 0"), F.col("c_nationkey")))
    t = t.unionByName(s.where("c_custkey % 101 = 0").withColumn("c_name", F.concat("c_name", F.lit("-x"))))
    return diff.pruned_diff(s, t, "c_name", s.columns, WIDTH)


@query(compare_sql(WIDTH))
def block_refine(spark, sf):
    return diff.block_refine(orders(spark, sf), t_orders(spark, sf), "o_orderkey", ORDERS, 1024, WIDTH)


@query(f"""SELECT min(block) AS first_block, max(block) AS last_block, count(*) AS n
FROM (SELECT block, block - row_number() OVER (ORDER BY block) AS island FROM ({compare_sql(WIDTH)})) GROUP BY island""")
def coalesce_ranges(spark, sf):
    return diff.coalesce_ranges(diff.block_compare(orders(spark, sf), t_orders(spark, sf), "o_orderkey", ORDERS, WIDTH))


@query("""SELECT CAST((o_orderkey - lo) // ((hi - lo) // 8 + 1) AS INTEGER) AS part, min(o_orderkey) AS first, max(o_orderkey) AS last, count(*) AS n
FROM orders, (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders) GROUP BY part""")
def range_split(spark, sf):
    return ranges.range_split(orders(spark, sf), "o_orderkey", 8)


# -- whole rows ----------------------------------------------------------------------------------

L = ", ".join(FLAGS)


@query(f"SELECT {L}, count(*) AS n FROM lineitem GROUP BY ALL")
def multiset_counts(spark, sf):
    return diff.multiset_counts(read(spark, sf, "lineitem"), FLAGS)


@query(f"""WITH s AS (SELECT {L}, count(*) AS n FROM lineitem GROUP BY ALL), t AS (SELECT {L}, count(*) AS n FROM lineitem WHERE l_orderkey % 7 <> 0 GROUP BY ALL)
SELECT {', '.join(f'coalesce(s.{c}, t.{c}) AS {c}' for c in FLAGS)}, CASE WHEN t.n IS NULL THEN 'insert' WHEN s.n IS NULL THEN 'delete' ELSE 'replace' END AS action,
coalesce(s.n, 0) AS source_n, coalesce(t.n, 0) AS target_n FROM s FULL JOIN t ON {' AND '.join(f's.{c} = t.{c}' for c in FLAGS)} WHERE s.n IS DISTINCT FROM t.n""")
def multiset_diff(spark, sf):
    rows = read(spark, sf, "lineitem")
    return diff.multiset_diff(rows, rows.where("l_orderkey % 7 <> 0"), FLAGS)


WHOLE = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
W_ = ", ".join(WHOLE)


@query(f"""WITH s AS (SELECT {W_}, count(*) AS n FROM lineitem GROUP BY ALL),
t AS (SELECT {W_}, count(*) AS n FROM (SELECT {W_} FROM lineitem WHERE l_orderkey % 211 <> 0 UNION ALL SELECT {W_} FROM lineitem WHERE l_orderkey % 307 = 0) GROUP BY ALL)
SELECT {', '.join(f'coalesce(s.{c}, t.{c}) AS {c}' for c in WHOLE)}, CASE WHEN t.n IS NULL THEN 'insert' WHEN s.n IS NULL THEN 'delete' ELSE 'replace' END AS action,
coalesce(s.n, 0) AS source_n, coalesce(t.n, 0) AS target_n FROM s FULL JOIN t ON {' AND '.join(f's.{c} IS NOT DISTINCT FROM t.{c}' for c in WHOLE)} WHERE s.n IS DISTINCT FROM t.n""")
def multiset_pruned_diff(spark, sf):
    """A table without a key: rows go to blocks by hash, and blocks are compared by sums of hashes, in which repeats count."""
    rows = read(spark, sf, "lineitem").select(*WHOLE)
    target = rows.where("l_orderkey % 211 <> 0").unionByName(rows.where("l_orderkey % 307 = 0"))
    return diff.pruned_multiset_diff(rows, target, WHOLE, WIDTH)


@query(f"SELECT {L}, unnest(range(n)) + 1 AS copy FROM (SELECT {L}, count(*) AS n FROM lineitem GROUP BY ALL)")
def multiset_expand(spark, sf):
    return diff.multiset_expand(diff.multiset_counts(read(spark, sf, "lineitem"), FLAGS)).withColumn("copy", F.col("copy").cast("long"))


# -- filters -------------------------------------------------------------------------------------


@query(f"SELECT {O} FROM orders WHERE o_totalprice > 100000 AND o_orderstatus IS NOT NULL")
def filter_only(spark, sf):
    return filters.apply_filter(orders(spark, sf), filters.TableFilter(only="o_totalprice > 100000 AND o_orderstatus IS NOT NULL"))


@query("SELECT count(*) AS n FROM orders WHERE false")
def filter_clear(spark, sf):
    return filters.apply_filter(orders(spark, sf), filters.parse_filters({"orders": "clear"})["orders"]).agg(F.count("*").alias("n"))


def masked(spark, sf, **f) -> DataFrame:
    return filters.apply_filter(customer(spark, sf), filters.TableFilter(**f))


@query("SELECT c_custkey, md5(c_name) AS c_name, c_nationkey, c_acctbal, c_name || '-' || c_mktsegment AS c_mktsegment FROM customer")
def filter_replace(spark, sf):
    return masked(spark, sf, replace={"c_name": "md5(c_name)", "c_mktsegment": "c_name || '-' || c_mktsegment"})


@query("SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def filter_replace_null(spark, sf):
    return masked(spark, sf, replace={"c_name": None})


@query("SELECT c_custkey, CAST(c_custkey * 2 AS VARCHAR) AS c_name, CAST('7' AS INTEGER) AS c_nationkey, CAST(c_nationkey AS DOUBLE) AS c_acctbal, c_mktsegment FROM customer")
def filter_replace_cast(spark, sf):
    return masked(spark, sf, replace={"c_name": "c_custkey * 2", "c_nationkey": "'7'", "c_acctbal": "c_nationkey"})


@query("SELECT c_custkey, c_name, c_nationkey, -1.0::DOUBLE AS c_acctbal, 'x' AS c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_only_replace(spark, sf):
    return masked(spark, sf, only="c_mktsegment = 'BUILDING'", replace={"c_mktsegment": "'x'", "c_acctbal": "-1"})


FILTERED = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, lower(c_mktsegment) AS c_mktsegment FROM customer WHERE c_nationkey < 10"


@query(diff_sql(FILTERED, T_CUSTOMER, "c_custkey", CUSTOMER))
def filtered_sync_diff(spark, sf):
    """The filter holds for the source only: target rows outside of it are deleted."""
    return diff.diff(masked(spark, sf, only="c_nationkey < 10", replace={"c_mktsegment": "lower(c_mktsegment)"}), t_customer(spark, sf), ["c_custkey"])


# -- new states ----------------------------------------------------------------------------------


@query(f"SELECT {O} FROM orders")
def apply_diff(spark, sf):
    t = t_orders(spark, sf)
    return apply.apply_diff(t, diff.diff(orders(spark, sf), t, ["o_orderkey"]), ["o_orderkey"])


@query(f"SELECT {O} FROM orders WHERE NOT (o_orderkey > 1000 AND o_orderkey <= 9000)")
def clear_range(spark, sf):
    return apply.clear_range(orders(spark, sf), ["o_orderkey"], [1000], [9000])


@query("SELECT event_id, user_id, event_type FROM events")
def reload_no_key(spark, sf):
    from concord.plans.sync import sync_table

    df = read(spark, sf, "events").select("event_id", "user_id", "event_type")
    return sync_table(df, df.limit(0), table_of(df, "events")).state


@query("SELECT 'before' AS state, count(*) AS n FROM region UNION ALL SELECT 'after', 0")
def sync_empty_source(spark, sf):
    from concord.plans.sync import sync_table

    df = read(spark, sf, "region")
    after = sync_table(df.limit(0), df, table_of(df, "region", ("r_regionkey",))).state
    return df.agg(F.count("*").alias("n")).select(F.lit("before").alias("state"), "n").unionByName(after.agg(F.count("*").alias("n")).select(F.lit("after").alias("state"), "n"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 50 = 0 AND c_name IS NOT NULL")
def unique_conflicts(spark, sf):
    """Incoming rows under new keys: some need a name that the target has, some bring new names."""
    df = customer(spark, sf).select("c_custkey", "c_name")
    incoming = df.where("c_custkey % 50 IN (0, 1)").select((F.col("c_custkey") + 10_000_000).alias("c_custkey"), F.when(F.col("c_custkey") % 50 == 1, F.concat("c_name", F.lit("-new"))).otherwise(F.col("c_name")).alias("c_name"))
    return diff.unique_conflicts(incoming, df, ["c_custkey"], [["c_name"]])


@query("SELECT 0::BIGINT AS missing, 0::BIGINT AS extra")
def sync_verify(spark, sf):
    s, t = orders(spark, sf), t_orders(spark, sf)
    return diff.verify(s, apply.apply_diff(t, diff.diff(s, t, ["o_orderkey"]), ["o_orderkey"]))


@query("SELECT coalesce(max(o_orderkey), 0) + 1 AS next_value FROM orders")
def next_sequence_value(spark, sf):
    return apply.next_sequence_value(orders(spark, sf), "o_orderkey")


@query(f"WITH t AS ({T_CUSTOMER}) SELECT c_custkey, coalesce(c_mktsegment, '') AS c_mktsegment FROM t")
def fill_nulls(spark, sf):
    return filters.fill_nulls(t_customer(spark, sf).select("c_custkey", "c_mktsegment"), {"c_mktsegment": ""})


@query(f"WITH t AS ({T_CUSTOMER}) SELECT c_custkey, 0::INTEGER AS c_level FROM t")
def add_column_fill(spark, sf):
    from concord.plans.model import ColumnDef

    table = TableDef("customer", (ColumnDef("c_custkey", "integer.64bit", False), ColumnDef("c_level", "integer", False)), ("c_custkey",))
    return schema_diff.apply_to_frame(t_customer(spark, sf).select("c_custkey"), table, [schema_diff.Action("add_column", "customer", "c_level", 0)])


# -- definitions ---------------------------------------------------------------------------------
# Catalogs of as many tables as there are customers: a column for each priority of the orders, a key for each status.

SIDES = {"s": "o_orderkey % 7 <> 0 AND o_custkey % 13 <> 0", "t": "o_orderkey % 9 <> 0 AND o_custkey % 17 <> 0"}


def catalog(spark, sf, side: str) -> DataFrame:
    """(tbl, pos, col, type, nullable) of the source "s" or the target "t"."""
    found = read(spark, sf, "orders").where(SIDES[side]).groupBy(F.concat(F.lit("t"), "o_custkey").alias("tbl"), "o_custkey", F.col("o_orderpriority").alias("col")).agg((F.count("*") > 1).alias("nullable"))
    shift = F.expr("o_custkey % 11 = 0").cast("int") if side == "t" else F.lit(0)
    kind = F.element_at(F.array(*map(F.lit, ("integer", "text.varchar", "json.binary", "decimal"))), (F.length("col") + shift) % 4 + 1)
    return found.select("tbl", F.row_number().over(Window.partitionBy("tbl").orderBy("col")).alias("pos"), "col", kind.alias("type"), "nullable")


def catalog_sql(side: str) -> str:
    shift = "CASE WHEN o_custkey % 11 = 0 THEN 1 ELSE 0 END" if side == "t" else "0"
    return f"""SELECT 't' || o_custkey AS tbl, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS INTEGER) AS pos, o_orderpriority AS col,
['integer', 'text.varchar', 'json.binary', 'decimal'][(length(o_orderpriority) + {shift}) % 4 + 1] AS type, count(*) > 1 AS nullable FROM orders WHERE {SIDES[side]} GROUP BY o_custkey, o_orderpriority"""


def catalog_keys(spark, sf, side: str) -> DataFrame:
    """(tbl, name, kind, cols)"""
    rows = read(spark, sf, "orders").where(SIDES[side])
    found = rows.groupBy(F.concat(F.lit("t"), "o_custkey").alias("tbl"), F.concat(F.lit("by_"), "o_orderstatus").alias("name")).agg(F.array_sort(F.collect_set("o_orderpriority")).alias("cols"))
    return found.select("tbl", "name", F.when(F.size("cols") % 2 == 1, "unique").otherwise("standard").alias("kind"), "cols")


def keys_sql(side: str) -> str:
    return f"""SELECT 't' || o_custkey AS tbl, 'by_' || o_orderstatus AS name, CASE WHEN count(DISTINCT o_orderpriority) % 2 = 1 THEN 'unique' ELSE 'standard' END AS kind,
list_sort(list(DISTINCT o_orderpriority)) AS cols FROM orders WHERE {SIDES[side]} GROUP BY o_custkey, o_orderstatus"""


CATALOGS = f"s AS ({catalog_sql('s')}), t AS ({catalog_sql('t')})"


@query(f"WITH {CATALOGS} SELECT DISTINCT tbl AS table_name FROM s")
def catalog_tables(spark, sf):
    return catalog(spark, sf, "s").select(F.col("tbl").alias("table_name")).distinct()


@query(f"WITH {CATALOGS} SELECT tbl AS table_name, pos AS position, col AS name, type, nullable FROM s")
def catalog_columns(spark, sf):
    return catalog(spark, sf, "s").withColumnsRenamed({"tbl": "table_name", "pos": "position", "col": "name"})


@query(f"WITH {CATALOGS} SELECT DISTINCT tbl AS table_name FROM s WHERE tbl IN ('t1', 't2', 't3', 't20', 't21') AND tbl NOT IN ('t2')")
def restrict_tables(spark, sf):
    return catalogs.restrict_rows(catalog(spark, sf, "s"), ["t1", "t2", "t3", "t20", "t21"], ["t2"]).select(F.col("tbl").alias("table_name")).distinct()


@query(f"""WITH {CATALOGS}, a AS (SELECT DISTINCT tbl FROM s), b AS (SELECT DISTINCT tbl FROM t)
SELECT coalesce(a.tbl, b.tbl) AS table_name, CASE WHEN b.tbl IS NULL THEN 'create' ELSE 'drop' END AS action FROM a FULL JOIN b ON a.tbl = b.tbl WHERE a.tbl IS NULL OR b.tbl IS NULL""")
def schema_diff_tables(spark, sf):
    return catalogs.table_changes(catalog(spark, sf, "s"), catalog(spark, sf, "t")).withColumnRenamed("tbl", "table_name")


@query(f"""WITH {CATALOGS} SELECT coalesce(s.tbl, t.tbl) AS table_name, coalesce(s.col, t.col) AS column_name, CASE WHEN t.col IS NULL THEN 'add' WHEN s.col IS NULL THEN 'drop' ELSE 'change' END AS action
FROM s FULL JOIN t ON s.tbl = t.tbl AND s.pos = t.pos AND s.col = t.col WHERE coalesce(s.tbl, t.tbl) IN (SELECT tbl FROM s INTERSECT SELECT tbl FROM t)
AND (s.col IS NULL OR t.col IS NULL OR s.type <> t.type OR s.nullable <> t.nullable)""")
def schema_diff_columns(spark, sf):
    return catalogs.column_changes(catalog(spark, sf, "s"), catalog(spark, sf, "t")).withColumnsRenamed({"tbl": "table_name", "col": "column_name"})


@query(f"""WITH s AS ({keys_sql('s')}), t AS ({keys_sql('t')})
SELECT coalesce(s.tbl, t.tbl) AS table_name, coalesce(s.name, t.name) AS key_name, CASE WHEN t.name IS NULL THEN 'create' WHEN s.name IS NULL THEN 'drop' ELSE 'change' END AS action
FROM s FULL JOIN t ON s.tbl = t.tbl AND s.name = t.name WHERE s.name IS NULL OR t.name IS NULL OR s.kind <> t.kind OR s.cols <> t.cols""")
def schema_diff_keys(spark, sf):
    return catalogs.key_changes(catalog_keys(spark, sf, "s"), catalog_keys(spark, sf, "t")).withColumnsRenamed({"tbl": "table_name", "name": "key_name"})


@query(f"""WITH {CATALOGS},
kept AS (SELECT t.tbl, t.col, t.type, t.nullable, row_number() OVER (PARTITION BY t.tbl ORDER BY t.pos) AS place, s.pos AS wanted, s.type AS want_type, s.nullable AS want_nullable FROM t JOIN s ON s.tbl = t.tbl AND s.col = t.col),
common AS (SELECT tbl FROM s INTERSECT SELECT tbl FROM t),
anew AS (SELECT DISTINCT tbl FROM kept WHERE place <> wanted OR type <> want_type),
altered AS (SELECT tbl FROM common EXCEPT SELECT tbl FROM anew)
SELECT DISTINCT 'create_table' AS action, tbl AS table_name, '' AS name FROM s WHERE tbl NOT IN (SELECT tbl FROM t)
UNION ALL SELECT DISTINCT 'drop_table', tbl, '' FROM t WHERE tbl NOT IN (SELECT tbl FROM s)
UNION ALL SELECT 'recreate_table', tbl, '' FROM anew
UNION ALL SELECT 'drop_column', t.tbl, t.col FROM t ANTI JOIN s ON t.tbl = s.tbl AND t.col = s.col WHERE t.tbl IN (SELECT tbl FROM altered)
UNION ALL SELECT 'add_column', s.tbl, s.col FROM s ANTI JOIN t ON t.tbl = s.tbl AND t.col = s.col WHERE s.tbl IN (SELECT tbl FROM altered)
UNION ALL SELECT unnest(CASE WHEN want_nullable THEN ['set_nullable'] ELSE ['fill_nulls', 'set_not_null'] END), tbl, col FROM kept WHERE tbl IN (SELECT tbl FROM altered) AND nullable <> want_nullable""")
def schema_plan(spark, sf):
    return catalogs.plans(catalog(spark, sf, "s"), catalog(spark, sf, "t")).select("action", F.col("tbl").alias("table_name"), "name")


@query(f"""WITH {CATALOGS}, k AS ({keys_sql('s')}),
usable AS (SELECT k.tbl, k.name, k.cols FROM k WHERE kind = 'unique' AND NOT EXISTS (SELECT 1 FROM s WHERE s.tbl = k.tbl AND s.nullable AND list_contains(k.cols, s.col))),
first_ AS (SELECT tbl, arg_min(cols, name) AS cols FROM usable GROUP BY tbl),
full_ AS (SELECT tbl, count(*) AS n FROM s GROUP BY tbl HAVING NOT bool_or(nullable)),
whole AS (SELECT k.tbl, arg_min(k.cols, k.name) AS cols FROM k JOIN full_ ON k.tbl = full_.tbl AND len(k.cols) = full_.n GROUP BY k.tbl)
SELECT n.tbl AS table_name, CASE WHEN f.tbl IS NOT NULL THEN 'unique' WHEN w.tbl IS NOT NULL THEN 'whole_row' ELSE 'none' END AS kind, coalesce(array_to_string(coalesce(f.cols, w.cols), ','), '') AS columns
FROM (SELECT DISTINCT tbl FROM s) n LEFT JOIN first_ f ON f.tbl = n.tbl LEFT JOIN whole w ON w.tbl = n.tbl""")
def choose_key_unique(spark, sf):
    return catalogs.chosen_keys(catalog(spark, sf, "s"), catalog_keys(spark, sf, "s")).withColumnsRenamed({"tbl": "table_name", "cols": "columns"})


@query(f"WITH {CATALOGS} SELECT tbl AS table_name, col AS name, type, CASE type WHEN 'json.binary' THEN 'json' ELSE type END AS negotiated FROM s")
def negotiate_types(spark, sf):
    return catalog(spark, sf, "s").select(F.col("tbl").alias("table_name"), F.col("col").alias("name"), "type", catalogs.negotiated(F.col("type"), "mysql").alias("negotiated"))


LABELS = "SELECT 'e' || n_regionkey AS enum, n_nationkey AS pos, n_name || '''s' AS label FROM nation"


def labels(spark, sf) -> DataFrame:
    """(enum, pos, label): an enum for each region."""
    return read(spark, sf, "nation").select(F.concat(F.lit("e"), "n_regionkey").alias("enum"), F.col("n_nationkey").alias("pos"), F.concat("n_name", F.lit("'s")).alias("label"))


@query(f"SELECT enum, string_agg(label, ',' ORDER BY pos) AS labels FROM ({LABELS}) GROUP BY enum")
def enum_values(spark, sf):
    return enum_labels(labels(spark, sf)).select("enum", F.array_join("labels", ",").alias("labels"))


@query(f"SELECT enum, 'enum_' || left(sha256(string_agg(label, ',' ORDER BY pos)), 8) AS type_name FROM ({LABELS}) GROUP BY enum")
def enum_type_name(spark, sf):
    return enum_labels(labels(spark, sf)).select("enum", scalars.enum_type_name(F.col("labels")).alias("type_name"))


@query(f"""WITH k AS (SELECT CAST(substr(tbl, 2) AS BIGINT) % 50 AS db, tbl, name FROM ({keys_sql('s')})),
n AS (SELECT *, row_number() OVER (PARTITION BY db, name ORDER BY tbl) AS i FROM k) SELECT db, tbl AS table_name, name, CASE WHEN i = 1 THEN name ELSE name || '_' || i END AS new_name FROM n""")
def index_name_dedupe(spark, sf):
    """Fifty databases in which all index names must differ."""
    rows = catalog_keys(spark, sf, "s").withColumn("db", F.substring("tbl", 2, 20).cast("long") % 50)
    return catalogs.unique_names(rows, 63).select("db", F.col("tbl").alias("table_name"), "name", F.col("new").alias("new_name"))


# -- scalar functions ----------------------------------------------------------------------------


@query(r"""SELECT event_id, CASE WHEN contains(v, '.') THEN regexp_replace(v, '\.?0+$', '') ELSE v END AS trimmed
FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%H:%M:%S.%f') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.000000') END AS v FROM events)""")
def trim_fractional_zeros(spark, sf):
    n = F.col("event_id") % 3
    v = F.when(n == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(n == 1, F.date_format("ts", "HH:mm:ss.SSSSSS")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.'000000'"))
    return read(spark, sf, "events").select("event_id", scalars.trim_fractional_zeros(v).alias("trimmed"))


#: Points at made-up places, byte order, type and two doubles; with a SRID or zeros in front, or as EWKB with a SRID or without.
POINT = "'0101000000' || upper(md5(p_name))"
GEOMETRY = f"SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN '00' WHEN p_partkey % 2 = 0 THEN '00000000' || {POINT} ELSE 'E6100000' || {POINT} END AS h FROM part"
EWKB = f"SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN '00' WHEN p_partkey % 2 = 0 THEN {POINT} ELSE '0101000020E6100000' || upper(md5(p_name)) END AS h FROM part"


def geometry(spark, sf, *, flat: str, flagged: str) -> DataFrame:
    """(p_partkey, h): too short, or a point after `flat` or `flagged`."""
    h = F.when(F.expr("p_partkey % 7 = 0"), "00").when(F.expr("p_partkey % 2 = 0"), F.concat(F.lit(flat), F.upper(F.md5("p_name")))).otherwise(F.concat(F.lit(flagged), F.upper(F.md5("p_name"))))
    return read(spark, sf, "part").select("p_partkey", h.alias("h"))


@query(f"""SELECT p_partkey, CASE WHEN length(h) < 18 THEN h WHEN left(h, 8) = '00000000' THEN substr(h, 9) ELSE substr(h, 9, 2) || substr(h, 11, 6) || '20' || left(h, 8) || substr(h, 19) END AS ewkb FROM ({GEOMETRY})""")
def geom_to_ewkb(spark, sf):
    return geometry(spark, sf, flat="000000000101000000", flagged="E61000000101000000").select("p_partkey", F.hex(spatial.to_ewkb(F.unhex("h"))).alias("ewkb"))


@query(f"""SELECT p_partkey, CASE WHEN length(h) < 10 THEN h WHEN substr(h, 9, 2) = '20' THEN substr(h, 11, 8) || left(h, 8) || '00' || substr(h, 19) ELSE '00000000' || h END AS geom FROM ({EWKB})""")
def ewkb_to_geom(spark, sf):
    return geometry(spark, sf, flat="0101000000", flagged="0101000020E6100000").select("p_partkey", F.hex(spatial.from_ewkb(F.unhex("h"))).alias("geom"))


@query("SELECT p_partkey, octet_length(unhex(md5(p_name))) AS n, hex(unhex(md5(p_name))) AS again FROM part")
def hex_decode(spark, sf):
    b = scalars.hex_decode(F.md5("p_name"))
    return read(spark, sf, "part").select("p_partkey", F.octet_length(b).cast("long").alias("n"), F.hex(b).alias("again"))


@query("""SELECT p_partkey, '"' || replace(p_name, '"', '""') || '"' AS quoted FROM part""")
def quote_identifier(spark, sf):
    return read(spark, sf, "part").select("p_partkey", scalars.quote_identifier(F.col("p_name")).alias("quoted"))


@query("SELECT p_partkey, p_brand || '|' || p_type || '''s|' || p_name AS labels FROM part")
def parse_enum_list(spark, sf):
    """Spelt as an enum of three labels, one of them with a quote, and read back."""
    spelling = F.concat(F.lit("enum('"), "p_brand", F.lit("','"), "p_type", F.lit("''s','"), "p_name", F.lit("')"))
    return read(spark, sf, "part").select("p_partkey", F.array_join(scalars.parse_enum_list(spelling), "|").alias("labels"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN NULL ELSE p_size END AS length, CASE p_partkey % 3 WHEN 2 THEN CAST(p_partkey % 10 AS INTEGER) END AS scale FROM part")
def parse_type_size(spark, sf):
    n, size = F.col("p_partkey") % 3, F.col("p_size").cast("string")
    v = F.when(n == 0, "int").when(n == 1, F.concat(F.lit("varchar("), size, F.lit(")"))).otherwise(F.concat(F.lit("decimal("), size, F.lit(", "), (F.col("p_partkey") % 10).cast("string"), F.lit(")")))
    return read(spark, sf, "part").select("p_partkey", scalars.type_length(v).alias("length"), scalars.type_scale(v).alias("scale"))


@query("SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN '' ELSE lower(regexp_extract(s_name, '[A-Za-z]+')) END AS subtype, CASE s_suppkey % 3 WHEN 2 THEN s_nationkey ELSE 0 END AS srid FROM supplier")
def parse_spatial_type(spark, sf):
    n, name = F.col("s_suppkey") % 3, F.regexp_extract("s_name", "[A-Za-z]+", 0)
    v = F.when(n == 0, "geometry").when(n == 1, F.concat(F.lit("geometry("), name, F.lit(")"))).otherwise(F.concat(F.lit("geometry("), name, F.lit(","), F.col("s_nationkey").cast("string"), F.lit(")")))
    return read(spark, sf, "supplier").select("s_suppkey", scalars.spatial_subtype(v).alias("subtype"), scalars.spatial_srid(v).alias("srid"))


@query("SELECT doc_id, toxic = 1 AS toxic, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE quality = 1 END AS quality FROM labels")
def decode_boolean(spark, sf):
    """As digits, as letters, and as something else."""
    letters = F.when(F.expr("doc_id % 5 = 0"), "2").when(F.col("quality") == 1, "t").otherwise("f")
    return read(spark, sf, "labels").select("doc_id", scalars.decode_boolean(F.col("toxic").cast("string")).alias("toxic"), scalars.decode_boolean(letters).alias("quality"))
