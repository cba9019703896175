"""Commits: files that change and files that stay, journals that are completed, databases whose tables refer to each other."""

import os
import shutil
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.operators import commit
from concord.plans.dependencies import linked, parents_first
from concord.plans.model import ColumnDef, Default, KeyDef, KeyKind, TableDef, table_of
from concord.plans.sync import endpoint, sync
from concord.sources.jdbc import JdbcSource
from concord.sources.tables import ParquetSource
from tests.test_sync import rows

DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def files(path):
    return {p.name: p.stat().st_mtime_ns for p in path.iterdir() if p.name.endswith(".parquet")}


# -- folders -------------------------------------------------------------------------------------


@pytest.fixture
def many_files(spark, tmp_path):
    """A table of 20 files at the target, and a source that differs in three keys of three files, and in a new one."""
    source, target = ParquetSource(spark, str(tmp_path / "a b")), ParquetSource(spark, str(tmp_path / "b c"))
    df = spark.range(2_000).select("id", F.concat(F.lit("v"), F.col("id")).alias("v"), (F.col("id") / 7).alias("x"))
    df.repartitionByRange(20, "id").write.parquet(f"{target.path}/t.parquet")
    changed = df.where("id <> 1500").withColumn("v", F.when(F.col("id").isin(3, 777), "new").otherwise(F.col("v")))
    changed.unionByName(spark.range(5_000, 5_002).select("id", F.lit("come").alias("v"), F.lit(1.0).alias("x"))).write.parquet(f"{source.path}/t.parquet")
    return source, target, {"t": table_of(df, "t", ("id",))}, tmp_path / "b c" / "t.parquet"


@pytest.mark.parametrize(("width", "how"), [(None, "often"), (64, "success")])
def test_files_without_changed_keys_stay(many_files, width, how):
    source, target, tables, path = many_files
    before = files(path)
    done = sync(source, target, tables=tables, width=width, commit=how)
    after = files(path)
    assert len(before) == 20 and sum(after.get(n) == t for n, t in before.items()) == 17
    assert rows(target.read("t")) == rows(source.read("t")) and done[0].counts() == {"insert": 2, "replace": 2, "delete": 1}
    left = sorted(os.listdir(path.parent))
    assert [n for n in left if n.startswith(".") and not n.endswith(".crc")] == [] and "_commit.json" not in left
    assert sync(source, target, tables=tables, width=width, commit=how)[0].counts() == {}
    assert files(path) == after


def test_the_comparison_runs_once(many_files, spark, monkeypatch):
    """Each side is scanned once for the changes and their numbers; of the target, only the files that change are read again."""
    source, target, tables, path = many_files
    from concord.plans import sync as module

    written = []
    hold = ParquetSource.hold
    monkeypatch.setattr(ParquetSource, "hold", lambda self, table, changes: written.append(changes._jdf.queryExecution().executedPlan().toString()) or hold(self, table, changes))
    monkeypatch.setattr(module, "summary", lambda changes: pytest.fail("the changes are counted by themselves"))
    sync(source, target, tables=tables)
    assert len(written) == 1 and written[0].count("FileScan parquet") == 2


@pytest.mark.parametrize("stop", range(9))
def test_a_commit_that_dies_is_completed_by_the_next_run(many_files, spark, monkeypatch, stop):
    source, target, tables, path = many_files
    steps = []

    class Dead(BaseException):
        pass

    def dying(f):
        def run(*args):
            steps.append(f.__name__)
            if len(steps) > stop:
                raise Dead
            return f(*args)

        return run

    with monkeypatch.context() as m:
        m.setattr(commit, "move", dying(commit.move))
        m.setattr(commit, "finish", dying(commit.finish))
        try:
            sync(source, target, tables=tables, commit="success")
        except Dead:
            assert commit.exists(spark, f"{target.path}/_commit.json")
    target.recover()
    assert rows(target.read("t")) == rows(source.read("t")) and target.stored("t")
    assert not [n for n in os.listdir(path.parent) if n.startswith(".old") or n == "_commit.json"]
    assert sync(source, target, tables=tables)[0].counts() == {}
    assert not commit.recover(spark, target.path)


def test_an_error_within_a_commit_undoes_it(many_files, spark, monkeypatch):
    source, target, tables, path = many_files
    before, seen = rows(target.read("t")), []

    def failing(spark, a, b, move=commit.move):
        seen.append(a)
        if len(seen) == 4:
            raise OSError("full")
        move(spark, a, b)

    with monkeypatch.context() as m:
        m.setattr(commit, "move", failing)
        with pytest.raises(OSError, match="full"):
            sync(source, target, tables=tables)
    assert rows(target.read("t")) == before and not commit.exists(spark, f"{target.path}/_commit.json")
    sync(source, target, tables=tables)
    assert rows(target.read("t")) == rows(source.read("t"))


def test_a_source_without_tables_drops_nothing(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    target = ParquetSource(spark, str(tmp_path / "b"))
    target.write("t", spark.range(3))
    with pytest.raises(ValueError, match="lists no tables"):
        sync(ParquetSource(spark, str(tmp_path / "empty")), target, alter=True)
    assert target.tables() == ["t"]


# -- databases -----------------------------------------------------------------------------------


def derby(spark, tmp_path, name, statements=(), **more):
    db = JdbcSource(spark, f"jdbc:derby:{tmp_path}/{name};create=true", DRIVER, **more)
    db.execute(list(statements))
    return db


def test_only_the_schema_that_is_meant_is_changed(spark, tmp_path):
    make = ['CREATE SCHEMA "OTHER"', 'CREATE TABLE "T" (X integer)', 'INSERT INTO "T" VALUES (5)', 'CREATE TABLE "OTHER"."T" (ID varchar(3) NOT NULL PRIMARY KEY, V varchar(9))', 'CREATE INDEX "OTHER"."OLD" ON "OTHER"."T" (V)']
    target = derby(spark, tmp_path, "t", make, schema="OTHER")
    source = derby(spark, tmp_path, "s", ['CREATE TABLE "T" (ID integer NOT NULL PRIMARY KEY, V varchar(9))', 'CREATE INDEX "BY_V" ON "T" (V)', "INSERT INTO \"T\" VALUES (1, 'a')"])
    sync(source, target, alter=True)
    app = JdbcSource(spark, target.url, DRIVER)
    assert rows(app.read("T")) == [(5,)] and [c.name for c in app.definition("T").columns] == ["X"]
    assert rows(target.read("T")) == [(1, "a")] and [k.name for k in target.definition("T").keys] == ["BY_V"]
    target.execute(['DROP INDEX "OTHER"."BY_V"'])
    sync(source, target, alter=True)
    assert target.definition("T") == source.definition("T")


def test_schemas_and_tables_are_found_by_their_exact_names(spark, tmp_path):
    make = ['CREATE SCHEMA "pg_x"', 'CREATE TABLE "pg_x"."T" (ID integer NOT NULL PRIMARY KEY)', 'CREATE SCHEMA "pgax"', 'CREATE TABLE "pgax"."U" (Y integer)']
    make += ['CREATE TABLE "A_B" (ID integer, V integer)', 'CREATE TABLE "AXB" (ID integer, W integer)']
    source = derby(spark, tmp_path, "s", make, schema="pg_x")
    assert source.tables() == ["T"]
    app = JdbcSource(spark, source.url, DRIVER)
    assert app.tables() == ["AXB", "A_B"] and [c.name for c in app.definition("A_B").columns] == ["ID", "V"]
    target = derby(spark, tmp_path, "t", ['CREATE TABLE "T" (ID integer NOT NULL PRIMARY KEY)', 'INSERT INTO "T" VALUES (1)'])
    sync(source, target, alter=True)
    assert target.tables() == ["T"] and rows(target.read("T")) == []


FAMILY = [
    'CREATE TABLE "z_parent" ("id" integer NOT NULL PRIMARY KEY, "v" varchar(9))',
    'CREATE TABLE "a_child" ("id" integer NOT NULL PRIMARY KEY, "p" integer, CONSTRAINT "to_parent" FOREIGN KEY ("p") REFERENCES "z_parent")',
    'CREATE TABLE "left" ("id" integer NOT NULL PRIMARY KEY, "r" integer)', 'CREATE TABLE "right" ("id" integer NOT NULL PRIMARY KEY, "l" integer)',
    'ALTER TABLE "left" ADD CONSTRAINT "lr" FOREIGN KEY ("r") REFERENCES "right" DEFERRABLE', 'ALTER TABLE "right" ADD CONSTRAINT "rl" FOREIGN KEY ("l") REFERENCES "left" DEFERRABLE',
    'CREATE TABLE "m_alone" ("id" integer NOT NULL PRIMARY KEY)',
]


@pytest.mark.parametrize("how", ["often", "success"])
def test_tables_that_refer_to_each_other_are_changed_in_one_transaction(spark, tmp_path, how):
    a, b = (derby(spark, tmp_path, n, FAMILY) for n in "ab")
    fill = lambda db, parents, children, pairs: db.execute([
        *(f"INSERT INTO \"z_parent\" VALUES ({i}, '{v}')" for i, v in parents), *(f'INSERT INTO "a_child" VALUES ({i}, {p})' for i, p in children),
        *(f'INSERT INTO "left" VALUES ({i}, NULL)' for i in pairs), *(f'INSERT INTO "right" VALUES ({i}, {i})' for i in pairs), *(f'UPDATE "left" SET "r" = {i} WHERE "id" = {i}' for i in pairs),
    ])
    fill(a, [(1, "new"), (3, "three")], [(10, 1), (12, 3)], [2, 3])
    fill(b, [(1, "old"), (2, "two")], [(10, 1), (11, 2)], [1, 2])
    assert b.references(b.tables()) == [("a_child", "z_parent"), ("left", "right"), ("right", "left")]
    assert b.transactions(b.tables()) == [["a_child", "z_parent"], ["left", "right"], ["m_alone"]]
    done = {r.table: r.counts() for r in sync(a, b, commit=how)}
    assert done["z_parent"] == {"insert": 1, "replace": 1, "delete": 1} and done["left"] == {"insert": 1, "delete": 1}
    assert all(rows(b.read(t)) == rows(a.read(t)) for t in a.tables()) and b.tables() == a.tables()
    # nothing of a failed transaction stays
    a.execute(['INSERT INTO "z_parent" VALUES (7, NULL)', 'INSERT INTO "a_child" VALUES (77, 7)'])
    b.execute(['CREATE TABLE "q" ("c" integer REFERENCES "z_parent")', 'INSERT INTO "q" VALUES (3)'])
    a.execute(['DELETE FROM "a_child" WHERE "p" = 3', 'DELETE FROM "z_parent" WHERE "id" = 3'])
    before = {t: rows(b.read(t)) for t in a.tables()}
    with pytest.raises(Exception, match="(?i)constraint"):
        sync(a, b, ignore="q", commit=how)
    assert {t: rows(b.read(t)) for t in a.tables()} == before


def test_dropped_tables_go_before_those_they_refer_to(spark, tmp_path):
    a = derby(spark, tmp_path, "a", FAMILY[-1:])
    b = derby(spark, tmp_path, "b", [*FAMILY[:2], FAMILY[-1], 'INSERT INTO "z_parent" VALUES (1, NULL)', 'INSERT INTO "a_child" VALUES (1, 1)'])
    done = sync(a, b, alter=True)
    assert [r.table for r in done] == ["m_alone", "a_child", "z_parent"] and b.tables() == ["m_alone"]


def test_order_of_tables():
    edges = [("child", "parent"), ("grand", "child"), ("x", "y"), ("y", "x"), ("y", "parent"), ("self", "self"), ("child", "elsewhere")]
    order = parents_first(["child", "grand", "parent", "self", "x", "y"], edges)
    at = {n: i for i, g in enumerate(order) for n in g}
    assert at["parent"] < at["child"] < at["grand"] and at["x"] == at["y"] > at["parent"] and sorted(at) == ["child", "grand", "parent", "self", "x", "y"]
    assert linked(["grand", "self", "parent", "child"], edges) == [["grand", "parent", "child"], ["self"]]


def test_identity_columns_go_on_after_the_greatest_value(spark, tmp_path):
    make = ['CREATE TABLE "t" ("inc" integer NOT NULL GENERATED BY DEFAULT AS IDENTITY PRIMARY KEY, "v" integer)']
    a, b = (derby(spark, tmp_path, n, make) for n in "ab")
    a.execute([f'INSERT INTO "t" VALUES ({n * 2 + 5}, {n})' for n in range(20)])
    sync(a, b)
    b.execute(['INSERT INTO "t" ("v") VALUES (99)'])
    assert rows(b.read("t").where('"v" = 99'.replace('"', "`"))) == [(44, 99)]
    assert JdbcSource(spark, "jdbc:postgresql://h/d", schema="s").restarting("t", ColumnDef("inc", "integer", default_kind=Default.SEQUENCE), 44) == "SELECT setval(pg_get_serial_sequence('\"s\".\"t\"', 'inc'), 44, false)"


@pytest.mark.parametrize("keys", [["u"], ["n", "u"], ["d"]])
def test_tables_are_read_in_ranges_of_any_key(spark, tmp_path, keys):
    make = ['CREATE TABLE "t" ("u" varchar(20) NOT NULL, "n" integer NOT NULL, "d" date NOT NULL, "v" integer)', 'CREATE TABLE "none" ("u" varchar(20) NOT NULL, "n" integer NOT NULL, "d" date NOT NULL)']
    a = derby(spark, tmp_path, "a", make, partitions=4)
    a.execute(["INSERT INTO \"t\" VALUES " + ", ".join(f"('k''{i % 37:02}', {i}, DATE('2001-02-{i % 28 + 1:02}'), {i})" for i in range(100))])
    df = a.read("t", keys)
    assert df.rdd.getNumPartitions() == 4 and rows(df) == rows(a.read("t"))
    assert min(df.groupBy(F.spark_partition_id()).count().toPandas()["count"]) >= 10
    assert a.read("none", keys).count() == 0


def test_a_sync_reads_in_ranges(spark, tmp_path, monkeypatch):
    make = ['CREATE TABLE "t" ("u" varchar(20) NOT NULL PRIMARY KEY, "v" integer)', "INSERT INTO \"t\" VALUES " + ", ".join(f"('k{i:02}', {i})" for i in range(50))]
    a = derby(spark, tmp_path, "a", make, partitions=3)
    b = derby(spark, tmp_path, "b", [make[0]], partitions=3)
    seen, read = [], JdbcSource.read
    monkeypatch.setattr(JdbcSource, "read", lambda self, *args: seen.append((df := read(self, *args)).rdd.getNumPartitions()) or df)
    sync(a, b)
    assert seen[0] == 3 and rows(b.read("t")) == rows(a.read("t"))


def test_statements_of_a_shared_snapshot(spark, monkeypatch):
    pg = JdbcSource(spark, "jdbc:postgresql://h/d", {"sessionInitStatement": "SET search_path TO s"})
    assert pg.joining("00-1") == "SET TRANSACTION ISOLATION LEVEL REPEATABLE READ, READ ONLY; SET TRANSACTION SNAPSHOT '00-1'; SET search_path TO s"
    said = []
    monkeypatch.setattr(JdbcSource, "connection", __import__("contextlib").contextmanager(lambda self: iter([said])))
    monkeypatch.setattr(JdbcSource, "_run", lambda self, c, statements: c.extend(statements))
    monkeypatch.setattr(JdbcSource, "_select", lambda self, c, sql: c.append(sql) or [["00-7"]])
    with pg.one_moment() as one:
        assert one.options["sessionInitStatement"] == pg.joining("00-7") and one.options["fetchsize"] == "10000"
    assert said == ["SET TRANSACTION ISOLATION LEVEL REPEATABLE READ, READ ONLY", "SELECT pg_export_snapshot()"]
    other = JdbcSource(spark, "jdbc:derby:x")
    with other.one_moment() as one:
        assert one is other
    assert JdbcSource(spark, "jdbc:mysql://h/d").ranges(["a", "b"], [[1, "x\\'"]]) == ["(`a` IS NULL OR `b` IS NULL OR NOT ((`a` > 1) OR (`a` = 1 AND `b` > 'x\\\\''')))", "((`a` > 1) OR (`a` = 1 AND `b` > 'x\\\\'''))"]


def test_endpoints(spark):
    pg = endpoint(spark, "postgres://me:p%40ss@host:5433/db/own")
    assert (pg.url, pg.options, pg.schema) == ("jdbc:postgresql://host:5433/db", {"user": "me", "password": "p@ss"}, "own")
    assert endpoint(spark, "mysql://host/db").url == "jdbc:mysql://host/db" and endpoint(spark, "jdbc:derby:x").url == "jdbc:derby:x"
    assert endpoint(spark, "hdfs://host/a/b").path == "hdfs://host/a/b" and isinstance(endpoint(spark, "/tmp/x"), ParquetSource)


def test_a_table_without_a_key_is_left_alone_if_nothing_differs(spark, tmp_path, monkeypatch):
    make = ['CREATE TABLE "j" ("a" integer NOT NULL, "b" integer NOT NULL)', 'CREATE INDEX "both" ON "j" ("b", "a")', 'INSERT INTO "j" VALUES (1, 2), (1, 2), (3, 4)']
    a, b = (derby(spark, tmp_path, n, make) for n in "ab")
    assert a.definition("j").keys == (KeyDef("both", columns=("b", "a")),)
    ran, execute = [], JdbcSource._run
    monkeypatch.setattr(JdbcSource, "_run", lambda self, c, s: ran.extend(s) or execute(self, c, s))
    assert sync(a, b)[0].counts() == {} and not [s for s in ran if s.startswith("DELETE")]
    a.execute(['INSERT INTO "j" VALUES (3, 4)'])
    assert sync(a, b)[0].counts() == {"replace": 1} and rows(b.read("j")) == [(1, 2), (1, 2), (3, 4), (3, 4)]


def test_a_missing_schema_is_created(spark, tmp_path):
    source = derby(spark, tmp_path, "s", ['CREATE TABLE "t" ("id" integer NOT NULL PRIMARY KEY)', 'INSERT INTO "t" VALUES (1)'])
    target = derby(spark, tmp_path, "t", schema="new one")
    sync(source, target, alter=True)
    assert target.tables() == ["t"] and rows(target.read("t")) == [(1,)] and JdbcSource(spark, target.url, DRIVER).tables() == []


def test_a_stream_changes_the_files_it_must(spark, tmp_path):
    """Late rows change nothing, files without keys of a batch stay, and what a stream repeats is there once."""
    from concord.streaming.refresh import refresh, upsert

    path, feed, schema = tmp_path / "target.parquet", str(tmp_path / "feed"), "id int, v string, at int"
    target = spark.createDataFrame([(i, "old", 5) for i in range(100)], schema)
    target.repartitionByRange(10, "id").write.parquet(str(path))
    before = files(path)
    come = spark.createDataFrame([(3, "late", 4), (7, "same time", 5), (8, "new", 6), (8, "newest", 7), (200, "added", 1)], schema)
    come.write.parquet(feed)
    for i in range(2):
        refresh(spark.readStream.schema(schema).parquet(feed), str(path), ["id"], "at", str(tmp_path / f"cp{i}")).awaitTermination()
    got = {r.id: (r.v, r.at) for r in spark.read.parquet(str(path)).collect()}
    assert len(got) == 101 and (got[3], got[7], got[8], got[200]) == (("old", 5), ("same time", 5), ("newest", 7), ("added", 1))
    assert spark.read.parquet(str(path)).count() == 101 and sum(n in files(path) for n in before) == 9
    assert rows(upsert(target, come, ["id"], "at")) == rows(spark.read.parquet(str(path)))
    assert not [n for n in os.listdir(tmp_path) if n.startswith((".", "_"))]


def test_keys_of_several_columns_page_by_page(spark):
    from concord.operators import diff, ranges

    df = spark.createDataFrame([(i // 7, f"k{i % 7}", i) for i in range(50)], "a int, b string, v int")
    got = [[r.v for r in p.collect()] for p in ranges.pages(df, ["a", "b"], 12)]
    assert got == [list(range(s, min(s + 12, 50))) for s in range(0, 50, 12)]
    none = df.limit(0)
    assert list(ranges.pages(none, ["a", "b"], 3)) == [] and diff.tail_inserts(df, none, ["a", "b"]).count() == 50 and diff.tail_inserts(none, df, ["a", "b"]).count() == 0
    assert diff.out_of_range(none, df, ["a", "b"]).count() == 50 and diff.out_of_range(df, none, ["a", "b"]).count() == 0


def test_verify_counts_copies(spark):
    from concord.operators import diff

    a, b = (spark.createDataFrame(x, "k int, v double") for x in ([(1, None), (1, None), (2, 0.0), (3, 1.0)], [(1, None), (2, -0.0), (4, float("nan")), (4, float("nan"))]))
    assert rows(diff.verify(a, b)) == [(2, 2)] and rows(diff.verify(a, a)) == [(0, 0)] and rows(diff.verify(a.limit(0), b.limit(0))) == [(0, 0)]


def test_digests(spark):
    import xxhash

    from concord.operators import encode

    assert encode.choose_digest(encode.DIGESTS, ["md5", "sha256"]) == "md5" and encode.choose_digest(encode.DIGESTS) == "xxhash64"
    with pytest.raises(ValueError, match="no digest"):
        encode.choose_digest(["md5"], ["sha256"])
    df = spark.createDataFrame([(i, f"v{i}") for i in range(20)], "k long, v string")
    told = lambda text: format(xxhash.xxh64_intdigest(text.encode(), 42), "X")
    got = {r.block: r.digest for r in encode.block_digest(df, "k", ["k", "v"], 8, "xxhash64").collect()}
    assert got == {b: told("".join(told(f"{len(str(k))}:{k}{len(f'v{k}')}:v{k}") for k in range(b * 8, min(b * 8 + 8, 20)))) for b in range(3)}


def test_what_catalogs_say_of_enums_and_extras(spark):
    """Texts only, as these drivers are not installed: what is asked, and what is made of the answers."""
    from concord.functions.scalars import enum_type_name
    from concord.plans import ddl

    asked = []

    def answering(rows):
        return type("Source", (JdbcSource,), {"_select": lambda self, c, sql: asked.append(sql) or rows})

    mysql = answering([["e", "enum('a','it''s')", ""], ["n", "int unsigned", "auto_increment"], ["at", "timestamp", "DEFAULT_GENERATED on update CURRENT_TIMESTAMP"]])(spark, "jdbc:mysql://h/d")
    spelled, enums = mysql._spellings(None, "d", "t's")
    assert asked.pop() == "SELECT column_name, column_type, extra FROM information_schema.columns WHERE table_schema = 'd' AND table_name = 't''s'"
    row = lambda n, **more: {"COLUMN_NAME": n, "NULLABLE": 0, "COLUMN_SIZE": 0, "DECIMAL_DIGITS": 0, "COLUMN_DEF": None, "TYPE_NAME": "X", "DATA_TYPE": 12, **more}
    made = [mysql._column(row(n, **more), spelled, enums) for n, more in (("e", {}), ("n", {}), ("at", {"COLUMN_DEF": "CURRENT_TIMESTAMP"}))]
    assert [(c.type_name, c.enum_values, c.default_kind, c.auto_update) for c in made] == [("enum", ("a", "it's"), Default.NONE, False), ("integer.unsigned", (), Default.SEQUENCE, False), ("datetime.mysqltimestamp", (), Default.EXPRESSION, True)]
    pg = answering([["mood", "sad"], ["mood", "ok"]])(spark, "jdbc:postgresql://h/d")
    spelled, enums = pg._spellings(None, "public", "t")
    assert "pg_enum" in asked[-1] and "nspname = 'public'" in asked[-1]
    c = pg._column(row("m", TYPE_NAME="mood"), spelled, enums)
    assert (c.type_name, c.enum_values, c.subtype) == ("enum", ("sad", "ok"), "mood")
    table = TableDef("t", (c, made[0]))
    name = spark.range(1).select(enum_type_name(F.array(F.lit("a"), F.lit("it's"))).alias("n")).first().n
    assert ddl.enum_type_sql(table, "postgresql", "s") == [
        "DO $$ BEGIN CREATE TYPE \"s\".\"mood\" AS ENUM ('sad', 'ok'); EXCEPTION WHEN duplicate_object THEN NULL; END $$",
        f"DO $$ BEGIN CREATE TYPE \"s\".\"{name}\" AS ENUM ('a', 'it''s'); EXCEPTION WHEN duplicate_object THEN NULL; END $$",
    ]
    assert ddl.type_sql(made[0], "postgresql") == f'"{name}"' and ddl.enum_type_sql(table, "mysql") == [] and ddl.type_sql(made[0], "mysql") == "enum('a','it''s')"


def test_sizes_order_tables(spark):
    asked = []
    of = lambda url: type("Source", (JdbcSource,), {"_select": lambda self, c, sql: asked.append(sql) or [["a", 5], ["b", 70]]})(spark, url)
    assert of("jdbc:mysql://h/d")._sizes(None, "d") == of("jdbc:postgresql://h/d")._sizes(None, "s") == {"a": 5, "b": 70} and of("jdbc:derby:x")._sizes(None, "APP") == {}
    assert "information_schema.tables WHERE table_schema = 'd'" in asked[0] and "n.nspname = 's'" in asked[1]


def test_jobs_are_described(many_files, spark, monkeypatch):
    source, target, tables, _ = many_files
    seen, hold = [], ParquetSource.hold
    monkeypatch.setattr(ParquetSource, "hold", lambda self, *a: seen.append(self.spark.sparkContext.getLocalProperty("spark.job.description")) or hold(self, *a))
    spark.sparkContext.setJobDescription("outer")
    sync(source, target, tables=tables)
    assert seen == ["sync t: compare and write aside"] and spark.sparkContext.getLocalProperty("spark.job.description") == "outer"
    spark.sparkContext.setLocalProperty("spark.job.description", None)


def test_definitions_without_columns_are_no_tables():
    assert TableDef("t").stored == []


def test_a_folder_of_mysql_types_goes_to_derby_and_back(spark, tmp_path):
    """Definitions and rows of another dialect: what comes back is what went, and neither side then differs."""
    columns = (
        ColumnDef("id", "integer.unsigned.64bit", False), ColumnDef("flag", "boolean"), ColumnDef("kind", "enum", False, enum_values=("red", "with'quote")), ColumnDef("tiny", "integer.unsigned.8bit"),
        ColumnDef("big", "integer.unsigned"), ColumnDef("name", "text.varchar", size=30), ColumnDef("code", "text.fixed", size=8), ColumnDef("at", "datetime.mysqltimestamp"), ColumnDef("clock", "time"),
        ColumnDef("u", "uuid"), ColumnDef("price", "decimal", size=9, scale=3), ColumnDef("x", "float.32bit"), ColumnDef("day", "date"),
    )
    table = TableDef("t", columns, ("id",), (KeyDef("k" * 70, KeyKind.STANDARD, ("name",)),))
    from concord.plans.convert import adapted

    rows_ = [
        (Decimal(2**64 - 1), True, "red", 255, 2**32 - 1, "it's", "ab", datetime(2001, 2, 3, 4, 5, 6, 500000), "01:23:45", "0" * 8 + "-aaaa-bbbb-cccc-" + "d" * 12, Decimal("1.500"), 0.5, date(2000, 1, 2)),
        (Decimal(1), None, "with'quote", None, None, None, None, None, None, None, None, None, None), (Decimal(7), False, "red", 0, 0, "", "x", datetime(1999, 1, 1), "23:59:59", None, Decimal("-2.125"), -1.25, None),
    ]
    source, back = ParquetSource(spark, str(tmp_path / "a")), ParquetSource(spark, str(tmp_path / "b"))
    schema = T.StructType([T.StructField(c.name, c.spark_type) for c in columns])
    source.write("t", spark.createDataFrame(rows_, schema))
    source.define({"t": table})
    db = derby(spark, tmp_path, "d")
    sync(source, db, alter=True)
    assert {c.name: (c.type_name, c.size) for c in db.definition("t").columns} == {c.name: (c.type_name, c.size) for c in adapted([table], "derby")["t"].columns}
    assert sync(source, db)[0].counts() == {}
    shutil.copytree(source.path, back.path)
    back.write("t", back.read("t").where("id <> 7").withColumn("name", F.lit("old")))
    assert sync(db, back)[0].counts() == {"insert": 1, "replace": 2}
    assert back.definition("t") == table and rows(back.read("t")) == rows(source.read("t")) and back.read("t").schema == source.read("t").schema
    assert sync(db, back)[0].counts() == {} and sync(back, db)[0].counts() == {}


def test_forms_of_values_between_databases(spark):
    from concord.plans import convert

    table = TableDef("t", (ColumnDef("g", "spatial"), ColumnDef("c", "text.fixed", size=5), ColumnDef("b", "boolean"), ColumnDef("u", "uuid"), ColumnDef("w", "time")))
    df = spark.createDataFrame([(bytes.fromhex("E6100000010100000000000000000024400000000000003440"), "ab   ", 1, "AB ", datetime(1970, 1, 1, 1, 2, 3, 500000))], "g binary, c string, b int, u string, w timestamp_ntz")
    got = convert.show(df, table, "mysql")
    assert rows(got.select(F.hex("g"), "c", "b", "u", "w")) == [("0101000020E610000000000000000024400000000000003440", "ab", True, "ab", "01:02:03.5")]
    again = convert.spell(got, table.columns, "mysql")
    assert rows(again.select(F.hex("g"), "w")) == rows(df.select(F.hex("g"), "w"))
    assert convert.convert(df, table, table) is df
    narrow = convert.convert(spark.createDataFrame([(300,)], "n int"), TableDef("t", (ColumnDef("n", "integer"),)), TableDef("t", (ColumnDef("n", "integer.8bit"),)))
    with pytest.raises(Exception, match="(?i)overflow"):
        narrow.collect()


def test_definitions_of_two_schemas_do_not_fit_mysql(spark):
    from concord.plans.convert import adapted

    with pytest.raises(ValueError, match="two schemas"):
        adapted([TableDef("t", schema="a"), TableDef("t", schema="b")], "mysql")
    names = [k.name for k in adapted([TableDef("t", keys=(KeyDef("x" * 70), KeyDef("x" * 66)))], "postgresql")["t"].keys]
    assert names == ["x" * 63, "x" * 61 + "_2"]
