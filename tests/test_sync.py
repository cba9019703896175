"""Synchronisation end to end: folders and Derby databases, exact pruning, filters, commits, statistics, DDL."""

import random

import pytest
from pyspark.sql import functions as F

from concord.operators import apply, blocks, diff, encode, filters, tree
from concord.plans import ddl
from concord.plans.model import ColumnDef, Default, KeyDef, KeyKind, TableDef, table_of
from concord.plans.schema_diff import Action
from concord.plans.sync import NotAKey, SchemaMismatch, main, sync, sync_table
from concord.sources.jdbc import JdbcSource
from concord.sources.tables import ParquetSource


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


# -- pruning -------------------------------------------------------------------------------------

VALUES = [0.0, -0.0, 1.0, 1.0 + 1e-12, 1.00001, 1e300, -1e36, 5e-324, float("inf"), float("nan"), None]


@pytest.mark.parametrize("seed", range(3))
def test_pruned_diff_loses_nothing(spark, seed):
    rng = random.Random(seed)
    schema = "k long, a double, b string, c array<string>"
    source = [(k, rng.choice(VALUES), rng.choice(["", "a", None]), rng.choice([None, [], [None, "x"], ["x"]])) for k in range(80)]
    target = [r if rng.random() < 0.8 else (r[0], rng.choice(VALUES), r[3][0] if r[3] else r[2], rng.choice([None, [], [None, "x"], ["x"]])) for r in source if rng.random() < 0.95]
    s, t = (spark.createDataFrame(x, schema) for x in (source, target))
    told = lambda df: sorted(map(repr, rows(df)))  # noqa: E731  as nan is not nan
    full = told(diff.diff(s, t, ["k"]))
    assert full and told(diff.pruned_diff(s, t, "k", s.columns, 4)) == full
    assert rows(diff.block_compare(s, s, "k", s.columns, 4)) == []
    encoded = s.select(encode.encoded_row(s, ["a"]).alias("e"), (F.col("a") + 0.0).alias("a")).distinct()
    assert encoded.select("e").distinct().count() == encoded.count()  # equal values and only those
    assert s.select(encode.encoded_row(s, ["a"], scale=4)).count() == 80


def test_pruned_diff_by_predicates_by_broadcast_and_by_join(spark, monkeypatch):
    s = spark.range(-500, 500).select("id", (F.col("id") * 3).alias("v"))
    t = s.where("id <> -7").withColumn("v", F.when(F.col("id").isin(-500, -16, -15, 0, 15, 16, 499), 1).otherwise(F.col("v")))
    full = rows(diff.diff(s, t, ["id"]))
    for literal, listed in ((1_000, 1_000), (3, 1_000), (3, 3)):
        monkeypatch.setattr(diff, "LITERAL_BLOCKS", literal)
        monkeypatch.setattr(diff, "BROADCAST_BLOCKS", listed)
        assert rows(diff.pruned_diff(s, t, "id", s.columns, 16)) == full
    for first, last in ((-3, -2), (-2, 0), (0, 0), (0, 2), (1, 3)):
        inside = {r.id for r in s.where(diff.key_span("id", 16, first, last)).collect()}
        assert inside == {i for i in range(-500, 500) if first <= int(i / 16) <= last}


def test_pruned_diff_of_other_keys(spark):
    """Keys that are no single integer are dealt by hash: uuids, texts, composite keys."""
    s = spark.range(300).select(F.concat(F.lit("id-"), F.col("id")).alias("u"), (F.col("id") % 7).cast("int").alias("n"), F.col("id").alias("v"))
    t = s.where("v % 50 <> 3").withColumn("v", F.when(F.col("v") % 90 == 1, -1).otherwise(F.col("v")))
    for key in (["u"], ["n", "u"]):
        assert rows(diff.pruned_diff(s, t, key, s.columns, 16)) == rows(diff.diff(s, t, key)) != []
    result = sync_table(s, t, table_of(s, "t", ("u",)), width=16)
    assert result.counts() == {"insert": 6, "replace": 4} and rows(result.state) == rows(s)


KEYS = {
    "u string": lambda rng: rng.choice(["", "a", "Z", "ü", "a'b", "x" * 30]) + str(rng.randrange(60)), "d date": lambda rng: __import__("datetime").date(2000, 1, 1 + rng.randrange(28)), "n int": lambda rng: rng.randrange(-9, 9),
    "x decimal(9,2)": lambda rng: __import__("decimal").Decimal(rng.randrange(-500, 500)) / 4, "at timestamp_ntz": lambda rng: __import__("datetime").datetime(2001, 2, 3, 4, 5, 6, rng.randrange(40)),
}


@pytest.mark.parametrize("names", [["u string"], ["n int", "u string"], ["d date", "n int"], ["x decimal(9,2)"], ["at timestamp_ntz", "n int"]])
def test_blocks_of_any_key_are_ranges_of_it(spark, names, monkeypatch):
    rng = random.Random(str(names))
    key = [n.split()[0] for n in names]
    found = {tuple(KEYS[n](rng) for n in names): i for i in range(600)}
    source = [(*k, i) for k, i in found.items()]
    target = [(*r[:-1], -1 if i % 40 == 3 else r[-1]) for i, r in enumerate(source) if i % 60 != 7]
    s, t = (spark.createDataFrame(x, ", ".join([*names, "v int"])) for x in (source, target))
    whole = rows(diff.diff(s, t, key))
    for width in (3, 16, 10_000):
        assert rows(diff.pruned_diff(s, t, key, s.columns, width)) == whole != []
    monkeypatch.setattr(blocks, "MOST_RANGES", 5)
    monkeypatch.setattr(blocks, "SAMPLED", 200)
    by = blocks.key_blocks(s, key, 7)
    ranges = sorted((r.b, r.low, r.high) for r in s.groupBy(by.range_of().alias("b")).agg(F.min(F.struct(*key)).alias("low"), F.max(F.struct(*key)).alias("high")).collect())
    assert len(ranges) > 2 and by.parts > 1 and all(tuple(a[2]) < tuple(b[1]) for a, b in zip(ranges, ranges[1:]))
    assert rows(diff.pruned_diff(s, t, key, s.columns, 7)) == whole


def test_bounds_are_one_constant_of_the_plan(spark):
    """Not made anew for each row: the time of a row must not grow with the number of ranges."""
    s = spark.range(600).select(F.format_string("k%03d", "id").alias("u"), F.timestamp_seconds("id").alias("at"), (F.col("id") % 7).cast("int").alias("n"))
    for key in (["u"], ["at", "n"], ["n", "u"]):
        by = blocks.key_blocks(s, key, 16)
        found = s.select(by.range_of().alias("b"), *key)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert len(by.bounds) > 8 and "from_json" not in plan and "transform(" not in plan
        assert found.agg(F.count_distinct("b")).first()[0] == len(by.bounds) + 1


def test_differing_blocks_of_a_text_key_reach_the_scan(spark, tmp_path):
    s = spark.range(2_000).select(F.format_string("k%05d", "id").alias("u"), F.col("id").alias("v"))
    s.write.parquet(str(tmp_path / "s"))
    s.withColumn("v", F.when(F.col("u") == "k00777", 0).otherwise(F.col("v"))).write.parquet(str(tmp_path / "t"))
    found = diff.pruned_diff(spark.read.parquet(str(tmp_path / "s")), spark.read.parquet(str(tmp_path / "t")), "u", ["u", "v"], 64)
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert len(pushed) == 2 and all("GreaterThan(u,k" in line and "LessThanOrEqual(u,k" in line for line in pushed)
    assert [r.u for r in found.collect()] == ["k00777"]


@pytest.mark.parametrize("copies", [(1, 3), (2, 4), (2, 1), (3, 0), (0, 2)])
def test_pruning_without_a_key_counts_copies(spark, copies):
    row, rest = (1, None, -0.0), [(i, "x", 0.5) for i in range(50)]
    s, t = (spark.createDataFrame(rest + [row] * n, "a int, b string, c double") for n in copies)
    got = diff.pruned_multiset_diff(s, t, s.columns, 4)
    assert rows(got) == rows(diff.multiset_diff(s, t, s.columns)) and [(r.source_n, r.target_n) for r in got.collect()] == [copies]
    assert rows(diff.pruned_multiset_diff(s, s, s.columns, 4)) == []


def test_copies_are_dealt_over_tasks(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 0), ("c", 3_000_000_000), ("d", 65_537)], "x string, n long")
    parts = apply.chunks(counts, "n")
    told = {r.x: (r.n, r.most) for r in parts.groupBy("x").agg(F.sum(F.col("_to") - F.col("_from") + 1).alias("n"), F.max(F.col("_to") - F.col("_from") + 1).alias("most")).collect()}
    assert {x: n for x, (n, _) in told.items() if n} == {"a": 3, "c": 3_000_000_000, "d": 65_537} and max(m for _, m in told.values()) == apply.CHUNK
    assert parts.where("x = 'c'").select(F.spark_partition_id()).distinct().count() > 1
    few = diff.multiset_expand(counts.where("x <> 'c'"))
    assert few.count() == 65_540 and few.select("x", "copy").distinct().count() == 65_540


def test_bounds_of_empty_sides(spark):
    df, none = spark.createDataFrame([(1,), (5,)], "k long"), spark.createDataFrame([], "k long")
    assert rows(diff.tail_inserts(df, none, "k")) == [(1,), (5,)] and rows(diff.tail_inserts(none, df, "k")) == []
    assert rows(diff.out_of_range(none, df, "k")) == [(1,), (5,)] and rows(diff.out_of_range(df, none, "k")) == []


# -- folders -------------------------------------------------------------------------------------

PEOPLE = [(1, "ann"), (2, "bob"), (3, None)]


@pytest.fixture
def folders(spark, tmp_path):
    source, target = ParquetSource(spark, str(tmp_path / "a")), ParquetSource(spark, str(tmp_path / "b"))
    people = spark.createDataFrame(PEOPLE, "id long, name string")
    source.write("people", people)
    source.write("ids", spark.range(3))
    target.write("people", people.where("id < 3").withColumn("name", F.lit("old")))
    target.write("ids", spark.range(2))
    return source, target, {"people": table_of(people, "people", ("id",)), "ids": table_of(spark.range(1), "ids", ("id",))}


def test_filters_of_unknown_tables_stop_everything(folders):
    source, target, tables = folders
    masked = filters.parse_filters({"poeple": {"replace": {"name": None}}})
    with pytest.raises(filters.FilterDefinitionError):
        sync(source, target, tables=tables, filters=masked)
    assert rows(target.read("people")) == [(1, "old"), (2, "old")]
    # a filter of a table that is left out does not count
    sync(source, target, tables=tables, filters=masked, ignore="poeple,ids")
    assert rows(target.read("people")) == rows(source.read("people"))
    sync(source, target, tables=tables, filters=filters.parse_filters({"people": {"replace": {"name": None}}}))
    assert {r[1] for r in rows(target.read("people"))} == {None}


@pytest.mark.parametrize("commit", ["often", "success"])
def test_statistics_outlive_the_commit(folders, commit, tmp_path):
    source, target, tables = folders
    seen = []
    done = sync(source, target, tables=tables, commit=commit, progress=lambda r: seen.append(r.table))
    counts = {r.table: r.counts() for r in done}
    assert counts == {"people": {"insert": 1, "replace": 2}, "ids": {"insert": 1}} and sorted(seen) == ["ids", "people"]
    assert all(r.changes is None and rows(r.state) == rows(source.read(r.table)) for r in done)
    assert not [p for p in (tmp_path / "b").iterdir() if p.name not in ("people.parquet", "ids.parquet", "_definitions.json", "._definitions.json.crc")]
    assert target.definition("people").primary_key == ("id",)


def test_success_is_all_or_nothing(folders, monkeypatch, tmp_path):
    source, target, tables = folders
    before = {n: rows(target.read(n)) for n in ("people", "ids")}
    publish = ParquetSource.publish
    monkeypatch.setattr(ParquetSource, "publish", lambda self, staged: publish(self, [staged[0], (staged[1][0] + "-gone", staged[1][1])]))
    with pytest.raises(OSError, match="renamed"):
        sync(source, target, tables=tables, commit="success")
    assert {n: rows(target.read(n)) for n in before} == before


def test_a_failed_swap_puts_the_old_state_back(spark, tmp_path):
    path = str(tmp_path / "t")
    apply.write_staged(spark.range(3), path)
    with pytest.raises(OSError):
        apply.swap(spark, [(str(tmp_path / "nothing"), path)])
    assert spark.read.parquet(path).count() == 3


def test_keys_are_checked_where_asked(folders, spark):
    source, target, tables = folders
    source.write("people", spark.createDataFrame([*PEOPLE, (3, "twin"), (None, "x")], "id long, name string"))
    with pytest.raises(NotAKey, match="people"):
        sync(source, target, tables=tables, check_keys=True)


def test_key_actions_arise_between_folders_with_definitions(folders, spark):
    source, target, tables = folders
    sync(source, target, tables=tables)
    named = TableDef("people", tables["people"].columns, ("id",), (KeyDef("names", KeyKind.STANDARD, ("name",)),))
    with pytest.raises(SchemaMismatch):
        sync(source, target, tables={**tables, "people": named})
    done = sync(source, target, tables={**tables, "people": named}, alter=True)
    assert [[a.kind for a in r.schema_actions] for r in done if r.table == "people"] == [["create_key"]]
    assert target.definition("people") == named


def test_command_line(folders, tmp_path, capsys):
    source, target, tables = folders
    from concord.plans.model import DatabaseDef

    (tmp_path / "keys.json").write_text(DatabaseDef(tuple(tables.values())).to_json())
    main(["--from", source.path, "--to", target.path, "--keys", str(tmp_path / "keys.json"), "--commit", "success", "--check-keys", "--block", "2"])
    assert "people explicit [] {" in capsys.readouterr().out
    assert rows(target.read("people")) == rows(source.read("people"))


# -- Derby ---------------------------------------------------------------------------------------

ORDERS = [
    'CREATE TABLE "orders" ("id" integer NOT NULL PRIMARY KEY, "code" varchar(20) NOT NULL, "price" decimal(9,2), "note" varchar(50) DEFAULT \'none\', "big" bigint)',
    'CREATE UNIQUE INDEX "orders_code" ON "orders" ("code")',
]


@pytest.fixture
def databases(spark, tmp_path):
    made = []
    for name in ("a", "b"):
        db = JdbcSource(spark, f"jdbc:derby:{tmp_path}/{name};create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}, partitions=2)
        db.execute(ORDERS)
        made.append(db)
    a, b = made
    a.execute(['INSERT INTO "orders" VALUES (1, \'x\', 1.50, NULL, 10), (2, \'moved\', 2.25, \'it\'\'s\', NULL), (3, \'new\', NULL, \'c\', 30)', 'CREATE TABLE "tags" ("tag" varchar(10))', "INSERT INTO \"tags\" VALUES ('p'), ('q')", 'CREATE VIEW "seen" AS SELECT "id" FROM "orders"'])
    b.execute(["INSERT INTO \"orders\" VALUES (1, 'x', 1.50, NULL, 10), (2, 'old', 2.25, 'b', NULL), (7, 'moved', 9.00, 'd', 70)"])
    return a, b


def test_definitions_of_a_database(databases):
    a, _ = databases
    assert a.tables() == ["orders", "tags"] and a.exists()
    t = a.definition("orders")
    assert t.primary_key == ("id",) and t.keys == (KeyDef("orders_code", KeyKind.UNIQUE, ("code",)),)
    assert [(c.name, c.type_name, c.nullable, c.size, c.scale) for c in t.columns] == [
        ("id", "integer", False, 0, 0), ("code", "text.varchar", False, 20, 0), ("price", "decimal", True, 9, 2), ("note", "text.varchar", True, 50, 0), ("big", "integer.64bit", True, 0, 0),
    ]
    assert (t.column("note").default_kind, t.column("note").default_value) == (Default.VALUE, "none")


def test_sync_of_databases(databases, tmp_path):
    a, b = databases
    with pytest.raises(SchemaMismatch):
        sync(a, b)
    done = {r.table: r.counts() for r in sync(a, b, alter=True, snapshot=str(tmp_path / "snapshots"))}
    assert done["orders"] == {"insert": 1, "replace": 1, "delete": 1}
    assert rows(b.read("orders")) == rows(a.read("orders")) and rows(b.read("tags")) == [("p",), ("q",)]
    assert b.tables() == ["orders", "tags"] and b.definition("orders") == a.definition("orders")
    assert {r.table: r.counts() for r in sync(a, b)}["orders"] == {}


def test_schema_actions_reach_the_database(databases):
    a, b = databases
    a.execute(['ALTER TABLE "orders" ADD COLUMN "level" integer DEFAULT 5', 'CREATE INDEX "orders_big" ON "orders" ("big")'])
    b.execute(['DROP INDEX "orders_code"', 'CREATE TABLE "extra" ("x" integer)'])
    sync(a, b, alter=True, width=2)
    assert b.tables() == ["orders", "tags"] and b.definition("orders") == a.definition("orders")
    assert rows(b.read("orders")) == rows(a.read("orders"))


def test_a_database_goes_to_a_folder_and_back(databases, spark, tmp_path):
    a, b = databases
    folder = ParquetSource(spark, str(tmp_path / "folder"))
    sync(a, folder, alter=True)
    assert folder.definition("orders") == a.definition("orders")
    sync(folder, b, alter=True)
    assert rows(b.read("orders")) == rows(a.read("orders")) and b.tables() == a.tables()


def test_failed_changes_leave_a_database_as_it_was(databases, spark):
    a, b = databases
    before = rows(b.read("orders"))
    bad = spark.createDataFrame([(8, "insert", "fits", None, None, None), (9, "insert", "fits", None, None, None)], "id int, action string, code string, price decimal(9,2), note string, big long")
    with pytest.raises(Exception, match="(?i)duplicate|constraint"):
        b.apply(b.definition("orders"), bad, ["id"], ["id", "code", "price", "note", "big"])
    assert rows(b.read("orders")) == before and b.tables() == ["orders"]


# -- DDL -----------------------------------------------------------------------------------------


def test_spelling_of_definitions():
    columns = (
        ColumnDef("id", "integer.64bit", False, default_kind=Default.IDENTITY_BY_DEFAULT), ColumnDef('we"ird', "text.varchar", size=9, default_kind=Default.VALUE, default_value="it's"),
        ColumnDef("n", "decimal", size=9, scale=3, default_kind=Default.VALUE, default_value="1.5"), ColumnDef("at", "datetime", default_kind=Default.EXPRESSION, default_value="CURRENT_TIMESTAMP", auto_update=True),
        ColumnDef("twice", "integer", default_kind=Default.GENERATED_STORED, default_value="n * 2"),
    )
    t = TableDef("t", columns, ("id",), (KeyDef("k", KeyKind.UNIQUE, ("n", "at")),))
    assert ddl.create_table_sql(t, "postgresql") == [
        'CREATE TABLE "t" ("id" bigint GENERATED BY DEFAULT AS IDENTITY NOT NULL, "we""ird" character varying(9) DEFAULT \'it\'\'s\', "n" numeric(9,3) DEFAULT 1.5, '
        '"at" timestamp DEFAULT CURRENT_TIMESTAMP, "twice" integer GENERATED ALWAYS AS (n * 2) STORED, PRIMARY KEY ("id"))',
        'CREATE UNIQUE INDEX "k" ON "t" ("n", "at")',
    ]
    mysql = ddl.create_table_sql(t, "mysql")[0]
    assert "`id` bigint AUTO_INCREMENT NOT NULL" in mysql and "ON UPDATE CURRENT_TIMESTAMP" in mysql and "`we\"ird` varchar(9)" in mysql
    assert ddl.type_sql(ColumnDef("e", "enum", enum_values=("a", "b's")), "mysql") == "enum('a','b''s')"
    with pytest.raises(ValueError, match="no type"):
        ddl.type_sql(ColumnDef("x", "json"), "derby")
    one = lambda kind, value=None, dialect="postgresql", name="n": ddl.action_sql(Action(kind, "t", name, value), t, dialect)
    assert one("set_not_null") == ['ALTER TABLE "t" ALTER COLUMN "n" SET NOT NULL'] and one("set_nullable", dialect="derby") == ['ALTER TABLE "t" ALTER COLUMN "n" NULL']
    assert one("set_default") == ['ALTER TABLE "t" ALTER COLUMN "n" SET DEFAULT 1.5'] and one("set_nullable", dialect="mysql") == ["ALTER TABLE `t` MODIFY `n` decimal(9,3) DEFAULT 1.5"]
    assert one("fill_nulls", 0) == ['UPDATE "t" SET "n" = 0 WHERE "n" IS NULL'] and one("drop_key", dialect="mysql", name="k") == ["DROP INDEX `k` ON `t`"]


@pytest.mark.parametrize(
    ("text", "dialect", "extra", "expected"),
    [
        (None, "mysql", "", (Default.NONE, "")), ("NULL", "postgresql", "", (Default.NONE, "")), ("'it''s'::character varying", "postgresql", "", (Default.VALUE, "it's")),
        ("plain", "mysql", "", (Default.VALUE, "plain")), ("7", "mysql", "", (Default.VALUE, "7")), ("(-1)::smallint", "postgresql", "", (Default.VALUE, "-1")),
        ("nextval('public.\"t_id_seq\"'::regclass)", "postgresql", "", (Default.SEQUENCE, "t_id_seq")), (None, "mysql", "auto_increment", (Default.SEQUENCE, "")),
        ("now()", "postgresql", "", (Default.EXPRESSION, "CURRENT_TIMESTAMP")), ("a + 1", "mysql", "STORED GENERATED", (Default.GENERATED_STORED, "a + 1")), ("true", "postgresql", "", (Default.VALUE, "true")),
    ],
)
def test_reading_of_defaults(text, dialect, extra, expected):
    assert ddl.read_default(text, dialect, extra) == expected


def test_names_and_schemas():
    assert [ddl.unquoted(x) for x in ('public."a""b"', "plain", "`x``y`", '"s.1"."t.2"')] == ['a"b', "plain", "x`y", "t.2"]
    tables = (TableDef("t"), TableDef("u", schema="s"))
    assert ddl.missing_schemas(tables, ["public"], ["public"]) == ["s"] and ddl.missing_schemas(tables, ["s"], ["own", "public"]) == ["own"]


# -- trees ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["value", "text", "two"])
def test_trees_find_what_the_leaves_find_and_follow_changes(spark, kind, monkeypatch):
    monkeypatch.setattr(tree, "FANOUT", 4)
    rng = random.Random(kind)
    key = {"value": ["n"], "text": ["u"], "two": ["m", "n"]}[kind]
    source = [(n - 150, f"k{n * 7919 % 400:03}", n % 5, rng.choice(["x", None])) for n in range(400)]
    target = [r if rng.random() < 0.97 else (*r[:3], "old") for r in source if rng.random() < 0.97] + [(10_000 + i, f"z{i}", 1, None) for i in range(3)]
    s, t = (spark.createDataFrame(x, "n long, u string, m int, v string") for x in (source, target))
    by = blocks.key_blocks(s, key, 4)
    a, b = (tree.leaves(x, by, s.columns) for x in (s, t))
    depth = tree.depth_of(100)
    wanted = rows(tree.unlike(a, b))
    assert depth == 3 and rows(tree.descend(tree.levels(a, depth), tree.levels(b, depth), depth)) == wanted != []
    assert rows(tree.descend(tree.levels(a, depth), tree.levels(a, depth), depth)) == []
    with monkeypatch.context() as m:
        m.setattr(tree, "LITERAL_BLOCKS", 2)
        assert rows(tree.descend(tree.levels(a, depth), tree.levels(b, depth), depth)) == wanted
    changes = diff.diff(tree.with_hashes(s, s.columns), tree.with_hashes(t, s.columns), key, carry=["_a", "_b"])
    assert rows(tree.updated(b, changes, by)) == rows(a)


@pytest.fixture
def grown(spark, tmp_path):
    source, target = ParquetSource(spark, str(tmp_path / "a")), ParquetSource(spark, str(tmp_path / "b"))
    df = spark.range(3_000).select(F.format_string("k%05d", "id").alias("u"), F.col("id").alias("v"))
    source.write("t", df)
    df.withColumn("v", F.when(F.col("v") % 900 == 1, -1).otherwise(F.col("v"))).repartitionByRange(8, "u").write.parquet(f"{target.path}/t.parquet")
    tables = {"t": table_of(df, "t", ("u",))}
    assert sync(source, target, tables=tables, width=32, trees=True)[0].counts() == {"replace": 4}
    return source, target, tables, tmp_path / "b" / "t.parquet", tmp_path / "b" / "_digests" / "t"


def spoil(path):
    """Overwrite the rows of parquet files, so that who reads them fails; names, lengths, times and footers stay."""
    import os

    for f in path.glob("*.parquet"):
        held, times = bytearray(f.read_bytes()), f.stat()
        held[4 : len(held) // 4] = b"\xff" * (len(held) // 4 - 4)
        f.write_bytes(held)
        os.utime(f, ns=(times.st_atime_ns, times.st_mtime_ns))
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)


def test_an_unchanged_target_is_not_read_again(grown):
    source, target, tables, path, _ = grown
    spoil(path)
    with pytest.raises(Exception):  # noqa: B017
        rows(target.read("t"))
    assert sync(source, target, tables=tables, width=32, trees=True)[0].counts() == {}


def test_trees_follow_a_sync(grown, spark):
    source, target, tables, path, digests = grown
    kept = source.read("t").where("u <> 'k00500'").withColumn("v", F.when(F.col("u").isin("k00007", "k02999"), 0).otherwise(F.col("v")))
    source.write("t", kept.unionByName(spark.createDataFrame([("zz", 1)], "u string, v long")))
    before = (digests / "tree.json").read_text()
    assert sync(source, target, tables=tables, width=32, trees=True)[0].counts() == {"insert": 1, "replace": 2, "delete": 1}
    assert rows(target.read("t")) == rows(source.read("t")) and (digests / "tree.json").read_text() != before
    found = tree.load(spark, target.tree_path("t"), target.files("t"), ["u"], ["u", "v"])
    assert rows(found.leaf(spark)) == rows(tree.leaves(source.read("t"), found.blocks, ["u", "v"]))
    # from a folder that has a tree of the same blocks, no row is read of either side that has not changed
    third = ParquetSource(spark, target.path + "-copy")
    import shutil

    shutil.copytree(target.path, third.path)
    assert sync(target, third, tables=tables, width=32, trees=True)[0].counts() == {}
    third.drop("t")
    assert third.tables() == [] and not (tmp := path.parent.parent / "b-copy" / "_digests" / "t").exists(), tmp


@pytest.mark.parametrize("how", ["leaves", "gone", "files"])
def test_a_damaged_tree_is_built_anew(grown, spark, how):
    source, target, tables, path, digests = grown
    fits = lambda: tree.load(spark, target.tree_path("t"), target.files("t"), ["u"], ["u", "v"])
    assert fits()
    if how == "leaves":
        levels = spark.read.parquet(f"{target.tree_path('t')}/levels")
        changed = spark.createDataFrame([(*r[:2], 7 if r.block == 3 else r.a, r.b, r.level) for r in levels.select("block", "n", "a", "b", "level").collect()], levels.select("block", "n", "a", "b", "level").schema)
        changed.repartition("level").write.mode("overwrite").partitionBy("level").parquet(f"{target.tree_path('t')}/levels")
    elif how == "gone":
        for f in (digests / "levels" / "level=0").glob("part*"):
            f.unlink()
    else:  # somebody else has written to the table
        target.write("t", target.read("t").withColumn("v", F.when(F.col("u") == "k00001", -5).otherwise(F.col("v"))))
    assert fits() is None
    done = sync(source, target, tables=tables, width=32, trees=True)[0].counts()
    assert done == ({"replace": 1} if how == "files" else {}) and fits() and rows(target.read("t")) == rows(source.read("t"))
