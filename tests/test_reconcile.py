"""The reconciliation operators on small tables."""

import pytest
from pyspark.sql import functions as F

from concord.operators import apply, diff, filters, keys, ranges
from concord.plans.model import ColumnDef, DatabaseDef, KeyDef, KeyKind, TableDef, table_of
from concord.plans.sync import SchemaMismatch, sync, sync_table
from concord.sources.tables import ParquetSource

FOO = [(2, 10, "test"), (4, None, "foo"), (5, None, None), (8, -1, "longer str"), (301, 0, None), (302, 0, None), (555, 0, None), (1000, 0, None), (1001, 0, "last")]
SCHEMA = "col1 int, another_col smallint, col3 string"


@pytest.fixture
def foo(spark):
    return spark.createDataFrame(FOO, SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


def changes(spark, source, target):
    s, t = (spark.createDataFrame(x, SCHEMA) for x in (source, target))
    return sync_table(s, t, table_of(s, "footbl", ("col1",)))


def same(result, source):
    return rows(result.state) == sorted((tuple(r) for r in source), key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize(
    ("target", "counts"),
    [
        (FOO, {}),
        ([], {"insert": 9}),
        (FOO[:-1], {"insert": 1}),
        (FOO[1:], {"insert": 1}),
        ([*FOO, (5000, 1, "x")], {"delete": 1}),
        ([(1, 1, "x"), *FOO], {"delete": 1}),
        ([(2, 10, "other"), *FOO[1:]], {"replace": 1}),
        ([*FOO[:2], (5, None, ""), *FOO[3:]], {"replace": 1}),
        ([(9, 9, "z")], {"insert": 9, "delete": 1}),
    ],
)
def test_row_diff(spark, target, counts):
    r = changes(spark, FOO, target)
    assert r.counts() == counts
    assert same(r, FOO)


def test_empty_source_clears(spark):
    r = changes(spark, [], FOO)
    assert r.counts() == {"delete": 9}
    assert same(r, [])


def test_unique_value_moves_in_one_step(spark):
    source, target = [(1, 10, "kept"), (3, 30, "irrelevant"), (4, 20, "replacer")], [(1, 10, "kept"), (2, 20, "replaced")]
    assert same(changes(spark, source, target), source)
    s, t = (spark.createDataFrame(x, SCHEMA) for x in (source, target))
    assert rows(diff.unique_conflicts(s, t, ["col1"], [["another_col"]])) == [(2, 20, "replaced")]


def test_null_in_unique_key_conflicts_with_nothing(spark):
    s, t = spark.createDataFrame([(1, None, "a")], SCHEMA), spark.createDataFrame([(2, None, "b")], SCHEMA)
    assert rows(diff.unique_conflicts(s, t, ["col1"], [["another_col"]])) == []


def test_all_bytes_and_long_values(spark):
    source = [(1, bytes(range(256))), (2, bytes(reversed(range(256)))), (3, b"x" * 500_000), (4, None)]
    s, t = spark.createDataFrame(source, "id int, b binary"), spark.createDataFrame(source[1:3], "id int, b binary")
    r = sync_table(s, t, table_of(s, "t", ("id",)))
    assert r.counts() == {"insert": 2}


def test_composite_key_range(spark):
    df = spark.createDataFrame([(2, 2349174, "xy", 1), (9, 968116383, "aa", 9), (100, 100, "aa", 100), (340, 363401169, "ab", 20)], "tri long, pri1 int, pri2 string, sec int")
    t = table_of(df, "secondtbl", ("pri2", "pri1"))
    assert [r.tri for r in ranges.range_rows(df, t).collect()] == [100, 9, 340, 2]
    assert [r.tri for r in ranges.range_rows(df, t, ["aa", 100], ["ab", 363401169]).collect()] == [9, 340]
    assert [r.tri for r in ranges.range_rows(df, t, ["aa", 101], None, limit=1).collect()] == [9]


def test_range_predicates_reach_the_scan(spark, tmp_path):
    spark.range(1000).select((F.col("id") % 7).alias("a"), "id").write.parquet(str(tmp_path / "x"))
    df = spark.read.parquet(str(tmp_path / "x")).where(ranges.key_range(["a", "id"], [1, 5], [3, 9]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(a,1)" in plan and "Or(GreaterThan(a,1)" in plan


def test_midpoints():
    assert ranges.midpoint(0, 9) == 4
    low, high = "00000000-0000-0000-0000-000000000000", "ffffffff-ffff-ffff-ffff-ffffffffffff"
    assert ranges.midpoint(low, high) == "7fffffff-ffff-ffff-ffff-ffffffffffff"


def test_multisets(spark):
    source = spark.createDataFrame([(1, 100), (3, 10), (3, 10), (2, None)], "a int, b int")
    target = spark.createDataFrame([(1, 100), (3, 10), (3, 10), (3, 10), (9, 9)], "a int, b int")
    got = diff.multiset_diff(source, target, ["a", "b"])
    assert rows(got) == [(2, None, "insert", 1, 0), (3, 10, "replace", 2, 3), (9, 9, "delete", 0, 1)]
    assert rows(apply.apply_multiset(target, got, ["a", "b"])) == rows(source)


@pytest.mark.parametrize("every", [1, 7, 50])
def test_pruned_diff_equals_full_diff(spark, every):
    s = spark.range(500).select("id", (F.col("id") * 3).alias("v"))
    t = s.where(F.col("id") % every != 0).unionByName(s.where(F.col("id") % (2 * every) == 0).withColumn("v", F.col("v") + 1))
    assert rows(diff.pruned_diff(s, t, "id", ["id", "v"], 16)) == rows(diff.diff(s, t, ["id"]))
    assert rows(diff.pruned_diff(s, s, "id", ["id", "v"], 16)) == []
    assert rows(diff.block_refine(s, t, "id", ["id", "v"], 64, 16)) == rows(diff.block_compare(s, t, "id", ["id", "v"], 16))


def no_primary(keys_=()):
    columns = (ColumnDef("nullable", "integer"), ColumnDef("version", "text.varchar", False), ColumnDef("name", "text.varchar", False), ColumnDef("non_nullable", "integer", False))
    return TableDef("noprimarytbl", columns, (), keys_)


def test_key_choice():
    u = lambda n, *c: KeyDef(n, KeyKind.UNIQUE, c)
    every = (u("correct_key", "version"), u("everything_key", "name", "nullable"), u("ignored_key", "nullable"), u("non_nullable_key", "non_nullable"))
    assert keys.choose_key(no_primary(every)).columns == ("version",)
    assert keys.choose_key(no_primary(every), {"version"}).columns == ("non_nullable",)
    assert keys.choose_key(no_primary((u("ignored_key", "nullable"),))).kind == "none"
    joint = TableDef("j", (ColumnDef("a", "integer", False), ColumnDef("b", "integer", False)), (), (KeyDef("i", KeyKind.STANDARD, ("b", "a")),))
    assert keys.choose_key(joint) == keys.KeyChoice("whole_row", ("b", "a"))
    assert keys.choose_key(joint, {"a"}).kind == "none"


def test_filters(spark):
    df = spark.createDataFrame([(2, 10, "test"), (4, None, "foo"), (5, None, None), (8, -1, "longerstr")], SCHEMA)
    f = filters.parse_filters({"footbl": {"replace": {"another_col": "col1 + char_length(col3)", "col3": "coalesce(col3 || 'x', 'default')"}}})["footbl"]
    assert rows(filters.apply_filter(df, f)) == [(2, 6, "testx"), (4, 7, "foox"), (5, None, "default"), (8, 17, "longerstrx")]
    both = filters.TableFilter("another_col IS NULL", {"another_col": "7"})
    assert rows(filters.apply_filter(df, both)) == [(4, 7, "foo"), (5, 7, None)]
    table = table_of(df, "footbl", ("col1",))
    for bad in ({"x": "clear"}, {"footbl": {"replace": {"nope": "1"}}}, {"footbl": {"replace": {"col1": "1"}}}):
        with pytest.raises(filters.FilterDefinitionError):
            filters.validate(filters.parse_filters(bad), {"footbl": table})
    with pytest.raises(filters.FilterDefinitionError):
        filters.parse_filters({"footbl": {"shuffle": 1}})
    assert filters.parse_filters({"t": {"replace": {"a": True, "b": None}}})["t"].replace == {"a": "true", "b": None}


def test_filtered_rows_leave_the_target(spark, foo):
    r = sync_table(foo, foo, table_of(foo, "footbl", ("col1",)), filter=filters.TableFilter("col1 < 300"))
    assert r.counts() == {"delete": 5}


def test_sync_of_folders(spark, tmp_path, foo):
    source, target = ParquetSource(spark, str(tmp_path / "a")), ParquetSource(spark, str(tmp_path / "b"))
    foo.write.parquet(str(tmp_path / "a/footbl.parquet"))
    spark.range(3).write.parquet(str(tmp_path / "a/ids.parquet"))
    foo.where("col1 > 4").write.parquet(str(tmp_path / "b/footbl.parquet"))
    tables = {"footbl": table_of(foo, "footbl", ("col1",))}
    with pytest.raises(SchemaMismatch):
        sync(source, target, tables=tables)
    for commit in ("success", "often"):
        sync(source, target, tables=tables, alter=True, commit=commit)
        assert rows(diff.verify(source.read("footbl"), target.read("footbl"))) == [(0, 0)]
        assert target.read("ids").count() == 3
    assert [r.counts() for r in sync(source, target, tables=tables, commit="never") if r.table == "footbl"] == [{}]
    assert sync(source, target, tables=tables, only="ids", commit="never")[0].table == "ids"


def test_definitions_survive_json():
    d = DatabaseDef((no_primary((KeyDef("k", KeyKind.UNIQUE, ("version",)),)),), ("an error",))
    assert DatabaseDef.from_json(d.to_json()) == d
    assert DatabaseDef.from_json('{"tables": [{"name": "t", "later": 1}], "later": 2}').tables[0].name == "t"


def test_staged_write_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    apply.write_staged(spark.range(3), path)
    apply.write_staged(spark.read.parquet(path).where("id > 0"), path)
    assert spark.read.parquet(path).count() == 2


def test_verify_key_counts_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "a int")
    assert rows(keys.verify_key(df, ["a"])) == [(4, 2, 1, False)]
    assert rows(keys.duplicate_keys(df, ["a"])) == [(1, 2)]


def test_generated_columns_are_left_out(spark):
    from concord.plans.model import Default

    df = spark.createDataFrame([(1, 10, 22, 100)], "pri int, fore int, stor int, back int")
    table = TableDef("g", (ColumnDef("pri", "integer", False), ColumnDef("fore", "integer"), ColumnDef("stor", "integer", default_kind=Default.GENERATED_STORED), ColumnDef("back", "integer")), ("pri",))
    assert sync_table(df, df.limit(0), table).state.columns == ["pri", "fore", "back"]


def test_sync_drops_tables_that_only_the_target_has(spark, tmp_path):
    source, target = ParquetSource(spark, str(tmp_path / "a")), ParquetSource(spark, str(tmp_path / "b"))
    spark.range(3).write.parquet(str(tmp_path / "a/ids.parquet"))
    for commit in ("often", "success"):
        for name in ("ids", "old", "other"):
            target.write(name, spark.range(5))
        with pytest.raises(SchemaMismatch):
            sync(source, target, commit=commit)
        with pytest.raises(ValueError):
            sync(ParquetSource(spark, str(tmp_path / "none")), target, alter=True, commit=commit)
        done = sync(source, target, alter=True, commit="never", ignore="other")
        assert [(r.table, [a.kind for a in r.schema_actions]) for r in done] == [("ids", []), ("old", ["drop_table"])]
        assert sorted(target.tables()) == ["ids", "old", "other"]
        sync(source, target, alter=True, commit=commit, ignore="other")
        assert sorted(target.tables()) == ["ids", "other"] and target.read("ids").count() == 3
        sync(source, target, alter=True, commit=commit)
        assert target.tables() == ["ids"] and not list(tmp_path.glob("b/.dropped*"))


def test_ranges_join_across_spans(spark):
    runs = [(5, 7), (999, 1000), (1500, 1999), (2000, 2000), (2999, 5000), (7000, 7999), (9001, 9001), (999_990, 1_000_010), (-3, 2), (10**12 - 1, 10**12)]
    df = spark.createDataFrame([(b,) for lo, hi in runs for b in range(lo, hi + 1)], "block long")
    want = sorted([(lo, hi, hi - lo + 1) for lo, hi in runs if lo not in (1500, 2000)] + [(1500, 2000, 501)])
    assert sorted(map(tuple, diff.coalesce_ranges(df, span=1_000).collect())) == want
    assert sorted(map(tuple, diff.coalesce_ranges(df).collect())) == want
