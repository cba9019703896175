"""Schema planning, dialects, URLs and scalar helpers."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from concord.functions import scalars, spatial
from concord.plans.dialects import adapt_schema, negotiate, parse_mysql, parse_postgresql, supported_types
from concord.plans.model import ColumnDef, DatabaseDef, Default, KeyDef, KeyKind, TableDef
from concord.plans.schema_diff import dedupe_names, plan_schema, plan_table, safe_default
from concord.sources.urls import parse_db_url, url_decode

A, B, C = ColumnDef("a", "integer", False), ColumnDef("b", "text"), ColumnDef("c", "integer")
KEY = KeyDef("idx", KeyKind.STANDARD, ("b",))
BASE = TableDef("t", (A, B, C), ("a",), (KEY,))


def plan(source, target):
    return [(x.kind, x.name) for x in plan_table(source, target)]


@pytest.mark.parametrize(
    ("source", "target", "expected"),
    [
        (BASE, BASE, []),
        (BASE, replace(BASE, columns=(A, B)), [("add_column", "c")]),
        (replace(BASE, columns=(A, B)), BASE, [("drop_column", "c")]),
        (replace(BASE, columns=(A, C), keys=()), BASE, [("drop_key", "idx"), ("drop_column", "b")]),
        (BASE, replace(BASE, columns=(B, A, C)), [("recreate_table", "")]),
        (BASE, replace(BASE, columns=(A, replace(B, type_name="integer"), C)), [("recreate_table", "")]),
        (BASE, replace(BASE, columns=(A, B, replace(C, nullable=False))), [("set_nullable", "c")]),
        (replace(BASE, columns=(A, B, replace(C, nullable=False))), BASE, [("fill_nulls", "c"), ("set_not_null", "c")]),
        (replace(BASE, columns=(A, replace(B, nullable=False), C)), BASE, [("recreate_table", "")]),
        (replace(BASE, columns=(A, B, replace(C, default_kind=Default.VALUE, default_value="3"))), BASE, [("set_default", "c")]),
        (replace(BASE, primary_key=("c",)), BASE, [("recreate_table", "")]),
        (replace(BASE, keys=()), BASE, [("drop_key", "idx")]),
        (replace(BASE, keys=(KEY, KeyDef("new", KeyKind.UNIQUE, ("c",)))), replace(BASE, keys=(KEY, KeyDef("old", KeyKind.STANDARD, ("c",)))), [("create_key", "new"), ("drop_key", "old")]),
        (replace(BASE, keys=(replace(KEY, kind=KeyKind.UNIQUE),)), BASE, [("drop_key", "idx"), ("create_key", "idx")]),
        (replace(BASE, columns=(A, B, C, ColumnDef("d", "integer", False)), keys=(KEY, KeyDef("dk", KeyKind.STANDARD, ("d",)))), BASE, [("recreate_table", "")]),
        (replace(BASE, columns=(B, C), primary_key=("b",)), BASE, [("recreate_table", "")]),
    ],
)
def test_plans(source, target, expected):
    assert plan(source, target) == expected


def test_table_sets():
    x = replace(BASE, name="x")
    assert [(a.kind, a.table) for a in plan_schema(DatabaseDef((BASE,)), DatabaseDef((x,)))] == [("drop_table", "x"), ("create_table", "t")]
    assert [(a.kind, a.table) for a in plan_schema(DatabaseDef((replace(BASE, schema="s.1"),)), DatabaseDef((BASE,)))] == [("drop_table", "t"), ("create_table", "s\\.1.t")]


def test_safe_defaults():
    assert safe_default(ColumnDef("x", "enum", enum_values=("red", "green"))) == "red"
    assert safe_default(ColumnDef("x", "integer.64bit")) == 0
    with pytest.raises(ValueError, match="no default"):
        safe_default(ColumnDef("x", "spatial"))


def test_dialects():
    assert parse_mysql("x", "tinyint(1)").type_name == "boolean"
    assert parse_mysql("x", "bigint(20) unsigned").type_name == "integer.unsigned.64bit"
    assert parse_mysql("x", "decimal(9,3)") == ColumnDef("x", "decimal", size=9, scale=3)
    assert parse_mysql("x", "enum('a','it''s')").enum_values == ("a", "it's")
    assert parse_mysql("x", "mediumtext").size == 16777215
    assert parse_postgresql("x", "character varying(10)") == ColumnDef("x", "text.varchar", size=10)
    assert parse_postgresql("x", "timestamp(4) with time zone") == ColumnDef("x", "datetime.tz", size=4)
    assert parse_postgresql("x", "geometry(Point,4326)") == ColumnDef("x", "spatial", subtype="point", srid=4326)
    assert parse_postgresql("x", "geography").srid == 4326
    assert parse_postgresql("x", "tsvector").type_name == "postgresql_specific"
    assert negotiate("json.binary", supported_types("mysql"), "mysql") == "json"
    assert negotiate("postgresql_specific", supported_types("mysql"), "mysql") == "unknown"
    d = DatabaseDef((TableDef("t", (ColumnDef("n", "decimal"), ColumnDef("v", "text.varchar")), keys=(KeyDef("x" * 70), KeyDef("x" * 65))),))
    mysql = adapt_schema(d, "mysql").tables[0]
    assert mysql.columns == (ColumnDef("n", "decimal", size=10), ColumnDef("v", "text"))
    assert [len(k.name) for k in mysql.keys] == [64, 64] and mysql.keys[0] != mysql.keys[1]
    with pytest.raises(ValueError, match="two schemas"):
        adapt_schema(DatabaseDef((BASE, replace(BASE, schema="other"))), "mysql")
    assert adapt_schema(DatabaseDef((TableDef("t", (ColumnDef("u", "integer.unsigned"),)),)), "postgresql").tables[0].columns[0].type_name == "integer"


def test_names():
    assert dedupe_names(["a", "a", "b", "a"], 63) == ["a", "a_2", "b", "a_3"]


def test_urls():
    u = parse_db_url("mysql://someuser:mypassword@my.database.host:123/mydb/sch")
    assert (u.user, u.password, u.host, u.port, u.database, u.schema) == ("someuser", "mypassword", "my.database.host", "123", "mydb", "sch")
    assert parse_db_url("postgres:///db").protocol == "postgresql"
    assert parse_db_url("mysql://u%40x:p%3a@h/d").user == "u@x"
    assert parse_db_url("postgresql://[::1]:5/db").jdbc == "jdbc:postgresql://[::1]:5/db"
    assert url_decode("100%zz%4") == "100%zz%4"
    with pytest.raises(ValueError, match="expected"):
        parse_db_url("nonsense")


def test_scalars(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(scalars.trim_fractional_zeros(F.lit("04:05:06.500"))) == "04:05:06.5"
    assert one(scalars.trim_fractional_zeros(F.lit("04:05:00"))) == "04:05:00"
    assert one(scalars.quote_identifier(F.lit('a"b'))) == '"a""b"'
    assert one(scalars.parse_enum_list(F.lit("enum('red','with''quote')"))) == ["red", "with'quote"]
    assert one(scalars.decode_boolean(F.lit("2"))) is None
    point = bytes.fromhex("010100000000000000000024400000000000003440")
    with_srid = bytes.fromhex("0101000020E610000000000000000024400000000000003440")
    prefixed = bytes.fromhex("E6100000") + point
    assert one(spatial.from_ewkb(F.lit(with_srid))) == prefixed
    assert one(spatial.to_ewkb(F.lit(prefixed))) == with_srid
    assert one(spatial.to_ewkb(spatial.from_ewkb(F.lit(point)))) == point
    assert one(spatial.to_ewkb(F.lit(b"\0"))) == b"\0"


def test_streaming_refresh(spark, tmp_path):
    from concord.streaming.refresh import refresh

    path, feed = str(tmp_path / "target"), str(tmp_path / "feed")
    spark.createDataFrame([(1, "old", 1), (2, "kept", 1)], "id int, v string, at int").write.parquet(path)
    spark.createDataFrame([(1, "newer", 2), (1, "newest", 3), (3, "added", 2)], "id int, v string, at int").write.parquet(feed)
    stream = spark.readStream.schema("id int, v string, at int").parquet(feed)
    refresh(stream, path, ["id"], "at", str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.id, r.v) for r in spark.read.parquet(path).collect()) == [(1, "newest"), (2, "kept"), (3, "added")]
