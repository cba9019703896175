"""Catalogs as relations give what the planning of definitions gives, on any definitions."""

import random

import pytest
from pyspark.sql import functions as F

from concord.operators import catalog
from concord.operators.keys import choose_key
from concord.plans import schema_diff
from concord.plans.dialects import negotiate, supported_types
from concord.plans.model import SPARK_TYPES, ColumnDef, DatabaseDef, KeyDef, KeyKind, TableDef
from tests.test_sync import rows

COLUMNS, KEYS = "tbl string, pos int, col string, type string, nullable boolean", "tbl string, name string, kind string, cols array<string>"


def database(seed):
    rng = random.Random(seed)
    tables = []
    for name in "abcdefghij":
        if rng.random() < 0.85:
            columns = tuple(ColumnDef(c, rng.choice(["integer", "integer", "integer", "text.varchar"]), rng.random() < 0.5) for c in "uvwxyz" if rng.random() < 0.8)
            if rng.random() < 0.2:
                columns = tuple(rng.sample(columns, len(columns)))
            keys = tuple(KeyDef(k, rng.choice([KeyKind.UNIQUE, KeyKind.STANDARD]), tuple(c.name for c in rng.sample(columns, rng.randrange(1, len(columns) + 1)))) for k in "kl" if columns and rng.random() < 0.7)
            if columns:
                tables.append(TableDef(name, columns, (), keys))
    return DatabaseDef(tuple(tables))


def relations(spark, d):
    columns = [(t.name, i, c.name, c.type_name, c.nullable) for t in d.tables for i, c in enumerate(t.columns)]
    return spark.createDataFrame(columns, COLUMNS), spark.createDataFrame([(t.name, k.name, k.kind.value, list(k.columns)) for t in d.tables for k in t.keys], KEYS)


@pytest.mark.parametrize("seed", range(3))
def test_relations_and_definitions_agree(spark, seed):
    s, t = database(seed), database(seed + 100)
    (sc, sk), (tc, tk) = relations(spark, s), relations(spark, t)
    plan = schema_diff.plan_schema(s, t)
    assert rows(catalog.table_changes(sc, tc)) == sorted((a.table, a.kind.removesuffix("_table")) for a in plan if a.kind in ("create_table", "drop_table"))
    assert rows(catalog.column_changes(sc, tc)) == sorted(schema_diff.column_changes(s, t))
    both = {x.name for x in s.tables} & {x.name for x in t.tables}
    found = catalog.key_changes(sk, tk).where(F.col("tbl").isin(sorted(both)))
    assert rows(found) == sorted(schema_diff.key_changes(s, t))
    bare = lambda d: DatabaseDef(tuple(TableDef(x.name, x.columns) for x in d.tables))
    steps = [(a.table, a.kind, a.name) for a in schema_diff.plan_schema(bare(s), bare(t))]
    got = [(r.tbl, r.action, r.name) for r in catalog.plans(sc, tc).orderBy("tbl", "step").collect()]
    assert got == sorted(steps, key=lambda x: x[0])
    chosen = {r.tbl: (r.kind, r.cols) for r in catalog.chosen_keys(sc, sk).collect()}
    assert chosen == {x.name: (c.kind, ",".join(c.columns)) for x in s.tables for c in [choose_key(x)]}


def test_tables_are_planned_many_a_batch(spark):
    """A group of pandas frames for each table costs milliseconds."""
    columns = spark.range(3_000).selectExpr("'t' || id div 3 AS tbl", "CAST(id % 3 AS INT) AS pos", "'c' || id % 3 AS col", "'integer' AS type", "id % 2 = 0 AS nullable")
    keys = columns.where("NOT nullable AND pos > 0").select("tbl", F.concat(F.lit("by_"), "col").alias("name"), F.lit("unique").alias("kind"), F.array("col").alias("cols"))
    steps, chosen = catalog.plans(columns, columns.where("col <> 'c2'")), catalog.chosen_keys(columns, keys)
    for found in (steps, chosen):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "InPandas" not in plan and "CoGroup" not in plan
    assert steps.groupBy("action", "name").count().collect() == [("add_column", "c2", 1_000)]
    assert {(r.kind, r.cols): r["count"] for r in chosen.groupBy("kind", "cols").count().collect()} == {("unique", "c1"): 500, ("unique", "c2"): 500}
    assert catalog.plans(columns.limit(0), columns.limit(0)).count() == 0


def test_names_are_numbered_in_linear_work():
    class Counted(str):
        tries = 0

        def __getitem__(self, at):
            Counted.tries += 1
            return str(self)[at]

    assert schema_diff.dedupe_names([Counted("a")] * 300, 63)[-1] == "a_300" and Counted.tries < 300 * 5


def plainly(names, limit):
    seen, out = set(), []
    for name in names:
        new, n = name[:limit], 1
        while new in seen:
            n += 1
            new = name[: limit - len(f"_{n}")] + f"_{n}"
        seen.add(new)
        out.append(new)
    return out


@pytest.mark.parametrize("limit", [6, 14, 63])
def test_names_that_meet_numbered_ones(spark, limit):
    rng = random.Random(limit)
    some = ["a", "a_2", "a_2_3", "a_", "a_1", "b", "b2", "ü" * 13, "ü" * 12 + "_2", "ü" * 62 + "x", "ü" * 62 + "y", "ü" * 61, "c_9_x", "d" * 70, "d" * 69, "only"]
    given = [(db, f"t{i:03d}", name) for db in range(4) for i in range(40) for name in rng.sample(some[: 16 - 3 * db], 6)]
    found = catalog.unique_names(spark.createDataFrame(given, "db long, tbl string, name string"), limit)
    want = [(db, t, n, new) for db in range(4) for own in [sorted(x for x in given if x[0] == db)] for (_, t, n), new in zip(own, plainly([x[2] for x in own], limit))]
    assert rows(found.select("db", "tbl", "name", "new")) == sorted(want)
    assert "FlatMapGroups" not in found._jdf.queryExecution().executedPlan().toString()


def test_names_types_and_lists(spark):
    names = spark.createDataFrame([(1, f"t{i}", "x" * 70) for i in range(4)] + [(2, "t0", "x" * 70), (1, "u", "y")], "db long, tbl string, name string")
    got = {(r.db, r.tbl): r.new for r in catalog.unique_names(names, 63).collect()}
    assert len({n for (db, _), n in got.items() if db == 1}) == 5 and max(map(len, got.values())) == 63 and got[2, "t0"] == "x" * 63 and got[1, "t1"] == "x" * 61 + "_2"
    types = spark.createDataFrame([(t,) for t in [*SPARK_TYPES, "new", None]], "t string")
    for dialect in ("mysql", "postgresql", "derby"):
        told = {r.t: r.n for r in types.select("t", catalog.negotiated(F.col("t"), dialect).alias("n")).collect()}
        assert told == {**{t: negotiate(t, supported_types(dialect), dialect) for t in SPARK_TYPES}, "new": "unknown", None: "unknown"}
    listed = spark.createDataFrame([("a",), ("b",), ("c",)], "tbl string")
    assert rows(catalog.restrict_rows(listed, ["a", "b"], ["b"])) == [("a",)] and rows(catalog.restrict_rows(listed, (), ["b"])) == [("a",), ("c",)] and catalog.restrict_rows(listed).count() == 3
