"""Catalogs as relations: definitions of any number of tables, compared and planned by table.

Columns are rows (tbl, pos, col, type, nullable), keys are rows (tbl, name, kind, cols).  Lists are compared by joins; what needs a whole
definition is planned per table, many tables a batch, in the task that has their rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from concord.operators.keys import choose_key
from concord.plans.dialects import negotiate, supported_types
from concord.plans.model import SPARK_TYPES, ColumnDef, KeyDef, KeyKind, TableDef
from concord.plans.schema_diff import Action, UniqueNames, plan_table


def restrict_rows(rows: DataFrame, only: Sequence[str] = (), ignore: Sequence[str] = ()) -> DataFrame:
    """Rows of the tables of `only`, or of all, without those of `ignore`."""
    rows = rows.where(F.col("tbl").isin(list(only))) if only else rows
    return rows.where(~F.col("tbl").isin(list(ignore))) if ignore else rows


def change(there: Column, here: Column, same: Column, words: tuple[str, str, str]) -> Column:
    """What it is called that only the source has something, only the target, or both another."""
    return F.when(here.isNull(), words[0]).when(there.isNull(), words[1]).when(~same, words[2])


def table_changes(source: DataFrame, target: DataFrame) -> DataFrame:
    """(tbl, action): create or drop."""
    s, t = source.select("tbl").distinct().withColumn("_s", F.lit(1)), target.select("tbl").distinct().withColumn("_t", F.lit(1))
    found = s.join(t, "tbl", "full_outer")
    return found.select("tbl", change(F.col("_s"), F.col("_t"), F.lit(True), ("create", "drop", "")).alias("action")).where("action is not null")


def in_both(source: DataFrame, target: DataFrame) -> DataFrame:
    return source.select("tbl").distinct().join(target.select("tbl").distinct(), "tbl")


def column_changes(source: DataFrame, target: DataFrame) -> DataFrame:
    """(tbl, col, action): add, drop or change, in tables of both; columns match by place and name, as altering goes by both."""
    own = lambda df, side: df.select("tbl", "pos", "col", F.struct("type", "nullable").alias(side))
    found = own(source, "_s").join(own(target, "_t"), ["tbl", "pos", "col"], "full_outer").join(in_both(source, target), "tbl", "left_semi")
    return found.select("tbl", "col", change(F.col("_s"), F.col("_t"), F.col("_s") == F.col("_t"), ("add", "drop", "change")).alias("action")).where("action is not null")


def key_changes(source: DataFrame, target: DataFrame) -> DataFrame:
    """(tbl, name, action): create, drop or change, in tables of both; keys match by name."""
    own = lambda df, side: df.select("tbl", "name", F.struct("kind", "cols").alias(side))
    found = own(source, "_s").join(own(target, "_t"), ["tbl", "name"], "full_outer")
    return found.select("tbl", "name", change(F.col("_s"), F.col("_t"), F.col("_s") == F.col("_t"), ("create", "drop", "change")).alias("action")).where("action is not null")


def whole(rows: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """A row for each table, its rows an array in the order of `columns`."""
    return rows.groupBy("tbl").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(name))


def definition(table: str, columns: list[dict] | None, keys: list[dict] | None = None) -> TableDef | None:
    """The definition that a table's rows tell; None without any."""
    if not columns:
        return None
    named = tuple(KeyDef(k["name"], KeyKind(k["kind"]), tuple(k["cols"])) for k in keys or ())
    return TableDef(table, tuple(ColumnDef(c["col"], c["type"], c["nullable"]) for c in columns), (), named)


def told(tables: DataFrame, tell: Callable[..., Iterable[tuple]], schema: str) -> DataFrame:
    """The rows that tell(*row) gives for each row, a batch of tables at a time."""
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for row in zip(*(c.to_pylist() for c in batch.columns)) for x in tell(*row)]
            columns = zip(*found) if found else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)

    return tables.mapInArrow(run, schema)


COLUMN = ("pos", "col", "type", "nullable")


def plans(source: DataFrame, target: DataFrame) -> DataFrame:
    """(tbl, step, action, name): what makes each table of the target one of the source, in order."""

    def plan(tbl: str, s: list[dict] | None, t: list[dict] | None) -> Iterable[tuple]:
        want, have = definition(tbl, s), definition(tbl, t)
        steps = plan_table(want, have) if want and have else [Action("create_table", want.id)] if want else [Action("drop_table", have.id)]
        return [(a.table, i, a.kind, a.name) for i, a in enumerate(steps)]

    both = whole(source, COLUMN, "s").join(whole(target, COLUMN, "t"), "tbl", "full_outer")
    return told(both.select("tbl", "s", "t"), plan, "tbl string, step int, action string, name string")


def chosen_keys(columns: DataFrame, keys: DataFrame) -> DataFrame:
    """(tbl, kind, cols): the key that each table's rows are told apart by."""

    def choose(tbl: str, c: list[dict], k: list[dict] | None) -> Iterable[tuple]:
        found = choose_key(definition(tbl, c, k))
        return [(tbl, found.kind, ",".join(found.columns))]

    held = whole(columns, COLUMN, "c").join(whole(keys, ("name", "kind", "cols"), "k"), "tbl", "left")
    return told(held.select("tbl", "c", "k"), choose, "tbl string, kind string, cols string")


def name_family(name: Column, limit: int) -> Column:
    """What names share that could ever be given the same numbered name: a beginning that numbers leave whole, without the numbers at its end."""
    return F.regexp_replace(F.substring(name, 1, max(limit - 11, 0)), r"(_[0-9]*)+$", "")


def unique_names(names: DataFrame, limit: int) -> DataFrame:
    """(db, tbl, name, new): index names that are cut to `limit` characters and differ within a database, in the order of tables and names.

    Families of one name are numbered by a window.  Where several names could meet, such as a and a_2, rows go through the task in
    order, and only what has been given out in a family is held.
    """
    held = names.select("db", "tbl", "name", F.substring("name", 1, limit).alias("_cut"), name_family(F.col("name"), limit).alias("_family"))
    family = W.partitionBy("db", "_family")
    held = held.withColumns({"_n": F.row_number().over(family.orderBy("tbl", "name")), "_alone": F.min("_cut").over(family).eqNullSafe(F.max("_cut").over(family))})
    number = F.concat(F.lit("_"), F.col("_n").cast("string"))
    new = F.when(F.col("_n") == 1, F.col("_cut")).otherwise(F.concat(F.col("_cut").substr(F.lit(1), F.lit(limit) - F.length(number)), number))
    alone = held.where("_alone").select("db", "tbl", "name", new.alias("new"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, given = None, UniqueNames(limit)
        for batch in batches:
            out = []
            for db, family, name in zip(*(batch.column(c).to_pylist() for c in ("db", "_family", "name"))):
                if (db, family) != at:
                    at, given = (db, family), UniqueNames(limit)
                out.append(given.add(name))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("db", "tbl", "name")), pa.array(out, pa.string())], ["db", "tbl", "name", "new"])

    others = held.where("NOT _alone").select("db", "_family", "tbl", "name").repartition("db", "_family").sortWithinPartitions("db", "_family", "tbl", "name")
    return alone.unionAll(others.mapInArrow(run, alone.schema))


def negotiated(type_name: Column, dialect: str) -> Column:
    """The type that a dialect takes for a portable one."""
    accepted = supported_types(dialect)
    known = F.create_map(*[F.lit(x) for t in SPARK_TYPES for x in (t, negotiate(t, accepted, dialect))])
    return F.coalesce(F.get(F.array(known[type_name]), F.lit(0)), F.lit("unknown"))
