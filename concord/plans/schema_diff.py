"""What must change in a target's schema: typed actions, planned on the driver from definitions."""

from __future__ import annotations

from dataclasses import dataclass, replace

from concord.plans.model import ColumnDef, DatabaseDef, TableDef


@dataclass(frozen=True)
class Action:
    """kind: create_table, drop_table, recreate_table, add_column, drop_column, set_nullable, fill_nulls, set_not_null,
    set_default, create_key, drop_key.  name: of the column or key."""

    kind: str
    table: str
    name: str = ""
    value: object = None


#: What NULLs become when a column turns NOT NULL, by portable type; enums take their first value.
SAFE_DEFAULTS = {
    "binary": b"",
    "text": "",
    "json": "",
    "uuid": "00000000-0000-0000-0000-000000000000",
    "date": "2000-01-01",
    "time": "00:00:00",
    "datetime": "2000-01-01 00:00:00",
    "boolean": False,
    "integer": 0,
    "float": 0,
    "decimal": 0,
}


def safe_default(column: ColumnDef) -> object:
    if column.type_name == "enum":
        return column.enum_values[0] if column.enum_values else ""
    family = column.type_name.split(".")[0]
    if family not in SAFE_DEFAULTS:
        raise ValueError(f"no default for {column.type_name} column {column.name}")
    return SAFE_DEFAULTS[family]


def plan_schema(source: DatabaseDef, target: DatabaseDef) -> list[Action]:
    """Tables by (schema, name): drop what is extra, create what is missing, alter or recreate the others."""
    have, want = ({(t.schema, t.name): t for t in d.tables} for d in (target, source))
    out = [Action("drop_table", have[k].id) for k in sorted(have.keys() - want.keys())]
    for k in sorted(want):
        out += plan_table(want[k], have[k]) if k in have else [Action("create_table", want[k].id, value=want[k])]
    return out


def plan_table(source: TableDef, target: TableDef) -> list[Action]:
    """Altering actions if they lead to the source's definition, else one to recreate the table."""
    if source == target:
        return []
    try:
        actions, result = alter(source, target)
    except Unalterable:
        return [Action("recreate_table", source.id, value=source)]
    same = result.columns == source.columns and result.primary_key == source.primary_key and set(result.keys) == set(source.keys)
    return actions if same else [Action("recreate_table", source.id, value=source)]


class Unalterable(Exception):
    pass


def alter(source: TableDef, target: TableDef) -> tuple[list[Action], TableDef]:
    """The actions, and the target's definition after them."""
    out: list[Action] = []
    columns, keys, at = list(target.columns), list(target.keys), 0
    wanted = {c.name for c in source.columns}
    in_key = lambda name: any(name in k.columns for k in keys) or name in target.primary_key
    while at < len(columns):
        have = columns[at]
        if have.name not in wanted:
            if have.name in target.primary_key:
                raise Unalterable
            for k in [k for k in keys if have.name in k.columns]:
                keys.remove(k)
                out.append(Action("drop_key", source.id, k.name))
            del columns[at]
            out.append(Action("drop_column", source.id, have.name))
            continue
        if at >= len(source.columns) or source.columns[at].name != have.name:
            raise Unalterable  # columns in another order
        want = source.columns[at]
        if want != have:
            if want.nullable != have.nullable:
                if want.nullable:
                    out.append(Action("set_nullable", source.id, want.name))
                elif in_key(want.name):
                    raise Unalterable
                else:
                    out += [Action("fill_nulls", source.id, want.name, safe_default(want)), Action("set_not_null", source.id, want.name)]
            if (want.default_kind, want.default_value) != (have.default_kind, have.default_value) and not (want.generated or have.generated):
                out.append(Action("set_default", source.id, want.name, want.default_value))
                have = replace(have, default_kind=want.default_kind, default_value=want.default_value)
            columns[at] = replace(have, nullable=want.nullable)
        at += 1
    for want in source.columns[len(columns):]:
        used = any(want.name in k.columns for k in source.keys) or want.name in source.primary_key
        if not want.nullable and used:
            raise Unalterable
        out.append(Action("add_column", source.id, want.name, None if want.nullable else safe_default(want)))
        columns.append(want)
    have_keys, want_keys = {k.name: k for k in keys}, {k.name: k for k in source.keys}
    changed = {n for n in want_keys.keys() & have_keys.keys() if want_keys[n] != have_keys[n]}
    # new keys before old ones go, so that constraints which need one always have it; a changed key has to go first
    out += [Action("drop_key", source.id, n) for n in sorted(changed)]
    out += [Action("create_key", source.id, n, want_keys[n]) for n in sorted((want_keys.keys() - have_keys.keys()) | changed)]
    out += [Action("drop_key", source.id, n) for n in sorted(have_keys.keys() - want_keys.keys())]
    return out, replace(target, columns=tuple(columns), keys=tuple(want_keys.values()))


def apply_to_frame(df, table: TableDef, actions: list[Action]):
    """A target DataFrame after the column actions of a plan."""
    from pyspark.sql import functions as F

    for a in actions:
        if a.kind == "drop_column":
            df = df.drop(a.name)
        elif a.kind == "add_column":
            df = df.withColumn(a.name, F.lit(a.value).cast(table.column(a.name).spark_type))
        elif a.kind == "fill_nulls":
            df = df.withColumn(a.name, F.coalesce(F.col(a.name), F.lit(a.value).cast(df.schema[a.name].dataType)))
        elif a.kind in ("create_table", "recreate_table"):
            from pyspark.sql.types import StructField, StructType

            df = df.sparkSession.createDataFrame([], StructType([StructField(c.name, c.spark_type) for c in table.columns]))
    return df


class UniqueNames:
    """Names cut to `limit` characters, given one by one; later equal ones are numbered _2, _3, ... within the limit.  A number that was found
    taken is never tried again."""

    def __init__(self, limit: int):
        self.limit, self.seen, self.free = limit, set(), {}

    def add(self, name: str) -> str:
        new, digits = name[: self.limit], 0
        while new in self.seen:
            digits += 1
            stem = name[: self.limit - 1 - digits]
            n = self.free.get((stem, digits), max(2, 10 ** (digits - 1)))
            while n < 10**digits and f"{stem}_{n}" in self.seen:
                n += 1
            self.free[stem, digits] = n
            if n < 10**digits:
                new = f"{stem}_{n}"
        self.seen.add(new)
        return new


def dedupe_names(names: list[str], limit: int) -> list[str]:
    """Names cut to `limit` characters, later equal ones numbered _2, _3, ... within the limit."""
    told = UniqueNames(limit)
    return [told.add(name) for name in names]


def column_changes(source: DatabaseDef, target: DatabaseDef) -> list[tuple[str, str, str]]:
    """(table, column, add, drop or change) in tables of both; columns match by place and name, as altering goes by both."""
    have, out = {(t.schema, t.name): t for t in target.tables}, []
    for t in source.tables:
        other = have.get((t.schema, t.name))
        if other:
            want, had = ({(i, c.name): c for i, c in enumerate(x.columns)} for x in (t, other))
            for k in sorted(want.keys() | had.keys()):
                if want.get(k) != had.get(k):
                    out.append((t.id, k[1], "add" if k not in had else "drop" if k not in want else "change"))
    return out


def key_changes(source: DatabaseDef, target: DatabaseDef) -> list[tuple[str, str, str]]:
    """(table, key, create, drop or change) in tables of both; keys match by name."""
    have, out = {(t.schema, t.name): t for t in target.tables}, []
    for t in source.tables:
        other = have.get((t.schema, t.name))
        if other:
            want, had = ({k.name: k for k in x.keys} for x in (t, other))
            for k in sorted(want.keys() | had.keys()):
                if want.get(k) != had.get(k):
                    out.append((t.id, k, "create" if k not in had else "drop" if k not in want else "change"))
    return out
