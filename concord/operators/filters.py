"""Row filters and column masks on the source side, as SQL expressions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.plans.model import TableDef


class FilterDefinitionError(ValueError):
    pass


@dataclass(frozen=True)
class TableFilter:
    """only: predicate over the original columns; replace: column -> expression over the original columns, or None for NULL."""

    only: str | None = None
    replace: Mapping[str, str | None] = field(default_factory=dict)


def parse_filters(given: Mapping) -> dict[str, TableFilter]:
    """{table: clear | {only: predicate, replace: {column: expression}}}"""
    out = {}
    for table, entry in (given or {}).items():
        if entry == "clear":
            out[table] = TableFilter(only="false")
            continue
        if not isinstance(entry, Mapping):
            raise FilterDefinitionError(f"filter of table {table}: expected clear, only or replace, not {entry!r}")
        if unknown := set(entry) - {"only", "replace"}:
            raise FilterDefinitionError(f"filter of table {table}: unknown action {sorted(unknown)[0]}")
        text = lambda v: None if v is None else str(v).lower() if isinstance(v, bool) else str(v)
        out[table] = TableFilter(text(entry.get("only")), {c: text(v) for c, v in (entry.get("replace") or {}).items()})
    return out


def load_filters(path: str) -> dict[str, TableFilter]:
    import yaml

    with open(path) as f:
        return parse_filters(yaml.safe_load(f))


def validate(filters: Mapping[str, TableFilter], tables: Mapping[str, TableDef]) -> None:
    for name, f in filters.items():
        if name not in tables:
            raise FilterDefinitionError(f"filtered table {name} is not there")
        known = {c.name for c in tables[name].columns}
        for column in f.replace:
            if column not in known:
                raise FilterDefinitionError(f"filtered column {column} is not in table {name}")
            if column in tables[name].primary_key:
                raise FilterDefinitionError(f"column {column} of table {name} is in its primary key and can't be replaced")


def apply_filter(df: DataFrame, f: TableFilter | None) -> DataFrame:
    """Rows by the predicate, then all replacements at once, each cast to its column's type."""
    if f is None:
        return df
    rows = df.where(F.expr(f.only)) if f.only is not None else df
    if not f.replace:
        return rows
    column = lambda s: (F.lit(None) if f.replace[s.name] is None else F.expr(f.replace[s.name])).cast(s.dataType).alias(s.name) if s.name in f.replace else F.col(s.name)
    return rows.select(*[column(s) for s in df.schema.fields])


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Nulls of columns that become NOT NULL, overwritten by a value of the column's type."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in values.items()})


def restrict(names: list[str], only: str = "", ignore: str = "") -> list[str]:
    """Names in the list `only` (all if empty) and not in `ignore`; lists are parted by commas or blanks."""
    wanted, unwanted = (set(x.replace(",", " ").split()) for x in (only, ignore))
    return [n for n in names if (not wanted or n in wanted) and n not in unwanted]
