"""Which columns identify a row: the explicit key, a unique key, the whole row with counts, or nothing."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.plans.model import KeyKind, TableDef


@dataclass(frozen=True)
class KeyChoice:
    kind: str  # explicit, unique, whole_row or none
    columns: tuple[str, ...] = ()

    @property
    def enforceable(self) -> bool:
        return self.kind in ("explicit", "unique")


def choose_key(table: TableDef, replaced: Collection[str] = ()) -> KeyChoice:
    """The declared primary key; else the first unique key by name without nullable or replaced columns; else the whole row, if no
    column is nullable or replaced and some key covers all columns (in that key's order); else none."""
    usable = lambda names: all(not table.column(c).nullable and c not in replaced for c in names)
    if table.primary_key:
        return KeyChoice("explicit", table.primary_key)
    for key in sorted(table.keys):
        if key.kind == KeyKind.UNIQUE and usable(key.columns):
            return KeyChoice("unique", key.columns)
    names = [c.name for c in table.columns]
    if usable(names):
        for key in sorted(table.keys):
            if key.kind != KeyKind.SPATIAL and len(key.columns) == len(names):
                return KeyChoice("whole_row", key.columns)
    return KeyChoice("none")


def verify_key(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: n_rows, n_keys (distinct, nulls left out), n_null (rows with a null in the key), is_key."""
    null = F.lit(False)
    for c in columns:
        null = null | F.col(c).isNull()
    groups = df.groupBy(*columns, null.alias("_null")).agg(F.count("*").alias("n"))
    counts = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"),
        F.count(F.when(~F.col("_null"), 1)).alias("n_keys"),
        F.coalesce(F.sum(F.when(F.col("_null"), F.col("n"))), F.lit(0)).cast("long").alias("n_null"),
    )
    return counts.withColumn("is_key", (F.col("n_keys") == F.col("n_rows")) & (F.col("n_null") == 0))


def duplicate_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that more than one row has, and how many do: a grouped count, so that a hot key is combined before it is shuffled."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")
