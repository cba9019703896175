"""One-way reconciliation of tables: schema, then rows, and what is committed when."""

from __future__ import annotations

import argparse
import re
from collections.abc import Callable, Collection, Iterator, Mapping, Sequence
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.operators import tree
from concord.operators.apply import apply_diff, apply_multiset
from concord.operators.blocks import key_blocks
from concord.operators.commit import Pair, delete
from concord.operators.diff import counting, diff, diff_within, multiset_diff, pruned_diff, pruned_multiset_diff, summary
from concord.operators.filters import TableFilter, apply_filter, load_filters, restrict, validate
from concord.operators.keys import choose_key, verify_key
from concord.plans.convert import adapted, convert, same_in, show
from concord.plans.dependencies import parents_first
from concord.plans.dialects import FALLBACKS
from concord.plans.model import DatabaseDef, TableDef, table_of
from concord.plans.schema_diff import Action, apply_to_frame, plan_table
from concord.sources.jdbc import JdbcSource, Job
from concord.sources.tables import ParquetSource
from concord.sources.urls import parse_db_url

Source = ParquetSource | JdbcSource


class SchemaMismatch(ValueError):
    pass


class NotAKey(ValueError):
    pass


@dataclass
class TableResult:
    """changes and state are plans over what was there before: once the table is committed they are None and the new rows, and
    counts() are those taken before."""

    table: str
    key: str
    schema_actions: list[Action] = field(default_factory=list)
    changes: DataFrame | None = None
    state: DataFrame | None = None
    columns: tuple[str, ...] = ()
    counted: dict[str, int] | None = None
    old: DataFrame | None = None
    tree: Callable[[DataFrame, list[Pair]], list[Pair]] | None = None

    def counts(self) -> dict[str, int]:
        if self.counted is None and self.changes is not None:
            self.counted = {r.action: r.n for r in summary(self.changes).collect()}  # at most three rows
        return self.counted or {}


def sync_table(
    source: DataFrame, target: DataFrame, table: TableDef, *, filter: TableFilter | None = None, width: int | None = None, check_keys: bool = False, carry: Sequence[str] = ()
) -> TableResult:
    """The changes that make `target` equal the filtered source, and the target after them.

    width: compare blocks of about so many rows first and only look into those that differ.  check_keys: raise NotAKey where rows
    of either side share a key or have nulls in it, which would be written twice or never match.  carry: columns of the target besides
    those of the table, which the changes of a table with a key have with t_ before their name.
    """
    choice = choose_key(table, (filter.replace if filter else {}).keys())
    columns = table.stored
    s, t = apply_filter(source, filter).select(*columns), target.select(*columns, *carry)
    if choice.enforceable:
        key = list(choice.columns)
        for side, rows in (("source", s), ("target", t)) if check_keys else ():
            found = verify_key(rows, key).first()
            if not found.is_key:
                raise NotAKey(f"{table.name}: {found.n_rows - found.n_keys} rows of the {side} share their {', '.join(key)} or have none")
        changes = pruned_diff(s, t, key, columns, width, carry=carry) if width else diff(s, t, key, carry=carry)
        return TableResult(table.name, choice.kind, changes=changes, state=apply_diff(t.select(*columns), changes, key), columns=choice.columns, old=t.select(*columns))
    if choice.kind == "whole_row":
        t = t.select(*columns)
        changes = pruned_multiset_diff(s, t, columns, width) if width else multiset_diff(s, t, columns)
        return TableResult(table.name, choice.kind, changes=changes, state=apply_multiset(t, changes, columns), old=t)
    return TableResult(table.name, choice.kind, state=s)  # cleared and loaded again


def sync(
    source: Source, target: Source, *, tables: Mapping[str, TableDef] | None = None, only: str = "", ignore: str = "",
    filters: Mapping[str, TableFilter] | None = None, alter: bool = False, commit: str = "often", width: int | None = None, structure_only: bool = False,
    check_keys: bool = False, snapshot: str | None = None, trees: bool = False, progress: Callable[[TableResult], None] = lambda _: None,
) -> list[TableResult]:
    """commit: never (results only), often (table by table) or success (all tables are computed and written aside before any is replaced,
    in one commit or transaction).  Tables of a database that refer to each other are always changed in one transaction.  alter:
    change the target's schema where it differs; tables that only the target has are dropped, after all others are done, unless the
    source lists none.  Tables outside `only` and `ignore` stay, and filters of such tables do not count; a filter of any other table that the source
    lacks is an error.  snapshot: a shared folder to copy a database's tables to, so that all
    passes see the same rows; PostgreSQL's tables are read as of one moment anyway.  trees: with `width`, keep trees of digests with the
    target's tables, so that of unchanged tables no row is read again.  progress: called with each table's result.
    """
    if trees and not width:
        raise ValueError("trees are of blocks: give their width")
    options = {"tables": tables, "only": only, "ignore": ignore, "filters": filters, "alter": alter, "commit": commit, "width": width, "structure_only": structure_only}
    with source.one_moment() if isinstance(source, JdbcSource) else nullcontext(source) as one:
        return sync_all(one, target, **options, check_keys=check_keys, snapshot=snapshot, trees=trees, progress=progress)


def sync_all(
    source: Source, target: Source, *, tables: Mapping[str, TableDef] | None, only: str, ignore: str, filters: Mapping[str, TableFilter] | None, alter: bool, commit: str, width: int | None,
    structure_only: bool, check_keys: bool, snapshot: str | None, trees: bool, progress: Callable[[TableResult], None],
) -> list[TableResult]:
    """sync() from a source as it is at one moment."""
    if commit not in ("never", "often", "success"):
        raise ValueError(f"commit {commit!r}: never, often or success")
    for side in (source, target):
        if isinstance(side, ParquetSource):
            side.recover()
    if alter and commit != "never" and isinstance(target, JdbcSource):
        target.create_schema()
    there, had = source.tables(), target.tables()
    names = restrict(there, only, ignore)
    defs = {n: (tables or {}).get(n) or source.definition(n) for n in names}
    shown = defs
    defs = wanted(source, target, defs, set(had))
    unwanted = {n for n in {*there, *had, *(filters or {})} if not restrict([n], only, ignore)}
    filters = {n: f for n, f in (filters or {}).items() if n not in unwanted}
    validate(filters, defs)
    targets = set(restrict(had, only, ignore))
    if extra := sorted(targets - set(names)):
        if not alter:
            raise SchemaMismatch(f"tables {extra} are only in the target")
        if not source.exists():
            raise ValueError(f"{source.path} does not exist: the target's tables are not dropped for it")
        if not there:
            raise ValueError(f"{source.path} lists no tables: the target's are not dropped for it")
    key_of = lambda n: choose_key(defs[n], (filters[n].replace if n in filters else {}).keys()).columns
    if isinstance(source, JdbcSource):
        reads = {n: show(source.snapshot(n, snapshot, key_of(n)) if snapshot else source.read(n, key_of(n)), shown[n], source.dialect) for n in names}
    else:
        reads = {n: source.read(n) for n in names}
    reads = {n: convert(df, shown[n], defs[n]) for n, df in reads.items()}
    plans: dict[str, list[Action]] = {}
    for name in names:  # all tables are planned before any is changed
        if name not in targets:
            plans[name] = [Action("create_table", name, value=defs[name])]
        elif isinstance(target, JdbcSource) or target.stored(name):
            plans[name] = plan_table(defs[name], target.definition(name))
        else:  # files without a definition only show columns
            plans[name] = plan_table(table_of(reads[name], name), table_of(target.read(name), name))
        if plans[name] and not alter:
            raise SchemaMismatch(f"{name}: {[a.kind for a in plans[name]]}")
    results = []
    for name in names:
        read, want, actions = reads[name], defs[name], plans[name]
        by_file = isinstance(target, ParquetSource) and name in targets and not actions and commit != "never" and target.is_folder(name)
        if isinstance(target, JdbcSource) and actions and commit != "never":
            target.alter(actions, want)
            old = show(target.read(name, key_of(name)), want, target.dialect)
        elif by_file:
            old = target.read_with_files(name)
        elif name in targets:
            old = show(target.read(name, key_of(name)), target.definition(name), target.dialect) if isinstance(target, JdbcSource) else target.read(name)
            old = apply_to_frame(old, want if {c.name for c in want.columns} >= set(read.columns) else table_of(read, name), actions)
        else:
            old = read.limit(0)
        if structure_only:
            result = TableResult(name, "", state=old.drop("_file"))
        else:
            carry = ("_file",) * by_file
            result = None
            if trees and by_file and not check_keys:
                with described(target.spark, f"sync {name}: compare digest trees"):
                    result = tree_table(source, target, want, read, old, filters.get(name), width)
            result = result or sync_table(read, old, want, filter=filters.get(name), width=width, check_keys=check_keys, carry=carry)
        result.schema_actions = actions
        results.append(result)
    define = isinstance(target, ParquetSource) and (tables or isinstance(source, JdbcSource) or any(source.stored(n) for n in names))
    if commit != "never":
        if isinstance(target, JdbcSource):
            to_database(target, results, defs, structure_only, commit, progress)
        else:
            to_folder(target, results, targets, structure_only, commit, progress, (defs, extra) if define else None)
    else:
        for result in results:
            progress(result)
    if isinstance(target, JdbcSource):  # tables go before those they refer to
        extra = [n for group in parents_first(extra, target.references(extra)) for n in group][::-1]
    for name in extra:
        results.append(TableResult(name, "", schema_actions=[Action("drop_table", name)]))
        if commit != "never":
            target.drop(name)
        progress(results[-1])
    return results


def tree_table(source: Source, target: ParquetSource, table: TableDef, read: DataFrame, old: DataFrame, filter: TableFilter | None, width: int) -> TableResult | None:
    """sync_table() by trees of digests; None if the table has no key.  A stored tree stands for the rows it is of; the source's, if it has one and
    no filter holds, too."""
    choice, columns, spark = choose_key(table, (filter.replace if filter else {}).keys()), table.stored, target.spark
    if not choice.enforceable:
        return None
    key = list(choice.columns)
    s = apply_filter(read, filter).select(*columns)
    stored = tree.load(spark, target.tree_path(table.name), target.files(table.name), key, columns)
    blocks = stored.blocks if stored else key_blocks(s, key, width)
    t = old.select(*columns, "_file")
    depth = stored.depth if stored else tree.depth_of(read.count() // width if not blocks.by_value else max(1, blocks_of_values(s, key[0], width)))
    own = tree.load(spark, source.tree_path(table.name), source.files(table.name), key, columns) if isinstance(source, ParquetSource) and not filter else None
    held: list[str] = []

    def kept(leaf: DataFrame) -> DataFrame:
        """Written, as a tree is looked at level by level."""
        out = target.hold(table.name, tree.levels(leaf, depth))
        held.append(out.held_path)
        return out

    have = stored.levels(spark) if stored else kept(tree.leaves(t, blocks, columns))
    want = own.levels(spark) if own and stored and own.of_same(stored) else kept(tree.leaves(s, blocks, columns))
    differing = tree.descend(want, have, depth)
    changes = diff_within(tree.with_hashes(s, columns), tree.with_hashes(t, columns), blocks, differing, ("_file", "_a", "_b"))
    result = TableResult(table.name, choice.kind, changes=changes, state=apply_diff(t.select(*columns), changes, key), columns=choice.columns, old=t.select(*columns))

    def grown(changes: DataFrame, pairs: list[Pair]) -> list[Pair]:
        """The tree after the changes, to take the place of the stored one; and what was held goes."""
        out: list[Pair] = [(p, None) for p in held]
        if result.counted or not stored:
            leaf = tree.updated(have.where("level = 0"), changes, blocks)
            aside = tree.store(leaf, blocks, columns, depth, target.files(table.name, pairs), target.path)
            out.append((aside, target.tree_path(table.name)))
        return out

    result.tree = grown
    return result


def blocks_of_values(df: DataFrame, key: str, width: int) -> int:
    low, high = df.agg(F.min(key), F.max(key)).first()
    return 0 if low is None else (int(high) - int(low)) // width + 1


def wanted(source: Source, target: Source, defs: Mapping[str, TableDef], had: Collection[str]) -> dict[str, TableDef]:
    """What the target's tables should be: the source's definitions in the types and names that the target can hold; a folder that has stored another
    dialect's definition keeps it if it is what the source shows."""
    if isinstance(target, JdbcSource):
        return adapted(list(defs.values()), target.dialect) if target.dialect in FALLBACKS else dict(defs)
    if not isinstance(source, JdbcSource) or source.dialect not in FALLBACKS:
        return dict(defs)
    stored = {t.name: t for t in target.definitions().tables if t.name in had}
    return {n: stored[n] if n in stored and same_in(source.dialect, stored[n], t) else t for n, t in defs.items()}


def to_folder(target: ParquetSource, results: list[TableResult], targets: Collection[str], structure_only: bool, commit: str, progress: Callable, definitions: tuple | None) -> None:
    """Stage each table's new files, and put them in place table by table, or all at once with their definitions."""
    staged: list[Pair] = []
    for result in results:
        with described(target.spark, f"sync {result.table}: compare and write aside"):
            pairs = [] if structure_only and result.table in targets and not result.schema_actions else staged_table(target, result)
        if commit == "often":
            target.publish(pairs)
            done(result, target)
            progress(result)
        staged += pairs
    named = target.stage_definitions(definitions[0], definitions[1]) if definitions else []
    target.publish(named if commit == "often" else staged + named)
    if commit == "success":
        for result in results:
            done(result, target)
            progress(result)


def staged_table(target: ParquetSource, result: TableResult) -> list[Pair]:
    """What takes whose place.  The comparison runs once: its changes are written aside, and counted in the same pass."""
    if result.changes is None:
        return [target.stage(result.table, result.state)]
    changes, counts = counting(result.changes)
    held = target.hold(result.table, changes)
    result.counted = counts()
    if "t__file" in held.columns:
        pairs = target.stage_changes(result.table, held, result.columns) if result.counted else []
        pairs += result.tree(held, pairs) if result.tree else []
    elif result.columns:
        pairs = [target.stage(result.table, apply_diff(result.old, held, result.columns))]
    else:
        pairs = [target.stage(result.table, apply_multiset(result.old, held, result.old.columns))]
    if pairs:
        return [*pairs, (held.held_path, None)]
    delete(target.spark, held.held_path)
    return []


def to_database(target: JdbcSource, results: list[TableResult], defs: Mapping[str, TableDef], structure_only: bool, commit: str, progress: Callable) -> None:
    """Changes of tables that refer to each other go in one transaction, with `success` those of all."""
    by_name = {r.table: r for r in results}
    for group in target.transactions(list(by_name), whole=commit == "success"):
        jobs = []
        for name in group:
            result = by_name[name]
            if structure_only:
                continue
            if result.columns:
                changes, counts = counting(result.changes)
                jobs.append(Job(defs[name], changes, result.columns, counts))
            elif result.changes is None or result.counts():  # a table without a key, unless nothing differs
                jobs.append(Job(defs[name], result.state.withColumn("action", F.lit("insert")), (), None))
        with described(target.spark, f"sync {', '.join(group)}: compare and stage"):
            target.apply_all(jobs)
        for job in jobs:
            if job.counts:
                by_name[job.table.name].counted = job.counts()
        for name in group:
            done(by_name[name], target)
            progress(by_name[name])


@contextmanager
def described(spark: SparkSession, text: str) -> Iterator[None]:
    """What Spark's pages and listeners say of the jobs within."""
    before = spark.sparkContext.getLocalProperty("spark.job.description")
    spark.sparkContext.setJobDescription(text)
    try:
        yield
    finally:
        spark.sparkContext.setLocalProperty("spark.job.description", before)


def done(result: TableResult, target: Source) -> None:
    result.changes, result.state, result.old, result.tree = None, target.read(result.table), None, None


def endpoint(spark: SparkSession, where: str) -> Source:
    """A folder, a JDBC URL, or a database URL such as postgres://user:password@host/database/schema."""
    if where.startswith("jdbc:"):
        return JdbcSource(spark, where)
    if re.match(r"(mysql|postgres|postgresql)://", where):
        url = parse_db_url(where)
        return JdbcSource(spark, url.jdbc, {k: v for k, v in (("user", url.user), ("password", url.password)) if v}, url.schema)
    return ParquetSource(spark, where)


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Make the tables of one folder equal those of another.")
    p.add_argument("--from", dest="source", required=True)
    p.add_argument("--to", dest="target", required=True)
    p.add_argument("--only", default="", help="tables, parted by commas")
    p.add_argument("--ignore", default="")
    p.add_argument("--filters", help="YAML file of row filters and column masks")
    p.add_argument("--keys", help="JSON file of table definitions with keys")
    p.add_argument("--alter", action="store_true", help="change the target's schema where it differs, dropping tables that only it has")
    p.add_argument("--structure-only", action="store_true")
    p.add_argument("--check-keys", action="store_true", help="stop where rows share a key")
    p.add_argument("--snapshot", help="shared folder for copies of a database's tables")
    p.add_argument("--commit", default="often", choices=["never", "often", "success"])
    p.add_argument("--trees", action="store_true", help="keep trees of digests with the target's tables")
    p.add_argument("--block", type=int, help="rows in a block whose digests are compared first")
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("concord").getOrCreate()
    tables = None
    if a.keys:
        with open(a.keys) as f:
            tables = {t.name: t for t in DatabaseDef.from_json(f.read()).tables}
    sync(
        endpoint(spark, a.source), endpoint(spark, a.target), tables=tables, only=a.only, ignore=a.ignore, filters=load_filters(a.filters) if a.filters else None, alter=a.alter, commit=a.commit, width=a.block,
        structure_only=a.structure_only, check_keys=a.check_keys, snapshot=a.snapshot, trees=a.trees, progress=lambda r: print(r.table, r.key, [x.kind for x in r.schema_actions], r.counts(), flush=True),
    )


if __name__ == "__main__":
    main()
