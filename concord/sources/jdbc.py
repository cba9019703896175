"""JDBC databases: listing definitions, reading tables in key ranges, carrying out schema actions and changes.

Rows go through Spark's JDBC reader and writer.  A table is read in ranges of its key by several tasks at once.  Changes are
first written to staging tables, by all tasks at once, and then applied by a few statements in one transaction: rows that are
deleted or replaced go, then rows that hold a unique value that is needed, and then the new rows come; where tables refer to each
other, children's rows go before their parents' and parents' come before their children's, and rows that others refer to are updated in place.
Identity columns then go on after the greatest value.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass, field, replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.plans.convert import spell
from concord.plans.ddl import action_sql, enum_type_sql, literal, missing_schemas, qualified, quoted, read_default
from concord.plans.dependencies import linked, parents_first
from concord.plans.dialects import parse_mysql, parse_postgresql
from concord.plans.model import ColumnDef, Default, KeyDef, KeyKind, TableDef
from concord.plans.schema_diff import Action

#: Portable types of java.sql.Types.
JDBC_TYPES = {
    -7: "boolean", -6: "integer.8bit", -5: "integer.64bit", -4: "binary", -3: "binary.varbinary", -2: "binary.fixed", -1: "text", 1: "text.fixed", 2: "decimal", 3: "decimal", 4: "integer",
    5: "integer.16bit", 6: "float", 7: "float.32bit", 8: "float", 12: "text.varchar", 16: "boolean", 91: "date", 92: "time", 93: "datetime", 2004: "binary", 2005: "text", 2014: "datetime.tz",
}

#: What PostgreSQL's catalog calls types by shorter names.
POSTGRESQL_NAMES = {
    "int2": "smallint", "int4": "integer", "int8": "bigint", "float4": "real", "float8": "double precision", "bool": "boolean", "timestamptz": "timestamp with time zone",
    "timestamp": "timestamp without time zone",
}


@dataclass
class Job:
    """What a table gets: the changes of diff() by a key, or, without a key, all its rows anew.  counts: told once they are written."""

    table: TableDef
    changes: DataFrame
    key: Sequence[str]
    counts: Callable[[], dict[str, int]] | None = None


@dataclass(frozen=True)
class JdbcSource:
    """options: driver, user, password, fetchsize, sessionInitStatement and whatever else the JDBC reader takes.  schema: the
    database schema whose tables are meant, by default the connection's.  partitions: ranges of a key that are read at once."""

    spark: SparkSession
    url: str
    options: Mapping[str, str] = field(default_factory=dict)
    schema: str = ""
    partitions: int = 1

    @property
    def dialect(self) -> str:
        return self.url.split(":")[1]

    @property
    def path(self) -> str:
        return self.url

    # -- statements ------------------------------------------------------------------------------

    @contextmanager
    def connection(self) -> Iterator:
        """A connection of the driver's, without autocommit: committed at the end, rolled back on errors."""
        jvm = self.spark._jvm
        properties = jvm.java.util.Properties()
        for k, v in self.options.items():
            properties.setProperty(k, str(v))
        if self.options.get("driver"):
            loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
            c = loader.loadClass(self.options["driver"]).getDeclaredConstructor(self.spark.sparkContext._gateway.new_array(jvm.java.lang.Class, 0)).newInstance(self.spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 0)).connect(self.url, properties)
        else:
            c = jvm.java.sql.DriverManager.getConnection(self.url, properties)
        c.setAutoCommit(False)
        try:
            yield c
            c.commit()
        except BaseException:
            c.rollback()
            raise
        finally:
            c.close()

    def execute(self, statements: list[str]) -> None:
        """All in one transaction, where the database has transactions for them."""
        with self.connection() as c:
            self._run(c, statements)

    def _run(self, c, statements: Sequence[str]) -> None:
        for s in statements:
            statement = c.createStatement()
            statement.execute(s)
            statement.close()

    def _scope(self, c) -> tuple[str | None, str | None]:
        """(catalog, schema) that tables are looked for in."""
        return (self.schema or c.getCatalog(), None) if self.dialect == "mysql" else (None, self.schema or c.getSchema())

    def _pattern(self, meta, name: str | None) -> str | None:
        """A name as a catalog pattern that only fits itself."""
        escape = meta.getSearchStringEscape()
        for x in (escape, "%", "_") if name and escape else ():
            name = name.replace(x, escape + x)
        return name

    def _rows(self, found) -> list[dict]:
        """A catalog listing, small; its columns are read by number, as some drivers allow each to be read once and in order."""
        meta, out = found.getMetaData(), []
        names = [meta.getColumnLabel(i + 1).upper() for i in range(meta.getColumnCount())]
        while found.next():
            out.append({n: found.getObject(i + 1) for i, n in enumerate(names)})
        found.close()
        return out

    # -- definitions -----------------------------------------------------------------------------

    def exists(self) -> bool:
        with self.connection():
            return True

    def tables(self) -> list[str]:
        """Tables of the schema, not views, largest first where the database tells sizes, equal ones by name; staging tables that a failed run
        has left are no tables."""
        kinds = self.spark.sparkContext._gateway.new_array(self.spark._jvm.java.lang.String, 1)
        kinds[0] = "TABLE"
        with self.connection() as c:
            catalog, schema = self._scope(c)
            meta = c.getMetaData()
            rows = self._rows(meta.getTables(catalog, self._pattern(meta, schema), "%", kinds))
            sizes = self._sizes(c, schema or catalog)
        names = [r["TABLE_NAME"] for r in rows if not r["TABLE_NAME"].startswith("concord_stage_") and (schema is None or r["TABLE_SCHEM"] == schema)]
        return sorted(names, key=lambda n: (-sizes.get(n, 0), n))

    def _sizes(self, c, schema: str) -> dict[str, int]:
        """Stored bytes by table, where a catalog tells them."""
        sql = {
            "mysql": f"SELECT table_name, coalesce(data_length + index_length, 0) FROM information_schema.tables WHERE table_schema = {self.literal(schema)}",
            "postgresql": f"SELECT c.relname, pg_total_relation_size(c.oid) FROM pg_catalog.pg_class c JOIN pg_catalog.pg_namespace n ON n.oid = c.relnamespace WHERE c.relkind IN ('r', 'p') AND n.nspname = {self.literal(schema)}",
        }.get(self.dialect)
        return {n: int(size) for n, size in self._select(c, sql)} if sql else {}

    def definition(self, table: str) -> TableDef:
        """Columns, primary key, and other keys by name."""
        with self.connection() as c:
            catalog, schema = self._scope(c)
            meta = c.getMetaData()
            columns = self._rows(meta.getColumns(catalog, self._pattern(meta, schema), self._pattern(meta, table), "%"))
            columns = sorted((r for r in columns if r["TABLE_NAME"] == table and (schema is None or r["TABLE_SCHEM"] == schema)), key=lambda r: r["ORDINAL_POSITION"])
            primary = sorted(self._rows(meta.getPrimaryKeys(catalog, schema, table)), key=lambda r: r["KEY_SEQ"])
            index = self._rows(meta.getIndexInfo(catalog, schema, table, False, True))
            referring = {r["FK_NAME"] for r in self._rows(meta.getImportedKeys(catalog, schema, table))}
            spelled, enums = self._spellings(c, schema or catalog, table)
        own = {r["PK_NAME"] for r in primary}
        key = tuple(r["COLUMN_NAME"] for r in primary)
        named: dict[str, list[dict]] = {}
        for r in index:
            if r["INDEX_NAME"] and r["COLUMN_NAME"]:
                named.setdefault(r["INDEX_NAME"], []).append(r)
        keys = []
        for name, rows in sorted(named.items()):
            held = tuple(r["COLUMN_NAME"] for r in sorted(rows, key=lambda r: r["ORDINAL_POSITION"]))
            backing = self.dialect == "derby" and rows[0]["NON_UNIQUE"] and re.match(r"SQL\d+", name)  # of a foreign key
            if name not in own and name not in referring and name != "PRIMARY" and held != key and not backing:
                keys.append(KeyDef(name, KeyKind.STANDARD if rows[0]["NON_UNIQUE"] else KeyKind.UNIQUE, held))
        return TableDef(table, tuple(self._column(r, spelled, enums) for r in columns), key, tuple(keys))

    def _spellings(self, c, schema: str, table: str) -> tuple[dict[str, tuple[str, str]], dict[str, tuple[str, ...]]]:
        """What JDBC's catalog leaves out: MySQL's full column types and extras by column, and the labels of PostgreSQL's enum types by type."""
        if self.dialect == "mysql":
            where = f"table_schema = {self.literal(schema)} AND table_name = {self.literal(table)}"
            return {n: (kind, extra) for n, kind, extra in self._select(c, f"SELECT column_name, column_type, extra FROM information_schema.columns WHERE {where}")}, {}
        enums: dict[str, list[str]] = {}
        if self.dialect == "postgresql":
            sql = "SELECT t.typname, e.enumlabel FROM pg_catalog.pg_enum e JOIN pg_catalog.pg_type t ON t.oid = e.enumtypid JOIN pg_catalog.pg_namespace n ON n.oid = t.typnamespace"
            for name, label in self._select(c, f"{sql} WHERE n.nspname = {self.literal(schema)} ORDER BY t.typname, e.enumsortorder"):
                enums.setdefault(name, []).append(label)
        return {}, {n: tuple(x) for n, x in enums.items()}

    def references(self, names: Sequence[str]) -> list[tuple[str, str]]:
        """(child, parent) of the foreign keys between tables of the schema."""
        out = set()
        with self.connection() as c:
            catalog, schema = self._scope(c)
            meta = c.getMetaData()
            for name in names:
                out |= {(name, r["PKTABLE_NAME"]) for r in self._rows(meta.getImportedKeys(catalog, schema, name)) if schema is None or r["PKTABLE_SCHEM"] == schema}
        return sorted(out)

    def _column(self, r: dict, spelled: Mapping[str, tuple[str, str]] = {}, enums: Mapping[str, tuple[str, ...]] = {}) -> ColumnDef:  # noqa: B006
        name, nullable = r["COLUMN_NAME"], r["NULLABLE"] != 0
        size, scale = r["COLUMN_SIZE"] or 0, r["DECIMAL_DIGITS"] or 0
        full, extra = spelled.get(name, ("", ""))
        if full:
            c = parse_mysql(name, full, nullable)
        elif self.dialect == "mysql":
            c = parse_mysql(name, f"{r['TYPE_NAME']}({size})" if r["DATA_TYPE"] in (1, 12, -2, -3) else f"{r['TYPE_NAME']}({size},{scale})" if r["DATA_TYPE"] in (2, 3) else r["TYPE_NAME"], nullable)
        elif self.dialect == "postgresql":
            kind = POSTGRESQL_NAMES.get(r["TYPE_NAME"], r["TYPE_NAME"])
            c = parse_postgresql(name, f"varchar({size})" if kind == "varchar" and size < 2**31 - 1 else f"character({size})" if kind == "bpchar" else f"numeric({size},{scale})" if kind == "numeric" and size else kind, nullable, dict(enums))
        else:
            kind = JDBC_TYPES.get(r["DATA_TYPE"], "unknown")
            sized = kind in ("decimal", "text.varchar", "text.fixed", "binary.varbinary", "binary.fixed")
            c = ColumnDef(name, kind, nullable, size if sized else 0, scale if kind == "decimal" else 0)
        kind, value = read_default(r["COLUMN_DEF"], self.dialect, extra or ("auto_increment" if r.get("IS_AUTOINCREMENT") == "YES" else ""), c.type_name.startswith(("integer", "decimal", "float")))
        return ColumnDef(**{**vars(c), "name": name, "default_kind": kind, "default_value": value, "auto_update": "on update" in extra.lower()})

    # -- rows ------------------------------------------------------------------------------------

    def _name(self, table: str) -> str:
        return qualified(table, self.dialect, self.schema)

    def _reader(self):
        return self.spark.read.format("jdbc").option("url", self.url).options(**self.options)

    def query(self, sql: str) -> DataFrame:
        return self._reader().option("query", sql).load()

    def read(self, table: str, key: str | Sequence[str] = ()) -> DataFrame:
        """A table; with a key, of any types, it is read in `partitions` ranges of the key at once."""
        key = [key] if isinstance(key, str) else list(key)
        if not key or self.partitions < 2:
            return self._reader().option("dbtable", self._name(table)).load()
        return self.spark.read.jdbc(self.url, self._name(table), predicates=self.ranges(key, self.boundaries(table, key)), properties={k: str(v) for k, v in self.options.items()})

    def boundaries(self, table: str, key: Sequence[str]) -> list[list]:
        """Keys that part the table into `partitions` ranges of about as many rows, found by the key's index."""
        listed = ", ".join(quoted(k, self.dialect) for k in key)
        out: list[list] = []
        with self.connection() as c:
            n = self._select(c, f"SELECT count(*) AS n FROM {self._name(table)}")[0][0]
            for i in range(1, self.partitions) if n >= self.partitions else ():
                skip = n * i // self.partitions - 1
                page = f"LIMIT 1 OFFSET {skip}" if self.dialect == "mysql" else f"OFFSET {skip} ROWS FETCH NEXT 1 ROWS ONLY"
                row = self._select(c, f"SELECT {listed} FROM {self._name(table)} ORDER BY {listed} {page}")[0]
                if None not in row and row not in out:
                    out.append(row)
        return out

    def _select(self, c, sql: str) -> list[list]:
        statement = c.createStatement()
        rows = [list(r.values()) for r in self._rows(statement.executeQuery(sql))]
        statement.close()
        return rows

    def ranges(self, key: Sequence[str], bounds: Sequence[Sequence]) -> list[str]:
        """Conditions of the ranges (b1, b2] between boundaries: every row, whatever its key, meets one of them."""

        def beyond(bound: Sequence) -> str:
            """key > bound, column by column."""
            parts = []
            for i, name in enumerate(key):
                same = [f"{quoted(k, self.dialect)} = {self.literal(v)}" for k, v in zip(key[:i], bound)]
                parts.append(" AND ".join([*same, f"{quoted(name, self.dialect)} > {self.literal(bound[i])}"]))
            return "(" + " OR ".join(f"({p})" for p in parts) + ")"

        if not bounds:
            return ["1 = 1"]
        null = " OR ".join(f"{quoted(k, self.dialect)} IS NULL" for k in key)
        out = [f"({null} OR NOT {beyond(bounds[0])})"]
        out += [f"({beyond(a)} AND NOT {beyond(b)})" for a, b in zip(bounds, bounds[1:])]
        return [*out, beyond(bounds[-1])]

    def literal(self, value) -> str:
        if isinstance(value, bool):
            return str(value).upper()
        if isinstance(value, datetime):
            return f"TIMESTAMP '{value}'" if self.dialect != "derby" else f"TIMESTAMP('{value}')"
        if isinstance(value, date):
            return f"DATE '{value}'" if self.dialect != "derby" else f"DATE('{value}')"
        return literal(value.replace("\\", "\\\\") if self.dialect == "mysql" else value) if isinstance(value, str) else str(value) if isinstance(value, (int, float)) else literal(value.toString())

    def snapshot(self, table: str, folder: str, key: str | Sequence[str] = ()) -> DataFrame:
        """A copy in a folder that executors share, so that every pass of a comparison sees the same rows."""
        path = f"{folder.rstrip('/')}/snapshot-{uuid.uuid4().hex}"
        self.read(table, key).write.parquet(path)
        return self.spark.read.parquet(path)

    @contextmanager
    def one_moment(self) -> Iterator[JdbcSource]:
        """The source as all its readers see it at one moment: PostgreSQL exports a snapshot, which every connection that reads takes over,
        as long as the connection that has exported it is open.  Other databases can't share one: they are read as they are."""
        if self.dialect != "postgresql":
            yield self
            return
        with self.connection() as c:
            self._run(c, ["SET TRANSACTION ISOLATION LEVEL REPEATABLE READ, READ ONLY"])
            found = self._select(c, "SELECT pg_export_snapshot()")[0][0]
            yield replace(self, options={"fetchsize": "10000", **self.options, "sessionInitStatement": self.joining(found)})

    def joining(self, snapshot: str) -> str:
        """What a connection without autocommit, as readers with a fetch size have it, says first; after what the options say."""
        own = self.options.get("sessionInitStatement", "")
        take = f"SET TRANSACTION ISOLATION LEVEL REPEATABLE READ, READ ONLY; SET TRANSACTION SNAPSHOT {literal(snapshot)}"
        return f"{take}; {own}" if own else take

    def append(self, table: str, df: DataFrame, batch: int = 10_000) -> None:
        df.write.format("jdbc").option("url", self.url).options(**self.options).option("dbtable", self._name(table)).option("batchsize", batch).mode("append").save()

    # -- changes ---------------------------------------------------------------------------------

    def alter(self, actions: list[Action], table: TableDef) -> None:
        """Carry out a plan on a table whose definition afterwards is `table`."""
        made = enum_type_sql(table, self.dialect, self.schema) if any(a.kind in ("create_table", "recreate_table", "add_column") for a in actions) else []
        self.execute([*made, *(s for a in actions for s in action_sql(a, table, self.dialect, self.schema))])

    def create_schema(self) -> None:
        """The schema that is meant, where the database lacks it."""
        if self.schema and self.dialect != "mysql":
            with self.connection() as c:
                there = [r["TABLE_SCHEM"] for r in self._rows(c.getMetaData().getSchemas())]
                self._run(c, [f"CREATE SCHEMA {quoted(s, self.dialect)}" for s in missing_schemas((TableDef("", schema=self.schema),), there, [])])

    def drop(self, table: str) -> None:
        self.execute([f"DROP TABLE {self._name(table)}"])

    @contextmanager
    def _staged(self, table: str, columns: list[str], rows: DataFrame) -> Iterator[tuple[str, dict[str, str]]]:
        """A staging table with the columns' types and an action, filled, and how its columns are read; dropped at the end.

        Spark sends Derby a null text as a CLOB, which it won't take for other columns: there texts are staged without nulls, and a
        mask tells which were null.
        """
        stage = f"concord_stage_{uuid.uuid4().hex[:12]}"
        read = {c: f"s.{quoted(c, self.dialect)}" for c in columns}
        texts = [c for c, kind in rows.dtypes if kind == "string" and c in columns] if self.dialect == "derby" else []
        if texts:
            mask = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in texts])
            rows = rows.withColumns({"concord_nulls": mask, **{c: F.coalesce(c, F.lit("")) for c in texts}})
            read |= {c: f"CASE WHEN SUBSTR(s.\"concord_nulls\", {i + 1}, 1) = '1' THEN NULL ELSE {read[c]} END" for i, c in enumerate(texts)}
        list_ = ", ".join(quoted(c, self.dialect) for c in columns)
        empty = f"SELECT {list_} FROM {self._name(table)}"
        kind = f"CREATE TABLE {self._name(stage)} AS {empty} WITH NO DATA" if self.dialect == "derby" else f"CREATE TABLE {self._name(stage)} AS {empty} WHERE 1 = 0"
        self.execute([kind, *[f"ALTER TABLE {self._name(stage)} ADD COLUMN {quoted(c, self.dialect)} varchar({n})" for c, n in (("concord_action", 8), ("concord_nulls", max(len(texts), 1)))]])
        try:
            self._loosen(stage)
            self.append(stage, rows.select(*columns, F.col("action").alias("concord_action"), *["concord_nulls"] * bool(texts)))
            yield self._name(stage), read
        finally:
            self.drop(stage)

    def _loosen(self, stage: str) -> None:
        """Columns of a copied definition may be NOT NULL, which the rows of deletes are not."""
        tight = [c.name for c in self.definition(stage).columns if not c.nullable]
        how = {"derby": "NULL", "postgresql": "DROP NOT NULL"}.get(self.dialect)
        if how:
            self.execute([f"ALTER TABLE {self._name(stage)} ALTER COLUMN {quoted(c, self.dialect)} {how}" for c in tight])

    def transactions(self, names: Sequence[str], whole: bool = False) -> list[list[str]]:
        """Tables that must be changed in one transaction, as they refer to each other; all in one if `whole`."""
        return [list(names)] if whole and names else linked(names, self.references(names))

    def apply(self, table: TableDef, changes: DataFrame, key: list[str], columns: list[str]) -> None:
        """The changes of diff(), in one transaction; nulls in a unique key clear nothing."""
        stored = replace(table, columns=tuple(c for c in table.columns if c.name in columns))
        self.apply_all([Job(stored, changes, key)])

    def replace(self, table: str, rows: DataFrame) -> None:
        """All rows of a table, in one transaction."""
        definition = self.definition(table)
        stored = replace(definition, columns=tuple(c for c in definition.columns if c.name in rows.columns))
        self.apply_all([Job(stored, rows.withColumn("action", F.lit("insert")), ())])

    def apply_all(self, jobs: Sequence[Job]) -> None:
        """The changes of several tables, in one transaction.

        Constraints that may be deferred are.  Of a cycle of tables with constraints that may not, changes fail if no order does them
        all; so do unique values that rows exchange which other tables refer to.
        """
        names = [j.table.name for j in jobs]
        edges = self.references(names) if jobs else []
        by_name = {j.table.name: j for j in jobs}
        order = [by_name[n] for group in parents_first(names, edges) for n in group]
        referred = {p for _, p in edges}
        with ExitStack() as stack:
            staged = {j.table.name: stack.enter_context(self._staged(j.table.name, j.table.stored, spell(j.changes, j.table.columns, self.dialect))) for j in order}
            gone, come = [], []
            for j in order:
                before, after = self.statements(j, *staged[j.table.name], j.table.name in referred)
                gone[:0] = before  # children first
                come += after
            if not jobs:
                return
            with self.connection() as c:
                self._run(c, [*self.deferring(bool(edges)), *gone, *come])
                for j in order:
                    self._restart(c, j.table)

    def deferring(self, referring: bool) -> list[str]:
        if not referring:
            return []
        return ["SET FOREIGN_KEY_CHECKS = 0"] if self.dialect == "mysql" else ["SET CONSTRAINTS ALL DEFERRED"]

    def statements(self, job: Job, stage: str, read: Mapping[str, str], referred: bool) -> tuple[list[str], list[str]]:
        """What makes rows go, and what makes them come.  referred: other tables refer to this one, so that replaced rows are updated in place."""
        q = lambda c: quoted(c, self.dialect)
        name, action, columns, key = self._name(job.table.name), q("concord_action"), job.table.stored, list(job.key)
        equal = lambda names: " AND ".join(f"{read[c]} = {name}.{q(c)}" for c in names)
        having = lambda names, *actions: f"EXISTS (SELECT 1 FROM {stage} s WHERE s.{action} IN ({', '.join(map(literal, actions))}) AND {equal(names)})"
        over = " OVERRIDING SYSTEM VALUE" if self.dialect == "postgresql" and any(c.default_kind == Default.IDENTITY_ALWAYS for c in job.table.columns) else ""
        insert = f"INSERT INTO {name} ({', '.join(map(q, columns))}){over} SELECT {', '.join(read[c] for c in columns)} FROM {stage} s WHERE s.{action} IN "
        if not key:
            return [f"DELETE FROM {name}"], [insert + "('insert')"]
        rest = [c for c in columns if c not in key]
        if referred:
            one = lambda c: f"{q(c)} = (SELECT {read[c]} FROM {stage} s WHERE s.{action} = 'replace' AND {equal(key)})"
            update = [f"UPDATE {name} SET {', '.join(map(one, rest))} WHERE {having(key, 'replace')}"] if rest else []
            return [f"DELETE FROM {name} WHERE {having(key, 'delete')}"], [*update, insert + "('insert')"]
        needed = [f"DELETE FROM {name} WHERE {having(k.columns, 'insert', 'replace')}" for k in job.table.keys if k.kind == KeyKind.UNIQUE]
        return [f"DELETE FROM {name} WHERE {having(key, 'delete', 'replace')}", *needed], [insert + "('insert', 'replace')"]

    def _restart(self, c, table: TableDef) -> None:
        """Identity columns go on after the greatest value that the table holds; MySQL does so by itself."""
        kinds = (Default.SEQUENCE, Default.IDENTITY_ALWAYS, Default.IDENTITY_BY_DEFAULT)
        for column in table.columns if self.dialect != "mysql" else ():
            if column.default_kind in kinds:
                most = self._select(c, f"SELECT max({quoted(column.name, self.dialect)}) AS m FROM {self._name(table.name)}")[0][0]
                self._run(c, [self.restarting(table.name, column, 1 + int(most or 0))])

    def restarting(self, table: str, column: ColumnDef, value: int) -> str:
        if self.dialect == "postgresql":
            owner = literal(self._name(table))
            return f"SELECT setval(pg_get_serial_sequence({owner}, {literal(column.name)}), {value}, false)"
        return f"ALTER TABLE {self._name(table)} ALTER COLUMN {quoted(column.name, self.dialect)} RESTART WITH {value}"
