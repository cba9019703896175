"""SQL that carries out schema actions in a database, and the reading of defaults and names from catalogs."""

from __future__ import annotations

import hashlib
import re

from concord.plans.model import ColumnDef, Default, TableDef
from concord.plans.schema_diff import Action

#: What portable types are called; a size or a size and scale follow where the type has them.
SPELLINGS = {
    "mysql": {
        "binary": "longblob", "binary.varbinary": "varbinary", "binary.fixed": "binary", "text": "longtext", "text.varchar": "varchar", "text.fixed": "char", "json": "json",
        "uuid": "char(36)", "date": "date", "time": "time", "datetime": "datetime", "datetime.mysqltimestamp": "timestamp", "spatial": "geometry", "boolean": "tinyint(1)",
        "integer.8bit": "tinyint", "integer.16bit": "smallint", "integer.24bit": "mediumint", "integer": "int", "integer.64bit": "bigint",
        "integer.unsigned.8bit": "tinyint unsigned", "integer.unsigned.16bit": "smallint unsigned", "integer.unsigned.24bit": "mediumint unsigned",
        "integer.unsigned": "int unsigned", "integer.unsigned.64bit": "bigint unsigned", "decimal": "decimal", "float": "double", "float.32bit": "float",
    },
    "postgresql": {
        "binary": "bytea", "text": "text", "text.varchar": "character varying", "text.fixed": "character", "json": "json", "json.binary": "jsonb", "uuid": "uuid", "date": "date",
        "time": "time", "time.tz": "time with time zone", "datetime": "timestamp", "datetime.tz": "timestamp with time zone", "spatial": "geometry", "spatial.geography": "geography",
        "boolean": "boolean", "integer.16bit": "smallint", "integer": "integer", "integer.64bit": "bigint", "decimal": "numeric", "float": "double precision", "float.32bit": "real",
    },
    "derby": {
        "binary": "blob", "binary.varbinary": "varchar for bit data", "text": "clob", "text.varchar": "varchar", "text.fixed": "char", "uuid": "char(36)", "date": "date", "time": "time",
        "datetime": "timestamp", "boolean": "boolean", "integer.16bit": "smallint", "integer": "integer", "integer.64bit": "bigint", "decimal": "decimal", "float": "double", "float.32bit": "real",
    },
}
SIZED = {"text.varchar", "text.fixed", "binary.varbinary", "binary.fixed"}
QUOTES = {"mysql": "`"}


def quoted(name: str, dialect: str) -> str:
    q = QUOTES.get(dialect, '"')
    return q + name.replace(q, q * 2) + q


def unquoted(name: str) -> str:
    """An identifier without its quotes and without the schema before it."""
    parts = re.findall(r'"(?:[^"]|"")*"|`(?:[^`]|``)*`|[^.]+', name.strip())
    last = parts[-1] if parts else ""
    return last[1:-1].replace(last[0] * 2, last[0]) if last[:1] in ('"', "`") else last


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def type_sql(column: ColumnDef, dialect: str) -> str:
    if column.type_name == "enum":
        return f"enum({','.join(map(literal, column.enum_values))})" if dialect == "mysql" else quoted(enum_name(column), dialect) if dialect == "postgresql" and column.enum_values else "character varying"
    if column.type_name.endswith("_specific"):
        return column.subtype
    if column.type_name not in SPELLINGS[dialect]:
        raise ValueError(f"{dialect} has no type for {column.type_name} column {column.name}")
    name = SPELLINGS[dialect][column.type_name]
    if column.type_name == "decimal" and column.size:
        return f"{name}({column.size},{column.scale})"
    if column.type_name in SIZED and column.size:
        first, _, rest = name.partition(" ")
        return f"{first}({column.size}) {rest}".strip() if dialect == "derby" else f"{name}({column.size})"
    return name


def enum_name(column: ColumnDef) -> str:
    """The name of an enum's type: its own, or one that depends on its labels alone, as functions.scalars.enum_type_name gives it."""
    return column.subtype or f"enum_{hashlib.sha256(','.join(column.enum_values).encode()).hexdigest()[:8]}"


def enum_type_sql(table: TableDef, dialect: str, schema: str = "") -> list[str]:
    """What makes PostgreSQL's enum types of a table, unless they are there; others have none."""
    out = []
    for c in table.columns if dialect == "postgresql" else ():
        if c.type_name == "enum" and c.enum_values:
            made = f"CREATE TYPE {qualified(enum_name(c), dialect, schema)} AS ENUM ({', '.join(map(literal, c.enum_values))})"
            out.append(f"DO $$ BEGIN {made}; EXCEPTION WHEN duplicate_object THEN NULL; END $$")
    return list(dict.fromkeys(out))


def default_sql(column: ColumnDef, dialect: str) -> str:
    """What follows the type: the default, the identity or the generating expression; empty if there is none."""
    kind, value = column.default_kind, column.default_value
    if kind == Default.NONE:
        return ""
    if kind == Default.VALUE:
        plain = column.type_name.startswith(("integer", "decimal", "float")) and re.fullmatch(r"-?\d+(\.\d+)?", value)
        if column.type_name == "boolean" and dialect != "mysql":
            return f"DEFAULT {value}"
        return f"DEFAULT {value if plain else literal(value)}"
    if kind == Default.EXPRESSION:
        return f"DEFAULT {value}" + (" ON UPDATE CURRENT_TIMESTAMP" if column.auto_update and dialect == "mysql" else "")
    if kind == Default.SEQUENCE and dialect == "postgresql":
        return f"DEFAULT nextval({literal(quoted(value, dialect))}::regclass)"
    if kind in (Default.SEQUENCE, Default.IDENTITY_ALWAYS, Default.IDENTITY_BY_DEFAULT):
        return "AUTO_INCREMENT" if dialect == "mysql" else f"GENERATED {'ALWAYS' if kind == Default.IDENTITY_ALWAYS else 'BY DEFAULT'} AS IDENTITY"
    return f"GENERATED ALWAYS AS ({value})" + ("" if dialect == "derby" else " STORED" if kind == Default.GENERATED_STORED else " VIRTUAL")


def column_sql(column: ColumnDef, dialect: str) -> str:
    return " ".join(x for x in (quoted(column.name, dialect), type_sql(column, dialect), default_sql(column, dialect), "" if column.nullable else "NOT NULL") if x)


def qualified(name: str, dialect: str, schema: str = "") -> str:
    return f"{quoted(schema, dialect)}." * bool(schema) + quoted(name, dialect)


def key_sql(table: TableDef, key, dialect: str, schema: str = "") -> str:
    """An index lies in its table's schema; Derby wants that said, others don't allow it."""
    kind = {"unique": "UNIQUE INDEX", "spatial": "SPATIAL INDEX" if dialect == "mysql" else "INDEX"}.get(key.kind.value, "INDEX")
    using = " USING gist" if key.kind.value == "spatial" and dialect == "postgresql" else ""
    name = qualified(key.name, dialect, schema if dialect == "derby" else "")
    return f"CREATE {kind} {name} ON {qualified(table.name, dialect, schema)}{using} ({', '.join(quoted(c, dialect) for c in key.columns)})"


def create_table_sql(table: TableDef, dialect: str, schema: str = "") -> list[str]:
    parts = [column_sql(c, dialect) for c in table.columns]
    if table.primary_key:
        parts.append(f"PRIMARY KEY ({', '.join(quoted(c, dialect) for c in table.primary_key)})")
    return [f"CREATE TABLE {qualified(table.name, dialect, schema)} ({', '.join(parts)})", *[key_sql(table, k, dialect, schema) for k in table.keys]]


def action_sql(action: Action, table: TableDef, dialect: str, schema: str = "") -> list[str]:
    """The statements of an action on a table of `schema` (the default one if empty) whose definition afterwards is `table`."""
    t, name = qualified(table.name, dialect, schema), quoted(action.name, dialect) if action.name else ""
    alter = f"ALTER TABLE {t} ALTER COLUMN {name}"
    if action.kind in ("create_table", "recreate_table"):
        return [f"DROP TABLE {t}"] * (action.kind == "recreate_table") + create_table_sql(table, dialect, schema)
    if action.kind == "drop_table":
        return [f"DROP TABLE {t}"]
    if action.kind == "drop_column":
        return [f"ALTER TABLE {t} DROP COLUMN {name}"]
    if action.kind == "drop_key":
        return [f"DROP INDEX {name} ON {t}" if dialect == "mysql" else f"DROP INDEX {qualified(action.name, dialect, schema)}"]
    if action.kind == "create_key":
        return [key_sql(table, action.value, dialect, schema)]
    column = table.column(action.name)
    if action.kind == "add_column":
        filled = "" if action.value is None or column.default_kind != Default.NONE else " DEFAULT " + (str(action.value) if isinstance(action.value, (bool, int)) else literal(str(action.value)))
        parts = [name, type_sql(column, dialect) + filled, default_sql(column, dialect), "" if column.nullable else "NOT NULL"]
        out = [f"ALTER TABLE {t} ADD COLUMN {' '.join(x for x in parts if x)}"]
        return out + [f"{alter} DROP DEFAULT"] * bool(filled)
    if action.kind == "fill_nulls":
        value = str(action.value) if isinstance(action.value, (bool, int)) else literal(str(action.value))
        return [f"UPDATE {t} SET {name} = {value} WHERE {name} IS NULL"]
    if dialect == "mysql":
        return [f"ALTER TABLE {t} MODIFY {column_sql(column, dialect)}"]
    if action.kind == "set_nullable":
        return [f"{alter} {'NULL' if dialect == 'derby' else 'DROP NOT NULL'}"]
    if action.kind == "set_not_null":
        return [f"{alter} {'NOT NULL' if dialect == 'derby' else 'SET NOT NULL'}"]
    if action.kind == "set_default":
        text = default_sql(column, dialect)
        return [f"{alter} SET {text}" if text else f"{alter} DROP DEFAULT"]
    raise ValueError(f"action {action.kind!r}")


def read_default(text: str | None, dialect: str, extra: str = "", numeric: bool = False) -> tuple[Default, str]:
    """(kind, value) of a default as a catalog shows it.  extra: MySQL's EXTRA column.  numeric: of a column of numbers."""
    if "auto_increment" in extra.lower():
        return Default.SEQUENCE, ""
    if text is None or text.strip().upper() == "NULL":
        return Default.NONE, ""
    if "generated" in extra.lower() and "default_generated" not in extra.lower():
        return (Default.GENERATED_STORED if "stored" in extra.lower() else Default.GENERATED_VIRTUAL), text
    if m := re.fullmatch(r"nextval\('(.+)'::regclass\)", text, re.I):
        return Default.SEQUENCE, unquoted(m[1].replace("''", "'"))
    if "GENERATED_BY_DEFAULT" in text or text.startswith("AUTOINCREMENT"):
        return Default.IDENTITY_BY_DEFAULT, ""
    if m := re.fullmatch(r"'((?:[^']|'')*)'(?:::[\w \"().,\[\]]+)?", text, re.S):
        return Default.VALUE, m[1].replace("''", "'")
    if m := re.fullmatch(r"\(?(-?\d+(?:\.\d+)?)\)?(?:::[\w ]+)?", text):
        return Default.VALUE, m[1]
    if text.lower() in ("true", "false"):
        return Default.VALUE, text.lower()
    if dialect == "mysql" and not numeric and not re.match(r"(?i)current_timestamp|now\(|\(", text) and "default_generated" not in extra.lower():
        return Default.VALUE, text  # MySQL shows strings without quotes
    return Default.EXPRESSION, re.sub(r"(?i)^(current_timestamp|now)(?:\(\))?$", "CURRENT_TIMESTAMP", text)


def missing_schemas(tables: tuple[TableDef, ...], existing: list[str], search_path: list[str]) -> list[str]:
    """Schemas that tables need and the database lacks; tables without a schema need one of the search path."""
    out = sorted({t.schema for t in tables if t.schema} - set(existing))
    if any(not t.schema for t in tables) and search_path and not set(search_path) & set(existing):
        out.append(search_path[0])
    return out
