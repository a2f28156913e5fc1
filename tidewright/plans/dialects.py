"""SQL text of remote dialects, by name: upsert, insert-ignore, paging, create and alter."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _text(kind: T.DataType, names: dict[type, str]) -> str:
    if isinstance(kind, T.DecimalType):
        return f"{names[T.DecimalType]}({kind.precision},{kind.scale})"
    return names[type(kind)]


_ANSI = {T.BooleanType: "BOOLEAN", T.ByteType: "SMALLINT", T.ShortType: "SMALLINT", T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.FloatType: "REAL", T.DoubleType: "DOUBLE PRECISION", T.DecimalType: "DECIMAL", T.StringType: "VARCHAR(4000)", T.BinaryType: "BLOB", T.DateType: "DATE", T.TimestampType: "TIMESTAMP"}


@dataclass(frozen=True)
class Dialect:
    """Plain SQL; upserts and insert-ignore only where the dialect has them."""

    name: str = "generic"
    quote: str = '"'

    types = _ANSI

    def page(self, table: str, columns: list[str] | None = None, where: str = "", order_by: str = "", limit: int | None = None, offset: int | None = None, part_column: str = "") -> str:
        """By range of ``part_column`` (needs a WHERE), else by order, limit and offset."""
        text = f"SELECT {', '.join(columns) if columns else '*'} FROM {table}"
        if part_column:
            if not where:
                raise ValueError("a range page needs a WHERE")
            return f"{text} WHERE {where} AND {part_column} >= {offset or 0}" + (f" AND {part_column} < {(offset or 0) + limit}" if limit is not None else "")
        text += (f" WHERE {where}" if where else "") + (f" ORDER BY {order_by}" if order_by else "")
        return text + self.limited(limit, offset)

    def limited(self, limit: int | None, offset: int | None) -> str:
        return (f" LIMIT {limit}" if limit is not None else "") + (f" OFFSET {offset}" if offset else "")

    def upsert(self, table: str, columns: list[str], keys: list[str]) -> str:
        raise NotImplementedError(f"{self.name} has no upsert")

    def insert_ignore(self, table: str, columns: list[str], keys: list[str]) -> str:
        raise NotImplementedError(f"{self.name} has no insert-ignore")

    def _insert(self, table: str, columns: list[str]) -> str:
        return f"INSERT INTO {table}({', '.join(columns)}) VALUES ({', '.join('?' * len(columns))})"

    def create(self, table: str, schema: T.StructType, keys: list[str] = ()) -> str:
        columns = [f"{f.name} {_text(f.dataType, self.types)}" + ("" if f.nullable else " NOT NULL") for f in schema.fields]
        return f"CREATE TABLE {table} ({', '.join([*columns, *([f'PRIMARY KEY ({", ".join(keys)})'] if keys else [])])})"

    def add_columns(self, table: str, fields: list[T.StructField]) -> str:
        return f"ALTER TABLE {table} " + ", ".join(f"ADD COLUMN {f.name} {_text(f.dataType, self.types)}" for f in fields)


class PostgreSQL(Dialect):
    types = _ANSI | {T.StringType: "TEXT", T.BinaryType: "BYTEA"}

    def upsert(self, table: str, columns: list[str], keys: list[str]) -> str:
        return f"{self._insert(table, columns)} ON CONFLICT ({', '.join(keys)}) DO UPDATE SET " + ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c not in keys)

    def insert_ignore(self, table: str, columns: list[str], keys: list[str]) -> str:
        return f"{self._insert(table, columns)} ON CONFLICT ({', '.join(keys)}) DO NOTHING"


class MySQL(Dialect):
    types = _ANSI | {T.StringType: "TEXT", T.DoubleType: "DOUBLE", T.TimestampType: "DATETIME(6)"}

    def upsert(self, table: str, columns: list[str], keys: list[str]) -> str:
        return f"{self._insert(table, columns)} ON DUPLICATE KEY UPDATE " + ", ".join(f"{c} = VALUES({c})" for c in columns)

    def insert_ignore(self, table: str, columns: list[str], keys: list[str]) -> str:
        return self._insert(table, columns).replace("INSERT", "INSERT IGNORE", 1)


class Oracle(Dialect):
    """ROWNUM paging, before release 12."""

    types = _ANSI | {T.BooleanType: "NUMBER(1)", T.LongType: "NUMBER(19)", T.DecimalType: "NUMBER", T.StringType: "VARCHAR2(4000)"}

    def page(self, table: str, columns: list[str] | None = None, where: str = "", order_by: str = "", limit: int | None = None, offset: int | None = None, part_column: str = "") -> str:
        if part_column or limit is None:
            return super().page(table, columns, where, order_by, limit, offset, part_column)
        inner = Dialect.page(Dialect(), table, columns, where, order_by)
        return f"SELECT * FROM (SELECT a.*, ROWNUM rnum FROM ({inner}) a WHERE ROWNUM <= {(offset or 0) + limit}) WHERE rnum > {offset or 0}"

    def add_columns(self, table: str, fields: list[T.StructField]) -> str:
        return f"ALTER TABLE {table} ADD (" + ", ".join(f"{f.name} {_text(f.dataType, self.types)}" for f in fields) + ")"


class Oracle12(Oracle):
    page = Dialect.page

    def limited(self, limit: int | None, offset: int | None) -> str:
        return (f" OFFSET {offset} ROWS" if offset else "") + (f" FETCH NEXT {limit} ROWS ONLY" if limit is not None else "")

    def upsert(self, table: str, columns: list[str], keys: list[str]) -> str:
        source = ", ".join(f"? {c}" for c in columns)
        match = " AND ".join(f"t.{k} = n.{k}" for k in keys)
        sets = ", ".join(f"t.{c} = n.{c}" for c in columns if c not in keys)
        return f"MERGE INTO {table} t USING (SELECT {source} FROM DUAL) n ON ({match}) WHEN MATCHED THEN UPDATE SET {sets} WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) VALUES ({', '.join(f'n.{c}' for c in columns)})"


class Derby(Dialect):
    types = _ANSI | {T.StringType: "CLOB"}


REGISTRY: dict[str, Dialect] = {}


def register(name: str, dialect: Dialect) -> None:
    REGISTRY[name.lower()] = dialect


def dialect(name: str) -> Dialect:
    return REGISTRY[name.lower()]


for _name, _kind in (("generic", Dialect), ("postgresql", PostgreSQL), ("mysql", MySQL), ("oracle", Oracle), ("oracle12", Oracle12), ("derby", Derby)):
    register(_name, _kind(_name, "`" if _name == "mysql" else '"'))
