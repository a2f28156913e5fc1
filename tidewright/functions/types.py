"""The type lattice: wider types, schema merging, SQL type codes, DDL text and numeric-fit checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The order in which a text is tried as a type, narrowest first.
LATTICE = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "decimal(38,18)", "date", "timestamp", "string")
_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
#: Decimal digits that every value of a whole type fits in.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}

#: JDBC type codes.
SQL_TYPE_CODES = {"boolean": 16, "tinyint": -6, "smallint": 5, "int": 4, "bigint": -5, "float": 6, "double": 8, "decimal": 3, "string": 12, "binary": -3, "date": 91, "time": 92, "timestamp": 93, "array": 2003, "struct": 2002, "map": 2000}
TYPES_BY_CODE = {v: k for k, v in SQL_TYPE_CODES.items()} | {-7: "boolean", 7: "float", 2: "decimal", 1: "string", -1: "string", -9: "string", -15: "string", -16: "string", 2005: "string", 2009: "string", -2: "binary", -4: "binary", 2004: "binary", 2014: "timestamp"}


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrower of the types that hold both, or None where only a union (variant or text) does."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    kinds = {type(a), type(b)}
    if kinds <= set(_WHOLE):
        return max(a, b, key=lambda x: _WHOLE.index(type(x)))
    if all(isinstance(x, T.DecimalType) for x in (a, b)):
        return T.DecimalType(max(a.precision, b.precision), max(a.scale, b.scale))
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.DecimalType):
            if type(y) in _DIGITS:
                return T.DecimalType(min(38, max(x.precision, _DIGITS[type(y)] + x.scale)), x.scale)
            if isinstance(y, (T.FloatType, T.DoubleType)):
                return x
        if isinstance(x, T.DoubleType) and (type(y) in _DIGITS or isinstance(y, T.FloatType)):
            return x
        if isinstance(x, T.FloatType) and type(y) in _DIGITS:
            return x
        if isinstance(x, T.StringType) and isinstance(y, (T.VarcharType, T.CharType)):
            return T.StringType()
        if isinstance(x, T.TimestampType) and isinstance(y, T.DateType):
            return x
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = wider(a.elementType, b.elementType)
        return element and T.ArrayType(element, a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        value = wider(a.valueType, b.valueType)
        return value and T.MapType(a.keyType, value, a.valueContainsNull or b.valueContainsNull)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged(a, b)
    return None


def merged(a: T.StructType, b: T.StructType) -> T.StructType:
    """The ordered union of two schemas: nullable if either is or has no such field, aliases united, first default kept.

    Fields whose types have no wider type become text.
    """
    out = []
    theirs = {f.name: f for f in b.fields}
    for f in a.fields:
        g = theirs.pop(f.name, None)
        if g is None:
            out.append(T.StructField(f.name, f.dataType, True, f.metadata))
            continue
        meta = {**(g.metadata or {}), **(f.metadata or {})}
        names = list(dict.fromkeys([*(f.metadata or {}).get("aliases", []), *(g.metadata or {}).get("aliases", [])]))
        if names:
            meta["aliases"] = names
        out.append(T.StructField(f.name, wider(f.dataType, g.dataType) or T.StringType(), f.nullable or g.nullable, meta))
    out += [T.StructField(g.name, g.dataType, True, g.metadata) for g in b.fields if g.name in theirs]
    return T.StructType(out)


def union_by_merged_schema(a: DataFrame, b: DataFrame) -> DataFrame:
    """The rows of both under their merged schema."""
    schema = merged(a.schema, b.schema)
    cast = lambda df: df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name in df.columns])
    return cast(a).unionByName(cast(b), allowMissingColumns=True)


def fits_float(c: Column) -> Column:
    """Whether a whole number survives as a float."""
    return F.abs(c) <= F.lit(2**24)


def fits_double(c: Column) -> Column:
    """Whether a whole number survives as a double."""
    return F.abs(c) <= F.lit(2**53)


def in_float_range(c: Column) -> Column:
    """Whether a double is inside the range of floats."""
    return F.abs(c) <= F.lit(3.4028234663852886e38)


#: What a text of a number, of a date or of a time begins with, after white space and controls.
_NUMBER = r"^[\x00-\x20\x7f]*([-+.\p{Nd}]|(?i:nan|inf))"
_TIME = r"^[\x00-\x20\x7f]*[-+]?([0-9]|[tT][0-9])"


def compatible(c: Column, kind: str) -> Column:
    """Whether a text can become ``kind``; null can. A text that begins like none isn't cast, as a failing cast costs an
    exception."""
    if kind == "string":
        return F.lit(True)
    if kind == "boolean":
        return c.isNull() | F.lower(c).isin("true", "false")
    return c.isNull() | F.when(c.rlike(_TIME if kind in ("date", "timestamp") else _NUMBER), c.try_cast(kind)).isNotNull()


def infer_columns(df: DataFrame, columns: list[str] | None = None, kinds: tuple[str, ...] = LATTICE) -> DataFrame:
    """One row a column: the narrowest type that all its trimmed texts can become. One pass, one row out of each task."""
    columns = columns or df.columns
    tests = [F.bool_and(compatible(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), k)).alias(f"{i}_{j}") for i, c in enumerate(columns) for j, k in enumerate(kinds)]
    found = df.agg(*tests)
    pick = lambda i: F.coalesce(*[F.when(F.coalesce(F.col(f"{i}_{j}"), F.lit(True)), F.lit(k)) for j, k in enumerate(kinds)])
    return found.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), pick(i).alias("type_name")) for i, c in enumerate(columns)])).alias("x")).select("x.*")


def infer_json(df: DataFrame, column: str, by: list[str] = ()) -> DataFrame:
    """The merged type of all JSON texts of a column, in all or by group."""
    return df.groupBy(*by).agg(F.schema_of_variant_agg(F.parse_json(F.col(column))).alias("type_name"))


def hive_ddl(schema: T.StructType, table: str, external: bool = False, stored_as: str = "ORC") -> str:
    """CREATE TABLE text with Hive type names, names lowered and sanitised."""
    from tidewright.functions.text import table_identifier

    columns = ", ".join(f"`{f.name.lower()}` {f.dataType.simpleString().upper()}" for f in schema.fields)
    return f"CREATE {'EXTERNAL ' if external else ''}TABLE IF NOT EXISTS {table_identifier(table)} ({columns}) STORED AS {stored_as}"
