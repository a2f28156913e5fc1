"""Aligning records with a target schema: name matching, unmatched fields and columns, nested rows, defaults, aliases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.text import normal_name


class SchemaMismatch(ValueError):
    """Fields or columns that have no partner, where the policy is to fail."""


def matched_names(fields: list[str], columns: list[str], translate: bool = True) -> dict[str, str]:
    """Column to field, by upper-case names without underscores (``translate``) or exactly. Two candidates are an error."""
    key = normal_name if translate else lambda x: x
    by: dict[str, str] = {}
    for f in fields:
        if key(f) in by:
            raise SchemaMismatch(f"{by[key(f)]} and {f} have the same normal name")
        by[key(f)] = f
    return {c: by[key(c)] for c in columns if key(c) in by}


def required(field: T.StructField) -> bool:
    """Not null, without default and not generated."""
    meta = field.metadata or {}
    return not field.nullable and "default" not in meta and not meta.get("auto_increment")


def aligned(df: DataFrame, target: T.StructType, translate: bool = True, unmatched_field: str = "ignore", unmatched_column: str = "ignore", aliases: bool = True, warnings: list[str] | None = None) -> DataFrame:
    """``df`` as the target's columns in order, in one projection.

    Input fields without a column are ignored or fail; no match at all fails. Target columns without a field become
    their default or null, or (``warn``) are named in ``warnings``, or fail; required ones always fail.
    """
    names = matched_names(df.columns, target.names, translate)
    if aliases:
        for f in target.fields:
            for alias in (f.metadata or {}).get("aliases", []):
                found = matched_names(df.columns, [alias], translate)
                if f.name not in names and found:
                    names[f.name] = found[alias]
    extra = [c for c in df.columns if c not in names.values()]
    if not names:
        raise SchemaMismatch("no field matches a column")
    if extra and unmatched_field == "fail":
        raise SchemaMismatch(f"no column for {', '.join(extra)}")
    missing = [f for f in target.fields if f.name not in names]
    if needed := [f.name for f in missing if required(f)]:
        raise SchemaMismatch(f"no field for required {', '.join(needed)}")
    if missing and unmatched_column == "fail":
        raise SchemaMismatch(f"no field for {', '.join(f.name for f in missing)}")
    if missing and unmatched_column == "warn" and warnings is not None:
        warnings += [f"no field for {f.name}" for f in missing]
    return df.select(*[_column(df, names.get(f.name), f) for f in target.fields])


def _column(df: DataFrame, name: str | None, field: T.StructField) -> Column:
    default = (field.metadata or {}).get("default")
    if name is None:
        return F.lit(default).cast(field.dataType).alias(field.name)
    value = reshaped(F.col(f"`{name}`"), df.schema[name].dataType, field.dataType)
    return (F.coalesce(value, F.lit(default).cast(field.dataType)) if default is not None else value).alias(field.name)


def reshaped(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A nested value as another nested type: names match without case at each level, in any order."""
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        by = {f.name.lower(): f for f in have.fields}
        parts = [(reshaped(value.getField(by[w.name.lower()].name), by[w.name.lower()].dataType, w.dataType) if w.name.lower() in by else F.lit(None).cast(w.dataType)).alias(w.name) for w in want.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: reshaped(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.struct((e["key"] if have.keyType == want.keyType else e["key"].try_cast(want.keyType)).alias("k"), reshaped(e["value"], have.valueType, want.valueType).alias("v")))
        return F.map_from_entries(F.filter(entries, lambda e: e["k"].isNotNull()))
    return value if have == want else value.try_cast(want)


def failures(value: Column, have: T.DataType, want: T.DataType, at: str) -> Column:
    """The paths below ``at`` whose values ``reshaped`` can't coerce, and of map keys that would become null."""
    none = F.array().cast("array<string>")
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        by = {f.name.lower(): f for f in have.fields}
        parts = [failures(value.getField(by[w.name.lower()].name), by[w.name.lower()].dataType, w.dataType, f"{at}.{w.name}") for w in want.fields if w.name.lower() in by]
        return F.coalesce(F.concat(*parts), none) if parts else none
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.coalesce(F.array_distinct(F.flatten(F.transform(value, lambda x: failures(x, have.elementType, want.elementType, f"{at}[]")))), none)
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        keys = F.when(F.exists(F.map_keys(value), lambda k: k.try_cast(want.keyType).isNull()), F.array(F.lit(f"{at} key"))).otherwise(none) if have.keyType != want.keyType else none
        values = F.array_distinct(F.flatten(F.transform(F.map_values(value), lambda x: failures(x, have.valueType, want.valueType, f"{at}{{}}"))))
        return F.coalesce(F.concat(keys, values), none)
    if have == want:
        return none
    return F.when(value.isNotNull() & value.try_cast(want).isNull(), F.array(F.lit(at))).otherwise(none)


def reshaped_rows(df: DataFrame, target: T.StructType) -> DataFrame:
    """``df``'s columns as the target's nested types with ``_error``, which names the paths that can't be coerced (null:
    none); their values are null."""
    have = {f.name.lower(): f for f in df.schema.fields}
    both = [(have[w.name.lower()], w) for w in target.fields if w.name.lower() in have]
    bad = F.array_distinct(F.concat(*[failures(F.col(f"`{h.name}`"), h.dataType, w.dataType, w.name) for h, w in both]))
    error = F.when(F.size(bad) > 0, F.concat(F.lit("can't coerce "), F.array_join(bad, ", ")))
    return df.select(*[reshaped(F.col(f"`{h.name}`"), h.dataType, w.dataType).alias(w.name) for h, w in both], error.alias("_error"))


def lowered(df: DataFrame) -> DataFrame:
    """Column names in lower case; a collision is an error."""
    names = [c.lower() for c in df.columns]
    if len(set(names)) < len(names):
        raise SchemaMismatch("names collide in lower case")
    return df.toDF(*names)


def rows_at(df: DataFrame, path: str) -> DataFrame:
    """The record, or the records of an array, at a path as rows; an empty or null one is an error when read."""
    kind = df.select(path).schema[0].dataType
    value = F.col(path)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        checked = F.when(F.coalesce(F.size(value), F.lit(0)) > 0, value).otherwise(F.raise_error(F.lit(f"no record at {path}")))
        return df.select(F.explode(checked).alias("_r")).select("_r.*")
    if isinstance(kind, T.StructType):
        checked = F.when(value.isNotNull(), value).otherwise(F.raise_error(F.lit(f"no record at {path}")))
        return df.select(checked.alias("_r")).select("_r.*")
    raise SchemaMismatch(f"{path} holds no records")


#: The operations that a record may name.
OPERATIONS = ("INSERT", "UPDATE", "UPSERT", "DELETE", "INSERT_IGNORE", "UPDATE_IGNORE", "DELETE_IGNORE")


def with_operation(df: DataFrame, path: str, allowed: tuple[str, ...] = OPERATIONS) -> DataFrame:
    """``df`` with ``_op`` from a path, in upper case, and ``_error`` where that is none, or where an array at the path
    doesn't hold exactly one distinct value."""
    kind = df.select(path).schema[0].dataType
    if isinstance(kind, T.ArrayType):
        values = F.array_distinct(F.col(path))
        name, single = F.upper(F.get(values, 0)), F.size(values) == 1
    else:
        name, single = F.upper(F.col(path)), F.lit(True)
    ok = F.coalesce(name.isin(list(allowed)) & single, F.lit(False))
    return df.withColumn("_op", F.when(ok, name)).withColumn("_error", F.when(~ok, F.concat(F.lit("no operation: "), F.coalesce(F.col(path).cast("string"), F.lit("null")))))


def filled(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Nulls as the columns' defaults."""
    return df.select(*[F.coalesce(F.col(c), F.lit(defaults[c]).cast(df.schema[c].dataType)).alias(c) if c in defaults else F.col(c) for c in df.columns])


def with_static_partitions(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Partition columns from fixed values, which win over fields, as the last columns."""
    return df.drop(*values).select("*", *[F.lit(v).alias(k) for k, v in values.items()])


def null_checked(df: DataFrame, keys: list[str], not_null: list[str]) -> DataFrame:
    """``df`` with ``_error`` for null keys and for nulls in columns that hold none."""
    bad = [F.when(F.col(c).isNull(), F.lit(f"null key {c}")) for c in keys] + [F.when(F.col(c).isNull(), F.lit(f"null {c}")) for c in not_null if c not in keys]
    return df.withColumn("_error", F.nullif(F.concat_ws(", ", *bad), F.lit("")))
