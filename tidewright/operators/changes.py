"""Keyed changes: last change wins, insert, update, upsert, insert-ignore, delete, and ordered replay of mixed operations.

Changes are reduced to one row a key before the join with the target, so the join moves each key once. Each operator
returns the new target (and rejects where rows can fail); publishing it is the sinks' work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_per_key(df: DataFrame, keys: list[str], seq: str | list[str]) -> DataFrame:
    """The row with the largest ``seq`` of each key, by a grouping with partial maxima."""
    order = [seq] if isinstance(seq, str) else seq
    top = F.max_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(top.alias("_r")).select("_r.*")


def first_per_key(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.col(seq)).alias("_r")).select("_r.*")


def _matched(target: DataFrame, source: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Target and source side by side as structs t and s, null where absent. Null keys match nothing."""
    t = target.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.struct(*target.columns).alias("t"))
    s = source.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.struct(*source.columns).alias("s"))
    return t.join(s, [f"_k{i}" for i in range(len(keys))], how)


def _set(target: DataFrame, source: DataFrame, keys: list[str], ignore_null: bool) -> list[Column]:
    """The target's columns with the source's values where a source row matches."""
    out = []
    for c in target.columns:
        if c in keys or c not in source.columns:
            out.append(F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")) if c in source.columns else F.col(f"t.{c}"))
            out[-1] = out[-1].alias(c)
            continue
        new = F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")) if ignore_null else F.col(f"s.{c}")
        out.append(F.when(F.col("s").isNotNull(), new.cast(target.schema[c].dataType)).otherwise(F.col(f"t.{c}")).alias(c))
    return out


def update(target: DataFrame, source: DataFrame, keys: list[str], ignore_null: bool = False) -> DataFrame:
    """Sets the source's columns where keys match; other source rows have no effect."""
    if not keys:
        raise ValueError("an update needs a key")
    return _matched(target, source, keys, "left").select(*_set(target, source, keys, ignore_null))


def upsert(target: DataFrame, source: DataFrame, keys: list[str], ignore_null: bool = False) -> DataFrame:
    """Sets or creates rows; columns that the source lacks are null in new rows."""
    return _matched(target, source, keys, "full_outer").select(*_set(target, source, keys, ignore_null))


def insert(target: DataFrame, source: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(new target, rejects): source rows whose key is in the target, or comes more than once, are rejected."""
    twice = source.groupBy(*keys).agg(F.count("*").alias("_n"))
    known = target.select(*keys).distinct().withColumn("_there", F.lit(True))
    marked = source.join(twice, keys).join(known, keys, "left")
    bad = F.col("_there").isNotNull() | (F.col("_n") > 1)
    new = marked.where(~bad).select(*source.columns)
    rejects = marked.where(bad).select(*source.columns).withColumn("_error", F.lit("duplicate key"))
    return target.unionByName(new.select(*[c for c in target.columns if c in source.columns]), allowMissingColumns=True), rejects


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str], seq: str | None = None) -> DataFrame:
    """Adds source rows with new keys, the first of each key by ``seq``."""
    one = first_per_key(source, keys, seq) if seq else source.dropDuplicates(keys)
    new = one.join(target.select(*keys).distinct(), keys, "left_anti")
    return target.unionByName(new.select(*[c for c in target.columns if c in source.columns]), allowMissingColumns=True)


def delete_rows(target: DataFrame, source: DataFrame) -> DataFrame:
    """Removes rows that equal a source row in all its columns, null equalling null."""
    t, s = target.alias("t"), source.distinct().alias("s")
    same = None
    for c in source.columns:
        one = F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))
        same = one if same is None else same & one
    return t.join(s, same, "left_anti")


def delete_keys(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(source.select(*keys).distinct(), keys, "left_anti")


def replay(target: DataFrame, changes: DataFrame, keys: list[str], seq: str, op: str = "_op", ignore_null: bool = False, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(new target, rejects) of changes with an operation each, applied in ``seq`` order.

    INSERT of a present key is rejected. UPDATE and DELETE of an absent key have no effect, or with ``strict`` are
    rejected; the _IGNORE forms never are. A null key and an unknown operation are rejected. A change carries all target
    columns; ``seq`` isn't null and differs between a key's changes.

    Whether a key is there before a change follows from the last change before it that set or removed it, which a
    window tells row by row; what the key holds in the end is the last change that set it, by partial maxima. So no
    key's changes are gathered in one row, however many a hot key has.
    """
    values = [c for c in target.columns if c not in keys]
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    bad_keys = changes.where(null_key).withColumn("_error", F.lit("null key"))
    kind = F.col(op)
    insert_, update_, delete_ = kind.isin("INSERT", "INSERT_IGNORE"), kind.isin("UPDATE", "UPDATE_IGNORE"), kind.isin("DELETE", "DELETE_IGNORE")
    effect = F.when(insert_ | (kind == "UPSERT"), True).when(delete_, False)
    base = target.select(*keys, F.struct(*values).alias("_base"))
    before = Window.partitionBy(*keys).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy(*keys).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    told = changes.where(~null_key).join(target.select(*keys, F.lit(True).alias("_present")), keys, "left")
    told = told.withColumn("_effect", effect).withColumn("_there", F.coalesce(F.last("_effect", True).over(before), "_present", F.lit(False)))
    there = F.col("_there")
    error = F.when((kind == "INSERT") & there, F.lit("duplicate key"))
    if strict:
        error = F.coalesce(error, F.when(kind.isin("UPDATE", "DELETE") & ~there, F.lit("no such key")))
    error = F.coalesce(error, F.when(~F.coalesce(insert_ | update_ | delete_ | (kind == "UPSERT"), F.lit(False)), F.lit("no operation")))
    rejects = told.withColumn("_error", error).where(F.col("_error").isNotNull()).select(*changes.columns, "_error").unionByName(bad_keys)

    sets = insert_ & ~there | update_ & there | (kind == "UPSERT")
    # a life begins with each row that is created and each removal; the target's own row is life 0
    lives = told.withColumn("_sets", sets).withColumn("_life", F.sum(F.when(sets & ~there | delete_, 1).otherwise(0)).over(so_far))
    row = F.struct(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in values])
    at = lambda what: F.struct(F.col("_life").alias("life"), F.col(seq).alias("seq"), what.alias("what"))
    if ignore_null:
        last = [F.max_by(F.struct(F.col("_life").alias("life"), F.col(c).cast(target.schema[c].dataType).alias("v")), F.when(F.col("_sets") & F.col(c).isNotNull(), F.struct("_life", seq))).alias(f"_v{i}") for i, c in enumerate(values)]
    else:
        last = [F.max_by(at(row), F.when(F.col("_sets"), F.struct("_life", seq))).alias("_row")]
    final = lives.groupBy(*keys).agg(F.max_by("_effect", F.when(F.col("_effect").isNotNull(), F.col(seq))).alias("_alive"), F.max("_life").alias("_last"), *last)
    joined = base.join(final, keys, "full_outer").where(F.coalesce("_alive", F.col("_base").isNotNull()))
    own = lambda c: F.when(F.coalesce("_last", F.lit(0)) == 0, F.col(f"_base.{c}"))
    if ignore_null:
        out = [F.when(F.col(f"_v{i}.life") == F.col("_last"), F.col(f"_v{i}.v")).otherwise(own(c)).alias(c) for i, c in enumerate(values)]
    else:
        out = [F.when(F.col("_row.life") == F.col("_last"), F.col(f"_row.what.{c}")).otherwise(own(c)).alias(c) for c in values]
    return joined.select(*keys, *out).select(*target.columns), rejects


def apply_changes(target: DataFrame, changes: DataFrame, keys: list[str], mode: str, seq: str | None = None, **options) -> DataFrame:
    """The new target for changes of one kind."""
    one = last_per_key(changes, keys, seq) if seq and mode in ("UPDATE", "UPSERT") else changes
    if seq and mode in ("UPDATE", "UPSERT") and seq not in target.columns:
        one = one.drop(seq)
    if mode == "INSERT":
        return insert(target, one, keys)[0]
    if mode == "INSERT_IGNORE":
        return insert_ignore(target, one, keys, seq)
    if mode == "DELETE":
        return delete_rows(target, one.select(*[c for c in target.columns if c in one.columns]))
    return {"UPDATE": update, "UPSERT": upsert}[mode](target, one, keys, **options)
