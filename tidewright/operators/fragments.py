"""Fragments, pages and offsets of ordered results, without a single-partition window."""

from __future__ import annotations

import datetime
import decimal
import uuid
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.operators.staged import staged


def _numbered(df: DataFrame, order_by: list[Column | str]) -> tuple[DataFrame, int]:
    """``df`` with ``_index``, and the number of rows."""
    spark = df.sparkSession
    sorted_ = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by) if order_by else df
    table = staged(sorted_, "ordered")
    placed = table.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    counts = placed.groupBy("_file").agg(F.count("*").alias("_n")).collect()  # a row a file, at most one for each shuffle partition
    counts.sort(key=lambda r: ([int(x) for x in r["_file"].split("-")[1:2]], r["_file"]))  # by task, then by file of a task
    before = [0, *accumulate(r["_n"] for r in counts)]
    starts = spark.createDataFrame([(r["_file"], n) for r, n in zip(counts, before, strict=False)], "_file string, _start long")
    return placed.join(F.broadcast(starts), "_file").withColumn("_index", F.col("_start") + F.col("_row")).drop("_file", "_row", "_start"), before[-1]


def with_index(df: DataFrame, order_by: list[Column | str]) -> DataFrame:
    """``df`` with ``_index``, each row's place in a total order, from 0.

    Rows are range-partitioned, sorted and written once, in the folder of ``spark.checkpoint.dir``. A row's place is its
    place in its file and the number of rows in the files before, so numbers follow from what was written: they hold
    however readers split and join partitions, and tied rows keep theirs when a task runs again. Without ``order_by``
    rows are numbered as they come.
    """
    return _numbered(df, order_by)[0]


def fragments(df: DataFrame, max_rows: int, order_by: list[Column | str], max_fragments: int = 0, identifier: str | None = None) -> DataFrame:
    """``df`` with fragment_identifier, fragment_index (from 0) and fragment_count; ``max_fragments`` ends early (0: never)."""
    rows, n = _numbered(df, order_by)
    placed = rows.withColumn("fragment_index", F.floor(F.col("_index") / max_rows))
    count = -(-n // max_rows)
    if max_fragments:
        placed, count = placed.where(F.col("fragment_index") < max_fragments), min(count, max_fragments)
    return placed.withColumn("fragment_count", F.lit(count).cast("long")).withColumn("fragment_identifier", F.lit(identifier or uuid.uuid4().hex)).drop("_index")


def range_page(df: DataFrame, column: str, offset: int, limit: int) -> DataFrame:
    """Rows with offset <= column < offset + limit: a filter that reaches the scan."""
    return df.where((F.col(column) >= offset) & (F.col(column) < offset + limit))


def page(df: DataFrame, order_by: list[Column | str], limit: int | None = None, offset: int = 0) -> DataFrame:
    out = df.orderBy(*order_by)
    out = out.offset(offset) if offset else out
    return out.limit(limit) if limit is not None else out


def range_predicates(column: str, lower: int, upper: int, parts: int) -> list[str]:
    """Disjoint predicates that together take every value and null, for as many parallel cursors."""
    step = max(1, -(-(upper - lower) // parts))
    return _between(column, list(range(lower + step, upper, step)))


def _between(column: str, cuts: list) -> list[str]:
    """Predicates for the ranges that ``cuts`` (rising, each the first value of its range) leave; null is in the first."""
    edges = [None, *map(_literal, cuts), None]
    out = []
    for a, b in zip(edges, edges[1:], strict=False):
        parts = ([f"{column} >= {a}"] if a is not None else []) + ([f"{column} < {b}"] if b is not None else [])
        text = " AND ".join(parts) or "1 = 1"
        out.append(f"({text} OR {column} IS NULL)" if a is None else text)
    return out


def _literal(value) -> str:
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value}'"
    if isinstance(value, (bool, int, float, decimal.Decimal)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def balanced_predicates(df: DataFrame, column: str, parts: int, then: str | None = None, accuracy: int = 100_000) -> list[str]:
    """Disjoint predicates that together take every row once, each with about as many rows as any other.

    The cuts are an equi-depth histogram of the column (one pass with partial aggregates), so a skewed key gets narrow
    ranges where its rows are. A value that fills several ranges by itself stands alone, and is cut by the column
    ``then``, if given, in the same way. Works for numbers, dates and timestamps.
    """
    cuts = _quantiles(df, column, parts, accuracy)
    hot = {v: cuts.count(v) for v in dict.fromkeys(cuts) if cuts.count(v) > 1}
    if not hot:
        return _between(column, sorted(set(cuts)))
    singles = sorted({v for v in cuts if v not in hot})
    out = []
    for low, high in zip([None, *sorted(hot)], [*sorted(hot), None], strict=True):
        inner = [v for v in singles if (low is None or v > low) and (high is None or v < high)]
        for a, b in zip([None, *inner], [*inner, None], strict=True):
            sides = [("> ", low) if a is None else (">= ", a), ("< ", high if b is None else b)]
            out.append("(" + " AND ".join(f"{column} {sign}{_literal(v)}" for sign, v in sides if v is not None) + ")")
        if high is not None:
            same = f"{column} = {_literal(high)}"
            more = _between(then, sorted(set(_quantiles(df.where(same), then, hot[high] + 1, accuracy)))) if then else []
            out.extend(f"({same} AND {x})" for x in more) if more else out.append(same)
    return [f"({out[0]} OR {column} IS NULL)", *out[1:]]


def _quantiles(df: DataFrame, column: str, parts: int, accuracy: int) -> list:
    """The values at the borders of ``parts`` equal shares of the rows; repeated where one value holds several."""
    kind, at = df.schema[column].dataType, [k / parts for k in range(1, parts)]
    if not at:
        return []
    return df.agg(F.percentile_approx(F.col(column), at, accuracy).cast(f"array<{kind.simpleString()}>").alias("q")).first()["q"] or []
