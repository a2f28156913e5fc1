"""SQL sources: queries with bound parameters, statements before and after, and JDBC reads by disjoint ranges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions import coerce
from tidewright.functions.text import statements
from tidewright.functions.types import TYPES_BY_CODE
from tidewright.operators.fragments import range_predicates


def parameter(code: int, text: str | None, form: str = "") -> Column:
    """A typed literal from a JDBC type code and text: bytes by ascii, hex or base64, times by pattern or epoch millis."""
    kind = TYPES_BY_CODE[code]
    value = F.lit(text)
    if kind == "binary":
        return coerce.to_binary(value, form or "ascii")
    if kind == "boolean":
        return coerce.to_boolean(value)
    if kind == "timestamp":
        return coerce.to_timestamp(value, form or None)
    if kind == "date":
        return coerce.to_date(value, form or None) if form or (text or "").lstrip("-").isdigit() else F.try_to_timestamp(value, F.lit("yyyy-MM-dd")).cast("date")
    return value.try_cast("decimal(38,18)" if kind == "decimal" else kind)


def parameters(spark: SparkSession, attributes: dict[str, str]) -> list[object]:
    """Values of ``sql.args.N.type / value / format``, in order of N."""
    numbers = sorted({int(k.split(".")[2]) for k in attributes if k.startswith("sql.args.")})
    at = lambda n, part: attributes.get(f"sql.args.{n}.{part}")
    if not numbers:
        return []
    typed = [parameter(int(at(n, "type")), at(n, "value"), at(n, "format") or "").alias(str(n)) for n in numbers]
    return list(spark.range(1).select(*typed).first())


def sql_source(spark: SparkSession, query: str, params: list[object] | dict[str, object] | None = None, pre: str = "", views: dict[str, DataFrame] | None = None) -> DataFrame:
    """A query over tables and views, after the ``pre`` statements. Catalyst plans what the text asks for."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    for statement in statements(pre):
        spark.sql(statement)
    return spark.sql(query, args=params) if params else spark.sql(query)


def with_post(spark: SparkSession, df: DataFrame, sink: Callable[[DataFrame], None], post: str = "") -> None:
    """Writes, then runs the ``post`` statements."""
    sink(df)
    for statement in statements(post):
        spark.sql(statement)


def jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None, column: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 8, fetch_rows: int = 1000, timeout_s: int = 0, properties: dict[str, str] | None = None) -> DataFrame:
    """A remote table or query; with a column and its bounds, one cursor for each of so many ranges."""
    options = {"fetchsize": str(fetch_rows), "queryTimeout": str(timeout_s), **(properties or {})}
    if table and column and bounds:
        return spark.read.jdbc(url, table, predicates=range_predicates(column, *bounds, parts), properties=options)
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    return (reader.option("query", query) if query else reader.option("dbtable", table)).load()


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 1000, properties: dict[str, str] | None = None, mode: str = "append") -> None:
    """Batched inserts, each partition in its own transaction, values bound and nulls kept."""
    df.write.jdbc(url, table, mode=mode, properties={"batchsize": str(batch), **(properties or {})})


def extract_csv(df: DataFrame, path: str, chunk_rows: int, **options) -> None:
    """CSV files of at most so many rows, all values as text, none lost at a chunk's end."""
    df.select(*[F.col(c).cast("string") for c in df.columns]).write.option("maxRecordsPerFile", chunk_rows).options(**options).csv(path)


def parquet(spark: SparkSession, path: str, pattern: str | None = None, merge_schema: bool = False) -> DataFrame:
    """Parquet files of a folder or glob."""
    reader = spark.read.option("mergeSchema", merge_schema)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(path)
