"""Remote tables: a distributed write into a staging table, then one statement on the server.

A server that executors can't reach, but that can read files, takes and gives tables as files in the folder that driver
and executors share (``load_files``, ``unload_files``): executors write and read them, and the server imports and exports
them one by one. The two use Derby's procedures.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.operators.fragments import range_predicates
from tidewright.operators.staged import shared_folder
from tidewright.plans.dialects import dialect
from tidewright.sinks.tables import fetch, names_in, remove, store
from tidewright.sources.sql import jdbc, write_jdbc


def execute(spark: SparkSession, url: str, statement: str, properties: dict[str, str] | None = None) -> int:
    """Runs a statement on the server; returns its update count."""
    given = spark._jvm.java.util.Properties()
    for key, value in (properties or {}).items():
        if key == "driver":
            spark._jvm.java.lang.Class.forName(value)
        else:
            given.setProperty(key, value)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, given)
    try:
        return connection.createStatement().executeUpdate(statement)
    finally:
        connection.close()


def merge_text(table: str, stage: str, columns: list[str], keys: list[str], update: bool = True) -> str:
    """MERGE of a staging table with quoted names; without ``update``, present keys are left alone."""
    q = lambda c: f'"{c}"'
    match = " AND ".join(f"t.{q(k)} = s.{q(k)}" for k in keys)
    sets = ", ".join(f"{q(c)} = s.{q(c)}" for c in columns if c not in keys)
    matched = f" WHEN MATCHED THEN UPDATE SET {sets}" if update and sets else ""
    return f"MERGE INTO {table} t USING {stage} s ON {match}{matched} WHEN NOT MATCHED THEN INSERT ({', '.join(map(q, columns))}) VALUES ({', '.join(f's.{q(c)}' for c in columns)})"


def upsert(df: DataFrame, url: str, table: str, keys: list[str], update: bool = True, batch: int = 1000, properties: dict[str, str] | None = None, write: Callable = write_jdbc) -> int:
    """Upserts (or with ``update`` off, insert-ignores) all rows in one server-side statement, which is all or nothing;
    failed or repeated write tasks only touch the staging table, which ``write`` makes. Keys of ``df`` are distinct.

    The server looks each key up, so the table wants an index of the keys."""
    spark, stage = df.sparkSession, f"stage_{uuid.uuid4().hex[:12]}"
    write(df, url, stage, batch, properties, mode="overwrite")
    try:
        return execute(spark, url, merge_text(table, stage, df.columns, keys, update), properties)
    finally:
        execute(spark, url, f"DROP TABLE {stage}", properties)


def embedded() -> tuple[str, dict[str, str]]:
    """URL and properties of a new database in the driver's JVM, on its disk."""
    return f"jdbc:derby:{tempfile.mkdtemp(prefix='spark-')}/db;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def reachable(spark: SparkSession) -> bool:
    """Whether tasks share the driver's JVM, and so a database that is embedded in it."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def _text(field: T.StructField):
    """A column as Derby imports it: texts in quotes, nulls empty."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        c = F.hex(c) if isinstance(field.dataType, T.BinaryType) else F.replace(c, F.lit('"'), F.lit('""'))
        c = F.concat(F.lit('"'), c, F.lit('"'))
    return F.coalesce(c.cast("string"), F.lit(""))


def load_files(df: DataFrame, url: str, table: str, batch: int = 0, properties: dict[str, str] | None = None, mode: str = "append") -> None:
    """The rows as a new table (``mode`` overwrite) or added to one, as ``write_jdbc`` writes them; a file is a transaction."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, "load")
    df.select(F.concat_ws(",", *map(_text, df.schema.fields)).alias("value")).write.text(path)
    if mode == "overwrite":
        made = T.StructType([T.StructField(f'"{f.name}"', f.dataType, f.nullable) for f in df.schema.fields])
        execute(spark, url, dialect("derby").create(table, made), properties)
    columns = ",".join(c.replace("'", "''") for c in df.columns)
    with tempfile.TemporaryDirectory(prefix="spark-") as folder:
        for name in names_in(spark, path):
            if name.startswith("part-"):
                local = fetch(spark, f"{path}/{name}", f"{folder}/rows")
                execute(spark, url, f"CALL SYSCS_UTIL.SYSCS_IMPORT_DATA(NULL, '{table.upper()}', '{columns}', NULL, '{local}', ',', '\"', 'UTF-8', 0)", properties)
                os.remove(local)
    remove(spark, path)


def unload_files(spark: SparkSession, url: str, table: str, column: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 8, properties: dict[str, str] | None = None) -> DataFrame:
    """A table, as ``jdbc`` reads it; with a column and its bounds, a file for each of so many ranges."""
    path, schema = shared_folder(spark, "unload"), jdbc(spark, url, table, properties=properties).schema
    ranges = range_predicates(column, *bounds, parts) if column and bounds else ["1 = 1"]
    with tempfile.TemporaryDirectory(prefix="spark-") as folder:
        for i, where in enumerate(ranges):
            local = f"{folder}/rows-{i}.csv"
            text = f"SELECT * FROM {table} WHERE {where}".replace("'", "''")
            execute(spark, url, f"CALL SYSCS_UTIL.SYSCS_EXPORT_QUERY('{text}', '{local}', ',', '\"', 'UTF-8')", properties)
            store(spark, local, f"{path}/{i}.csv")
    hexed = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.BinaryType) else f.dataType) for f in schema.fields])
    rows = spark.read.schema(hexed).options(multiLine=True, lineSep="\n", escape='"', nullValue="\x00\x01").csv(path)
    return rows.select(*[F.unhex(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, T.BinaryType) else F.col(f"`{f.name}`") for f in schema.fields])
