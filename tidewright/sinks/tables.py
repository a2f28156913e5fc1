"""Table sinks on Parquet and ORC: staged publishing, partition transforms, versions, compaction, drift, table sync.

A write goes to a staging folder beside the target and is renamed into place once it is whole, so readers see the old
files or the new ones. One writer at a time is assumed. Folders are handled through Hadoop's file system, so any store
that Spark reads will do.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.text import identifier
from tidewright.operators.routing import CommitConflict, retried


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames; whatever the store's own error is, it comes as an OSError, so that it can be tried again."""
    fs, at = _fs(spark, source)
    try:
        done = fs.rename(at, _fs(spark, target)[1])
    except Py4JJavaError as error:
        raise OSError(f"can't rename {source}: {error.java_exception}") from error
    if not done:
        raise OSError(f"can't rename {source}")


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none where it is absent."""
    fs, at = _fs(spark, path)
    return [x.getPath().getName() for x in fs.listStatus(at)] if fs.exists(at) else []


def fetch(spark: SparkSession, path: str, local: str) -> str:
    """Copies a file to the driver's own disk."""
    fs, at = _fs(spark, path)
    fs.copyToLocalFile(False, at, _fs(spark, f"file://{local}")[1], True)
    return local


def store(spark: SparkSession, local: str, path: str) -> None:
    """Moves a file of the driver's own disk to a path."""
    fs, at = _fs(spark, path)
    fs.mkdirs(at.getParent())
    fs.copyFromLocalFile(True, False, _fs(spark, f"file://{local}")[1], at)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a path or glob."""
    fs, at = _fs(spark, path)
    return sum(fs.getContentSummary(x.getPath()).getLength() for x in fs.globStatus(at) or [])


def create(spark: SparkSession, path: str, text: str) -> None:
    """A small file that wasn't there; a conflict if it was."""
    fs, at = _fs(spark, path)
    if fs.exists(at):
        raise CommitConflict(path)
    try:
        out = fs.create(at, False)
    except Exception as error:
        raise CommitConflict(path) if fs.exists(at) else error
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, at = _fs(spark, path)
    stream = fs.open(at)
    try:
        return str(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def publish(df: DataFrame, path: str, check: Callable[[DataFrame], bool] | None = None, file_format: str = "parquet", partition_by: list[str] | None = None, options: dict[str, str] | None = None) -> None:
    """Replaces the table at ``path`` with ``df``, which may read it: stage, check, rename the old away, rename in.

    Where the second rename fails, the old table is moved back."""
    spark, stage, old = df.sparkSession, f"{path}_staging_{uuid.uuid4().hex}", f"{path}_old_{uuid.uuid4().hex}"
    writer = df.write.options(**(options or {})).format(file_format)
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).save(stage)
        if check and not check(spark.read.format(file_format).load(stage)):
            raise ValueError(f"staged rows for {path} fail their check")
    except Exception:
        remove(spark, stage)
        raise
    had = exists(spark, path)
    if had:
        move(spark, path, old)
    try:
        move(spark, stage, path)
    except Exception:
        if had:
            move(spark, old, path)
        remove(spark, stage)
        raise
    if had:
        remove(spark, old)


#: Partition transforms: the derived column's name and value, as text that sorts in time order.
def transform(column: str, unit: str) -> tuple[str, Column]:
    pattern = {"year": "yyyy", "month": "yyyy-MM", "day": "yyyy-MM-dd", "hour": "yyyy-MM-dd-HH"}[unit]
    return f"{column}_{unit}", F.date_format(column, pattern)


def _files_under(spark: SparkSession, path: str) -> list[str]:
    """Data files under a folder, as paths relative to it."""
    fs, at = _fs(spark, path)
    found, root = fs.listFiles(at, True), at.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()
    out = []
    while found.hasNext():
        name = found.next().getPath().toString()
        if not name.rpartition("/")[2].startswith(("_", ".")):
            out.append(name[len(root) + 1 :])
    return out


def append(df: DataFrame, path: str, transforms: list[tuple[str, str]] = (), file_format: str = "parquet", rows_per_file: int = 0, target_bytes: int = 0, options: dict[str, str] | None = None, retries: int = 10) -> None:
    """Appends with folders for the transforms, rows of a partition brought together first.

    ``target_bytes`` is about what a task writes to a partition. Files are written to a staging folder, which is the
    costly part and happens once, and then moved in under new names; only moves are tried again, and where one fails for
    good, what was moved and staged is deleted.
    """
    spark, stage, conf = df.sparkSession, f"{path}_staging_{uuid.uuid4().hex}", df.sparkSession.conf
    derived = dict(transform(c, u) for c, u in transforms)
    rows = df.withColumns(derived) if derived else df
    if derived or target_bytes:
        rows = rows.hint("rebalance", *derived)
    writer = rows.write.options(**(options or {}))
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer = writer.partitionBy(*derived) if derived else writer
    name, moved = "spark.sql.adaptive.advisoryPartitionSizeInBytes", []
    before = conf.get(name, None)
    try:
        if target_bytes:
            conf.set(name, target_bytes)
        writer.format(file_format).save(stage)
        for file in _files_under(spark, stage):
            fs, at = _fs(spark, f"{path}/{file}")
            fs.mkdirs(at.getParent())
            retried(lambda file=file: move(spark, f"{stage}/{file}", f"{path}/{file}"), retries=retries, on=(CommitConflict, OSError))
            moved.append(file)
    except Exception:
        for file in moved:
            remove(spark, f"{path}/{file}")
        raise
    finally:
        remove(spark, stage)
        if target_bytes:
            conf.set(name, before) if before else conf.unset(name)


def append_version(df: DataFrame, path: str, retries: int = 5) -> int:
    """Appends as the next version, from 0: a folder for the rows, then its name as the commit. The commit's rename
    fails if another writer took the number, and is tried again with the next."""
    spark = df.sparkSession
    data = f"{path}/data/{uuid.uuid4().hex}"
    df.write.parquet(data)

    def commit() -> int:
        version = len(versions(spark, path))
        create(spark, f"{path}/_versions/{version:08d}", data)
        return version

    return retried(commit, retries=retries, least=0.01)


def versions(spark: SparkSession, path: str) -> list[str]:
    """Data folders of a versioned table, in order; a line of text each."""
    if not exists(spark, f"{path}/_versions"):
        return []
    rows = spark.read.text(f"{path}/_versions").select("value", F.col("_metadata.file_name").alias("n")).orderBy("n").collect()
    return [r.value for r in rows]


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows of all versions up to one (None: the latest)."""
    folders = versions(spark, path)
    return spark.read.parquet(*folders[: len(folders) if version is None else version + 1])


def compact(spark: SparkSession, source: str, target: str, target_bytes: int = 128 << 20, keep_source: bool = False, codec: str = "snappy") -> int:
    """Few files from many, of about ``target_bytes``, checked by row count before the sources go; returns the rows.

    Every source split is read by its own task; the number of files follows from the sources' bytes."""
    rows = spark.read.parquet(source)
    n, files = rows.count(), max(1, -(-size_of(spark, source) // target_bytes))
    publish(rows.repartition(files), target, lambda x: x.count() == n, options={"compression": codec})
    if not keep_source and source.rstrip("/") != target.rstrip("/"):
        remove(spark, source)
    return n


def with_drift(target: DataFrame, source: DataFrame) -> tuple[DataFrame, list[str]]:
    """The target with the source's new columns as nulls, and their names; names match without case."""
    have = {c.lower() for c in target.columns}
    new = [f for f in source.schema.fields if f.name.lower() not in have]
    return target.select("*", *[F.lit(None).cast(f.dataType).alias(f.name.lower()) for f in new]), [f.name.lower() for f in new]


#: Storage formats and the providers that stand for them.
STORED_AS = {"PARQUET": "parquet", "ORC": "orc", "TEXTFILE": "csv", "AVRO": "avro"}


def sync_table(spark: SparkSession, name: str, df: DataFrame, partitions: list[str] = (), create: bool = True, file_format: str = "parquet", location: str | None = None, stored_as: str | None = None, external: bool = False) -> list[str]:
    """Creates the table or adds missing columns; returns the statements that ran.

    ``stored_as`` names a storage format instead of a provider. An ``external`` table needs a location and keeps its
    files when it is dropped; the session's catalog takes any table with a location as external.
    """
    if external and not location:
        raise ValueError("an external table needs a location")
    if stored_as and stored_as.upper() not in STORED_AS:
        raise ValueError(f"no provider for {stored_as}; there is one for {', '.join(STORED_AS)}")
    file_format = STORED_AS[stored_as.upper()] if stored_as else file_format
    ran = []

    def run(text: str) -> None:
        spark.sql(text)
        ran.append(text)

    known = spark.catalog.tableExists(name)
    if not known:
        if not create:
            raise ValueError(f"no table {name}")
        unknown = [p for p in partitions if p not in df.columns]
        plain = [f"`{identifier(f.name.lower())}` {f.dataType.simpleString()}" for f in df.schema.fields] + [f"`{p}` string" for p in unknown]
        run(f"CREATE TABLE {name} ({', '.join(plain)}) USING {file_format}" + (f" PARTITIONED BY ({', '.join(partitions)})" if partitions else "") + (f" LOCATION '{location}'" if location else ""))
        return ran
    have = {c.name.lower() for c in spark.catalog.listColumns(name)}
    new = [f for f in df.schema.fields if f.name.lower() not in have]
    if new:
        run(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name.lower()}` {f.dataType.simpleString()}' for f in new)})")
    return ran


def resolve(spark: SparkSession, name: str) -> DataFrame:
    """A table of the session's catalogs by ``catalog.namespace.table`` or a part of it, or a folder of Parquet by path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def location(spark: SparkSession, name: str) -> str:
    """The output path of a table."""
    return next(r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r.col_name == "Location")


def _spec(values: dict[str, str], columns: list[str]) -> str:
    return ", ".join("{}='{}'".format(c, str(values[c]).replace("'", "\\'")) for c in columns)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def add_partition(spark: SparkSession, name: str, values: dict[str, str]) -> str:
    """Adds a partition and returns its path under the table; every partition column needs a value."""
    columns = partition_columns(spark, name)
    if set(columns) != set(values) or any(v in (None, "") for v in values.values()):
        raise ValueError(f"{name} is partitioned by {', '.join(columns)}")
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({_spec(values, columns)})")
    return "/".join(f"{c}={values[c]}" for c in columns)


def drop_partition(spark: SparkSession, name: str, values: dict[str, str]) -> None:
    columns = partition_columns(spark, name)
    if columns:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({_spec(values, columns)})")


def partition_event(spark: SparkSession, name: str, event: str, values: dict[str, str] | None = None) -> dict[str, str]:
    """What a ``put`` or ``delete`` of files means for a table: its kind, the partition and a warning.

    A put adds its partition if it is new, else the files are an insert; on a table without partitions it is an insert.
    A delete drops its partition; on a table without partitions nothing is dropped, and a warning says so.
    """
    columns, values = partition_columns(spark, name), values or {}
    out = {"table": name, "event": event, "kind": "insert", "partition": "/".join(f"{c}={values.get(c)}" for c in columns), "warning": ""}
    if event == "put":
        if columns:
            there = spark.sql(f"SHOW PARTITIONS {name} PARTITION ({_spec(values, columns)})").isEmpty() is False
            out["partition"] = add_partition(spark, name, values)
            out["kind"] = "insert" if there else "add_partition"
    elif event == "delete":
        out["kind"] = "drop_partition" if columns else "none"
        if columns:
            drop_partition(spark, name, values)
        else:
            out["warning"] = f"{name} has no partitions, nothing is dropped"
    else:
        raise ValueError(f"no such event: {event}")
    return out


def run_script(spark: SparkSession, text: str, retries: int = 0, code: Callable[[Exception], int | None] = lambda error: None, run: Callable[[str], object] | None = None) -> list[tuple[str, str]]:
    """(statement, route) for a script; stops at the first that fails.

    A failed statement is judged by the number that ``code`` finds in its error, if any, else by its SQLSTATE. One that
    is to be retried is run again up to ``retries`` times, waiting longer each time. ``run`` runs a statement (by default in the session).
    """
    from tidewright.functions.text import statements
    from tidewright.operators.routing import Route, classify, classify_code

    def attempt(statement: str) -> None:
        try:
            (run or spark.sql)(statement)
        except Exception as error:
            number = code(error)
            told = (classify(error) if number is None else classify_code(number)).route
            raise (Again if told is Route.RETRY else Refused)(told.value) from error

    out = []
    for statement in statements(text):
        try:
            retried(lambda statement=statement: attempt(statement), retries=retries, least=0.05, on=(Again,))
            out.append((statement, Route.SUCCESS.value))
        except (Again, Refused) as error:
            out.append((statement, str(error)))
            break
    return out


class Again(RuntimeError):
    """A statement that may succeed when it is run again."""


class Refused(RuntimeError):
    """A statement that fails however often it is run."""


def write_orc(df: DataFrame, path: str, codec: str = "none", stripe_bytes: int = 64 << 20, table: str = "") -> str:
    """Writes ORC with lower-case names; returns the DDL of an external table over it (``table``, by default the path's name)."""
    from tidewright.functions.types import hive_ddl
    from tidewright.operators.align import lowered

    rows = lowered(df)
    rows.write.option("compression", codec).option("orc.stripe.size", str(stripe_bytes)).orc(path)
    return hive_ddl(rows.schema, table or path.rstrip("/").rpartition("/")[2], True) + f" LOCATION '{path}'"


def write_parquet(df: DataFrame, path: str, codec: str = "snappy", block_bytes: int = 128 << 20, int96: bool = False, page_bytes: int = 1 << 20, dictionary: bool = True, dictionary_bytes: int = 1 << 20, shift_hours: int = 0, patterns: dict[str, str] | None = None) -> None:
    """Parquet with row-group, page and dictionary sizes; timestamps shifted by hours, those with a pattern as text."""
    from tidewright.functions.coerce import add_hours

    times = {c for c, k in df.dtypes if k.startswith("timestamp")}
    shifted = {c: add_hours(F.col(c), shift_hours) if shift_hours else F.col(c) for c in times}
    rows = df.select(*[(F.date_format(shifted[c], patterns[c]) if c in (patterns or {}) else shifted[c]).alias(c) if c in times else F.col(c) for c in df.columns])
    options = {"compression": codec, "parquet.block.size": block_bytes, "parquet.page.size": page_bytes, "parquet.enable.dictionary": str(dictionary).lower(), "parquet.dictionary.page.size": dictionary_bytes}
    name, conf = "spark.sql.parquet.outputTimestampType", df.sparkSession.conf
    before = conf.get(name)
    conf.set(name, "INT96" if int96 else "TIMESTAMP_MICROS")
    try:
        rows.write.options(**options).parquet(path)
    finally:
        conf.set(name, before)


def write_csv(df: DataFrame, path: str, header: bool = True, names: list[str] | None = None, sep: str = ",", quote_all: bool = False, date_format: str = "yyyy-MM-dd", timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> None:
    """CSV with typed formats; nulls are empty. White space around texts stays."""
    rows = df.toDF(*names) if names else df
    rows.write.options(header=header, sep=sep, quoteAll=quote_all, nullValue="", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, dateFormat=date_format, timestampFormat=timestamp_format).csv(path)


def as_text_types(df: DataFrame) -> DataFrame:
    """Logical types off: decimals, dates and timestamps as text."""
    return df.select(*[F.col(c).cast("string") if k.startswith(("decimal", "date", "timestamp")) else F.col(c) for c, k in df.dtypes])


def lake_writer(df: DataFrame, table: str, provider: str, properties: dict[str, str] | None = None):
    """A writer for a table format whose connector the session has; the format is a parameter."""
    writer = df.writeTo(table).using(provider)
    for key, value in (properties or {}).items():
        writer = writer.option(f"snapshot-property.{key}", value)
    return writer
