"""Helpers that the training-data operators share: the shared work folder and flat views of Arrow text columns."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

#: Bytes that separate words: blank, tab, line feed, vertical tab, form feed, carriage return.
WORD_SPACE = np.zeros(256, bool)
WORD_SPACE[[32, 9, 10, 11, 12, 13]] = True


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``).

    Where the setting is absent, a temporary folder is used in local mode only; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._folder = path
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes the files of tables that ``written`` made and nobody reads any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df._folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


#: Tables of at most so many rows of a few numbers and a name, some ten megabytes, are broadcast.
BROADCAST_ROWS = 100_000
SALTS = 16


def with_found(rows: DataFrame, found: DataFrame, keys: list[str], how: str = "left", most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` joined with ``found``, a written table with one small row for each key.

    Up to ``most_rows``, which are counted first, ``found`` is broadcast and ``rows`` stay where they are. Beyond that
    both are shuffled by the keys and a salt made of the whole row, so that the rows of a hot key are split.
    """
    if found.count() <= most_rows:
        return rows.join(F.broadcast(found), keys, how)
    simple = [F.col(f.name) for f in rows.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*simple), F.lit(SALTS)).cast("int"))
    return salted.join(found.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)]))), [*keys, "_salt"], how).drop("_salt")


def place_of(*columns: Column) -> Column:
    """A number from 0 to 2**20 - 1 by which rows are sampled: a hash of the columns, null or not."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 20))


def small_batches(spark: SparkSession, size: int = 16 << 20) -> None:
    """Bound the Arrow batches that Python workers get, as long documents make the usual ones large.

    The bound is read when a query is planned, so it is the session's; it is only ever lowered.
    """
    name, units = "spark.sql.execution.arrow.maxBytesPerBatch", {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    given = str(spark.conf.get(name)).lower().removesuffix("b")
    number, unit = (given[:-1], given[-1]) if given[-1:] in units else (given, "b")
    if not number.isdigit() or int(number) * units[unit] > size:
        spark.conf.set(name, size)


def tidy() -> None:
    """Give memory that a finished task no longer needs back to the system, as Python workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library can't
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def flat_text(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column as one uint8 array, and int64 offsets of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2] if len(column) else None
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return flat, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each; a longer row stands alone."""
    out, start, n = [], 0, len(offsets) - 1
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(n, max(end, start + 1))
        out.append((start, end))
        start = end
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = WORD_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word (a run of bytes that are not in ``space``) of every row."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~space[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE_CODE = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64; the table doubles when it is too short."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16, 2 * len(have) if have is not None else 0), base, np.uint64)
        steps[0] = 1
        _POWERS[base] = have = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3 (public domain)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each span of bytes (A-Z as a-z if ``lower``), from differences of one running polynomial."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    code = _BYTE_CODE
    if lower:
        code = code.copy()
        code[65:91] = _BYTE_CODE[97:123]
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(code[data] * _powers(_BASE, len(data)), out=run[1:])
    h = (run[ends] - run[starts]) * _powers(_INVERSE, len(data) + 1)[starts]
    return mix64(h + (ends - starts).astype(np.uint64))
