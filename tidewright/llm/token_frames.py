"""Token-id files: one independent zstandard frame a document, a trailing seek table and a checksum for each frame.

File layout (little endian; every part is a valid zstandard or skippable frame, so ``zstd -d`` reads the ids too):

* for each document one zstandard frame that holds its ids as unsigned 32-bit integers;
* a skippable frame 0x184D2A50 with the documents' ids as signed 64-bit integers;
* the seek table, a skippable frame 0x184D2A5E: for each document frame its compressed size, its decompressed size and
  the low 32 bits of the XXH64 of its decompressed bytes (unsigned 32-bit each), then the number of frames, a
  descriptor byte 0x80 (checksums present) and 0x8F92EAB1.

A reader takes the seek table and the document ids from the end of the file and reads and decompresses the frames it
is asked for, no others.

Null texts are empty documents; each document ends with ``end_id``. Rows that share a doc_id keep a place each, in the
order of their text's hash, and are dealt to partitions by it, so that an id with many rows is split. A null doc_id is
stored as the smallest 64-bit integer and read back as null. A document is one frame however long it is, up to the 4 GB
that a seek table can tell. Only the id and text columns are read, so other columns never clash.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewright.llm.bpe_ids import Encoder
from tidewright.llm.common import shared_folder, small_batches, tidy

#: Fixed values of the seekable zstandard format.
IDS_MAGIC, SEEK_MAGIC, SEEK_FOOTER = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
NO_ID = -(2**63)
#: Words whose ids a Python worker keeps from task to task, some hundred megabytes; beyond that it starts anew.
WORDS = 600_000
MANIFEST = "file string, part int, part_file int, n_docs long, n_ids long"


class FrameWriter:
    """Writes one file of document frames under a name of this attempt alone."""

    def __init__(self, folder: str, level: int):
        self.uri = f"{folder}/ids-{uuid.uuid4().hex}.zst"
        self.fs, self.path = pafs.FileSystem.from_uri(self.uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.path, compression=None)
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.doc_ids: list[int] = []
        self.table: list[tuple[int, int, int]] = []
        self.size = 0

    def add(self, doc_id: int, payload: bytes) -> None:
        frame = self.zstd.compress(payload)
        self.out.write(frame)
        self.doc_ids.append(doc_id)
        self.table.append((len(frame), len(payload), xxhash.xxh64_intdigest(payload) & 0xFFFFFFFF))
        self.size += len(frame)

    def close(self) -> tuple[str, int, int]:
        n = len(self.doc_ids)
        self.out.write(struct.pack("<II", IDS_MAGIC, 8 * n) + np.array(self.doc_ids, "<i8").tobytes())
        self.out.write(struct.pack("<II", SEEK_MAGIC, 12 * n + 9) + np.array(self.table, "<u4").tobytes() + struct.pack("<IBI", n, 0x80, SEEK_FOOTER))
        self.out.close()
        return self.uri, n, sum(x[1] for x in self.table) // 4


def read_frames(uri: str, wanted: set[int] | None = None) -> Iterator[tuple[int, int, bytes]]:
    """(doc_id, ids in the file before it, its bytes) of the wanted documents of one file (None: all)."""
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as f:
        size = f.size()
        n, flags, magic = struct.unpack("<IBI", f.read_at(9, size - 9))
        if magic != SEEK_FOOTER or flags != 0x80:
            raise ValueError(f"{uri}: no seek table")
        tail = 12 * n + 17
        table = np.frombuffer(f.read_at(12 * n, size - tail + 8), "<u4").reshape(n, 3)
        doc_ids = np.frombuffer(f.read_at(8 * n, size - tail - 8 * n), "<i8")
        begin = np.zeros(n + 1, np.int64)
        np.cumsum(table[:, 0], out=begin[1:])
        before = np.zeros(n + 1, np.int64)
        np.cumsum(table[:, 1] // 4, out=before[1:])
        unzip = zstandard.ZstdDecompressor()
        block, block_at = b"", 0
        for i in range(n):
            doc_id = int(doc_ids[i])
            if wanted is not None and doc_id not in wanted:
                continue
            a, b = int(begin[i]), int(begin[i + 1])
            if wanted is not None:
                frame = f.read_at(b - a, a)
            else:  # whole files are read in blocks
                if not block_at <= a < b <= block_at + len(block):
                    block, block_at = f.read_at(min(max(b - a, 4 << 20), int(begin[-1]) - a), a), a
                frame = block[a - block_at : b - block_at]
            payload = unzip.decompress(frame, max_output_size=int(table[i, 1]))
            if len(payload) != table[i, 1] or xxhash.xxh64_intdigest(payload) & 0xFFFFFFFF != table[i, 2]:
                raise ValueError(f"{uri}: frame {i} is damaged")
            yield doc_id, int(before[i]), payload


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", max_file_bytes: int = 128 << 20, level: int = 3) -> str:
    """Encode ``docs`` and write token-id files in ascending ``id_col`` order; returns the folder.

    Rows are range-partitioned and sorted, so the files follow each other in id order; ``<folder>/manifest`` lists
    the files of the task attempts that succeeded. An empty table yields an empty manifest.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "token-frames")
    files = f"{folder}/files"

    def write(batches):
        from pyspark import TaskContext

        part, done, out, encoder = TaskContext.get().partitionId(), [], None, Encoder.of(tokenizer_path, WORDS)
        for batch in batches:
            doc_ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            for first, ids, at in encoder.encode(batch.column(1), 4 << 20):
                for i in range(len(at) - 1):
                    if out is not None and out.size >= max_file_bytes:
                        done.append(out.close())
                        out = None
                    out = out or FrameWriter(files, level)
                    out.add(int(doc_ids[first + i]), np.append(ids[at[i] : at[i + 1]], np.uint32(end_id)).astype("<u4").tobytes())
        if out is not None:
            done.append(out.close())
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([part] * len(done), pa.int32()), pa.array(range(len(done)), pa.int32()), pa.array([x[1] for x in done], pa.int64()), pa.array([x[2] for x in done], pa.int64())], ["file", "part", "part_file", "n_docs", "n_ids"])
        tidy()  # the encoder's words stay for the worker's next task

    small_batches(spark, 4 << 20)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text")).repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash").select("doc_id", "text")
    rows.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return folder


def read_token_files(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, start, ids) of the documents in a folder of token-id files; ``ids`` are little-endian unsigned 32-bit.

    ``start`` counts the ids of all documents before, over all files. ``doc_ids`` limits what is decompressed.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    n = manifest.count()
    order = Window.orderBy("part", "part_file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(order), F.lit(0).cast("long"))).select("file", "base")
    wanted = None if doc_ids is None else set(doc_ids)

    def read(batches):
        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, size = [], 0
                for doc_id, before, payload in read_frames(uri, wanted):
                    rows.append((None if doc_id == NO_ID else doc_id, base + before, payload))
                    size += len(payload)
                    if size > 4 << 20 or len(rows) >= 4096:
                        yield _rows(rows)
                        rows, size = [], 0
                yield _rows(rows)

    def _rows(rows):
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int64()), pa.array([x[2] for x in rows], pa.binary())], ["doc_id", "start", "ids"])

    return placed.repartition(max(1, n)).mapInArrow(read, "doc_id long, start long, ids binary")
