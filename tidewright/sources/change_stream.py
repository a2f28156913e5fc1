"""A change table as a stream with offsets and a row cap a trigger: a Python data source for ``spark.readStream``.

The table is a folder of JSON-lines files of change events, each with a sequence number that rises from file to file and
within a file, as capture jobs write them; files are only ever added, under names that sort in order. An offset is the
number of events before it. A trigger takes at most ``max_rows`` events, in parts of ``rows_per_task``, so the first one
after a long stop is no larger than any other. The offset up to which Spark has committed is written to
``offsets`` (a folder) as well: a restarted query goes on from its own checkpoint, and a query with a new checkpoint from
there (``start``: committed), from the beginning (earliest), or from the end of what is there (latest). No event is lost or comes twice for a sink
that is idempotent by batch, as Spark's own are.

    register(spark)
    spark.readStream.format("change_table").option("path", p).option("max_rows", 1000).load()

Event counts of finished files are remembered by the reader, and of each ``BLOCK`` bytes of them, so a task reads its own
part of a file alone. Files are read through PyArrow's file systems.
"""

from __future__ import annotations

import json
import posixpath
import sys
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

#: Bytes whose events are counted together; an event's sequence number, its key and value as JSON text, and where it belongs.
BLOCK = 1 << 18
SCHEMA = "seq long, cdc_key string, value string, cdc_destination string"


def register(spark: SparkSession) -> None:
    """Makes the format ``change_table`` known to a session.

    The source is sent by value, as Spark plans it in a Python process that doesn't have the session's Python files."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    try:
        spark.dataSource.register(ChangeSource)
    finally:
        cloudpickle.unregister_pickle_by_value(sys.modules[__name__])


def _store(path: str):
    import pyarrow.fs as pafs

    uri = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path
    return pafs.FileSystem.from_uri(uri)


class Part(InputPartition):
    """Events ``begin`` to ``end`` (not included), and the files that have them with a byte before these and the number of the event it is in."""

    def __init__(self, begin: int, end: int, files: list[tuple[str, int, int]]):
        self.begin, self.end, self.files = begin, end, files


class ChangeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "change_table"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> ChangeReader:
        return ChangeReader(dict(self.options))


class ChangeReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.kept = options["path"], options.get("offsets")
        self.most, self.each = int(options.get("max_rows", 10_000)), int(options.get("rows_per_task", 2_500))
        self.start = options.get("start", "committed" if self.kept else "earliest")
        if self.start not in ("committed", "earliest", "latest") or self.start == "committed" and not self.kept or self.most < 1 or self.each < 1:
            raise ValueError("start is committed (with a folder for offsets), earliest or latest; row numbers are at least 1")
        self.counts: dict[str, list[int]] = {}  # events of files before each block, and all
        self.at: int | None = None  # up to where batches have been planned or offered

    def _files(self) -> list[tuple[str, int]]:
        """Files in order and the number of the first event of each; the last entry is the number of all."""
        import pyarrow.fs as pafs

        fs, root = _store(self.path)
        names = sorted(x.path for x in fs.get_file_info(pafs.FileSelector(root)) if x.is_file and x.base_name.endswith(".json"))
        out, n = [], 0
        for name in names:
            if name not in self.counts:
                with fs.open_input_stream(name) as f:
                    self.counts[name] = list(accumulate((block.count(b"\n") for block in iter(lambda f=f: f.read(BLOCK), b"")), initial=0))
            out.append((name, n))
            n += self.counts[name][-1]
        return [*out, ("", n)]

    def _committed(self) -> int:
        import pyarrow.fs as pafs

        fs, at = _store(self.kept)
        if fs.get_file_info(at).type == pafs.FileType.NotFound:
            return 0
        names = [x.base_name for x in fs.get_file_info(pafs.FileSelector(at)) if x.is_file and x.base_name.isdigit()]
        return max(map(int, names), default=0)

    def initialOffset(self) -> dict:
        self.at = {"earliest": lambda: 0, "latest": lambda: self._files()[-1][1], "committed": self._committed}[self.start]()
        return {"events": self.at}

    def latestOffset(self) -> dict:
        """At most ``max_rows`` further than the last one. After a restart it goes on from what was committed."""
        if self.at is None:
            self.at = self._committed() if self.kept else 0
        self.at = max(self.at, min(self._files()[-1][1], self.at + self.most))
        return {"events": self.at}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        begin, stop, files = start["events"], end["events"], self._files()
        self.at = max(self.at or 0, stop)
        out = []
        for a in range(begin, stop, self.each):
            b = min(stop, a + self.each)
            own = [self._from(name, n, a) for (name, n), (_, after) in zip(files, files[1:], strict=False) if n < b and after > a]
            out.append(Part(a, b, own))
        return out

    def _from(self, name: str, first: int, event: int) -> tuple[str, int, int]:
        """The last block of a file that begins in an event before the given one, or the first block."""
        counts = self.counts[name]
        i = max(0, bisect_left(counts, event - first) - 1)
        return name, i * BLOCK, first + counts[i]

    def read(self, partition: Part) -> Iterator[tuple]:
        fs, _ = _store(self.path)
        for name, at, n in partition.files:
            with fs.open_input_file(name) as file:
                file.seek(at)
                lines = _lines(file)
                if at:  # in the midst of event n, or at its begin
                    next(lines, None)
                    n += 1
                for line in lines:
                    if partition.begin <= n < partition.end:
                        event = json.loads(line)
                        yield tuple(event.get(k) if not isinstance(event.get(k), (dict, list)) else json.dumps(event[k]) for k in ("seq", "cdc_key", "value", "cdc_destination"))
                    n += 1
                    if n >= partition.end:
                        break

    def commit(self, end: dict) -> None:
        """Remembers an offset as a file's name, which is there whole or not at all; the one before stays."""
        if self.kept:
            fs, root = _store(self.kept)
            fs.create_dir(root)
            with fs.open_output_stream(posixpath.join(root, f"{end['events']:020d}")):
                pass


def _lines(stream) -> Iterator[bytes]:
    held = b""
    while block := stream.read(BLOCK):
        *whole, held = (held + block).split(b"\n")
        yield from whole
    if held:
        yield held
