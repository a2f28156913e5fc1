"""Tables with a commit log: appends and merges of several writers at once, and reads that skip files.

A table is a folder of data files, of manifests and of numbered commits. A manifest is a small Parquet table with a row a
file: whether the commit adds or removes it, its partition, its rows, and the least and largest value of the ``stats``
columns. A commit is one file that names a manifest and the partitions that it touches. It is created only if its number
is free, so of two writers one is first; the other goes on with the next number unless what came between touches
what it has read, which is then a conflict. Every tenth commit's manifest lists the live files of all before it, so the
log that has to be read stays short. What a reader sees depends on commits alone; files without one are never read.
"""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.operators import changes as keyed
from tidewright.operators.routing import CommitConflict, retried
from tidewright.sinks.tables import create, names_in, read_text, remove

#: A manifest with all live files every so many commits.
WHOLE_EVERY = 10
COMPARE: dict[str, tuple[Callable, Callable]] = {
    "=": (lambda c, v: c == v, lambda low, high, v: (low <= v) & (high >= v)),
    "<": (lambda c, v: c < v, lambda low, high, v: low < v),
    "<=": (lambda c, v: c <= v, lambda low, high, v: low <= v),
    ">": (lambda c, v: c > v, lambda low, high, v: high > v),
    ">=": (lambda c, v: c >= v, lambda low, high, v: high >= v),
}


class ReadChanged(Exception):
    """Another commit changed partitions that this one has read."""


def _file() -> Column:
    """The file of a row, as a path below the table; paths come URL-encoded."""
    return F.url_decode(F.replace(F.regexp_extract(F.col("_metadata.file_path"), r"/(data/[0-9a-f]{32}/.*)$", 1), F.lit("+"), F.lit("%2B")))


def _rank(value: Column, cuts: list[float]) -> Column:
    """How many of the cuts (rising) a value reaches; 0 for null. Found by halving."""
    known, steps = F.array(*map(F.lit, map(float, cuts))).cast("array<double>"), [1 << j for j in reversed(range(len(cuts).bit_length()))]
    further = lambda at, step: F.when(F.get(known, at + step - 1) <= value, at + step).otherwise(at)
    return F.when(value.isNull(), 0).otherwise(F.aggregate(F.array(*map(F.lit, steps)).cast("array<int>"), F.lit(0), further)).cast("long")


def _interleaved(rows: DataFrame, columns: list[str], bits: int = 8) -> Column:
    """The bits of the columns' ranks, in ``2 ** bits`` equal shares of the rows each, in turns from the highest."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = rows.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(c) for c in columns]).first()
    out = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        rank = _rank(F.col(c).cast("double"), cuts[c] or [])
        for j in range(bits):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(rank, j).bitwiseAND(F.lit(1).cast("long")), j * len(columns) + i))
    return out


class LoggedTable:
    """The table at ``path``. The first commit sets its columns, ``partition_by`` and ``stats`` (columns of simple types)."""

    def __init__(self, spark: SparkSession, path: str, partition_by: list[str] = (), stats: list[str] = ()):
        self.spark, self.path = spark, path.rstrip("/")
        known = self.commits()
        first = self._commit(known[0]) if known else {"partition_by": list(partition_by), "stats": list(stats)}
        self.partition_by, self.stats = first["partition_by"], first["stats"]

    def commits(self) -> list[int]:
        return sorted(int(x.partition(".")[0]) for x in names_in(self.spark, f"{self.path}/_commits"))

    def version(self) -> int:
        """The last commit's number; -1 where there is none."""
        return max(self.commits(), default=-1)

    def _commit(self, version: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.path}/_commits/{version:012d}.json"))

    def schema(self, version: int | None = None) -> T.StructType:
        return T.StructType.fromJson(self._commit(self.version() if version is None else version)["schema"])

    def _manifests(self, commits: list[dict]) -> DataFrame:
        tables = [self.spark.read.parquet(f"{self.path}/_manifests/{c['manifest']}").withColumn("_at", F.lit(i)) for i, c in enumerate(commits)]
        return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)

    def files(self, version: int | None = None) -> DataFrame:
        """(file, part, rows, bytes, stats) of the live files of a version."""
        version = self.version() if version is None else version
        if version < 0:
            raise FileNotFoundError(f"{self.path} has no commit")
        back, commits = version, []
        while not commits or not commits[-1]["whole"]:
            commits.append(self._commit(back))
            back -= 1
        entries = self._manifests(commits[::-1])
        gone = entries.where("kind = 'remove'").select("file")
        return entries.where("kind = 'add'").join(gone, "file", "left_anti").drop("kind", "_at")

    def _rows(self, files: list[str], schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{x}" for x in files]) if files else self.spark.createDataFrame([], schema)

    def read(self, where: list[tuple[str, str, object]] = (), version: int | None = None) -> DataFrame:
        """Rows of a version for which all conditions (column, one of ``COMPARE``, value) hold.

        Only files whose statistics allow a match are opened; the conditions reach their scan too.
        """
        version = self.version() if version is None else version
        chosen = self.files(version)
        for column, sign, value in where:
            if column in self.stats:
                chosen = chosen.where(COMPARE[sign][1](F.col(f"stats.{column}.low"), F.col(f"stats.{column}.high"), F.lit(value)))
        rows = self._rows(sorted(r.file for r in chosen.select("file").collect()), self.schema(version))  # Spark's scan takes a list of paths
        for column, sign, value in where:
            rows = rows.where(COMPARE[sign][0](F.col(column), F.lit(value)))
        return rows

    def _written(self, df: DataFrame, rows_per_file: int, as_is: bool = False) -> DataFrame:
        """Writes data files, and gives a manifest's entries for them; ``as_is`` keeps the rows' own partitions and order."""
        folder = f"data/{uuid.uuid4().hex}"
        parts = {f"_part_{c}": F.col(c) for c in self.partition_by}  # the columns stay in the files as well
        writer = df.withColumns(parts).hint("rebalance", *parts).write if parts and not as_is else df.withColumns(parts).write
        writer = writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer
        (writer.partitionBy(*parts) if parts else writer).parquet(f"{self.path}/{folder}")
        span = [F.struct(F.min(c).alias("low"), F.max(c).alias("high"), F.count_if(F.col(c).isNull()).alias("nulls")).alias(c) for c in self.stats]
        stats = F.struct(*span).alias("stats") if span else F.lit(None).cast("string").alias("stats")
        rows = self.spark.read.schema(df.schema).option("recursiveFileLookup", "true").parquet(f"{self.path}/{folder}").select(*self.stats, _file().alias("file"), F.col("_metadata.file_size").alias("size"))
        told = rows.groupBy("file").agg(F.count("*").alias("rows"), F.max("size").alias("bytes"), stats)
        part = F.regexp_extract("file", r"^data/[0-9a-f]{32}/(?:(.*)/)?[^/]*$", 1)
        return told.select(F.lit("add").alias("kind"), "file", part.alias("part"), "rows", "bytes", "stats")

    def _commit_files(self, read: int, df: DataFrame, added: DataFrame, removed: list[str], touched: list[str] | None, retries: int, rows_stay: bool = False) -> int:
        """Makes a commit of files that were prepared from version ``read``.

        ``touched`` are the partitions whose rows the commit depends on (None: on none, as in an append). Commits that
        came between must not have changed them; for a commit that changes no row (``rows_stay``) only removals count.
        """
        manifest, entries = uuid.uuid4().hex, added
        if removed:
            gone = self.spark.createDataFrame([(x,) for x in removed], "file string").select(F.lit("remove").alias("kind"), "file")
            entries = added.unionByName(gone, allowMissingColumns=True)
        entries.coalesce(1).write.parquet(f"{self.path}/_manifests/{manifest}")
        own = self.spark.read.parquet(f"{self.path}/_manifests/{manifest}").where("kind = 'add'").select("part").distinct()
        own = sorted({r.part for r in own.collect()} | set(touched or ()))
        state = {"checked": read}

        def commit() -> int:
            last = self.version()
            for v in range(state["checked"] + 1, last + 1):
                other = self._commit(v)
                if touched is not None and set(other["parts"]) & set(touched) and (other["removes"] or not rows_stay):
                    raise ReadChanged(f"commit {v} changed what this one has read")
                state["checked"] = v
            told = {"manifest": manifest, "whole": last < 0, "parts": own, "removes": bool(removed), "schema": json.loads(self._schema(last, df).json()), "partition_by": self.partition_by, "stats": self.stats}
            if last >= 0 and (last + 1) % WHOLE_EVERY == 0:
                told |= {"manifest": self._whole(last, manifest, removed), "whole": True}
            create(self.spark, f"{self.path}/_commits/{last + 1:012d}.json", json.dumps(told))
            return last + 1

        return retried(commit, retries=retries, least=0.01)

    def _schema(self, last: int, df: DataFrame) -> T.StructType:
        """The table's columns and those that are new."""
        old = self.schema(last).fields if last >= 0 else []
        return T.StructType([*old, *[f for f in df.schema.fields if f.name not in {x.name for x in old}]])

    def _whole(self, last: int, manifest: str, removed: list[str]) -> str:
        """A manifest of all live files after a commit."""
        name = uuid.uuid4().hex
        live = self.files(last).withColumn("kind", F.lit("add"))
        new = self.spark.read.parquet(f"{self.path}/_manifests/{manifest}").where("kind = 'add'")
        if removed:
            live = live.join(self.spark.createDataFrame([(x,) for x in removed], "file string"), "file", "left_anti")
        live.unionByName(new).coalesce(1).write.parquet(f"{self.path}/_manifests/{name}")
        return name

    def append(self, df: DataFrame, rows_per_file: int = 0, retries: int = 10) -> int:
        """Adds rows; returns the commit's number. Appends never conflict."""
        read = self.version()
        added = self._written(df, rows_per_file)
        return self._commit_files(read, df, added, [], None, retries)

    def merge(self, source: DataFrame, keys: list[str], mode: str = "UPSERT", rows_per_file: int = 0, retries: int = 10) -> tuple[int, list[str]]:
        """Updates, upserts or deletes by keys; (commit, files that were written anew).

        Files that can hold a key are found by the statistics of the keys, and of these the ones that do by a join on
        the keys alone. Only their rows are read and written; all others stay as they are, byte for byte. Where another
        commit changed the partitions of those files meanwhile, the merge starts again from what is there now.
        """
        source = source.persist()
        try:
            for _ in range(retries):
                try:
                    return self._merged(source, keys, mode, rows_per_file, retries)
                except ReadChanged:
                    continue
            raise CommitConflict(f"{self.path}: other writers were first {retries} times")
        finally:
            source.unpersist()

    def _merged(self, source: DataFrame, keys: list[str], mode: str, rows_per_file: int, retries: int) -> tuple[int, list[str]]:
        read = self.version()
        known, schema = self.files(read), self.schema(read)
        ranged = [k for k in keys if k in self.stats]
        if ranged:
            span = source.agg(*[f(k).alias(f"{f.__name__}_{k}") for k in ranged for f in (F.min, F.max)]).first()
            for k in ranged:
                known = known.where((F.col(f"stats.{k}.low") <= F.lit(span[f"max_{k}"])) & (F.col(f"stats.{k}.high") >= F.lit(span[f"min_{k}"])))
        maybe = sorted(r.file for r in known.select("file").collect())
        holding = self._rows(maybe, schema).select(*keys, _file().alias("file")).join(source.select(*keys).distinct(), keys, "left_semi")
        files = sorted(r.file for r in holding.select("file").distinct().collect())
        old = self._rows(files, schema)
        if mode == "DELETE":
            new = keyed.delete_keys(old, source, keys)
        else:
            new = {"UPDATE": keyed.update, "UPSERT": keyed.upsert}[mode](old, source, keys)
        added = self._written(new, rows_per_file)
        # an upsert depends on its keys' absence elsewhere: on every partition where one might have come
        parts = [r.part for r in self.files(read).select("part").distinct().collect()] if mode == "UPSERT" and not self._keyed_by_partition(keys) else None
        touched = sorted({self._part_of(x) for x in files} | set(parts or ()))
        if mode == "UPSERT" and parts is None:
            touched = sorted({*touched, *[r.part for r in added.select("part").distinct().collect()]})
        return self._commit_files(read, new, added, files, touched, retries), files

    def compact(self, target_bytes: int = 128 << 20, small: float = 0.75, cluster: list[str] = (), retries: int = 10) -> int | None:
        """Brings small files together; the commit's number, or None where nothing is to be done.

        Files under ``small`` of the target are packed, in their order, into bins of at most ``target_bytes`` within each
        partition; a bin of several files becomes one file that has their rows in their order. Files that are large
        already, and bins of one file, stay as they are. With ``cluster`` all files of the table are written anew, each
        partition in order of the interleaved bits of these numeric columns, so that conditions on any of them skip
        files.
        """
        read = self.version()
        files = [tuple(r) for r in self.files(read).select("part", "file", "bytes").orderBy("part", "file").collect()]
        bins: list[list[str]] = []
        last, size = None, 0
        for part, file, n in files:
            if cluster:
                bins.append([file])
            elif n < small * target_bytes:
                if part != last or size + n > target_bytes:
                    bins.append([])
                    last, size = part, 0
                bins[-1].append(file)
                size += n
        bins = bins if cluster else [b for b in bins if len(b) > 1]
        chosen = [x for b in bins for x in b]
        if not chosen:
            return None
        rows = self._rows(chosen, self.schema(read))
        if cluster:
            total = sum(n for _, _, n in files)
            z = _interleaved(rows, list(cluster))
            new = rows.withColumn("_z", z).repartitionByRange(max(1, -(-total // target_bytes)), *self.partition_by, "_z").sortWithinPartitions(*self.partition_by, "_z").drop("_z")
        else:
            place = self.spark.createDataFrame([(x, i, k) for i, b in enumerate(bins) for k, x in enumerate(b)], "_file string, _bin int, _nth int")  # a row a small file
            told = rows.select("*", _file().alias("_file"), F.col("_metadata.row_index").alias("_row")).join(F.broadcast(place), "_file")
            new = told.repartition(len(bins), "_bin").sortWithinPartitions("_bin", "_nth", "_row")
            # partitions can hold several bins; each is a file of its own where the bin is a folder
            return self._commit_files(read, rows, self._binned(new), chosen, sorted({self._part_of(x) for x in chosen}), retries, True)
        return self._commit_files(read, rows, self._written(new, 0, as_is=True), chosen, sorted({self._part_of(x) for x in chosen}), retries, True)

    def _binned(self, rows: DataFrame) -> DataFrame:
        """Writes a file for each ``_bin``, in the rows' order, below folders of the partitions."""
        own, parts = self.partition_by, [f"_part_{c}" for c in self.partition_by]
        self.partition_by = [*own, "_bin"]
        try:
            entries = self._written(rows.drop("_file", "_nth", "_row"), 0, as_is=True)
        finally:
            self.partition_by = own
        return entries.withColumn("part", F.regexp_replace("part", "(^|/)_part__bin=.*$", "")) if parts else entries.withColumn("part", F.lit(""))

    def _keyed_by_partition(self, keys: list[str]) -> bool:
        """Whether equal keys are always in one partition."""
        return bool(self.partition_by) and set(self.partition_by) <= set(keys)

    @staticmethod
    def _part_of(file: str) -> str:
        return "/".join(x for x in file.split("/")[2:-1] if not x.startswith("_part__bin="))

    def clean(self, keep: int = 1) -> list[str]:
        """Deletes data that no commit of the last ``keep`` versions has, and returns it; no writer may be at work.

        Earlier versions can't be read any more.
        """
        last = self.version()
        live = functools.reduce(DataFrame.union, [self.files(v).select("file") for v in range(max(0, last - keep + 1), last + 1)]).distinct()
        folders = {r.folder for r in live.select(F.regexp_extract("file", "^data/([0-9a-f]{32})/", 1).alias("folder")).distinct().collect()}
        lost = sorted(x for x in names_in(self.spark, f"{self.path}/data") if x not in folders)
        for x in lost:
            remove(self.spark, f"{self.path}/data/{x}")
        return lost
