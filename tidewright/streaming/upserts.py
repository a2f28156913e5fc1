"""Micro-batches into tables: idempotent upserts, transactional appends, de-duplication within a watermark.

A table of upserts is a set of buckets and a log of deltas. A bucket has the rows whose key hash lies in its range, as
files of its own; a delta has what one micro-batch changed, a row a key, deleted keys too. Readers take the newest row of
a key by its sequence number, so a batch writes its delta and nothing else. Deltas of about one size are folded into
one, and a bucket takes the deltas in once they are a fair part of it; one that has grown past ``bucket_rows`` is split
in two. Merging twice changes nothing, so no row is ever missed or doubled by what runs again.
"""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from tidewright.operators.changes import last_per_key, replay
from tidewright.operators.fragments import with_index
from tidewright.sinks.tables import create, exists, names_in, publish, read_text, remove

DELETED, HASH = "_deleted", "_hash"
#: Hashes are 31 bits; ranges are [low, high).
TOP = 1 << 31
#: Operations whose outcome doesn't depend on whether the key is there.
BLIND = ("UPSERT", "DELETE", "DELETE_IGNORE")
#: So many deltas of about one size (powers of this number, in rows) are folded into one.
FOLD = 8


def _snapshots(spark: SparkSession, path: str) -> list[str]:
    return sorted(names_in(spark, f"{path}/_snapshots"))


def _snapshot(spark: SparkSession, path: str, name: str) -> dict:
    """buckets: low, high, folder (or none), rows, upto (the last delta that is in it); deltas: folder, number, rows."""
    return json.loads(read_text(spark, f"{path}/_snapshots/{name}"))


def _files(state: dict) -> set[str]:
    return {x["folder"] for x in [*state["buckets"], *state["deltas"]] if x["folder"]}


def _rows(spark: SparkSession, path: str, folders: list[str], schema) -> DataFrame:
    return spark.read.schema(schema).parquet(*[f"{path}/{x}" for x in folders]) if folders else spark.createDataFrame([], schema)


def _hash(keys: list[str]) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*keys), 33)


def _newest(base: DataFrame, deltas: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The row with the largest ``seq`` of each key, of a base with a row a key and any number of deltas.

    The base's values are never shuffled where the deltas' newest rows are small enough to broadcast, which Spark tells.
    """
    newest = last_per_key(deltas, keys, seq)
    both = base.join(newest.select(*keys, F.struct(*newest.columns).alias("_new")), keys, "left")
    mine = F.col("_new").isNull() | (F.col(seq) > F.col(f"_new.{seq}"))
    kept = both.select(*[F.when(mine, F.col(c)).otherwise(F.col(f"_new.{c}")).alias(c) for c in base.columns])
    return kept.unionByName(newest.join(base.select(*keys), keys, "left_anti"))


def _table(spark: SparkSession, path: str, state: dict, columns: list[str] | None = None) -> DataFrame:
    """Rows of a snapshot, deleted keys too."""
    schema = T.StructType.fromJson(state["schema"])
    if columns:
        schema = T.StructType([schema[c] for c in columns])
    base = _rows(spark, path, [b["folder"] for b in state["buckets"] if b["folder"]], schema)
    if not state["deltas"]:
        return base
    return _newest(base, _rows(spark, path, [x["folder"] for x in state["deltas"]], schema), state["keys"], state["seq"])


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """The latest snapshot of a table of ``upsert_stream``, without what marks its deleted keys."""
    found = _snapshots(spark, path)
    if not found:
        raise FileNotFoundError(f"{path} has no rows")
    return _table(spark, path, _snapshot(spark, path, found[-1])).where(~F.col(DELETED)).drop(DELETED, HASH)


def _add_rejects(rejects: DataFrame, path: str) -> None:
    """Adds to a batch's rejects those that aren't there, as often as they come, so that a batch that comes again loses and doubles none."""
    spark, there = rejects.sparkSession, exists(rejects.sparkSession, path)
    if there:
        old = spark.read.schema(rejects.schema).parquet(path)
        each = Window.partitionBy("_text").orderBy("_text")
        counted = lambda df: df.withColumn("_text", F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).withColumn("_nth", F.row_number().over(each))
        rejects = old.unionByName(counted(rejects).join(counted(old).select("_text", "_nth"), ["_text", "_nth"], "left_anti").drop("_text", "_nth"))
    publish(rejects, path)


def upsert_batch(batch: DataFrame, path: str, keys: list[str], seq: str, op: str = "_op", buckets: int = 4, number: int = 0, bucket_rows: int = 1_000_000, share: float = 0.5) -> None:
    """Replays one micro-batch on the table at ``path``.

    The table keeps the last ``seq`` of each key, of deleted keys too, so changes that come again or late are left out:
    at least once becomes once, in whatever order batches bring them. A batch of upserts and deletes reads nothing of
    the table; other operations read keys and sequence numbers. It writes one delta, and a snapshot file makes it
    visible at once. Changes that can't be applied (null key, null ``seq``, an INSERT of a key that is there, unknown
    operation) go to ``<path>_rejects/batch=<number>``, to which a batch that comes again adds nothing.

    ``buckets`` is how many buckets a new table has. A bucket is written anew once what its deltas hold for it is ``share`` of
    its rows or more, and split when it has over ``bucket_rows``.
    """
    spark, values = batch.sparkSession, [c for c in batch.columns if c != op]
    schema = batch.select(*values).withColumns({DELETED: F.lit(False), HASH: F.lit(0).cast("long")}).schema
    before = _snapshots(spark, path)
    if before:
        state = _snapshot(spark, path, before[-1])
        schema = T.StructType([*schema.fields, *[f for f in T.StructType.fromJson(state["schema"]).fields if f.name not in schema.names]])
    else:
        edges = [TOP * i // buckets for i in range(buckets + 1)]
        state = {"keys": keys, "seq": seq, "next": 0, "buckets": [{"low": a, "high": b, "folder": "", "rows": 0, "upto": -1} for a, b in zip(edges, edges[1:], strict=False)], "deltas": []}
    state["schema"] = json.loads(schema.json())
    batch = batch.persist()
    try:
        usable = F.col(seq).isNotNull()
        fresh = batch.where(usable)
        told = batch.agg(F.count("*").alias("n"), F.count_if(~F.coalesce(F.col(op).isin(*BLIND), F.lit(False))).alias("bound")).first()
        if not told["n"]:
            return
        present = fresh.limit(0).select(*values)
        if told["bound"] and before:
            known = _table(spark, path, state, [*keys, seq, DELETED, HASH]).join(fresh.select(*keys).distinct(), keys, "left_semi")
            fresh = fresh.join(known.select(*keys, F.col(seq).alias("_had")), keys, "left").where(F.col("_had").isNull() | (F.col(seq) > F.col("_had"))).drop("_had")
            # a key that is there and that no change sets comes out without a sequence number
            present = present.unionByName(known.where(~F.col(DELETED)).select(*keys), allowMissingColumns=True)
        after, rejects = replay(present, fresh, keys, seq, op)
        rejects = rejects.unionByName(batch.where(~usable).withColumn("_error", F.lit("null sequence number")))
        gone = fresh.where(F.col(op).startswith("DELETE")).select(*keys, seq).dropna(subset=keys).groupBy(*keys).agg(F.max(seq).alias(seq))
        made = after.withColumn(DELETED, F.lit(False)).unionByName(gone.withColumn(DELETED, F.lit(True)), allowMissingColumns=True)
        # of a key that is both, what is alive in the end counts
        newest = last_per_key(made.withColumn("_alive", ~F.col(DELETED)), keys, ["_alive", seq]).drop("_alive").where(F.col(seq).isNotNull())
        folder, at = f"data/{uuid.uuid4().hex}", state["next"]
        newest.withColumn(HASH, _hash(keys)).hint("rebalance").write.parquet(f"{path}/{folder}")
        _add_rejects(rejects, f"{path}_rejects/batch={number}")
    finally:
        batch.unpersist()
    counts = _counts(_rows(spark, path, [folder], schema), state["buckets"])
    state["deltas"].append({"folder": folder, "number": at, "rows": sum(counts), "share": counts})
    state["next"] = at + 1
    _merge(spark, path, state, schema, bucket_rows, share)
    create(spark, f"{path}/_snapshots/{int(before[-1]) + 1 if before else 0:012d}", json.dumps(state))
    for old in before[:-1]:  # readers may still be at the one before
        for x in _files(_snapshot(spark, path, old)) - _files(state) - _files(_snapshot(spark, path, before[-1])):
            remove(spark, f"{path}/{x}")
        remove(spark, f"{path}/_snapshots/{old}")


def _bucket(buckets: list[dict]) -> Column:
    """The place of a row's bucket among ``buckets``, whose ranges rise; ranges between them count with the one before."""
    def among(part: list[tuple[int, int]]) -> Column:
        if len(part) == 1:
            return F.lit(part[0][1])
        half = len(part) // 2
        return F.when(F.col(HASH) < part[half][0], among(part[:half])).otherwise(among(part[half:]))

    return among([(b["low"], i) for i, b in enumerate(buckets)])


def _counts(rows: DataFrame, buckets: list[dict]) -> list[int]:
    """Rows for each bucket; a row a bucket reaches the driver."""
    found = dict(map(tuple, rows.groupBy(_bucket(buckets).alias("b")).count().collect()))
    return [found.get(i, 0) for i in range(len(buckets))]


def _merge(spark: SparkSession, path: str, state: dict, schema, bucket_rows: int, share: float) -> None:
    """Folds deltas, and writes the buckets anew for which there is enough in them; changes ``state``."""
    keys, seq = state["keys"], state["seq"]
    pending = [sum(x["share"][i] for x in state["deltas"] if x["number"] > b["upto"]) for i, b in enumerate(state["buckets"])]
    due = [i for i, b in enumerate(state["buckets"]) if pending[i] and pending[i] >= max(share * b["rows"], min(1000, bucket_rows))]
    if due:
        chosen = [state["buckets"][i] for i in due]
        inside = functools.reduce(lambda a, b: a | b, [(F.col(HASH) >= b["low"]) & (F.col(HASH) < b["high"]) for b in chosen])
        base = _rows(spark, path, [b["folder"] for b in chosen if b["folder"]], schema)
        merged = _newest(base, _rows(spark, path, [x["folder"] for x in state["deltas"]], schema).where(inside), keys, seq)
        halves = []
        for b, n in zip(chosen, [pending[i] for i in due], strict=True):
            parts = 1
            while b["rows"] + n > parts * bucket_rows and (b["high"] - b["low"]) // parts > 1:
                parts *= 2
            edges = [b["low"] + (b["high"] - b["low"]) * k // parts for k in range(parts + 1)]
            halves += [{"low": x, "high": y, "folder": "", "rows": 0, "upto": state["next"] - 1} for x, y in zip(edges, edges[1:], strict=False)]
        folder = f"data/{uuid.uuid4().hex}"
        merged.withColumn("_bucket", _bucket(halves)).hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{path}/{folder}")
        counts = dict(map(tuple, spark.read.schema(T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])).parquet(f"{path}/{folder}").groupBy("_bucket").count().collect()))
        for k, b in enumerate(halves):
            if counts.get(k):
                b |= {"folder": f"{folder}/_bucket={k}", "rows": counts[k]}
        state["buckets"] = sorted([b for i, b in enumerate(state["buckets"]) if i not in set(due)] + halves, key=lambda b: b["low"])
        oldest = min(b["upto"] for b in state["buckets"])
        state["deltas"] = [x for x in state["deltas"] if x["number"] > oldest]
        for x in state["deltas"]:  # the buckets have changed places
            x["share"] = _counts(_rows(spark, path, [x["folder"]], schema), state["buckets"])
    size = lambda x: len(f"{x['rows']:o}")  # noqa: E731  powers of eight
    for s in sorted({size(x) for x in state["deltas"]}):
        same = [x for x in state["deltas"] if size(x) == s]
        if len(same) >= FOLD:
            folder = f"data/{uuid.uuid4().hex}"
            last_per_key(_rows(spark, path, [x["folder"] for x in same], schema), keys, seq).select(*schema.names).hint("rebalance").write.parquet(f"{path}/{folder}")
            counts = _counts(_rows(spark, path, [folder], schema), state["buckets"])
            state["deltas"] = [x for x in state["deltas"] if x not in same] + [{"folder": folder, "number": max(x["number"] for x in same), "rows": sum(counts), "share": counts}]


def clean_upserted(spark: SparkSession, path: str) -> list[str]:
    """Deletes folders that no snapshot names: what runs that failed before their snapshot have left. No writer may be at work."""
    states = [_snapshot(spark, path, x) for x in _snapshots(spark, path)]
    named = {x.split("/")[1] for s in states for x in _files(s)}
    lost = [x for x in names_in(spark, f"{path}/data") if x not in named]
    for x in lost:
        remove(spark, f"{path}/data/{x}")
    return lost


def upsert_stream(events: DataFrame, path: str, checkpoint: str, keys: list[str], seq: str, op: str = "_op", buckets: int = 4, available_now: bool = True, **options) -> StreamingQuery:
    """``upsert_batch`` of each micro-batch; ``read_upserted`` reads the table."""
    writer = events.writeStream.foreachBatch(lambda batch, number: upsert_batch(batch, path, keys, seq, op, buckets, number, **options)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def append_stream(events: DataFrame, path: str, checkpoint: str, rows_per_file: int = 0, available_now: bool = True) -> StreamingQuery:
    """Appends by the file sink, whose log makes each batch count once."""
    writer = events.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def append_transactions(batch: DataFrame, path: str, number: int, rows_each: int = 0, check: Callable[[DataFrame], Column] | None = None) -> list[str]:
    """One micro-batch as transactions: folders ``batch=N/part=K`` of ``rows_each`` rows each (0: one for all; the last
    may have fewer), each all or nothing. ``check`` gives the error of a row or null; a transaction with an error is
    left out whole and its rows go to ``<path>_failed``. Returns the committed folders; a repeated batch replaces its own.

    Rows are dealt by running number, in the order in which they come, so equal rows and columns of any type are dealt
    like others."""
    spark = batch.sparkSession
    rows = with_index(batch.withColumn("_error", check(batch) if check else F.lit(None).cast("string")), [])
    told = rows.withColumn("part", F.floor(F.col("_index") / (rows_each or TOP)).cast("int")).drop("_index")
    bad = told.where("_error IS NOT NULL").select("part").distinct()
    good = told.join(bad, "part", "left_anti").drop("_error")
    for name in (f"{path}/batch={number}", f"{path}_failed/batch={number}"):
        remove(spark, name)
    good.repartition("part").write.partitionBy("part").parquet(f"{path}/batch={number}")
    told.join(bad, "part", "left_semi").write.parquet(f"{path}_failed/batch={number}")
    return sorted(f"batch={number}/{x}" for x in names_in(spark, f"{path}/batch={number}") if x.startswith("part="))


def route_stream(events: DataFrame, checkpoint: str, sinks: dict[str, Callable[[DataFrame, int], None]], column: str = "cdc_destination", available_now: bool = True) -> StreamingQuery:
    """Each micro-batch's rows to the sink of their destination."""

    def apply(batch: DataFrame, number: int) -> None:
        batch.persist()
        for name, sink in sinks.items():
            sink(batch.where(F.col(column) == name), number)
        batch.unpersist()

    writer = events.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def once_within(events: DataFrame, at: str, keys: list[str], delay: str) -> DataFrame:
    """The first event of each key inside the watermark's delay."""
    return events.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)
