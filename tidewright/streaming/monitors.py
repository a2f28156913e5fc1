"""Stateful streams: threshold alerts with re-arming, and the consecutive-failure lockout, one state a key.

``alert_stream`` and ``lockout_stream`` take any number of rows a key: each trigger's rows are sorted by Spark, which
spills, and read with the state that their key had after the trigger before; states are a table of upserts. The
functions that give streams, ``threshold_alerts`` and ``lockout``, are for keys whose rows of one trigger fit in a task: these
are gathered and sorted, however many Arrow batches bring them. Ties go by ``tie``. Rows of
later triggers count as later, so sources should bring each key's rows in order between triggers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewright.operators.alerts import chain, locked_out, scanned
from tidewright.operators.changes import last_per_key
from tidewright.sinks.tables import exists
from tidewright.streaming.upserts import read_upserted, upsert_batch

Step = Callable[[tuple[int, ...], pa.RecordBatch], tuple[tuple[int, ...], pa.RecordBatch]]


def _sorted(batches: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    return pd.concat(list(batches)).sort_values(order, kind="stable")


def threshold_alerts(rows: DataFrame, series: str, at_us: str, value: str, threshold: float, interval_s: int) -> DataFrame:
    """(series, at_us, value) of alerts, as in ``operators.alerts``, for rows that come in order within each series."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else -1  # -1: armed
        fired = []
        for at, v in _sorted(batches, [at_us, value])[[at_us, value]].itertuples(index=False):
            if not v > threshold:
                last = -1
            elif last < 0 or at >= last + interval_s * 1_000_000:
                fired.append((key[0], at, v))
                last = at
        yield pd.DataFrame(fired, columns=["series", "at_us", "value"])
        state.update((int(last),))

    return rows.groupBy(series).applyInPandasWithState(run, "series string, at_us long, value double", "last long", "append", GroupStateTimeout.NoTimeout)


def lockout(attempts: DataFrame, user: str, at_us: str, ok: str, most: int = 5, lock_s: int = 900, tie: str | None = None) -> DataFrame:
    """(user, at_us, outcome) of each attempt, as in ``operators.alerts``."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        failures, until = state.get if state.exists else (0, -1)
        out = []
        for at, good in _sorted(batches, [at_us, tie or ok])[[at_us, ok]].itertuples(index=False):
            if at < until:
                out.append((key[0], at, "refused"))
            elif good:
                failures = 0
                out.append((key[0], at, "allowed"))
            else:
                failures += 1
                until = at + lock_s * 1_000_000 if failures >= most else until
                out.append((key[0], at, "locked" if failures >= most else "failed"))
        yield pd.DataFrame(out, columns=["user_id", "at_us", "outcome"])
        state.update((int(failures), int(until)))

    return attempts.groupBy(user).applyInPandasWithState(run, "user_id long, at_us long, outcome string", "failures long, until long", "append", GroupStateTimeout.NoTimeout)


def scan_batch(rows: DataFrame, number: int, path: str, keys: list[str], order: list[str], start: tuple[int, ...], step: Step) -> None:
    """One micro-batch: ``step`` gets a key's state and its next rows in order, and gives the state and the rows' results.

    Results have the keys, the ``order`` columns and what ``step`` adds, and go to ``<path>/results/batch=<number>``; a
    batch that comes again replaces its own. Of each key ``<path>/states`` keeps the state after its last batch and the
    one before that batch, from which a batch that comes again starts. Rows of a null key start afresh in each batch.
    """
    spark, width = rows.sparkSession, len(start)
    held = [f"_s{i}" for i in range(width)]
    joined = rows.withColumns({c: F.lit(None).cast("long") for c in held})
    if exists(spark, f"{path}/states/_snapshots"):
        now = [F.when(F.col("_batch") < number, F.col(c)).otherwise(F.col(f"{c}_before")).alias(c) for c in held]
        joined = rows.join(read_upserted(spark, f"{path}/states").select(*keys, *now), keys, "left").select(*rows.columns, *held)
    names, n = rows.columns, len(rows.columns)
    empty = pa.RecordBatch.from_pylist([], pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in rows.schema.fields]))
    added = step(start, empty)[1].schema

    def run(state, batch: pa.RecordBatch):
        own = batch.select(range(n))
        if state is None:
            first = [batch.column(n + i)[0].as_py() for i in range(width)]
            before = tuple(s if v is None else v for s, v in zip(start, first, strict=True))
            state = before, before
        now, out = step(state[0], own)
        marks = [pa.array(np.full(batch.num_rows, v), pa.int64()) for v in (*now, *state[1])]
        columns = [own.column(names.index(c)) for c in (*keys, *order)]
        return (now, state[1]), pa.RecordBatch.from_arrays([*columns, *out.columns, *marks], [*keys, *order, *added.names, *held, *[f"{c}_before" for c in held]])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in (*keys, *order)), *(f"`{f.name}` {_SQL[f.type]}" for f in added), *(f"{c} long" for c in held), *(f"{c}_before long" for c in held)])
    at = f"{path}/results/batch={number}"
    scanned(joined, keys, order, lambda: None, run, schema).write.mode("overwrite").parquet(at)
    done = last_per_key(spark.read.schema(schema).parquet(at).dropna(subset=keys), keys, order)
    states = done.select(*keys, *held, *[f"{c}_before" for c in held], F.lit(number).cast("long").alias("_batch"), F.lit("UPSERT").alias("_op"))
    upsert_batch(states, f"{path}/states", keys, "_batch", number=number)


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64()}
_SQL = {pa.int64(): "long", pa.string(): "string", pa.bool_(): "boolean", pa.float64(): "double"}


def scan_results(spark, path: str) -> DataFrame:
    """The results of ``scan_batch`` so far."""
    rows = spark.read.option("basePath", f"{path}/results").parquet(f"{path}/results")
    return rows.drop("batch", *[c for c in rows.columns if c.startswith("_s") and c.removeprefix("_s").removesuffix("_before").isdigit()])


def _stream(events: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None], available_now: bool) -> StreamingQuery:
    writer = events.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def lockout_stream(attempts: DataFrame, path: str, checkpoint: str, user: str, at_us: str, ok: Column, tie: str, most: int = 5, lock_s: int = 900, available_now: bool = True) -> StreamingQuery:
    """``operators.alerts.lockout`` of a stream; ``scan_results`` has (user, at_us, tie, outcome, failures) of each attempt."""
    rows = attempts.select(user, F.col(at_us).cast("long").alias(at_us), F.col(tie).cast("long").alias(tie), F.coalesce(ok, F.lit(False)).alias("_ok"))

    def step(state: tuple[int, ...], batch: pa.RecordBatch):
        now, outcome, count = locked_out(state, batch.column(1).to_pylist(), batch.column(3).to_pylist(), most, lock_s * 1_000_000)
        return now, pa.RecordBatch.from_arrays([pa.array(outcome, pa.string()), pa.array(count, pa.int64())], ["outcome", "failures"])

    return _stream(rows, checkpoint, lambda batch, n: scan_batch(batch, n, path, [user], [at_us, tie], (0, -1), step), available_now)


def alert_stream(rows: DataFrame, path: str, checkpoint: str, series: str, at_us: str, value: str, threshold: float, interval_s: int, available_now: bool = True) -> StreamingQuery:
    """``operators.alerts.threshold_alerts`` of a stream; ``scan_results`` has (series, at_us, value, fired) of each row."""
    armed = -(1 << 63)
    kept = rows.select(series, F.col(at_us).cast("long").alias(at_us), F.col(value).cast("double").alias(value))

    def step(state: tuple[int, ...], batch: pa.RecordBatch):
        above = np.array([v is not None and v > threshold for v in batch.column(2).to_pylist()], bool)
        last, fired = chain([None if state[0] == armed else state[0]], batch.column(1).to_numpy(), above, interval_s * 1_000_000)
        return (armed if last[0] is None else last[0],), pa.RecordBatch.from_arrays([pa.array(fired)], ["fired"])

    return _stream(kept, checkpoint, lambda batch, n: scan_batch(batch, n, path, [series], [at_us, value], (armed,), step), available_now)
