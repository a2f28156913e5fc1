"""Threshold alerts with re-arming, usage metrics, payload rows, and the consecutive-failure lockout."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent_used(used: Column, total: Column) -> Column:
    return F.when(total > 0, used * 100 / total)


def scanned(rows: DataFrame, keys: list[str], order: list[str], start: Callable[[], object], step: Callable[[object, pa.RecordBatch], tuple[object, pa.RecordBatch]], schema) -> DataFrame:
    """A scan of each key's rows in order, with a state that is carried from batch to batch.

    Rows are dealt by key and sorted, which spills; a task holds one batch and one key's state, so a hot key costs time
    in its task but no memory. ``step`` gets the state and the next rows of one key; null keys are a key.
    """
    names = rows.columns

    def run(batches):
        last, state = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            told = [batch.column(names.index(k)).to_pylist() for k in keys]
            own = list(zip(*told, strict=True)) if keys else [()] * batch.num_rows
            cuts = [0, *(i for i in range(1, len(own)) if own[i] != own[i - 1]), len(own)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if last is None or own[a] != last[0]:
                    last, state = (own[a],), start()
                state, out = step(state, batch.slice(a, b - a))
                yield out

    dealt = rows.repartition(*keys) if keys else rows.repartition(1)
    return dealt.sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def chain(state: list, at: np.ndarray, above: np.ndarray, interval: int) -> tuple[list, np.ndarray]:
    """Which of the rows raise an alert; ``state`` is the last alert's time in the present stretch, or None if armed.

    Looks at the rows that end a stretch and those that an alert's interval leads to, no others."""
    last, fired, i, n = state[0], np.zeros(len(at), bool), 0, len(at)
    below = np.append(np.flatnonzero(~above), n)
    while i < n:
        if not above[i]:
            last, i = None, i + 1
            continue
        end = int(below[np.searchsorted(below, i)])  # the stretch's end
        while i < end:
            if last is not None:
                i += int(np.searchsorted(at[i:end], last + interval))
                if i >= end:
                    break
            fired[i], last, i = True, int(at[i]), i + 1
        i = end
    return [last], fired


def threshold_alerts(rows: DataFrame, series: list[str], at: str, value: str, threshold: Column, interval_s: int) -> DataFrame:
    """Rows that raise an alert: above the threshold, and first since the series was at or below it, or at least
    ``interval_s`` after the last alert of the same stretch. Rows of one time are taken with the lower value first."""
    marked = rows.select("*", F.coalesce(F.col(value) > threshold, F.lit(False)).alias("_above"), F.unix_micros(at).alias("_at"), F.col(value).alias("_value"))
    n = len(rows.columns)

    def step(state: list, batch: pa.RecordBatch) -> tuple[list, pa.RecordBatch]:
        state, fired = chain(state, batch.column(n + 1).to_numpy(), batch.column(n).to_numpy(zero_copy_only=False), interval_s * 1_000_000)
        return state, batch.filter(pa.array(fired)).select(range(n))

    return scanned(marked, series, ["_at", "_value"], lambda: [None], step, rows.schema)


def payloads(alerts: DataFrame, host: str, kind: str, threshold: Column, values: list[str], properties: dict[str, str] | None = None) -> DataFrame:
    """``alerts`` with ``payload``: JSON of host, type, threshold, measured values and free properties."""
    free = F.create_map(*[F.lit(x) for pair in (properties or {}).items() for x in pair]) if properties else F.lit(None).cast("map<string,string>")
    body = F.struct(F.lit(host).alias("hostname"), F.lit(kind).alias("type"), threshold.alias("threshold"), F.struct(*values).alias("values"), free.alias("properties"))
    return alerts.withColumn("payload", F.to_json(body))


def message(name: Column, used: Column, limit: Column) -> Column:
    return F.format_string("%s is %.2f%% used, over %.2f%%", name, used, limit)


def locked_out(state: tuple[int, int], at_us: list[int], ok: list[bool], most: int, lock_us: int) -> tuple[tuple[int, int], list[str], list[int]]:
    """One user's next attempts in order, with what became of each; ``state`` is failures in a row and the lock's end.

    A failure adds one; at ``most`` in a row the user is locked for a time. Attempts while locked are refused and don't
    count. A success resets the count; the end of a lock doesn't, so the next failure locks again.
    """
    (failures, until), outcome, count = state, [], []
    for at, good in zip(at_us, ok, strict=True):
        if at < until:
            outcome.append("refused")
        elif good:
            failures = 0
            outcome.append("allowed")
        else:
            failures += 1
            until = at + lock_us if failures >= most else until
            outcome.append("locked" if failures >= most else "failed")
        count.append(failures)
    return (failures, until), outcome, count


def lockout(attempts: DataFrame, user: str, at: str, ok: Column, tie: str, most: int = 5, lock_s: int = 900, users: DataFrame | None = None, enabled: str = "enabled") -> DataFrame:
    """(user, tie, outcome, failures) of each attempt, by a scan with one state a user.

    With ``users``, attempts of users that aren't there are ``unknown`` and those of users that aren't ``enabled`` (or
    where that is null) are ``disabled``; neither counts.
    """
    each = attempts.select(F.col(user).alias("user"), F.col(tie).alias("tie"), F.unix_micros(at).alias("at_us"), F.coalesce(ok, F.lit(False)).alias("ok"))

    def step(state: tuple[int, int], batch: pa.RecordBatch) -> tuple[tuple[int, int], pa.RecordBatch]:
        state, outcome, count = locked_out(state, batch.column(2).to_pylist(), batch.column(3).to_pylist(), most, lock_s * 1_000_000)
        return state, pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(outcome, pa.string()), pa.array(count, pa.int64())], ["user", "tie", "outcome", "failures"])

    kinds = {f.name: f.dataType.simpleString() for f in each.schema.fields}
    names, shut = {"user": user, "tie": tie}, None
    if users is not None:
        known = users.groupBy(F.col(user).alias("user")).agg(F.bool_or(F.coalesce(F.col(enabled), F.lit(False))).alias("_enabled"))
        told = each.join(known, "user", "left")
        refused = told.where(~F.coalesce("_enabled", F.lit(False)))
        shut = refused.select("user", "tie", F.when(F.col("_enabled").isNull(), "unknown").otherwise("disabled").alias("outcome"), F.lit(0).cast("long").alias("failures"))
        each = told.where("_enabled").select(each.columns)
    done = scanned(each, ["user"], ["at_us", "tie"], lambda: (0, -1), step, f"user {kinds['user']}, tie {kinds['tie']}, outcome string, failures long")
    return (done if shut is None else done.unionByName(shut)).withColumnsRenamed(names)
