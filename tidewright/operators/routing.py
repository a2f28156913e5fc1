"""Success, failure and retry: routes, metrics, the error taxonomy, rollback and retries with backoff."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from enum import Enum

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window


class Route(str, Enum):
    SUCCESS = "success"
    FAILURE = "failure"
    RETRY = "retry"


class ErrorType(Enum):
    """What failed and for how long: (route, penalised)."""

    PERSISTENT_FAILURE = (Route.FAILURE, True)
    UNKNOWN_FAILURE = (Route.FAILURE, True)
    INVALID_INPUT = (Route.FAILURE, False)
    TEMPORAL_FAILURE = (Route.RETRY, False)
    TEMPORAL_INPUT_FAILURE = (Route.RETRY, True)
    DEFER = (Route.RETRY, False)

    @property
    def route(self) -> Route:
        return self.value[0]


#: SQLSTATE classes of errors that pass: connection, transaction rollback, resources, operator intervention.
TRANSIENT_CLASSES = frozenset({"08", "40", "53", "57"})


def classify_sqlstate(state: str | None) -> ErrorType:
    if not state:
        return ErrorType.UNKNOWN_FAILURE
    return ErrorType.TEMPORAL_FAILURE if state[:2] in TRANSIENT_CLASSES else ErrorType.INVALID_INPUT if state[:2] in {"22", "23", "42"} else ErrorType.PERSISTENT_FAILURE


def classify_code(code: int) -> ErrorType:
    """Warehouse error codes: 1xxxx and 2xxxx invalid, 3xxxx to be retried, 4xxxx invalid, others pass."""
    group = code // 10000
    return ErrorType.INVALID_INPUT if group in (1, 2, 4) else ErrorType.TEMPORAL_INPUT_FAILURE if group == 3 else ErrorType.TEMPORAL_FAILURE


def classify(error: Exception) -> ErrorType:
    state = getattr(error, "getSqlState", lambda: None)()
    return classify_sqlstate(state)


def routed(df: DataFrame, error: str = "_error", transient: str = "(?i)timeout|connection|deadlock|lock") -> DataFrame:
    """``df`` with ``_route`` from its error text: none is success, a transient one retry, any other failure."""
    route = F.when(F.col(error).isNull(), Route.SUCCESS.value).when(F.col(error).rlike(transient), Route.RETRY.value).otherwise(Route.FAILURE.value)
    return df.withColumn("_route", route)


def parts(df: DataFrame) -> dict[Route, DataFrame]:
    """The rows of each route; cache ``df`` first if it is costly, as each is its own filter."""
    return {r: df.where(F.col("_route") == r.value).drop("_route") for r in Route}


def metrics(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows in, failed and out (in less failed), in all or by group; one grouping with partial sums."""
    failed = F.count_if(F.col("_error").isNotNull())
    grouped = df.groupBy(*by) if by else df.groupBy()
    return grouped.agg(F.count("*").alias("rows_in"), failed.alias("rows_failed"), (F.count("*") - failed).alias("rows_out"))


def error_table(df: DataFrame, unit: str) -> DataFrame:
    """(unit, _error, n): every message of every input unit and how many rows have it; a row a message, in no array."""
    return df.where(F.col("_error").isNotNull()).groupBy(unit, "_error").agg(F.count("*").alias("n"))


def errors_by(df: DataFrame, unit: str, most: int | None = None) -> DataFrame:
    """For each input unit how many rows failed, and its distinct messages in order.

    With ``most`` only the first so many are brought together, however many a unit has; ``error_table`` has them all.
    """
    bad = error_table(df, unit)
    if most is None:
        return bad.groupBy(unit).agg(F.sum("n").alias("rows_failed"), F.sort_array(F.collect_list("_error")).alias("messages"))
    counted = bad.groupBy(unit).agg(F.sum("n").alias("rows_failed"))
    first = bad.withColumn("_i", F.row_number().over(Window.partitionBy(unit).orderBy("_error"))).where(F.col("_i") <= most)
    told = first.groupBy(F.col(unit).alias("_unit")).agg(F.sort_array(F.collect_list("_error")).alias("messages"))
    return counted.join(told, F.col(unit).eqNullSafe(F.col("_unit"))).drop("_unit")


def _measures(by: str | None, values: list) -> list[Column]:
    """Rows in and failed, of all rows and of those with each value (each may be null) of a column."""
    out = []
    for i, which in enumerate([F.lit(True), *[F.col(by).eqNullSafe(F.lit(v)) for v in values]]):
        out += [F.count_if(which).alias(f"in_{i}"), F.count_if(which & F.col("_error").isNotNull()).alias(f"failed_{i}")]
    return out


def _told(found: dict, values: list) -> dict:
    rows = [(found[f"in_{i}"], found[f"failed_{i}"], found[f"in_{i}"] - found[f"failed_{i}"]) for i in range(len(values) + 1)]
    return {"all": rows[0], "by": dict(zip(values, rows[1:], strict=True))}


def observed(df: DataFrame, by: str | None = None, values: list = ()) -> tuple[DataFrame, Callable[[], dict]]:
    """(``df``, a function that tells its metrics): counted while whatever uses ``df`` runs, without a pass of their own.

    The function waits for the first action on ``df`` (or on what is made of it) and gives ``all`` and, for each of
    ``values`` in the column ``by``, (rows in, failed, out). Each value is an aggregate of the pass, so they should be few.
    """
    seen, values = Observation(), list(values)
    return df.observe(seen, *_measures(by, values)), lambda: _told(seen.get, values)


def observed_stream(df: DataFrame, name: str, by: str | None = None, values: list = ()) -> DataFrame:
    """A stream whose metrics are counted in each trigger under a name; ``stream_metrics`` reads them."""
    return df.observe(name, *_measures(by, list(values)))


def stream_metrics(query: StreamingQuery, name: str, values: list = ()) -> dict:
    """The metrics of a query's triggers so far (of those that Spark still keeps the progress of), as of ``observed``."""
    total: dict[str, int] = {}
    for progress in query.recentProgress:
        row = (progress.observedMetrics or {}).get(name)
        for key, n in (row.asDict() if row else {}).items():
            total[key] = total.get(key, 0) + n
    values = list(values)
    return _told(total or dict.fromkeys([f"{x}_{i}" for x in ("in", "failed") for i in range(len(values) + 1)], 0), values)


def all_or_nothing(df: DataFrame, publish: Callable[[DataFrame], None]) -> bool:
    """Publishes only if no row failed; else changes nothing."""
    if df.where(F.col("_error").isNotNull()).isEmpty():
        publish(df.drop("_error"))
        return True
    return False


def first_error_stops(df: DataFrame) -> DataFrame:
    """The rows without ``_error``; reading one with an error fails the job."""
    stop = F.when(F.col("_error").isNotNull(), F.raise_error(F.col("_error")))
    return df.withColumn("_stop", stop).where(F.col("_stop").isNull()).drop("_stop", "_error")


class CommitConflict(RuntimeError):
    """Another writer committed first; the same commit may succeed when tried again."""


def retried(action: Callable[[], object], retries: int = 10, least: float = 0.1, most: float = 2.0, total: float = 30.0, on: tuple[type[Exception], ...] = (CommitConflict,), sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic) -> object:
    """Runs a driver-side commit up to ``retries`` + 1 times, waiting twice as long each time, up to ``total`` seconds.
    Only conflicts are tried again; any other error ends it at once."""
    began, wait = clock(), least
    for attempt in range(retries + 1):
        try:
            return action()
        except on:
            if attempt == retries or clock() - began + wait > total:
                raise
            sleep(wait * random.uniform(0.9, 1.1))
            wait = min(most, 2 * wait)
    raise AssertionError
