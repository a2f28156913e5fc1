"""Hooks on rows: a function of each data row, and commands that rows are piped through with their exit status."""

from __future__ import annotations

import subprocess
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_columns(df: DataFrame, hook: Callable[[DataFrame], dict[str, Column]]) -> DataFrame:
    """Rows through a hook that gives Column expressions: the first choice, as Spark plans and compiles them."""
    return df.withColumns(hook(df))


def mapped(df: DataFrame, function: Callable[[dict], dict], schema: str) -> DataFrame:
    """Rows through a Python function, in batches; for what ``with_columns``, which stays in the JVM, can't say."""

    def run(batches):
        for batch in batches:
            yield from pa.Table.from_pylist([function(r) for r in batch.to_pylist()], schema=arrow).to_batches()

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)
    return df.mapInArrow(run, schema)


def piped(df: DataFrame, command: list[str], value: str = "value", before: list[str] | None = None, after: list[str] | None = None, batch_rows: int = 10_000) -> DataFrame:
    """Lines of text through a command, so many at a time: (value, status, _error, _route).

    Status 0 gives the output lines on the success route; another status, of the command or of the one before it, gives
    the input lines on the failure route with the command's error text. A line ends at \\n alone. Values that hold one
    can't be told from two lines: they don't reach the command and take the failure route with status -1. Runs what it
    is given; opt-in only.
    """
    columns = ["value", "status", "_error", "_route"]

    def told(lines: list[str], status: int, error: str | None) -> pa.RecordBatch:
        n, failed = len(lines), status != 0
        return pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), pa.array([status] * n, pa.int32()), pa.array([error if failed else None] * n, pa.string()), pa.array(["failure" if failed else "success"] * n, pa.string())], columns)

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, batch_rows):
                given = [x or "" for x in batch.column(0).slice(a, batch_rows).to_pylist()]
                lines = [x for x in given if "\n" not in x]
                if len(lines) < len(given):
                    yield told([x for x in given if "\n" in x], -1, "line end in a value")
                status, error = 0, None
                if before:
                    first = subprocess.run(before, capture_output=True, text=True)
                    status, error = first.returncode, first.stderr
                out = lines
                if status == 0 and lines:
                    done = subprocess.run(command, input=("\n".join(lines) + "\n").encode(), capture_output=True)
                    status, error = done.returncode, done.stderr.decode(errors="replace")
                    text = done.stdout.decode(errors="replace")
                    out = text.removesuffix("\n").split("\n") if status == 0 and text else [] if status == 0 else lines
                    if after:
                        subprocess.run(after, capture_output=True)
                yield told(out, status, error)

    return df.select(F.col(value).cast("string")).mapInArrow(run, "value string, status int, _error string, _route string")
