"""Tables that logged statements read and write, as a job over the log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NAME = "([A-Za-z_][A-Za-z0-9_]*(?:\\.[A-Za-z_][A-Za-z0-9_]*)?)"


def _bare(text: Column) -> Column:
    """Without comments, quoted texts and identifier quotes."""
    for pattern, by in (("--[^\\n]*", " "), ("(?s)/\\*.*?\\*/", " "), ("'(?:[^']|'')*'", "''"), ("[`\"]", "")):
        text = F.regexp_replace(text, pattern, by)
    return text


def lineage(log: DataFrame, statement: str = "statement") -> DataFrame:
    """``log`` with ``input_tables`` and ``output_tables``, distinct and sorted; names keep their database. Names that
    the statement itself defines (WITH x AS) are no inputs."""
    text = _bare(F.lower(F.col(statement)))
    read = F.regexp_extract_all(text, F.lit(f"\\b(?:from|join)\\s+{_NAME}"), F.lit(1))
    wrote = F.regexp_extract_all(text, F.lit(f"\\b(?:insert\\s+(?:into|overwrite)(?:\\s+table)?|create\\s+(?:external\\s+)?table(?:\\s+if\\s+not\\s+exists)?|merge\\s+into|update)\\s+{_NAME}"), F.lit(1))
    named = F.regexp_extract_all(text, F.lit("(?:\\bwith|,)\\s+([a-z_][a-z0-9_]*)\\s+as\\s*\\("), F.lit(1))
    return log.withColumn("input_tables", F.sort_array(F.array_except(F.array_distinct(read), named))).withColumn("output_tables", F.sort_array(F.array_distinct(wrote)))


def edges(log: DataFrame, key: str) -> DataFrame:
    """(key, src, dst) for each pair of a statement's input and output."""
    return lineage(log).select(key, F.explode("input_tables").alias("src"), "output_tables").select(key, "src", F.explode("output_tables").alias("dst"))
