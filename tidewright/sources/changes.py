"""Change-event sources: JSON envelopes, table filters, and snapshots followed by changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The operation letters of change envelopes.
LETTERS = {"c": "INSERT", "r": "UPSERT", "u": "UPDATE", "d": "DELETE"}


def envelopes(df: DataFrame, after: str, before: str, op: Column, key: list[str], destination: str, seq: str, connector: str) -> DataFrame:
    """Change rows as (cdc_key, value, cdc_destination, cdc_partition, cdc_connector), value as JSON text."""
    body = F.struct(F.col(before).alias("before"), F.col(after).alias("after"), op.alias("op"), F.col(seq).alias("seq"))
    keys = F.struct(*[F.coalesce(F.col(f"{after}.{k}"), F.col(f"{before}.{k}")).alias(k) for k in key])
    return df.select(F.to_json(keys).alias("cdc_key"), F.to_json(body).alias("value"), F.lit(destination).alias("cdc_destination"), F.pmod(F.xxhash64(F.to_json(keys)), F.lit(8)).cast("int").alias("cdc_partition"), F.lit(connector).alias("cdc_connector"))


def parsed(events: DataFrame, row_schema: str, include: list[str] | None = None) -> DataFrame:
    """Envelopes without tombstones, of the included tables (regular expressions, whole names), with the row of each
    change (the one before, for deletes), ``_op`` and ``_seq``. Works on batches and streams."""
    kept = events.where(F.col("value").isNotNull())
    if include:
        kept = kept.where(F.col("cdc_destination").rlike("^(?:" + "|".join(include) + ")$"))
    body = F.from_json("value", f"before struct<{row_schema}>, after struct<{row_schema}>, op string, seq bigint")
    told = kept.withColumn("_b", body)
    names = F.create_map(*[F.lit(x) for pair in LETTERS.items() for x in pair])
    return told.select("cdc_key", "cdc_destination", "cdc_partition", "cdc_connector", names[F.col("_b.op")].alias("_op"), F.col("_b.seq").alias("_seq"), F.when(F.col("_b.op") == "d", F.col("_b.before")).otherwise(F.col("_b.after")).alias("row"))


def stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 16) -> DataFrame:
    """Envelope files as a stream, so many at a time; offsets live in the checkpoint."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def with_snapshot(snapshot: DataFrame, changes: DataFrame, mode: str = "initial", have_offsets: bool = False) -> DataFrame:
    """The snapshot's rows as upserts before all changes, then the changes. ``mode``: initial, no_data, when_needed
    (unless offsets are known) or never. ``changes`` has the snapshot's columns, _op and _seq."""
    if mode in ("no_data", "never") or mode == "when_needed" and have_offsets:
        return changes
    first = snapshot.withColumn("_op", F.lit("UPSERT")).withColumn("_seq", F.lit(-1).cast("long"))
    return first.unionByName(changes.select(*first.columns))
