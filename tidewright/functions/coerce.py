"""Coercions with the exact rules of record movement: a value that can't become the type is null here, and a reject in
``coerce_rows``. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names of ISO formatters as Spark patterns.
ISO_PATTERNS = {
    "BASIC_ISO_DATE": "yyyyMMdd", "ISO_LOCAL_DATE": "yyyy-MM-dd", "ISO_DATE": "yyyy-MM-dd", "ISO_LOCAL_TIME": "HH:mm:ss", "ISO_TIME": "HH:mm:ss",
    "ISO_LOCAL_DATE_TIME": "yyyy-MM-dd'T'HH:mm:ss", "ISO_DATE_TIME": "yyyy-MM-dd'T'HH:mm:ss", "ISO_OFFSET_DATE_TIME": "yyyy-MM-dd'T'HH:mm:ssXXX",
    "ISO_ZONED_DATE_TIME": "yyyy-MM-dd'T'HH:mm:ssXXX", "ISO_ORDINAL_DATE": "yyyy-DDD", "ISO_INSTANT": "yyyy-MM-dd'T'HH:mm:ssX", "RFC_1123_DATE_TIME": "EEE, dd MMM yyyy HH:mm:ss Z",
}
DEFAULT_PATTERN = "yyyy-MM-dd HH:mm:ss"
#: The patterns of the named timestamp types.
NAMED_PATTERNS = {"DATE": "yyyy-MM-dd", "TIMESTAMP": "yyyy-MM-dd HH:mm:ss", "TIMESTAMP_MILLIS": "yyyy-MM-dd HH:mm:ss.SSS", "TIMESTAMP_MICROS": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


def to_boolean(c: Column, lenient: bool = False) -> Column:
    """true or false in any case; anything else is no boolean (``lenient``: is false)."""
    low = F.lower(c.cast("string"))
    return F.when(low == "true", True).when(low == "false", False).otherwise(F.when(c.isNotNull(), False) if lenient else F.lit(None).cast("boolean"))


def to_number(c: Column, kind: str) -> Column:
    """A checked cast of a number or a text."""
    return c.try_cast(kind)


def date_number(c: Column, kind: str = "bigint") -> Column:
    """A date or timestamp as epoch milliseconds in a numeric type; null where they don't fit."""
    return F.unix_millis(c.cast("timestamp")).try_cast(kind)


def decimal_rounded(c: Column, precision: int, scale: int) -> Column:
    """HALF_UP to the scale; null beyond the precision."""
    return c.try_cast(f"decimal({precision},{scale})")


def decimal_exact(c: Column, precision: int, scale: int) -> Column:
    """Padded with zeros only: null if digits would be lost."""
    wide, narrow = c.try_cast("decimal(38,18)"), c.try_cast(f"decimal({precision},{scale})")
    return F.when(wide == narrow.cast("decimal(38,18)"), narrow)


def epoch_millis_text(c: Column) -> Column:
    return F.timestamp_millis(F.trim(c).try_cast("bigint"))


def to_timestamp(c: Column, pattern: str | None = None) -> Column:
    """A text by pattern, else as epoch milliseconds; trimmed, empty is null."""
    text = F.nullif(F.trim(c), F.lit(""))
    by_pattern = F.try_to_timestamp(text, F.lit(ISO_PATTERNS.get(pattern or "", pattern or DEFAULT_PATTERN)))
    return F.coalesce(by_pattern, epoch_millis_text(text))


def pattern_for(column: str, options: dict[str, str]) -> str:
    """``column.all.pattern``, else ``column.<name>.pattern``, else the default."""
    return options.get("column.all.pattern") or options.get(f"column.{column}.pattern") or DEFAULT_PATTERN


def patterns_of_formats(formats: list[dict]) -> dict[str, str]:
    """Options from ``[{"column-name": .., "timestamp-pattern": .., "type": ..}]``; a type names a pattern."""
    return {f"column.{f['column-name']}.pattern": f.get("timestamp-pattern") or NAMED_PATTERNS[f.get("type", "TIMESTAMP")] for f in formats}


def add_hours(c: Column, hours: int) -> Column:
    return c + F.make_interval(hours=F.lit(hours))


def to_date(c: Column, pattern: str | None = None) -> Column:
    """A text by pattern; without one, epoch-millisecond text. Session time zone."""
    text = F.nullif(F.trim(c), F.lit(""))
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date") if pattern else epoch_millis_text(text).cast("date")


def lake_date(c: Column) -> Column:
    """A number is an epoch day."""
    return F.date_from_unix_date(c.cast("int"))


def lake_timestamp(c: Column) -> Column:
    """A number is epoch milliseconds."""
    return F.timestamp_millis(c.cast("bigint"))


def lake_timestamp_text(c: Column) -> Column:
    """An ISO instant, or a local date and time, which is read as UTC."""
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ssX")), F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss")))


def same_day_in_utc(c: Column, zone: str) -> Column:
    """The instant of a date's midnight by the wall clock of UTC, whatever the zone."""
    return F.to_utc_timestamp(F.from_utc_timestamp(c.cast("timestamp"), zone), zone)


def micros_text(c: Column) -> Column:
    """A timestamp as text with microseconds and Z (UTC session)."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def to_text(c: Column, kind: str, pattern: str | None = None) -> Column:
    """Dates by pattern, else as epoch milliseconds; arrays as [a, b]; bytes as UTF-8."""
    if kind in ("date", "timestamp"):
        return F.date_format(c, pattern) if pattern else F.unix_millis(c.cast("timestamp")).cast("string")
    if kind.startswith("array"):
        return F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: x.cast("string")), ", "), F.lit("]"))
    return F.decode(c, "UTF-8") if kind == "binary" else c.cast("string")


def uuid_bytes(c: Column) -> Column:
    """16 bytes, big endian."""
    return F.unhex(F.regexp_replace(c, "-", ""))


def uuid_text(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.hex(c)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def to_binary(c: Column, form: str = "ascii") -> Column:
    """Bytes of a text in ascii, hex or base64."""
    return F.unhex(c) if form == "hex" else F.unbase64(c) if form == "base64" else F.encode(c, "UTF-8")


def fixed_length(c: Column, n: int) -> Column:
    return F.when(F.octet_length(c) == n, c)


def one_of(c: Column, symbols: list[str]) -> Column:
    return F.when(c.isin(symbols), c)


def branch(c: Column, kinds: list[str]) -> Column:
    """For a union and a text: the first type that takes it, and its value as text; empty stays text."""
    from tidewright.functions.types import compatible

    taken = [F.when(compatible(c, k), F.struct(F.lit(k).alias("kind"), (to_boolean(c) if k == "boolean" else c.try_cast(k)).cast("string").alias("value"))) for k in kinds if k != "string"]
    text = F.struct(F.lit("string").alias("kind"), c.alias("value"))
    return F.when(c.isNotNull(), F.coalesce(*taken, text))


def lenient(c: Column, kind: str) -> Column:
    """(value, text): the converted value, and the text where it can't be converted."""
    value = coerced(c, kind)
    return F.struct(value.alias("value"), F.when(value.isNull(), c).alias("text"))


def coerced(c: Column, kind: str, pattern: str | None = None) -> Column:
    """The value as ``kind`` or null."""
    if kind == "boolean":
        return to_boolean(c)
    if kind == "timestamp":
        return to_timestamp(c.cast("string"), pattern)
    if kind == "date":
        return to_date(c.cast("string"), pattern or "yyyy-MM-dd")
    if kind == "binary":
        return to_binary(c)
    return c.cast("string") if kind == "string" else c.try_cast(kind)


def coerce_rows(df: DataFrame, kinds: dict[str, str], patterns: dict[str, str] | None = None) -> DataFrame:
    """``df`` with the columns coerced and ``_error``, which names the fields that can't be (null: none)."""
    patterns = patterns or {}
    new = {c: coerced(F.col(c), k, pattern_for(c, patterns) if k == "timestamp" else None) for c, k in kinds.items()}
    bad = F.concat_ws(", ", *[F.when(F.col(c).isNotNull() & v.isNull(), F.lit(c)) for c, v in new.items()])
    return df.select("*", F.nullif(bad, F.lit("")).alias("_error")).select(*[(new[c].alias(c) if c in new else F.col(c)) for c in df.columns], "_error")
