"""Text rules: quoting, trimming, identifiers, statement and argument splitting, paths, sizes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = {"B": 1, "KB": 1 << 10, "MB": 1 << 20, "GB": 1 << 30, "TB": 1 << 40}


def quoted(c: Column, mode: str = "as_needed", col: str = "^|", row: str = "@@\n", quote: str = '"') -> Column:
    """A field for a delimited file: quoted never, always, or where it holds the quote or a delimiter. Quotes double."""
    wrapped = F.concat(F.lit(quote), F.replace(c, F.lit(quote), F.lit(quote * 2)), F.lit(quote))
    if mode == "never":
        return c
    if mode == "always":
        return wrapped
    needs = F.contains(c, F.lit(quote)) | F.contains(c, F.lit(col)) | F.contains(c, F.lit(row))
    return F.when(needs, wrapped).otherwise(c)


def unquoted(c: Column) -> Column:
    """Without one pair of outer double quotes."""
    return F.when((F.length(c) > 1) & F.startswith(c, F.lit('"')) & F.endswith(c, F.lit('"')), F.substring(c, F.lit(2), F.length(c) - 2)).otherwise(c)


def flat_lines(c: Column) -> Column:
    """Line ends as blanks."""
    return F.regexp_replace(c, "\r?\n", " ")


def normal_name(name: str) -> str:
    return name.upper().replace("_", "")


def identifier(name: str) -> str:
    """Only [A-Za-z0-9_]; a leading digit gets a _ before it."""
    name = re.sub(r"[^A-Za-z0-9_]", "_", name)
    return f"_{name}" if name[:1].isdigit() else name


def table_identifier(name: str) -> str:
    return re.sub(r"[. ]", "_", name)


def column_label(name: str) -> str:
    """c of a.b.c"""
    return name.rpartition(".")[2]


def identifier_column(c: Column) -> Column:
    clean = F.regexp_replace(c, "[^A-Za-z0-9_]", "_")
    return F.when(clean.rlike("^[0-9]"), F.concat(F.lit("_"), clean)).otherwise(clean)


def statements(text: str) -> list[str]:
    """Statements split at semicolons without a backslash; an escaped one is a plain semicolon."""
    return [x for x in (part.replace(r"\;", ";").strip() for part in re.split(r"(?<!\\);", text)) if x]


def statements_column(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, r"(?<!\\);"), lambda x: F.trim(F.replace(x, F.lit(r"\;"), F.lit(";")))), lambda x: x != "")


def arguments(text: str, delimiter: str = " ") -> list[str]:
    """Arguments split at the delimiter, tabs and line ends, but not within double quotes, which go."""
    parts = re.findall(r'(?:"[^"]*"|[^"\t\r\n' + re.escape(delimiter) + r"])+", text)
    return [p.replace('"', "") for p in parts]


def plain_double(c: Column | str) -> Column:
    """A double's shortest text, as most databases give it: an exponent below 1e-4 and from 1e16 on only; -0.0 keeps its sign."""
    c = F.col(c) if isinstance(c, str) else c
    size, own = F.abs(c), c.cast("string")
    digits = F.regexp_replace(F.regexp_replace(own.try_cast("decimal(38,21)").cast("string"), "0+$", ""), "[.]$", ".0")
    power = F.regexp_extract(own, "E(-?[0-9]+)$", 1).try_cast("int")
    short = F.concat(F.regexp_extract(own, "^(.*?)([.]0)?E", 1), F.when(power < 0, "e-").otherwise("e+"), F.when(F.abs(power) < 10, "0").otherwise(""), F.abs(power).cast("string"))
    odd = F.when(F.isnan(c), "nan").when(size == float("inf"), F.when(c > 0, "inf").otherwise("-inf"))
    return F.coalesce(odd, F.when((size == 0) | size.between(1e-3, 9_999_999), own).when((size >= 1e-4) & (size < 1e16), digits).otherwise(short))


def path_partitions(c: Column) -> Column:
    """key to value of the k=v parts of a path."""
    return F.map_from_arrays(F.regexp_extract_all(c, F.lit("([^/=]+)=([^/]+)"), F.lit(1)), F.regexp_extract_all(c, F.lit("([^/=]+)=([^/]+)"), F.lit(2)))


def threshold(c: Column, total: Column) -> Column:
    """``80%`` of the total, or bytes of ``10 GB``."""
    number = F.regexp_extract(c, r"^\s*([0-9.]+)", 1).try_cast("double")
    unit = F.upper(F.regexp_extract(c, r"([A-Za-z]+)\s*$", 1))
    factor = F.create_map(*[F.lit(x) for pair in UNITS.items() for x in pair])[unit]
    return F.when(F.contains(c, F.lit("%")), number * total / 100).otherwise(number * F.coalesce(factor, F.lit(1)))
