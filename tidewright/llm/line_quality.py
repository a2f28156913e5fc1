"""Quality rules: counts within each text, and line frequency across the documents of a host.

Everything is DataFrame operations. A line is normalised (lower case, runs of white space as one blank, trimmed) and
hashed. Lines in more distinct documents of a host than its limit are boilerplate: the limit is ``share`` of the host's
documents, at least ``min_docs`` and at most ``most_docs``, so in large hosts it is absolute. A document is depleted,
and rejected, when boilerplate makes up more than ``max_removed`` of its words.

Documents of a host with the same text count once, so a group of exact copies doesn't make its own lines boilerplate.
Counting runs on (host, line, text) triples with partial aggregation. The triples are written once to the shared folder
and read twice. What is found about lines and texts is joined by ``with_found``, which broadcasts a table of checked
size and salts the key beyond it, so neither a hot host, a hot line nor a group of copies gathers in one task.

A null text has no words and no lines and fails the base rules; a null host is the host ''. Repeated rows get the same
verdict. An empty table gives an empty result. Other columns are left alone, but for columns named like the results,
which are replaced, and columns whose names begin with ``_lq_``, which are working columns and are dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import with_found, written

SPACE = "[\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Bits of a packed window key that hold its position; longer texts take keys of two fields.
POSITION_BITS = 20


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.transform(F.array(value), body)[0]


def without(text: Column, chars: str) -> Column:
    for x in chars:
        text = F.replace(text, F.lit(x), F.lit(""))
    return text


def words_of(text: Column) -> Column:
    """The words of a text that isn't null, split without a pass over the words."""
    inner = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE))


def _covered(positions: Column) -> Column:
    """How many words the 3-word windows at these ascending positions cover."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    return F.aggregate(positions, zero, lambda a, p: F.struct((a["n"] + p + 3 - F.greatest(p, a["upto"])).alias("n"), (p + 3).alias("upto")), lambda a: a["n"])


def repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more. Windows are compared by 64-bit hashes.

    Hashes are sorted together with their positions; equal neighbours are the repeats. A key has a hash's low bits above
    the position, and whole hashes are compared where keys agree.
    """
    top = 1 << POSITION_BITS

    def of_pairs(pairs: Column) -> Column:
        return _covered(F.sort_array(F.array_distinct(F.flatten(pairs))))

    def packed(h: Column) -> Column:
        keys = F.sort_array(F.transform(h, lambda x, i: F.shiftleft(x, POSITION_BITS).bitwiseOR(i.cast("long"))))
        place = lambda x: x.bitwiseAND(F.lit(top - 1).cast("long"))
        whole = lambda x: F.get(h, place(x).cast("int"))
        same = lambda x, y: (F.shiftright(x, POSITION_BITS) == F.shiftright(y, POSITION_BITS)) & (whole(x) == whole(y))
        # keys that differ above the position are told apart by one comparison
        first = lambda s: F.filter(F.sequence(F.lit(0), F.size(s) - 2), lambda i: F.coalesce(same(F.get(s, i), F.get(s, i + 1)), F.lit(False)))
        return let(keys, lambda s: of_pairs(F.transform(first(s), lambda i: F.array(place(F.get(s, i)), place(F.get(s, i + 1))))))

    def paired(h: Column) -> Column:
        keys = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.cast("long").alias("p"))))
        first = lambda s: F.filter(F.sequence(F.lit(0), F.size(s) - 2), lambda i: F.coalesce(F.get(s, i)["h"] == F.get(s, i + 1)["h"], F.lit(False)))
        return let(keys, lambda s: of_pairs(F.transform(first(s), lambda i: F.array(F.get(s, i)["p"], F.get(s, i + 1)["p"]))))

    def counted(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).when(F.size(h) < top, packed(h)).otherwise(paired(h))

    hashes = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return let(words, lambda w: F.when(F.size(w) < 3, F.lit(0).cast("long")).otherwise(let(hashes(w), counted)))


def lines_of(text: Column) -> Column:
    """The \\n-split lines with a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))


def base_counts(text: Column) -> Column:
    """A struct of the counts; the text is split into words once for all of them."""
    text = F.coalesce(text, F.lit(""))
    return let(
        words_of(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
            let(lines_of(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeat_words(w).alias("n_repeat_words"),
        ),
    )


KEY = ["_lq_host", "_lq_text", "_lq_length"]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def text_key(text: Column, host: Column) -> dict[str, Column]:
    """What tells the texts of a host apart."""
    return dict(zip(KEY, (F.coalesce(host.cast("string"), F.lit("")), F.xxhash64(text), F.length(text)), strict=True))


def normal_lines(text: Column) -> Column:
    """The normalised lines of a text, with empty ones where a line has no word."""
    runs = "[\\x09\\x0B-\\x0D][\\x20\\x09\\x0B-\\x0D]*|\\x20[\\x20\\x09\\x0B-\\x0D]+"  # all but single blanks
    return F.transform(F.split(F.regexp_replace(F.lower(text), runs, " "), "\n", -1), F.trim)


def boilerplate(docs: DataFrame, min_docs: int = 20, share: float = 0.1, most_docs: int = 200, text_col: str = "text", host_col: str = "source", lines: bool = False) -> DataFrame:
    """KEY of the texts with boilerplate lines and how many words those hold (``_lq_words``); with ``lines`` also the lines' hashes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    line = lambda x: F.struct(F.xxhash64(x).alias("line"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).cast("long").alias("words"))
    # besides its lines each row gives one entry without a line, which counts the rows of a text and the texts of a host
    itself = F.array(F.struct(F.lit(None).cast("long").alias("line"), F.lit(0).cast("long").alias("words")))
    own = F.transform(F.filter(normal_lines(text), lambda x: x != ""), line)
    rows = docs.select(*[v.alias(k) for k, v in text_key(text, F.col(host_col)).items()], F.explode(F.concat(itself, own)).alias("x"))
    each = rows.groupBy(*KEY, F.col("x.line").alias("line")).agg(F.max("x.words").alias("words"), F.count("*").alias("times"))
    each = written(each, "host-lines")
    counts = each.groupBy("_lq_host", "line").agg(F.count("*").alias("docs"))
    sizes = counts.where(F.col("line").isNull()).select("_lq_host", F.col("docs").alias("host_docs"))
    limit = F.greatest(F.lit(min_docs), F.least(F.lit(most_docs), F.col("host_docs") * share))
    often = counts.where(F.col("line").isNotNull() & (F.col("docs") > min_docs)).join(sizes, "_lq_host").where(F.col("docs") > limit)
    marked = with_found(each, written(often.select("_lq_host", "line", F.lit(True).alias("often")), "often-lines"), ["_lq_host", "line"])
    found = marked.where("often OR line IS NULL").groupBy(*KEY).agg(
        F.sum(F.when(F.col("often"), F.col("words") * F.col("times")).otherwise(0)).alias("words"), F.max(F.when(F.col("line").isNull(), F.col("times"))).alias("copies"), *([F.collect_set("line").alias("_lq_lines")] if lines else [])
    )
    return found.where("words > 0").select(*KEY, F.expr("words div copies").alias("_lq_words"), *(["_lq_lines"] if lines else []))


def quality_rules(docs: DataFrame, min_docs: int = 20, share: float = 0.1, most_docs: int = 200, max_removed: float = 0.5, min_words: int = 50, max_repeat: float = 0.5, clean: bool = False, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``docs`` with the base counts, ``removed_words``, ``base_failed`` and ``kept``; with ``clean``, ``text`` loses its
    boilerplate lines. A text that occurs more than once in a host has as many removed words as one copy."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = [c for c in docs.columns if c not in {*COUNTS, "removed_words", "base_failed", "kept"} and not c.startswith("_lq_")]
    found = written(boilerplate(docs, min_docs, share, most_docs, text_col, host_col, clean), "texts-with-boilerplate")
    wide = docs.select(*own, *[v.alias(k) for k, v in text_key(text, F.col(host_col)).items()], base_counts(F.col(text_col)).alias("_lq_counts"))
    joined = with_found(wide, found, KEY).select(*own, *[F.col(f"_lq_counts.{c}") for c in COUNTS], *[c for c in found.columns if c not in KEY])
    removed = F.coalesce(F.col("_lq_words"), F.lit(0)).cast("long")
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    out = joined.withColumn("removed_words", removed).withColumn("base_failed", failed).withColumn("kept", ~failed & (removed <= max_removed * F.col("n_words")))
    if clean:
        whole = F.arrays_zip(F.split(F.col(text_col), "\n", -1).alias("own"), normal_lines(F.col(text_col)).alias("plain"))
        left = F.array_join(F.transform(F.filter(whole, lambda x: ~F.array_contains("_lq_lines", F.xxhash64(x["plain"]))), lambda x: x["own"]), "\n")
        out = out.withColumn(text_col, F.when(F.col("_lq_lines").isNull(), F.col(text_col)).otherwise(left))
    return out.drop("_lq_words", "_lq_lines")
