"""Delimited text with delimiters of several characters, and CSV with width guards.

``scan`` reads quotes as the format means them: a quote opens a field only as its first character, delimiters inside
quotes are text, a doubled quote is one quote, and text after a closing quote is kept.

One file is read by many tasks. Spark's text source splits it at row delimiters, quoted or not. A first pass tells for
each split how it ends and how many rows begin in it, both for a start at a row and for a start inside quotes; going
through these few results in order gives each split's true start and first row number, and a second pass gives the rows.
Rows that reach over splits come in pieces, which are put together by a grouping of the pieces alone.

Charsets whose characters can hold a delimiter's bytes, delimiters that overlap and compressed files take a plainer way:
a task a file, which is streamed in blocks. ``scan_unquoted`` is for files declared to have no quoted delimiter.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewright.functions.text import quoted, unquoted


class WidthError(ValueError):
    """A row has another number of fields than expected."""


def parse(text: str, col: str, row: str, quote: str = '"', preserve: bool = False) -> Iterator[list[str]]:
    """Rows of fields. A last row without delimiter counts; an empty end doesn't."""
    for fields, _ in _rows(text, col, row, quote, preserve):
        yield fields


def parse_blocks(blocks: Iterator[str], col: str, row: str, quote: str = '"', preserve: bool = False) -> Iterator[list[str]]:
    """As ``parse``, of a text that comes in blocks; what follows a block's last row delimiter waits for the next."""
    held, waiting, tried = [], 0, 0
    for block in blocks:
        held.append(block)
        waiting += len(block)
        if waiting < 2 * tried:  # a long row is tried again only once twice as much is there
            continue
        text, done = "".join(held), 0
        for fields, end in _rows(text, col, row, quote, preserve):
            if end is not None:
                yield fields
                done = end
        held, waiting = [text[done:]], len(text) - done
        tried = waiting
    yield from parse("".join(held), col, row, quote, preserve)


def _rows(text: str, col: str, row: str, quote: str, preserve: bool) -> Iterator[tuple[list[str], int | None]]:
    """Rows and where the text goes on after each (None: the row has no delimiter)."""
    if len(col) < 2 or len(row) < 2:
        raise ValueError("delimiters have at least 2 characters")
    at, n, fields, parts, inside, c, r = 0, len(text), [], [], False, 0, 0
    while at < n:
        if inside:
            end = text.find(quote, at)
            if end < 0:
                parts.append(text[at:])
                at = n
            elif text.startswith(quote, end + 1):
                parts.append(text[at:end] + (quote * 2 if preserve else quote))
                at = end + 2
            else:
                parts.append(text[at:end] + (quote if preserve else ""))
                at, inside = end + 1, False
        elif not parts and text.startswith(quote, at):
            parts.append(quote if preserve else "")
            at, inside = at + 1, True
        else:
            c = text.find(col, at) if 0 <= c < at or c == 0 else c  # -1: there is none left
            r = text.find(row, at) if 0 <= r < at or r == 0 else r
            if c >= 0 and (r < 0 or c < r):
                parts.append(text[at:c])
                fields.append("".join(parts))
                parts, at = [], c + len(col)
                if at == n:
                    fields.append("")
            elif r >= 0:
                parts.append(text[at:r])
                yield [*fields, "".join(parts)], r + len(row)
                fields, parts, at = [], [], r + len(row)
            else:
                parts.append(text[at:])
                at = n
    if fields or parts:
        yield ([*fields, "".join(parts)] if parts or not text.endswith(col) else fields), None


def opens(segment: bytes, inside: bool, col: bytes, quote: bytes) -> bool:
    """Whether a quote is open after a text without row delimiters outside quotes, which begins inside quotes or at a row's start."""
    at, n, size = 0, len(segment), len(quote)
    while True:
        if inside:
            at = segment.find(quote, at)
            if at < 0:
                return True
            at += size
            if segment.startswith(quote, at):
                at += size
                continue
            inside = False
            at = segment.find(col, at)  # text behind the quote
        elif segment.startswith(quote, at):
            inside, at = True, at + size
            continue
        else:  # on to a field that begins with a quote
            at = segment.find(col + quote, at)
        if at < 0:
            return False
        at += len(col)
        if at >= n:
            return False


#: Charsets in which ASCII bytes are nothing but ASCII characters, or, for the last, all but letters are.
_ASCII_SAFE = {"utf-8", "ascii", "iso8859-1", "iso8859-15", "cp1252", "cp1251", "euc_kr", "euc_jp", "koi8-r", "cp949"}


COMPRESSED = r"\.(gz|bz2|zst|lz4|snappy|deflate|xz)$"


def splits_anywhere(charset: str, col: str, row: str, quote: str) -> bool:
    """Whether row delimiters can be found from a file's middle, but for quotes."""
    name, marks = codecs.lookup(charset).name, col + row + quote
    if name not in _ASCII_SAFE or not marks.isascii() or (name == "cp949" and any(x.isalpha() for x in marks)):
        return False
    ends = lambda a, b: any(a.endswith(b[:k]) for k in range(1, len(b)))  # noqa: E731  a's end can be b's begin
    return not (ends(col, row) or ends(row, col) or ends(row, row) or ends(col, col) or col in row or row in col or quote in col + row)


def _scan_splits(spark: SparkSession, path: str, charset: str, col: str, row: str, quote: str, preserve: bool, expected: int, skip_rows: int, header: bool) -> DataFrame:
    """(path, row_index, fields) of ``scan``, read by Spark's splits; skipped rows and the header are left out."""
    import pyarrow as pa
    import pyarrow.compute as pc

    name = F.replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), F.lit("file:///"), F.lit("file:/"))
    lines = spark.read.option("lineSep", row).text(path).select(F.col("value").cast("binary").alias("value"), name.alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("size"))
    mark, sep, end, skip = quote.encode(), col.encode(), row.encode(), skip_rows + header

    def pieces(batches):
        """(path, start, size, texts, places of texts with a quote) for each stretch of one split."""
        for batch in batches:
            if not batch.num_rows:
                continue
            names, starts = batch.column(1).dictionary_encode(), batch.column(2).to_numpy()
            codes = names.indices.to_numpy(zero_copy_only=False)
            cuts = [0, *[i for i in range(1, len(starts)) if starts[i] != starts[i - 1] or codes[i] != codes[i - 1]], len(starts)] if (starts[0], codes[0]) != (starts[-1], codes[-1]) else [0, len(starts)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                texts = batch.column(0).slice(a, b - a)
                yield names.dictionary[int(codes[a])].as_py(), int(starts[a]), batch.column(3)[a].as_py(), texts, pc.indices_nonzero(pc.match_substring(texts, quote)).to_pylist()

    def told(batches):
        """For each split, from a row's start and from inside quotes: whether a quote is open at its end, and the rows that begin in it."""
        found: dict[tuple[str, int], list] = {}
        for path_, start, size, texts, marked in pieces(batches):
            now = found.setdefault((path_, start), [size, 0, False, True, 0, 0])
            now[1] += pc.sum(pc.binary_length(texts)).as_py() + len(end) * len(texts)
            done = 0
            for i in [*marked, len(texts)]:
                for k in (2, 3):
                    now[k + 2] += 0 if now[k] else i - done
                if i < len(texts):
                    text = texts[i].as_py()
                    for k in (2, 3):
                        now[k + 2] += not now[k]
                        now[k] = opens(text, now[k], sep, mark)
                done = i + 1
        rows = [(*key, *x) for key, x in found.items()]
        yield pa.RecordBatch.from_pylist([dict(zip(NAMES, r, strict=True)) for r in rows], pa.schema(KINDS))

    NAMES = ["path", "start", "size", "bytes", "open0", "open1", "rows0", "rows1"]
    KINDS = list(zip(NAMES, [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()], strict=True))
    splits = lines.mapInArrow(told, "path string, start long, size long, bytes long, open0 boolean, open1 boolean, rows0 long, rows1 long").collect()  # a row a split
    entry, ended, within = {}, {}, False
    for r in sorted(splits, key=lambda r: (r.path, r.start)):
        is_open, n, length = ended.get(r.path, (False, 0, 0))
        entry[r.path, r.start] = (is_open, n)
        within |= is_open
        is_open, n = (r.open1, n + r.rows1) if is_open else (r.open0, n + r.rows0)
        ended[r.path] = (is_open, n, length + r.bytes)
        size = r.size
        if length + r.bytes >= size:  # the last split: whether the file ends with a row delimiter
            ended[r.path] = (is_open, n, length + r.bytes == size)
    for file, (is_open, n, _) in ended.items():
        if header and n < skip:
            raise WidthError(f"{file}: ends before its header")
        within |= is_open
    shared = spark.sparkContext.broadcast((entry, {k: x[2] is True for k, x in ended.items()}))

    def fields_of(texts: list[bytes], index: list[int], file: str) -> list[list[str]]:
        out = []
        for text, i in zip(texts, index, strict=True):
            fields = text.decode(charset).split(col) if mark not in text else next(parse(text.decode(charset), col, row, quote, preserve), [""])
            if i >= skip_rows and expected and len(fields) != expected:
                raise WidthError(f"{file}: row {i} has {len(fields)} fields, not {expected}")
            out.append(fields)
        return out

    def read(batches):
        """Whole rows have fields; pieces of rows that reach over a split's border have a text."""
        known, _ = shared.value
        key, held, index = None, [], 0
        out: tuple[list, list] = ([], [])

        def given(file: str, start: int, piece: bytes | None = None, at: int = 0):
            texts, numbers = out
            keep = [k for k, i in enumerate(numbers) if i >= skip]
            fields = fields_of(texts, numbers, file)
            rows = [{"path": file, "row_index": numbers[k] - skip, "fields": fields[k], "start": start, "piece": None} for k in keep]
            if piece is not None:
                rows.append({"path": file, "row_index": at - skip, "fields": None, "start": start, "piece": piece})
            texts.clear()
            numbers.clear()
            return pa.RecordBatch.from_pylist(rows, SCHEMA)

        for file, start, _, texts, marked in pieces(batches):
            if (file, start) != key:
                if key:
                    yield given(*key, end.join(held), index - 1) if held else given(*key)
                if (file, start) not in known:
                    raise ValueError(f"{file}: its splits are other ones than when its quotes were looked through")
                key, held = (file, start), []
                inside, index = known[key]
                begun_before = inside
            quoted = set(marked)
            for i, text in enumerate(texts.to_pylist()):
                if not inside and i not in quoted:
                    out[0].append(text)
                    out[1].append(index)
                    index += 1
                else:
                    index += not inside
                    held.append(text)
                    inside = opens(text, inside, sep, mark) if i in quoted else inside
                    if not inside:
                        whole = end.join(held)
                        held = []
                        if begun_before:
                            yield given(*key, whole, index - 1)
                            begun_before = False
                        else:
                            out[0].append(whole)
                            out[1].append(index - 1)
                if len(out[0]) >= 4096:
                    yield given(*key)
        if key:
            yield given(*key, end.join(held), index - 1) if held else given(*key)

    def joined(batches):
        trailing = shared.value[1]
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["row_index"] < 0:
                    continue
                text = end.join(r["pieces"])
                text += end if opens_at_end(text) and trailing[r["path"]] else b""
                rows.append({"path": r["path"], "row_index": r["row_index"], "fields": fields_of([text], [r["row_index"] + skip], r["path"])[0]})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([SCHEMA.field(i) for i in range(3)]))

    def opens_at_end(text: bytes) -> bool:
        return opens(text, False, sep, mark)

    SCHEMA = pa.schema([("path", pa.string()), ("row_index", pa.int64()), ("fields", pa.list_(pa.string())), ("start", pa.int64()), ("piece", pa.binary())])
    rows = lines.mapInArrow(read, "path string, row_index long, fields array<string>, start long, piece binary")
    whole = rows.where("piece IS NULL").drop("start", "piece")
    if not within:
        return whole
    apart = rows.where("piece IS NOT NULL").groupBy("path", "row_index").agg(F.transform(F.sort_array(F.collect_list(F.struct("start", "piece"))), lambda x: x["piece"]).alias("pieces"))
    return whole.unionByName(apart.mapInArrow(joined, "path string, row_index long, fields array<string>"))


def _streamed(path: str, charset: str, size: int) -> Iterator[str]:
    import pyarrow.fs as pafs

    fs, at = pafs.FileSystem.from_uri(_uri(path))
    decoder = codecs.getincrementaldecoder(charset)()
    with fs.open_input_stream(at) as stream:
        while block := stream.read(size):
            yield decoder.decode(block)
    yield decoder.decode(b"", True)


def _uri(path: str) -> str:
    return path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path


def _streamable(path: str) -> bool:
    """Whether tasks can open the file as a stream."""
    import pyarrow.fs as pafs

    try:
        fs, at = pafs.FileSystem.from_uri(_uri(path))
        return fs.get_file_info(at).is_file
    except Exception:
        return False


def scan(spark: SparkSession, path: str, columns: list[str] | None = None, charset: str = "CP949", col: str = "^|", row: str = "@@\n", quote: str = '"', preserve_quotes: bool = False, expected_cols: int = 0, skip_rows: int = 0, header: bool = False, block_bytes: int = 8 << 20) -> DataFrame:
    """Fields as ``fields``, or as ``columns``, with the file's path and the row's index in it.

    ``skip_rows`` rows, then the header, are left out. A width other than ``expected_cols`` fails with the row's index,
    and so does the end of a file before its header.
    """

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column(0)[i].as_py()
                # stores that only Spark can read give a file's whole content
                blocks = _streamed(name, charset, block_bytes) if batch.num_columns == 1 else iter([batch.column(1)[i].as_py().decode(charset)])
                rows = parse_blocks(blocks, col, row, quote, preserve_quotes)
                out: list[list[str]] = []
                first, left = 0, skip_rows + header
                for i, fields in enumerate(rows):
                    if i >= skip_rows and expected_cols and len(fields) != expected_cols:
                        raise WidthError(f"{name}: row {i} has {len(fields)} fields, not {expected_cols}")
                    if left:
                        left -= 1
                        continue
                    out.append(fields)
                    if len(out) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(out)), pa.array(range(first, first + len(out)), pa.int64()), pa.array(out, pa.list_(pa.string()))], ["path", "row_index", "fields"])
                        first, out = first + len(out), []
                if left and header:
                    raise WidthError(f"{name}: ends before its header")
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(out), pa.string()), pa.array(range(first, first + len(out)), pa.int64()), pa.array(out, pa.list_(pa.string()))], ["path", "row_index", "fields"])

    found = spark.read.format("binaryFile").load(path).select("path", "length")
    if header and (empty := found.where("length = 0").head()):
        raise WidthError(f"{empty.path}: ends before its header")
    if splits_anywhere(charset, col, row, quote) and found.where(F.col("path").rlike(COMPRESSED)).isEmpty():
        rows = _scan_splits(spark, path, charset, col, row, quote, preserve_quotes, expected_cols, skip_rows, header)
        return rows if columns is None else rows.select(*[F.get("fields", i).alias(c) for i, c in enumerate(columns)], "path", "row_index")
    files = spark.read.format("binaryFile").load(path)
    one = files.select("path").head()
    files = files.select("path") if one and _streamable(one.path) else files.select("path", "content")
    rows = files.mapInArrow(read, "path string, row_index long, fields array<string>")
    return rows if columns is None else rows.select(*[F.get("fields", i).alias(c) for i, c in enumerate(columns)], "path", "row_index")


def scan_unquoted(spark: SparkSession, path: str, columns: list[str] | None = None, charset: str = "UTF-8", col: str = "^|", row: str = "@@\n") -> DataFrame:
    """Fields of files without quoted delimiters, split in any number of tasks."""
    text = F.col("value") if charset.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), charset)
    rows = spark.read.text(path, lineSep=row).select(F.split(text, _literal(col), -1).alias("fields"))
    return rows if columns is None else rows.select(*[F.get("fields", i).alias(c) for i, c in enumerate(columns)])


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"


def write(df: DataFrame, path: str, col: str = "^|", row: str = "@@\n", quote_mode: str = "as_needed", quote: str = '"', header: bool = False) -> None:
    """Text files with delimiters of several characters; nulls are empty fields. A header begins each file."""
    fields = [quoted(F.coalesce(F.col(c).cast("string"), F.lit("")), quote_mode, col, row, quote) for c in df.columns]
    lines = df.select(F.concat_ws(col, *fields).alias("value"))
    if header:
        head = col.join(df.columns)

        def headed(batches):
            import pyarrow as pa

            first = True
            for batch in batches:
                if first:
                    yield pa.RecordBatch.from_arrays([pa.array([head])], ["value"])
                    first = False
                yield pa.RecordBatch.from_arrays([batch.column(0)], ["value"])

        lines = lines.mapInArrow(headed, "value string")
    lines.write.option("lineSep", row).text(path)


def csv_fields(lines: DataFrame, value: str = "value", sep: str = ",") -> DataFrame:
    """``lines`` with ``fields``: split at separators outside double quotes, outer quotes and doubled quotes undone."""
    marked = F.regexp_extract_all(F.concat(F.lit(sep), F.col(value)), F.lit(_literal(sep) + '("(?:[^"]|"")*"|[^"' + sep + "]*)"), F.lit(1))
    return lines.withColumn("fields", F.transform(marked, lambda x: F.when(F.startswith(x, F.lit('"')), F.replace(unquoted(x), F.lit('""'), F.lit('"'))).otherwise(x)))


def width_guard(rows: DataFrame, width: int | StructType, fail: bool = False) -> DataFrame:
    """``rows`` with ``_error`` where a non-empty row has another width, given as a number or by a schema's fields; with
    ``fail``, reading such a row fails."""
    width = width if isinstance(width, int) else len(width.fields)
    bad = (F.size("fields") != width) & ~((F.size("fields") == 1) & (F.get("fields", 0) == ""))
    text = F.format_string(f"%d fields, not {width}", F.size("fields"))
    return rows.withColumn("_error", F.when(bad, F.raise_error(text) if fail else text))


def named_fields(rows: DataFrame, names: list[str], extra: str = "keep", most: int = 0) -> DataFrame:
    """Fields by name. Further ones are dropped, or kept under unknown_field_index_i: the first of them up to field
    ``most`` as columns, all others in the map ``unknown_fields``."""
    out = [F.get("fields", i).alias(n) for i, n in enumerate(names)]
    if extra == "keep":
        wide = max(most, len(names))
        out += [F.get("fields", i).alias(f"unknown_field_index_{i}") for i in range(len(names), wide)]
        rest = F.slice("fields", F.lit(wide + 1), F.greatest(F.size("fields") - wide, F.lit(0)))
        out.append(F.map_from_entries(F.transform(rest, lambda x, i: F.struct(F.concat(F.lit("unknown_field_index_"), (i + wide).cast("string")), x))).alias("unknown_fields"))
    return rows.select(*[c for c in rows.columns if c != "fields"], *out)


def trimmed_values(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Without one pair of outer quotes; empty is null."""
    columns = columns or df.columns
    clean = lambda c: F.nullif(unquoted(F.col(c)), F.lit(""))
    return df.select(*[clean(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def read_csv(spark: SparkSession, path: str, schema=None, header: str = "first_line", charset: str = "UTF-8", date_format: str | None = None, timestamp_format: str | None = None, multi_line: bool = False, **options) -> DataFrame:
    """CSV with its header used (first_line), skipped (ignore) or absent (none); without a schema all columns are text.

    A byte-order mark is not data.
    """
    reader = spark.read.option("header", header != "none").option("encoding", charset).option("multiLine", multi_line).options(**options)
    if header == "ignore":
        reader = reader.option("enforceSchema", True)
    for name, value in (("dateFormat", date_format), ("timestampFormat", timestamp_format)):
        reader = reader.option(name, value) if value else reader
    return (reader.schema(schema) if schema is not None else reader).csv(path)
