"""Media columns: interleaved sequences of text and media, with payloads resolved by digest.

``interleave`` reads HTML into an ordered array of structs: text blocks and media references, each with its position; a
reference has its digest (of a ``digest:`` source), alternative text and the caption of the figure that it stands in.
``resolve`` joins references to a media table by digest and keeps positions and captions beside the payload's columns;
references without a payload stay, with nulls. Joins move one small row a reference, never payloads; the references of
a hot digest are dealt to several tasks by a salt, and that digest's row goes to each of them.

``media_table`` stores bytes as 8-bit grey-level images (binary PGM, ``WIDTH`` samples a row): lossless, and the stored
form is a function of the payload. ``features`` reads stored images back, checks their digest and describes samples.

Null HTML gives an empty sequence; null text is stored as blanks. A page of any length is read whole, one page at a
time. References that tie on an id, and repeated rows, keep a row each. An empty table gives an empty result. Of other
columns ``interleave`` replaces one named ``items`` and keeps the rest; ``resolve`` returns the id and its own columns
alone, so an id that is to carry more is a struct.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import small_batches, written
from tidewright.llm.html_blocks import blocks

WIDTH = 192
ITEM = "struct<position:int,kind:string,text:string,digest:string,alt:string,caption:string>"


def payload_of(text: Column) -> Column:
    """The text's UTF-8 bytes with blanks up to a positive multiple of WIDTH; null is empty."""
    raw = F.coalesce(text, F.lit("")).cast("binary")
    rest = F.octet_length(raw) % WIDTH
    pad = F.when((rest > 0) | (F.octet_length(raw) == 0), WIDTH - rest).otherwise(0)
    return F.concat(raw, F.repeat(F.lit(" "), pad).cast("binary"))


def image_of(payload: Column) -> Column:
    """A binary PGM of the payload, whose length is a multiple of WIDTH."""
    rows = F.floor(F.octet_length(payload) / WIDTH)
    return F.concat(F.concat(F.lit(f"P5\n{WIDTH} "), rows.cast("string"), F.lit("\n255\n")).cast("binary"), payload)


def samples_of(image: bytes) -> np.ndarray:
    """The samples of a binary PGM of one byte a sample."""
    magic, size, top, rest = image.split(b"\n", 3)
    width, height = map(int, size.split())
    if magic != b"P5" or top != b"255" or len(rest) != width * height:
        raise ValueError("not an 8-bit PGM image")
    return np.frombuffer(rest, np.uint8)


def describe(samples: np.ndarray) -> str:
    """Mean, spread, extremes, a 16-bin histogram and the mean step between neighbours, as text."""
    histogram = np.bincount(samples >> 4, minlength=16)
    steps = np.abs(np.diff(samples.astype(np.int16))).mean() if len(samples) > 1 else 0.0
    return f"mean={samples.mean():.6f};std={samples.std():.6f};min={samples.min()};max={samples.max()};step={steps:.6f};hist={','.join(map(str, histogram))}"


def features(media: DataFrame) -> DataFrame:
    """One row a digest from stored (digest, media): sizes, digests of the read payload and its features."""

    small_batches(media.sparkSession, 4 << 20)

    def run(batches):
        for batch in batches:
            rows = []
            for digest, image in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                image = image.as_py()
                if hashlib.sha256(image).hexdigest() != digest:
                    raise ValueError(f"stored media differs from its digest {digest}")
                samples = samples_of(image)
                payload = samples.tobytes()
                rows.append((digest, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(image), describe(samples)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["digest", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "feature"])

    each = media.select("digest", "media").mapInArrow(run, "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, feature string")
    return each.dropDuplicates(["digest"])


def sequence(html: str) -> list[dict]:
    """The interleaved items of one page. A caption belongs to the media of its figure, before or after it."""
    out: list[dict] = []
    figure: list[int] = []
    for b in blocks(html, media=True):
        inside = "figure" in b.path
        if not inside:
            figure = []
        if b.media is not None:
            source = b.media.get("src", "")
            out.append({"position": len(out), "kind": "media", "text": None, "digest": source.removeprefix("digest:") if source.startswith("digest:") else None, "alt": b.media.get("alt"), "caption": None})
            if inside:
                figure.append(len(out) - 1)
        elif "figcaption" in b.path and figure:
            for i in figure:
                out[i]["caption"] = b.text if out[i]["caption"] is None else f"{out[i]['caption']} {b.text}"
            figure = []
        else:
            out.append({"position": len(out), "kind": "text", "text": b.text, "digest": None, "alt": None, "caption": None})
    return out


ITEM_ARROW = pa.list_(pa.struct([("position", pa.int32()), *((name, pa.string()) for name in ("kind", "text", "digest", "alt", "caption"))]))


def interleave(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``items``, the ordered text and media references of their HTML, in the HTML column's place."""
    small_batches(pages.sparkSession, 4 << 20)
    keep = [c for c in pages.columns if c not in (html_col, "items")]
    schema = pages.select(*keep, F.lit(None).cast(f"array<{ITEM}>").alias("items")).schema

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                items = [sequence(h) if h else [] for h in part.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(items, ITEM_ARROW)], [*keep, "items"])

    return pages.select(*keep, html_col).mapInArrow(run, schema)


#: More references than this to one digest, or than one in ten thousand of all, are dealt to several tasks.
HOT = 4096


def resolve(pages: DataFrame, media: DataFrame, id_col: str) -> DataFrame:
    """(id, position, alt, caption, digest, ...) of every media reference, with the columns of ``media``, which has a row
    for each digest."""
    each = pages.select(F.col(id_col), F.explode("items").alias("i")).where("i.kind = 'media'")
    each = written(each.select(id_col, "i.position", "i.alt", "i.caption", "i.digest"), "references")
    limit = max(HOT, each.count() // 10_000)
    hot = each.where("digest IS NOT NULL").groupBy("digest").agg(F.count("*").alias("n")).where(F.col("n") > limit)
    # at most ten thousand rows, as each stands for more than a ten-thousandth of all references
    hot = F.broadcast(written(hot.select("digest", F.ceil(F.col("n") / limit).cast("int").alias("_salts")), "hot-digests"))
    salts = F.coalesce("_salts", F.lit(1))
    dealt = each.join(hot, "digest", "left").withColumn("_salt", F.pmod(F.xxhash64(id_col, "position"), salts).cast("int")).drop("_salts")
    copied = media.join(hot, "digest", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return dealt.join(copied, ["digest", "_salt"], "left").drop("_salt").select(id_col, "position", "alt", "caption", "digest", *[c for c in media.columns if c != "digest"])
