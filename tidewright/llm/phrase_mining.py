"""Collocations: frequent phrases of a few words, scored by how much oftener they occur than their parts would together.

Phrases are counted by Rabin-Karp fingerprints. In a task, words are hashed by differences of a polynomial that runs over
the text's bytes, and phrases by differences of one that runs over the words' hashes (numpy prefix sums; language and
length go in too). Each stretch of text gives every fingerprint once, with its count; the shuffle deals sorted runs of
them by their top bits, and each bucket, a bounded part of the corpus, is summed alone. Fingerprints below ``least`` are
done with. Phrases of three words or more are fingerprinted only where both phrases of one word less are frequent, which
a bit sketch of bounded size tells: past its bound it lets more through, and results stay the same.

Then the texts are read again for the frequent fingerprints alone. A fingerprint points to its first occurrence in the
stretch, and all others are compared with that word by word; an occurrence that only collides counts for its own phrase. What comes out
is phrases with their text, exact count and a pointer (document and byte) to an occurrence, and what was frequent by collisions alone
falls away. Scores, cuts and ranks follow by joins and windows.

Null and empty texts have no words; a null language is ``und``. Ties in rank go by the phrase, in byte order. Repeated
rows count each; an empty table gives no rows. Other columns are not read. Texts are cut at their punctuation into
stretches of about ``STRETCH`` bytes, as no phrase crosses it, so a very long text needs no more memory than others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewright.llm.common import _BASE, _INVERSE, _powers, discard, flat_text, mix64, slices, small_batches, span_hashes, tidy, word_spans, written

#: Bytes that end a piece: . , ; : ! ? and line feed to carriage return; and those that end a word: these, blank and tab.
PIECE_END = np.zeros(256, bool)
PIECE_END[[46, 44, 59, 58, 33, 63, 10, 11, 12, 13]] = True
WORD_END = PIECE_END.copy()
WORD_END[[32, 9]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

STRETCH = 2 << 20
#: Fingerprints that a task holds before it gives them out.
HELD = 2_000_000
#: Bytes of text for each bucket of fingerprints, and the least number of buckets.
BUCKET_BYTES, BUCKETS = 8 << 20, 256
#: Bits of the sketch: 16 for each fingerprint, and so many at most (32 MB).
SKETCH_BITS = 1 << 28
#: A language's candidates are ranked in so many parts before they meet.
SALTS = 64


class Stretch:
    """The words of a stretch of text, and fingerprints of its phrases."""

    def __init__(self, data: np.ndarray, first: int, offsets: np.ndarray, lang_of_row: np.ndarray, lang_hash: np.ndarray, bits: int):
        self.data, self.first, self.bits = LOWER[data], first, bits
        inside = offsets[(offsets > first) & (offsets < first + len(data))] - first
        self.starts, self.ends, _ = word_spans(self.data, np.concatenate(([0], inside, [len(data)])).astype(np.int64), WORD_END)
        self.row = np.searchsorted(offsets, self.starts + first, "right") - 1
        self.lang = lang_of_row[self.row]
        n = len(self.starts)
        hashes = span_hashes(self.data, self.starts, self.ends, lower=False)
        self.run = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * _powers(_BASE, n), out=self.run[1:])
        self.back = _powers(_INVERSE, n)
        self.salt = lang_hash[self.lang]
        ended = np.cumsum(PIECE_END[self.data], dtype=np.int32)[self.starts] if n else np.zeros(0, np.int32)
        #: whether word i and the next are in one piece of one text
        self.joined = (self.row[1:] == self.row[:-1]) & (ended[1:] == ended[:-1])

    def begins(self, k: int) -> np.ndarray:
        """Words where a phrase of ``k`` words begins."""
        ok = np.ones(max(0, len(self.starts) - k + 1), bool)
        for j in range(k - 1):
            ok &= self.joined[j : j + len(ok)]
        return np.flatnonzero(ok)

    def fingerprints(self, at: np.ndarray, k: int) -> np.ndarray:
        prints = mix64((self.run[at + k] - self.run[at]) * self.back[at] + self.salt[at] + np.uint64(k))
        return prints & np.uint64(-1 << (64 - self.bits) & (1 << 64) - 1)

    def words(self) -> tuple[np.ndarray, pa.Array]:
        """The number of each word's text, and the texts."""
        kept = np.zeros(len(self.data), np.int8)
        np.add.at(kept, self.starts, 1)
        np.add.at(kept[: len(self.data)], self.ends[self.ends < len(self.data)], -1)
        flat = np.ascontiguousarray(self.data[np.cumsum(kept, dtype=np.int8).view(bool)])
        at = np.concatenate((np.zeros(1, np.int64), np.cumsum(self.ends - self.starts)))
        coded = pa.Array.from_buffers(pa.large_string(), len(self.starts), [None, pa.py_buffer(at), pa.py_buffer(flat)]).dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def stretches(batch: pa.RecordBatch, bits: int, stretch: int) -> Iterator[tuple[Stretch, pa.Array, pa.Array]]:
    """(stretch, language names, document ids) of a batch of (doc_id, lang, text)."""
    data, offsets = flat_text(batch.column(2))
    coded = batch.column(1).dictionary_encode()
    names, at = flat_text(coded.dictionary)
    lang_hash = span_hashes(names, at[:-1], at[1:], lower=False)
    cut = np.zeros(len(data) + 1, bool)
    cut[1:] = PIECE_END[data]
    cut[offsets] = True
    bounds = np.flatnonzero(cut)
    lang = coded.indices.to_numpy(zero_copy_only=False)
    for a, b in slices(bounds, stretch) if len(data) else ():
        yield Stretch(data[bounds[a] : bounds[b]], int(bounds[a]), offsets, lang, lang_hash, bits), coded.dictionary, batch.column(0)


def summed(prints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints in order, and their counts' sums."""
    if not len(prints):
        return prints, counts
    order = np.argsort(prints)
    prints, counts = prints[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], prints[1:] != prints[:-1])))
    return prints[first], np.add.reduceat(counts, first)


def in_sketch(sketch: np.ndarray, prints: np.ndarray) -> np.ndarray:
    word = sketch[prints >> np.uint64(64 - (len(sketch).bit_length() - 1))] if len(sketch) > 1 else sketch[np.zeros(len(prints), np.int64)]
    one, low = np.uint64(1), np.uint64(63)
    want = one << (prints & low) | one << (prints >> np.uint64(6) & low)
    return word & want == want


def sketched(prints: DataFrame, most_bits: int = SKETCH_BITS) -> np.ndarray:
    """Two bits for each fingerprint in one word of a bit sketch; at most ``most_bits`` / 64 words reach the driver."""
    n = prints.count()
    words = min(most_bits, max(1 << 16, 1 << (16 * n).bit_length())) // 64
    shift = 64 - (words.bit_length() - 1)
    mask = F.expr("shiftleft(1L, cast(fp & 63 as int)) | shiftleft(1L, cast(shiftrightunsigned(fp, 6) & 63 as int))")
    told = prints.select(F.shiftrightunsigned("fp", shift).alias("word") if words > 1 else F.lit(0).cast("long").alias("word"), mask.alias("mask"))
    rows = told.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    sketch = np.zeros(words, np.uint64)
    sketch[rows.column("word").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    return sketch


def frequent(texts: DataFrame, sizes: tuple[int, ...], least: int, buckets: int, sketch: np.ndarray | None, bits: int, stretch: int) -> DataFrame:
    """Fingerprints (fp) of phrases of the given numbers of words that are counted ``least`` times or more.

    Phrases whose phrases of one word less aren't all in the sketch are left out, if there is one.
    """
    shared = texts.sparkSession.sparkContext.broadcast(sketch)
    shift = np.uint64(64 - (buckets.bit_length() - 1))

    def given(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        prints, counts = summed(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))
        bucket = (prints >> shift).astype(np.int32)
        first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(prints) else np.zeros(0, np.int64)
        at = np.append(first, len(prints))
        blobs = [pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(at * x.itemsize), pa.py_buffer(x)]).cast(pa.binary()) for x in (prints, counts)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[first], pa.int32()), *blobs], ["bucket", "prints", "counts"])

    def dealt(batches):
        held, many, filter_ = [], 0, shared.value
        for batch in batches:
            for part, _, _ in stretches(batch, bits, stretch):
                for k in sizes:
                    at = part.begins(k)
                    if filter_ is not None:
                        at = at[in_sketch(filter_, part.fingerprints(at, k - 1))]
                        at = at[in_sketch(filter_, part.fingerprints(at + 1, k - 1))]
                    prints = part.fingerprints(at, k)
                    held.append(summed(prints, np.ones(len(prints), np.int64)))
                    many += len(held[-1][0])
            if many >= HELD:
                yield given(held)
                held, many = [], 0
        if held:
            yield given(held)
        tidy()

    def totals(batches):
        now, held = None, []
        none = pa.RecordBatch.from_arrays([pa.array([], pa.int64())], ["fp"])

        def done() -> pa.RecordBatch:
            if not held:
                return none
            prints, counts = summed(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))
            return pa.RecordBatch.from_arrays([pa.array(prints[counts >= least].view(np.int64))], ["fp"])

        for batch in batches:
            for bucket, prints, counts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                if bucket != now:
                    yield done()
                    now, held = bucket, []
                held.append((np.frombuffer(prints.as_buffer(), np.uint64), np.frombuffer(counts.as_buffer(), np.int64)))
        yield done()
        tidy()

    runs = texts.mapInArrow(dealt, "bucket int, prints binary, counts binary")
    return runs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(totals, "fp long")


def verified(texts: DataFrame, longest: int, sketch: np.ndarray, bits: int, stretch: int) -> DataFrame:
    """(lang, words, phrase, n, doc_id, byte): occurrences of frequent fingerprints, counted by their text in each stretch.

    Rows with 0 words have the number of all words. ``doc_id`` and ``byte`` are an occurrence's document and its place there.
    """
    shared = texts.sparkSession.sparkContext.broadcast(sketch)
    names = ["lang", "words", "phrase", "n", "doc_id", "byte"]
    id_type = texts.schema["doc_id"].dataType.simpleString()

    def groups(part: Stretch, number: np.ndarray, at: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """First occurrences and counts of the phrases that begin at the words ``at``."""
        prints = part.fingerprints(at, k)
        order = np.argsort(prints, kind="stable")
        at, prints = at[order], prints[order]
        while len(at):
            opens = np.concatenate(([True], prints[1:] != prints[:-1]))
            first = at[np.flatnonzero(opens)[np.cumsum(opens) - 1]]
            same = part.lang[at] == part.lang[first]
            for j in range(k):
                same &= number[at + j] == number[first + j]
            group = np.cumsum(opens) - 1
            yield at[opens], np.bincount(group[same], minlength=int(group[-1]) + 1)
            at, prints = at[~same], prints[~same]  # these only collide

    def told(batches):
        filter_ = shared.value
        for batch in batches:
            for part, langs, ids in stretches(batch, bits, stretch):
                number, texts_ = part.words()
                n = np.bincount(part.lang, minlength=len(langs))
                some = np.flatnonzero(n)
                blank = pa.nulls(len(some), ids.type)
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(some)), pa.array([0] * len(some), pa.int32()), pa.array([""] * len(some)), pa.array(n[some], pa.int64()), blank, pa.array([0] * len(some), pa.int64())], names)
                for k in range(1, longest + 1):
                    at = part.begins(k)
                    at = at[in_sketch(filter_, part.fingerprints(at, k))]
                    for first, count in groups(part, number, at, k):
                        each = [texts_.take(pa.array(number[first + j])) for j in range(k)]
                        phrase = pc.binary_join_element_wise(*each, pa.scalar(" ", pa.large_string())) if k > 1 else each[0]
                        row = part.row[first]
                        place = part.starts[first] + part.first - row_starts(batch)[row]
                        yield pa.RecordBatch.from_arrays(
                            [langs.take(pa.array(part.lang[first])), pa.array(np.full(len(first), k), pa.int32()), phrase.cast(pa.string()), pa.array(count, pa.int64()), ids.take(pa.array(row)), pa.array(place, pa.int64())], names
                        )
        tidy()

    def row_starts(batch: pa.RecordBatch) -> np.ndarray:
        return flat_text(batch.column(2))[1]

    return texts.mapInArrow(told, f"lang string, words int, phrase string, n long, doc_id {id_type}, byte long")


def phrases(docs: DataFrame, longest: int = 3, least: int = 10, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", bits: int = 64, stretch: int = STRETCH, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """A written table (lang, words, phrase, n, doc_id, byte) of all phrases of 1 to ``longest`` words with n >= ``least``.

    A row of 0 words has the number of all words of its language. ``doc_id`` and ``byte`` point to an occurrence; which
    of them may differ from run to run.
    """
    small_batches(docs.sparkSession, 4 << 20)
    texts = docs.where(F.octet_length(text_col) > 0).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    buckets = 1 << (max(BUCKETS, size // BUCKET_BYTES) - 1).bit_length()
    found = [written(frequent(texts, (1, 2) if longest > 1 else (1,), least, buckets, None, bits, stretch), "prints")]
    for k in range(3, longest + 1):
        found.append(written(frequent(texts, (k,), least, buckets, sketched(_together(found), sketch_bits), bits, stretch), "prints"))
    rows = verified(texts, longest, sketched(_together(found), sketch_bits), bits, stretch)
    counted = rows.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"), F.first("doc_id").alias("doc_id"), F.first("byte").alias("byte"))
    table = written(counted.where((F.col("words") == 0) | (F.col("n") >= least)), "phrases")
    discard(*found)
    return table


def _together(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for df in tables[1:]:
        out = out.unionByName(df)
    return out


def collocations(found: DataFrame, top: int = 2000, share: int = 50) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, doc_id, byte) of each language's first ``top`` phrases of a ``phrases`` table.

    A phrase is cut in two after each of its words; a cut's score is floor(1000000 a a / (l r)) for the counts of the
    whole and of both parts, exact in decimals, and the lowest (then first) cut counts. Phrases inside a longer one that
    has ``share`` per cent of their count or more are left out.
    """
    words = F.split("phrase", " ")
    part = lambda begin, size: F.array_join(F.slice(words, begin, size), " ")
    whole = found.where("words > 1").withColumnRenamed("n", "a")
    known = found.where("words > 0").select("lang", F.col("phrase").alias("part"), "n")
    cuts = whole.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("left"), part(F.col("cut") + 1, F.col("words") - F.col("cut")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("part").alias(side), F.col("n").alias(name)), ["lang", side])
    wide = {x: F.col(x).cast("decimal(19,0)") for x in ("a", "l", "r")}
    scored = cuts.withColumns({f"_{x}": c for x, c in wide.items()}).withColumn("score", F.expr("(1000000BD * (_a * _a)) div (_l * _r)"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r")).alias("x"))
    inner = whole.where("words > 2").select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
    inner = inner.select("lang", "phrase", "a", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("begin"))
    inside = inner.select("lang", part(F.col("begin"), F.col("size")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    left = whole.join(inside, ["lang", "phrase"], "left").where(F.col("_longer").isNull() | (100 * F.col("_longer") < share * F.col("a")))
    rows = left.join(best, ["lang", "phrase"]).select("lang", "phrase", "a", "x.l", "x.r", "x.score", "doc_id", "byte")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = found.where("words = 0").select("lang", "n")
    return ranked.join(F.broadcast(totals) if totals.count() <= 10_000 else totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "doc_id", "byte")
