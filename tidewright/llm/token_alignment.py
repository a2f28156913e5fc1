"""Alignment of two tokenizers over the same bytes by a merge in lockstep.

A batch's documents advance together. One state vector holds each lane's place among the tokens of A and of B; a step
compares the ends of all lanes' current tokens at once, moves on the side that ends first (or both), gives out a link and
a cut where they end together, and drops lanes that are through. A long document has several lanes: it may be entered at
any byte where a token of either side ends, which is looked up, so the number of steps follows ``LANE`` and not the
longest document.

A text is aligned as a blank and the text, which is what the SentencePiece model sees. Texts that are null or empty, or
that the tokens don't give back byte by byte (such as those that hold U+2581), have no tokens and no links. Strings of
special tokens are plain text. Repeated rows are aligned alike and each counts; an empty table gives an empty one. Other
columns are left alone; those named like the results are replaced.

How often a pair of ids is linked is counted over all documents by Spark's partial sums, and joined back by
``with_found``: a table of counts is broadcast only below its bound, and salted beyond it.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.bpe_ids import _BYTE_CHARS, Encoder
from tidewright.llm.common import flat_text, small_batches, tidy, with_found, written
from tidewright.llm.piece_parts import PieceParts
from tidewright.llm.sentencepiece_codec import SPACE

#: Words whose ids a worker keeps for later batches.
KEPT_WORDS = 400_000
#: Bytes of a lane, where the tokens allow a cut.
LANE = 512
SCHEMA = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, pair_links array<int>"


class Side:
    """The bytes of each id of a tokenizer."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = pa.array(tokens, pa.large_binary())
        self.sizes = np.array([len(x) for x in tokens])


def joined(values: pa.Array, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``values`` at the given places, one after the other, and where each ends."""
    taken = values.take(pa.array(place))
    ends = np.frombuffer(taken.buffers()[1], np.int64)[1 : len(place) + 1]
    return np.frombuffer(taken.buffers()[2], np.uint8)[: ends[-1] if len(ends) else 0], ends


class PlainEncoder(Encoder):
    """Byte-level ids where the strings of special tokens are plain text."""

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str, cache: int = KEPT_WORDS):
        super().__init__(path, cache)
        self.tokenizer.encode_special_tokens = True
        self.added = None
        back = {c: b for b, c in _BYTE_CHARS.items()}
        tokens = [b""] * (1 + max(self.tokenizer.get_vocab().values()))
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            tokens[i] = bytes(back[ord(c)] for c in token)
        self.side = Side(tokens)

    def ids(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = flat_text(text)
        return self._encode(data, offsets)


class Pieces:
    """SentencePiece ids of texts, encoding each distinct part once, and the bytes of each piece."""

    _made: dict[str, Pieces] = {}

    def __init__(self, path: str):
        self.parts = PieceParts(path)
        p = self.parts.library
        one = lambda i: bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace(SPACE, " ").encode()
        self.side = Side([b"" if p.is_control(i) or p.is_unknown(i) else one(i) for i in range(p.get_piece_size())])
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.values, self.ends = array("I"), array("q", [0])

    @classmethod
    def of(cls, path: str) -> Pieces:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def ids(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a text column and where each text's begin."""
        data, offsets = self.parts.flat(text)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        bounds = self.parts.bounds(data, offsets)
        told, index = self.parts.distinct(data, bounds)
        if len(self.place) > KEPT_WORDS:
            self.forget()
        missing = [x for x in told if x not in self.place]
        lead = self.parts.lead
        for x, ids in zip(missing, self.parts.encode(missing), strict=True):
            self.place[x] = len(self.ends) - 1
            self.values.extend(ids[lead:])
            self.ends.append(len(self.values))
        index = np.fromiter(map(self.place.__getitem__, told), np.int64, len(told))[index]
        ends = np.array(self.ends)
        n = np.diff(ends)[index]
        out = np.concatenate((np.zeros(1, np.int64), np.cumsum(n)))
        return np.array(self.values)[np.repeat(ends[index] - out[:-1], n) + np.arange(out[-1])], out[np.searchsorted(bounds, offsets)]


def lanes(ends_a: np.ndarray, ends_b: np.ndarray, offsets: np.ndarray, data: np.ndarray, lane: int = LANE) -> np.ndarray:
    """Bytes where lanes begin: the documents' first ones, and about every ``lane`` bytes a blank before which tokens of both sides end."""
    blanks = np.flatnonzero(data == 32)
    place = np.searchsorted(blanks, np.arange(lane, len(data), lane))
    inner = np.unique(blanks[place[place < len(blanks)]])
    for ends in (ends_a, ends_b):
        inner = inner[ends[np.minimum(np.searchsorted(ends, inner), len(ends) - 1)] == inner] if len(ends) else inner[:0]
    return np.unique(np.concatenate((offsets[:-1][np.diff(offsets) > 0], inner)))


def merge(ends_a: np.ndarray, ends_b: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in A and in B of tokens that end together, in order of A.

    ``ends_a`` and ``ends_b`` rise over all documents, and both have every lane's end.
    """
    a, b = np.searchsorted(ends_a, begins, "right"), np.searchsorted(ends_b, begins, "right")
    stop = np.append(a[1:], len(ends_a))
    links_a, links_b = [], []
    live = a < stop
    a, b, stop = a[live], b[live], stop[live]
    while len(a):
        end_a, end_b = ends_a[a], ends_b[b]
        both = end_a == end_b
        links_a.append(a[both])
        links_b.append(b[both])
        a = a + (end_a <= end_b)
        b = b + (end_b <= end_a)
        live = a < stop
        if not live.all():
            a, b, stop = a[live], b[live], stop[live]
    if not links_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    link_a, link_b = np.concatenate(links_a), np.concatenate(links_b)
    order = np.argsort(link_a)
    return link_a[order], link_b[order]


_DECIMALS: dict[int, pa.Array] = {}


def group_texts(ids_a: np.ndarray, ids_b: np.ndarray, link_a: np.ndarray, link_b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``a1,a2|b1;a3|b2,b3;`` over all groups, and where each group ends in them. Ids are below ``size``."""
    if size not in _DECIMALS:
        _DECIMALS[size] = pa.array([f"{i}{mark}" for mark in ",|;" for i in range(size)], pa.large_binary())
    n_a, n_b = len(ids_a), len(ids_b)
    last_a, last_b = np.zeros(n_a, bool), np.zeros(n_b, bool)
    last_a[link_a], last_b[link_b] = True, True
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    place_a = np.arange(n_a) + np.concatenate((np.zeros(1, np.int64), link_b + 1))[group_a]
    place_b = np.arange(n_b) + (link_a + 1)[group_b]
    each = np.empty(n_a + n_b, np.int64)
    each[place_a], each[place_b] = ids_a + size * last_a, ids_b + 2 * size * last_b
    flat, ends = joined(_DECIMALS[size], each)
    return flat, ends[place_b[link_b]]


def aligned(text: pa.Array, a: PlainEncoder, b: Pieces) -> tuple[list, ...]:
    """The columns of ``SCHEMA`` for a text column (null: empty)."""
    text = pc.fill_null(text.cast(pa.large_string()), "")
    padded = pc.if_else(pc.equal(text, ""), text, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), text, pa.scalar("", pa.large_string())))
    data, offsets = flat_text(padded)
    n = len(text)
    numbers = np.zeros((4, n), np.int64)
    groups, pairs, pair_links = [""] * n, [[]] * n, [[]] * n
    found, good = [], np.diff(offsets) > 0
    for side, (ids, at) in ((a.side, a.ids(padded)), (b.side, b.ids(text))):
        raw, ends = joined(side.tokens, ids)
        ends, raw, given = np.concatenate((np.zeros(1, np.int64), ends))[at], raw.tobytes(), data.tobytes()
        good &= np.fromiter((raw[ends[i] : ends[i + 1]] == given[offsets[i] : offsets[i + 1]] for i in range(n)), bool, n)
        found.append((ids.astype(np.int64), at))
    (ids_a, at_a), (ids_b, at_b) = found
    some = np.flatnonzero(good)
    if not len(some):
        return (*numbers, groups, pairs, pair_links)
    if len(some) < n:
        keep = lambda at: np.repeat(good, np.diff(at))
        ids_a, ids_b, data = ids_a[keep(at_a)], ids_b[keep(at_b)], data[keep(offsets)]
        at_a, at_b, offsets = (np.concatenate((np.zeros(1, np.int64), np.cumsum(np.diff(x)[some]))) for x in (at_a, at_b, offsets))
    ends_a, ends_b = np.cumsum(a.side.sizes[ids_a]), np.cumsum(b.side.sizes[ids_b])
    link_a, link_b = merge(ends_a, ends_b, lanes(ends_a, ends_b, offsets, data))
    flat, group_ends = group_texts(ids_a, ids_b, link_a, link_b, max(len(a.side.sizes), len(b.side.sizes)))
    link_at = np.searchsorted(link_a, at_a)  # each document's links
    numbers[0, some], numbers[1, some] = np.diff(at_a), np.diff(at_b)
    numbers[2, some] = numbers[3, some] = np.diff(link_at)
    text_at = np.concatenate((np.zeros(1, np.int64), group_ends))[link_at]
    codes = ids_a[link_a] << 32 | ids_b[link_b]
    raw = flat.tobytes()
    for k, i in enumerate(some):
        groups[i] = raw[text_at[k] : text_at[k + 1] - 1].decode()
        pairs[i], pair_links[i] = np.unique(codes[link_at[k] : link_at[k + 1]], return_counts=True)
    return (*numbers, groups, pairs, pair_links)


def align(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text") -> DataFrame:
    """``docs`` without its texts, with each document's alignment.

    ``path_a`` is a byte-level ``tokenizers`` file, ``path_b`` a SentencePiece model. ``groups`` has the ids of both sides
    between cuts (``a1,a2|b1;a3|b2,b3``); ``pairs`` has the linked pairs of ids (A's in the upper 32 bits), each once, and
    ``pair_links`` how many links of the document each has.
    """
    added = [x.split()[0] for x in SCHEMA.split(", ")]
    keep = [c for c in docs.columns if c not in (text_col, *added)]
    casts = [F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in SCHEMA.split(", ")]
    schema = docs.select(*keep, *casts).schema
    kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def run(batches):
        a, b = PlainEncoder.of(path_a), Pieces.of(path_b)
        for batch in batches:
            columns = aligned(batch.column(len(keep)), a, b)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *map(pa.array, columns, kinds)], [*keep, *added])
        tidy()

    small_batches(docs.sparkSession, 4 << 20)
    return docs.select(*keep, text_col).mapInArrow(run, schema)


def link_counts(links: DataFrame) -> DataFrame:
    """(pair, n, best) over rows (pair, k): how many links each pair of ids has, and whether no pair of its B id has more."""
    counts = written(links.groupBy("pair").agg(F.sum("k").alias("n")), "pairs")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = counts.groupBy(b.alias("_b")).agg(F.max("n").alias("_most"))
    return counts.join(most, b == F.col("_b")).select("pair", "n", (F.col("n") == F.col("_most")).alias("best"))


def scored(documents: DataFrame) -> DataFrame:
    """A written table of ``align`` with n_best and count_sum.

    n_best counts the links whose pair is among the most frequent of its B id; count_sum adds their pairs' counts. The
    table needs a column ``_row`` that differs from row to row.
    """
    links = documents.select("_row", F.explode(F.arrays_zip("pairs", "pair_links")).alias("x")).select("_row", F.col("x.pairs").alias("pair"), F.col("x.pair_links").cast("long").alias("k"))
    counts = written(link_counts(links), "counts")
    told = with_found(links, counts, ["pair"], "inner")
    sums = told.groupBy("_row").agg(F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("n_best"), F.sum(F.col("k") * F.col("n")).alias("count_sum"))
    rows = documents.drop("pairs", "pair_links", "n_best", "count_sum").join(sums, "_row", "left").drop("_row")
    return rows.fillna(0, ["n_best", "count_sum"])
