"""SentencePiece encoding and decoding in batched numpy.

A batch's distinct words are encoded once. Words of equal length advance together: hashes of all their substrings, from
differences of one running polynomial, probe the sorted keys of the vocabulary, which gives a table of pieces by start
and length for all words at once.

* Unigram models: Viterbi over the table. The best score at each position is a vectorised maximum over piece lengths,
  whose argument is kept as the backpointer.
* BPE models: their scores are merge ranks, and a sum of ranks doesn't pick the library's segmentation. The same Viterbi
  runs with transition scores instead: 0 where two pieces can stand side by side, which is when merging their joined
  text gives them back, else minus infinity. Each prefix of a word has exactly one path of score 0, which is what the
  library makes of it (``stand``). The test of a pair walks back through both pieces' merges and is remembered.

Characters outside the vocabulary become byte pieces if the model has them, else the unknown piece. Words end before a
blank that follows a non-blank; that is exact for vocabularies without pieces that have a blank inside. Words of any
length take the same way; long ones have their table made piece by piece.

Null and empty texts have no ids and decode to the empty text. Decoding undoes the marks for blanks and the leading
blank that encoding adds, so texts without U+2581 come back exactly. Repeated rows get equal ids; an empty table gives
an empty result. Other columns are left alone, but for one named like the output, which is replaced.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import _BASE, _INVERSE, _powers, flat_text, mix64, slices, small_batches, tidy

SPACE = "▁"
#: Ends of a word for which the table of pieces is made at a time.
STRETCH = 4096
SEEN_BITS, PAIR_BITS = 22, 19
KEPT_WORDS = 150_000
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE, UNIGRAM, BPE = 1, 2, 3, 4, 6, 1, 2


def _fields(data: bytes):
    """(number, value) of a protocol buffer message; nested messages stay bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            n = varint()
            yield tag >> 3, data[at : at + n]
            at += n
        else:
            n = 4 if kind == 5 else 8
            yield tag >> 3, struct.unpack("<f" if n == 4 else "<d", data[at : at + n])[0]
            at += n


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _running(codes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix64(codes.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(codes)), out=out[1:])
    return out


class Paths:
    """The best path to each end of words of one length, all words together; ``back`` has the last piece's length."""

    def __init__(self, vocabulary: Vocabulary, n: int, length: int):
        self.vocabulary, self.n, self.length = vocabulary, n, length
        self.back = np.zeros((n, length + 1), np.int32)

    def advance(self, table: np.ndarray, low: int, first: int, last: int) -> None:
        """From end ``first`` to end ``last``, by a table of pieces whose starts count from ``low``."""
        for end in range(first, last + 1):
            sizes = np.arange(1, min(end, table.shape[2] - 1) + 1)
            self.step(end, sizes, table[:, end - low - sizes, sizes])

    def step(self, end: int, sizes: np.ndarray, piece: np.ndarray) -> None:
        raise NotImplementedError

    def ends(self) -> np.ndarray:
        """Ends of the pieces that begin at each position (0: no piece begins there)."""
        ends = np.zeros((self.n, self.length), np.int32)
        at, rows = np.full(self.n, self.length), np.arange(self.n)
        while (at > 0).any():
            live = at > 0
            size = self.back[rows[live], at[live]]
            ends[rows[live], at[live] - size] = at[live]
            at[live] -= size
        return ends


class Summed(Paths):
    """Paths by the sum of their pieces' scores; a character that is no piece scores below all."""

    def __init__(self, vocabulary: Vocabulary, n: int, length: int):
        super().__init__(vocabulary, n, length)
        self.floor = np.float32(vocabulary.scores.min() - 10)
        self.best = np.full((n, length + 1), -np.inf, np.float32)
        self.best[:, 0] = 0

    def step(self, end: int, sizes: np.ndarray, piece: np.ndarray) -> None:
        score = np.where(piece >= 0, self.vocabulary.scores[piece], np.float32(-np.inf))
        score[:, 0] = np.where(piece[:, 0] >= 0, score[:, 0], self.floor)
        paths = self.best[:, end - sizes] + score
        self.back[:, end], self.best[:, end] = sizes[paths.argmax(1)], paths.max(1)


class Standing(Paths):
    """Paths of pieces that can stand side by side; ``last`` has each prefix's last piece."""

    def __init__(self, vocabulary: Vocabulary, n: int, length: int):
        super().__init__(vocabulary, n, length)
        self.last = np.full((n, length + 1), vocabulary.start, np.int32)

    def step(self, end: int, sizes: np.ndarray, piece: np.ndarray) -> None:
        piece[:, 0] = np.where(piece[:, 0] >= 0, piece[:, 0], self.vocabulary.alone)
        there = piece >= 0
        several = there.sum(1) > 1  # one piece alone needs no test
        row, column = np.nonzero(there & several[:, None])
        score = np.where(there, np.float32(0), np.float32(-np.inf))
        score[row, column] = np.where(self.vocabulary.stand(self.last[row, end - sizes[column]], piece[row, column]), 0, -np.inf)
        best, rows = score.argmax(1), np.arange(self.n)
        self.back[:, end], self.last[:, end] = sizes[best], piece[rows, best]


@dataclass
class Vocabulary:
    pieces: list[str]
    scores: np.ndarray
    kinds: np.ndarray
    model: int
    prefix: bool

    _made = {}

    @classmethod
    def of(cls, path: str) -> Vocabulary:
        """The vocabulary of a model file, read once in each Python process."""
        if path not in cls._made:
            with open(path, "rb") as f:
                cls._made[path] = cls.parse(f.read())
        return cls._made[path]

    @classmethod
    def parse(cls, data: bytes) -> Vocabulary:
        pieces, scores, kinds, model, prefix = [], [], [], UNIGRAM, True
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                pieces.append(own.get(1, b"").decode())
                scores.append(own.get(2, 0.0))
                kinds.append(own.get(3, NORMAL))
            elif number == 2:
                model = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                rules = dict(_fields(value))
                prefix = bool(rules.get(3, 1))
                if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
                    raise ValueError("models that map characters, remove blanks or keep them as they are are not supported")
        return cls(pieces, np.array(scores, np.float32), np.array(kinds), model, prefix).prepared()

    def prepared(self) -> Vocabulary:
        usable = np.flatnonzero(np.isin(self.kinds, (NORMAL, USER_DEFINED)))
        texts = [self.pieces[i] for i in usable]
        if any(SPACE in x.lstrip(SPACE) for x in texts):
            raise ValueError("pieces with a blank inside are not supported")
        self.longest = max(map(len, texts))
        codes = _codes("".join(texts))
        ends = np.cumsum([len(x) for x in texts])
        keys = self._keys(_running(codes), ends - [len(x) for x in texts], ends)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], usable[order].astype(np.int32)
        self.seen = np.zeros(1 << SEEN_BITS, bool)  # most substrings are ruled out by their keys' top bits
        self.seen[keys >> np.uint64(64 - SEEN_BITS)] = True
        self.forget()
        self.unknown = int(np.flatnonzero(self.kinds == UNKNOWN)[0])
        found = {self.pieces[i]: i for i in np.flatnonzero(self.kinds == BYTE)}
        self.bytes = [int(found[f"<0x{b:02X}>"]) for b in range(256)] if len(found) == 256 else None
        self.index = {x: int(i) for x, i in zip(texts, usable, strict=True)}
        out = [b"" if k == CONTROL else (bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(SPACE, " ").encode()) for p, k in zip(self.pieces, self.kinds, strict=True)]
        out[self.unknown] = " ⁇ ".encode()
        self.outputs = np.frombuffer(b"".join(out), np.uint8)
        self.output_at = np.concatenate((np.zeros(1, np.int64), np.cumsum([len(x) for x in out])))
        if self.model == BPE:
            self._merge_trees(usable, texts)
        return self

    def _merge_trees(self, usable: np.ndarray, texts: list[str]) -> None:
        """The two pieces that each piece is last merged from, and which pieces join to a piece.

        ``formed`` is a piece's score, or infinity for a single character; merges happen in falling order of it.
        Pieces that merges of their own text don't give are left out of ``ids``: nothing ever merges to them.
        """
        size = len(self.pieces)
        self.left, self.right = np.full(size + 2, -1, np.int32), np.full(size + 2, -1, np.int32)
        self.formed = np.full(size + 2, np.inf, np.float32)  # the last two: a character that is no piece, a word's start
        self.alone, self.start = size, size + 1
        lengths = np.array([len(x) for x in texts])
        codes = _codes("".join(texts))
        run, first = _running(codes), np.cumsum(lengths) - lengths
        lost, joins = [], []
        for length in np.unique(lengths[lengths > 1]):
            same = np.flatnonzero(lengths == length)
            table = self.table(run, first[same], int(length))
            for k in range(1, length):  # every way to split the pieces in two
                a, b = table[:, 0, k], table[:, k, length - k]
                ok = (a >= 0) & (b >= 0)
                joins.append(np.stack((a[ok].astype(np.int64) << 32 | b[ok], usable[same[ok]]), 1))
            table[:, 0, length] = -1  # the state before the last merge
            ends = self.merges(table)
            middle = ends[:, 0]
            two = (middle < length) & (ends[np.arange(len(same)), np.minimum(middle, length - 1)] == length)
            rows = np.flatnonzero(two)
            own = usable[same[rows]]
            a, b = table[rows, 0, middle[rows]], table[rows, middle[rows], length - middle[rows]]
            known = (a >= 0) & (b >= 0)
            self.left[own[known]], self.right[own[known]] = a[known], b[known]
            self.formed[own] = self.scores[own]
            lost.append(usable[same[~two]])
            lost.append(own[~known])
        joined = np.concatenate(joins) if joins else np.zeros((0, 2), np.int64)
        order = np.argsort(joined[:, 0])
        self.join_keys, self.join_ids = joined[order, 0], joined[order, 1].astype(np.int32)
        gone = np.isin(self.ids, np.concatenate(lost)) if lost else np.zeros(len(self.ids), bool)
        self.keys, self.ids = self.keys[~gone], self.ids[~gone]
        whole = np.flatnonzero(self.left >= 0)
        if (np.minimum(self.formed[self.left[whole]], self.formed[self.right[whole]]) < self.formed[whole]).any():
            raise ValueError("pieces that are merged before their parts are not supported")
        self.pair_keys, self.pair_good = np.full(1 << PAIR_BITS, -1, np.int64), np.zeros(1 << PAIR_BITS, bool)

    def _joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The score of the piece that a and b make together (minus infinity: none)."""
        if not len(self.join_keys):
            return np.full(len(a), -np.inf, np.float32)
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.join_keys, key), len(self.join_keys) - 1)
        return np.where(self.join_keys[at] == key, self.scores[self.join_ids[at]], np.float32(-np.inf))

    def _walked(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``stand`` by walking back in time: the later formed of the two symbols at the border is taken apart.

        Two symbols that met are merged if their piece comes before what took one of them away, or at the same time
        and further left. Where no pair of symbols was, the pieces stand.
        """
        good = np.ones(len(a), bool)
        row, x, y = np.arange(len(a)), a, b
        until, later = np.full(len(a), -np.inf, np.float32), np.zeros(len(a), bool)
        while len(row):
            score = self._joined(x, y)
            bad = (score > until) | later & (score == until) & (score > -np.inf)
            good[row[bad]] = False
            fx, fy = self.formed[x], self.formed[y]
            live = ~bad & (np.minimum(fx, fy) < np.inf)
            row, x, y, fx, fy = row[live], x[live], y[live], fx[live], fy[live]
            later = fy <= fx  # of equal pieces the left one is merged first
            until = np.where(later, fy, fx)
            x, y = np.where(later, x, self.right[x]), np.where(later, self.left[y], y)
        return good

    def stand(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the text of piece a and then b gives these two pieces; remembers what it found."""
        key = a.astype(np.int64) << 32 | b
        slot = (mix64(key.view(np.uint64)) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        good = self.pair_good[slot]
        new = np.flatnonzero(self.pair_keys[slot] != key)
        if len(new):
            found, back = np.unique(key[new], return_inverse=True)
            told = self._walked((found >> 32).astype(np.int32), (found & 0xFFFFFFFF).astype(np.int32))
            good[new] = told[back]
            at = (mix64(found.view(np.uint64)) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
            self.pair_keys[at] = found
            kept = self.pair_keys[at] == found  # of new pairs in one slot one stays
            self.pair_good[at[kept]] = told[kept]
        return good

    @staticmethod
    def _keys(run: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((run[ends] - run[starts]) * _powers(_INVERSE, len(run))[starts] + (ends - starts).astype(np.uint64))

    def found(self, run: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Piece ids of substrings (-1: none)."""
        keys = self._keys(run, starts, starts + lengths)
        maybe = np.flatnonzero(self.seen[keys >> np.uint64(64 - SEEN_BITS)])
        place = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
        out = np.full(len(keys), -1, np.int32)
        out[maybe] = np.where(self.keys[place] == keys[maybe], self.ids[place], -1)
        return out

    def table(self, run: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        """Piece ids (words x start x piece length, -1: none) of words of one length."""
        most = min(length, self.longest)
        out = np.full((len(starts), length, most + 1), -1, np.int32)
        for k in range(1, most + 1):
            at = starts[:, None] + np.arange(length - k + 1)
            out[:, : length - k + 1, k] = self.found(run, at.ravel(), np.int64(k)).reshape(at.shape)
        return out

    def viterbi(self, table: np.ndarray) -> np.ndarray:
        """Ends of the pieces that begin at each position on the best path (0: no piece begins there)."""
        n, length, width = table.shape
        paths = self.paths(n, length)
        paths.advance(table, 0, 1, length)
        return paths.ends()

    def paths(self, n: int, length: int) -> Paths:
        return (Standing if self.model == BPE else Summed)(self, n, length)

    def merges(self, table: np.ndarray) -> np.ndarray:
        """Ends of pieces by the best merge of each word in each step (the leftmost of equals), as BPE is defined."""
        n, length, width = table.shape
        ends = np.broadcast_to(np.arange(1, length + 1, dtype=np.int32), (n, length)).copy()
        if length < 2:
            return ends
        live = np.arange(n)
        score = np.append(self.scores, np.float32(-np.inf))  # id -1 has no score
        while len(live):
            own = ends[live]
            after = np.minimum(own, length - 1)
            reach = np.take_along_axis(own, after, 1)
            size = np.where((own > 0) & (own < length), reach - np.arange(length), 0)
            ok = (size > 0) & (size < width)
            piece = np.where(ok, table[live[:, None], np.arange(length), np.where(ok, size, 0)], -1)
            value = score[piece]
            best = value.argmax(1)
            row = np.arange(len(live))
            some = value[row, best] > -np.inf
            live, best = live[some], best[some]
            middle = ends[live, best]
            ends[live, best] = ends[live, middle]
            ends[live, middle] = 0
        return ends

    def single(self, text: str) -> list[int]:
        """Ids of a piece, or of a character that is none."""
        piece = self.index.get(text)
        if piece is not None:
            return [piece]
        return [self.bytes[b] for b in text.encode()] if self.bytes else [self.unknown]

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.values, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def places(self, texts: list[str]) -> np.ndarray:
        """Places of words in ``values`` and ``sizes``, which keep what earlier batches found until there is too much."""
        if len(self.place) > KEPT_WORDS:
            self.forget()
        missing = [x for x in texts if x not in self.place]
        if missing:
            values, sizes = self.words([x.replace(" ", SPACE) for x in missing])
            self.place.update(zip(missing, range(len(self.sizes), len(self.sizes) + len(missing)), strict=True))
            self.values, self.sizes = np.concatenate((self.values, values)), np.concatenate((self.sizes, sizes))
        return np.fromiter(map(self.place.__getitem__, texts), np.int64, len(texts))

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, in which blanks are already marks: flat, and how many each word has."""
        lengths = np.array([len(x) for x in texts])
        codes = _codes("".join(texts))
        run, first = _running(codes), np.cumsum(lengths) - lengths
        owners, found = [], []
        for length in np.unique(lengths):
            same = np.flatnonzero(lengths == length)
            if length == 0:
                continue
            most = min(int(length), self.longest)
            step = max(1, 3_000_000 // (min(int(length), STRETCH + most) * (most + 1)))
            for a in range(0, len(same), step):
                part = same[a : a + step]
                paths = self.paths(len(part), int(length))
                for end in range(0, int(length), STRETCH):
                    low, high = max(0, end - most), min(int(length), end + STRETCH)
                    paths.advance(self.table(run, first[part] + low, high - low), low, end + 1, high)
                ends = paths.ends()
                row, at = np.nonzero(ends)
                piece = self.found(run, first[part[row]] + at, ends[row, at] - at)
                none = np.flatnonzero(piece < 0)
                if len(none):
                    each = [self.single(texts[part[r]][w]) for r, w in zip(row[none], at[none], strict=True)]
                    sizes = np.ones(len(piece), np.int64)
                    sizes[none] = [len(x) for x in each]
                    begin = (np.cumsum(sizes) - sizes)[none]
                    row, piece = np.repeat(row, sizes), np.repeat(piece, sizes)
                    inside = np.arange(sizes[none].sum()) - np.repeat(np.cumsum(sizes[none]) - sizes[none], sizes[none])
                    piece[np.repeat(begin, sizes[none]) + inside] = [y for x in each for y in x]
                found.append(piece.astype(np.uint32))
                owners.append(part[row])
        if not found:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        owner = np.concatenate(owners)
        return np.concatenate(found)[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(texts))

    def encode(self, column: pa.Array, limit: int = 4 << 20):
        """Yield (first row, ids, offsets) for row ranges of about ``limit`` bytes of a text column (null: empty)."""
        text = pc.replace_substring(pc.fill_null(column.cast(pa.large_string()), ""), SPACE, " ")
        if self.prefix:
            text = pc.if_else(pc.equal(text, ""), text, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), text, pa.scalar("", pa.large_string())))
        data, offsets = flat_text(text)
        for a, b in slices(offsets, limit):
            own, at = np.ascontiguousarray(data[offsets[a] : offsets[b]]), offsets[a : b + 1] - offsets[a]
            if not len(own):
                yield a, np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
                continue
            cut = np.zeros(len(own) + 1, bool)
            cut[1:-1] = (own[1:] == 32) & (own[:-1] != 32)
            cut[at] = True
            bounds = np.flatnonzero(cut)
            words = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(own)]).dictionary_encode()
            index = self.places(words.dictionary.to_pylist())[words.indices.to_numpy(zero_copy_only=False)]
            n, begin = self.sizes[index], (np.cumsum(self.sizes) - self.sizes)[index]
            out = np.concatenate((np.zeros(1, np.int64), np.cumsum(n)))
            yield a, self.values[np.repeat(begin - out[:-1], n) + np.arange(out[-1])], out[np.searchsorted(bounds, at)]

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 text of ids."""
        begin, n = self.output_at[ids], np.diff(self.output_at)[ids]
        at = np.cumsum(n) - n
        text = self.outputs[np.repeat(begin - at, n) + np.arange(int(n.sum()))].tobytes()
        return text[1:] if self.prefix and text.startswith(b" ") else text


def encode(docs: DataFrame, model_path: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids``: little-endian unsigned 32-bit piece ids as one binary; the text column goes."""
    keep = [c for c in docs.columns if c not in (text_col, out_col)]
    schema = docs.select(*keep, F.lit(b"").alias(out_col)).schema

    def run(batches):
        vocabulary = Vocabulary.of(model_path)
        for batch in batches:
            for a, ids, at in vocabulary.encode(batch.column(len(keep))):
                n = len(at) - 1
                rows = pa.array([ids[at[i] : at[i + 1]].astype("<u4").tobytes() for i in range(n)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, n) for i in range(len(keep))), rows], [*keep, out_col])
        vocabulary.forget()
        tidy()

    small_batches(docs.sparkSession, 4 << 20)
    return docs.select(*keep, text_col).mapInArrow(run, schema)


def decode(docs: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``docs`` with the text of its ids (null: empty)."""
    keep = [c for c in docs.columns if c != out_col]
    schema = docs.select(*keep, F.lit("").alias(out_col)).schema

    small_batches(docs.sparkSession, 4 << 20)

    def run(batches):
        vocabulary = Vocabulary.of(model_path)
        for batch in batches:
            ids = batch.column(keep.index(ids_col)).to_pylist()
            texts = [vocabulary.decode(np.frombuffer(x or b"", "<u4").astype(np.int64)).decode(errors="replace") for x in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*keep, out_col])

    return docs.select(*keep).mapInArrow(run, schema)
