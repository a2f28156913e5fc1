"""Byte-level BPE ids of a text column with the ``tokenizers`` library, encoding each distinct word once a batch.

The byte-level pre-tokenizer always starts a new word at a single blank or line feed that a visible character follows,
whatever stands before, and between a letter and a punctuation mark. Cutting there changes no id, and the pieces repeat so often that encoding the distinct ones
costs a tenth of encoding the texts. The tokenizer's added tokens, such as ``<|endoftext|>``, are pieces of their own
where a text holds them, as the library has it, and a text ends before them as at its own end.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa

from tidewright.llm.common import flat_text, slices

#: Bytes that begin a visible character: printable ASCII, and the UTF-8 lead bytes of U+00C0 to U+07FF. Others also
#: begin visible characters; leaving them out only makes longer pieces.
_VISIBLE = np.zeros(256, bool)
_VISIBLE[33:127] = True
_VISIBLE[0xC3:0xE0] = True


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True


#: A blank or none, then basic and extended Latin letters: what the pre-tokenizer always leaves whole.
_PLAIN = re.compile("[ ]?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+").fullmatch
#: The characters by which byte-level BPE writes bytes: printable Latin-1 stands for itself, the rest follow U+0100.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: b for b in _SHOWN} | {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in _SHOWN)}


class Encoder:
    """Ids of texts by the tokenizer in ``path``; one for each Python worker, path and cache size (in words, some 170 bytes each)."""

    _made: dict[tuple[str, int], Encoder] = {}

    def __init__(self, path: str, cache: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(x.lstrip or x.rstrip or x.single_word for x in added):
            raise ValueError(f"{path}: added tokens that depend on their neighbours")
        told = sorted((re.escape(x.content.encode()) for x in added if x.content), key=len, reverse=True)
        self.added = re.compile(b"|".join(told)) if told else None
        self.model, self.cache_size = self.tokenizer.model, cache
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.values, self.ends = array("I"), array("q", [0])

    @classmethod
    def of(cls, path: str, cache: int = 200_000) -> Encoder:
        if (path, cache) not in cls._made:
            cls._made[path, cache] = cls(path, cache)
        return cls._made[path, cache]

    def _keep(self, text: str, ids: list[int]) -> None:
        self.place[text] = len(self.ends) - 1
        self.values.extend(ids)
        self.ends.append(len(self.values))

    def _pieces(self, texts: list[str]) -> np.ndarray:
        """Places of the texts' ids in ``values``; keeps them for later batches until there are too many."""
        if len(self.place) > self.cache_size:
            self.forget()
        missing = [x for x in texts if x not in self.place]
        other = []
        for x in missing:
            if _PLAIN(x):  # one pre-token: only the merges are left to do
                self._keep(x, [t.id for t in self.model.tokenize(x.encode().decode("latin-1").translate(_BYTE_CHARS))])
            else:
                other.append(x)
        for i in range(0, len(other), 8192):
            part = other[i : i + 8192]
            for x, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self._keep(x, e.ids)
        return np.fromiter(map(self.place.__getitem__, texts), np.int32, len(texts))

    def _added_spans(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
        """Where the rows' added tokens are, without those that would reach into the next row."""
        spans, raw, at = [], data.tobytes(), 0
        while self.added and (found := self.added.search(raw, at)):
            a, b = found.span()
            whole = offsets[np.searchsorted(offsets, a, "right")] >= b
            at = b if whole else a + 1
            if whole:
                spans.append((a, b))
        return spans

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        cut = np.zeros(len(data) + 1, bool)
        spans = self._added_spans(data, offsets)
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        edge[[x for span in spans for x in span]] = True
        # a blank or line feed before an edge ends its text, and belongs to the white space before it
        gap = np.flatnonzero(((data[:-1] == 32) | (data[:-1] == 10)) & _VISIBLE[data[1:]] & ~edge[1:-1])
        cut[gap] = True
        cut[gap[data[gap] == 10] + 1] = True
        cut[1:-1] |= _LETTER[data[:-1]] & _MARK[data[1:]]
        for a, b in spans:
            cut[a:b] = False
        cut |= edge
        bounds = np.flatnonzero(cut)
        pieces = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = pieces.dictionary_encode()
        index = self._pieces(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
        ends, values = np.array(self.ends, np.int32), np.array(self.values, np.uint32)
        n = np.diff(ends)[index]
        out = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=out[1:])
        at = np.repeat(ends[index] - out[:-1].astype(np.int32), n)
        at += np.arange(len(at), dtype=np.int32)
        return values[at], out[np.searchsorted(bounds, offsets)]

    def encode(self, column: pa.Array, limit: int = 4 << 20):
        """Yield (first row, ids, offsets) for row ranges of about ``limit`` bytes of a text column (null: empty)."""
        data, offsets = flat_text(column)
        for a, b in slices(offsets, limit):
            ids, at = self._encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            yield a, ids, at
