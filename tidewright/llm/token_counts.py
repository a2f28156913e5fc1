"""Token counts of a text column: batch encoding in Arrow functions that give back lengths only.

A task joins its texts to one run of bytes and cuts it into batches of about equal bytes, whatever the texts' lengths: a
long text is split over several batches and short ones share one. Cuts lie at boundaries that no token can cross, so the
lengths of the parts add up to the text's. Within a batch each distinct part is encoded once.

* SentencePiece models: a boundary is between two characters that stand side by side in no piece (``piece_parts``), such
  as a letter and the blank after it. Models with a normaliser of their own are given whole texts.
* ``tokenizers`` files: byte-level ones by ``bpe_ids``, which cuts at the borders of their pre-tokens; others whole texts.

Null and empty texts have 0 tokens; texts without a boundary go to the library whole. Repeated rows get equal counts, an
empty table gives none. Other columns are left alone; those named like the results are replaced.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.bpe_ids import Encoder
from tidewright.llm.common import flat_text, slices, small_batches, tidy
from tidewright.llm.piece_parts import PieceParts

KEPT_PARTS = 500_000
BATCH_BYTES = 1 << 20


class PieceCounter:
    """Lengths of texts by a SentencePiece model."""

    def __init__(self, path: str):
        self.parts = PieceParts(path)
        self.kept: dict[str, int] = {}

    def lengths(self, parts: list[str]) -> np.ndarray:
        """The library's lengths of parts; keeps them for later batches until there are too many."""
        if len(self.kept) > KEPT_PARTS:
            self.kept.clear()
        missing = [x for x in parts if x not in self.kept]
        if missing:
            self.kept.update(zip(missing, map(len, self.parts.encode(missing)), strict=True))
        return np.fromiter(map(self.kept.__getitem__, parts), np.int64, len(parts)) - self.parts.lead

    def counts(self, text: pa.Array, limit: int) -> np.ndarray:
        """Tokens of each text of a column, from batches of about ``limit`` bytes."""
        data, offsets = self.parts.flat(text)
        bounds = self.parts.bounds(data, offsets)
        run = np.zeros(len(bounds), np.int64)
        for a, b in slices(bounds, limit):
            told, place = self.parts.distinct(data, bounds[a : b + 1])
            run[a + 1 : b + 1] = self.lengths(told)[place]
        return np.diff(np.cumsum(run)[np.searchsorted(bounds, offsets)])


class JsonCounter:
    """Lengths of texts by a ``tokenizers`` file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        self.encoder = Encoder.of(path)
        self.whole = (told.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or bool(told.get("normalizer"))

    def counts(self, text: pa.Array, limit: int) -> np.ndarray:
        data, offsets = flat_text(text)
        out = np.zeros(len(offsets) - 1, np.int64)
        raw = data.tobytes()
        for a, b in slices(offsets, limit):
            if self.whole:
                texts = [raw[offsets[i] : offsets[i + 1]].decode() for i in range(a, b)]
                out[a:b] = [len(e.ids) for e in self.encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            else:
                out[a:b] = np.diff(self.encoder._encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])[1])
        return out


_MADE: dict[str, PieceCounter | JsonCounter] = {}


def counter(path: str) -> PieceCounter | JsonCounter:
    if path not in _MADE:
        _MADE[path] = JsonCounter(path) if path.endswith(".json") else PieceCounter(path)
    return _MADE[path]


def token_counts(docs: DataFrame, path: str, limit: int = 4096, text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``docs`` without its texts, with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``)."""
    added = ("n_bytes", "n_tokens", "over_limit")
    keep = [c for c in docs.columns if c not in (text_col, *added)]
    schema = docs.select(*keep, F.lit(0).cast("long").alias(added[0]), F.lit(0).cast("long").alias(added[1]), F.lit(True).alias(added[2])).schema

    def run(batches):
        told = counter(path)
        for batch in batches:
            text = batch.column(len(keep))
            size, tokens = np.diff(flat_text(text)[1]), told.counts(text, batch_bytes)
            found = [pa.array(size, pa.int64()), pa.array(tokens, pa.int64()), pa.array(tokens > limit, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *found], [*keep, *added])
        tidy()

    small_batches(docs.sparkSession, 4 << 20)
    return docs.select(*keep, text_col).mapInArrow(run, schema)
