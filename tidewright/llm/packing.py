"""Harmonic packing of documents into fixed-length sequences.

With capacity C, a piece of length in (C/(k+1), C/k] belongs to class k, and a bin of class k takes exactly k pieces.
A document first gives whole sequences of C ids. Its rest, in class k, either fills its slot C/k well (at least
``fill`` of it) and stays whole, or is cut once at C//(k+1), which fills a slot of class k+1, and what is left is
classed again. Rests of class ``classes`` or beyond go to one open bin filled one after the other, where a piece that
doesn't fit is cut at the bin's end. Every task packs its own rows: one open bin for each class, no shuffle. At the end
of a task the unfinished bins' pieces are put together, longest first, and the last bin may stay short.

Sequence ids are the task's number times 2**32 plus a count, so they are unique without any exchange. The same rows in
the same order give the same sequences, so a task that runs again repeats its result.

A null text is an empty document, which has the end id alone. Repeated rows, and rows that share an id, are packed as
often as they occur; a null id stays null. A document longer than ``capacity`` ids gives whole sequences first, however
long it is, and its ids are in memory once. Only the id and text columns are read, so other columns never clash. An empty
table gives no piece.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.bpe_ids import Encoder
from tidewright.llm.common import small_batches, tidy

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def cuts(n: int, capacity: int = 2048, classes: int = 16, fill: float = 0.97) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document of ``n`` ids, in order; class 0 is the open bin."""
    out = [(capacity, 1)] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if k >= classes:
            out.append((rest, 0))
            break
        if rest * k >= fill * capacity:
            out.append((rest, k))
            break
        piece = capacity // (k + 1)
        if k + 1 >= classes:
            out.append((rest, 0))
            break
        out.append((piece, k + 1))
        rest -= piece
    return out


class Packer:
    """The open bins of one task. A piece is (row, start, length); ``take`` gets finished bins."""

    def __init__(self, capacity: int, classes: int, fill: float):
        self.capacity, self.classes, self.fill = capacity, classes, fill
        self.open: dict[int, list] = {}
        self.done: list[list] = []
        self._cuts: dict[int, list[tuple[int, int]]] = {}
        self.last: list = []
        self.used = 0

    def add(self, doc, n: int) -> None:
        rest = n % self.capacity
        plan = self._cuts.get(rest)
        if plan is None:
            plan = self._cuts[rest] = cuts(rest, self.capacity, self.classes, self.fill)
        start = 0
        for _ in range(n // self.capacity):
            self.done.append([(doc, start, self.capacity)])
            start += self.capacity
        for length, k in plan:
            if k == 0:
                self._pour(doc, start, length)
            elif k == 1:
                self.done.append([(doc, start, length)])
            else:
                bin_ = self.open.setdefault(k, [])
                bin_.append((doc, start, length))
                if len(bin_) == k:
                    self.done.append(self.open.pop(k))
            start += length

    def _pour(self, doc, start: int, length: int) -> None:
        while length:
            piece = min(length, self.capacity - self.used)
            self.last.append((doc, start, piece))
            self.used, start, length = self.used + piece, start + piece, length - piece
            if self.used == self.capacity:
                self.done.append(self.last)
                self.last, self.used = [], 0

    def finish(self) -> None:
        for doc, start, length in sorted((x for bin_ in self.open.values() for x in bin_), key=lambda x: -x[2]):
            self._pour(doc, start, length)
        self.open = {}
        if self.last:
            self.done.append(self.last)
            self.last, self.used = [], 0


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1, classes: int = 16, fill: float = 0.97, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: its document, start, length and ids (little-endian unsigned 32-bit), its sequence and place there."""

    def run(batches):
        from pyspark import TaskContext

        first_id, made, encoder, packer = TaskContext.get().partitionId() << 32, 0, Encoder.of(tokenizer_path), Packer(capacity, classes, fill)

        def rows():
            nonlocal made
            out = [[] for _ in range(7)]
            for bin_ in packer.done:
                offset = 0
                for (doc_id, ids), start, length in bin_:
                    for column, value in zip(out, (doc_id, start, length, len(ids), first_id + made, offset, ids[start : start + length].tobytes()), strict=True):
                        column.append(value)
                    offset += length
                made += 1
            packer.done = []
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out[:6]] + [pa.array(out[6], pa.binary())], ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, ids, at in encoder.encode(batch.column(1), 1 << 20):
                for i in range(len(at) - 1):
                    own = np.append(ids[at[i] : at[i + 1]], np.uint32(end_id)).astype("<u4")
                    packer.add((doc_ids[first + i], own), len(own))
                yield rows()
        packer.finish()
        yield rows()
        encoder.forget()
        tidy()

    small_batches(docs.sparkSession, 4 << 20)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)
