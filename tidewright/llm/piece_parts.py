"""Texts of a SentencePiece model cut into parts that the library encodes one by one, each distinct part once.

Between two characters that stand side by side in no piece, no merge and no path ever crosses: cutting there changes no
token. ``PieceParts`` derives these pairs from the vocabulary for characters that one byte tells apart (ASCII, and any
other before ASCII). The library puts a blank before what it encodes, so a part goes to it behind a guard, a character
that no piece joins to others, and the guard's own tokens are taken off again.

Models with rules of their own for normalising, or without byte pieces (neighbouring unknown characters are then one
token), aren't cut: their parts are whole texts without a guard.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidewright.llm.common import flat_text
from tidewright.llm.sentencepiece_codec import SPACE, _fields


class PieceParts:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = p = SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            rules = next((dict(_fields(value)) for number, value in _fields(f.read()) if number == 3), {})
        kinds = [(p.is_control(i) or p.is_unknown(i), p.is_byte(i), p.id_to_piece(i)) for i in range(p.get_piece_size())]
        together = {pair for control, byte, piece in kinds if not (control or byte) for pair in zip(piece, piece[1:], strict=False)}
        plain = [SPACE if c == 32 else chr(c) for c in range(128)]
        self.free = np.zeros((256, 256), bool)
        self.free[:128, :128] = [[(x, y) not in together for y in plain] for x in plain]
        before_ascii = {y for x, y in together if ord(x) > 127 and x != SPACE}
        self.free[128:, :128] = [y not in before_ascii for y in plain]
        self.free[0x81] &= self.free[32]  # it ends U+2581, which the model reads as a blank
        self.guard = next((plain[c] for c in (10, *range(32)) if self.free[c].all(where=np.arange(256) < 128) and self.free[:, c].all()), "")
        self.free[:, 128:] = False
        prefix, kept = bool(rules.get(3, 1)), not rules.get(2) and not rules.get(4, 1) and rules.get(5, 1)
        self.whole = not (kept and self.guard and sum(byte for _, byte, _ in kinds) == 256)
        self.padded = prefix and not self.whole
        self.lead = 0 if self.whole else len(p.encode(self.guard))
        if self.whole:
            self.guard = ""

    def flat(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes and offsets of a text column (null: empty), with the blank that the model puts first."""
        text = pc.fill_null(text.cast(pa.large_string()), "")
        if self.padded:
            empty = pa.scalar("", pa.large_string())
            text = pc.if_else(pc.equal(text, ""), text, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), text, empty))
        return flat_text(text)

    def bounds(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where parts begin, and the end of all."""
        cut = np.zeros(len(data) + 1, bool)
        if not self.whole and len(data):
            cut[1:-1] = self.free[data[:-1], data[1:]]
        cut[offsets] = True
        return np.flatnonzero(cut)

    @staticmethod
    def distinct(data: np.ndarray, bounds: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The distinct parts between bounds, and the place of each part among them."""
        own = np.ascontiguousarray(data[bounds[0] : bounds[-1]])
        at = np.ascontiguousarray(bounds - bounds[0], np.int64)
        coded = pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(own)]).dictionary_encode()
        return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)

    def encode(self, parts: list[str]) -> list[list[int]]:
        """The library's ids of parts, behind the guard's."""
        return self.library.encode([self.guard + x for x in parts], num_threads=1)
