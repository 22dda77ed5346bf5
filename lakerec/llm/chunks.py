"""Cuts texts into chunks that a byte-level BPE tokenizer encodes independently of each other, and encodes those.

The pattern of byte-level tokenizers ends a piece before a space that a non-blank character follows, around a line feed
between non-blank characters, and between Latin letters, ASCII digits and ASCII marks, but for what follows an
apostrophe. Texts are cut there, in numpy; a chunk may still hold several pieces. The chunks of a slice are reduced to
distinct ones by Arrow, those not met lately are encoded, and the ids are put together again by gathering. An encoder
keeps the ids of up to ``kept`` chunks and starts anew when that many are held.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa

from lakerec.llm import text as T

KEPT = 300_000
LONGEST_KEPT = 64  # bytes of a chunk that is kept

_CERTAIN = np.zeros(256, dtype=bool)  # first bytes of characters that are certainly not blank
_CERTAIN[0x21:0x7F] = True
_CERTAIN[0xC3:0xF5] = True
_CERTAIN[[0xE1, 0xE2, 0xE3]] = False
_PRINTED = np.zeros(256, dtype=bool)
_PRINTED[0x21:0x7F] = True
_KIND = np.zeros(256, dtype=np.uint8)  # 1 letters, 2 digits, 3 marks of ASCII; 0 the rest
_KIND[0x21:0x7F] = 3
_KIND[[c for c in range(128) if chr(c).isalpha()]] = 1
_KIND[[c for c in range(128) if chr(c).isdigit()]] = 2


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``flat[s : s + n]`` for each start and length, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts - ends + lengths, lengths)]


def cut(data: np.ndarray, bounds: np.ndarray, special: bytes | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Chunk bounds (n + 1) and each text's first chunk; a special string inside one text is a chunk of its own."""
    forced = np.zeros(len(data) + 1, dtype=bool)
    forced[bounds] = True
    whole = []
    if special:
        body, at = data.tobytes(), -1
        while (at := body.find(special, at + 1)) >= 0:
            if not forced[at + 1 : at + len(special)].any():
                forced[[at, at + len(special)]] = True
                whole.append(at)
                at += len(special) - 1
    cuts = forced.copy()
    if len(data) > 1:
        certain = _CERTAIN[data[1:]] & ~forced[1:-1]  # the byte after place i begins a non-blank character of the text
        cuts[:-2] |= (data[:-1] == 0x20) & certain
        line = np.zeros(len(data), dtype=bool)
        line[1:-1] = (data[1:-1] == 0x0A) & _PRINTED[data[:-2]] & certain[1:] & ~forced[1:-2]
        cuts[:-1] |= line
        cuts[1:] |= line
        kind = _KIND[data]
        latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7))
        kind[latin] = 1
        kind[latin + 1] = 1
        change = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0) & (data[:-1] != 0x27)
        cuts[1:-1] |= change
    for at in whole:
        cuts[at + 1 : at + len(special)] = False
    places = np.flatnonzero(cuts)
    return places, np.searchsorted(places, bounds)


class Encoder:
    """Ids of texts. ``encode`` gives for distinct chunks (bytes) their ids in one array, and each one's start and length."""

    def __init__(
        self,
        encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]],
        special: bytes | None,
        special_id: int,
        kept: int | None = None,
        slice_bytes: int = T.SLICE_BYTES,
    ):
        self.encode, self.special, self.special_id = encode, special, special_id
        self.kept, self.slice_bytes = kept or KEPT, slice_bytes
        self._clear()

    def _clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 20, dtype=np.int32)
        self.used = 0
        self.start = np.zeros(self.kept, dtype=np.int64)
        self.length = np.zeros(self.kept, dtype=np.int64)

    def _keep(self, chunks: list[bytes], ids: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), len(ids)), dtype=np.int32)])
        self.flat[self.used : self.used + len(ids)] = ids
        held = len(self.place)
        self.start[held : held + len(chunks)] = start + self.used
        self.length[held : held + len(chunks)] = length
        self.place.update(zip(chunks, range(held, held + len(chunks))))
        self.used += len(ids)

    def slice_ids(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice of texts, and the n + 1 bounds of each text's ids."""
        places, first = cut(data, bounds, self.special)
        count = len(places) - 1
        if count < 1:
            return np.zeros(0, dtype=np.int32), np.zeros(len(bounds), dtype=np.int64)
        chunks = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), count, [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        which = chunks.indices.to_numpy(zero_copy_only=False)
        distinct = chunks.dictionary.to_pylist()
        if len(self.place) + len(distinct) > self.kept:
            self._clear()
        known = np.fromiter(map(self.place.get, distinct, repeat(-1)), dtype=np.int64, count=len(distinct))
        start, length = self.start[known], self.length[known]
        missing = np.flatnonzero(known < 0)
        flat = self.flat[: self.used]
        if len(missing):
            words = [distinct[i] for i in missing]
            ids, word_start, word_length = self.encode(words)
            if self.special in words:
                at = words.index(self.special)
                word_start[at], word_length[at] = len(ids), 1
                ids = np.append(ids, self.special_id)
            start[missing], length[missing] = word_start + self.used, word_length
            flat = np.concatenate([flat, ids])
            short = len(max(words, key=len)) <= LONGEST_KEPT
            if short and len(self.place) + len(words) <= self.kept:
                self._keep(words, ids, word_start, word_length)
        bounds_of_ids = np.concatenate([[0], np.cumsum(length[which])])[first]
        return gather(flat, start[which], length[which]).astype(np.int32, copy=False), bounds_of_ids

    def column_ids(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, ids, bounds) of runs of rows of a text column; a null counts as empty."""
        for low, high, data, bounds in T.slices(column, self.slice_bytes):
            yield low, high, *self.slice_ids(data, bounds)
