"""Arrow and numpy helpers for texts: columns as byte buffers, words, and 64-bit hashes of spans.

A word is a maximal run of bytes outside ``\\x20\\x09-\\x0D``. Hashes of spans are polynomials modulo the prime 2**61 - 1
in a fixed base drawn at random, brought to position zero and mixed: two different spans of n bytes collide for at most
n of all bases, whatever they are made of. They are the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20  # texts are worked through in slices of about this size, so memory follows the longest text only

PRIME = np.uint64((1 << 61) - 1)
BASE = np.uint64(0x0B5C4D1E7A93F26B)  # drawn at random below the prime
INVERSE = np.uint64(pow(int(BASE), -1, int(PRIME)))
RUN = 1 << 15  # numbers worked through at once, so that they stay in the processor's cache
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _mod(x: np.ndarray) -> np.ndarray:
    """``x`` modulo the prime."""
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.minimum(x, x - PRIME)  # below the prime the difference wraps to a large number


def sub_mod(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    difference = a - b
    return np.minimum(difference, difference + PRIME)


def mul_mod(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product modulo the prime of numbers below it."""
    if len(a) > 2 * RUN:
        out = np.empty(len(a), dtype=np.uint64)
        for at in range(0, len(a), RUN):
            out[at : at + RUN] = mul_mod(a[at : at + RUN], b[at : at + RUN] if len(b) > 1 else b)
        return out
    half, thirty = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
    a_high, a_low, b_high, b_low = a >> np.uint64(31), a & half, b >> np.uint64(31), b & half
    middle = a_low * b_high + a_high * b_low
    total = (a_high * b_high << np.uint64(1)) + (middle >> np.uint64(30)) + ((middle & thirty) << np.uint64(31)) + a_low * b_low
    return _mod(total)


_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def powers(n: int, which: str = "up") -> np.ndarray:
    """The first ``n`` powers of the base (``up``) or of its inverse (``down``), kept between calls."""
    held = _powers[which]
    if len(held) < n:
        size = max(n, SLICE_BYTES + 2)
        grown = np.ones(size, dtype=np.uint64)
        known, step = 1, int(BASE if which == "up" else INVERSE)
        while known < size:
            more = min(known, size - known)
            grown[known : known + more] = mul_mod(grown[:more], np.array([step], dtype=np.uint64))
            known, step = known + more, step * step % int(PRIME)
        _powers[which] = held = grown
    return held[:n]


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text or binary column and the n + 1 offsets into them; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = column.cast(pa.large_binary())
    if wide.null_count:
        wide = pc.fill_null(wide, b"")
    _, offsets, data = wide.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[wide.offset : wide.offset + len(wide) + 1]
    if data is None or not len(wide):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(wide) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8), bounds


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of whole texts of at most ``limit`` bytes, or of one text."""
    data, bounds = as_bytes(column)
    low, rows = 0, len(bounds) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + limit, side="right")) - 1)
        high = min(high, rows)
        yield low, high, data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]
        low = high


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and the index of each text's first word (n + 1 entries)."""
    solid = ~IS_SPACE[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = solid
    before[bounds] = False
    begins = np.flatnonzero(solid & ~before[:-1])
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = solid
    after[bounds] = False
    ends = np.flatnonzero(solid & ~after[1:]) + 1
    return begins, ends, np.searchsorted(begins, bounds)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """For each place the sum, modulo the prime, of (byte + 1) times the power of its place over all bytes before it."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    up = powers(len(data))
    half = np.uint64(0xFFFFFFFF)
    carry = np.uint64(0)
    for at in range(0, len(data), RUN):
        value, power = data[at : at + RUN].astype(np.uint64) + np.uint64(1), up[at : at + RUN]
        low, high = np.cumsum(value * (power & half)), _mod(np.cumsum(value * (power >> np.uint64(32))))
        # high * 2**32, where 2**61 counts as 1
        shifted = ((high << np.uint64(32)) & PRIME) + (high >> np.uint64(29))
        part = _mod(_mod(low) + shifted + carry)
        sums[at + 1 : at + 1 + len(part)] = part
        carry = part[-1]
    return sums


def span_hashes(sums: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per span: equal bytes give equal hashes wherever they stand."""
    down = powers(len(sums), "down")
    value = mul_mod(sub_mod(sums[ends], sums[begins]), down[begins])
    return mix(value ^ mix((ends - begins).astype(np.uint64)))


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` consecutive values (len - width + 1 of them), order included."""
    count = max(0, len(values) - width + 1)
    total = np.full(count, width, dtype=np.uint64)
    for k in range(width):
        total = mix(total + values[k : k + count])
    return total


def shingles(data: np.ndarray, bounds: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word shingles, A-Z lower-cased.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    low = LOWER[data]
    begins, ends, first = words(low, bounds)
    values = span_hashes(prefix_sums(low), begins, ends)
    windows = window_hashes(values, width)
    result = []
    for start, end in zip(first[:-1].tolist(), first[1:].tolist()):
        if end - start >= width:
            result.append(np.unique(windows[start : end - width + 1]))
        elif end > start:
            result.append(window_hashes(values[start:end], end - start))
        else:
            result.append(np.zeros(0, dtype=np.uint64))
    return result
