"""Byte-level BPE encoding by contiguous rank arrays, and decoding.

A short word is a row of part ids with an array of the ranks of adjacent pairs beside it. Each turn scans the ranks for
the least (the leftmost of equals), joins that pair, deletes the boundary, and looks up the ranks of the two pairs next
to it; a row is done when no pair has a rank. Rows of about the same length are turned together in numpy. Words above
``SHORT`` bytes keep their pairs in a heap instead, so their cost does not grow with the square of the length; the
order of joins, and so the result, is the same.

The vocabulary file's path is a parameter; nothing is trained. A special token's string in a text is that token, as
the tokenizers library has it by default. Defined cases: a null text encodes as an empty one, to no ids; texts of any
length are whole; ids that are no token raise. Columns other than the text pass through. An empty table gives an empty
table.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerec.llm.chunks import Encoder, gather

SHORT = 32
NEVER = np.int32(2**31 - 1)

#: Fixed value: the published pattern of byte-level tokenizers; blanks are Unicode's White_Space.
_BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_BLANK}\p{{L}}\p{{N}}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+"
)


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printed, else 256 and up."""
    printed = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    shown = dict(zip(printed, map(chr, printed)))
    for byte in range(256):
        if byte not in shown:
            shown[byte] = chr(256 + len(shown) - len(printed))
    return [shown[byte] for byte in range(256)]


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab = model["vocab"]
        characters = byte_characters()
        self.byte_ids = np.array([vocab[c] for c in characters], dtype=np.int32)
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        if size > 1 << 16:
            raise ValueError("ids above 16 bits")
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], dtype=np.int64)
        self.joined = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.rank_of = dict(zip(self.keys.tolist(), self.ranks.tolist()))
        back = {c: bytes([b]) for b, c in enumerate(characters)}
        tokens: list[bytes | None] = [None] * size
        for token, i in vocab.items():
            tokens[i] = b"".join(back.get(c, c.encode()) for c in token)
        specials = [t for t in spec["added_tokens"] if t["special"]]
        for t in spec["added_tokens"]:
            tokens[t["id"]] = t["content"].encode()
        if len(specials) > 1:
            raise ValueError("more than one special token")
        self.special = specials[0]["content"].encode() if specials else None
        self.special_id = specials[0]["id"] if specials else -1
        self.token_length = np.array([len(t or b"") for t in tokens], dtype=np.int64)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.token_bytes = np.frombuffer(b"".join(t or b"" for t in tokens), dtype=np.uint8)
        decimal = [f"{i},".encode() for i in range(size)]
        self.decimal_length = np.array([len(d) for d in decimal], dtype=np.int64)
        self.decimal_start = np.cumsum(self.decimal_length) - self.decimal_length
        self.decimal_bytes = np.frombuffer(b"".join(decimal), dtype=np.uint8)
        self.pieces = regex.compile(PATTERN).findall
        self.one_piece = re.compile(rb" ?(?:(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+|[0-9]+|[!-&(-/:-@\[-`{-~]+)").fullmatch

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) << 16 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NEVER)

    def _join_short(self, parts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Part ids and their number after all joins; row i begins as ``size[i]`` parts."""
        count, width = parts.shape
        parts, size = parts.copy(), size.copy()
        done, done_size = np.zeros_like(parts), size.copy()
        column = np.arange(width)
        ranks = np.full((count, width), NEVER, dtype=np.int32)  # the last column is never a pair
        inside = column[None, :-1] + 1 < size[:, None]
        ranks[:, :-1][inside] = self._rank(parts[:, :-1][inside], parts[:, 1:][inside])
        rows = np.arange(count)
        while len(rows):
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(rows)), at]
            over = least == NEVER
            if over.any():
                done[rows[over]], done_size[rows[over]] = parts[over], size[over]
                live = ~over
                rows, parts, ranks, size, at, least = (x[live] for x in (rows, parts, ranks, size, at, least))
                if not len(rows):
                    break
            r = np.arange(len(rows))
            source = np.minimum(column[None, :] + (column[None, :] > at[:, None]), width - 1)
            parts, ranks = parts[r[:, None], source], ranks[r[:, None], source]
            ranks[:, -1] = NEVER
            parts[r, at] = self.joined[least]
            size = size - 1
            ranks[r, at] = NEVER
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self._rank(parts[left, at[left] - 1], parts[left, at[left]])
            right = np.flatnonzero(at + 1 < size)
            ranks[right, at[right]] = self._rank(parts[right, at[right]], parts[right, at[right] + 1])
        return done, done_size

    def _join_long(self, word: bytes) -> np.ndarray:
        parts = self.byte_ids[np.frombuffer(word, dtype=np.uint8)].tolist()
        count = len(parts)
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        get = self.rank_of.get
        heap = [
            (rank, i, parts[i], parts[i + 1])
            for i in range(count - 1)
            if (rank := get(parts[i] << 16 | parts[i + 1])) is not None
        ]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= count or parts[j] != b:
                continue  # one of the parts is gone
            parts[i], parts[j] = int(self.joined[rank]), -1
            after[i] = after[j]
            if after[j] < count:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < count:
                    a, b = parts[k], parts[after[k]]
                    if (rank := get(a << 16 | b)) is not None:
                        heapq.heappush(heap, (rank, k, a, b))
        return np.array([p for p in parts if p >= 0], dtype=np.int32)

    def encode_chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct chunks (UTF-8) in one array, and each one's start and length in it."""
        lengths = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        single = np.fromiter(map(self.one_piece, chunks), dtype=object, count=len(chunks)) != None  # noqa: E711
        single |= lengths == 1
        body = np.frombuffer(b"".join(chunks), dtype=np.uint8)
        begins = np.cumsum(lengths) - lengths
        start, length = np.zeros(len(chunks), dtype=np.int64), np.zeros(len(chunks), dtype=np.int64)
        found, used = [], 0
        widths = np.where(single & (lengths <= SHORT), -(-lengths // 4) * 4, 0)
        for width in np.unique(widths[widths > 0]).tolist():
            group = np.flatnonzero(widths == width)
            place = np.minimum(begins[group][:, None] + np.arange(width)[None, :], len(body) - 1)
            parts, size = self._join_short(self.byte_ids[body[place]], lengths[group])
            start[group] = used + np.cumsum(size) - size
            length[group] = size
            found.append(parts[np.arange(width)[None, :] < size[:, None]])
            used += int(size.sum())
        for i in np.flatnonzero(widths == 0).tolist():
            ids = np.concatenate([self._piece_ids(p.encode()) for p in self.pieces(chunks[i].decode())])
            start[i], length[i] = used, len(ids)
            found.append(ids)
            used += len(ids)
        return np.concatenate(found).astype(np.int32), start, length

    def _piece_ids(self, piece: bytes) -> np.ndarray:
        ids = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)]
        if len(piece) == 1:
            return ids
        if len(piece) > SHORT:
            return self._join_long(piece)
        parts, size = self._join_short(ids[None, :], np.array([len(piece)]))
        return parts[0, : size[0]]

    def encoder(self) -> Encoder:
        return Encoder(self.encode_chunks, self.special, self.special_id)

    def encode(self, text: str) -> list[int]:
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        return self.encoder().slice_ids(data, np.array([0, len(data)]))[0].tolist()

    def decode_bytes(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.token_bytes, self.token_start[ids], self.token_length[ids])

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(np.asarray(ids, dtype=np.int64)).tobytes().decode("utf-8", "replace")

    def decimals(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by commas."""
        return gather(self.decimal_bytes, self.decimal_start[ids], self.decimal_length[ids]).tobytes()[:-1]


def encoded(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array<int>) in the place of the text."""
    return _over_texts(docs, path, text, "ids array<int>", _ids)


def round_trip_digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens, ids_sha256, decoded_sha256`` in the place of the text: encoded, then decoded."""
    return _over_texts(docs, path, text, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", _digests)


def _ids(bpe: Bpe, ids: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
    return [pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))]


def _digests(bpe: Bpe, ids: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
    spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
    decoded = []
    for a, b in spans:
        body = bpe.decode_bytes(ids[a:b]).tobytes()
        decoded.append(hashlib.sha256(body.decode("utf-8", "replace").encode()).hexdigest())
    return [
        pa.array(np.diff(bounds)),
        pa.array([hashlib.sha256(bpe.decimals(ids[a:b])).hexdigest() for a, b in spans], pa.string()),
        pa.array(decoded, pa.string()),
    ]


def _over_texts(docs: DataFrame, path: str, text: str, schema: str, columns) -> DataFrame:
    new = [c.split()[0] for c in schema.split(", ")]
    kept = [c for c in docs.columns if c != text and c not in new]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(0).alias("none"))
    source = docs.select(row.alias("row"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(path)
        encoder = bpe.encoder()
        for batch in batches:
            for low, high, ids, bounds in encoder.column_ids(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), *columns(bpe, ids, bounds)], names=["row", *new]
                )

    out = source.mapInArrow(run, f"row {source.schema['row'].dataType.simpleString()}, {schema}")
    return out.select(*[F.col("row")[c].alias(c) for c in kept], *new)
