"""Token ids in length-delimited binary files with masked checksums, and an offset index for shuffled reads.

A file holds records, each framed as ``length (u64) | masked crc of the length (u32) | payload | masked crc of the
payload (u32)``, little-endian. The payload is ``doc_id (i64) | flags (u32) | ids``; flag 1 is a null doc_id, flag 2
ids of two bytes, used while the vocabulary fits, else they have four. A masked crc is the CRC-32 rotated right by 15
bits plus 0xA282EAD8, so that a checksum stored in data that is checksummed itself does no harm. Beside each file lies
an index of the same name and ``.idx``: the record count, and each record's offset (u64).

Documents are range-partitioned and sorted by id, so the files in order hold them in order; a partition rolls over
to a further file at ``ROLL`` bytes. Encoding and writing happen in the same task, after the texts are shuffled, so ids
are never shuffled. A manifest with one row per file gives the number of ids before each. Files are written whole or
not at all and have the same content when a task is repeated.

Ids come from the tokenizers library: each distinct chunk of text that a worker has not met lately is encoded by it
(see ``chunks``), and every text's ids are those of the whole text. Defined cases: a null text is empty and has only
the end id; null ids come first; equal ids are ordered by text; other columns are not read; an empty table gives no
files and no rows.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerec.llm.chunks import Encoder
from lakerec.llm.shards import reading, writing
from lakerec.session import new_scratch, stored

ROLL = 128 << 20
KEPT = 700_000  # chunks that a worker process remembers, some 150 MB
SLICE_BYTES = 4 << 20  # of texts whose chunks are told apart at once: fewer look-ups than in slices of 1 MB
NULL_ID, NARROW = 1, 2
HEAD = "<QI"
LEAD = "<qI"
MANIFEST = "file string, place bigint, part bigint, n_docs bigint, n_ids bigint"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join([length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload))])


def payload_of(doc_id: int | None, ids: np.ndarray, narrow: bool) -> bytes:
    flags = (NULL_ID if doc_id is None else 0) | (NARROW if narrow else 0)
    return struct.pack(LEAD, doc_id or 0, flags) + ids.astype("<u2" if narrow else "<u4").tobytes()


def read_payload(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, flags = struct.unpack_from(LEAD, payload)
    ids = np.frombuffer(payload, dtype="<u2" if flags & NARROW else "<u4", offset=struct.calcsize(LEAD))
    return None if flags & NULL_ID else doc_id, ids


def read_record(file: pa.NativeFile) -> bytes | None:
    """The payload at the file's position, checked; None at its end."""
    head = file.read(struct.calcsize(HEAD))
    if not head:
        return None
    if len(head) < struct.calcsize(HEAD):
        raise ValueError("a record is cut off")
    length, check = struct.unpack(HEAD, head)
    if masked_crc(head[:8]) != check:
        raise ValueError("a record's length is damaged")
    body = file.read(length + 4)
    if len(body) != length + 4 or masked_crc(body[:-4]) != struct.unpack("<I", body[-4:])[0]:
        raise ValueError("a record is damaged")
    return body[:-4]


def read_index(folder: str, name: str) -> np.ndarray:
    """Offsets of a file's records."""
    with reading(folder, f"{name}.idx") as file:
        data = file.read()
    count = struct.unpack_from("<Q", data)[0]
    offsets = np.frombuffer(data, dtype="<u8", offset=8)
    if len(offsets) != count:
        raise ValueError("an index is cut off")
    return offsets


def read_at(folder: str, name: str, offset: int) -> tuple[int | None, np.ndarray]:
    """One record by its offset, as a shuffled reader takes it."""
    with reading(folder, name) as file:
        file.seek(int(offset))
        return read_payload(read_record(file))


_encoders: dict[str, tuple[Encoder, bool]] = {}


def library_encoder(path: str) -> tuple[Encoder, bool]:
    """An encoder that asks the tokenizers library for chunks, and whether ids fit two bytes.

    It is kept in the worker process with the chunks it knows, so the tasks that the process runs share it.
    """
    if path not in _encoders:
        _encoders[path] = _new_encoder(path)
    return _encoders[path]


def _new_encoder(path: str) -> tuple[Encoder, bool]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    added = tokenizer.get_added_tokens_decoder()
    if len(added) > 1:
        raise ValueError("more than one added token")
    special_id, special = next(((i, t.content.encode()) for i, t in added.items()), (-1, None))

    def encode(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        coded = tokenizer.encode_batch_fast([c.decode() for c in chunks], add_special_tokens=False)
        ids = [c.ids for c in coded]
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(lengths.sum()))
        return flat, np.cumsum(lengths) - lengths, lengths

    return Encoder(encode, special, special_id, KEPT, SLICE_BYTES), tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16


class _Shards:
    """Files of one partition, one after the other."""

    def __init__(self, folder: str, part: int):
        self.folder, self.part, self.place = folder, part, 0
        self._open()

    def _open(self) -> None:
        self.name = f"part-{self.part:06d}-{self.place:05d}.rec"
        self.offsets, self.size, self.n_ids = [], 0, 0
        self.context = writing(self.folder, self.name)
        self.file = self.context.__enter__()

    def add(self, payload: bytes, ids: int) -> tuple | None:
        """Write a record; the finished file's row of the manifest, when it is full."""
        self.offsets.append(self.size)
        record = framed(payload)
        self.file.write(record)
        self.size += len(record)
        self.n_ids += ids
        if self.size < ROLL:
            return None
        row = self.close()
        self.place += 1
        self._open()
        return row

    def close(self) -> tuple:
        self.context.__exit__(None, None, None)
        with writing(self.folder, f"{self.name}.idx") as file:
            file.write(struct.pack("<Q", len(self.offsets)) + np.array(self.offsets, dtype="<u8").tobytes())
        return self.name, self.place, self.part, len(self.offsets), self.n_ids


def _manifest_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), *[pa.int64()] * 4]
    names = [c.split()[0] for c in MANIFEST.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def write(docs: DataFrame, folder: str, path: str, end_id: int = 0) -> DataFrame:
    """Encode ``docs (doc_id, text)``, write them to ``folder`` in ascending order; the manifest, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, narrow = library_encoder(path)
        shards = None
        end = np.array([end_id], dtype=np.int32)
        for batch in batches:
            for low, high, ids, bounds in encoder.column_ids(batch.column(1)):
                for i, doc_id in enumerate(batch.column(0).slice(low, high - low).to_pylist()):
                    own = np.concatenate([ids[bounds[i] : bounds[i + 1]], end])
                    shards = shards or _Shards(folder, TaskContext.get().partitionId())
                    if row := shards.add(payload_of(doc_id, own, narrow), len(own)):
                        yield _manifest_rows([row])
        if shards:
            yield _manifest_rows([shards.close()])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(run, MANIFEST), "manifest")



def read(manifest: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every record, read from the files that ``manifest`` lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                with reading(folder, name) as file:
                    while (payload := read_record(file)) is not None:
                        doc_id, ids = read_payload(payload)
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                        if len(rows) >= 10_000:
                            yield _record_rows(rows)
                            rows = []
                if rows:
                    yield _record_rows(rows)

    # One row per file: a running sum over them is small at any size of input.
    before = "coalesce(sum(n_ids) over (order by part, place rows between unbounded preceding and 1 preceding), 0)"
    files = stored(manifest.selectExpr("file", f"{before} as start"), "starts")
    spread = files.repartitionByRange(max(1, files.count()), "file")  # a file is a task's work
    return spread.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _record_rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)


def folder_for(spark: SparkSession, label: str = "records") -> str:
    return new_scratch(spark, label)
