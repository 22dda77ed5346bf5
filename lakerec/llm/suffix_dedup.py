"""Removal of repeated byte strings by a hash-compared suffix sort, spread over content-chosen buckets.

Every byte of a text (UTF-8) that a ``span``-byte string covers which also starts elsewhere is removed; strings are
judged on the input and never cross texts. ``span`` is ``SPAN`` unless the caller gives another.

1. *Buckets.* The suffixes to compare are those that start a whole string, one per byte. Each is filed under the least
   ``gram``-byte gram (by hash, leftmost first) inside its first ``span`` bytes, its anchor. Equal strings have equal
   anchors at equal offsets, so only suffixes of one bucket (anchor gram, offset) can be equal. The suffixes of one
   anchor follow each other in the text; their union, a stretch, is one row.
2. *Whole stretches.* A stretch that occurs twice is repeated as a whole. Anchors of a single stretch are unique text.
   Both are decided by counting, combined before the shuffle, however many copies there are. Stretches are told apart
   by their gram and by a 128-bit hash of their bytes.
3. *Hot anchors.* The stretches of an anchor that has more than ``BUCKET`` kinds are split by content: each suffix has a
   second anchor, the least gram by another hash, and equal strings share that too. The parts of a stretch are counted
   like stretches, and split again by further anchors while their buckets are too large, ``AT_ONCE`` anchors at a time:
   each time is a few shuffles, however little is left. After ``ROUNDS`` anchors the strings that are left, those of a
   passage with very many variants, are counted one by one.
4. *Suffix sort.* Anchors with several different stretches, the borders of repeats, get the bytes of one stretch of
   each kind. Each bucket's suffixes are sorted by merging runs; two suffixes are compared by their longest common
   extension, found from polynomial prefix hashes by binary search (9 steps for 400 bytes), and the byte after it.
   Neighbours with ``span`` bytes in common are repeated. All buckets of a task are merged at once in numpy.
   The bytes of every such pair are compared; if a hash ever lied, its bucket is decided on the bytes themselves.
5. The spans of each text are joined with it, merged and cut out.

What the sort removes is verified on the bytes; what counting removes rests on the 128-bit hash, within one gram.

Defined cases: a null text has no bytes; texts shorter than ``span`` lose nothing. Rows are told apart by id and a hash
of the text, so repeated rows, null ids and different texts under one id are each judged as texts of their own, and
no list is gathered for more than one text. Cuts may split a UTF-8 character; ``removed`` then drops its rest in the text
(``errors="ignore"``), never in the digest. Other columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakerec.llm import text as T
from lakerec.session import stored

SPAN = 400
GRAM = 128
BUCKET = 500
ROUNDS = 6
AT_ONCE = 3
PIECE = 1 << 18  # bytes whose anchors are found at once; a dozen arrays of eight times that are held then
PLACE_BITS = 21
SORT_SUFFIXES = 100_000  # suffixes sorted at once in a task

_FACTOR = 0x9E3779B97F4A7C15


def _factors(n: int, factor: int) -> np.ndarray:
    powers = np.full(n, factor, dtype=np.uint64)
    powers[:1] = 1
    return np.cumprod(powers, dtype=np.uint64)


_BYTE = T.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_FACTOR))


def gram_hashes(data: np.ndarray, gram: int, round_: int = 0) -> np.ndarray:
    """A cheap hash of each ``gram`` bytes, or words given by their hashes; it only chooses anchors, so a collision costs
    time and nothing else."""
    values = _BYTE[data] if data.dtype == np.uint8 else data
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values * _factors(len(data), _FACTOR), out=sums[1:])
    down = _factors(len(data) - gram + 1, pow(_FACTOR, -1, 1 << 64))
    return T.mix((sums[gram:] - sums[:-gram]) * down + np.uint64(round_ * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))


def _least_places(keys: np.ndarray, width: int) -> np.ndarray:
    """The least key of each run of ``width`` keys."""
    count = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(keys)] = keys
    rows = padded.reshape(-1, width)
    upto = np.minimum.accumulate(rows, axis=1).ravel()
    onward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(onward[:count], upto[width - 1 : width - 1 + count])


def stretches(data: np.ndarray, bounds: np.ndarray, span: int = SPAN, gram: int = GRAM, round_: int = 0) -> tuple[np.ndarray, ...]:
    """(text, first start, last start, anchor, gram hash) of every anchor; places are from the text's start."""
    found = []
    for begin in range(0, max(len(data) - span + 1, 0), PIECE):
        piece = data[begin : begin + PIECE + span - 1]
        grams = gram_hashes(piece, gram, round_)
        mask = np.uint64((1 << PLACE_BITS) - 1)
        keys = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
        anchors = (_least_places(keys, span - gram + 1) & mask).astype(np.int64)
        starts = np.arange(len(anchors))
        owner = np.searchsorted(bounds, starts + begin, "right") - 1
        whole = np.flatnonzero(starts + begin + span <= bounds[owner + 1])
        if not len(whole):
            continue
        owner, anchors = owner[whole], anchors[whole]
        new = np.ones(len(whole), dtype=bool)
        new[1:] = (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        low, high = whole[at], whole[np.append(at[1:], len(whole)) - 1]
        owner, anchors = owner[at], anchors[at]
        shift = begin - bounds[owner]
        found.append((owner, low + shift, high + shift, anchors + shift, grams[anchors]))
    if not found:
        return tuple(np.zeros(0, dtype=t) for t in (np.int64,) * 4 + (np.uint64,))
    return tuple(np.concatenate(parts) for parts in zip(*found))


def kinds_of(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(spans, 2) halves of a 128-bit hash of each span's bytes and the offset of its anchor."""
    body = memoryview(np.ascontiguousarray(data))
    digests = [
        xxhash.xxh3_128_digest(body[a:b], seed=o) for a, b, o in zip(begins.tolist(), ends.tolist(), offsets.tolist())
    ]
    return np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)


_ANCHORS = "doc_id bigint, mark bigint, low int, high int, anchor int, gram bigint, kind bigint, check bigint"


def _anchors(span: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``(key, mark, text)``."""
        for batch in batches:
            for low, high, data, bounds in T.slices(batch.column(2), PIECE):
                owner, first, last, anchor, grams = stretches(data, bounds, span, gram)
                kinds = kinds_of(data, bounds[owner] + first, bounds[owner] + last + span, anchor - first)
                rows = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(low, high - low).take(rows) for i in (0, 1)]
                    + [pa.array(c.astype(np.int32)) for c in (first, last, anchor)]
                    + [pa.array(grams.view(np.int64)), pa.array(kinds[:, 0]), pa.array(kinds[:, 1])],
                    names=[c.split()[0] for c in _ANCHORS.split(", ")],
                )

    return run


def common_extension(sums: np.ndarray, a: np.ndarray, b: np.ndarray, most: int = SPAN) -> np.ndarray:
    """Bytes that the suffixes at ``a`` and ``b`` have in common, up to ``most``, by binary search on prefix hashes."""
    a, b = np.minimum(a, b), np.maximum(a, b)
    apart, sum_a, sum_b = T.powers(len(sums))[b - a], sums[a], sums[b]
    low, high = np.zeros(len(a), dtype=np.int64), np.full(len(a), most, dtype=np.int64)
    for _ in range(int(most).bit_length()):
        middle = (low + high + 1) >> 1
        same = T.mul_mod(T.sub_mod(sums[a + middle], sum_a), apart) == T.sub_mod(sums[b + middle], sum_b)
        low = np.where(same, middle, low)
        high = np.where(same, high, middle - 1)
    return low


def _less(data: np.ndarray, sums: np.ndarray, a: np.ndarray, b: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether suffix ``a`` sorts before ``b``, and whether their first ``span`` bytes are equal."""
    shared = common_extension(sums, a, b, span)
    equal = shared == span
    step = np.where(equal, 0, shared)
    return ~equal & (data[a + step] < data[b + step]), equal


def merge_sort(data: np.ndarray, sums: np.ndarray, suffixes: np.ndarray, group: np.ndarray, span: int = SPAN) -> np.ndarray:
    """``suffixes`` with those of each group (a run of equal, rising ``group`` values) in order."""
    order = suffixes.copy()
    _, first, sizes = np.unique(group, return_index=True, return_counts=True)
    base, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
    local = np.arange(len(order)) - base
    width = 1
    while width < (sizes.max() if len(sizes) else 0):
        moving = np.flatnonzero(size > width)
        place, length, start = local[moving], size[moving], base[moving]
        run = place // (2 * width) * (2 * width)
        in_left = place - run < width
        other = np.where(in_left, run + width, run)  # where the other run of the pair begins
        low = np.zeros(len(moving), dtype=np.int64)
        high = np.clip(np.where(in_left, np.minimum(length, run + 2 * width), run + width) - other, 0, width)
        for _ in range(int(width).bit_length()):
            live = np.flatnonzero(low < high)
            if not len(live):
                break
            middle = (low[live] + high[live]) >> 1
            mine = order[moving[live]]
            theirs = order[start[live] + other[live] + middle]
            less, equal = _less(data, sums, theirs, mine, span)
            ahead = less | (equal & ~in_left[live])  # equal suffixes of the left run come first
            low[live] = np.where(ahead, middle + 1, low[live])
            high[live] = np.where(ahead, high[live], middle)
        target = start + run + (place - run - np.where(in_left, 0, width)) + low
        moved = order[moving]
        order[target] = moved
        width *= 2
    return order


def _bytes_equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, span: int) -> bool:
    """Whether the ``span`` bytes at every ``a`` equal those at its ``b``; overlapping pairs are compared once."""
    order = np.lexsort((a, b - a))
    a, gap = a[order], (b - a)[order]
    length = np.full(len(a), span, dtype=np.int64)
    follows = (gap[1:] == gap[:-1]) & (a[1:] - a[:-1] < span)
    begin = a.copy()
    begin[1:][follows] = a[:-1][follows] + span
    length[1:][follows] = (a[1:] - a[:-1])[follows]
    for at in range(0, len(a), 20_000):
        part = slice(at, at + 20_000)
        ends = np.cumsum(length[part])
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin[part] - ends + length[part], length[part])
        if not np.array_equal(data[place], data[place + np.repeat(gap[part], length[part])]):
            return False
    return True


def repeated_suffixes(data: np.ndarray, suffixes: np.ndarray, group: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Which ``suffixes`` share their first ``span`` bytes with another of their group (rising group values)."""
    result = np.zeros(len(suffixes), dtype=bool)
    if len(suffixes) < 2:
        return result
    sums = T.prefix_sums(data)
    order = merge_sort(data, sums, suffixes, group, span)
    near = np.flatnonzero(group[1:] == group[:-1])
    equal = common_extension(sums, order[near], order[near + 1], span) == span
    a, b = order[near[equal]], order[near[equal] + 1]
    if _bytes_equal(data, a, b, span):
        return np.isin(suffixes, np.concatenate([a, b]))
    seen: dict = {}  # a hash has lied
    for i, key in enumerate(zip(group.tolist(), (data[s : s + span].tobytes() for s in suffixes.tolist()))):
        if key in seen:
            result[[i, seen[key]]] = True
        seen.setdefault(key, i)
    return result


_SPANS = "doc_id bigint, mark bigint, low int, high int"


def _sort_buckets(span: int):
    def solve(rows: list[tuple]) -> pa.RecordBatch:
        unique = {(r[0], r[3], r[4]): r for r in rows}  # repeated rows of a document gave the same stretch
        rows = list(unique.values())
        data = np.frombuffer(b"".join(r[9] for r in rows), dtype=np.uint8)
        sizes = np.array([r[7] - r[6] + 1 for r in rows])
        base = np.cumsum([0] + [len(r[9]) for r in rows])[:-1]
        anchor = np.array([r[8] - r[6] for r in rows])
        numbers: dict = {}
        bucket = np.array([numbers.setdefault(r[0], len(numbers)) for r in rows])
        row = np.repeat(np.arange(len(rows)), sizes)
        step = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        group = bucket[row] * span + (anchor[row] - step)
        by_group = np.argsort(group, kind="stable")
        suffixes = base[row] + step
        repeated = np.zeros(len(row), dtype=bool)
        repeated[by_group] = repeated_suffixes(data, suffixes[by_group], group[by_group], span)
        repeated &= ~np.array([r[5] > 1 for r in rows])[row]  # these are known
        hits = np.flatnonzero(repeated)
        breaks = np.flatnonzero((np.diff(hits) != 1) | (np.diff(row[hits]) != 0))
        first, last = (hits[np.append(0, breaks + 1)], hits[np.append(breaks, len(hits) - 1)]) if len(hits) else (hits, hits)
        own, low = row[first], np.array([r[6] for r in rows])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[1] for r in rows], pa.int64()).take(pa.array(own)),
                pa.array([r[2] for r in rows], pa.int64()).take(pa.array(own)),
                pa.array((low[own] + step[first]).astype(np.int32)),
                pa.array((low[own] + step[last] + span).astype(np.int32)),
            ],
            names=["doc_id", "mark", "low", "high"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``_STRETCHES`` sorted by bucket: spans ``[low, high)`` of the texts."""
        rows: list[tuple] = []
        held, last = 0, None
        for batch in batches:
            for values in zip(*(column.to_pylist() for column in batch.columns)):
                if held >= SORT_SUFFIXES and values[0] != last:
                    yield solve(rows)
                    rows, held = [], 0
                last = values[0]
                rows.append(values)
                held += values[7] - values[6] + 1
        if rows:
            yield solve(rows)

    return run


# The anchor is the first one: suffixes of one bucket are compared where their offsets to it are equal.
_STRETCHES = (
    "bucket bigint, doc_id bigint, mark bigint, kind bigint, check bigint, copies bigint, low int, high int, anchor int, "
    "stretch binary"
)
_NAMES = [c.split()[0] for c in _STRETCHES.split(", ")]
_KINDS = [*[pa.int64()] * 6, *[pa.int32()] * 3, pa.binary()]


def _cut_stretches(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``(key, mark, text, wanted)``: the bytes of each wanted stretch."""
        for batch in batches:
            rows = []
            ids, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            bodies, bounds = T.as_bytes(batch.column(2))
            for i, wanted in enumerate(batch.column(3).to_pylist()):
                for w in wanted or ():
                    stretch = bodies[int(bounds[i]) + w["low"] : int(bounds[i]) + w["high"] + span].tobytes()
                    row = (w["bucket"], ids[i], marks[i], w["kind"], w["check"], w["copies"], w["low"], w["high"], w["anchor"], stretch)
                    rows.append((*row, w["hot"]))
            if rows:
                kinds = [*_KINDS, pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[*_NAMES, "hot"])

    return run


def parts(data: np.ndarray, bounds: np.ndarray, span: int, gram: int, rounds: range) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """(text, first start, last start, gram hash by round) of the runs of starts that have one anchor in each of ``rounds``."""
    found = [stretches(data, bounds, span, gram, round_) for round_ in rounds]
    places = [bounds[owner] + first for owner, first, *_ in found]
    place = np.unique(np.concatenate(places))
    rows = [np.searchsorted(p, place, "right") - 1 for p in places]
    owner = found[0][0][rows[0]]
    last = reduce(np.minimum, [f[2][at] for f, at in zip(found, rows)])
    return owner, place - bounds[owner], last, [f[4][at] for f, at in zip(found, rows)]


def _split(span: int, gram: int, rounds: range):
    """``_STRETCHES`` rows: their parts by the anchors of further rounds. Before the first round they are sorted by bucket and kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(_NAMES)}
            keys = list(zip(*(columns[c].to_pylist() for c in ("bucket", "kind", "check"))))
            new = [k != before for k, before in zip(keys, [last, *keys[:-1]])]  # repeated rows gave it twice
            last = keys[-1] if keys else last
            batch = batch.filter(pa.array(new, pa.bool_()))
            for begin, end, data, bounds in T.slices(batch.column(9), PIECE):
                owner, first, high, grams = parts(data, bounds, span, gram, rounds)
                old = {name: batch.column(i).slice(begin, end - begin) for i, name in enumerate(_NAMES)}
                low = old["low"].to_numpy()[owner]
                anchor = old["anchor"].to_numpy()[owner]
                begins, ends = bounds[owner] + first, bounds[owner] + high + span
                kinds = kinds_of(data, begins, ends, anchor - low - first + span)
                bucket = reduce(lambda b, g: T.mix(T.mix(b) + g), grams, old["bucket"].to_numpy()[owner].view(np.uint64)).view(np.int64)
                rows = pa.array(owner)
                stretch = [data[a:b].tobytes() for a, b in zip(begins.tolist(), ends.tolist())]
                values = [pa.array(bucket), old["doc_id"].take(rows), old["mark"].take(rows), pa.array(kinds[:, 0]), pa.array(kinds[:, 1])]
                values += [old["copies"].take(rows), pa.array((low + first).astype(np.int32)), pa.array((low + high).astype(np.int32))]
                values += [old["anchor"].take(rows), pa.array(stretch, pa.binary())]
                yield pa.RecordBatch.from_arrays(values, names=_NAMES)

    return run


def _strings(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``_STRETCHES`` rows: ``(bucket, kind, check, copies, doc_id, mark, low, high)`` of each string in them."""
        for batch in batches:
            for begin, end, data, bounds in T.slices(batch.column(9), PIECE):
                old = {name: batch.column(i).slice(begin, end - begin) for i, name in enumerate(_NAMES)}
                low, high, anchor = (old[c].to_numpy() for c in ("low", "high", "anchor"))
                sizes = high - low + 1
                owner = np.repeat(np.arange(len(sizes)), sizes)
                step = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                begins = bounds[owner] + step
                kinds = kinds_of(data, begins, begins + span, anchor[owner] - low[owner] - step + span)
                rows = pa.array(owner)
                start = (low[owner] + step).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [old["bucket"].take(rows), pa.array(kinds[:, 0]), pa.array(kinds[:, 1]), old["copies"].take(rows)]
                    + [old["doc_id"].take(rows), old["mark"].take(rows), pa.array(start), pa.array(start + np.int32(span))],
                    names=["bucket", "kind", "check", "copies", "doc_id", "mark", "low", "high"],
                )

    return run


def _same_text(left_id: str, left_mark: str) -> Column:
    return F.col("key").eqNullSafe(F.col(left_id)) & (F.col("mark") == F.col(left_mark))


def _first_spans(source: DataFrame, span: int, gram: int) -> DataFrame:
    """``(id, text_mark, wanted, spans)`` of each text with a shared anchor: stretches to sort, and spans that counting decides."""
    anchors = stored(source.select("key", "mark", "text").mapInArrow(_anchors(span, gram), _ANCHORS), "anchors")
    least = [F.min("kind").alias("k0"), F.max("kind").alias("k1"), F.min("check").alias("c0"), F.max("check").alias("c1")]
    grams = anchors.groupBy("gram").agg(F.count("*").alias("n"), *least)
    # Stored, so that the join can be split where a gram is hot.
    shared = stored(grams.where("n > 1").select("gram", F.expr("k0 <> k1 or c0 <> c1").alias("mixed")), "shared-grams")
    met = stored(anchors.join(shared, "gram"), "shared-anchors")
    place = F.struct("low", (F.col("high") + span).alias("high"))
    whole = met.where("not mixed").select("doc_id", "mark", place.alias("span"))
    one = F.min(F.struct("doc_id", "mark", "low", "high", "anchor")).alias("one")
    kinds = stored(met.where("mixed").groupBy("gram", "kind", "check").agg(F.count("*").alias("copies"), one), "kinds")
    often = met.where("mixed").join(kinds.where("copies > 1").select("gram", "kind", "check"), ["gram", "kind", "check"])
    hot = stored(kinds.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET).select("gram", F.lit(True).alias("hot")), "hot")
    parts = kinds.join(hot, "gram", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    wanted = F.struct(F.col("gram").alias("bucket"), "hot", "kind", "check", "copies", "one.low", "one.high", "one.anchor")
    rows = whole.union(often.select("doc_id", "mark", place))
    rows = rows.withColumn("wanted", F.lit(None).cast(parts.select(wanted).schema[0].dataType))
    rows = rows.union(parts.select("one.doc_id", "one.mark", F.lit(None).cast(rows.schema["span"].dataType), wanted))
    # Lists of one text's own stretches; collect_list leaves nulls out.
    return rows.groupBy(F.col("doc_id").alias("id"), F.col("mark").alias("text_mark")).agg(
        F.collect_list("wanted").alias("wanted"), F.collect_set("span").alias("spans")
    )


def _split_hot(rows: DataFrame, span: int, gram: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Spans that counting decides, and ``_STRETCHES`` whose buckets are small enough to sort, of hot ``_STRETCHES``."""
    spans, ready = [], []
    by = ["bucket", "kind", "check"]
    place = ["doc_id", "mark", "low"]
    for round_ in range(1, ROUNDS + 1, AT_ONCE):
        if rows.isEmpty():
            return spans, ready
        if round_ == 1:  # later ones come once and stand apart already
            rows = rows.repartition(*by).sortWithinPartitions(*by)
        rounds = range(round_, min(round_ + AT_ONCE, ROUNDS + 1))
        split = stored(rows.mapInArrow(_split(span, gram, rounds), _STRETCHES), "split")
        counts = split.groupBy(*by).agg(F.sum("copies").alias("total"), F.min(F.struct(*place)).alias("one"))
        counts = stored(counts, "part-kinds")
        sizes = stored(counts.groupBy("bucket").agg(F.count("*").alias("kinds")).where("kinds > 1"), "part-buckets")
        known = counts.where("total > 1").select(*by)
        # Parts of stretches that were repeated as a whole are known already.
        spans.append(split.where("copies = 1").join(known, by).select(*place, (F.col("high") + span).alias("high")))
        ids = [F.col("doc_id").eqNullSafe(F.col("one.doc_id")), *[F.col(c) == F.col(f"one.{c}") for c in place[1:]]]
        heads = split.join(counts.join(sizes, "bucket"), by).where(ids[0] & ids[1] & ids[2]).withColumn("copies", F.col("total"))
        heads = stored(heads.select(*_NAMES, "kinds"), "part-heads")
        ready.append(heads.where(F.col("kinds") <= BUCKET).select(*_NAMES))
        rows = heads.where(F.col("kinds") > BUCKET).select(*_NAMES)
    schema = "bucket bigint, kind bigint, check bigint, copies bigint, doc_id bigint, mark bigint, low int, high int"
    strings = stored(rows.repartition("bucket", "kind").mapInArrow(_strings(span), schema), "strings")
    known = strings.groupBy(*by).agg(F.sum("copies").alias("total")).where("total > 1").select(*by)
    spans.append(strings.where("copies = 1").join(known, by).select(*place, "high"))
    return spans, ready


def _later_spans(touched: DataFrame, span: int, gram: int) -> DataFrame:
    """``(doc_id, mark, low, high)`` found by sorting the wanted stretches of stored ``touched`` texts."""
    wanted = touched.where("size(wanted) > 0").select("key", "mark", "text", "wanted")
    cut = stored(wanted.mapInArrow(_cut_stretches(span), f"{_STRETCHES}, hot boolean"), "stretches")
    spans, ready = _split_hot(cut.where("hot").select(*_NAMES), span, gram)
    ready.append(cut.where("not hot").select(*_NAMES))
    rows = reduce(DataFrame.union, ready).repartition("bucket").sortWithinPartitions("bucket")
    spans.append(stored(rows.mapInArrow(_sort_buckets(span), _SPANS), "sorted"))
    return reduce(DataFrame.union, spans)


_FIELDS = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string"
NEW = [c.split()[0] for c in _FIELDS.split(", ")]


def _cut_out(body: bytes, spans: list[tuple[int, int]], texts: bool) -> tuple:
    """The fields of a text without ``spans``; the rest itself only if ``texts``."""
    kept, at, gone, runs, last = [], 0, 0, 0, -1
    for begin, end in sorted(spans):
        if begin > last:
            kept.append(body[at:begin])
            runs += 1
            gone += end - begin
        elif end > last:
            gone += end - last
        last = max(last, end)
        at = last
    kept.append(body[at:])
    rest = b"".join(kept)
    text = rest.decode("utf-8", "ignore") if texts else None
    return len(body), gone, runs, hashlib.sha256(rest).hexdigest(), text


def _columns(rows: list[tuple]) -> list[pa.Array]:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]


def _own(spans: list[dict] | None) -> list[tuple[int, int]]:
    return [(s["low"], s["high"]) for s in spans or ()]


def _sort_out(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    """Rows ``(key, row, mark, text, wanted, spans)``: done with if no stretch of the text is to be sorted."""
    for batch in batches:
        for low, high, data, bounds in T.slices(batch.column(3), PIECE):
            old = [batch.column(i).slice(low, high - low) for i in range(6)]
            rows = []
            for i, (asked, spans) in enumerate(zip(old[4].to_pylist(), old[5].to_pylist())):
                body = data[bounds[i] : bounds[i + 1]].tobytes()
                rows.append((None,) * 5 if asked else _cut_out(body, _own(spans), texts))
            still = pa.array([low + i if r[0] is None else None for i, r in enumerate(rows)], pa.int64())
            old[3] = batch.column(3).take(still)  # null where the text is done with
            yield pa.RecordBatch.from_arrays(
                old + _columns(rows), names=["key", "row", "mark", "text", "wanted", "spans", *NEW]
            )


def _finish(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    """Rows ``(row, text, spans, more)`` of texts whose stretches have been sorted."""
    for batch in batches:
        bodies, bounds = T.as_bytes(batch.column(1))
        rows = []
        for i, (spans, more) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
            rows.append(_cut_out(bodies[bounds[i] : bounds[i + 1]].tobytes(), _own(spans) + _own(more), texts))
        if rows:
            yield pa.RecordBatch.from_arrays([batch.column(0), *_columns(rows)], names=["row", *NEW])


def removed(docs: DataFrame, texts: bool = True, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``docs`` with ``NEW`` in the place of the text; every row of ``docs`` is kept. ``kept_text`` is null without ``texts``.

    Strings of ``span`` bytes are judged; ``gram`` is to be less than half of that. All texts are shuffled once, to meet
    what is known of them; only those with stretches to sort are kept and shuffled again.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    key = F.col("doc_id").cast("bigint").alias("key")
    source = docs.select(key, row.alias("row"), F.xxhash64("text").alias("mark"), "text")
    first = _first_spans(source, span, gram)
    joined = source.join(first, _same_text("id", "text_mark"), "left").select("key", "row", "mark", "text", "wanted", "spans")
    kinds = {f.name: f.dataType.simpleString() for f in joined.schema}
    held = f"key bigint, row {kinds['row']}, mark bigint, text string, wanted {kinds['wanted']}, spans {kinds['spans']}, {_FIELDS}"
    rows = stored(joined.mapInArrow(lambda batches: _sort_out(batches, texts), held), "texts")
    open_rows = rows.where("n_bytes is null")
    more = _later_spans(open_rows, span, gram).distinct().groupBy(F.col("doc_id").alias("id"), F.col("mark").alias("text_mark"))
    more = more.agg(F.collect_list(F.struct("low", "high")).alias("more"))
    last = open_rows.select("key", "row", "mark", "text", "spans").join(more, _same_text("id", "text_mark"), "left")
    last = last.select("row", "text", "spans", "more").mapInArrow(
        lambda batches: _finish(batches, texts), f"row {kinds['row']}, {_FIELDS}"
    )
    out = rows.where("n_bytes is not null").select("row", *NEW).union(last)
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != "text" and c not in NEW], *NEW)
