"""Exact Jaccard join of shingle sets with prefix trees, and the classes of documents that it links.

Two documents link when ``100 * intersection >= 80 * union`` over their distinct 5-word shingles (64-bit hashes).

1. *Collapse.* Documents of equal sets share a 128-bit digest; from here on a set stands for all its copies.
2. *Candidates.* Of each set of n shingles, ordered by hash, the first ``n - ceil(0.8 n) + l`` are probes, with
   ``l = max(1, n // 20)``. Linked sets share at least the l of the smaller among their probes, so a set that shares
   fewer has no link. Probes that several sets of one slice of texts hold are counted there, and only two of the sets
   announce them to the others, so a probe that every document holds costs two rows per slice.
3. *Global order.* Only candidate sets are shipped whole; other texts are left out before the shuffle (``narrow``). Their shingles are counted: blocks of sets send each distinct
   shingle once, packed, to the task of its hash range, and get back those that several sets hold. Each set is ordered
   by count, the rarest first, then hash. Its first ``n - ceil(0.8 n) + 1`` are its prefix; linked sets share one.
   A set with that many shingles of its own is linked with nothing, and most others share passages only far down.
   Sets that share a shingle of their prefixes are joined to the least set holding it; the components of these star
   edges are clusters, and every link lies inside one.
4. *Prefix trees.* A block of sets, a cluster, is one task's group. Its sets are stored as a tree of their ordered
   shingles (frequent ones first, so paths are shared), walked once for all sets: partial overlaps are kept for a path
   and shared by all below it, and a subtree is left out for every set that can no longer reach the threshold with the
   shingles that remain, or that is already in the same class as all of the subtree.
5. *Large clusters.* A cluster above ``BLOCK_SETS`` or ``BLOCK_SHINGLES`` is dealt out in salted blocks, the classes
   found are contracted, and their least members are joined again. What is left are shingles whose holders are in
   different classes still: the holders of each form a block (all pairs of its parts, when it is too large for one).
   No pair is skipped other than pairs inside one class.

Classes come from ``components`` over the links found. Links inside a class need not all be listed.

Defined cases: a null, empty or blank text has an empty set and is linked with nothing. A text of fewer than five
words has its whole sequence as one shingle. Repeated rows each get a row of the result. Null ids are ignored when the
least id of a class is taken. Other columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerec.llm import text as T
from lakerec.llm.components import components
from lakerec.llm.narrow import meeting
from lakerec.session import stored

WIDTH = 5
BLOCK_SETS = 2_000
BLOCK_SHINGLES = 1_000_000
COUNT_BLOCK = 4 << 20  # bytes of sets that count their shingles together
COUNT_RANGE = 2_000_000  # shingles that one task counts, about


def least_overlap(n: int) -> int:
    """Shingles that a set of ``n`` shares with any set it links with, at least."""
    return -(-4 * n // 5)


def spare(n: int) -> int:
    return max(1, n // 20)


DIGEST_SALTS = (0x5BD1E9955BD1E995, 0xA5A5F0F0C3C33C3C)


def digest(values: np.ndarray) -> bytes:
    """A 128-bit digest of a set of 64-bit values."""
    sums = [int(T.mix(values ^ np.uint64(salt)).sum(dtype=np.uint64)) for salt in DIGEST_SALTS]
    return b"".join(s.to_bytes(8, "big") for s in sums)


def _mark(cls: bytes) -> int:
    return int.from_bytes(cls[:8], "big", signed=True)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, bounds in T.slices(batch.column(1)):
            sets = T.shingles(data, bounds, WIDTH)
            digests = [digest(s) if len(s) else None for s in sets]
            more = range(2, batch.num_columns)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, high - low),
                    pa.array(digests, pa.binary()),
                    pa.array([d and _mark(d) for d in digests], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                ]
                + [batch.column(i).slice(low, high - low) for i in more],
                names=["doc_id", "cls", "mark", "n_shingles"] + [batch.schema.names[i] for i in more],
            )


def signatures(docs: DataFrame, *key: str) -> DataFrame:
    """``(doc_id, cls, mark, n_shingles)`` per row of ``docs (doc_id, text)``; ``cls`` is null for an empty set.

    ``mark`` is half of the digest and only serves to count. The columns ``key`` follow.
    """
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *key)
    kinds = "".join(f", {c} {source.schema[c].dataType.simpleString()}" for c in key)
    return source.mapInArrow(_signatures, f"doc_id bigint, cls binary, mark bigint, n_shingles bigint{kinds}")


def _announce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(h, mark, counted)``: ``counted`` 1 asks whether other sets hold probe h, 0 only tells others of it; with h null
    it is a number of probes that this slice has found shared already."""
    for batch in batches:
        for _, _, data, bounds in T.slices(batch.column(0)):
            sets = {digest(s): s for s in T.shingles(data, bounds, WIDTH) if len(s)}
            if not sets:
                continue
            probes = [s[: len(s) - least_overlap(len(s)) + spare(len(s))] for s in sets.values()]
            marks = np.array([_mark(d) for d in sets], dtype=np.int64)
            owner = np.repeat(np.arange(len(probes)), [len(p) for p in probes])
            values, first, inverse, count = np.unique(
                np.concatenate(probes), return_index=True, return_inverse=True, return_counts=True
            )
            own = np.bincount(owner[count[inverse] > 1], minlength=len(probes))
            last = np.zeros(len(values), dtype=np.int64)
            last[inverse] = np.arange(len(inverse))
            single = count == 1
            h = np.concatenate([values[single], values[~single], values[~single]]).view(np.int64)
            told = np.concatenate([owner[first[single]], owner[first[~single]], owner[last[~single]]])
            counted = np.concatenate([np.ones(single.sum()), np.zeros(2 * (~single).sum())]).astype(np.int32)
            found = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(h), pa.nulls(len(found), pa.int64())]),
                    pa.array(np.concatenate([marks[told], marks[found]])),
                    pa.array(np.concatenate([counted, own[found].astype(np.int32)])),
                ],
                names=["h", "mark", "counted"],
            )


def _count_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_announce`` sorted by probe: ``(mark, n)`` for the probes that two different sets hold."""
    held: np.ndarray | None = None  # the rows of a probe that the next batch may go on with
    shared_before: tuple[int, int] | None = None  # a probe known to be shared, when its rows go on

    def count(h: np.ndarray, mark: np.ndarray, counted: np.ndarray) -> pa.RecordBatch:
        new = np.ones(len(h), dtype=bool)
        new[1:] = h[1:] != h[:-1]
        run = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        differs = np.zeros(len(first), dtype=bool)
        differs[run[mark != mark[first][run]]] = True
        if shared_before is not None and h[0] == shared_before[0]:
            differs[0] = True
        hit = mark[differs[run] & (counted == 1)]
        marks, n = np.unique(hit, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(marks), pa.array(n)], names=["mark", "n"])

    for batch in batches:
        told = np.array([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]], dtype=np.int64)
        known = batch.column(0).is_null().to_numpy(zero_copy_only=False)
        if known.any():
            yield pa.RecordBatch.from_arrays([pa.array(told[0, known]), pa.array(told[1, known])], names=["mark", "n"])
        h = batch.column(0).drop_null().to_numpy()
        rows = np.vstack([h, told[:, ~known]])
        rows = rows if held is None else np.hstack([held, rows])
        if not rows.shape[1]:
            continue
        # Hold the last probe back; of a long run one row of each of two sets is enough to go on with.
        cut = int(np.searchsorted(rows[0], rows[0, -1]))
        if cut:
            yield count(*rows[:, :cut])
            shared_before = None
        held = rows[:, cut:]
        if held.shape[1] > 100_000 and (held[1] != held[1, 0]).any():
            yield count(*held)
            shared_before = (int(held[0, 0]), int(held[1, 0]))
            held = held[:, -1:].copy()
            held[2] = 0
    if held is not None and held.shape[1]:
        yield count(*held)


def candidates(docs: DataFrame, signed: DataFrame, *key: str) -> DataFrame:
    """``(cls, doc_id, *key)`` of the candidate sets of ``docs (text)``, with one document of each."""
    rows = docs.select("text").mapInArrow(_announce, "h bigint, mark bigint, counted int")
    rows = rows.repartition("h", F.when(F.col("h").isNull(), F.col("mark"))).sortWithinPartitions("h", "mark")
    counted = rows.mapInArrow(_count_shared, "mark bigint, n bigint").groupBy("mark").agg(F.sum("n").alias("shared"))
    # The least number of spare probes of any partner, which has 4/5 of the shingles or more. A set met in several
    # slices counts its probes several times, which keeps it in.
    enough = F.greatest(F.lit(1), F.expr("((4 * n_shingles + 4) div 5) div 20"))
    one = signed.where("cls is not null").groupBy("cls", "mark", "n_shingles")
    if key:
        one = one.agg(F.min(F.struct("doc_id", *key)).alias("one")).select("mark", "cls", "n_shingles", "one.*")
    else:
        one = one.agg(F.min("doc_id").alias("doc_id"))
    return one.join(counted, "mark").where(F.col("shared") >= enough).select("cls", "doc_id", *key)


_SETS = "id bigint, block bigint, cls binary, n bigint, shingles binary"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number, block, size = TaskContext.get().partitionId(), 0, 0, 0
    for batch in batches:
        for low, high, data, bounds in T.slices(batch.column(1)):
            wanted = batch.column(0).slice(low, high - low).to_pylist()
            rows = []
            for cls, values in zip(wanted, T.shingles(data, bounds, WIDTH)):
                if not len(values) or digest(values) != cls:
                    continue  # another text with the same id
                if size > COUNT_BLOCK:
                    block, size = block + 1, 0
                rows.append((part << 33 | number, part << 33 | block, cls, len(values), values.tobytes()))
                number, size = number + 1, size + 8 * len(values)
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[c.split()[0] for c in _SETS.split(", ")]
                )


def whole_sets(docs: DataFrame, chosen: DataFrame, *key: str) -> DataFrame:
    """``_SETS`` of the stored candidates, to be stored. Repeated rows of a document give its set more than once."""
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *key)
    source = meeting(source, [F.col(c) for c in ("doc_id", *key)], chosen, [F.col(c) for c in ("doc_id", *key)])
    named = chosen.select("cls", F.col("doc_id").alias("id"), *[F.col(c).alias(f"own_{c}") for c in key])
    same = F.col("id").eqNullSafe(F.col("doc_id"))
    for c in key:
        same = same & (F.col(f"own_{c}") == F.col(c))
    matched = named.join(source, same)
    return matched.select("cls", "text").mapInArrow(_sets, _SETS)


def _pack_by_range(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``(block, shingles)``: a block's distinct shingles and how many of its sets hold each, by hash range."""

        def packed(block: int, parts: list[bytes]) -> pa.RecordBatch:
            values, counts = np.unique(np.frombuffer(b"".join(parts), dtype=np.uint64), return_counts=True)
            place = (values >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
            cuts = np.searchsorted(place, np.arange(ranges + 1))
            full = np.flatnonzero(np.diff(cuts))
            counts = counts.astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(full.astype(np.int32)),
                    pa.array([block] * len(full), pa.int64()),
                    pa.array([values[cuts[i] : cuts[i + 1]].tobytes() for i in full], pa.binary()),
                    pa.array([counts[cuts[i] : cuts[i + 1]].tobytes() for i in full], pa.binary()),
                ],
                names=["range", "block", "shingles", "counts"],
            )

        current, parts = None, []
        for batch in batches:
            for block, shingles in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if block != current and parts:
                    yield packed(current, parts)
                    parts = []
                current = block
                parts.append(shingles)
        if parts:
            yield packed(current, parts)

    return run


def _count_range(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Of one hash range: to each block those of its shingles that two sets or more hold, with the number of sets."""
    blocks = table["block"].to_pylist()
    values = [np.frombuffer(v, dtype=np.uint64) for v in table["shingles"].to_pylist()]
    counts = np.concatenate([np.frombuffer(c, dtype=np.int32) for c in table["counts"].to_pylist()])
    distinct, inverse = np.unique(np.concatenate(values), return_inverse=True)
    total = np.bincount(inverse, weights=counts).astype(np.int64)[inverse]
    rows, at = [], 0
    for block, own in zip(blocks, values):
        held = total[at : at + len(own)]
        at += len(own)
        often = held > 1
        rows.append((block, own[often].tobytes(), np.minimum(held[often], 2**31 - 1).astype(np.int32).tobytes()))
    kinds = [pa.int64(), pa.binary(), pa.binary()]
    names = ["block", "common", "holders"]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


_ORDERED = "id bigint, cls binary, n bigint, shingles binary, prefix array<bigint>"


def _order_block(key: tuple[pa.Scalar, ...], sets: pa.Table, replies: pa.Table) -> pa.Table:
    common = np.frombuffer(b"".join(replies["common"].to_pylist()), dtype=np.uint64)
    holders = np.frombuffer(b"".join(replies["holders"].to_pylist()), dtype=np.int32)
    by_value = np.argsort(common)
    common, holders = common[by_value], holders[by_value]
    rows = []
    columns = [sets[c].to_pylist() for c in ("id", "cls", "n", "shingles")]
    for number, cls, n, shingles in zip(*columns):
        values = np.frombuffer(shingles, dtype=np.uint64)
        at = np.minimum(np.searchsorted(common, values), max(0, len(common) - 1))
        met = common[at] == values if len(common) else np.zeros(n, dtype=bool)
        own = n - int(met.sum())  # shingles of this set alone come first
        left = n - least_overlap(n) + 1 - own
        if left > 0 and own < n:
            shared = values[met]
            order = np.lexsort((shared, holders[at[met]]))
            rows.append((number, cls, n, shingles, shared[order[:left]].view(np.int64)))
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    names = [c.split()[0] for c in _ORDERED.split(", ")]
    columns = list(zip(*rows)) if rows else [[]] * 5
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def ordered_sets(sets: DataFrame) -> DataFrame:
    """``_ORDERED`` of those stored ``sets`` that share a shingle of their prefix with another, as far as they know."""
    total = sets.agg(F.sum("n")).first()[0] or 0
    ranges = max(1, -(-total // COUNT_RANGE))
    sent = sets.select("block", "shingles").mapInArrow(
        _pack_by_range(ranges), "range int, block bigint, shingles binary, counts binary"
    )
    replies = sent.groupBy("range").applyInArrow(_count_range, "block bigint, common binary, holders binary")
    return sets.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_order_block, _ORDERED)


class Classes:
    """Union-find over the places of a block; a class is known by its least place."""

    def __init__(self, start: np.ndarray):
        self.label = start.copy()

    def union(self, members: np.ndarray) -> None:
        labels = np.unique(self.label[members])
        if len(labels) > 1:
            self.label[np.isin(self.label, labels)] = labels[0]


def tree_join(sets: list[np.ndarray], start: np.ndarray | None = None) -> np.ndarray:
    """The class (its least place) of each set; ``start`` gives classes known before.

    ``sets`` hold 64-bit shingles, each shingle once. A set with no shingle links with nothing.
    """
    count = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    classes = Classes(np.arange(count) if start is None else start)
    if count < 2:
        return classes.label
    owner = np.repeat(np.arange(count), sizes)
    _, inverse, frequency = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(frequency), dtype=np.int64)
    rank[np.argsort(-frequency, kind="stable")] = np.arange(len(frequency))
    met = frequency[inverse] > 1  # a shingle of one set only can't add to an overlap
    token, owner = rank[inverse][met], owner[met]
    by_set = np.lexsort((token, owner))
    token, owner = token[by_set].astype(">u4"), owner[by_set]
    first = np.searchsorted(owner, np.arange(count + 1))
    by_token = np.argsort(token, kind="stable")
    holders = owner[by_token]
    holder_first = np.searchsorted(token[by_token], np.arange(int(token.max()) + 2 if len(token) else 1))
    paths = [token[first[i] : first[i + 1]] for i in range(count)]
    order = sorted(range(count), key=lambda i: paths[i].tobytes())
    order_array = np.array(order)
    lengths = np.array([len(paths[i]) for i in order])
    common = np.zeros(count, dtype=np.int64)  # shingles that a set shares with the one before it, from the root
    for k in range(1, count):
        a, b = paths[order[k - 1]], paths[order[k]]
        n = min(len(a), len(b))
        differs = np.flatnonzero(a[:n] != b[:n])
        common[k] = differs[0] if len(differs) else n
    met_sizes = np.diff(first)

    # A node is a run of the sorted sets with ``depth`` shingles in common, the overlap of every set with that path, and
    # the sets that can still link with one of the run.
    stack = [(0, count, 0, np.zeros(count, dtype=np.int64), np.arange(count))]
    while stack:
        low, high, depth, overlap, active = stack.pop()
        alone = high - low == 1
        end = int(lengths[low]) if alone else int(common[low + 1 : high].min())
        if end > depth:
            path = paths[order[low]][depth:end]
            overlap = overlap.copy()
            for t in path.tolist():
                overlap[holders[holder_first[t] : holder_first[t + 1]]] += 1
        below = order_array[low:high]
        left = int(lengths[low:high].max()) - end
        smallest = int(sizes[below].min())
        reach = overlap[active] + np.minimum(met_sizes[active] - overlap[active], left)
        active = active[9 * reach >= 4 * (sizes[active] + smallest)]
        labels = classes.label[below]
        if (labels == labels[0]).all():
            active = active[classes.label[active] != labels[0]]
        if not len(active):
            continue
        if alone:
            own = order[low]
            linked = active[(9 * overlap[active] >= 4 * (sizes[active] + sizes[own])) & (active != own)]
            if len(linked) and sizes[own]:
                classes.union(np.append(linked, own))
            continue
        cuts = [low, *(low + 1 + np.flatnonzero(common[low + 1 : high] == end)).tolist(), high]
        for a, b in zip(cuts[:-1], cuts[1:]):
            stack.append((a, b, end, overlap, active))
    return classes.label


def _join_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(block, id, known, shingles)`` sorted by block: links ``(a, b)`` from each set to its class."""

    def links(rows: list[tuple]) -> pa.RecordBatch:
        names = sorted({row[0] for row in rows})
        place = {name: i for i, name in enumerate(names)}
        data: list = [None] * len(names)
        known: list = [None] * len(names)
        for name, before, shingles in rows:
            data[place[name]] = np.frombuffer(shingles, dtype=np.uint64)
            known[place[name]] = before
        seen: dict = {}
        start = np.array([seen.setdefault(k, i) if k is not None else i for i, k in enumerate(known)])
        label = tree_join(data, start)
        new = [i for i in range(len(names)) if label[i] != start[i]]
        return pa.RecordBatch.from_arrays(
            [pa.array([names[i] for i in new], pa.int64()), pa.array([names[label[i]] for i in new], pa.int64())],
            names=["a", "b"],
        )

    block, rows = None, []
    for batch in batches:
        for key, *row in zip(*(column.to_pylist() for column in batch.columns)):
            if key != block and rows:
                yield links(rows)
                rows = []
            block = key
            rows.append(row)
    if rows:
        yield links(rows)


def join_blocks(blocks: DataFrame) -> DataFrame:
    """Links found in each block of ``(block, id, known, shingles)``."""
    rows = blocks.select("block", "id", "known", "shingles").repartition("block").sortWithinPartitions("block")
    return rows.mapInArrow(_join_blocks, "a bigint, b bigint")


def _with_class(sets: DataFrame, links: DataFrame) -> DataFrame:
    roots = components(links).select(F.col("node").alias("id"), F.col("root").alias("class"))
    return sets.join(roots, "id", "left").withColumn("class", F.coalesce("class", "id"))


def set_links(sets: DataFrame) -> DataFrame:
    """Links ``(a, b)`` of ids that connect every class of stored sets ``(id, n, shingles, prefix)``.

    Sets that link must share a value of their prefixes.
    """
    holding = sets.select("id", F.explode("prefix").alias("h"))
    least = holding.groupBy("h").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least <> most")
    met = stored(holding.join(least.select("h", "least"), "h"), "met")
    clusters = components(met.where("id <> least").select(F.col("id").alias("a"), F.col("least").alias("b")).distinct())
    placed = sets.select("id", "n").join(clusters.withColumnRenamed("node", "id"), "id")
    placed = stored(placed, "clusters")
    parts = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    totals = [F.count("*").alias("sets"), F.sum("n").alias("total")]
    sizes = stored(placed.groupBy("root").agg(*totals).select("root", parts.alias("parts")), "cluster-sizes")
    none = F.lit(None).cast("bigint")

    def salted(rows: DataFrame, salt: int) -> DataFrame:
        """Links of rows ``(id, root, parts)`` in blocks of their cluster."""
        part = F.pmod(F.xxhash64("id", F.lit(salt)), F.col("parts"))
        dealt = rows.select("id", F.concat_ws(":", "root", part).alias("block"), none.alias("known"))
        return join_blocks(sets.select("id", "shingles").join(dealt, "id"))

    links = stored(salted(placed.join(sizes, "root"), 0), "links")
    large = stored(placed.join(sizes.where("parts > 1").select("root"), "root", "left_semi"), "large")
    if large.isEmpty():
        return links
    # Contract: the least members of the classes found so far meet again.
    heads = _with_class(large, links).where("id = class").drop("class")
    counts = heads.groupBy("root").agg(*totals).select("root", parts.alias("parts"))
    links = stored(links.union(salted(heads.join(counts, "root"), 1)), "links")
    # What is left: shingles whose holders are in different classes.
    classed = _with_class(large, links)
    open_rows = stored(met.select("h", "id").join(classed.select("id", "class", "n"), "id"), "open")
    mixed = open_rows.groupBy("h").agg(F.min("class").alias("c0"), F.max("class").alias("c1"), *totals)
    mixed = mixed.where("c0 <> c1").select("h", parts.alias("parts"))
    ways = open_rows.join(mixed, "h").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    # Part i meets every part j in block (min, max); with one part that is one block.
    ways = ways.select("h", "id", "class", "part", F.explode(F.expr("sequence(0, parts - 1)")).alias("other"))
    ways = ways.select(
        F.concat_ws(":", "h", F.least("part", "other"), F.greatest("part", "other")).alias("block"),
        "id",
        F.col("class").alias("known"),
    )
    return stored(links.union(join_blocks(ways.join(sets.select("id", "shingles"), "id"))), "links")


def set_classes(sets: DataFrame) -> DataFrame:
    """``(cls, root)`` of the digests of stored sets ``(id, cls, n, shingles, prefix)`` that link with another."""
    roots = components(set_links(sets)).withColumnRenamed("node", "id")
    # A set that was there more than once has ids of one class.
    return sets.select("id", "cls").join(roots, "id").groupBy("cls").agg(F.min("root").alias("root"))


def grouped_rows(docs: DataFrame, *key: str) -> DataFrame:
    """``(doc_id, cls, n_shingles, *key, group)`` per row of ``docs (doc_id, text, *key)``; rows of one class share ``group``.

    Rows of one id and different texts must differ in ``key``, if there is one; then they are found by it as well.
    """
    signed = stored(signatures(docs, *key), "signatures")
    sets = stored(whole_sets(docs, stored(candidates(docs, signed, *key), "candidates"), *key), "sets")
    roots = set_classes(stored(ordered_sets(sets), "ordered"))
    rows = signed.select("doc_id", "cls", "n_shingles", *key).join(roots, "cls", "left")
    group = F.when(F.col("root").isNull(), F.col("cls"))
    return rows.withColumn("group", F.struct("root", group.alias("cls"))).drop("root")


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row of ``docs (doc_id, text)``."""
    rows = grouped_rows(docs)
    least = rows.where("cls is not null").groupBy("group").agg(F.min("doc_id").alias("least"))
    least = least.select(F.col("group.root").alias("r"), F.col("group.cls").alias("c"), "least")
    same = F.col("group.root").eqNullSafe(F.col("r")) & F.col("group.cls").eqNullSafe(F.col("c"))
    return rows.join(least, same & F.col("cls").isNotNull(), "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")
    )


def kept_rows(docs: DataFrame) -> DataFrame:
    """One row of each class of ``docs``, with all its columns; documents without words all stay.

    The row that stays is the least by id, null ids last, then by the text's digest, so rows of a shared or null id are
    told apart. Repeated rows of one document count as one.
    """
    marked = docs.withColumn("__mark", F.unhex(F.md5("text")))
    rows = grouped_rows(marked.select("doc_id", "text", "__mark"), "__mark").where("n_shingles > 0")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__mark")
    rows = stored(rows.select("group.root", "group.cls", "doc_id", "__mark", key.alias("key")), "classes")
    ends = rows.groupBy("root", "cls").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    first = ends.where("not (first <=> last)").select(F.col("root").alias("r"), F.col("cls").alias("c"), "first")
    one_class = F.col("root").eqNullSafe(F.col("r")) & F.col("cls").eqNullSafe(F.col("c"))
    gone = rows.join(first, one_class).where("not (key <=> first)")
    named = [F.col("doc_id").alias("__id"), F.col("__mark").alias("__text")]
    gone = gone.select(*named).distinct()
    twice = rows.groupBy("doc_id", "__mark").agg(F.count("*").alias("n")).where("n > 1")
    twice = stored(twice.select(*named), "repeated")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__mark") == F.col("__text"))
    kept = marked.join(gone, same, "left_anti")
    if twice.isEmpty():
        return kept.drop("__mark")
    once = kept.join(twice, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(twice, same, "left_anti").unionByName(once).drop("__mark")
