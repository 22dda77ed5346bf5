"""MinHash near-duplicates by a chosen-path set similarity join, and the classes of documents that it links.

Two documents link when ``100 * intersection >= 80 * union`` over their distinct 4-word shingles (64-bit hashes).

1. *Collapse.* Documents of equal sets share a 128-bit digest; from here on a set stands for all its copies. Each set
   has a sketch: the least values of its shingles under ``COORDINATES`` hash functions. Two sets of Jaccard similarity
   s agree in a coordinate with probability s.
2. *Trees.* Each of ``TREES`` independent trees starts with the coordinates of its own that it has drawn; a set goes to
   the child named by (coordinate, its least shingle there), ``BRANCHES`` children for each set. A node of more than
   ``WHOLE_PARTS`` parts of ``NODE_SETS`` sets branches again by coordinates drawn for that node, up to ``DEPTH`` levels.
3. *Small nodes* are compared exhaustively, each part with each part: first by sketches (a pair below ``LEAST_AGREEING``
   agreeing coordinates, five standard deviations under a link, is left out), then by whole sets, which are shipped to
   the nodes of the sets that passed. Every link is confirmed on the whole sets. Pairs inside one class known so far
   are skipped.
4. *Large nodes* are dealt out in random parts, each with the node's least set as its hub, and only the parts compared.
   Groups of near copies become one class there; a node whose sets are all of one class is done. Only the others
   branch. Nodes still large after ``DEPTH`` levels are compared in full.
5. The first tree runs alone; its classes spare the others nearly all comparisons. If all its nodes were small, pairs
   that met in it are not compared again.

Recall. A linked pair survives one level of a tree with probability at least ``1 - (1 - 0.8)**2`` = 0.96 and any depth
with at least 0.937, so ``TREES`` = 6 trees miss it with a probability of at most 6e-8 and the sketch filter with 5e-7.

Classes come from ``components`` over the links. Defined cases: a null, empty or blank text has an empty set and is
linked with nothing. A text of fewer than four words has its whole sequence as one shingle. Repeated rows each get a row
of the result. Null ids are ignored when the least id of a class is taken; a row without an id is kept only if its class
has no id at all. Other columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerec.llm import text as T
from lakerec.llm.components import components
from lakerec.llm.narrow import meeting
from lakerec.llm.ngram_join import digest
from lakerec.session import stored

WIDTH = 4
TREES = 6
BRANCHES = 2
COORDINATES = 64
LEAST_AGREEING = 35
DEPTH = 3
NODE_SETS = 1_000
WHOLE_PARTS = 8
NODE_SHINGLES = 2_000_000
SEED = 0x1F83D9ABFB41BD6B

_FACTORS = T.mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(SEED)) | np.uint64(1)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, COORDINATES) 32-bit least values of non-empty sets."""
    values = np.concatenate(sets)
    first = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), COORDINATES), dtype=np.uint32)
    for k, factor in enumerate(_FACTORS):
        out[:, k] = np.minimum.reduceat((values * factor) >> np.uint64(32), first)
    return out


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, bounds in T.slices(batch.column(1)):
            sets = T.shingles(data, bounds, WIDTH)
            full = [s for s in sets if len(s)]
            whole = sketches(full) if full else np.zeros((0, COORDINATES), dtype=np.uint32)
            # A byte of each value is enough to compare; the first tree's values are kept whole.
            met = np.ascontiguousarray(whole[:, :BRANCHES]).view(np.uint8)
            rows, short = iter(whole), iter(np.hstack([whole.astype(np.uint8), met]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, high - low),
                    pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(short).tobytes() if len(s) else None for s in sets], pa.binary()),
                    batch.column(2).slice(low, high - low),
                ],
                names=["doc_id", "cls", "n_shingles", "sketch", "short", "mark"],
            )


def drawn(seeds: np.ndarray) -> np.ndarray:
    """(nodes, BRANCHES) different coordinates for each node, drawn by its 64-bit name."""
    pick = T.mix(seeds ^ np.uint64(SEED))
    first = pick % np.uint64(COORDINATES)
    others = [first]
    for _ in range(BRANCHES - 1):
        pick = T.mix(pick + np.uint64(1))
        step = np.uint64(1) + pick % np.uint64(COORDINATES // BRANCHES - 1)
        others.append((others[-1] + step) % np.uint64(COORDINATES))
    return np.stack(others, axis=1).astype(np.int64)


def children(nodes: np.ndarray, sketch: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """(rows, BRANCHES) names of the children that sets in ``nodes`` go to."""
    values = np.take_along_axis(sketch, chosen, axis=1).astype(np.uint64)
    place = chosen.astype(np.uint64) << np.uint64(32)
    return T.mix(T.mix(nodes)[:, None] + (values | place))


def _branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(node, cls, sketch)``: a row for each child. A root's coordinates are its own, no two trees share one."""
    for batch in batches:
        if not batch.num_rows:
            continue
        nodes = batch.column(0).to_numpy().view(np.uint64)
        sketch = _matrix(batch.column(2), np.uint32)
        roots = nodes < TREES
        at = np.arange(BRANCHES)[None, :] + BRANCHES * (nodes[:, None] % np.uint64(TREES)).astype(np.int64)
        chosen = np.where(roots[:, None], at, drawn(nodes))
        named = children(nodes, sketch, chosen)
        rows = np.repeat(np.arange(len(nodes)), BRANCHES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(named.ravel().view(np.int64)), batch.column(1).take(pa.array(rows))], names=["node", "cls"]
        )


def _matrix(column: pa.Array, kind: type, width: int = COORDINATES) -> np.ndarray:
    data, bounds = T.as_bytes(column)
    return data[bounds[0] : bounds[-1]].view(kind).reshape(-1, width)


def alike_pairs(
    sketch: np.ndarray, block: np.ndarray, group: np.ndarray, sizes: np.ndarray, met: np.ndarray | None = None
) -> np.ndarray:
    """Which rows (sorted by ``block``) have a partner in their block, of another ``group``, that may link with them.

    Pairs that agree in a column of ``met`` have been compared before.
    """
    hit = np.zeros(len(block), dtype=bool)
    rows = np.arange(len(block))
    distance = 0
    while True:
        distance += 1
        rows = rows[rows + distance < len(block)]
        rows = rows[block[rows] == block[rows + distance]]
        if not len(rows):
            return hit
        a, b = rows, rows + distance
        other = (group[a] != group[b]) & (5 * np.minimum(sizes[a], sizes[b]) >= 4 * np.maximum(sizes[a], sizes[b]))
        for at in range(0, len(a), 50_000):
            part = slice(at, at + 50_000)
            x, y = a[part][other[part]], b[part][other[part]]
            near = (sketch[x] == sketch[y]).sum(axis=1) >= LEAST_AGREEING
            if met is not None:
                near &= (met[x] != met[y]).all(axis=1)
            hit[x[near]] = True
            hit[y[near]] = True


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by the number in their first column, in lots that never cut a run of equal numbers."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        if held and key[0] != last:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            held = []
        held.append(batch.slice(cut))
        last = key[-1]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """A number for each row, the same for equal values."""
    return column.combine_chunks().dictionary_encode().indices.to_numpy()


def _filter(first_done: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``(block, cls, class, n, short)`` sorted by block: ``(block, cls, class)`` of the sets to be compared."""
        for table in _lots(batches):
            both = _matrix(table["short"].combine_chunks(), np.uint8, COORDINATES + 4 * BRANCHES)
            met = np.ascontiguousarray(both[:, COORDINATES:]).view(np.uint32) if first_done else None
            sketch = np.ascontiguousarray(both[:, :COORDINATES])
            hit = alike_pairs(sketch, table["block"].to_numpy(), _numbers(table["class"]), table["n"].to_numpy(), met)
            yield from table.select(["block", "cls", "class"]).filter(pa.array(hit)).to_batches()

    return run


def exhaustive(sets: list[np.ndarray], start: np.ndarray) -> np.ndarray:
    """The class (its least place) of each set after all comparisons; ``start`` gives the classes known before."""
    label = start.copy()
    sizes = np.array([len(s) for s in sets])
    first = np.cumsum(np.append(0, sizes))
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(int(token.max()) + 1 if len(token) else 0, dtype=bool)
    for i in range(len(sets) - 1):
        later = np.arange(i + 1, len(sets))
        later = later[(label[later] != label[i]) & (5 * np.minimum(sizes[later], sizes[i]) >= 4 * np.maximum(sizes[later], sizes[i]))]
        if not len(later):
            continue
        own = token[first[i] : first[i + 1]]
        mark[own] = True
        if 2 * len(later) > len(sets) - i:
            shared = np.add.reduceat(mark[token[first[i + 1] :]], first[i + 1 : -1] - first[i + 1], dtype=np.int64)[later - i - 1]
        else:
            shared = np.array([np.count_nonzero(mark[token[first[j] : first[j + 1]]]) for j in later.tolist()])
        mark[own] = False
        for j in later[9 * shared >= 4 * (sizes[i] + sizes[later])].tolist():
            a, b = sorted((label[i], label[j]))
            if a != b:
                label[label == b] = a
    return label


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(block, cls, class, shingles)`` sorted by block: links ``(a, b)`` found in each block."""
    for table in _lots(batches):
        block = table["block"].to_numpy()
        cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        names, known = table["cls"].to_pylist(), _numbers(table["class"])
        data, bounds = T.as_bytes(table["shingles"])
        links = []
        for low, high in zip(cuts[:-1], cuts[1:]):
            place = {}  # a hub may have been dealt into its own part as well
            for i in range(low, high):
                place.setdefault(names[i], i)
            rows = list(place.values())
            sets = [data[bounds[i] : bounds[i + 1]].view(np.uint64) for i in rows]
            seen: dict = {}
            start = np.array([seen.setdefault(known[i], k) for k, i in enumerate(rows)])
            label = exhaustive(sets, start)
            links += [(names[rows[k]], names[rows[label[k]]]) for k in np.flatnonzero(label != start).tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in links], pa.binary()), pa.array([p[1] for p in links], pa.binary())], names=["a", "b"]
        )


def _wanted_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(cls, text)``: the whole set of each, if the text has it."""
    for batch in batches:
        for low, high, data, bounds in T.slices(batch.column(1)):
            rows = []
            for cls, values in zip(batch.column(0).slice(low, high - low).to_pylist(), T.shingles(data, bounds, WIDTH)):
                if len(values) and digest(values) == cls:  # not another text of the same id
                    rows.append((cls, values.tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*rows)], names=["cls", "shingles"])


def _sorted_map(rows: DataFrame, run, schema: str) -> DataFrame:
    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(run, schema)


class Join:
    """The state of one join: sketches of the distinct sets, links found so far and the classes they make."""

    def __init__(self, docs: DataFrame):
        # The text's mark tells apart texts under one id, or under none.
        source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("mark"))
        self.source = source
        schema = "doc_id bigint, cls binary, n_shingles bigint, sketch binary, short binary, mark bigint"
        self.signed = stored(source.mapInArrow(_signatures, schema), "signatures")
        sets = self.signed.where("cls is not null").select("cls", F.col("n_shingles").alias("n"), "sketch", "short")
        self.sketches = stored(sets.distinct(), "sketches")
        self.links: list[DataFrame] = []
        self.known = 0  # links that the classes come from
        self.members = self.sketches.select("cls", "n", "short", F.col("cls").alias("class"))
        self.sets: DataFrame | None = None
        self.first_done = False  # all pairs that meet in the first tree's first level have been compared

    def ship(self, asked: DataFrame) -> None:
        """Store the whole sets ``(cls, shingles)`` of all that may have a link, ``asked (cls)``, once for all nodes."""
        one = self.signed.where("cls is not null").groupBy("cls").agg(F.min(F.struct("doc_id", "mark")).alias("one"))
        one = asked.distinct().join(one, "cls").select("cls", F.col("one.doc_id").alias("id"), F.col("one.mark").alias("text_mark"))
        same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("text_mark") == F.col("mark"))
        # Stored, so that the planner knows whether it is small enough to be brought to the texts.
        one = stored(one, "asked")
        source = meeting(self.source, [F.col("doc_id"), F.col("mark")], one, [F.col("id"), F.col("text_mark")])
        texts = one.join(source, same).select("cls", "text").dropDuplicates(["cls"])
        self.sets = stored(texts.mapInArrow(_wanted_sets, "cls binary, shingles binary"), "sets")

    def passing(self, placed: DataFrame) -> DataFrame:
        """``(block, cls, class)`` of the sets of ``(block, cls)`` that may link with one of another class in their block."""
        asked = placed.join(self.members, "cls").select("block", "cls", "class", "n", "short")
        return _sorted_map(asked, _filter(self.first_done), "block bigint, cls binary, class binary")

    def contract(self) -> None:
        """Bring the classes up to date with the links found since."""
        if len(self.links) > self.known:
            self.known = len(self.links)
            found = components(reduce(DataFrame.union, self.links)).select(F.col("node").alias("cls"), F.col("root").alias("class"))
            joined = self.sketches.select("cls", "n", "short").join(found, "cls", "left")
            self.members = stored(joined.withColumn("class", F.coalesce("class", "cls")), "members")

    def compare(self, placed: DataFrame) -> None:
        """Compare the sets of each block of ``(block, cls)`` that are not of one class, and add the links."""
        whole = self.passing(placed).join(self.sets, "cls").select("block", "cls", "class", "shingles")
        links = stored(_sorted_map(whole, _compare, "a binary, b binary"), "links")
        if not links.isEmpty():
            self.links.append(links)

    def mixed(self, rows: DataFrame) -> DataFrame:
        """``(node, parts, hub)`` of the nodes of ``(node, cls)`` that hold sets of several classes, stored."""
        nodes = rows.join(self.members.select("cls", "class", "n"), "cls").groupBy("node").agg(
            F.count("*").alias("sets"), F.sum("n").alias("total"), F.min("cls").alias("hub"),
            F.min("class").alias("c0"), F.max("class").alias("c1"),
        )
        parts = F.greatest(F.ceil(F.col("sets") / NODE_SETS), F.ceil(F.col("total") / NODE_SHINGLES)).cast("int")
        return stored(nodes.where("c0 <> c1").select("node", parts.alias("parts"), "hub"), "mixed")

    def dealt(self, rows: DataFrame, nodes: DataFrame, salt: int) -> DataFrame:
        """``(block, cls)``: the sets of each node in its parts, with the hub in each part."""
        part = F.pmod(F.xxhash64("cls", F.lit(salt)), F.col("parts")).cast("int")
        own = rows.join(nodes, "node").select("node", part.alias("part"), "cls")
        hubs = nodes.select("node", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), F.col("hub").alias("cls"))
        return own.union(hubs).select(F.xxhash64("node", "part").alias("block"), "cls")

    def every_part(self, rows: DataFrame, nodes: DataFrame) -> DataFrame:
        """``(block, cls)``: part i of a node meets each part j in block (min, max)."""
        part = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
        ways = rows.join(nodes, "node").select("node", "cls", "parts", part.alias("part"))
        ways = ways.select("node", "cls", "part", F.explode(F.expr("sequence(0, parts - 1)")).alias("other"))
        pair = [F.least("part", "other"), F.greatest("part", "other")]
        return ways.select(F.xxhash64("node", *pair).alias("block"), "cls")

    def branched(self, rows: DataFrame) -> DataFrame:
        """Rows ``(node, cls)`` of the children of stored rows."""
        held = rows.join(self.sketches.select("cls", "sketch"), "cls").select("node", "cls", "sketch")
        return stored(held.mapInArrow(_branch, "node bigint, cls binary"), "nodes")

    def roots(self, trees: range) -> DataFrame:
        """Rows ``(node, cls)`` of the first level of some trees."""
        tree = F.explode(F.array(*[F.lit(t).cast("bigint") for t in trees])).alias("node")
        return stored(self.sketches.select(tree, "cls", "sketch").mapInArrow(_branch, "node bigint, cls binary"), "nodes")

    def candidates(self) -> DataFrame:
        """``(cls)`` of the sets that may have a link: a partner by sketch in a small node, or a place in a large one."""
        rows = self.roots(range(TREES))
        nodes = self.mixed(rows)
        found = self.passing(self.every_part(rows, nodes.where(F.col("parts") <= WHOLE_PARTS))).select("cls")
        return found.union(rows.join(nodes.where(F.col("parts") > WHOLE_PARTS).select("node"), "node", "left_semi").select("cls"))

    def run_trees(self, trees: range) -> None:
        rows = self.roots(trees)
        for level in range(DEPTH + 1):
            nodes = self.mixed(rows)
            if nodes.isEmpty():
                return
            last = level == DEPTH
            small, large = nodes.where(F.col("parts") <= WHOLE_PARTS), nodes.where(F.col("parts") > WHOLE_PARTS)
            done = last or large.isEmpty()
            whole = done and level == 0
            placed = self.every_part(rows, nodes if last else small)
            self.compare(placed if done else placed.union(self.dealt(rows, large, level)))
            self.contract()
            self.first_done |= whole and trees[0] == 0
            if done:
                return
            rows = stored(rows.join(large.select("node"), "node", "left_semi"), "large")
            rows = self.branched(rows.join(self.mixed(rows).select("node"), "node", "left_semi"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs (doc_id, text)``."""
    join = Join(docs)
    join.ship(join.candidates())
    join.run_trees(range(1))
    join.run_trees(range(1, TREES))
    rows = join.signed.select("doc_id", "n_shingles", "cls")
    rows = stored(rows.join(join.members.select("cls", "class"), "cls", "left").drop("cls"), "classed")
    least = rows.where("class is not null").groupBy(F.col("class").alias("c")).agg(F.min("doc_id").alias("least"))
    out = rows.join(least, F.col("class") == F.col("c"), "left")
    root = F.coalesce("least", "doc_id")
    return out.select("doc_id", "n_shingles", root.alias("component_id"), F.col("doc_id").eqNullSafe(root).alias("kept"))
