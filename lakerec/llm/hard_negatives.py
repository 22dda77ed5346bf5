"""Hard negatives by exact integer scores, with angular triangle filtering.

Vectors become whole numbers, ``floor(SCALE * x)`` in double precision; a score is an integer inner product. For each
anchor its ``positives`` best rows of the same label are found, and for each of these the best ``negatives`` rows of
other labels whose scores lie in a window set by the positive's score.

1. *Angles.* Every row stores its angles to ``REFERENCES`` directions and its norm. Directions are chosen from a bounded
   sample (the ``SAMPLE`` rows of least hash), each as far from the others as possible; they change costs only.
2. *Bounds.* By the triangle inequality the angle of two vectors lies between the differences and the sums of their
   angles to any direction. The cosines of that interval, times both norms, with a margin for rounding, bound the score.
3. *Blocks.* Rows are dealt by nearest direction into blocks of ``ROWS``, anchors into blocks of ``ANCHORS``, each with
   the least and greatest angles and norms inside. A row is copied only for those blocks of anchors whose windows its
   block's bounds can reach. Inside a task the same bounds leave out tiles, then rows; only rows whose bounds overlap an
   anchor's windows get integer scoring. A window's floor rises to the score of the last row that still counts.
4. Each task returns its best rows per window; they are ranked over all tasks, limited before the shuffle.

Scores are sums in double precision while these are exact (norms whose product is below 2**53), and Python integers,
limited to 64 bits, beyond.

Defined cases: rows with a null id, label or vector, an empty vector, or a null or non-finite component take no part.
Rows of one id count as one, the least by label and vector. Vectors of different lengths never meet. A zero vector
scores 0 with all others. Ties go to the smaller id. Other columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakerec.session import stored

SCALE = 256
REFERENCES = 8
SAMPLE = 2_000
ROWS = 8_192
ANCHORS = 1_024
TILE = 1_024
EXACT = 2.0**53
LEAST, MOST = -(2**63), 2**63 - 1
SLACK = 1e-6  # radians: far above what rounding does to an angle

_CODED = "dim int, vec_id bigint, label int, norm double, angles binary, near int, units binary"


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & (F.size(vector) > 0)


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """``(dim, vec_id, label, units)``: the usable rows of ``vectors (vec_id, label, vector)``, one for each id."""
    kept = vectors.where(usable(F.col("vector")) & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    units = F.transform("vector", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    rows = kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("int").alias("label"), units.alias("units"))
    place = F.expr("row_number() over (partition by vec_id order by label, units)")
    one = rows.withColumn("place", place).where("place = 1")
    return one.select(F.size("units").alias("dim"), "vec_id", "label", "units")


def _lists(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dim)


def directions(vectors: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` unit vectors among ``vectors``, each as far in angle from those before it as possible."""
    lengths = np.linalg.norm(vectors, axis=1)
    unit = vectors[lengths > 0] / lengths[lengths > 0, None]
    if not len(unit):
        return np.eye(1, vectors.shape[1])
    chosen = [0]
    nearest = unit @ unit[0]
    while len(chosen) < min(count, len(unit)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def angles(vectors: np.ndarray, lengths: np.ndarray, references: np.ndarray) -> np.ndarray:
    cosines = vectors @ references.T / np.where(lengths > 0, lengths, 1)[:, None]
    return np.arccos(np.clip(cosines, -1, 1))


def _code(references):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``(dim, vec_id, label, units)``: with norm, angles and nearest direction."""
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                units = _lists(part.column(3), dim)
                lengths = np.linalg.norm(units, axis=1)
                to = angles(units, lengths, references.value[dim])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), part.column(2), pa.array(lengths),
                        pa.array([a.tobytes() for a in to], pa.binary()),
                        pa.array(to.argmin(axis=1).astype(np.int32)),
                        pa.array([u.tobytes() for u in units], pa.binary()),
                    ],
                    names=[c.split()[0] for c in _CODED.split(", ")],
                )

    return run


def coded(rows: DataFrame) -> DataFrame:
    """``_CODED`` of stored ``whole_numbers``."""
    dims = [r.dim for r in rows.select("dim").distinct().limit(SAMPLE + 1).collect()]
    if len(dims) > SAMPLE:
        raise ValueError(f"more than {SAMPLE} different vector lengths")
    found = {}
    for dim in dims:
        own = rows.where(F.col("dim") == dim).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)
        found[dim] = directions(_lists(own.select("units").toArrow()["units"].combine_chunks(), dim), REFERENCES)
    shared = rows.sparkSession.sparkContext.broadcast(found)  # REFERENCES vectors for each length
    return stored(rows.mapInArrow(_code(shared), _CODED), "coded")


def blocked(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Coded rows with a block number: of one length and, where they suffice, one nearest direction."""
    counts = stored(rows.groupBy("dim", "near").agg(F.count("*").alias("n")), "counts")  # a row for each direction
    part = F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("n") / size))
    return rows.join(F.broadcast(counts), ["dim", "near"]).withColumn(name, F.xxhash64("dim", "near", part)).drop("n", "near")


_BOX = "dim int, block bigint, least binary, most binary, short double, long double, low bigint, high bigint"


def _box(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The box of one block: its angles, norms, and the widest of its anchors' windows."""
    to = np.stack([np.frombuffer(a) for a in table["angles"].to_pylist()])
    norm = table["norm"].to_numpy()
    low, high = (table[c].to_numpy() for c in ("low", "high"))
    values = [key[0].as_py(), key[1].as_py(), to.min(axis=0).tobytes(), to.max(axis=0).tobytes(), norm.min(), norm.max()]
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
    return pa.Table.from_arrays(
        [pa.array([v], t) for v, t in zip([*values, int(low.min()), int(high.max())], kinds)],
        names=[c.split()[0] for c in _BOX.split(", ")],
    )


def boxes(rows: DataFrame, block: str) -> DataFrame:
    """``_BOX`` of each block of rows ``(dim, <block>, angles, norm, low, high)``."""
    return rows.select("dim", F.col(block).alias("block"), "angles", "norm", "low", "high").groupBy("dim", "block").applyInArrow(_box, _BOX)


def cosine_interval(least_a, most_a, least_b, most_b) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the cosine between vectors whose angles to the directions (last axis) lie in these ranges."""
    apart = np.maximum(0, np.maximum(least_a - most_b, least_b - most_a)).max(axis=-1) - SLACK
    widest = np.minimum(most_a + most_b, 2 * np.pi - (least_a + least_b))
    widest = np.where((most_a + most_b >= np.pi) & (least_a + least_b <= np.pi), np.pi, widest).min(axis=-1) + SLACK
    return np.cos(np.clip(widest, 0, np.pi)), np.cos(np.clip(apart, 0, np.pi))


def score_bounds(cosines: tuple[np.ndarray, np.ndarray], short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the score, rounded outward, from those of the cosine and of the product of both norms."""
    low, high = cosines
    spare = 1 + 1e-9 * long
    return np.where(low < 0, low * long, low * short) - spare, np.where(high < 0, high * short, high * long) + spare


def _reach(asked):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Boxes of row blocks: the blocks of anchors that each may matter to."""
        for batch in batches:
            for row in batch.to_pylist():
                own = asked.value.get(row["dim"])
                if own is None:
                    continue
                least, most = (np.frombuffer(row[c]) for c in ("least", "most"))
                cosines = cosine_interval(own["least"], own["most"], least, most)
                low, high = score_bounds(cosines, own["short"] * row["short"], own["long"] * row["long"])
                hit = np.flatnonzero((high >= own["low"]) & (low <= own["high"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]] * len(hit), pa.int64()), pa.array(own["block"][hit], pa.int64())],
                    names=["rb", "ab"],
                )

    return run


class Best:
    """The ``k`` best rows of each window so far; equal scores go to the lower id."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.k, self.high = k, high
        self.floor = low.copy()  # what a row must score to count
        self.window = np.zeros(0, dtype=np.int64)
        self.ids, self.scores = self.window.copy(), self.window.copy()

    def offer(self, window: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        window, ids, scores = (np.concatenate(c) for c in ((self.window, window), (self.ids, ids), (self.scores, scores)))
        order = np.lexsort((ids, ~scores, window))  # ~s falls as s rises, without the overflow of -s
        window, ids, scores = window[order], ids[order], scores[order]
        place = np.arange(len(window)) - np.searchsorted(window, window)
        kept = place < self.k
        self.window, self.ids, self.scores = window[kept], ids[kept], scores[kept]
        last = place[kept] == self.k - 1
        self.floor[self.window[last]] = self.scores[last]


def exact_scores(a: np.ndarray, b: np.ndarray, longest: float) -> np.ndarray:
    """The integer inner products of all rows of ``a`` with all of ``b``."""
    if longest < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.array([[int(x) for x in row] for row in a.tolist()], dtype=object)
    other = np.array([[int(x) for x in row] for row in b.tolist()], dtype=object)
    return np.clip(whole @ other.T, LEAST, MOST).astype(np.int64)


def _decoded(table: pa.Table) -> dict[str, np.ndarray]:
    out = {c: table[c].to_numpy() for c in ("vec_id", "label", "norm")}
    out["angles"] = np.stack([np.frombuffer(x) for x in table["angles"].to_pylist()])
    out["units"] = np.stack([np.frombuffer(x) for x in table["units"].to_pylist()])
    return out


def best_rows(anchors: dict, windows: tuple[np.ndarray, ...], rows: dict, same_label: bool, k: int) -> tuple[Best, int]:
    """The ``k`` best of ``rows`` in each window ``(anchor's place, low, high)``, and how many pairs were scored."""
    owner, low, high = windows
    best = Best(low, high, k)
    order = np.lexsort((-rows["norm"], rows["angles"][:, 0]))
    scored = 0
    for at in range(0, len(order), TILE):
        tile = order[at : at + TILE]
        # What any window of an anchor still asks for.
        least = np.full(len(anchors["norm"]), MOST)
        most = np.full(len(anchors["norm"]), LEAST)
        np.minimum.at(least, owner, best.floor)
        np.maximum.at(most, owner, high)
        to, norm = rows["angles"][tile], rows["norm"][tile]
        cosines = cosine_interval(anchors["angles"], anchors["angles"], to.min(axis=0), to.max(axis=0))
        bounds = score_bounds(cosines, anchors["norm"] * norm.min(), anchors["norm"] * norm.max())
        live = np.flatnonzero((bounds[1] >= least) & (bounds[0] <= most) & (least <= most))
        if not len(live):
            continue
        high_cos, low_cos = np.full((len(live), len(tile)), 0.0), np.full((len(live), len(tile)), np.pi)
        for r in range(to.shape[1]):  # the angles of single pairs
            mine, theirs = anchors["angles"][live, r][:, None], to[:, r][None, :]
            np.maximum(high_cos, np.abs(mine - theirs), out=high_cos)
            total = mine + theirs
            np.minimum(low_cos, np.minimum(total, 2 * np.pi - total), out=low_cos)
        cosines = np.cos(np.minimum(low_cos + SLACK, np.pi)), np.cos(np.maximum(high_cos - SLACK, 0))
        product = anchors["norm"][live][:, None] * norm[None, :]
        lower, upper = score_bounds(cosines, product, product)
        wanted = (upper >= least[live][:, None]) & (lower <= most[live][:, None])
        match = anchors["label"][live][:, None] == rows["label"][tile][None, :]
        wanted &= match if same_label else ~match
        wanted &= anchors["vec_id"][live][:, None] != rows["vec_id"][tile][None, :]
        a, b = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
        if not len(a):
            continue
        wanted = wanted[np.ix_(a, b)]
        scored += int(wanted.sum())
        longest = float(anchors["norm"][live[a]].max() * norm[b].max())
        scores = exact_scores(anchors["units"][live[a]], rows["units"][tile[b]], longest)
        place = np.full(len(anchors["norm"]), -1)
        place[live[a]] = np.arange(len(a))
        for number in range(int(np.bincount(owner).max())):  # the windows of an anchor one after the other
            mine = np.flatnonzero((_turn(owner) == number) & (place[owner] >= 0))
            own = scores[place[owner[mine]]]
            inside = wanted[place[owner[mine]]] & (own >= best.floor[mine][:, None]) & (own <= high[mine][:, None])
            surplus = own.shape[1] - k
            if surplus > 0 and inside.sum() > k * len(mine):
                ranked = np.partition(np.where(inside, own, LEAST), surplus, axis=1)[:, surplus]
                inside &= own >= ranked[:, None]
            w, c = np.nonzero(inside)
            best.offer(mine[w], rows["vec_id"][tile[b[c]]], own[w, c])
    return best, scored


def _turn(owner: np.ndarray) -> np.ndarray:
    """The number of each window among those of its anchor; windows of one anchor follow each other."""
    return np.arange(len(owner)) - np.searchsorted(owner, owner)


_FOUND = "anchor_id bigint, key bigint, vec_id bigint, score bigint, scored bigint"


def _match(same_label: bool, k: int):
    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        """A block of anchors with their windows against a block of rows."""
        names = [c.split()[0] for c in _FOUND.split(", ")]
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_arrays([pa.array([], pa.int64())] * 5, names=names)
        anchors, rows = _decoded(left), _decoded(right)
        asked = left["windows"].to_pylist()
        owner = np.repeat(np.arange(len(asked)), [len(w) for w in asked])
        keys, low, high = (np.array([w[c] for own in asked for w in own], dtype=np.int64) for c in ("key", "low", "high"))
        best, scored = best_rows(anchors, (owner, low, high), rows, same_label, k)
        share = np.zeros(len(best.window), dtype=np.int64)
        share[:1] = scored
        columns = [anchors["vec_id"][owner[best.window]], keys[best.window], best.ids, best.scores, share]
        return pa.Table.from_arrays([pa.array(c) for c in columns], names=names)

    return run


def search(rows: DataFrame, anchors: DataFrame, same_label: bool, k: int) -> DataFrame:
    """``(anchor_id, key, vec_id, score, rank)``: the ``k`` best rows in each window of stored coded ``anchors``.

    ``anchors`` has a column ``windows``, an array of (key, low, high) whose scores, both ends included, count.
    """
    widest = [F.array_min(F.transform("windows", lambda w: w["low"])).alias("low")]
    widest.append(F.array_max(F.transform("windows", lambda w: w["high"])).alias("high"))
    left = stored(blocked(anchors, ANCHORS, "ab"), "anchor-blocks")
    right = stored(blocked(rows, ROWS, "rb"), "row-blocks")
    asked: dict[int, dict] = {}
    # A row for each thousand anchors or so.
    for box in boxes(left.select("*", *widest), "ab").orderBy("dim", "block").toLocalIterator():
        asked.setdefault(box.dim, []).append(box)
    shared = {}
    for dim, own in asked.items():
        shared[dim] = {c: np.array([b[c] for b in own]) for c in ("block", "short", "long", "low", "high")}
        shared[dim] |= {c: np.stack([np.frombuffer(bytes(b[c])) for b in own]) for c in ("least", "most")}
    spark = rows.sparkSession
    none = [F.lit(0).cast("bigint").alias(c) for c in ("low", "high")]
    pairs = boxes(right.select("*", *none), "rb").mapInArrow(_reach(spark.sparkContext.broadcast(shared)), "rb bigint, ab bigint")
    pairs = stored(pairs, "block-pairs")
    columns = ["vec_id", "label", "norm", "angles", "units"]
    mine = left.join(pairs, "ab").select("ab", "rb", *columns, "windows").groupBy("ab", "rb")
    theirs = right.join(pairs, "rb").select("ab", "rb", *columns).groupBy("ab", "rb")
    found = mine.cogroup(theirs).applyInArrow(_match(same_label, k), _FOUND)
    rank = F.expr("row_number() over (partition by anchor_id, key order by score desc, vec_id)")
    return found.withColumn("rank", rank).where(F.col("rank") <= k).drop("scored")


def mined(
    vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, least_percent: int = 30, most_percent: int = 90
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are the rows of ``vectors (vec_id, label, vector)`` that the condition ``anchor`` on these columns holds for.
    A negative's score times 100 lies between ``least_percent`` and ``most_percent`` times the positive's.
    """
    marked = vectors.select("vec_id", "label", "vector")
    rows = coded(stored(whole_numbers(marked), "whole-numbers"))
    chosen = rows.where(anchor)
    everything = F.array(F.struct(F.lit(0).cast("bigint").alias("key"), F.lit(LEAST).alias("low"), F.lit(MOST).alias("high")))
    first = search(rows, stored(chosen.withColumn("windows", everything), "anchors"), True, positives)
    first = stored(first.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    wide = F.col("positive_score").cast("decimal(38, 0)")
    # The least and the greatest whole score inside the window.
    low = F.ceil(wide * least_percent / 100).cast("bigint")
    high = F.floor(wide * most_percent / 100).cast("bigint")
    window = F.struct(F.col("positive_id").alias("key"), low.alias("low"), high.alias("high"))
    windows = first.where(low <= high).groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list(window)).alias("windows"))
    second = search(rows, stored(chosen.join(windows, "vec_id"), "anchors"), False, negatives)
    second = second.select("anchor_id", F.col("key").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = second.join(first, ["anchor_id", "positive_id"])
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
