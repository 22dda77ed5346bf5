"""Approximate nearest neighbours by cosine: p-stable hashing with query-directed multiprobe and exact reranking.

Hashing. On unit vectors the largest cosine is the least distance, so Gaussian (2-stable) projections are used: each of
``TABLES`` tables has ``FUNCTIONS`` functions ``floor((a . x + b) / WIDTH)``; their values are a vector's cell. A query
visits its own cell and ``PROBES - 1`` others in each table, in order of estimated success: a step down or up in a
function costs the square of the query's distance to that border, the cost of a set of steps is their sum, and sets are
generated in rising order by a heap. Vectors found in any table are ranked by their exact cosine in double precision.

Plan. Equal vectors are one entry with its least ``k + 1`` ids (limited before the shuffle, so a vector that a third of
the rows hold costs k + 1 rows per task). Entries and queries meet in blocks: a table's cells are grouped into regions
by their first two values, and a region of more than ``BLOCK`` entries is dealt out to several blocks, so a hot cell is
split; so are the queries of a region, by ``QUERY_BLOCK``. A query is sent to each block of the regions it probes, with the cells, and only visits those; each block
returns its best ids, chosen among all entries as near as the k-th id, ties and all. Every entry is indexed; nothing is fitted. Queries that found fewer than ``k`` neighbours visit every
cell of one table instead, which is exact.

Vectors that are null, empty, zero or hold null or non-finite components take no part. Vectors of different lengths
are never compared. Ties go to the smaller id; repeated ids with different vectors are separate entries, of which the
best counts. A row is no candidate of the query with its own id. Extra columns are not read; an empty table gives an
empty table.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakerec.session import stored

TABLES = 4
FUNCTIONS = 6
WIDTH = 1.5
PROBES = 300
BLOCK = 10_000
QUERY_BLOCK = 5_000
SEED = 20_07

_FOUND = "query_id bigint, vec_id bigint, score double"


def usable(vector: Column) -> Column:
    infinite = F.lit(float("inf"))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def hash_functions(dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions (dim, TABLES * FUNCTIONS) and offsets, the same everywhere."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    directions = rng.standard_normal((dim, TABLES * FUNCTIONS))
    return directions, rng.uniform(0, WIDTH, TABLES * FUNCTIONS)


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def places(vectors: np.ndarray) -> np.ndarray:
    """(rows, TABLES, FUNCTIONS): projections in widths; their floors are the cells."""
    directions, offsets = hash_functions(vectors.shape[1])
    return ((unit(vectors) @ directions + offsets) / WIDTH).reshape(len(vectors), TABLES, FUNCTIONS)


def probes(place: np.ndarray, count: int = PROBES) -> list[tuple[int, ...]]:
    """The first ``count`` cells of one table for a query at ``place``, the likeliest first."""
    home = np.floor(place).astype(int)
    inside = place - home
    steps = sorted([(x * x, i, -1) for i, x in enumerate(inside)] + [((1 - x) ** 2, i, 1) for i, x in enumerate(inside)])
    found = [tuple(home.tolist())]
    heap = [(steps[0][0], (0,))]
    while heap and len(found) < count:
        cost, chosen = heapq.heappop(heap)
        last = chosen[-1]
        if last + 1 < len(steps):
            heapq.heappush(heap, (cost - steps[last][0] + steps[last + 1][0], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (cost + steps[last + 1][0], (*chosen, last + 1)))
        functions = [steps[c][1] for c in chosen]
        if len(set(functions)) == len(functions):  # not both ways in one function
            cell = home.copy()
            for c in chosen:
                cell[steps[c][1]] += steps[c][2]
            found.append(tuple(cell.tolist()))
    return found


def _matrix(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows of each vector length: their places in the column and the vectors in double precision."""
    lengths = np.array([len(v) for v in column])
    return {
        int(n): (at, np.array([column[i].as_py() for i in at.tolist()], dtype=np.float64))
        for n in np.unique(lengths)
        if len(at := np.flatnonzero(lengths == n))
    }


def _region(dim: int, table: int, cell: tuple[int, ...]) -> str:
    return f"{dim}:{table}:{cell[0]}:{cell[1]}"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(entry, ids, vector)``: one row per table with its region and cell."""
    for batch in batches:
        for dim, (at, vectors) in _matrix(batch.column(2)).items():
            cells = np.floor(places(vectors)).astype(int)
            rows = pa.array(np.repeat(at, TABLES))
            names = [
                (_region(dim, t, cell), ",".join(map(str, cell)))
                for row in cells.tolist()
                for t, cell in enumerate(row)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n[0] for n in names]), pa.array([n[1] for n in names])]
                + [batch.column(i).take(rows) for i in range(3)],
                names=["region", "cell", "entry", "ids", "vector"],
            )


def _visits(everything: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``(query_id, vector)``: one row per region visited, with the cells wanted in it (null: all)."""
        for batch in batches:
            for dim, (at, vectors) in _matrix(batch.column(1)).items():
                located = places(vectors)
                rows, regions, cells = [], [], []
                for i, place in zip(at.tolist(), located):
                    for t in range(1 if everything else TABLES):
                        wanted: dict[str, list[str]] = {}
                        for cell in [] if everything else probes(place[t]):
                            wanted.setdefault(_region(dim, t, cell), []).append(",".join(map(str, cell)))
                        if everything:
                            wanted = {f"{dim}:0": None}
                        rows += [i] * len(wanted)
                        regions += wanted.keys()
                        cells += wanted.values()
                picked = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(regions, pa.string()), batch.column(0).take(picked), batch.column(1).take(picked)]
                    + [pa.array(cells, pa.list_(pa.string()))],
                    names=["region", "query_id", "query", "cells"],
                )

    return run


def _reach(near: np.ndarray, at: np.ndarray, ids: list[list[int]], own: int, k: int) -> float:
    """The nearness of the ``k``-th distinct id other than ``own`` among entries ``at``; minus infinity if there are fewer."""
    size = min(len(near), 2 * k + 8)
    while True:
        top = np.argpartition(-near, size - 1)[:size] if size < len(near) else np.arange(size)
        found: set[int] = set()
        for i in top[np.argsort(-near[top])].tolist():
            found.update(ids[at[i]])
            found.discard(own)
            if len(found) >= k:
                return float(near[i])
        if size == len(near):
            return -np.inf
        size = min(len(near), 4 * size)


def _search(k: int):
    def run(key, entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        """The best entries of one block for each of its queries, by exact cosine."""
        out: list[tuple] = []
        if len(entries) and len(queries):
            entries = entries.sort_values(["cell", "entry"], kind="stable")
            cell = entries["cell"].to_numpy()
            vectors = unit(np.array(entries["vector"].tolist(), dtype=np.float64))
            ids = entries["ids"].tolist()
            names, first = np.unique(cell.astype(str), return_index=True)
            spans = dict(zip(names.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(cell)])))
            asked = unit(np.array(queries["query"].tolist(), dtype=np.float64))
            for query_id, query, cells in zip(queries["query_id"].tolist(), asked, queries["cells"].tolist()):
                if cells is None:
                    at = np.arange(len(vectors))
                else:
                    runs = [np.arange(*spans[c]) for c in cells if c in spans]
                    if not runs:
                        continue
                    at = np.concatenate(runs)
                near = vectors[at] @ query
                if len(at) > k:  # the margin is above what rounding makes of a tie
                    margin = 8 * vectors.shape[1] * np.finfo(float).eps
                    at = at[near >= _reach(near, at, ids, query_id, k) - margin]
                # Products are summed by size: in one way wherever the row stands and whatever the components' order.
                scores = np.sort(vectors[at] * query, axis=1).sum(axis=1)
                best: dict[int, float] = {}
                for score, i in zip(scores.tolist(), at.tolist()):
                    for vec_id in ids[i]:
                        if vec_id != query_id:
                            best[vec_id] = max(score, best.get(vec_id, score))
                few = heapq.nsmallest(k, ((-score, vec_id) for vec_id, score in best.items()))
                out += [(query_id, vec_id, -score) for score, vec_id in few]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.expr("row_number() over (partition by query_id order by score desc, vec_id)")
    return best.withColumn("rank", rank).where(F.col("rank") <= k)


def search(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows of ``vectors (vec_id, vector)`` found for each row of
    ``queries (query_id, vector)``, whose ids are those of the rows they must not find (their own).

    Queries of one id and several vectors are one query that keeps the best of each.
    """
    kept = vectors.where(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    order = F.expr("row_number() over (partition by vector order by vec_id)")
    first = kept.select("vector", F.col("vec_id").cast("bigint").alias("vec_id")).distinct()
    few = first.withColumn("place", order).where(F.col("place") <= k + 1)
    entries = few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = stored(entries.select(F.col("ids")[0].alias("entry"), "ids", "vector"), "entries")
    kind = entries.schema["vector"].dataType.simpleString()
    asked = queries.where(usable(F.col("vector")) & F.col("query_id").isNotNull())
    asked = stored(asked.select(F.col("query_id").cast("bigint").alias("query_id"), "vector"), "queries")

    schema = f"region string, cell string, entry bigint, ids array<bigint>, vector {kind}"
    indexed = stored(entries.mapInArrow(_index, schema), "index")

    def meet(indexed: DataFrame, visits: DataFrame) -> DataFrame:
        parts = stored(
            indexed.groupBy("region").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")), "regions"
        )
        asked = visits.groupBy("region").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("lots"))
        met = stored(parts.join(asked, "region"), "met-regions")
        part = F.pmod(F.xxhash64("entry", "vector"), F.col("parts")).cast("int")
        lot = F.pmod(F.xxhash64("query_id", "query"), F.col("lots")).cast("int")
        left = indexed.join(met, "region").withColumn("part", part).withColumn("lot", F.explode(F.expr("sequence(0, lots - 1)")))
        right = visits.join(met, "region").withColumn("lot", lot).withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
        block = ["region", "part", "lot"]
        left = left.select(*block, "cell", "entry", "ids", "vector").groupBy(*block)
        right = right.select(*block, "query_id", "query", "cells").groupBy(*block)
        return left.cogroup(right).applyInPandas(_search(k), _FOUND)

    visit_schema = f"region string, query_id bigint, query {kind}, cells array<string>"
    visits = stored(asked.mapInArrow(_visits(False), visit_schema), "visits")
    found = stored(meet(indexed, visits), "found")
    counts = found.select("query_id", "vec_id").distinct().groupBy("query_id").agg(F.count("*").alias("n"))
    short = asked.join(counts, "query_id", "left").where(f"n is null or n < {int(k)}").select("query_id", "vector")
    short = stored(short, "short")
    if not short.isEmpty():
        one = indexed.where(F.split("region", ":")[1] == "0")
        one = one.withColumn("region", F.concat(F.split("region", ":")[0], F.lit(":0")))
        found = found.union(meet(one, stored(short.mapInArrow(_visits(True), visit_schema), "visits")))
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")
