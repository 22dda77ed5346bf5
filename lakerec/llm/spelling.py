"""Groups of spelling variants: words one edit apart, found by k-d trees over letter counts.

A word is a maximal run of Latin letters (``[A-Za-z\\u00C0-\\u00FF]+``) of a text, A-Z lower-cased. Two words are near if
they differ by exactly one inserted, deleted or replaced code point.

1. *Words.* Each task counts the words of its texts in a table of bounded size; counts are added before and after the
   shuffle. Words of ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences over all texts make the vocabulary.
2. *Vectors.* A word's vector counts its letters in ``DIMENSIONS`` classes (a-z, and the others dealt to the rest), each
   count, up to two, as so many bits. A replaced letter moves it by an L1 distance of 2 at most, an inserted one by 1.
3. *Upper tree.* For each length a k-d tree is fitted to a bounded sample of the vocabulary (the ``SAMPLE`` words of least
   hash) with leaves of about ``LEAF_WORDS`` words of the whole vocabulary. Every word is filed in its leaf of the tree of its own
   length, and visits the leaves whose box lies within distance 2 there and within 1 in the tree of the next length.
   Each pair is met once: from the word of the lesser leaf, or the shorter word.
4. *Lower trees.* A task builds a k-d tree with tight boxes over the words of a leaf, and visitors stream past it in
   batches: all of a batch go down together, a box further than the allowed distance is pruned, and at the bottom
   the distance is taken word by word. Pairs that pass are verified letter by letter.
5. *Forms.* A word's form is its near word of most occurrences, if it has ``RATIO`` times the word's; roots are found
   by pointer jumping along forms, which rise by that factor, so chains are short.

Defined cases: a null text has no words; a null id counts as an empty one where the id enters the hash. Repeated rows
count as often as they stand there. Words of equal letters in another order are not near, nor is a word near itself.
Ties among forms go to the least word in code-point order. Other columns are not read. An empty table gives an empty
table.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerec.llm.text import LOWER
from lakerec.session import stored

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
DELETE_ONE_IN = 31  # of the occurrences' hashes, when letters are deleted to plant variants
DIMENSIONS = 32
SAMPLE = 50_000
LEAF_WORDS = 40_000
BOTTOM = 16  # words of the lowest nodes of a lower tree
HELD_WORDS = 300_000  # distinct words a task counts before it sends them on
LOT = 200_000  # words compared at once at the bottom of a lower tree
VERIFIED_BYTES = 16 << 20

_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[ord("a") : ord("z") + 1] = np.arange(26)
_CLASS[0xC0:] = 26 + np.arange(64) % (DIMENSIONS - 26)


def runs(text: str, least: int) -> list[str]:
    """The maximal runs of Latin letters of at least ``least`` code points, A-Z lower-cased."""
    low = text.encode("utf-8", "surrogatepass").translate(LOWER.tobytes()).decode("utf-8", "surrogatepass")
    return re.findall(f"[a-zÀ-ÿ]{{{least},}}", low)


def counted_words(doc_id: int | None, text: str | None, deleting: bool) -> Counter:
    """How often each word of one text occurs, after the deletions if ``deleting``."""
    found: Counter = Counter()
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for word, n in Counter(runs(text or "", LEAST_LENGTH)).items():
        if deleting:
            mark = zlib.crc32(word.encode(), start)
            if mark % DELETE_ONE_IN == 0:
                at = mark % len(word)
                word = word[:at] + word[at + 1 :]
        if len(word) >= LEAST_LENGTH:
            found[word] += n
    return found


def _count(deleting: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``(doc_id, text)``: ``(word, n)``, each word once per lot."""
        held: Counter = Counter()

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                held.update(counted_words(doc_id.as_py(), text.as_py(), deleting))
                if len(held) > HELD_WORDS:
                    yield sent()
                    held.clear()
        yield sent()

    return run


def vocabulary(docs: DataFrame, deleting: bool = False) -> DataFrame:
    """``(word, n)`` of the words of ``docs (doc_id, text)`` that are long and frequent enough."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    counts = rows.mapInArrow(_count(deleting), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


def vectors(words: list[str]) -> np.ndarray:
    """Letter counts of each word as 64 bits: two a class, the lower set from a count of 1, the upper from 2.

    Counts above two are shortened, so the bits that differ never number more than the L1 distance.
    """
    body = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
    owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    counts = np.bincount(owner * DIMENSIONS + _CLASS[body], minlength=len(words) * DIMENSIONS).reshape(-1, DIMENSIONS)
    bits = np.stack([counts >= 1, counts >= 2], axis=2).reshape(len(words), 2 * DIMENSIONS)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """L1 distance from points to boxes: ``low`` has the bits that all vectors inside have, ``high`` those that any has."""
    return np.bitwise_count(low & ~points) + np.bitwise_count(points & ~high)


def split(points: np.ndarray) -> np.uint64 | None:
    """The bit (a class and the threshold of its count) that halves the points best; none if all are equal."""
    upper = np.unpackbits(points.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    mixed = np.flatnonzero((upper > 0) & (upper < len(points)))
    if not len(mixed):
        return None
    return np.uint64(1) << np.uint64(mixed[np.abs(2 * upper[mixed] - len(points)).argmin()])


class UpperTree:
    """The boxes of the leaves of one length's tree, numbered from 0. They cover all vectors and do not overlap."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.boxes: list[tuple[np.uint64, np.uint64]] = []
        self._grow(points, leaf, np.uint64(0), ~np.uint64(0))

    def _grow(self, points: np.ndarray, leaf: int, low: np.uint64, high: np.uint64) -> None:
        bit = split(points) if len(points) > leaf else None
        if bit is None:
            self.boxes.append((low, high))
            return
        upper = (points & bit) != 0
        self._grow(points[~upper], leaf, low, high & ~bit)
        self._grow(points[upper], leaf, low | bit, high)

    def reached(self, points: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(point, leaf) of the leaves within ``most`` of each point; within 0 is the one leaf that holds it."""
        found = [np.flatnonzero(distance(points, low, high) <= most) for low, high in self.boxes]
        return np.concatenate(found), np.repeat(np.arange(len(found)), [len(f) for f in found])


def upper_trees(words: DataFrame) -> dict[int, UpperTree]:
    """A tree for each length, from a sample of stored ``words (word, n)``; a length not met has a tree of one leaf."""
    total = words.count()
    near = words.select("word").orderBy(F.xxhash64("word"), "word").limit(SAMPLE)
    by_length: dict[int, list[str]] = {}
    for row in near.where(F.length("word") < 256).collect():  # at most SAMPLE short words
        by_length.setdefault(len(row.word), []).append(row.word)
    leaf = max(1, LEAF_WORDS * min(SAMPLE, total) // max(total, 1))
    return {length: UpperTree(vectors(own), leaf) for length, own in by_length.items()}


_FILED = "block bigint, visits boolean, word string, n bigint"


def _file(trees):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``(word, n)``: a row for the word's own leaf, and for each that it visits."""
        one = UpperTree(np.zeros(1, dtype=np.uint64), 1)
        for batch in batches:
            words = batch.column(0).to_pylist()
            if not words:
                continue
            points, lengths = vectors(words), np.fromiter(map(len, words), np.int64, len(words))
            rows, blocks, visits = [], [], []
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                home = None
                for other, most, visit in ((length, 0, False), (length, 2, True), (length + 1, 1, True)):
                    point, leaf = trees.value.get(other, one).reached(points[at], most)
                    if not visit:
                        home = np.empty(len(at), dtype=np.int64)
                        home[point] = leaf
                    elif other == length:  # of two leaves, the words of the lesser visit the other
                        later = leaf >= home[point]
                        point, leaf = point[later], leaf[later]
                    rows.append(at[point])
                    blocks.append((other << 24) + leaf)
                    visits.append(np.full(len(point), visit))
            rows = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(blocks)), pa.array(np.concatenate(visits))] + [c.take(rows) for c in batch.columns],
                names=["block", "visits", "word", "n"],
            )

    return run


class LowerTree:
    """A k-d tree of words of one length, with the tight box of every node."""

    def __init__(self, words: list[str], counts: list[int]):
        self.words, self.counts, self.points = words, counts, vectors(words)
        self.body = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), -1)
        self.order = np.arange(len(words))
        nodes: list[tuple] = []
        self._grow(0, len(words), nodes)
        self.begin, self.end, self.left, self.right = (np.array(c) for c in list(zip(*nodes))[:4])
        self.low, self.high = (np.array(c, dtype=np.uint64) for c in list(zip(*nodes))[4:])

    def _grow(self, begin: int, end: int, nodes: list) -> int:
        own = self.order[begin:end]
        points = self.points[own]
        number, box = len(nodes), (np.bitwise_and.reduce(points), np.bitwise_or.reduce(points))
        nodes.append((begin, end, -1, -1, *box))
        bit = split(points) if end - begin > BOTTOM else None
        if bit is not None:
            upper = (points & bit) != 0
            middle = end - int(upper.sum())
            self.order[begin:end] = np.concatenate([own[~upper], own[upper]])
            nodes[number] = (begin, end, self._grow(begin, middle, nodes), self._grow(middle, end, nodes), *box)
        return number

    def within(self, points: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(point, word) of all words whose vectors are within ``most`` of each point, in lots of bounded size."""
        asked, node = np.arange(len(points)), np.zeros(len(points), dtype=np.int64)
        while len(asked):
            near = distance(points[asked], self.low[node], self.high[node]) <= most
            asked, node = asked[near], node[near]
            bottom = self.left[node] < 0
            yield from self._bottom(points, asked[bottom], node[bottom], most)
            asked, node = asked[~bottom], node[~bottom]
            asked, node = np.concatenate([asked, asked]), np.concatenate([self.left[node], self.right[node]])

    def _bottom(self, points: np.ndarray, asked: np.ndarray, node: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        size = self.end[node] - self.begin[node]
        ends = np.cumsum(size)
        low = 0
        while low < len(node):
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + LOT, side="right")))
            base = ends[low:high] - size[low:high]
            place = np.arange(base[0], ends[high - 1]) + np.repeat(self.begin[node[low:high]] - base, size[low:high])
            word, point = self.order[place], np.repeat(asked[low:high], size[low:high])
            hit = np.bitwise_count(points[point] ^ self.points[word]) <= most
            yield point[hit], word[hit]
            low = high


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of letters ``a`` are one edit from their row of ``b``, of the same length or one letter longer."""
    width = a.shape[1]
    if width == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    before = np.logical_and.accumulate(a == b[:, :width], axis=1).sum(axis=1)
    after = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return before + after >= width


_NEAR = "word string, n bigint, near string, near_n bigint"


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``_FILED`` sorted by block, its own words first: ``_NEAR`` pairs, each once."""
    block, tree = None, None
    members: dict[str, int] = {}

    def visit(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        """Visitors of one length."""
        words, counts, own = zip(*rows)
        same = len(words[0]) == len(tree.words[0])
        body = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), -1)
        for asked, word in tree.within(vectors(list(words)), 2 if same else 1):
            good = np.zeros(len(asked), dtype=bool)
            step = max(1, VERIFIED_BYTES // body.shape[1])
            for i in range(0, len(asked), step):
                part = slice(i, i + step)
                good[part] = one_edit(body[asked[part]], tree.body[word[part]])
            pairs = zip(asked[good].tolist(), word[good].tolist())
            # The words of the leaf itself meet both ways.
            found = [(words[i], counts[i], tree.words[j], tree.counts[j]) for i, j in pairs if not own[i] or words[i] < tree.words[j]]
            if found:
                kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
                names = ["word", "n", "near", "near_n"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], names=names)

    def ready(visitors: list[tuple]) -> Iterator[pa.RecordBatch]:
        lengths: dict[int, list[tuple]] = {}
        for row in visitors:
            lengths.setdefault(len(row[0]), []).append(row)
        for rows in lengths.values():
            yield from visit(rows)

    for batch in batches:
        visitors: list[tuple] = []
        for own, visits, word, n in zip(*(column.to_pylist() for column in batch.columns)):
            if own != block:
                yield from ready(visitors)
                block, tree, members, visitors = own, None, {}, []
            if not visits:
                members[word] = n
            elif members:
                tree = tree or LowerTree(list(members.keys()), list(members.values()))
                visitors.append((word, n, word in members))
        yield from ready(visitors)


def near_pairs(words: DataFrame) -> DataFrame:
    """``(word, n, near, near_n)``: the pairs of stored ``words (word, n)`` that are one edit apart, each once."""
    trees = words.sparkSession.sparkContext.broadcast(upper_trees(words))  # bounded by SAMPLE
    filed = words.select("word", "n").mapInArrow(_file(trees), _FILED)
    return filed.repartition("block").sortWithinPartitions("block", "visits").mapInArrow(_meet, _NEAR)


def variant_groups(words: DataFrame) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of each of stored ``words (word, n)``."""
    pairs = stored(near_pairs(words), "near")
    both = pairs.union(pairs.select("near", "near_n", "word", "n"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    found = both.groupBy("word").agg(F.count("*").alias("n_near"), best)
    found = found.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    joined = words.join(found, "word", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("bigint")))
    enough = F.col("near_n") >= RATIO * F.col("n")
    rows = joined.select(
        "word", "n", "n_near", F.when(enough, F.col("near")).alias("form"), F.when(enough, F.col("near_n")).alias("form_n")
    )
    rows = stored(rows, "forms")
    links = stored(rows.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:  # each round doubles the steps; counts rise tenfold with each step
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = stored(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        moved = not jumped.where("next is not null").isEmpty()
        links = jumped.select("word", "root")
        if not moved:
            break
    return rows.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, deleting: bool = False) -> DataFrame:
    """``variant_groups`` of the words of ``docs (doc_id, text)``.

    ``deleting`` plants variants: an occurrence whose hash with the id is divisible by ``DELETE_ONE_IN`` loses a letter.
    """
    return variant_groups(stored(vocabulary(docs, deleting), "words"))
