"""Removal of paragraphs that repeat, exactly or nearly, by MinHash banding, exact checks and components.

With ``passage`` given, runs of that many words which stand in several documents go as well, wherever lines begin.

A paragraph is a line (``\\n``-split) of five words or more, the width of a shingle; its set are the distinct 5-word
shingles, A-Z lower-cased. Paragraphs are alike when ``100 * intersection >= 80 * union``. The result counts those of
``MIN_WORDS`` words or more (``n_paragraphs``) and the shorter ones (``n_short``) apart; ``n_removed`` counts both.

1. *Signatures.* Each paragraph has a 128-bit digest of its set and MinHash values in ``bands`` bands of ``rows`` values.
   ``tune`` takes the least number of bands for which sets at the threshold collide in one or more with the wanted
   probability (0.999).
2. *Collisions.* Equal sets are one from here on. A band value is of interest if two different sets have it, a
   reduction that is combined before the shuffle. Sets with such a value are shipped once.
3. *Exact check.* Sets that share band values are verified in blocks by their exact Jaccard similarity (the tree join
   of ``ngram_join``, whose treatment of large clusters splits a hot band value). No pair of different sets that
   collides is skipped, but those in one class already.
4. *Removals.* Classes are the components of the links. Of each class the paragraph that comes first, by document id and
   then by place, stays; the others are removed from their documents.
5. *Passages* (only with ``passage``). Windows of that many words, A-Z lower-cased and with any white space between, are
   filed under the least gram of ``passage // 2`` words inside (by hash, leftmost first): equal windows have equal grams
   at equal offsets. The windows of one gram are a stretch. Where all stretches of a gram that several documents hold
   are equal, counting decides; otherwise one stretch of each kind is taken apart, and its windows are counted by a
   128-bit hash. The first document that holds a window keeps it; in the others the words it covers are removed, with
   what stands between them, and lines that lose all their words. ``n_shared_words`` counts the words in such windows,
   ``n_cut_words`` those removed from documents that do not come first, lines removed anyhow included; a window
   repeated inside of one document only is neither.

Defined cases: a null text has no paragraphs; lines of fewer than five words have no shingle and are never touched; null ids come last when the first
paragraph is chosen; lines of any length are one paragraph, so without ``passage`` a passage inside of longer lines that are not alike stays; rows are told
apart by id and a hash of the text, and repeated rows are documents of their own that lose
the same lines, with the first row's paragraphs kept in every repeat of it. Extra columns pass through. An empty table
gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakerec.llm import text as T
from lakerec.llm.narrow import marked, meeting
from lakerec.llm.ngram_join import DIGEST_SALTS, WIDTH, set_classes
from lakerec.llm.suffix_dedup import kinds_of, stretches
from lakerec.session import discard, stored

MIN_WORDS = 10  # only tells n_paragraphs from n_short; shorter lines are compared and removed alike
THRESHOLD = 0.8
ROWS = 3
RECALL = 0.999


def tune(threshold: float = THRESHOLD, rows: int = ROWS, recall: float = RECALL) -> int:
    """The least number of bands of ``rows`` values with ``1 - (1 - threshold ** rows) ** bands >= recall``."""
    return ceil(log(1 - recall) / log(1 - threshold**rows))


def _lines(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Begin and end of each word, each line's first word (one more entry), and each line's text and number there."""
    breaks = np.flatnonzero(data == 10)
    edges = np.unique(np.concatenate([bounds, breaks + 1]))  # line starts; a line's feed belongs to it
    begins, ends, first = T.words(data, edges)
    owner = np.searchsorted(bounds, edges[:-1], "right") - 1
    number = np.arange(len(owner)) - np.searchsorted(edges, bounds)[owner]
    return begins, ends, first, owner, number


def _distinct(values: np.ndarray) -> np.ndarray:
    """``np.unique`` of non-empty ``values``, in a fraction of its time for the few of a line."""
    values = np.sort(values)
    new = values[1:] != values[:-1]
    return values if new.all() else values[np.append(True, new)]


def paragraphs(data: np.ndarray, bounds: np.ndarray) -> tuple[list[list[tuple[int, int, np.ndarray]]], np.ndarray, np.ndarray]:
    """Per text ``(line number, words, shingles)`` of its paragraphs; hashes of all words, and each text's first word."""
    begins, ends, first, owner, number = _lines(data, bounds)
    values = T.span_hashes(T.prefix_sums(T.LOWER[data]), begins, ends)
    n_words = np.diff(first)
    many = np.flatnonzero(n_words >= WIDTH)
    windows = T.window_hashes(values, WIDTH)
    found: list[list] = [[] for _ in range(len(bounds) - 1)]
    for line, text in zip(many.tolist(), owner[many].tolist()):
        own = _distinct(windows[first[line] : first[line + 1] - WIDTH + 1])
        found[text].append((int(number[line]), int(n_words[line]), own))
    return found, values, np.searchsorted(begins, bounds)


def _owners(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All values of non-empty sets, one set after the other, and where each begins."""
    return np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])


def digests(sets: list[np.ndarray]) -> list[bytes]:
    """``digest`` of each of the sets, all at once."""
    values, first = _owners(sets)
    halves = [np.add.reduceat(T.mix(values ^ np.uint64(salt)), first).astype(">u8") for salt in DIGEST_SALTS]
    both = np.stack(halves, axis=1).tobytes()
    return [both[i : i + 16] for i in range(0, len(both), 16)]


def band_values(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """(sets, bands): one value per band from the least mixed values of each set, all sets of a slice at once."""
    values, first = _owners(sets)
    salts = T.mix(np.arange(1, bands * rows + 1, dtype=np.uint64) * T.BASE)
    least = np.stack([np.minimum.reduceat(T.mix(values ^ salt), first) for salt in salts], axis=1)
    by_band = least.reshape(len(sets), bands, rows)
    total = T.mix(np.arange(bands, dtype=np.uint64) + np.uint64(1))[None, :]
    for r in range(rows):
        total = T.mix(total * T.BASE + by_band[:, :, r])
    return total.view(np.int64)


_PARAGRAPHS = (
    "doc_id bigint, mark bigint, line int, cls binary, bands array<bigint>, "
    "low int, high int, gram bigint, k0 bigint, k1 bigint"
)
_SETS = "cls binary, n bigint, shingles binary, prefix array<bigint>, k0 bigint, k1 bigint, place int, w0 bigint, w1 bigint"


def _batch(schema: str, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """The columns of ``schema``, null where not given."""
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    rows = len(next(iter(columns.values())))
    fields = [c.split() for c in schema.split(", ")]
    values = [columns[c] if c in columns else pa.nulls(rows, kinds[kind]) for c, kind in fields]
    return pa.RecordBatch.from_arrays(values, names=[c for c, _ in fields])


def _hashes(values: np.ndarray, low: np.ndarray, high: np.ndarray, offset: np.ndarray) -> list[pa.Array]:
    """Halves of a 128-bit hash of the words ``[low, high)`` and the offset."""
    both = kinds_of(values.view(np.uint8), low * 8, high * 8, offset)
    return [pa.array(both[:, 0]), pa.array(both[:, 1])]


def _signatures(bands: int, rows: int, passage: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``(doc_id, mark, text)``; of equal sets in a slice only the first carries its bands."""
        for batch in batches:
            for low, high, data, bounds in T.slices(batch.column(2)):
                ids = [batch.column(i).slice(low, high - low) for i in (0, 1)]
                found, values, first_word = paragraphs(data, bounds)
                if passage:
                    owner, begin, last, anchor, grams = stretches(values, first_word, passage, passage // 2)
                    at = pa.array(owner)
                    k0, k1 = _hashes(values, first_word[owner] + begin, first_word[owner] + last + passage, anchor - begin)
                    columns = {"doc_id": ids[0].take(at), "mark": ids[1].take(at), "k0": k0, "k1": k1}
                    columns |= {"low": pa.array(begin.astype(np.int32)), "high": pa.array(last.astype(np.int32))}
                    yield _batch(_PARAGRAPHS, columns | {"gram": pa.array(grams.view(np.int64))})
                out = [(i, line, own_set) for i, own in enumerate(found) for line, _, own_set in own]
                if not out:
                    continue
                names = digests([o[2] for o in out])
                first = {name: i for i, name in reversed(list(enumerate(names)))}
                heads = sorted(first.values())
                flat = band_values([out[i][2] for i in heads], bands, rows)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(heads) + 1, dtype=np.int32) * bands), pa.array(flat.ravel()))
                place = np.full(len(out), -1)
                place[heads] = np.arange(len(heads))
                at = pa.array([o[0] for o in out])
                columns = {"doc_id": ids[0].take(at), "mark": ids[1].take(at), "line": pa.array([o[1] for o in out], pa.int32())}
                columns |= {"cls": pa.array(names, pa.binary()), "bands": lists.take(pa.array(place, mask=place < 0))}
                yield _batch(_PARAGRAPHS, columns)

    return run


def _whole_sets(bands: int, rows: int, passage: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``(text, wanted, asked)``: the sets of the wanted lines, and the windows of the asked stretches."""
        for batch in batches:
            for low, high, data, bounds in T.slices(batch.column(0)):
                wanted, asked = (batch.column(i).slice(low, high - low).to_pylist() for i in (1, 2))
                found, values, first_word = paragraphs(data, bounds)
                out = []
                for i, own in enumerate(found):
                    lines = {w["line"]: w["cls"] for w in wanted[i]}
                    out += [(lines[line], own_set) for line, _, own_set in own if line in lines]
                if out:
                    flat = band_values([o[1] for o in out], bands, rows)
                    columns = {
                        "cls": pa.array([o[0] for o in out], pa.binary()),
                        "n": pa.array([len(o[1]) for o in out], pa.int64()),
                        "shingles": pa.array([o[1].tobytes() for o in out], pa.binary()),
                        "prefix": pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * bands), pa.array(flat.ravel())),
                    }
                    yield _batch(_SETS, columns)
                told = [(a["k0"], a["k1"], int(first_word[i]) + a["low"], a["high"] - a["low"] + 1) for i in range(len(asked)) for a in asked[i]]
                if told:
                    k0, k1, begin, size = (np.array(c, dtype=np.int64) for c in zip(*told))
                    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                    start = np.repeat(begin, size) + place
                    w0, w1 = _hashes(values, start, start + passage, np.zeros(len(start), dtype=np.int64))
                    columns = {"k0": pa.array(np.repeat(k0, size)), "k1": pa.array(np.repeat(k1, size)), "w0": w0, "w1": w1}
                    yield _batch(_SETS, columns | {"place": pa.array(place.astype(np.int32))})

    return run


def _shared_stretches(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored stretches whose gram several documents hold, and their kinds with the first document of each.

    ``mixed`` tells grams whose stretches are not all equal.
    """
    who = F.xxhash64("doc_id", "mark").alias("who")
    own = signed.where("gram is not null").select("doc_id", "mark", "low", "high", "gram", "k0", "k1", who)
    bounds = [f(c).alias(f"{f.__name__}_{c}") for c in ("who", "k0", "k1") for f in (F.min, F.max)]
    several = own.groupBy("gram").agg(*bounds).where("min_who <> max_who")
    shared = stored(several.select("gram", F.expr("min_k0 <> max_k0 or min_k1 <> max_k1").alias("mixed")), "shared-grams")
    # Stored, so that the joins can be split where a gram is hot.
    met = stored(meeting(own, [F.col("gram")], shared, [F.col("gram")]).join(shared, "gram"), "shared-stretches")
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "low", "high")).alias("one")
    kinds = met.groupBy("k0", "k1", "mixed").agg(one, F.min("who").alias("a"), F.max("who").alias("b"))
    return met, stored(kinds, "stretch-kinds")


def _passages(met: DataFrame, kinds: DataFrame, windows: DataFrame) -> DataFrame:
    """``(doc_id, mark, low, places, gone, kept_doc)``: windows that several documents hold, as a bit for each start from
    ``low`` on, and whether another document keeps them. ``windows`` are those of the mixed kinds."""
    first = F.struct("one.none", "one.doc_id", "one.mark").alias("first")
    by = ["k0", "k1"]
    told = windows.join(kinds.where("mixed").select(*by, first, "a", "b"), by)
    often = told.groupBy("w0", "w1").agg(F.min("first").alias("first"), F.min("a").alias("a"), F.max("b").alias("b"))
    hits = told.select(*by, "place", "w0", "w1").join(often.where("a <> b").select("w0", "w1", "first"), ["w0", "w1"])
    hits = hits.groupBy(*by, "first").agg(F.expr("bit_or(shiftleft(1L, place))").alias("places"))
    whole = kinds.where("not mixed").select(*by, first, F.expr("shiftleft(1L, one.high - one.low + 1) - 1").alias("places"))
    spans = met.join(stored(hits.unionByName(whole), "shared-windows"), by)
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))
    return spans.select("doc_id", "mark", "low", "places", (~own).alias("gone"), F.col("first.doc_id").alias("kept_doc"))


def _own_lists(lines: DataFrame, line: str, spans: DataFrame | None, span: str) -> DataFrame:
    """``(id, text_mark)`` with one text's lists of both columns; either is empty where a text has rows of the other only."""
    rows = lines.withColumn(span, F.lit(None).cast("int" if spans is None else spans.schema[span].dataType))
    if spans is not None:
        rows = rows.unionByName(spans.withColumn(line, F.lit(None).cast(rows.schema[line].dataType)))
    return rows.groupBy("id", "text_mark").agg(F.collect_list(line).alias(line), F.collect_set(span).alias(span))


def _found(docs: DataFrame, bands: int, rows: int, passage: int | None) -> tuple[DataFrame, DataFrame | None]:
    """``classes`` of ``docs``, and their ``_passages`` if asked for."""
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    everything = stored(source.mapInArrow(_signatures(bands, rows, passage), _PARAGRAPHS), "paragraphs")
    signed = everything.where("cls is not null").select("doc_id", "mark", "line", "cls", "bands")
    values = signed.select(F.hash("cls").alias("mark"), F.explode("bands").alias("h"))
    shared = values.groupBy("h").agg(F.min("mark").alias("a"), F.max("mark").alias("b")).where("a <> b").select("h")
    shared = stored(shared, "shared-bands")
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "line")).alias("one")
    by_set = stored(signed.groupBy("cls").agg(one, F.first("bands", ignorenulls=True).alias("bands")), "paragraph-sets")
    values = meeting(by_set.select("cls", "one", F.explode("bands").alias("h")), [F.col("h")], shared, [F.col("h")])
    colliding = values.join(shared, "h", "left_semi")
    colliding = colliding.select("cls", "one").distinct()
    text: list[Column] = [F.col("one.doc_id").alias("id"), F.col("one.mark").alias("text_mark")]
    lines, asked = colliding.select(*text, F.struct("one.line", "cls").alias("wanted")), None
    if passage:
        met, kinds = _shared_stretches(everything)
        asked = kinds.where("mixed").select(*text, F.struct("k0", "k1", "one.low", "one.high").alias("asked"))
    wanted = stored(_own_lists(lines, "wanted", asked, "asked"), "wanted-lines")
    signed = stored(signed.select("doc_id", "mark", "line", "cls"), "lines")
    discard(everything, shared, by_set)  # bands and stretches, by far the most of what is stored
    source = meeting(source, [F.col("doc_id"), F.col("mark")], wanted, [F.col("id"), F.col("text_mark")])
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("text_mark") == F.col("mark"))
    sets = wanted.join(source, same).select("text", "wanted", "asked").mapInArrow(_whole_sets(bands, rows, passage), _SETS)
    sets = stored(sets.withColumn("id", F.monotonically_increasing_id()), "paragraph-shingles")
    roots = set_classes(sets.where("cls is not null").select("cls", "n", "shingles", "prefix", "id"))
    found = signed.join(roots, "cls", "left")
    name = F.concat_ws(":", "root", F.when(F.col("root").isNull(), F.hex("cls")))
    result = stored(found.select("doc_id", "mark", "line", name.alias("class")), "paragraph-classes")
    return result, _passages(met, kinds, sets.where("cls is null").select("k0", "k1", "place", "w0", "w1")) if passage else None


def classes(docs: DataFrame, bands: int | None = None, rows: int = ROWS) -> DataFrame:
    """``(doc_id, mark, line, class)`` of every paragraph of ``docs (doc_id, text)``, stored."""
    return _found(docs, bands or tune(rows=rows), rows, None)[0]


def removals(found: DataFrame) -> DataFrame:
    """``(doc_id, mark, line, kept_doc)`` of the paragraphs to remove, with the document that keeps theirs."""
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "line")
    first = found.groupBy("class").agg(F.min(key).alias("first"), F.count("*").alias("n")).where("n > 1")
    joined = found.join(first.select("class", "first"), "class")
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))
    own = own & (F.col("line") == F.col("first.line"))
    return joined.where(~own).select("doc_id", "mark", "line", F.col("first.doc_id").alias("kept_doc"))


NEW = ["n_paragraphs", "n_short", "n_removed", "kept_docs", "kept_sha256", "kept_text"]
PASSAGE = ["n_shared_words", "n_cut_words"]


def _elements(column: pa.ListArray) -> tuple[np.ndarray, list[pa.Array]]:
    """The row of each struct in a column of lists, and the structs' fields."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), sizes), column.flatten().flatten()


def _covered(low: np.ndarray, places: np.ndarray, words: int, passage: int) -> np.ndarray:
    """Which of ``words`` words lie in a window of the spans."""
    starts = [low[:0]]
    for k in range(63):
        starts.append(low[places >> k & 1 == 1] + k)
    start = np.concatenate(starts)
    edges = np.bincount(start, minlength=words + 1) - np.bincount(start + passage, minlength=words + 1)
    return np.cumsum(edges)[:-1] > 0


def _cut(line: bytes, keep: np.ndarray) -> bytes | None:
    """What is kept of a line, or None if it has lost all its words."""
    if keep.all():
        return line
    rest = np.frombuffer(line, dtype=np.uint8)[keep].tobytes()
    return rest if rest.strip() else None


def _remove(passage: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``(row, text, gone, spans)``."""
        for batch in batches:
            for low, high, data, bounds in T.slices(batch.column(1)):
                rows = []
                gone: list[dict] = [{} for _ in range(high - low)]
                origins: list[set] = [set() for _ in range(high - low)]
                at, (line, kept_doc) = _elements(batch.column(2).slice(low, high - low))
                for i, n, doc in zip(at.tolist(), line.to_numpy().tolist(), kept_doc.to_pylist()):
                    gone[i][n] = doc
                    origins[i].add(doc)
                begins, ends, first, owner, _ = _lines(data, bounds)
                n_words = np.diff(first)
                long, many = (np.bincount(owner[n_words >= n], minlength=high - low).tolist() for n in (MIN_WORDS, WIDTH))
                first_word = np.searchsorted(begins, bounds)
                shared = cut = np.zeros(len(begins), dtype=bool)
                if passage:
                    at, (start, places, later, kept_doc) = _elements(batch.column(3).slice(low, high - low))
                    start, places, left = first_word[at] + start.to_numpy(), places.to_numpy(), later.to_numpy(zero_copy_only=False)
                    shared = _covered(start, places, len(begins), passage)
                    cut = _covered(start[left], places[left], len(begins), passage)
                    for i, doc in zip(at[left].tolist(), kept_doc.filter(later).to_pylist()):
                        origins[i].add(doc)
                n_shared, n_cut = (np.diff(np.append(0, np.cumsum(words))[first_word]).tolist() for words in (shared, cut))
                for i in range(high - low):
                    body = data[bounds[i] : bounds[i + 1]].tobytes()
                    lines = body.split(b"\n")
                    if n_cut[i]:
                        own = slice(first_word[i], first_word[i + 1])
                        keep = np.ones(len(body), dtype=bool)
                        edges = np.flatnonzero(np.diff(np.concatenate([[0], cut[own], [0]])))
                        for a, b in edges.reshape(-1, 2).tolist():  # runs of words to cut
                            keep[begins[own][a] - bounds[i] : ends[own][b - 1] - bounds[i]] = False
                        at = np.cumsum([0] + [len(line) + 1 for line in lines]).tolist()
                        lines = [_cut(line, keep[a : a + len(line)]) for line, a in zip(lines, at)]
                    kept = b"\n".join(line for n, line in enumerate(lines) if n not in gone[i] and line is not None)
                    sums = (long[i], many[i] - long[i], len(gone[i]))
                    digest = hashlib.sha256(kept).hexdigest()
                    rows.append((*sums, sorted(origins[i] - {None}), digest, kept.decode(), n_shared[i], n_cut[i]))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low)] + [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                    names=["row", *NEW, *PASSAGE],
                )

    return run


def removed(docs: DataFrame, passage: int | None = None) -> DataFrame:
    """``docs`` with ``NEW`` in the place of the text: paragraphs, those removed, the documents that keep them, the rest.

    With ``passage`` (4 to 120 words) passages of that many words are removed too, and the columns ``PASSAGE`` follow.
    """
    found, spans = _found(docs, tune(), ROWS, passage)
    text = [F.col("doc_id").alias("id"), F.col("mark").alias("text_mark")]
    lines = removals(found).distinct().select(*text, F.struct("line", "kept_doc").alias("__gone"))
    if passage:
        spans = spans.select(*text, F.struct("low", "places", "gone", "kept_doc").alias("__spans"))
    gone = _own_lists(lines, "__gone", spans, "__spans")
    gone = stored(gone.withColumnsRenamed({"id": "__id", "text_mark": "__text"}), "gone")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    source = docs.select(F.col("doc_id").cast("bigint").alias("__key"), F.xxhash64("text").alias("__mark"), row.alias("row"), "text")
    same = F.col("__key").eqNullSafe(F.col("__id")) & (F.col("__mark") == F.col("__text"))
    # Texts that lose nothing stay where they are.
    source = marked(source, [F.col("__key"), F.col("__mark")], gone, [F.col("__id"), F.col("__text")], "__met")
    nothing = [F.lit(None).cast(gone.schema[c].dataType).alias(c) for c in ("__gone", "__spans")]
    whole = source.where("not __met").select("row", "text", *nothing)
    joined = source.where("__met").join(gone, same, "left").select("row", "text", "__gone", "__spans").union(whole)
    kind = joined.schema["row"].dataType.simpleString()
    out = joined.mapInArrow(
        _remove(passage),
        f"row {kind}, n_paragraphs bigint, n_short bigint, n_removed bigint, kept_docs array<bigint>, kept_sha256 string, "
        "kept_text string, n_shared_words bigint, n_cut_words bigint",
    )
    new = [*NEW, *PASSAGE] if passage else NEW
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != "text" and c not in new], *new)
