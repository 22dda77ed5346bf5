"""Neighbours, mixing, records, archives, BPE, chat and the pipeline."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import reference as R
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from lakerec.llm import ann, bpe, chat, chunks, mixing, queries, records, warc
from lakerec.session import new_scratch, stored

SF = "/root/testdata/sf0.001"
PATH = queries.vocabulary()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


# --- neighbours ------------------------------------------------------------------------------------------------------


def exact(rows, query_id, query, k):
    def cosine(v):
        a, b = np.array(v, dtype=float), np.array(query, dtype=float)
        return float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))

    scores = sorted((-round(cosine(v), 12), i) for i, v in rows if i != query_id)
    return [i for _, i in scores[:k]]


def test_neighbours_recall(spark):
    found = {}
    for r in queries.op1_multiprobe_ann(spark, SF).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    hits = 0
    for i, v in rows:
        if i % 50 == 0:
            own = sorted(found[i])
            assert [r for r, _, _ in own] == [1, 2, 3, 4, 5]
            assert all(a[2] >= b[2] for a, b in zip(own, own[1:]))
            hits += len({x for _, x, _ in own} & set(exact(rows, i, v, 5)))
    assert hits / (5 * len(found)) >= 0.9


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_neighbours_recall_on_larger_tables(spark, sf):
    folder = SF.replace("sf0.001", sf)
    found = {}
    for r in queries.op1_multiprobe_ann(spark, folder).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    unit = np.stack(rows.embedding.to_numpy()).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    hits = 0
    for i in np.flatnonzero(rows.vec_id % 50 == 0).tolist():
        near = unit @ unit[i]
        near[i] = -2
        hits += len(set(rows.vec_id[np.argsort(-near)[:5]].tolist()) & found[rows.vec_id[i]])
    assert hits / (5 * len(found)) >= 0.95


def test_neighbours_odd_vectors_copies_and_few_rows(spark):
    rng = np.random.default_rng(2)
    near = rng.standard_normal(8)
    nan, inf = float("nan"), float("inf")
    rows = [(0, near.tolist()), (1, (near * 2).tolist()), (2, None), (3, []), (4, [0.0] * 8), (5, [nan] * 8)]
    rows += [(6, [1.0] * 7 + [None]), (7, [inf] * 8), (8, [1.0, 2.0, 3.0]), (9, [3.0, 2.0, 1.0])]
    rows += [(100 + i, [1.0] + [0.5] * 7) for i in range(300)]  # one vector that most rows hold
    vectors = spark.createDataFrame(rows, "vec_id long, vector array<double>").withColumn("score", F.lit("clash"))
    asked = vectors.where("vec_id in (0, 2, 4, 8, 150)").select(F.col("vec_id").alias("query_id"), "vector")
    found = {}
    for r in ann.search(vectors, asked).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert found == {0: [1, 100, 101, 102, 103], 8: [9], 150: [100, 101, 102, 103, 104]}
    assert ann.search(vectors.limit(0), asked).count() == 0 and ann.search(vectors, asked.limit(0)).count() == 0


def block(rows, query_id, query, k):
    """What one block returns for a query that visits all of it, from rows ``(ids, vector)`` in their order."""
    entries = pd.DataFrame([("0", ids[0], ids, v) for ids, v in rows], columns=["cell", "entry", "ids", "vector"])
    entries["cell"] = [f"{i:04d}" for i in range(len(rows))]  # cells are visited in the order of the rows
    asked = pd.DataFrame([(query_id, query, None)], columns=["query_id", "query", "cells"])
    return ann._search(k)(("r", 0), entries, asked).vec_id.tolist()


def test_ties_beyond_the_kept_entries_go_to_the_smaller_ids(spark):
    base = [3.0, -1.0, 2.0, 5.0]
    copies = [([100 - i], [x * (i + 1) for x in base]) for i in range(30)]  # the smallest ids come last
    others = [([200 + i], [1.0, float(i), 0.0, 0.0]) for i in range(20)]
    for rows in (copies + others, copies[::-1] + others, others + copies):
        assert block(rows, 1, base, 5) == [71, 72, 73, 74, 75]
        assert block(rows, 72, base, 5) == [71, 73, 74, 75, 76]
    pairs = [(i, j) for i in range(12) for j in range(i)]
    ones = [([500 - n], [float(x in p) for x in range(12)]) for n, p in enumerate(pairs)]
    query = [1.0] * 12  # as near to each of 66 vectors
    assert block(ones, 1, query, 5) == [435, 436, 437, 438, 439]
    shared = [([7], [1.0, i / 1000, 0.0, 0.0]) for i in range(1, 60)] + [([i], [1.0, 1.0, float(i), 0.0]) for i in range(1, 7)]
    assert block(shared, 2, [1.0, 0.0, 0.0, 0.0], 3) == [7, 1, 3]  # an id with many vectors counts once
    vectors = spark.createDataFrame([(ids[0], v) for ids, v in copies], "vec_id long, vector array<double>")
    asked = spark.createDataFrame([(1, base)], "query_id long, vector array<double>")
    assert [r.vec_id for r in ann.search(vectors, asked).orderBy("rank").collect()] == [71, 72, 73, 74, 75]


def test_probes_come_in_order_of_cost():
    place = np.array([0.3, 2.9, -1.5, 7.2])
    home = np.floor(place)
    cells = ann.probes(place, 40)
    assert len(cells) == len(set(cells)) == 40 and cells[0] == tuple(home.astype(int))

    def cost(cell):
        step = np.array(cell) - home
        inside = place - home
        return sum(x * x if s < 0 else (1 - x) ** 2 if s > 0 else 0 for s, x in zip(step, inside))

    costs = [cost(c) for c in cells]
    assert costs == sorted(costs) and all(max(abs(np.array(c) - home)) <= 1 for c in cells)


# --- mixing ----------------------------------------------------------------------------------------------------------


def filled(sizes, budget):
    """Targets by resharing the excess until none is above twice its source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, full = {}, set()
    while True:
        left = budget - sum(2 * sizes[s] for s in full)
        total = sum(weight[s] for s in order if s not in full)
        target = {s: 2 * sizes[s] if s in full else left * weight[s] / total for s in order}
        over = {s for s in order if s not in full and target[s] > 2 * sizes[s]}
        if not over:
            return target
        full |= over


def test_mix_meets_its_targets(spark):
    rng = random.Random(1)
    rows = []
    for i in range(900):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "é", "", None, "z1", "z2"])
        rows.append((i, " ".join(["w"] * rng.randrange(0, 120)) if i % 17 else None, source))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("target", F.lit("clash"))
    mix = mixing.mixed(mixing.sized(docs)).collect()
    assert len(mix) == 900
    size = {i: len(R.WORD.findall(t or "")) for i, t, _ in rows}
    by_source = {}
    for i, _, s in rows:
        by_source[s] = by_source.get(s, 0) + size[i]
    expected = filled(by_source, 1.5 * sum(size.values()))
    taken = dict.fromkeys(by_source, 0)
    for r in mix:
        assert r["size"] == size[r.doc_id] and r.source_size == by_source[r.source]
        assert math.isclose(r.target, expected[r.source], rel_tol=1e-12)
        assert r.taken == r["copies"] * r["size"] <= 2 * r["size"]
        taken[r.source] += r.taken
    for s in by_source:
        assert abs(taken[s] - expected[s]) <= 60  # half of the longest document
    assert {(r.doc_id, r.taken) for r in mix} == {(r.doc_id, r.taken) for r in mixing.mixed(mixing.sized(docs)).collect()}


def test_mix_of_nothing(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mixed(mixing.sized(docs)).collect()] == [(0.0, 0)] * 2
    assert mixing.mixed(mixing.sized(docs.limit(0))).count() == 0


def test_mix_runs_no_python(spark, plan):
    df = queries.op4_mixing_sources(spark, SF)
    df.collect()
    assert not any(word in plan(df) for word in ("Python", "Arrow", "Pandas"))


# --- BPE and records -------------------------------------------------------------------------------------------------

PIECES = st.sampled_from(
    ["a", "b", " ", "\n", "\t", "é", "×", " the", "'s", "'", "1", "!", "<|endoftext|>", "\xa0", " ", "　", "日本"]
    + ["😀", "  ", "ing", "\r\n", "\x1c", "\x85", "<|endof", "text|>", "X" * 40, "ab" * 50, "|", "Ⅷ", "ß", "ǆ", "﻿"]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=12), max_size=6))
def test_bpe_equals_the_library(texts):
    texts = ["".join(t) for t in texts]
    model, tokenizer = test_bpe_equals_the_library.model, test_bpe_equals_the_library.tokenizer
    for make in (model.encoder, lambda: records.library_encoder(PATH)[0]):
        for low, high, ids, bounds in make().column_ids(queries_array(texts)):
            for i in range(low, high):
                expected = tokenizer.encode(texts[i], add_special_tokens=False).ids
                assert ids[bounds[i - low] : bounds[i - low + 1]].tolist() == expected, texts[i]
                assert model.decode(expected) == tokenizer.decode(expected, skip_special_tokens=False)


def queries_array(texts):
    import pyarrow as pa

    return pa.array(texts, pa.string())


@pytest.fixture(autouse=True, scope="module")
def models(library):
    test_bpe_equals_the_library.model, test_bpe_equals_the_library.tokenizer = bpe.Bpe(PATH), library


def test_encoder_forgets_and_goes_on(library, monkeypatch):
    from lakerec.llm import chunks

    monkeypatch.setattr(chunks, "KEPT", 300)
    rng = random.Random(3)
    encoder = bpe.Bpe(PATH).encoder()
    for _ in range(30):
        texts = ["".join(rng.choices("abcde ,.\n", k=150)) for _ in range(3)] + ["y" * 90]
        for low, high, ids, bounds in encoder.column_ids(queries_array(texts)):
            for i in range(low, high):
                assert ids[bounds[i - low] : bounds[i - low + 1]].tolist() == library.encode(texts[i]).ids


ODD_TEXTS = [(3, "Hello there, world"), (1, None), (2, ""), (None, "no id"), (7, "x" * 30_000), (7, "again é"), (7, "again é")]


def test_round_trip_digests(spark, library):
    docs = spark.createDataFrame(ODD_TEXTS, "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    rows = bpe.round_trip_digests(docs, PATH).collect()
    assert len(rows) == len(ODD_TEXTS)
    found = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows)

    def expected(doc_id, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        shown = ",".join(map(str, ids)).encode()
        back = library.decode(ids, skip_special_tokens=False).encode()
        return doc_id or 0, len(ids), hashlib.sha256(shown).hexdigest(), hashlib.sha256(back).hexdigest()

    assert found == sorted(expected(*row) for row in ODD_TEXTS)
    assert bpe.encoded(docs.limit(0), PATH).count() == 0


def test_records_round_trip(spark, library, monkeypatch):
    monkeypatch.setattr(records, "ROLL", 3_000)
    folder = new_scratch(spark, "records")
    rows = [(i, "".join(random.Random(i).choices("abc de", k=i * 7 % 400))) for i in range(60)] + ODD_TEXTS
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit(1)).repartition(5)
    manifest = records.write(docs, folder, PATH)
    found = records.read(manifest, folder).collect()
    start = 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for row, (doc_id, text) in zip(sorted(found, key=lambda r: r.start), order, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        data = np.array(ids, dtype="<u4").tobytes()
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(data))
        start += len(ids)
    files = manifest.collect()
    assert sum(f.n_docs for f in files) == len(rows) and len(files) > 5
    seen = []
    for f in files:  # a shuffled reader: any record by its offset
        offsets = records.read_index(folder, f.file)
        assert len(offsets) == f.n_docs
        seen += [records.read_at(folder, f.file, o)[0] for o in offsets[::-1]]
    assert sorted(seen, key=str) == sorted([r[0] for r in rows], key=str)
    assert records.read(records.write(docs.limit(0), new_scratch(spark, "none"), PATH), folder).count() == 0


def test_a_damaged_record_is_found(tmp_path):
    import pyarrow as pa

    good = records.framed(records.payload_of(5, np.array([1, 70_000]), narrow=False))
    doc_id, ids = records.read_payload(records.read_record(pa.BufferReader(good)))
    assert doc_id == 5 and ids.tolist() == [1, 70_000]
    for at in range(len(good)):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            records.read_record(pa.BufferReader(bytes(bad)))
    with pytest.raises(ValueError):
        records.read_record(pa.BufferReader(good[:-1]))


# --- archives --------------------------------------------------------------------------------------------------------

PAGES = [(5, "http://a", "same"), (3, "http://b\r\nX: y", "same"), (9, None, "same"), (4, "http://c", "other\r\n\r\n\0é")]
PAGES += [(None, "http://d", "same"), (7, "http://e", None), (8, "http://f", ""), (3, "http://b", "same"), (11, "u", "x" * 200_000)]


@pytest.mark.parametrize("least", [0, 5])
def test_revisits(spark, monkeypatch, least):
    monkeypatch.setattr(warc, "ROLL", 1_000)
    first, second = new_scratch(spark, "first"), new_scratch(spark, "second")
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("uri", F.lit(1)).repartition(3)
    headers = warc.write_archives(pages, first)
    rows = warc.read_archives(warc.deduplicate(warc.resolve(headers, least), first, second), second).collect()
    assert len(rows) == len(PAGES)
    payloads = {p: (h or "").encode() for p, _, h in PAGES}
    for r in rows:
        body = payloads[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(body), warc.digest_of(body))
    kinds = sorted(((r.page_id or 0, r.record_type, r.refers_to) for r in rows), key=str)
    expected = [(0, "revisit", 3), (3, "response", None), (3, "revisit", 3), (4, "response", None), (5, "revisit", 3)]
    expected += [(7, "response", None), (8, "revisit", 7), (9, "revisit", 3), (11, "response", None)]
    if least:
        expected = [(p, "response", None) for p, _, _ in expected]
    assert kinds == sorted(expected, key=str)
    full = warc.read_archives(headers.select("file").distinct(), first)
    assert full.where("record_type = 'response'").count() == len(PAGES)
    assert warc.write_archives(pages.limit(0), new_scratch(spark, "none")).count() == 0


# --- chat ------------------------------------------------------------------------------------------------------------

CONTROL = st.lists(
    st.sampled_from(["<|im_start|>", "<|im_end|>", "<", "|", "\\", "\n", "im_end|>", "<\\|im_end|>", "<\\\\|im_start|>", "a", "assistant", "é"]),
    max_size=8,
).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(CONTROL, CONTROL), max_size=4))
def test_any_turns_parse_back(turns):
    formatted = "".join(chat.render(role, text) for role, text in turns)
    assert [t[:2] for t in chat.parse(formatted)] == turns
    for _, text, start, length in chat.parse(formatted):
        assert chat.unescape_text(formatted[start : start + length]) == text


def test_plain_turns_are_not_escaped():
    text = "a < b | c \\ d <|other|>"
    assert chat.render("user", text) == f"<|im_start|>user\n{text}<|im_end|>\n"


@pytest.mark.parametrize("bad", ["x", "<|im_start|>user\nhi", "<|im_start|>user<|im_end|>\n", "<|im_start|>u\nhi<|im_end|>"])
def test_malformed_text_is_refused(bad):
    with pytest.raises(chat.Malformed):
        chat.parse(bad)


def test_conversation_digests(spark):
    rows = [(1, 2, "assistant", "second <|im_end|>"), (1, 1, "user", "first"), (1, 3, "assistant", None), (2, 1, None, "é")]
    rows += [(None, 1, "assistant", "x"), (2, 1, None, "é"), (3, None, "user", "z"), (3, 0, "assistant", "y")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit(1))
    found = {r.conv_id: r for r in chat.digests(chat.formatted(turns)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert found[conv].n_turns == len(own)
        assert found[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (found[conv].loss_chars, found[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert found[conv].formatted_chars == sum(len(chat.render(r[2] or "", r[3] or "")) for r in own)
    assert chat.digests(chat.formatted(turns.limit(0))).count() == 0
    with_conflict = {r.conv_id for r in queries.op10_chat_formatting(spark, SF).collect()}
    assert -1 in with_conflict


# --- pipeline --------------------------------------------------------------------------------------------------------


def test_each_stage_on_its_own_input(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, before_frame = docs.collect(), docs
        docs = stored(stage(spark, docs, SF), "stage")
        after = docs.collect()
        if name == "quality rules":
            assert {r.doc_id for r in after} <= {r.doc_id for r in before}
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            lost = {r.doc_id for r in before} - {r.doc_id for r in after}
            clean = [d for d in lost if labels.get(d) == 1 and len(next(r.text for r in before if r.doc_id == d).split()) >= 20]
            assert not clean
        if name == "n-gram Jaccard join":
            classes = R.jaccard_classes([(r.doc_id, r.text) for r in before])
            assert {r.doc_id for r in after} == {d for d, (_, c) in classes.items() if c == d}
        if name == "suffix-array dedup":
            expected = {r.doc_id: e for r, e in zip(before, R.repeats([r.text for r in before], corpus_pipeline.REPEAT_BYTES))}
            for r in after:
                assert expected[r.doc_id][3] == hashlib.sha256(r.text.encode()).hexdigest()
                assert r.n_chars == len(r.text)
        if name == "mixing sources to target weights":
            words = {r.doc_id: len(R.WORD.findall(r.text)) for r in before}
            sources = {r.doc_id: r.source for r in before}
            taken = Counter()
            for r in after:
                taken[r.source] += words[r.doc_id]
            targets = {r.source: r.target for r in mixing.mixed(mixing.sized(before_frame)).select("source", "target").distinct().collect()}
            assert abs(sum(targets.values()) - 1.5 * sum(words.values())) < 1
            for source, target in targets.items():  # whole documents: half the largest one is the most that can miss
                assert abs(taken[source] - target) <= max(n for d, n in words.items() if sources[d] == source) / 2 + 1
        if name == "BPE encoding and decoding":
            texts = {r.doc_id: r.text for r in before}
            for r in after:
                assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids
        else:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_one_row_of_each_class_stays_with_shared_and_null_ids(spark):
    def text(name):
        return " ".join(f"{name}{i}" for i in range(60))

    a, b, c, d, e = (text(x) for x in "abcde")
    rows = [(1, a), (2, a + " more"), (2, b)]  # id 2: a copy of 1, and a text of its own
    rows += [(None, c), (None, c + " more"), (None, c + " other"), (None, a + " end")]  # null ids: one of c, none of a
    rows += [(5, d), (6, d + " more"), (4, d + " end"), (4, a)]  # the least id of d's class is dropped through a
    rows += [(7, e), (7, e), (8, None), (8, None), (7, None)]  # repeats count as one; all without words stay
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = [(r.doc_id, r.text) for r in corpus_pipeline.ngram_jaccard_join(spark, docs, SF).collect()]
    of_c = [r for r in out if r[1] and r[1].startswith(c)]
    assert len(of_c) == 1 and of_c[0] in rows
    rest = [r for r in out if r not in of_c]
    expected = [(1, a), (2, b), (4, d + " end"), (7, e), (7, None), (8, None), (8, None)]
    assert sorted(rest, key=str) == sorted(expected, key=str)


def test_stages_take_nulls_repeats_and_nothing(spark):
    columns = "doc_id long, text string, lang string, source string, n_chars long, size int, kept string, mark int"
    text = " ".join(f"word{i}" for i in range(120))
    rows = [(1, text, "en", None, 1, 1, "k", 1)] * 2 + [(None, text + " more", None, "s", None, 1, "k", 1), (4, None, None, None, None, 1, "k", 1)]
    rows += [(5, "", "en", "s", 0, 1, "k", 1)]
    for rows_in in (rows, []):
        docs = spark.createDataFrame(rows_in, columns)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "BPE encoding and decoding":
                assert out.columns == docs.columns
            out.collect()


def test_chunks_are_looked_up_once_for_several_megabytes():
    asked = []

    def encode(words):
        asked.append(len(words))
        lengths = np.array([len(w) for w in words])
        return np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int32), np.cumsum(lengths) - lengths, lengths

    texts = [" ".join(f"w{(i * j) % 5003}" for j in range(4000)) for i in range(1, 130)]  # 3 MB
    encoder = chunks.Encoder(encode, None, -1, slice_bytes=records.SLICE_BYTES)
    runs = list(encoder.column_ids(pa.array(texts)))
    assert len(runs) == len(asked) == 1
    (low, high, ids, bounds), data = runs[0], "".join(texts).encode()
    assert (low, high) == (0, len(texts)) and ids.astype(np.uint8).tobytes() == data
    assert bounds.tolist() == np.cumsum([0, *map(len, texts)]).tolist()
