"""Joins, dedup and quality rules against brute force."""

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import reference as R
from pyspark.sql import functions as F

from lakerec.llm import ngram_join, paragraph_dedup, quality, suffix_dedup
from lakerec.llm import text as T
from lakerec.llm.components import components

ODD = [None, "", "   \n\t ", "one", "one two", "a\x0bb\x0cc d e", "É é ß 日本 語 x y z", "#*$ %&|<> a b c d e f"]


def prose(rng, words, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def edited(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    texts = list(ODD) + ["one two", "", "short text of four"]
    for _ in range(12):
        base = prose(rng, rng.randrange(20, 160), 4000)
        texts += [base] + [edited(rng, base, rng.randrange(1, 5)) for _ in range(rng.randrange(5))]
    hot = prose(rng, 150, 4000)  # a group of near copies with a third of all rows
    texts += [edited(rng, hot, rng.randrange(1, 6)) for _ in range(40)]
    line = prose(rng, 30, 4000)  # a line that many share, in texts that are not alike
    texts += [prose(rng, 60, 4000) + "\n" + line for _ in range(30)]
    texts.append(prose(rng, 30_000, 100_000))
    rng.shuffle(texts)
    return list(enumerate(texts))


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


def twins(n):
    """Two texts of n letters that differ in each, and collide in any polynomial hash modulo a power of two (n >= 1024)."""
    word = "a"
    while len(word) < n:
        word += word.translate({97: 98, 98: 97})
    return word, word.translate({97: 98, 98: 97})


@pytest.mark.parametrize("n", [1024, 2048])
def test_structured_texts_do_not_collide(spark, n):
    a, b = twins(n)
    words = np.frombuffer(f"{a} {b}".encode(), dtype=np.uint8)
    hashes = T.span_hashes(T.prefix_sums(words), np.array([0, n + 1]), np.array([n, 2 * n + 1]))
    assert hashes[0] != hashes[1]
    rows = [(1, a), (1, b), (2, f"{a} x\n{b} x\n{a} x"), (3, f"p {a} q r {b}\nz p {b} q r {a}")]
    links = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_join.jaccard_classes(frame(spark, [(7, a), (8, b)])).collect()}
    assert links == {(7, 1): 7, (8, 1): 8}
    docs = frame(spark, [(*r, "en", "s") for r in rows], "doc_id long, text string, lang string, source string")
    judged = {(r.doc_id, r.text): r.n_dup_lines for r in quality.judged_rows(docs).collect()}
    assert judged == {(i, t): R.quality_counts(t)[3] for i, t in rows}
    own = frame(spark, [(1, a * 2), (1, b * 2), (1, "other")])  # one id; each repeats only inside of itself
    cut = {r.n_bytes: set() for r in suffix_dedup.removed(own).collect()}
    for r in suffix_dedup.removed(own).collect():
        cut[r.n_bytes].add(r.kept_sha256)
    expected = R.repeats([a * 2, b * 2, "other"], 400)
    assert cut == {2 * n: {e[3] for e in expected[:2]}, 5: {expected[2][3]}}
    five = " c d e f"
    kept = sorted(r.kept_text for r in paragraph_dedup.removed(frame(spark, [(1, a + five), (1, b + five), (2, a + five)])).collect())
    assert kept == sorted([a + five, b + five, ""])


def test_prime_field_arithmetic():
    rng = np.random.default_rng(1)
    p = int(T.PRIME)
    a, b = (np.append(rng.integers(0, p, 70_000), [0, p - 1, p - 1, 1]).astype(np.uint64) for _ in range(2))
    for f, g in ((T.mul_mod, lambda x, y: x * y % p), (T.sub_mod, lambda x, y: (x - y) % p)):
        assert f(a, b)[-500:].tolist() == [g(x, y) for x, y in zip(a[-500:].tolist(), b[-500:].tolist())]
    data = rng.integers(0, 256, 70_000).astype(np.uint8)
    sums, base = T.prefix_sums(data), int(T.BASE)
    for begin, end in ((0, 9), (32_760, 32_780), (65_000, 66_000)):
        exact = sum((int(data[i]) + 1) * pow(base, i, p) for i in range(begin, end)) % p
        assert (int(sums[end]) - int(sums[begin])) % p == exact


@pytest.mark.parametrize("limits", [None, (7, 10**9), (3, 1500)])
def test_jaccard_classes_equal_brute_force(spark, corpus, monkeypatch, limits):
    if limits:  # large clusters: salted blocks, contraction, and the blocks of what is left
        monkeypatch.setattr(ngram_join, "BLOCK_SETS", limits[0])
        monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", limits[1])
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(frame(spark, corpus)).collect()}
    assert found == R.jaccard_classes(corpus)


def test_jaccard_threshold_is_inclusive(spark):
    # 9 and 9 shingles of which 8 are shared: 80 %. One fewer is under the threshold.
    words = [f"w{i}" for i in range(13)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-1] + ["other"])), (3, " ".join(words[1:] + ["y"]))]
    found = {r.doc_id: r.component_id for r in ngram_join.jaccard_classes(frame(spark, rows)).collect()}
    assert found == {1: 1, 2: 1, 3: 1}
    rows = [(1, " ".join(words[:12])), (2, " ".join(words[:11] + ["other"]))]
    found = {r.doc_id: r.component_id for r in ngram_join.jaccard_classes(frame(spark, rows)).collect()}
    assert found == {1: 1, 2: 2}  # 7 of 9


def test_jaccard_repeated_rows_null_ids_and_empty_table(spark):
    text = "a b c d e f g h"
    rows = [(5, text), (5, text), (None, text), (7, text.upper()), (None, None), (9, None)]
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in ngram_join.jaccard_classes(frame(spark, rows)).collect())
    assert found == [(0, 0, 0), (0, 4, 5), (5, 4, 5), (5, 4, 5), (7, 4, 5), (9, 0, 9)]
    assert ngram_join.jaccard_classes(frame(spark, [])).count() == 0


def test_tree_join_equals_all_pairs():
    rng = np.random.default_rng(1)
    for _ in range(40):
        base = rng.integers(0, 60, (3, 30))
        sets = []
        for _ in range(25):
            own = set(base[rng.integers(3)].tolist())
            for _ in range(rng.integers(0, 6)):
                own.discard(int(rng.integers(60)))
                own.add(int(rng.integers(60)))
            sets.append(np.array(sorted(own), dtype=np.uint64))
        sets.append(np.zeros(0, dtype=np.uint64))
        expected = R.classes([frozenset(s.tolist()) for s in sets])
        assert ngram_join.tree_join(sets).tolist() == expected


def test_components_of_paths_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)] + [(7, 7), (500, 500), (None, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 1000 for i in range(1000, 1100)}, 500: 500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("bucket, rounds, span, gram", [(2_000, 6, 400, 128), (2, 6, 400, 128), (2, 1, 240, 96)])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, bucket, rounds, span, gram):
    """``bucket`` 2 splits the borders of repeats by further anchors; what one round leaves is counted string by string."""
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    monkeypatch.setattr(suffix_dedup, "ROUNDS", rounds)
    rng = random.Random(5)
    passage, long = prose(rng, 90), prose(rng, 300)
    texts = ODD + [passage, "é" * 500, "é" * 500, "a" * 3000, long, long, "x" + long]
    texts += [prose(rng, 30) + " " + passage + " " + prose(rng, 30) for _ in range(20)]
    texts += [long[: rng.randrange(500, 900)] + prose(rng, 20) for _ in range(6)]
    texts += [prose(rng, 200), passage[:399], "y" + long[7:407] + "y", "z" + long[7:406] + "z", "ab" * 300]
    texts += [edited(rng, long, 2) for _ in range(12)]
    rows = list(enumerate(texts))
    found = {r.doc_id: r for r in suffix_dedup.removed(frame(spark, rows), span=span, gram=gram).collect()}
    for i, expected in enumerate(R.repeats(texts, span)):
        r = found[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected, texts[i]


def test_suffix_dedup_keeps_rows_and_columns(spark):
    text = prose(random.Random(1), 200)
    rows = [(None, text, 1), (None, "other", 2), (3, text[:500], 3), (3, "short", 4), (8, None, 5), (8, None, 5)]
    docs = frame(spark, rows, "doc_id bigint, text string, n_removed int")
    out = suffix_dedup.removed(docs)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in out.collect()) == sorted(
        (i or 0, len(t or ""), 500 if t and len(t) >= 500 else 0) for i, t, _ in rows
    )
    assert suffix_dedup.removed(frame(spark, [])).count() == 0


def test_hot_variants_give_rows_in_proportion(spark, monkeypatch):
    """Near copies of one text: no table on the way has a row for each string, or near it."""
    made = []
    real = suffix_dedup.stored

    def watched(df, label):
        out = real(df, label)
        made.append((out.count(), label))
        return out

    monkeypatch.setattr(suffix_dedup, "stored", watched)
    monkeypatch.setattr(suffix_dedup, "BUCKET", 50)
    rng = random.Random(14)
    base = prose(rng, 200)
    texts = [edited(rng, base, rng.randrange(1, 5)) for _ in range(300)]
    found = {r.doc_id: r.kept_sha256 for r in suffix_dedup.removed(frame(spark, list(enumerate(texts)))).collect()}
    assert found == {i: e[3] for i, e in enumerate(R.repeats(texts, 400))}
    strings = sum(len(t) - 399 for t in texts)
    assert {"split", "sorted"} <= {label for _, label in made} and max(made)[0] < strings / 10


def test_hot_variants_are_split_in_few_passes(spark, monkeypatch):
    """Each pass is several shuffles, however little is left: six anchors are taken in two passes, repeated rows included."""
    made = []
    real = suffix_dedup.stored
    monkeypatch.setattr(suffix_dedup, "stored", lambda df, label: made.append(label) or real(df, label))
    monkeypatch.setattr(suffix_dedup, "BUCKET", 2)
    rng = random.Random(15)
    base = prose(rng, 150)
    texts = [edited(rng, base, 2) for _ in range(40)]
    rows = [*enumerate(texts), (3, texts[3]), (3, texts[3])]
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removed(frame(spark, rows)).collect()}
    expected = dict(enumerate(R.repeats([*texts, texts[3], texts[3]], 400)))
    assert found == {i: expected[i] for i in range(40)}
    assert made.count("split") == 2 and "strings" in made


@pytest.mark.parametrize("rounds", [range(1, 2), range(1, 4), range(4, 7)])
def test_parts_have_one_anchor_a_round(rounds):
    rng = np.random.default_rng(16)
    data, bounds = rng.integers(97, 101, 2_000).astype(np.uint8), np.array([0, 30, 700, 700, 1_300, 2_000])
    owner, first, last, grams = suffix_dedup.parts(data, bounds, 100, 30, rounds)
    found = {}
    for i, (text, low, high) in enumerate(zip(owner.tolist(), first.tolist(), last.tolist())):
        for start in range(low, high + 1):
            assert (text, start) not in found
            found[text, start] = [g[i] for g in grams]
    assert set(found) == {(t, s) for t in range(5) for s in range(bounds[t + 1] - bounds[t] - 99)}
    for round_, k in zip(rounds, range(len(rounds))):
        for text, low, high, _, gram in zip(*suffix_dedup.stretches(data, bounds, 100, 30, round_)):
            assert all(found[text, start][k] == gram for start in range(low, high + 1))


def test_merge_sort_orders_suffixes():
    rng = random.Random(2)
    body = "".join(rng.choice("ab") for _ in range(1500)).encode() * 2
    data = np.frombuffer(body + bytes(suffix_dedup.SPAN), dtype=np.uint8)
    suffixes = np.array(rng.sample(range(2000), 300))
    group = np.sort(np.array([rng.randrange(4) for _ in suffixes]))
    out = suffix_dedup.merge_sort(data, suffix_dedup.T.prefix_sums(data), suffixes, group)
    for g in range(4):
        cut = [data[s : s + suffix_dedup.SPAN].tobytes() for s in out[group == g].tolist()]
        assert cut == sorted(cut)
        assert sorted(out[group == g].tolist()) == sorted(suffixes[group == g].tolist())


def test_a_hash_that_lies_is_found_out(monkeypatch):
    rng = random.Random(4)
    data = np.frombuffer("".join(rng.choice("abc") for _ in range(3000)).encode(), dtype=np.uint8).copy()
    data[1000:1500] = data[0:500]
    suffixes = np.arange(0, 1600, 100)
    monkeypatch.setattr(suffix_dedup, "common_extension", lambda sums, a, b, most=400: np.full(len(a), most))
    found = suffix_dedup.repeated_suffixes(data, suffixes, np.zeros(len(suffixes), dtype=np.int64))
    assert suffixes[found].tolist() == [0, 100, 1000, 1100]


def test_quality_counts_equal_brute_force(spark, corpus):
    rng = random.Random(8)
    line = "the same line again and more words here"
    extra = [line + "\n" + line + "\r\n" + line, "a b c d e f g h " * 40, "\n\n\nx\n\nx\n x\nx", "| # a\n" * 30]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}") for i, t in enumerate([t for _, t in corpus] + extra)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = quality.judged_rows(docs.withColumn("kept", F.lit("clash")).withColumn("n_words", F.lit(1)))
    assert out.count() == len(rows)
    for r in out.collect():
        counts = R.quality_counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        assert r.base_failed == failed
        assert not (failed and r.kept)
    assert rng and quality.judged_rows(docs.limit(0)).count() == 0


def test_fences_follow_the_group_and_keep_clean_texts(spark):
    rng = random.Random(6)
    rows = [(i, " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(4, 7))) for _ in range(80)), "en", "short") for i in range(200)]
    rows += [(1000 + i, " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(14, 18))) for _ in range(80)), "de", "long") for i in range(200)]
    noisy = " ".join("".join(rng.choices("abcdefgh", k=5)) + "###" for _ in range(80))
    odd = " ".join("".join(rng.choices("abcdefgh", k=16)) for _ in range(80))
    rows += [(5000, noisy, "en", "short"), (5001, odd, "en", "short"), (5002, odd, "de", "long"), (5003, odd, "de", "few")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.judged_rows(docs).collect()}
    assert not kept[5000] and not kept[5001] and kept[5002] and kept[5003]  # a small source has its language's fences
    assert all(v for k, v in kept.items() if k < 5000)


def test_sketches_merge_in_any_order(spark):
    rows = [(i, "word " * (20 + i % 50), f"l{i % 2}", f"s{i % 3}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    one = quality.sketches(quality.measured(docs.coalesce(1)))
    many = quality.sketches(quality.measured(docs.repartition(7)))
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, many.collect()), key=str)
    whole = many.where("level = 0").groupBy("measure").agg(F.sum("n").alias("n")).collect()
    parts = many.where("level = 2").groupBy("measure").agg(F.sum("n").alias("n")).collect()
    assert {tuple(r) for r in whole} == {tuple(r) for r in parts}


def test_bins_are_within_a_thirty_second(spark):
    values = spark.range(0, 100_000, 7).select("id", quality.bin_of(F.col("id")).alias("bin")).toPandas()
    assert (values.bin <= values.id).all() and (values.id - values.bin <= values.id / 32).all()
    assert (values.bin[values.id < 64] == values.id[values.id < 64]).all()


def test_paragraph_dedup_equals_exact_classes(spark):
    rng = random.Random(9)
    passages = [prose(rng, rng.randrange(30, 90), 5000) for _ in range(25)]
    rows = []
    for i in range(80):
        lines = [prose(rng, rng.randrange(3, 60), 5000) for _ in range(rng.randrange(4))]
        for _ in range(rng.randrange(3)):
            lines.append(edited(rng, rng.choice(passages), rng.randrange(3)))
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "a short line\n" * 3), (104, passages[0] + "\r\n" + passages[0].upper())]
    found = {r.doc_id: r for r in paragraph_dedup.removed(frame(spark, rows)).collect()}
    at = [(i, n, line) for i, t in rows for n, line in enumerate((t or "").split("\n")) if len(R.WORD.findall(line)) >= 10]
    label = R.classes([R.shingle_set(line) for _, _, line in at])
    gone = {at[k][:2]: at[c][0] for k, c in enumerate(label) if c != k}
    for i, text in rows:
        lines = (text or "").split("\n")
        assert found[i].n_paragraphs == sum(a[0] == i for a in at)
        assert found[i].n_removed == sum((i, n) in gone for n in range(len(lines)))
        assert found[i].kept_text == "\n".join(line for n, line in enumerate(lines) if (i, n) not in gone)
        assert found[i].kept_docs == sorted({gone[i, n] for n in range(len(lines)) if (i, n) in gone})
    assert paragraph_dedup.removed(frame(spark, [])).count() == 0


def test_paragraph_dedup_removes_short_lines(spark):
    """Lines of five to nine words that repeat go, exact or alike; those of four words have no shingle."""
    rows = [(i, f"Read more on our own pages\nonly four words here\nown{i} line{i} with{i} six{i} words{i} {i}") for i in range(40)]
    rows += [(50, "one two three four five six seven eight"), (51, "one two three four five six seven eight nine")]
    rows += [(52, "READ MORE ON OUR OWN PAGES"), (None, "Read more on our own pages")]
    found = {r.doc_id: r for r in paragraph_dedup.removed(frame(spark, rows)).collect()}
    assert found[0].kept_text == rows[0][1] and found[50].kept_text == rows[40][1]
    for i in range(1, 40):
        assert found[i].kept_text == rows[i][1].split("\n", 1)[1]
        assert (found[i].n_paragraphs, found[i].n_short, found[i].n_removed, found[i].kept_docs) == (0, 2, 1, [0])
    for i, first in ((51, 50), (52, 0), (None, 0)):
        assert (found[i].kept_text, found[i].n_removed, found[i].kept_docs) == ("", 1, [first])


def test_paragraph_dedup_repeated_rows_clashing_columns_and_long_lines(spark):
    rng = random.Random(15)
    long = prose(rng, 40_000, 100_000)
    inside = prose(rng, 60)
    rows = [(1, "same line of five words", 1), (1, "same line of five words", 2), (2, long, 3), (3, edited(rng, long, 30), 4)]
    rows += [(4, f"{prose(rng, 80)} {inside} {prose(rng, 80)}", 5), (5, f"{prose(rng, 90)} {inside} {prose(rng, 70)}", 6)]
    docs = frame(spark, rows, "doc_id bigint, text string, n_removed int").withColumns({"line": F.lit(1), "cls": F.lit("c")})
    out = paragraph_dedup.removed(docs)
    assert out.columns == ["doc_id", "line", "cls", *paragraph_dedup.NEW]
    found = sorted((r.doc_id, r.n_paragraphs + r.n_short, r.n_removed, len(r.kept_text)) for r in out.collect())
    # The repeats of a row keep the first row's line; a passage inside of longer lines that are not alike stays.
    expected = [(1, 1, 0, 23)] * 2 + [(2, 1, 0, len(long)), (3, 1, 1, 0)] + [(i, 1, 0, len(t)) for i, t, _ in rows[4:]]
    assert found == expected


def passages(rows, size):
    """By brute force ``(id, text)`` -> words in windows of ``size`` words that several ids hold, and those of them to cut."""
    words = {i: [w.lower() for w in R.WORD.findall(t or "")] for i, t in rows}
    held = {}
    for i, own in words.items():
        for n in range(len(own) - size + 1):
            held.setdefault(tuple(own[n : n + size]), set()).add(i)
    found = {}
    for i, own in words.items():
        shared, cut = set(), set()
        for n in range(len(own) - size + 1):
            holders = held[tuple(own[n : n + size])]
            if len(holders) > 1:
                shared.update(range(n, n + size))
                if min(holders, key=lambda d: (d is None, d)) != i:
                    cut.update(range(n, n + size))
        found[i] = shared, cut
    return found


def test_paragraph_dedup_removes_passages_inside_lines(spark):
    rng = random.Random(21)
    inside = prose(rng, 60)
    rows = [(i, f"{prose(rng, 80)} {inside} {prose(rng, 70)}\nthe end") for i in range(3)]
    rows += [(9, f"{prose(rng, 30)} {' '.join(inside.split()[:49])} {prose(rng, 30)}")]  # 49 words are no passage
    found = {r.doc_id: r for r in paragraph_dedup.removed(frame(spark, rows), passage=50).collect()}
    assert [found[i].n_shared_words for i, _ in rows] == [60, 60, 60, 0]
    assert [found[i].n_cut_words for i, _ in rows] == [0, 60, 60, 0]
    assert [found[i].kept_docs for i, _ in rows] == [[], [0], [0], []]
    assert [found[i].kept_text for i, _ in rows] == [t if i in (0, 9) else t.replace(inside, "") for i, t in rows]


@pytest.mark.parametrize("size", [50, 12, 5])
def test_paragraph_dedup_passages_equal_brute_force(spark, size):
    rng = random.Random(23)
    pool = [prose(rng, rng.randrange(size, 4 * size), 5000) for _ in range(12)]
    pool += ["ab " * size * 2, "a b c " * size]
    rows = []
    for i in range(90):
        parts = [prose(rng, rng.randrange(4 * size), 5000) for _ in range(rng.randrange(3))]
        for _ in range(rng.randrange(4)):
            piece = edited(rng, rng.choice(pool), rng.randrange(3)).split(" ")
            low = rng.randrange(max(1, len(piece) - size))
            parts.append(rng.choice([" ", "\n", "  "]).join(piece[low : low + rng.randrange(size // 2, 3 * size)]))
        rng.shuffle(parts)
        rows.append((i, rng.choice([" ", "\n", "\t"]).join(parts)))
    rows += [(100, None), (101, ""), (None, rows[0][1].upper()), (102, " ".join(pool[:5])), (103, prose(rng, 40_000, 100_000))]
    rows += [(104, rows[-1][1])]
    found = {r.doc_id: r for r in paragraph_dedup.removed(frame(spark, rows), passage=size).collect()}
    plain = {r.doc_id: r for r in paragraph_dedup.removed(frame(spark, rows)).collect()}
    expected = passages(rows, size)
    assert any(cut and cut != shared for shared, cut in expected.values())
    for i, text in rows:
        shared, cut = expected[i]
        assert (found[i].n_shared_words, found[i].n_cut_words) == (len(shared), len(cut)), i
        assert found[i][1:4] == plain[i][1:4]  # lines are counted as before
        if found[i].n_removed == 0:
            own = R.WORD.findall(text or "")
            assert R.WORD.findall(found[i].kept_text) == [w for n, w in enumerate(own) if n not in cut]
            if not cut:
                assert found[i].kept_text == (text or "")


def test_passages_of_many_texts_are_cut_at_once(monkeypatch):
    """Texts with very many spans take as few steps as texts with one."""
    calls = []
    real = paragraph_dedup._covered
    monkeypatch.setattr(paragraph_dedup, "_covered", lambda *a: calls.append(1) or real(*a))
    rng = random.Random(21)
    texts = [None, "", *(prose(rng, rng.randrange(60, 300)) + "\n" + prose(rng, 20) for _ in range(40))]
    gone, spans = [], []
    for i, text in enumerate(texts):
        size = len((text or "").split())
        gone.append([{"line": 1, "kept_doc": 7}] if size and i % 3 == 0 else None)
        drawn = [] if size < 60 else [(rng.randrange(size - 60), rng.getrandbits(10) | 1, rng.random() < 0.5, rng.choice([None, 1, 2])) for _ in range(i)]
        spans.append([dict(zip(("low", "places", "gone", "kept_doc"), d)) for d in drawn] or None)
    kinds = [pa.struct([("line", pa.int32()), ("kept_doc", pa.int64())])]
    kinds += [pa.struct([("low", pa.int32()), ("places", pa.int64()), ("gone", pa.bool_()), ("kept_doc", pa.int64())])]
    lists = [pa.array(c, pa.list_(kind)) for c, kind in zip((gone, spans), kinds)]
    rows = pa.array([{"doc_id": i} for i in range(len(texts))])
    batch = pa.RecordBatch.from_arrays([rows, pa.array(texts), *lists], names=["row", "text", "gone", "spans"])
    found = [r for part in (batch, batch.slice(5, 9)) for b in paragraph_dedup._remove(50)(iter([part])) for r in b.to_pylist()]
    assert len(calls) <= 4
    for r in found:
        i = r["row"]["doc_id"]
        words, own = (texts[i] or "").split(), spans[i] or []
        shared, cut = ({s["low"] + k + w for s in part for k in range(10) if s["places"] >> k & 1 for w in range(50)} for part in (own, [s for s in own if s["gone"]]))
        lost = words.index(texts[i].split("\n")[1].split()[0], len(words) - 20) if gone[i] else len(words)
        assert (r["n_shared_words"], r["n_cut_words"], r["n_removed"]) == (len(shared), len(cut), len(gone[i] or []))
        assert r["kept_text"].split() == [w for n, w in enumerate(words) if n not in cut and n < lost]
        assert r["kept_docs"] == sorted({s["kept_doc"] for s in own if s["gone"]} - {None} | ({7} if gone[i] else set()))


def test_paragraph_dedup_leaves_no_signatures_behind(spark, monkeypatch):
    """Bands and stretches are several times the rest of what is stored; they go as soon as they have been used."""
    made = {}
    real = paragraph_dedup.stored
    monkeypatch.setattr(paragraph_dedup, "stored", lambda df, label: made.setdefault(label, real(df, label)))
    rng = random.Random(22)
    docs = frame(spark, [(i, prose(rng, 30) + "\nthe same line of six words") for i in range(6)])
    out = paragraph_dedup.removed(docs, passage=50)
    there = {label: any(Path(f.removeprefix("file:")).exists() for f in df.inputFiles()) for label, df in made.items()}
    assert not there["paragraphs"] and not there["paragraph-sets"] and there["lines"] and there["gone"]
    assert sorted((r.doc_id, r.n_removed) for r in out.collect()) == [(i, int(i > 0)) for i in range(6)]


def test_paragraph_dedup_passages_of_repeated_rows(spark):
    rng = random.Random(27)
    inside = prose(rng, 55)
    one, two = f"{prose(rng, 60)} {inside} {prose(rng, 70)}", f"{prose(rng, 80)} {inside} {prose(rng, 50)}"
    docs = frame(spark, [(None, one), (None, one), (None, two), (1, inside + "\n" + inside), (1, "x")])
    found = sorted((r.doc_id is None, r.n_shared_words, r.n_cut_words, len(r.kept_text)) for r in paragraph_dedup.removed(docs, passage=50).collect())
    cut = [(True, 55, 55, len(t) - len(inside)) for t in (one, one, two)]
    assert found == sorted([*cut, (False, 0, 0, 1), (False, 110, 0, len(inside))])  # its own repeat goes as a line


def test_jaccard_classes_with_clashing_columns(spark, corpus):
    docs = frame(spark, corpus[:40]).withColumns({"cls": F.lit(b"x"), "n": F.lit(1), "mark": F.lit(2), "id": F.lit(3)})
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(docs).collect()}
    assert found == R.jaccard_classes(corpus[:40])


def test_bands_are_tuned_to_the_recall():
    for rows in (1, 2, 3, 5):
        bands = paragraph_dedup.tune(rows=rows)
        assert 1 - (1 - 0.8**rows) ** bands >= 0.999 > 1 - (1 - 0.8**rows) ** (bands - 1)
