"""Near-duplicates by chosen paths, spelling variants and hard negatives against brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
import reference as R
from pyspark.sql import functions as F

from lakerec.llm import chosen_path, hard_negatives, spelling
from lakerec.session import stored


def prose(rng, words, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def edited(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
    return " ".join(words)


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


# --- near-duplicates -------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    texts = [None, "", " \n\t ", "one", "ONE", "one two three", "One two THREE", "a\x0bb\x0cc d e", "É é ß 日本 x y z"]
    for _ in range(15):
        base = prose(rng, rng.randrange(20, 160))
        texts += [base] + [edited(rng, base, rng.randrange(1, 5)) for _ in range(rng.randrange(5))]
    hot = prose(rng, 150)  # a group of near copies with a third of all rows
    texts += [edited(rng, hot, rng.randrange(1, 7)) for _ in range(45)]
    line = prose(rng, 30)  # a line that many share, in texts that are not alike
    texts += [prose(rng, 60) + "\n" + line for _ in range(30)]
    texts += [prose(rng, 30_000, 100_000), "z " * 5000] + [texts[12]] * 3
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("limits", [None, (5, 2, 2000, 1)])
def test_chosen_paths_equal_brute_force(spark, corpus, monkeypatch, limits):
    """Nodes of few sets: parts with hubs, branching, and each part with each part where the depth ends."""
    if limits:
        monkeypatch.setattr(chosen_path, "NODE_SETS", limits[0])
        monkeypatch.setattr(chosen_path, "DEPTH", limits[1])
        monkeypatch.setattr(chosen_path, "NODE_SHINGLES", limits[2])
        monkeypatch.setattr(chosen_path, "WHOLE_PARTS", limits[3])
    found = chosen_path.near_duplicates(frame(spark, corpus)).collect()
    sets = [R.shingle_set(text, 4) for _, text in corpus]
    label = R.classes(sets)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == [(i, len(sets[i]), label[i]) for i in range(len(sets))]
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_chosen_paths_threshold_nulls_repeats_and_clashing_columns(spark):
    words = [f"w{i}" for i in range(12)]  # 9 shingles
    rows = [(1, " ".join(words)), (2, " ".join(words[:-1] + ["y"])), (3, " ".join(words[:-2] + ["y", "z"]))]
    rows += [(5, "q r s t u"), (5, "Q r s t u"), (None, "q r s t u"), (None, "n o n e h"), (None, None), (9, ""), (5, "other text of five words")]
    docs = frame(spark, rows).withColumns({"cls": F.lit(1), "n": F.lit(2), "class": F.lit("c"), "kept": F.lit(True)})
    found = chosen_path.near_duplicates(docs).collect()
    key = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found), key=str)
    expected = [(1, 9, 1, True), (2, 9, 1, False), (3, 9, 3, True)]  # 8 of 10 links, 7 of 11 does not
    expected += [(5, 2, 5, True), (5, 2, 5, True), (None, 2, 5, False), (None, 2, None, True), (None, 0, None, True), (9, 0, 9, True), (5, 2, 5, True)]
    assert key == sorted(expected, key=str)
    assert chosen_path.near_duplicates(frame(spark, [])).count() == 0


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(5)
    agreed = []
    for _ in range(200):
        own = rng.integers(0, 2**63, 900).astype(np.uint64)
        a, b = own[:800], np.concatenate([own[:711], own[800:889]])  # 711 of 889
        agreed.append((np.diff(chosen_path.sketches([a, b]).astype(np.int64), axis=0) == 0).sum())
    assert abs(np.mean(agreed) / chosen_path.COORDINATES - 711 / 889) < 0.02 and min(agreed) >= chosen_path.LEAST_AGREEING


def test_a_node_draws_different_coordinates():
    drawn = chosen_path.drawn(np.arange(10_000, dtype=np.uint64))
    assert (drawn[:, 0] != drawn[:, 1]).all() and set(np.unique(drawn)) == set(range(chosen_path.COORDINATES))


# --- spelling variants -----------------------------------------------------------------------------------------------


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def variants(counts):
    result = {}
    for word, n in counts.items():
        near = [w for w in counts if one_edit(word, w)]
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        form = best if best is not None and counts[best] >= 10 * n else None
        result[word] = (n, len(near), form, counts[form] if form else None)
    roots = {}
    for word in result:
        root = word
        while result[root][2]:
            root = result[root][2]
        roots[word] = root
    return {w: (*r, roots[w]) for w, r in result.items()}


def word_counts(rows, deleting):
    letters = {*"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", *map(chr, range(0xC0, 0x100))}
    found = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if c in letters:
                run += c
                continue
            word = run.translate(R.LOWER)
            run = ""
            if deleting and word:
                h = zlib.crc32(f"{doc_id}:{word}".encode())
                if h % 31 == 0:
                    word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 7:
                found[word] += 1
    return {w: n for w, n in found.items() if n >= 2}


def spelt(found):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in found}


@pytest.fixture(scope="module")
def spellings():
    rng = random.Random(12)
    base = ["".join(rng.choice("abcdeéÀ") for _ in range(rng.randrange(7, 11))) for _ in range(60)]
    texts = []
    for _ in range(300):
        words = []
        for _ in range(30):
            word = base[min(int(rng.expovariate(0.2)), 59)]
            if rng.random() < 0.1:
                i = rng.randrange(len(word))
                word = rng.choice([word[:i] + word[i + 1 :], word[:i] + rng.choice("abÉ") + word[i + 1 :], word[:i] + "x" + word[i:]])
            words.append(word.upper() if rng.random() < 0.1 else word)
        texts.append(rng.choice([" ", "-", "1", "日"]).join(words))
    long = "ab" * 3000
    texts += [None, "", long + " " + long, "c" + long, long + "c", "×÷×÷×÷× ×÷×÷×÷×", "abcdefg abcdefg bacdefg bacdefg abcdef"]
    return list(enumerate(texts))


@pytest.mark.parametrize("deleting", [False, True])
@pytest.mark.parametrize("leaf", [None, 15])
def test_spelling_variants_equal_brute_force(spark, spellings, monkeypatch, deleting, leaf):
    if leaf:
        monkeypatch.setattr(spelling, "LEAF_WORDS", leaf)
    found = spelling.spelling_variants(frame(spark, spellings), deleting).collect()
    assert spelt(found) == variants(word_counts(spellings, deleting)) and len(found) > 100


def test_spelling_roots_follow_chains_and_ties_take_the_least(spark):
    counts = {"abcdefg": 2000, "abcdefgh": 100, "abcdefghi": 10, "abcdefghij": 1, "bbbbbbb": 1, "bbbbbba": 30, "bbbbbbc": 30, "qqqqqqq": 5}
    words = stored(frame(spark, list(counts.items()), "word string, n bigint"), "words")
    found = spelt(spelling.variant_groups(words).collect())
    assert found == variants(counts)
    assert found["abcdefghij"][-1] == "abcdefg" and found["bbbbbbb"][2] == "bbbbbba" and found["qqqqqqq"][2] is None


def test_spelling_rows_without_words_ids_or_with_more_columns(spark):
    assert spelling.spelling_variants(frame(spark, [])).count() == 0
    assert spelling.spelling_variants(frame(spark, [(1, None), (2, ""), (None, "short words only")])).count() == 0
    rows = [(7, "Wordlike wordlike"), (7, "Wordlike wordlike"), (None, "wordlika wordlika")]
    docs = frame(spark, rows).withColumns({"word": F.lit("x"), "n": F.lit(1), "form": F.lit("y")})
    assert spelt(spelling.spelling_variants(docs).collect()) == {"wordlike": (4, 1, None, None, "wordlike"), "wordlika": (2, 1, None, None, "wordlika")}


def test_lower_tree_finds_all_within():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abcdefgé") for _ in range(9)) for _ in range(3000)})
    tree = spelling.LowerTree(words, [1] * len(words))
    points = spelling.vectors(words)
    found = {(a, b) for p, w in tree.within(points[:200], 2) for a, b in zip(p.tolist(), w.tolist())}
    apart = np.bitwise_count(points[:200, None] ^ points[None, :])
    assert found == set(zip(*(x.tolist() for x in np.nonzero(apart <= 2))))


# --- hard negatives --------------------------------------------------------------------------------------------------


def hard(rows, anchors, k=5, negatives=10):
    """Brute force over ``{vec_id: (label, [int])}``."""
    result = set()
    for a in anchors:
        label, mine = rows[a]
        scores = {i: sum(x * y for x, y in zip(mine, v)) for i, (_, v) in rows.items() if i != a and len(v) == len(mine)}
        order = sorted(scores, key=lambda i: (-scores[i], i))
        for p in [i for i in order if rows[i][0] == label][:k]:
            fits = [i for i in order if rows[i][0] != label and 30 * scores[p] <= 100 * scores[i] <= 90 * scores[p]]
            result |= {(a, p, r, i, scores[p], scores[i]) for r, i in enumerate(fits[:negatives], 1)}
    return result


def units(vector):
    return [int(np.floor(256 * float(x))) for x in vector]


@pytest.mark.parametrize("sizes", [None, (40, 3, 16)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, sizes):
    """A third of the rows has one label, and one vector stands under many ids."""
    if sizes:
        monkeypatch.setattr(hard_negatives, "ROWS", sizes[0])
        monkeypatch.setattr(hard_negatives, "ANCHORS", sizes[1])
    rng = np.random.default_rng(13)
    centres = rng.standard_normal((6, 12))
    rows = {}
    for i in range(700):
        vector = (centres[i % 6] + rng.standard_normal(12) * rng.choice([0.1, 1])).astype(np.float32)
        rows[i] = (int(0 if i % 3 == 0 else rng.integers(5)), vector.tolist())
    for i in range(700, 760):
        rows[i] = (int(i % 2), [0.5] * 12)
    rows[760], rows[761] = (1, [0.0] * 12), (1, [-0.001] * 12)
    frame_ = frame(spark, [(i, l, v) for i, (l, v) in rows.items()], "vec_id bigint, label int, vector array<float>")
    found = hard_negatives.mined(frame_, F.col("vec_id") % 20 == 0).collect()
    expected = hard({i: (l, units(v)) for i, (l, v) in rows.items()}, range(0, 762, 20))
    assert {tuple(r) for r in found} == expected and len(found) == len(expected) > 500


def test_hard_negatives_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.1]), (2, 2, [0.6, 0.1]), (2, 2, [0.6, 0.1]), (2, 3, [0.7, 0.0]), (3, None, [0.5, 0.5])]
    rows += [(4, 2, None), (5, 2, [0.5, None]), (6, 2, [0.5, nan]), (7, 2, [0.5, inf]), (None, 2, [0.5, 0.0]), (8, 2, [0.5, 0.5, 0.5])]
    rows += [(9, 2, []), (10, 2, [0.3, 0.0]), (11, 2, [0.9, 0.0]), (12, 2, [0.91, 0.0])]
    schema = "vec_id bigint, label int, vector array<double>"
    docs = frame(spark, rows, schema).withColumns({"score": F.lit(1), "rank": F.lit(2), "units": F.lit(3)})
    kept = {0: (1, [256, 0]), 1: (1, [256, 25]), 2: (2, [153, 25]), 8: (2, [128] * 3), 10: (2, [76, 0]), 11: (2, [230, 0]), 12: (2, [232, 0])}
    found = hard_negatives.mined(docs, F.col("vec_id") == 0)
    assert {tuple(r) for r in found.collect()} == hard(kept, [0])
    assert hard_negatives.mined(frame(spark, [], schema), F.col("vec_id") == 0).count() == 0
    assert hard_negatives.mined(docs, F.col("vec_id") == 99).count() == 0


def test_hard_negatives_beyond_double_precision(spark):
    big = 2.0**22
    rows = [(0, 1, [big, 1.0]), (1, 1, [big, 3.0]), (2, 2, [big / 2, 5.0]), (3, 2, [big / 2, 6.0])]
    found = hard_negatives.mined(frame(spark, rows, "vec_id bigint, label int, vector array<double>"), F.col("vec_id") == 0)
    assert {tuple(r) for r in found.collect()} == hard({i: (l, units(v)) for i, l, v in rows}, [0])


def test_score_bounds_hold():
    rng = np.random.default_rng(3)
    a, b = (np.round(rng.standard_normal((300, 6)) * rng.choice([1, 1000], (300, 1))) for _ in range(2))
    b[:50] = a[:50] * 3
    b[50:100] = -a[50:100]
    references = hard_negatives.directions(a, 4)
    na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    to_a, to_b = hard_negatives.angles(a, na, references), hard_negatives.angles(b, nb, references)
    cosines = hard_negatives.cosine_interval(to_a, to_a, to_b, to_b)
    low, high = hard_negatives.score_bounds(cosines, na * nb, na * nb)
    scores = (a * b).sum(axis=1)
    assert (low <= scores).all() and (scores <= high).all()
    box = to_b.min(axis=0), to_b.max(axis=0)
    low, high = hard_negatives.score_bounds(hard_negatives.cosine_interval(to_a, to_a, *box), na * nb.min(), na * nb.max())
    every = a @ b.T
    assert (low[:, None] <= every).all() and (every <= high[:, None]).all()
