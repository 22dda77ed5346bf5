"""Texts that meet no wanted key stay out of the shuffles of the pair operators."""

import pytest
from pyspark.sql import functions as F

from lakerec.llm import chosen_path, narrow, ngram_join, paragraph_dedup
from lakerec.session import stored


@pytest.mark.parametrize("words", [1 << 20, 64])
def test_no_wanted_key_is_left_out(spark, monkeypatch, words):
    monkeypatch.setattr(narrow, "WORDS", words)
    rows = spark.range(20_000).select(F.when(F.col("id") > 9, F.col("id")).alias("id"), F.col("id").alias("mark"))
    wanted = stored(rows.where("mark % 50 = 3").select(F.col("id").alias("i"), F.col("mark").alias("m")), "wanted")
    keys = [F.col("id"), F.col("mark")], wanted, [F.col("i"), F.col("m")]
    met = {r.mark for r in narrow.meeting(rows, *keys).collect()}
    assert met >= set(range(3, 20_000, 50))
    assert len(met) < (20_000 * 3 // 25 if words > 64 else 3_000)
    split = narrow.marked(rows, *keys).groupBy("__met").count().collect()
    assert {r["__met"]: r["count"] for r in split} == {True: len(met), False: 20_000 - len(met)}
    assert narrow.meeting(rows, *keys[:1], wanted.where("false"), keys[2]).count() == 0


def shuffled_texts(plan: str) -> bool:
    """Whether all texts go into an exchange without having met the bitmap."""
    return "BroadcastHashJoin [__at" not in plan


def test_only_texts_that_may_be_wanted_are_shuffled(spark, conf, plan, monkeypatch):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    base = " ".join(f"w{i}" for i in range(60))
    lines = [(i, f"own{i} line{i} with{i} six{i} words{i} {i}\n" + (base if i % 5 == 0 else "")) for i in range(40)]
    docs = spark.createDataFrame(lines, "doc_id bigint, text string")
    plans = {}

    def noted(df, label):
        plans[label] = plan(df)
        return stored(df, label)

    for module in (ngram_join, chosen_path, paragraph_dedup):
        monkeypatch.setattr(module, "stored", noted)
    ngram_join.jaccard_classes(docs).collect()
    assert not shuffled_texts(plans["sets"])
    plans.clear()
    chosen_path.near_duplicates(docs).collect()
    assert not shuffled_texts(plans["sets"])
    out = paragraph_dedup.removed(docs)
    assert not shuffled_texts(plans["paragraph-shingles"]) and not shuffled_texts(plan(out))
    kept = {r.doc_id: (r.n_removed, r.kept_docs) for r in out.collect()}
    assert kept == {i: (1, [0]) if i % 5 == 0 and i else (0, []) for i in range(40)}
