"""A training corpus from ``documents``: five stages, each written as Parquet and read again by the next.

Each stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of ``documents``; ``n_chars`` follows a
changed text. SQL can express neither the suffix sort nor BPE, so there is no oracle; the stages are tested against
brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerec.llm import bpe, mixing, ngram_join, quality, suffix_dedup
from lakerec.llm.queries import vocabulary
from lakerec.session import new_scratch, scratch_scope

ORACLE_SQL = None
REPEAT_BYTES = 240  # a passage of fifty words is rarely shorter


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fences of their language and source."""
    rows = quality.judged_rows(docs)
    return rows.where("kept").select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies one row; documents without words all stay."""
    return ngram_join.kept_rows(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the byte strings that occur elsewhere cut out of its text."""
    cut = suffix_dedup.removed(docs, span=REPEAT_BYTES, gram=REPEAT_BYTES * 2 // 5)
    cut = cut.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.length("kept_text").cast("bigint"))
    return cut.select(*docs.columns)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    mix = mixing.mixed(mixing.sized(docs)).where("copies > 0")
    return mix.withColumn("__copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*docs.columns)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids`` of every document of the mix."""
    coded = bpe.encoded(docs.select("doc_id", "lang", "source", "text"), vocabulary())
    return coded.withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("suffix-array dedup", suffix_array_dedup),
    ("mixing sources to target weights", mixing_sources),
    ("BPE encoding and decoding", bpe_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_scratch(spark, name.replace(" ", "-"))
        with scratch_scope(spark):  # what a stage stores on its way goes when its result is written
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
