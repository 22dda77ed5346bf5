"""The raw catalogue tables derived from a star-schema data set, for queries, benches and tests on that data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per (customer, part): quantity scaled to 0.5..5.0, at the last ship date."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .groupBy(F.col("o_custkey").cast("int").alias("userId"), F.col("l_partkey").cast("int").alias("movieId"))
        .agg(
            F.max(F.ceil(F.col("l_quantity") / 5) / F.lit(2.0)).cast("double").alias("rating"),
            F.max("l_shipdate").cast("timestamp").alias("timestamp"),
        )
    )


def ratings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings(spark, sf_dir).withColumn("timestamp", F.unix_timestamp("timestamp"))


def movies_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names as titles, most of them with a year; type and brand as genres."""
    year = F.concat(F.lit(" ("), (F.col("p_size") + 1950).cast("string"), F.lit(")"))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("movieId"),
        F.concat("p_name", F.when(F.col("p_size") % 7 != 0, year).otherwise("")).alias("title"),
        F.concat_ws("|", "p_type", "p_brand").alias("genres"),
    )


def links_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key in ten missing, one in ten zero."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.cast("int").alias("movieId"),
        F.lpad((key + 100000).cast("string"), 8, "0").alias("imdbId"),
        F.when(key % 10 == 0, F.lit(None)).when(key % 10 == 1, F.lit(0)).otherwise(key).cast("int").alias("tmdbId"),
    )


def tags_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All text, one time in eleven malformed."""
    epoch = F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("userId"),
        (F.col("event_id") % 2000).cast("string").alias("movieId"),
        F.col("event_type").alias("tag"),
        F.when(F.col("event_id") % 11 == 0, "bad").otherwise(epoch).alias("timestamp"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tmdbId, payload): documents as JSON answers; one in nine without overview, and a budget beyond 32 bits."""
    key = F.col("doc_id")
    answer = F.struct(
        F.when(key % 9 != 0, F.col("text")).alias("overview"),
        F.concat(F.lit("/"), "source", F.lit(".jpg")).alias("poster_path"),
        (F.col("n_chars") * 10_000_000).alias("budget"),
        (F.col("n_chars") % 100 / 10).alias("vote_average"),
    )
    return table(spark, sf_dir, "documents").select(
        key.cast("int").alias("tmdbId"), F.to_json(answer).alias("payload")
    )


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(movieId, overview): document texts, one in nine empty."""
    key = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        key.cast("int").alias("movieId"), F.when(key % 9 == 0, "").otherwise(F.col("text")).alias("overview")
    )
