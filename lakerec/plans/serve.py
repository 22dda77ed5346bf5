"""Per-user serving queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerec import fixed


def recommendations_for(
    user_id: int, movies: DataFrame, recommendations: DataFrame, links: DataFrame, k: int = fixed.KEPT_PER_USER
) -> DataFrame:
    """imdbId, title, genres, year, score: the k best recommendations of a user, ties by movieId."""
    mine = recommendations.filter(F.col("userId") == F.lit(user_id))
    found = mine.join(movies, "movieId").join(links, "movieId")
    best = found.orderBy(F.col("score").desc(), F.col("movieId").asc()).limit(k)
    return best.select("imdbId", "title", "genres", "year", "score")


def history_of(user_id: int, ratings: DataFrame, movies: DataFrame, links: DataFrame) -> DataFrame:
    """imdbId, title, year, genres, rating, timestamp: all ratings of a user, newest first, ties by movieId."""
    mine = ratings.filter(F.col("userId") == F.lit(user_id))
    found = mine.join(movies, "movieId").join(links, "movieId")
    newest_first = found.orderBy(F.col("timestamp").desc(), F.col("movieId").asc())
    return newest_first.select("imdbId", "title", "year", "genres", "rating", "timestamp")
