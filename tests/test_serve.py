import datetime

from pyspark.sql import functions as F

from lakerec.plans import serve
from lakerec.sources.tables import overwrite_table

MOVIES = "movieId int, title string, genres array<string>, year int"
LINKS = "movieId int, imdbId string, tmdbId int"


def catalogue(spark, n=30):
    movies = spark.createDataFrame([(m, f"t{m}", ["A"], 1990) for m in range(n)], MOVIES)
    links = spark.createDataFrame([(m, f"{m:07d}", m) for m in range(n) if m != 4], LINKS)
    return movies, links


def test_recommendations_for_a_user(spark, plan):
    movies, links = catalogue(spark)
    recs = spark.createDataFrame([(u, m, 1.0 + m // 2) for u in (1, 2) for m in range(15)], "userId int, movieId int, score double")
    found = serve.recommendations_for(2, movies, recs, links)
    assert found.columns == ["imdbId", "title", "genres", "year", "score"]
    assert [r.title for r in found.collect()] == [f"t{m}" for m in (14, 12, 13, 10, 11, 8, 9, 6, 7, 5)]
    assert "TakeOrderedAndProject" in plan(found)


def test_history_of_a_user(spark):
    movies, links = catalogue(spark)
    day = datetime.datetime(2020, 1, 1)
    rows = [(u, m, 3.0, day + datetime.timedelta(days=m // 3)) for u in (1, 2) for m in range(12)]
    ratings = spark.createDataFrame(rows, "userId int, movieId int, rating double, timestamp timestamp")
    found = serve.history_of(1, ratings, movies, links)
    assert found.columns == ["imdbId", "title", "year", "genres", "rating", "timestamp"]
    assert [r.title for r in found.collect()] == [f"t{m}" for m in (9, 10, 11, 6, 7, 8, 3, 5, 0, 1, 2)]


def test_the_user_filter_and_the_columns_reach_the_scan(spark, plan):
    movies, links = catalogue(spark)
    ratings = spark.range(100).select(
        (F.col("id") % 7).cast("int").alias("userId"),
        (F.col("id") % 30).cast("int").alias("movieId"),
        F.lit(1.0).alias("rating"),
        F.current_timestamp().alias("timestamp"),
        F.lit("unused").alias("note"),
    )
    stored = overwrite_table(ratings, "t_serve.ratings", cluster_by=("userId", "movieId"))
    found = serve.history_of(3, stored, movies, links)
    scan = next(line for line in plan(found).splitlines() if "t_serve" in line)
    assert "EqualTo(userId,3)" in scan and "note" not in scan
