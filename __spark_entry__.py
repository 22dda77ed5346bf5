
from __future__ import annotations

import json
import sys
from collections.abc import Callable
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakerec import fixed
from lakerec.functions.scores import similarity_percent
from lakerec.functions.vectors import cosine_similarity, norm
from lakerec.operators import als, embed, matching, ranking, silver
from lakerec.operators.payloads import with_json_fields
from lakerec.operators.profile import profile
from lakerec.operators.upsert import fold_batch, upsert
from lakerec.plans import jobs, serve
from lakerec.plans.ledger import refresh_changed
from lakerec.session import new_scratch, stored
from lakerec.sources import files, lookup, proxies
from lakerec.sources.proxies import table
from lakerec.sources.tables import ensure_namespace, overwrite_table

try:  # the operators of training-data pipelines can be taken out as a whole
    import corpus_pipeline
    from lakerec.llm.queries import ORACLES as LLM_ORACLES
    from lakerec.llm.queries import QUERIES as LLM_QUERIES
except ImportError:
    LLM_QUERIES, LLM_ORACLES = {}, {}
else:
    LLM_QUERIES = {**LLM_QUERIES, "pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL:
        LLM_ORACLES = {**LLM_ORACLES, "pipeline": corpus_pipeline.ORACLE_SQL}

Query = Callable[[SparkSession, str], DataFrame]

SERVED_USER = 1


def _zoneless(df: DataFrame) -> DataFrame:
    """``timestamp`` as the zone-free type the SQL side has."""
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


# --- scans, landing, sinks -------------------------------------------------------------------------------------------


def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = new_scratch(spark, "movies.csv")
    files.write_csv(proxies.movies_raw(spark, sf), path)
    return files.read_csv(spark, path, files.MOVIES_SCHEMA)


def csv_multiline_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = new_scratch(spark, "documents.csv")
    files.write_csv(table(spark, sf, "documents").select("doc_id", "text", "lang"), path)
    return files.read_csv(spark, path, multi_line=True)


def _raw(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "movies": proxies.movies_raw(spark, sf),
        "ratings": proxies.ratings_raw(spark, sf),
        "tags": proxies.tags_raw(spark, sf),
        "links": proxies.links_raw(spark, sf),
    }


def bronze_landing(spark: SparkSession, sf: str) -> DataFrame:
    """The four raw tables as nested folders of CSV parts, landed under their names, and every landed value as text."""
    source, target = new_scratch(spark, "download"), new_scratch(spark, "landed")
    for name, df in _raw(spark, sf).items():
        files.write_csv(df, f"{source}/set/{name}.csv")
    files.land_csv(spark, source, target)

    def landed(name: str, columns: list[str]) -> DataFrame:
        rows = files.read_csv(spark, f"{target}/{name}.csv", multi_line=name == "tags")
        values = [F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]
        return rows.select(F.lit(name).alias("table"), *values, *[F.lit(None).cast("string").alias(f"c{i}") for i in range(len(columns), 4)])

    return reduce(DataFrame.unionByName, [landed(name, df.columns) for name, df in _raw(spark, sf).items()])


def overwrite_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    place = new_scratch(spark, "roundtrip")
    name = f"{place.rpartition('/')[2].replace('-', '_')}.movies"
    ensure_namespace(spark, name, place)
    raw = proxies.movies_raw(spark, sf)
    overwrite_table(raw, name)  # replaced below, schema included
    return overwrite_table(silver.movies(raw).drop("genres"), name, cluster_by=("movieId",))


def profile_table(spark: SparkSession, sf: str) -> DataFrame:
    def one(name: str, df: DataFrame) -> DataFrame:
        seen = profile(df, exact=True)
        return seen.select(F.lit(name).alias("table"), "column", "rows", "nulls", "distinct", "min", "max")

    silver_ratings = _zoneless(stored(proxies.ratings(spark, sf), "ratings"))
    silver_tags = _zoneless(silver.tags(proxies.tags_raw(spark, sf)))
    return reduce(
        DataFrame.unionByName,
        [
            one("movies", silver.movies(proxies.movies_raw(spark, sf))),
            one("ratings", silver_ratings),
            one("tags", silver_tags),
            one("links", silver.links(proxies.links_raw(spark, sf))),
        ],
    )


def upsert_partial(spark: SparkSession, sf: str) -> DataFrame:
    base = table(spark, sf, "part").select(
        F.col("p_partkey").cast("int").alias("movieId"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("genres"),
        F.col("p_brand").alias("overview"),
        F.array(F.col("p_retailprice").cast("float")).alias("embedding"),
    )
    updates = table(spark, sf, "events").select(
        (F.col("user_id") * 20).cast("int").alias("movieId"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("title"),
        F.col("event_type").alias("genres"),
        F.col("props").alias("overview"),
        F.array(F.col("value").cast("float")).alias("embedding"),
        "event_id",
    )
    batch = stored(fold_batch(updates, "movieId", ["embedding", "overview"], "event_id"), "batch")
    merged = upsert(base, batch)
    return merged.withColumn("embedding", F.col("embedding")[0].cast("double"))


# --- silver ----------------------------------------------------------------------------------------------------------


def movies_silver(spark: SparkSession, sf: str) -> DataFrame:
    return silver.movies(proxies.movies_raw(spark, sf)).withColumn("genres", F.to_json("genres"))


def ratings_silver(spark: SparkSession, sf: str) -> DataFrame:
    return _zoneless(silver.ratings(proxies.ratings_raw(spark, sf)))


def tags_silver(spark: SparkSession, sf: str) -> DataFrame:
    return _zoneless(silver.tags(proxies.tags_raw(spark, sf)))


def links_silver(spark: SparkSession, sf: str) -> DataFrame:
    return silver.links(proxies.links_raw(spark, sf))


# --- freshness, popularity, fairness ---------------------------------------------------------------------------------


def decay_rating(spark: SparkSession, sf: str) -> DataFrame:
    fresh = ranking.with_freshness(stored(proxies.ratings(spark, sf), "ratings"))
    return _zoneless(fresh).withColumn("days_old", F.col("days_old").cast("bigint"))


def item_popularity(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.item_popularity(proxies.ratings(spark, sf))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """Plain ratings in the place of model scores, so that SQL can follow."""
    ratings = stored(proxies.ratings(spark, sf), "ratings")
    candidates = ratings.select("userId", "movieId", F.col("rating").alias("als_score"))
    scored = ranking.with_fairness(candidates, stored(ranking.item_popularity(ratings), "popularity"))
    return scored.withColumn("fairness_score", F.round("fairness_score", 6))


def fair_score(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select("userId", "movieId", "als_score", "num_ratings", "fairness_score")


def fair_topk(spark: SparkSession, sf: str) -> DataFrame:
    best = ranking.top_per_user(_scored(spark, sf))
    return best.select("userId", "movieId", F.col("fairness_score").alias("score"), F.col("rank").cast("bigint"))


def explode_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.explode_candidates(ranking.pack_candidates(proxies.ratings(spark, sf), "rating"))


# --- factorisation ---------------------------------------------------------------------------------------------------


def als_candidates(spark: SparkSession, sf: str) -> DataFrame:
    ratings = stored(proxies.ratings(spark, sf), "ratings")  # read several times, as the silver table is
    return als.recommend_for_all_users(als.factorise(ranking.with_freshness(ratings)))


def recommend_gold(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.recommend(stored(proxies.ratings(spark, sf), "ratings"))


def als_rank_one(spark: SparkSession, sf: str) -> DataFrame:
    """At rank 1 every start factor is 1 and a half step is one quotient, so SQL can follow three iterations."""
    ratings = stored(proxies.ratings(spark, sf), "ratings")
    factors = als.factorise(ranking.with_freshness(ratings), rank=1, max_iter=3)

    def side(name: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(name).alias("side"), "id", F.round(F.col("features")[0].cast("double"), 3).alias("factor"))

    return side("user", factors.users).union(side("item", factors.items))


def als_rank_two(spark: SparkSession, sf: str) -> DataFrame:
    """At rank 2 a half step has a closed form by cases of sign, so SQL can follow two iterations from a given start."""
    ratings = stored(proxies.ratings(spark, sf), "ratings")
    users = ratings.select(F.col("userId").alias("id")).distinct()
    features = F.array((F.col("id") % 7 + 1) / 8, (F.col("id") % 5) / 4)
    factors = als.factorise(ranking.with_freshness(ratings), rank=2, max_iter=2, start=users.withColumn("features", features))

    def side(name: str, df: DataFrame) -> DataFrame:
        both = [F.round(F.col("features")[k].cast("double"), 3).alias(c) for k, c in enumerate(("first", "second"))]
        return df.select(F.lit(name).alias("side"), "id", *both)

    return side("user", factors.users).union(side("item", factors.items))


def recommend_rank_one(spark: SparkSession, sf: str) -> DataFrame:
    """The whole gold job at rank 1: the ten scores of every user, best first."""
    best = jobs.recommend(stored(proxies.ratings(spark, sf), "ratings"), rank=1, max_iter=3)
    place = F.expr("row_number() over (partition by userId order by score desc)").cast("bigint")
    return best.select("userId", place.alias("place"), F.round("score", 3).alias("score"))


# --- serving ---------------------------------------------------------------------------------------------------------


def serve_recs(spark: SparkSession, sf: str) -> DataFrame:
    movies = silver.movies(proxies.movies_raw(spark, sf)).withColumn("genres", F.to_json("genres"))
    return serve.recommendations_for(SERVED_USER, movies, fair_topk(spark, sf), proxies.links_raw(spark, sf))


def serve_history(spark: SparkSession, sf: str) -> DataFrame:
    movies = silver.movies(proxies.movies_raw(spark, sf)).withColumn("genres", F.to_json("genres"))
    history = serve.history_of(SERVED_USER, proxies.ratings(spark, sf), movies, proxies.links_raw(spark, sf))
    return _zoneless(history)


# --- enrichment ------------------------------------------------------------------------------------------------------


def links_resolvable(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.resolvable(proxies.links_raw(spark, sf))


def links_first_500(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.resolvable(proxies.links_raw(spark, sf), limit=500)


def enrich_lookup(spark: SparkSession, sf: str) -> DataFrame:
    keys = lookup.resolvable(proxies.links_raw(spark, sf))
    return lookup.details(lookup.captured_payloads(keys, proxies.payloads(spark, sf)))


def _client_factory() -> lookup.Client:
    """A deterministic service: one key in seven fails on the way, one in five is unknown."""

    def client(key: int) -> str | None:
        if key % 7 == 0:
            raise OSError("unreachable")
        return None if key % 5 == 0 else json.dumps({"overview": f"story {key}", "budget": key * 10_000_000})

    return client


def enrich_fetch(spark: SparkSession, sf: str) -> DataFrame:
    keys = lookup.resolvable(proxies.links_raw(spark, sf))
    payloads = stored(lookup.fetch_payloads(keys, _client_factory, clients=4, min_interval_s=0.0), "payloads")
    return lookup.details(payloads)


class _StepClock(lookup.Clock):
    """Time that passes only by waiting and by calls, in whole sixteenths of a second."""

    def __init__(self):
        self.time = 0.0

    def now(self) -> float:
        return self.time

    def sleep(self, seconds: float) -> None:
        self.time += seconds


def _slow_client(clock: lookup.Clock) -> lookup.Client:
    def client(key: int) -> str | None:
        clock.sleep((key % 4) / 16)  # up to 0.1875 s
        return None

    return client


def enrich_pacing(spark: SparkSession, sf: str) -> DataFrame:
    """The schedule of all calls: how many, by how many clients, the least and the longest gap, and calls out of time."""
    keys = lookup.resolvable(proxies.links_raw(spark, sf))
    calls = stored(lookup.fetch_calls(keys, _slow_client, clients=4, min_interval_s=0.125, clock_factory=_StepClock), "calls")
    order = Window.partitionBy("client").orderBy("called_at")
    took = F.greatest(F.lit(0.125), F.lag(F.col("tmdbId") % 4 / 16).over(order))
    gaps = calls.select("client", (F.col("called_at") - F.lag("called_at").over(order)).alias("gap"), took.alias("due"))
    return gaps.agg(
        F.count("*").alias("calls"), F.count_distinct("client").alias("clients"), F.min("gap").alias("least_gap"),
        F.max("gap").alias("most_gap"), F.count_if(F.col("gap") != F.col("due")).alias("off_schedule"),
    )


def json_defaults(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "props")
    return with_json_fields(events, "props", {"k": -1, **fixed.DETAIL_DEFAULTS})


# --- vectors ---------------------------------------------------------------------------------------------------------


def _exemplars(spark: SparkSession, sf: str) -> DataFrame:
    """One vector per label, that of its lowest id; reduced before the shuffle."""
    vectors = table(spark, sf, "embeddings")
    return stored(vectors.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("exemplar")), "exemplars")


def cosine_to_exemplar(spark: SparkSession, sf: str) -> DataFrame:
    pairs = table(spark, sf, "embeddings").join(_exemplars(spark, sf), "label")
    similarity = cosine_similarity(F.col("embedding"), F.col("exemplar"))
    return pairs.select("vec_id", "label", similarity.alias("similarity"))


def cosine(spark: SparkSession, sf: str) -> DataFrame:
    return cosine_to_exemplar(spark, sf).withColumn("similarity", F.round("similarity", 6) + F.lit(0.0))


def percent(spark: SparkSession, sf: str) -> DataFrame:
    return cosine_to_exemplar(spark, sf).select("vec_id", similarity_percent(F.col("similarity")).alias("percent"))


def knn_single(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").withColumnRenamed("vec_id", "movieId")
    query = vectors.agg(F.min_by("embedding", "movieId")).first()[0]  # one vector, as a caller would pass it
    found = matching.nearest(vectors, query)
    return found.select("movieId", "label", (F.round("similarity", 6) + F.lit(0.0)).alias("similarity"))


def knn_batch(spark: SparkSession, sf: str) -> DataFrame:
    queries = _exemplars(spark, sf).select(F.col("label").alias("query_id"), F.col("exemplar").alias("embedding"))
    vectors = table(spark, sf, "embeddings").withColumnRenamed("vec_id", "movieId")
    found = jobs.search_many(vectors, queries, dim=64)
    return found.select(
        "query_id",
        "movieId",
        (F.round("similarity", 6) + F.lit(0.0)).alias("similarity"),
        F.col("rank").cast("bigint").alias("rank"),
    )


# --- text embedding and semantic search ------------------------------------------------------------------------------


def _input(spark: SparkSession, sf: str) -> DataFrame:
    return embed.embedding_input(silver.movies(proxies.movies_raw(spark, sf)), proxies.details(spark, sf))


def embedding_input(spark: SparkSession, sf: str) -> DataFrame:
    return _input(spark, sf).select("movieId", "title", "overview")


def embedding_context(spark: SparkSession, sf: str) -> DataFrame:
    return embed.with_context(_input(spark, sf)).select("movieId", "context")


def embed_documents(spark: SparkSession, sf: str) -> DataFrame:
    texts = embed.spread(table(spark, sf, "documents").select("doc_id", F.col("text").alias("context")))
    vectors = embed.embed_with_model(embed.fit_text_model(texts), texts)
    return vectors.select(
        "doc_id", F.size("embedding").cast("bigint").alias("dim"), F.round(norm(F.col("embedding")), 5).alias("norm")
    )


def _search_all(spark: SparkSession, sf: str, embedded: Callable[[DataFrame], DataFrame], rows: DataFrame, dim: int) -> DataFrame:
    """Every benchmark passage as a query text against all described entries."""
    vectors = stored(embedded(rows).select("movieId", "title", F.to_json("genres").alias("genres"), "overview", "embedding"), "vectors")
    texts = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    found = jobs.search_texts(vectors, texts, embedded, dim=dim)
    return found.withColumn("similarity", F.round("similarity", 6)).withColumn("rank", F.col("rank").cast("bigint"))


def semantic_search(spark: SparkSession, sf: str) -> DataFrame:
    movies, details = silver.movies(proxies.movies_raw(spark, sf)), embed.spread(proxies.details(spark, sf))
    rows = embed.with_context(embed.embedding_input(movies, details))
    model = embed.fit_text_model(rows)
    return _search_all(spark, sf, lambda texts: embed.embed_with_model(model, texts), rows, fixed.EMBEDDING_DIM)


def _letter_counts() -> embed.Embedder:
    """An external embedder that SQL can follow: how often each of a-z stands in the text."""
    return lambda texts: [[float(text.count(chr(c))) for c in range(ord("a"), ord("z") + 1)] for text in texts]


def embed_external(spark: SparkSession, sf: str) -> DataFrame:
    vectors = embed.embed_with(embed.with_context(_input(spark, sf)), _letter_counts, dim=26)
    return vectors.select("movieId", F.concat_ws(",", F.transform("embedding", lambda x: x.cast("int"))).alias("vector"))


def semantic_search_external(spark: SparkSession, sf: str) -> DataFrame:
    rows = embed.with_context(_input(spark, sf))
    return _search_all(spark, sf, lambda texts: embed.embed_with(texts, _letter_counts, dim=26), rows, 26)


# --- the whole chain -------------------------------------------------------------------------------------------------


def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """All jobs in order on landed files, twice; what the resulting tables hold, column by column."""
    place = new_scratch(spark, "refresh")
    tag = place.rpartition("-")[2]
    tables = jobs.Tables(f"silver_{tag}", f"gold_{tag}")
    for namespace in (tables.silver, tables.gold):
        ensure_namespace(spark, f"{namespace}.any", f"{place}/{namespace}")
    raw = _raw(spark, sf)
    again = raw["links"].where("movieId % 50 = 2").withColumn("tmdbId", F.col("movieId") + 1)  # a second key for one film
    raw["links"] = raw["links"].union(again)
    for name, df in raw.items():
        files.write_csv(df, f"{place}/landed/{name}.csv")
    for _ in range(2):  # the second run must change nothing
        jobs.refresh_all(spark, f"{place}/landed", tables, captured=proxies.payloads(spark, sf), model_path=f"{place}/model")

    def seen(name: str) -> DataFrame:
        df = spark.table(getattr(tables, name)).drop("embedding", "score", "updated_at")
        if "timestamp" in df.columns:
            df = _zoneless(df)
        if name == "movies":
            df = df.withColumn("genres", F.array_join("genres", "|"))
        found = profile(df, exact=True)
        if name == "recommendations":  # which films are kept depends on the factors
            free = F.col("column") == "movieId"
            found = found.withColumns({c: F.when(~free, F.col(c)) for c in ("distinct", "min", "max")})
        found = found.select(F.lit(name).alias("table"), "column", "rows", "nulls", "distinct", "min", "max")
        return stored(found, "profile")  # a few rows; the pairs that were counted go before the next table

    names = ["movies", "ratings", "tags", "links", "recommendations", "details", "vectors"]
    return reduce(DataFrame.unionByName, map(seen, names))


def refresh_by_version(spark: SparkSession, sf: str) -> DataFrame:
    """Which jobs run, and the rows they write: at first all, then one changed input, then the other three, then none."""
    place = new_scratch(spark, "versions")
    tag = place.rpartition("-")[2]
    tables = jobs.Tables(f"silver_{tag}", f"gold_{tag}")
    for namespace in (tables.silver, tables.gold):
        ensure_namespace(spark, f"{namespace}.any", f"{place}/{namespace}")
    raw = _raw(spark, sf)
    again = raw["links"].where("movieId % 50 = 2").withColumn("tmdbId", F.col("movieId") + 1)
    raw["links"] = raw["links"].union(again)
    more_tags = raw["tags"].union(raw["tags"].withColumn("tag", F.upper("tag")))
    rows = []
    for number, new in enumerate([raw, {"tags": more_tags}, {n: raw[n] for n in ("movies", "ratings", "links")}, {}], 1):
        for name, df in new.items():
            files.write_csv(df, f"{place}/landed/{name}.csv")
        ran = refresh_changed(spark, f"{place}/landed", tables, captured=proxies.payloads(spark, sf), model_path=f"{place}/model")
        rows += [(number, job, spark.table(getattr(tables, job)).count()) for job in ran]
    return spark.createDataFrame(rows, "round int, job string, rows bigint")


def entry(spark: SparkSession) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return recommend_gold(spark, "/root/testdata/sf0.001")


def _in_utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")  # the SQL side knows no session zone
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    registered = {
        "csv_scan": csv_scan,
        "csv_multiline_scan": csv_multiline_scan,
        "bronze_landing": bronze_landing,
        "overwrite_roundtrip": overwrite_roundtrip,
        "profile_table": profile_table,
        "upsert_partial": upsert_partial,
        "movies_silver": movies_silver,
        "ratings_silver": ratings_silver,
        "tags_silver": tags_silver,
        "links_silver": links_silver,
        "decay_rating": decay_rating,
        "item_popularity": item_popularity,
        "fair_score": fair_score,
        "fair_topk": fair_topk,
        "explode_candidates": explode_candidates,
        "als_candidates": als_candidates,
        "recommend_gold": recommend_gold,
        "als_rank_one": als_rank_one,
        "als_rank_two": als_rank_two,
        "recommend_rank_one": recommend_rank_one,
        "serve_recs": serve_recs,
        "serve_history": serve_history,
        "links_resolvable": links_resolvable,
        "links_first_500": links_first_500,
        "enrich_lookup": enrich_lookup,
        "enrich_fetch": enrich_fetch,
        "enrich_pacing": enrich_pacing,
        "json_defaults": json_defaults,
        "cosine_similarity": cosine,
        "similarity_percent": percent,
        "knn_single": knn_single,
        "knn_batch": knn_batch,
        "embedding_input": embedding_input,
        "embedding_context": embedding_context,
        "embed_documents": embed_documents,
        "embed_external": embed_external,
        "semantic_search": semantic_search,
        "semantic_search_external": semantic_search_external,
        "full_refresh": full_refresh,
        "refresh_by_version": refresh_by_version,
        **LLM_QUERIES,
    }
    return {name: _in_utc(query) for name, query in registered.items()}


# Common table expressions: the raw tables as lakerec.sources.proxies derives them, and the silver tables from them.
_CTES = {
    "ratings": """
        select cast(o_custkey as integer) as "userId", cast(l_partkey as integer) as "movieId",
               max(ceil(l_quantity / 5) / 2.0)::double as rating, max(l_shipdate) as "timestamp"
        from lineitem join orders on l_orderkey = o_orderkey group by 1, 2""",
    "movies_raw": """
        select cast(p_partkey as integer) as "movieId",
               p_name || case when p_size % 7 <> 0 then ' (' || (p_size + 1950) || ')' else '' end as title,
               p_type || '|' || p_brand as genres
        from part""",
    "movies": r"""
        select "movieId", regexp_replace(title, '\s*\(\d{4}\)\s*', '', 'g') as title,
               string_split(genres, '|') as genres,
               try_cast(regexp_extract(title, '\((\d{4})\)', 1) as integer) as year
        from movies_raw""",
    "flat_movies": """select "movieId", title, array_to_string(genres, '|') as genres, year from movies""",
    "movies_json": """
        select "movieId", title, '["' || array_to_string(genres, '","') || '"]' as genres, year from movies""",
    "links": """
        select cast(p_partkey as integer) as "movieId", lpad(cast(p_partkey + 100000 as varchar), 8, '0') as "imdbId",
               cast(case when p_partkey % 10 = 0 then null when p_partkey % 10 = 1 then 0 else p_partkey end as integer)
                   as "tmdbId"
        from part""",
    "tags": """
        select cast(user_id as integer) as "userId", cast(event_id % 2000 as integer) as "movieId", event_type as tag,
               date_trunc('second', ts) as "timestamp"
        from events
        where event_id % 11 <> 0 and user_id is not null and event_type is not null and ts is not null""",
    "details": """
        select cast(doc_id as integer) as "movieId", case when doc_id % 9 = 0 then '' else text end as overview
        from documents""",
    "scored": """
        select "userId", "movieId", rating as als_score, count(*) over (partition by "movieId") as num_ratings,
               round(rating / log10(count(*) over (partition by "movieId") + 9.0), 6) as fairness_score
        from ratings""",
    "top": """
        select * from (
            select "userId", "movieId", fairness_score as score,
                   row_number() over (partition by "userId" order by fairness_score desc, "movieId") as rank
            from scored)
        where rank <= 10""",
    "resolvable": """select "movieId", "tmdbId" from links where "tmdbId" <> 0""",
    "input": """
        select "movieId", title, genres, overview from movies join details using ("movieId") where overview <> ''""",
    "exemplars": """select label, arg_min(embedding, vec_id) as exemplar from embeddings group by label""",
    "cosines": """
        select vec_id, label, list_cosine_similarity(embedding::double[], exemplar::double[]) as similarity
        from embeddings join exemplars using (label)""",
}
_CTES |= {
    "fresh": """
        select "userId", "movieId", round(rating / pow(2.0, days_old / 1460.0), 1) as r from (
            select "userId", "movieId", rating,
                   date_diff('day', "timestamp"::date, max("timestamp"::date) over ()) as days_old
            from ratings)""",
    "u0": """select distinct "userId", 1.0::double as x from fresh""",
    **{
        name: f"""
        select f."{wanted}", greatest(0.0, sum(r * x) / (sum(x * x) + 0.1 * count(*)))::float::double as x
        from fresh f join {known} k on f."{other}" = k."{other}" group by 1"""
        for step in (1, 2, 3)
        for name, wanted, known, other in (
            (f"i{step}", "movieId", f"u{step - 1}", "userId"),
            (f"u{step}", "userId", f"i{step}", "movieId"),
        )
    },
    "v0": """select distinct "userId", (("userId" % 7 + 1) / 8.0)::float::double as x, (("userId" % 5) / 4.0)::float::double as y from fresh""",
    **{
        name: f"""
        select id, (case when s1 >= 0 and s2 >= 0 then s1 when a12 * b1 >= b2 * a11 and b1 > 0 then b1 / a11
                         when b2 > 0 then 0.0 else greatest(b1, 0.0) / a11 end)::float::double as x,
               (case when s1 >= 0 and s2 >= 0 then s2 when a12 * b1 >= b2 * a11 and b1 > 0 then 0.0
                     else greatest(b2, 0.0) / a22 end)::float::double as y, id as "{wanted}"
        from (
            select *, (b1 * a22 - b2 * a12) / (a11 * a22 - a12 * a12) as s1, (b2 * a11 - b1 * a12) / (a11 * a22 - a12 * a12) as s2
            from (
                select f."{wanted}" as id, sum(x * x) + 0.1 * count(*) as a11, sum(x * y) as a12,
                       sum(y * y) + 0.1 * count(*) as a22, sum(r::float::double * x) as b1, sum(r::float::double * y) as b2
                from fresh f join {known} k on f."{other}" = k."{other}" group by 1))"""
        for step in (1, 2)
        for name, wanted, known, other in (
            (f"j{step}", "movieId", f"v{step - 1}", "userId"),
            (f"v{step}", "userId", f"j{step}", "movieId"),
        )
    },
    "users": """select "userId" from (select distinct "userId" from ratings), range(10)""",
    "all_links": """
        select * from links
        union all select "movieId", "imdbId", cast("movieId" + 1 as integer) from links where "movieId" % 50 = 2""",
    "all_details": """
        select "movieId", "tmdbId", case when doc_id % 9 <> 0 then text else '' end as overview,
               case when doc_id is null then '' else '/' || source || '.jpg' end as poster_path,
               coalesce(n_chars * 10000000, 0) as budget, cast(0 as bigint) as revenue,
               coalesce((n_chars % 100)::double / 10, 0.0) as vote_average
        from (select * from all_links where "tmdbId" <> 0) left join documents on doc_id = "tmdbId" """,
    "all_vectors": """
        select "movieId", any_value(title) as title, any_value(array_to_string(genres, ', ')) as genres,
               arg_max(overview, "tmdbId") as overview
        from movies join all_details using ("movieId") where overview <> '' group by 1""",
    "letters": """
        select "movieId", title, overview, '["' || array_to_string(genres, '","') || '"]' as genres,
               'Filme: ' || title || '. Gêneros: ' || array_to_string(genres, ', ') || '. Sinopse: ' || overview as context
        from input""",
}
_NEEDS = {
    "fresh": ["ratings"],
    "u0": ["fresh"],
    **{f"{side}{step}": [f"u{step - 1}" if side == "i" else f"i{step}"] for step in (1, 2, 3) for side in "iu"},
    "v0": ["fresh"],
    **{f"{side}{step}": [f"v{step - 1}" if side == "j" else f"j{step}"] for step in (1, 2) for side in "jv"},
    "letters": ["input"],
    "users": ["ratings"],
    "all_links": ["links"],
    "all_details": ["all_links"],
    "all_vectors": ["movies", "all_details"],
    "movies": ["movies_raw"],
    "movies_json": ["movies"],
    "flat_movies": ["movies"],
    "scored": ["ratings"],
    "top": ["scored"],
    "resolvable": ["links"],
    "input": ["movies", "details"],
    "cosines": ["exemplars"],
}


def _with(names: list[str], body: str) -> str:
    """``body`` after the named CTEs and whatever they need, each once."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    if not order:
        return body
    return "with " + ", ".join(f"{name} as ({_CTES[name]})" for name in order) + " " + body


def _letter_vector(text: str) -> str:
    counts = ", ".join(f"length({text}) - length(replace({text}, '{chr(c)}', ''))" for c in range(97, 123))
    return f"[{counts}]"


def _profile_sql(ctes: list[str] | None = None, columns: dict[str, list[str]] | None = None) -> str:
    columns = columns or {
        "movies": ["movieId", "title", "genres", "year"],
        "ratings": ["userId", "movieId", "rating", "timestamp"],
        "tags": ["userId", "movieId", "tag", "timestamp"],
        "links": ["movieId", "imdbId", "tmdbId"],
    }

    def entry_sql(name: str, column: str) -> str:
        nested = (name, column) == ("movies", "genres")
        low, high = ("null", "null") if nested else (f'min("{column}")', f'max("{column}")')
        return (
            f"""select '{name}' as "table", '{column}' as "column", count(*) as rows, """
            f"""count(*) - count("{column}") as nulls, count(distinct "{column}") as "distinct", """
            f"""cast({low} as varchar) as "min", """
            f"""cast({high} as varchar) as "max" from {name}"""
        )

    parts = [entry_sql(name, column) for name, listed in columns.items() for column in listed]
    return _with(ctes or list(columns), " union all ".join(parts))


def oracle_sql() -> dict[str, str]:
    ratings = 'select "userId", "movieId", rating, "timestamp" from ratings'
    return {
        "csv_scan": _with(["movies_raw"], "select * from movies_raw"),
        "csv_multiline_scan": "select cast(doc_id as varchar) as doc_id, text, lang from documents",
        "overwrite_roundtrip": _with(["movies"], 'select "movieId", title, year from movies'),
        "profile_table": _profile_sql(),
        "upsert_partial": """
            with base as (
                select cast(p_partkey as integer) as "movieId", p_name as title, p_type as genres, p_brand as overview,
                       p_retailprice::float::double as embedding
                from part),
            updates as (
                select cast(user_id * 20 as integer) as "movieId", 'event ' || arg_min(event_id, event_id) as title,
                       arg_min(event_type, event_id) as genres, arg_max(props, event_id) as overview,
                       arg_max(value, event_id)::float::double as embedding
                from events group by user_id)
            select "movieId", case when b."movieId" is null then u.title else b.title end as title,
                   case when b."movieId" is null then u.genres else b.genres end as genres,
                   case when u."movieId" is null then b.overview else u.overview end as overview,
                   case when u."movieId" is null then b.embedding else u.embedding end as embedding
            from base b full join updates u using ("movieId")""",
        "movies_silver": _with(["movies_json"], "select * from movies_json"),
        "ratings_silver": _with(["ratings"], ratings),
        "tags_silver": _with(["tags"], "select * from tags"),
        "links_silver": _with(["links"], "select * from links"),
        "decay_rating": _with(
            ["ratings"],
            """
            select *, round(rating / pow(2.0, days_old / 1460.0), 1) as fresh_rating from (
                select "userId", "movieId", rating, "timestamp", "timestamp"::date as rating_date,
                       date_diff('day', "timestamp"::date, max("timestamp"::date) over ()) as days_old
                from ratings)""",
        ),
        "item_popularity": _with(
            ["ratings"], 'select "movieId", count(*) as num_ratings from ratings group by "movieId"'
        ),
        "fair_score": _with(["scored"], "select * from scored"),
        "fair_topk": _with(["top"], "select * from top"),
        "explode_candidates": _with(
            ["ratings"],
            """
            select "userId", "movieId", als_score from (
                select "userId", "movieId", rating as als_score,
                       row_number() over (partition by "userId" order by rating desc, "movieId") as place
                from ratings)
            where place <= 50""",
        ),
        "serve_recs": _with(
            ["top", "movies_json", "links"],
            f"""
            select "imdbId", title, genres, year, score
            from top join movies_json using ("movieId") join links using ("movieId")
            where "userId" = {SERVED_USER} order by score desc, "movieId" limit 10""",
        ),
        "serve_history": _with(
            ["ratings", "movies_json", "links"],
            f"""
            select "imdbId", title, year, genres, rating, "timestamp"
            from ratings join movies_json using ("movieId") join links using ("movieId")
            where "userId" = {SERVED_USER} order by "timestamp" desc, "movieId" """,
        ),
        "links_resolvable": _with(["resolvable"], "select * from resolvable"),
        "links_first_500": _with(["resolvable"], 'select * from resolvable order by "movieId", "tmdbId" limit 500'),
        "enrich_lookup": _with(
            ["resolvable"],
            """
            select "movieId", "tmdbId", case when doc_id % 9 <> 0 then text else '' end as overview,
                   case when doc_id is null then '' else '/' || source || '.jpg' end as poster_path,
                   coalesce(n_chars * 10000000, 0) as budget, cast(0 as bigint) as revenue,
                   coalesce((n_chars % 100)::double / 10, 0.0) as vote_average
            from resolvable left join documents on doc_id = "tmdbId" """,
        ),
        "json_defaults": """
            select event_id, coalesce(cast(json_extract_string(props, '$.k') as bigint), -1) as k,
                   coalesce(json_extract_string(props, '$.overview'), '') as overview,
                   coalesce(json_extract_string(props, '$.poster_path'), '') as poster_path,
                   coalesce(cast(json_extract_string(props, '$.budget') as bigint), 0) as budget,
                   coalesce(cast(json_extract_string(props, '$.revenue') as bigint), 0) as revenue,
                   coalesce(cast(json_extract_string(props, '$.vote_average') as double), 0.0) as vote_average
            from events""",
        "cosine_similarity": _with(
            ["cosines"], "select vec_id, label, round(similarity, 6) + 0.0 as similarity from cosines"
        ),
        "similarity_percent": _with(["cosines"], "select vec_id, round(similarity * 100, 1) + 0.0 as percent from cosines"),
        "knn_single": """
            with query as (select arg_min(embedding, vec_id) as q from embeddings)
            select vec_id as "movieId", label,
                   round(list_cosine_similarity(embedding::double[], q::double[]), 6) + 0.0 as similarity
            from embeddings, query
            order by list_cosine_similarity(embedding::double[], q::double[]) desc nulls last, vec_id limit 5""",
        "knn_batch": _with(
            ["exemplars"],
            """
            select cast(query_id as bigint) as query_id, cast("movieId" as integer) as "movieId",
                   round(raw, 6) + 0.0 as similarity, rank from (
                select *, row_number() over (partition by query_id order by raw desc nulls last, "movieId") as rank
                from (select exemplars.label as query_id, vec_id as "movieId",
                             list_cosine_similarity(embedding::double[], exemplar::double[]) as raw
                      from exemplars, embeddings))
            where rank <= 5""",
        ),
        "embedding_input": _with(["input"], 'select "movieId", title, overview from input'),
        "embedding_context": _with(
            ["input"],
            """
            select "movieId", 'Filme: ' || title || '. Gêneros: ' || array_to_string(genres, ', ') || '. Sinopse: '
                   || overview as context
            from input""",
        ),
        "full_refresh": _profile_sql(
            ["ratings", "tags", "flat_movies", "all_links", "users", "all_details", "all_vectors"],
            {
                "flat_movies": ["movieId", "title", "genres", "year"],
                "ratings": ["userId", "movieId", "rating", "timestamp"],
                "tags": ["userId", "movieId", "tag", "timestamp"],
                "all_links": ["movieId", "imdbId", "tmdbId"],
                "users": ["userId"],
                "all_details": ["movieId", "tmdbId", "overview", "poster_path", "budget", "revenue", "vote_average"],
                "all_vectors": ["movieId", "title", "genres", "overview"],
            },
        )
        .replace("select 'all_", "select '")
        .replace("select 'flat_", "select '")
        .replace("select 'users'", "select 'recommendations'")
        + """ union all select 'recommendations', 'movieId', count(*), 0, null, null, null from users""",
        "refresh_by_version": _with(
            ["ratings", "tags", "movies", "all_links", "users", "all_details", "all_vectors"],
            """
            select round::int as round, job, rows from (
                select 'movies' as job, (select count(*) from movies) as rows, [1, 3] as rounds
                union all select 'ratings', (select count(*) from ratings), [1, 3]
                union all select 'links', (select count(*) from all_links), [1, 3]
                union all select 'recommendations', (select count(*) from users), [1, 3]
                union all select 'details', (select count(*) from all_details), [1, 3]
                union all select 'vectors', (select count(*) from all_vectors), [1, 3]
                union all select 'tags', (select count(*) from tags), [1]
                union all select 'tags', (select 2 * count(*) from tags), [2]), unnest(rounds) r(round)""",
        ),
        "bronze_landing": _with(
            ["movies_raw", "ratings", "links"],
            """
            select 'movies' as "table", cast("movieId" as varchar) as c0, title as c1, genres as c2, null::varchar as c3
            from movies_raw
            union all
            select 'ratings', cast("userId" as varchar), cast("movieId" as varchar), cast(rating as varchar),
                   cast(epoch("timestamp")::bigint as varchar) from ratings
            union all
            select 'tags', cast(user_id as varchar), cast(event_id % 2000 as varchar), event_type,
                   case when event_id % 11 = 0 then 'bad' else cast(floor(epoch(ts))::bigint as varchar) end from events
            union all
            select 'links', cast("movieId" as varchar), "imdbId", cast("tmdbId" as varchar), null from links""",
        ),
        "als_rank_one": _with(
            ["u3"],
            """
            select 'user' as side, "userId" as id, round(x, 3) as factor from u3
            union all select 'item', "movieId", round(x, 3) from i3""",
        ),
        "als_rank_two": _with(
            ["v2"],
            """
            select 'user' as side, id, round(x, 3) as first, round(y, 3) as second from v2
            union all select 'item', id, round(x, 3), round(y, 3) from j2""",
        ),
        "recommend_rank_one": _with(
            ["u3"],
            """
            select "userId", place, round(score, 3) as score from (
                select "userId", score, row_number() over (partition by "userId" order by score desc) as place
                from (
                    select "userId", als / log10(n + 9.0) as score
                    from (
                        select u3."userId", i3."movieId", u3.x * i3.x as als,
                               row_number() over (partition by u3."userId" order by u3.x * i3.x desc, i3."movieId") as k
                        from u3, i3)
                    join (select "movieId", count(*) as n from ratings group by 1) using ("movieId")
                    where k <= 50))
            where place <= 10""",
        ),
        "enrich_pacing": _with(
            ["resolvable"],
            """
            select count(*) as calls, least(count(*), 4) as clients, 0.125::double as least_gap,
                   greatest(0.125, max("tmdbId" % 4) / 16.0)::double as most_gap, 0::bigint as off_schedule
            from resolvable""",
        ),
        "enrich_fetch": _with(
            ["resolvable"],
            """
            select "movieId", "tmdbId",
                   case when "tmdbId" % 7 = 0 or "tmdbId" % 5 = 0 then '' else 'story ' || "tmdbId" end as overview,
                   '' as poster_path,
                   case when "tmdbId" % 7 = 0 or "tmdbId" % 5 = 0 then 0 else "tmdbId"::bigint * 10000000 end as budget,
                   cast(0 as bigint) as revenue, cast(0 as double) as vote_average
            from resolvable""",
        ),
        "embed_documents": r"""
            select doc_id, cast(768 as bigint) as dim,
                   case when regexp_matches(text, '[\p{L}\p{N}]') then 1.0 else 0.0 end::double as norm
            from documents""",
        "embed_external": _with(
            ["letters"], f"""select "movieId", array_to_string({_letter_vector('context')}, ',') as vector from letters"""
        ),
        "semantic_search_external": _with(
            ["letters"],
            f"""
            select query_id, "movieId", title, genres, overview, round(raw, 6) as similarity, rank from (
                select *, row_number() over (partition by query_id order by raw desc nulls last, "movieId") as rank
                from (
                    select item_id as query_id, "movieId", title, genres, overview,
                           round(list_cosine_similarity(q.v::double[], l.v::double[]), 12) as raw
                    from (select item_id, {_letter_vector('text')} as v from benchmark) q,
                         (select *, {_letter_vector('context')} as v from letters) l))
            where rank <= 5""",
        ),
        **LLM_ORACLES,
    }
