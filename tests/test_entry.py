"""Every registered query against its SQL, on the smallest data set."""

import datetime
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def plain(value):
    if pd.isna(value):
        return ""
    if isinstance(value, (datetime.date, pd.Timestamp)):
        return pd.Timestamp(value).isoformat()
    return repr(float(value)) if isinstance(value, (int, float, np.number)) else str(value)


def canonical(frame):
    columns = sorted(frame.columns)
    return columns, sorted(tuple(map(plain, row)) for row in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_equals_sql(spark, duck, name):
    found, expected = QUERIES[name](spark, SF), duck.sql(ORACLES[name])
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}
    kinds |= {"timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    assert {c: kinds[t] for c, t in found.dtypes} == dict(zip(expected.columns, map(str, expected.types)))
    assert canonical(found.toPandas()) == canonical(expected.df())


def test_every_oracle_has_a_query():
    assert ORACLES.keys() <= QUERIES.keys()


def test_candidates_and_recommendations(spark):
    candidates = QUERIES["als_candidates"](spark, SF).toPandas()
    assert (candidates.groupby("userId").size() == 50).all() and (candidates["als_score"] >= 0).all()
    kept = driver.entry(spark).toPandas()
    assert list(kept.columns) == ["userId", "movieId", "score"]
    assert (kept.groupby("userId").size() == 10).all() and not kept.duplicated(["userId", "movieId"]).any()
    pairs = set(map(tuple, candidates[["userId", "movieId"]].to_numpy()))
    assert set(map(tuple, kept[["userId", "movieId"]].to_numpy())) <= pairs


def test_semantic_search_equals_brute_force(spark):
    from lakerec.operators import embed
    from lakerec.sources.proxies import table

    found = QUERIES["semantic_search"](spark, SF).toPandas()
    rows = embed.with_context(driver._input(spark, SF))
    model = embed.fit_text_model(rows)
    items = embed.embed_with_model(model, rows).select("movieId", "embedding").toPandas()
    texts = table(spark, SF, "benchmark").selectExpr("item_id", "text as context")
    queries = embed.embed_with_model(model, texts).select("item_id", "embedding").toPandas()
    q, c = (np.stack(f["embedding"].to_numpy()).astype(float) for f in (queries, items))
    q, c = (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300) for m in (q, c))
    best = np.sort(np.round(q @ c.T, 6), axis=1)[:, ::-1][:, :5]
    for item, scores in zip(queries["item_id"], best):
        mine = found[found["query_id"] == item].sort_values("rank")
        np.testing.assert_allclose(mine["similarity"], scores, atol=2e-6)
        assert mine["title"].notna().all() and mine["overview"].notna().all()
