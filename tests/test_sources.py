import json
import random
import sys
import time

from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lakerec import session
from lakerec.operators import silver
from lakerec.sources import files, lookup, multiline, tables

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import this file


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


def test_doubled_quotes(spark, tmp_path):
    path = write(
        tmp_path / "movies.csv",
        'movieId,title,genres\n3,"""Great Performances"" Cats (1998)",M\n4,"Say ""Hi"", Bob (2000)",M\n',
    )
    rows = {r.movieId: (r.title, r.genres) for r in files.read_csv(spark, path, files.MOVIES_SCHEMA).collect()}
    assert rows == {3: ('"Great Performances" Cats (1998)', "M"), 4: ('Say "Hi", Bob (2000)', "M")}


def test_inference(spark, tmp_path):
    path = write(tmp_path / "links.csv", "movieId,imdbId,tmdbId\n1,0114709,862\n2,0113497,\n")
    assert [t for _, t in files.read_csv(spark, path, infer=True).dtypes] == ["int", "int", "int"]
    kept = files.read_csv(spark, path, files.LINKS_SCHEMA)
    assert [r.imdbId for r in kept.collect()] == ["0114709", "0113497"]
    assert silver.links(kept, imdb_as_int=True).first().imdbId == 114709


TAGS = (
    'userId,movieId,tag,timestamp\n1,17,"say ""hi"",\nbob",944249077\n2,18,,944249077\n'
    "3,19,ok,notanum\n4,20,fine,944249078\n"
)


def test_multi_line_tags(spark, tmp_path):
    raw = files.read_csv(spark, write(tmp_path / "tags.csv", TAGS), files.TAGS_SCHEMA, multi_line=True)
    rows = silver.tags(raw).orderBy("userId").collect()
    assert [(r.userId, r.movieId, r.tag) for r in rows] == [(1, 17, 'say "hi",\nbob'), (4, 20, "fine")]


ODD_CSV = (
    'k,v,"w\nx"\n1,plain,a\n2,"two\r\nlines\n\n",b\n\n3,"""",\n4,"",c,more\n5,"é ""x"", y",z\n6\n7,"a\n"",""\nb","\n"\n8, padded ,last'
)


def spark_reader(spark, path, schema):
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    return reader.schema(schema).csv(path)


@pytest.mark.parametrize("size, ranges", [(4, 10**6), (30, 10**6), (1000, 10**6), (11, 0)])
def test_multi_line_files_are_read_by_ranges(spark, conf, tmp_path, size, ranges):
    """Any cut gives what Spark's own reader gives; records cross one border, or several."""
    conf(spark__sql__files__maxPartitionBytes=str(size), spark__sql__files__openCostInBytes="0")
    path = write(tmp_path / "odd/a.csv", ODD_CSV)
    write(tmp_path / "odd/b.csv", "k,v,w\n9,x,y\n")
    write(tmp_path / "odd/c.csv", "k,v,w\n")
    write(tmp_path / "odd/d.csv", "")
    schema = "k string, v string, w string"
    for place in (path, f"{tmp_path}/odd"):
        found = multiline.read_multiline_csv(spark, place, schema, max_broadcast_ranges=ranges)
        expected = sorted(map(tuple, spark_reader(spark, place, schema).collect()), key=str)
        assert sorted(map(tuple, found.collect()), key=str) == expected and len(expected) >= 8


def test_multi_line_records_may_end_with_carriage_returns(spark, tmp_path):
    path = write(tmp_path / "crlf.csv", 'k,v\r\n1,"a\r\nb"\r\n2,c\r\n\r\n3,\r\n')
    found = files.read_csv(spark, path, "k int, v string", multi_line=True)
    assert sorted(map(tuple, found.collect())) == [(1, "a\r\nb"), (2, "c"), (3, None)]


def test_multi_line_long_file_in_many_ranges(spark, conf, tmp_path):
    rng = random.Random(1)
    rows = []
    for i in range(20_000):
        text = "".join(rng.choice('ab ,"\né') for _ in range(rng.randrange(20)))
        rows.append((i, text if i % 3 else "line " * (i % 50), "end"))
    quoted = "".join('%d,"%s",%s\n' % (k, v.replace('"', '""'), w) for k, v, w in rows)
    path = write(tmp_path / "long.csv", "k,v,w\n" + quoted)
    conf(spark__sql__files__maxPartitionBytes="30000", spark__sql__files__openCostInBytes="0")
    found = files.read_csv(spark, path, "k int, v string, w string", multi_line=True)
    assert found.columns == ["k", "v", "w"] and found.rdd.getNumPartitions() > 1
    assert sorted(map(tuple, found.collect())) == [(k, v or None, w) for k, v, w in rows]


def test_multi_line_columns_from_the_header(spark, tmp_path):
    path = write(tmp_path / "h.csv", 'k,"a ""b""\nc"\n1,"x\ny"\n')
    found = files.read_csv(spark, path, multi_line=True)
    assert found.columns == ["k", 'a "b"\nc'] and [tuple(r) for r in found.collect()] == [("1", "x\ny")]


def test_landing_reads_folders_of_parts_in_one_plan(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "concat('line', chr(10), id) as tag")
    files.write_csv(df.repartition(7), f"{tmp_path}/raw/deep/tags.csv")
    files.write_csv(df.select("id").repartition(3), f"{tmp_path}/raw/x.csv")
    assert files.land_csv(spark, f"{tmp_path}/raw", f"{tmp_path}/landed") == ["tags.csv", "x.csv"]
    back = files.read_csv(spark, f"{tmp_path}/landed/tags.csv", "id long, tag string", multi_line=True)
    assert sorted(map(tuple, back.collect())) == [(i, f"line\n{i}") for i in range(1000)]
    files.write_csv(df, f"{tmp_path}/raw/other/x.csv")
    with pytest.raises(ValueError, match="x.csv"):
        files.land_csv(spark, f"{tmp_path}/raw", f"{tmp_path}/landed")


def test_malformed_tag_id(spark, tmp_path):
    path = write(tmp_path / "tags.csv", "userId,movieId,tag,timestamp\nabc,17,x,944249077\n")
    raw = files.read_csv(spark, path, files.TAGS_SCHEMA)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver.tags(raw).collect()
    assert silver.tags(raw, strict=False).collect() == []


def test_written_csv_reads_back_the_same(spark, tmp_path):
    rows = [(1, " padded "), (2, ""), (3, None), (4, 'a "b",\nc'), (5, "back\\slash"), (6, '"')]
    df = spark.createDataFrame(rows, "k int, v string").repartition(3)
    files.write_csv(df, f"{tmp_path}/out")
    back = files.read_csv(spark, f"{tmp_path}/out", "k int, v string", multi_line=True)
    assert sorted((r.k, r.v) for r in back.collect()) == [(k, v or None) for k, v in rows]


def test_manifest_and_landing(spark, tmp_path):
    write(tmp_path / "raw/a/tags.csv", TAGS)
    write(tmp_path / "raw/a/b/movies.csv", "movieId,title,genres\n1,T (1990),A|B\n2,U,A\n")
    write(tmp_path / "raw/readme.txt", "no")
    found = {r.name: r.length for r in files.manifest(spark, f"{tmp_path}/raw").collect()}
    assert found == {"tags.csv": len(TAGS), "movies.csv": len("movieId,title,genres\n1,T (1990),A|B\n2,U,A\n")}
    assert files.land_csv(spark, f"{tmp_path}/raw", f"{tmp_path}/landed") == ["movies.csv", "tags.csv"]
    back = files.read_csv(spark, f"{tmp_path}/landed/tags.csv", files.TAGS_SCHEMA, multi_line=True)
    assert silver.tags(back).count() == 2
    assert files.read_csv(spark, f"{tmp_path}/landed/movies.csv", files.MOVIES_SCHEMA).count() == 2


def test_landing_refuses_two_files_of_one_name(spark, tmp_path):
    write(tmp_path / "raw/a/x.csv", "k\n1\n")
    write(tmp_path / "raw/b/x.csv", "k\n2\n")
    with pytest.raises(ValueError, match="x.csv"):
        files.land_csv(spark, f"{tmp_path}/raw", f"{tmp_path}/landed")


def test_overwrite_replaces_rows_and_schema(spark):
    tables.overwrite_table(spark.range(5), "t_over.x")
    stored = tables.overwrite_table(spark.range(3).select(F.col("id").cast("string").alias("name")), "t_over.x")
    assert stored.dtypes == [("name", "string")] and stored.count() == 3


def test_clustered_table_spreads_a_hot_key_over_files(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    df = spark.range(8000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("userId"), F.col("id").alias("movieId")
    )
    stored = tables.overwrite_table(df.repartition(4), "t_cluster.x", cluster_by=("userId", "movieId"))
    assert stored.count() == 8000
    hot = stored.filter("userId = 1").select(F.input_file_name().alias("f")).distinct().count()
    assert hot >= 2


def test_replace_table_may_read_what_it_replaces(spark):
    tables.overwrite_table(spark.range(4), "t_swap.x")
    for _ in range(2):
        now = spark.table("t_swap.x")
        tables.replace_table(now.unionByName(now.select((F.col("id") + 100).alias("id"))), "t_swap.x")
    assert spark.table("t_swap.x").count() == 16
    assert {t.name for t in spark.catalog.listTables("t_swap") if not t.isTemporary} == {"x"}


def test_create_table_if_missing(spark):
    assert tables.create_table_if_missing(spark, "t_make.x", "k int, v string").count() == 0
    tables.overwrite_table(spark.range(2), "t_make.y")
    assert tables.create_table_if_missing(spark, "t_make.y", "k int").count() == 2
    spark.sql("ALTER TABLE t_make.y RENAME TO t_make.y__old")  # a swap that died half way
    assert tables.create_table_if_missing(spark, "t_make.y", "k int").count() == 2


def test_resolvable(spark):
    links = spark.createDataFrame([(1, "a", None), (2, "b", 0), (3, "c", 862), (4, "d", 9)], files.LINKS_SCHEMA)
    assert [tuple(r) for r in lookup.resolvable(links).orderBy("movieId").collect()] == [(3, 862), (4, 9)]
    assert [tuple(r) for r in lookup.resolvable(links, limit=1).collect()] == [(3, 862)]


ANSWERS = {
    10: json.dumps({"overview": "o", "budget": 2923706026, "vote_average": 7.5, "poster_path": None}),
    30: json.dumps({"revenue": 4}),
}


def client_factory():
    def client(key):
        if key == 40:
            raise ConnectionError("down")
        return ANSWERS.get(key)

    return client


def test_lookup_forms_agree(spark):
    keys = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, 40)], "movieId int, tmdbId int")
    called = lookup.details(lookup.fetch_payloads(keys, client_factory, clients=3, min_interval_s=0.0))
    captured = spark.createDataFrame(list(ANSWERS.items()), "tmdbId int, payload string")
    offline = lookup.details(lookup.captured_payloads(keys, captured))
    expected = [
        (1, 10, "o", "", 2923706026, 0, 7.5),
        (2, 20, "", "", 0, 0, 0.0),
        (3, 30, "", "", 0, 4, 0.0),
        (4, 40, "", "", 0, 0, 0.0),
    ]
    assert called.rdd.getNumPartitions() == 3
    assert [tuple(r) for r in called.orderBy("movieId").collect()] == expected
    assert [tuple(r) for r in offline.orderBy("movieId").collect()] == expected


def test_lookup_keeps_its_interval(spark):
    keys = spark.createDataFrame([(m, 10) for m in range(5)], "movieId int, tmdbId int")
    start = time.perf_counter()
    assert lookup.fetch_payloads(keys, client_factory, clients=1, min_interval_s=0.2).count() == 5
    assert time.perf_counter() - start >= 1.0


def test_scratch_follows_the_cluster_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    own = f"{base}/lakerec/{spark.sparkContext.applicationId}"
    assert session.new_scratch(spark, "x").startswith(f"{own}/x-")
    with session.scratch_scope(spark):
        path = session.new_scratch(spark, "x")
        assert path.startswith(f"{own}/scope-")
        session.stored(spark.range(3), "y")
    assert not list(Path(own).glob("scope-*"))
    assert spark.sparkContext.getCheckpointDir() is not None


def test_clustered_write_computes_its_input_once(spark, tmp_path, monkeypatch):
    """The source is read for the store only; the sampling of ranges and the write read what is stored."""
    path = write(tmp_path / "r.csv", "k,v\n" + "".join(f"{i},{i % 7}\n" for i in range(5000)))
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    rows = files.read_csv(spark, path, "k int, v int").mapInArrow(counted, "k int, v int")
    monkeypatch.setattr(tables, "MAX_ROWS_PER_FILE", 400)
    stored = tables.overwrite_table(rows, "t_once.x", cluster_by=("v", "k"))
    assert calls.value == 5000 and stored.count() == 5000
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 400


class StepClock(lookup.Clock):
    def __init__(self):
        self.time = 0.0

    def now(self):
        return self.time

    def sleep(self, seconds):
        self.time += seconds


def test_the_schedule_of_calls(spark):
    keys = spark.range(1, 101).select(F.col("id").cast("int").alias("movieId"), F.col("id").cast("int").alias("tmdbId"))

    def slow(clock):
        def client(key):
            clock.sleep(0.5 if key % 10 == 0 else 0.0)
            if key % 3 == 0:
                raise OSError
            return "{}"

        return client

    calls = lookup.fetch_calls(keys, slow, clients=3, min_interval_s=0.25, clock_factory=StepClock).toPandas()
    assert len(calls) == 100 and calls.client.nunique() == 3 and calls.payload.notna().sum() == 67
    for _, own in calls.groupby("client"):
        own = own.sort_values("called_at", kind="stable")
        gaps = own.called_at.diff().dropna().tolist()
        assert gaps == [0.5 if key % 10 == 0 else 0.25 for key in own.tmdbId.tolist()[:-1]]


def test_shuffle_files_go_with_the_write_that_needed_them(spark, tmp_path):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    places = [Path(place.getPath()) for place in manager.localDirs()]

    def shuffled():
        return {file.name for place in places for file in place.rglob("shuffle_*")}

    before = shuffled()
    rows = spark.range(0, 10_000, 1, 4).repartition(5, "id")
    session.stored(rows, "dealt")
    files.write_csv(rows, str(tmp_path / "x.csv"))
    deadline = time.monotonic() + 20
    while (left := shuffled() - before) and time.monotonic() < deadline:
        time.sleep(0.1)
    assert not left
