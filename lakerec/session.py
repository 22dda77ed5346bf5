"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scopes: list[str] = []
_swept: set[str] = set()


def get_session(app_name: str = "lakerec") -> SparkSession:
    """The session, created if needed. Everything not set here is left to spark-submit and the cluster's defaults."""
    return SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC").getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or where it is unset one in the warehouse."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base


def _folder(spark: SparkSession) -> str:
    """This session's part of the shared folder; the file system removes it when the driver ends."""
    path = f"{shared_dir(spark).rstrip('/')}/lakerec/{spark.sparkContext.applicationId}"
    if path not in _swept:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = place.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(place)
        system.deleteOnExit(place)
        _swept.add(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """What is stored inside is removed at the end. Results must be in their own tables by then."""
    path = f"{_folder(spark)}/scope-{uuid.uuid4().hex}"
    _scopes.append(path)
    try:
        yield
    finally:
        _scopes.remove(path)
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each query run inside go when it ends, not when the driver next collects its garbage.

    For writes, whose plan is never run again.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: computed once, lineage cut, size known to the planner."""
    path = new_scratch(df.sparkSession, label)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(*tables: DataFrame) -> None:
    """Removes the files of ``stored`` tables. Whatever was read from them must be stored by then."""
    for table in tables:
        for path in {file.rpartition("/")[0] for file in table.inputFiles()}:
            place = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder. A retried or repeated run never meets the files of an earlier one."""
    return f"{_scopes[-1] if _scopes else _folder(spark)}/{label}-{uuid.uuid4().hex}"


def one_by_one(parts: Iterable[Broadcast]) -> Iterator:
    """The values of broadcasts, in a task. The worker loads one at a time from its disk and keeps none of them."""
    for part in parts:
        yield part.value
        if getattr(part, "_path", None) is not None:
            vars(part).pop("_value", None)
