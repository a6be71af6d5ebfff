"""Intermediate tables of iterative jobs, written where every executor can read them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset (tests, one machine) a folder of our own."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is unset: a cluster must name a shared folder")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="offerweave-")
    return _own[app]


def written(df: DataFrame) -> DataFrame:
    """``df`` computed once, as Parquet: lineage ends here, and lost executors don't matter."""
    return _write(df, _new_path(df.sparkSession))


def _new_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/offerweave/round-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Jobs run here delete their shuffle files once they end, and not when the driver next collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def _write(df: DataFrame, path: str) -> DataFrame:
    with shuffles_deleted(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Workspace:
    """Written tables that a job needs only while it runs: ``drop`` deletes some early, leaving the block all."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def path(self) -> str:
        """A folder that a table of the caller's own layout may be made in, deleted like the others."""
        path = _new_path(self.spark)
        self.paths[path] = (path, path)
        return path

    def written(self, df: DataFrame) -> DataFrame:
        path = _new_path(self.spark)
        out = _write(df, path)
        self.paths[id(out)] = (path, out)
        return out

    def drop(self, *tables: DataFrame) -> None:
        self._delete([self.paths.pop(id(t))[0] for t in tables])

    def _delete(self, paths: list[str]) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in paths:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self._delete([path for path, _ in self.paths.values()])
        self.paths.clear()
