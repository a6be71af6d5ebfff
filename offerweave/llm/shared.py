"""Tables that jobs leave for later jobs, in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerweave.operators.tables import shared_dir


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/offerweave/{name}-{uuid.uuid4().hex}"


def packed(docs: DataFrame, **keys: Column) -> DataFrame:
    """The caller's row as one struct ``row`` beside ``keys``: no name of a column of theirs can meet one of ours."""
    return docs.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in keys.items()])


def apart(docs: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


class Scratch:
    """Stored tables that an operator needs only until its own last table is written; then they are deleted.

    ``tasks``: where a table's last stage has more partitions than that, neighbouring ones share a task and a file.
    """

    def __init__(self, spark: SparkSession, tasks: int | None = None) -> None:
        self.spark, self.tasks, self.paths = spark, tasks, []

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(self.spark, name)
        self.paths.append(path)
        return stored(df.coalesce(self.tasks) if self.tasks else df, name, path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in self.paths:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` computed once and written as Parquet in the shared folder; later jobs read the files.

    Unlike a cache it outlives lost executors, and unlike localCheckpoint it has no single copy on one.
    """
    path = path or new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
