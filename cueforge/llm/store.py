"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct: carried so, none of them can clash with a name that an operator needs for itself."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns))


def fields(row: str, names: list[str], **other: Column) -> list[Column]:
    """The columns of a struct column made by whole_row(), some of them exchanged."""
    return [other[c].alias(c) if c in other else F.col(row)[c].alias(c) for c in names]


class Store:
    """Tables of one operator run, under spark.checkpoint.dir.

    A written table cuts the lineage: a lost executor costs at most the tasks of the step that was running. Where the session
    names no folder, a local session (as in tests) uses a temporary one, which is deleted at exit; a cluster is refused, since its
    machines don't see each other's folders. Tables that an operator's result reads stay until the folder is cleared.
    """

    def __init__(self, spark: SparkSession, name: str):
        top = spark.conf.get("spark.checkpoint.dir", None)
        if not top:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            top = tempfile.mkdtemp(prefix="cueforge-")
            atexit.register(shutil.rmtree, top, ignore_errors=True)
        self.spark = spark
        self.path = f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write df and return what was written. by: a column of few values that get folders of their own."""
        path = f"{self.path}/{name}"
        writer = df.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads, and let Spark release the shuffles of finished steps."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.release()

    def release(self) -> None:
        """Let Spark delete the shuffle files of steps whose frames are gone: it does so when their objects are collected."""
        for _ in range(2):
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()
            time.sleep(0.2)


#: Rows of texts that go to Python together in scans that hold much besides.
ROWS = 2000


@contextmanager
def rows_at_once(spark: SparkSession, n: int) -> Iterator[None]:
    """For tables of large binary rows: while this holds, Spark hands at most n rows to Python together."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, old)
