"""Cutting lineage with tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset (a local test) a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            return known.get()
        folder = tempfile.mkdtemp(prefix="gavel-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


#: Paths that materialise() has written within each open scope, the innermost last.
_scopes: list[list[str]] = []


@contextmanager
def scope(spark: SparkSession) -> Iterator[list[str]]:
    """Tables that are written within it are deleted at its end; a path that is taken off the list that it gives stays.

    For a caller that writes what it needs of the results: they cannot be read afterwards.
    """
    _scopes.append([])
    try:
        yield _scopes[-1]
    finally:
        remove(spark, *_scopes.pop())


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete written tables."""
    for one in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(one)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write df once to the shared folder and return the written table.

    Executors that are lost later cost nothing but a re-read: the lineage ends at files that all machines see.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _scopes:
        _scopes[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass
class Bucketed:
    """A written table whose rows are dealt to `buckets` by a key."""

    name: str
    path: str
    buckets: int
    table: DataFrame


def bucketed(df: DataFrame, key: str, label: str, rows: int = 0, buckets: int = 0) -> Bucketed:
    """df as a table in the shared folder, bucketed by key: tables of equally many buckets join without a shuffle.

    Either buckets of about `rows` rows are made (one for each core at least), or rows stay in the tasks that they are
    in and `buckets` says how many buckets those have been read from.
    """
    spark = df.sparkSession
    if not buckets:
        buckets = max(spark.sparkContext.defaultParallelism, -(-df.count() // rows))
        df = df.repartition(buckets, key)
    name = f"{label}_{uuid.uuid4().hex}".replace("-", "_")
    path = f"{shared_folder(spark)}/{name}"
    df.write.bucketBy(buckets, key).option("path", path).saveAsTable(name)
    return Bucketed(name, path, buckets, spark.table(name))


def discard(spark: SparkSession, *written: Bucketed | None) -> None:
    """Delete tables that nothing reads any more."""
    for one in filter(None, written):
        spark.sql(f"DROP TABLE IF EXISTS {one.name}")
        remove(spark, one.path)


def smallest(df: DataFrame, hashed: Column, rows: int) -> DataFrame:
    """The rows of df with the `rows` smallest values of hashed (more at equal values), the same at every run.

    Only hashes are ranked; the rows themselves are filtered where they are read.
    """
    last = df.select(hashed.alias("h")).orderBy("h").limit(rows).agg(F.max("h")).head()[0]
    return df.filter(hashed <= F.lit(last)) if last is not None else df.limit(0)
