"""Session and table helpers shared by queries, tests and the bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session with the settings every query assumes: UTC, AQE, ANSI defaults."""
    return (
        SparkSession.builder.master(master)
        .appName("gavel")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder, read by Spark alone so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a table that one task sorts or groups.
PER_TASK = 250_000


def spread(rows: DataFrame, of: int, *keys: str) -> DataFrame:
    """rows dealt by keys to as many tasks as a table of so many rows needs, where the session's own number is too small.

    A task's memory then stays the same however large the table is; groups, windows and joins by these keys need no
    further shuffle.
    """
    tasks = of // PER_TASK
    return rows.repartition(tasks, *keys) if tasks > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below spark.checkpoint.dir, which all machines see; a temporary one where that is unset (a local test)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = known.get() if known.isDefined() else tempfile.mkdtemp(prefix="gavel-")
        if not known.isDefined():
            spark.sparkContext.setCheckpointDir(folder)
    return f"{folder}/{label}-{uuid.uuid4().hex}"
