"""Incremental harvest: batches of documents, of which only new ones are stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_only(batch: DataFrame, known: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of a batch whose key is not known yet, each key once, the first in order."""
    fresh = batch.join(known.select(key).distinct(), key, "left_anti")
    first = fresh.groupBy(key).agg(F.min_by(F.struct(*[c for c in fresh.columns if c != key]), order).alias("r"))
    return first.select(key, "r.*")


def harvest_stream(source: DataFrame, path: str, checkpoint: str, key: str, order: str) -> StreamingQuery:
    """Append to the table at path what a stream brings and the table lacks.

    Each batch goes to a folder named after it and replaces that folder when it is run again, so a batch that was
    half written is neither lost nor doubled. Known keys are read from the other batches' folders alone.
    """

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        keyed = batch.withColumn("batch", F.lit(number))
        try:
            known = spark.read.schema(keyed.schema).option("basePath", path).parquet(path).filter(F.col("batch") < number)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            known = keyed.limit(0)
        new_only(batch, known, key, order).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return source.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def seen_once(source: DataFrame, key: str, time: str, late: str = "10 minutes") -> DataFrame:
    """Stream without repeats of a key that come within the watermark's delay."""
    return source.withColumn("__time", F.col(time).cast("timestamp")).withWatermark("__time", late).dropDuplicatesWithinWatermark([key]).drop("__time")


def counts_by_window(source: DataFrame, time: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows a time window; the harvest itself has no such operator."""
    stamped = source.withColumn("__time", F.col(time).cast("timestamp")).withWatermark("__time", late)
    return stamped.groupBy(F.window("__time", width).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as a stream of files, one a batch."""
    path = f"{folder}/{name}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
