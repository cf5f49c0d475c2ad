"""Counts of a harvest while it runs: metrics that are observed on the way to a sink, and told to a listener.

The counts come with the job that writes, so nothing is read twice. A stream reports them batch by batch, by a
listener of its queries; a batch job at its end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

#: Name of the metrics, and what they are.
METRICS, COUNTS = "outcomes", ("total", "new", "skipped", "failed")


def _counts(success: Column, skipped: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("total"), F.count_if(success & ~skipped).alias("new"), F.count_if(skipped).alias("skipped"), F.count_if(~success & ~skipped).alias("failed")]


def watched(results: DataFrame, success: str = "success", skipped: str = "skipped", name: str = METRICS) -> DataFrame:
    """results as they are; a stream's progress reports their counts under `name`."""
    return results.observe(name, *_counts(F.col(success), F.col(skipped)))


def counted(results: DataFrame, write: Callable[[DataFrame], None], success: str = "success", skipped: str = "skipped") -> dict[str, int]:
    """Counts of the results that `write` writes, by the job that writes them."""
    seen = Observation()
    write(results.observe(seen, *_counts(F.col(success), F.col(skipped))))
    return {c: seen.get[c] for c in COUNTS}


class OutcomeListener(StreamingQueryListener):
    """Adds up the counts of each batch, and tells them as they come: tell(batch number, counts of the batch, totals).

    A batch that is run again after a failure is counted once. Only counts come to the driver.
    """

    def __init__(self, tell: Callable[[int, dict[str, int], dict[str, int]], None] | None = None, name: str = METRICS) -> None:
        self.tell, self.name, self.batches, self.ended = tell, name, {}, []

    @property
    def totals(self) -> dict[str, int]:
        """Counts of all batches so far."""
        return {c: sum(b[c] for b in self.batches.values()) for c in COUNTS}

    def onQueryStarted(self, event) -> None:  # noqa: N802  Spark's names
        """Nothing is counted yet."""

    def onQueryProgress(self, event) -> None:  # noqa: N802
        row = event.progress.observedMetrics.get(self.name)
        if row is None:
            return
        own = {c: row[c] for c in COUNTS}
        self.batches[(str(event.progress.id), event.progress.batchId)] = own
        if self.tell:
            self.tell(event.progress.batchId, own, self.totals)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        """An idle trigger has no counts."""

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended.append((str(event.id), event.exception))


def listening(spark: SparkSession, run: Callable[[], None], tell: Callable | None = None, name: str = METRICS) -> dict[str, int]:
    """Totals of the streams that `run` starts and waits for."""
    listener = OutcomeListener(tell, name)
    spark.streams.addListener(listener)
    try:
        run()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()  # reports come after the batches
    finally:
        spark.streams.removeListener(listener)
    return listener.totals
