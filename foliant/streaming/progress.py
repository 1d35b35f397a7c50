"""What a running crawl has read, saved and given up, batch by batch.

The counts are observed on the stream while its rows flow past, at no extra pass, and
reported with the progress of each micro-batch; a listener lands them as one small file per
batch, which a batch that runs again overwrites.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from foliant.operators import triage as t

NAME = "crawl_progress"
DISPOSITIONS = {"saved": t.SAVED, "failed": t.FAILED, "duplicate": t.DUPLICATE, "non_english": t.NON_ENGLISH, "blocked": t.BLOCKED}
COUNTS = ["read", *DISPOSITIONS]


def observed(settled: DataFrame) -> DataFrame:
    """The rows of a stream of settled pages, counted by disposition as they pass."""
    counts = [F.count_if(F.col("disposition").eqNullSafe(F.lit(value))).alias(name) for name, value in DISPOSITIONS.items()]
    return settled.observe(NAME, F.count(F.lit(1)).alias("read"), *counts)


class ProgressLog(StreamingQueryListener):
    """Lands the counts of every batch below ``path``; register with ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = progress.observedMetrics.get(NAME)
        if found is None:
            return
        row = [(progress.batchId, *(found[c] or 0 for c in COUNTS))]
        schema = "batch bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)
        target = f"{self.path}/query={progress.id}/batch_id={progress.batchId}"
        self.spark.createDataFrame(row, schema).coalesce(1).write.mode("overwrite").parquet(target)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def wait(self, query, seconds: float = 60) -> bool:
        """Until all that ``query``, which has ended, reported is landed: its end is told last."""
        with self._news:
            return self._news.wait_for(lambda: str(query.runId) in self._ended, seconds)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """(query, batch, counts) of all batches landed so far."""
    return spark.read.parquet(path).select("query", "batch", *COUNTS)
