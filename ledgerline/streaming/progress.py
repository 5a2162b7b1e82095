"""Progress of running streams, stored per micro-batch."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ledgerline.sources.tables import _Files

_PROGRESS = (
    "query string, name string, batch long, at string, rows long, rows_in double, rows_done double, seconds double, sources long"
)


class ProgressLog(StreamingQueryListener):
    """Stores rows, rates and duration of each micro-batch of a session's streams under ``root``, a small file each.

    ``rows_in`` and ``rows_done`` are rows a second, as Spark reports them. Use it in a ``with`` statement, or attach and
    detach it. Listeners are told later than queries end; detaching waits until all that was told is written.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._files = _Files(spark, self.root)
        self.ended: set[str] = set()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.id))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {
            "query": str(p.id), "name": p.name, "batch": p.batchId, "at": p.timestamp, "rows": p.numInputRows, "rows_in": _number(p.inputRowsPerSecond),
            "rows_done": _number(p.processedRowsPerSecond), "seconds": p.durationMs.get("triggerExecution", 0) / 1000, "sources": len(p.sources),
        }
        self._files.write(f"{self.root}/{p.id}-{p.batchId}-{uuid.uuid4().hex}.json", json.dumps(row))

    def read(self) -> DataFrame:
        """One row for each micro-batch that had rows; a batch told twice counts once."""
        rows = self.spark.read.schema(_PROGRESS).json(self.root)
        return rows.withColumn("at", F.col("at").cast("timestamp")).where("rows > 0").dropDuplicates(["query", "batch"])


def _number(value: float | None) -> float | None:
    return None if value is None or value != value or value in (float("inf"), float("-inf")) else value


def rates(progress: DataFrame) -> DataFrame:
    """For each query its batches, rows, seconds and rows a second over all batches."""
    total = progress.groupBy("query").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("rows").alias("rows"), F.sum("seconds").alias("seconds"),
        F.max("rows_done").alias("best_rows_a_second"),
    )
    return total.withColumn("rows_a_second", F.col("rows") / F.greatest("seconds", F.lit(0.001)))
