"""Expectations on a stream: rows that fail are stored apart, and each micro-batch leaves its counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ledgerline.operators.quality import DROP, FAIL, WARN
from ledgerline.sources.tables import _Files
from ledgerline.streaming.apply import batch_token
from ledgerline.streaming.ingest import run_batches

#: Names of the rules that a row failed.
FAILED = "failed_rules"


class ExpectedTable:
    """Rows of a stream under ``rows/batch=TOKEN/accepted=...``, counts under ``metrics/batch=TOKEN``. A repeated batch replaces itself."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._files = _Files(spark, self.root)

    def _part(self, accepted: bool) -> DataFrame | None:
        base = f"{self.root}/rows"
        found = self._files.glob(f"{base}/batch=*/accepted={str(accepted).lower()}")
        return self.spark.read.option("basePath", base).parquet(*found).drop("batch", "accepted") if found else None

    def accepted(self) -> DataFrame | None:
        rows = self._part(True)
        return None if rows is None else rows.drop(FAILED)

    def rejected(self) -> DataFrame | None:
        """Rows with the names of the rules that they failed."""
        return self._part(False)

    def metrics(self) -> DataFrame:
        """``batch``, ``rule``, ``passed``, ``failed`` for each micro-batch."""
        return self.spark.read.parquet(f"{self.root}/metrics")


def expect_stream(
    stream: DataFrame, rules: Mapping[str, Column], table: ExpectedTable, checkpoint: str, action: str = DROP
) -> None:
    """Check every row of the stream. NULL counts as failed.

    ``warn`` accepts all rows, ``drop`` stores the failing ones apart, ``fail`` stops before a batch with one is kept. Rows are
    read and written once; the counts come along with the write.
    """
    if action not in (WARN, DROP, FAIL):
        raise ValueError(f"unknown action {action!r}")
    names = list(rules)

    def check(batch: DataFrame, batch_id: int) -> None:
        token = batch_token(batch.sparkSession, checkpoint, batch_id)
        failures = F.array_compact(F.array(*[F.when(~F.coalesce(rules[n], F.lit(False)), F.lit(n)) for n in names]))
        marked = batch.withColumn(FAILED, failures)
        if action == FAIL:
            message = F.concat(F.lit("expectation failed: "), F.array_join(FAILED, ", "))
            marked = marked.withColumn(FAILED, F.when(F.size(FAILED) == 0, F.col(FAILED)).otherwise(F.raise_error(message)))
        counts = Observation()
        seen = marked.observe(
            counts, F.count(F.lit(1)).alias("n"),
            *[F.count_if(F.array_contains(FAILED, n)).alias(f"f{k}") for k, n in enumerate(names)],
        )
        accepted = F.lit(True) if action == WARN else F.size(FAILED) == 0
        path = f"{table.root}/rows/batch={token}"
        seen.withColumn("accepted", accepted).write.mode("overwrite").partitionBy("accepted").parquet(path)
        found = counts.get
        rows = [(n, found["n"] - found[f"f{k}"], found[f"f{k}"]) for k, n in enumerate(names)]
        batch.sparkSession.createDataFrame(rows, "rule string, passed long, failed long").coalesce(1).write.mode(
            "overwrite").parquet(f"{table.root}/metrics/batch={token}")

    run_batches(stream, check, checkpoint)
