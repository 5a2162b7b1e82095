"""A fact stream joined to dimensions that change while it runs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.operators.joins import lookup_join
from ledgerline.sources.tables import VersionedTable
from ledgerline.streaming.apply import batch_token
from ledgerline.streaming.ingest import run_batches
from ledgerline.workspace import materialize


@dataclass(frozen=True)
class Dimension:
    """``read`` gives the newest committed rows whenever it is called; they are unique on ``on``, and ``columns`` are added."""

    read: Callable[[], DataFrame]
    on: Sequence[str]
    columns: Sequence[str]


class StarSink:
    """Facts with their dimension columns under ``root/facts/batch=TOKEN``, and those that still wait for a dimension row.

    Each micro-batch binds the dimensions anew, takes the rows that wait along and stores the rows without a match of some
    dimension as the next version of the waiting rows, which is published last, under the number of the batch. A batch
    whose version is there is done; one that died before starts again from the version before and replaces its facts.
    So a row is in the facts once. One stream at a time, which keeps its checkpoint.
    """

    def __init__(self, spark: SparkSession, root: str, dimensions: Mapping[str, Dimension]):
        self.spark, self.root, self.dimensions = spark, root.rstrip("/"), dict(dimensions)
        self._waiting = VersionedTable(spark, f"{self.root}/waiting")

    def waiting(self) -> DataFrame | None:
        """Facts whose dimension rows have not come yet, with ``missing``, the dimensions that lack them, and ``since``,
        the number of the batch that brought them. Count them to know how many."""
        return self._waiting.read() if self._waiting.versions() else None

    def facts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/facts").drop("batch")

    def apply(self, batch: DataFrame, number: int, token: str) -> None:
        """Take a micro-batch, once per ``number``; numbers count up from 0."""
        earlier = self._waiting.versions()
        if number + 1 in earlier:
            return
        rows = batch.withColumn("since", F.lit(number).cast("bigint"))
        if earlier:
            rows = rows.unionByName(self._waiting.read(earlier[-1]).drop("missing"))
        lacking = []
        for name, dimension in self.dimensions.items():
            lookup = dimension.read().select(*dimension.on, *dimension.columns).withColumn(f"_has_{name}", F.lit(True))
            rows = lookup_join(rows, lookup, dimension.on, "left")
            lacking.append(F.when(F.col(f"_has_{name}").isNull(), F.lit(name)))
        marks, added = [f"_has_{n}" for n in self.dimensions], [c for d in self.dimensions.values() for c in d.columns]
        joined = materialize(rows.withColumn("missing", F.array_compact(F.array(*lacking))).drop(*marks), "star-batch")
        complete = joined.where(F.size("missing") == 0).drop("missing", "since")
        complete.write.mode("overwrite").parquet(f"{self.root}/facts/batch={token}")
        self._waiting.publish(joined.where(F.size("missing") > 0).drop(*added), number + 1)

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        """Take what a stream has now."""
        run_batches(stream, lambda batch, number: self.apply(batch, number, batch_token(self.spark, checkpoint, number)), checkpoint)
