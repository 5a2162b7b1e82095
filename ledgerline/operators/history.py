"""Type 2 history from snapshots, kept without rewriting the past.

Each snapshot writes one folder: the rows that are open after it, and those that it closed. Closed rows are final, so a
later snapshot only reads and replaces the open ones; the whole history is the newest open rows and all closed rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.operators import changes as ch
from ledgerline.sources.tables import _Files

_FORMAT = "%Y%m%dT%H%M%S%f"


class SnapshotHistory:
    """Versions of a table of unique ``keys`` under ``root``. One writer at a time.

    Snapshot rows with a NULL key name nothing; they are stored beside the history (``quarantined``), not dropped.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str]):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self._files = _Files(spark, self.root)

    def _steps(self) -> list[tuple[int, dt.datetime]]:
        """Complete steps with the time of their snapshot, which their marker names."""
        found = []
        for path in self._files.glob(f"{self.root}/v=*/_COMMITTED.*"):
            version, marker = path.split("/")[-2:]
            found.append((int(version.removeprefix("v=")), dt.datetime.strptime(marker.split(".")[1], _FORMAT)))
        return sorted(found)

    def _part(self, version: int, state: str) -> list[str]:
        path = f"{self.root}/v={version}/state={state}"
        return [path] if self._files.exists(path) else []

    def open_rows(self) -> DataFrame | None:
        steps = self._steps()
        if not steps:
            return None
        return self._read(self._part(steps[-1][0], "open"), steps[-1][0])

    def read(self) -> DataFrame:
        """All versions."""
        steps = self._steps()
        if not steps:
            raise FileNotFoundError(f"no snapshot under {self.root}")
        closed = [p for version, _ in steps for p in self._part(version, "closed")]
        return self._read(self._part(steps[-1][0], "open") + closed, steps[-1][0])

    def quarantined(self) -> DataFrame | None:
        """All snapshot rows with a NULL key, with the time ``at`` of their snapshot; count them to know how many."""
        out = None
        for version, at in self._steps():
            part = self.spark.read.parquet(f"{self.root}/v={version}/_quarantine").withColumn("at", F.lit(str(at)).cast("timestamp"))
            out = part if out is None else out.unionByName(part)
        return out

    def _read(self, paths: list[str], version: int) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.root}/v={version}").drop("state").schema
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def apply(
        self, snapshot: DataFrame, at: dt.datetime, *, track_except: Sequence[str] = (), keep: Sequence[str] = (),
        allow_empty: bool = False,
    ) -> None:
        """Take a full snapshot. The rules are those of ``changes.scd2_snapshot``."""
        steps = self._steps()
        if steps and at <= steps[-1][1]:
            raise ValueError("snapshot time must be later than all stored times")
        rows = ch.scd2_snapshot(
            self.open_rows(), snapshot, self.keys, F.lit(str(at)).cast("timestamp"), track_except=track_except, keep=keep, allow_empty=allow_empty
        )
        known = [int(p.split("=")[-1]) for p in self._files.glob(f"{self.root}/v=*")]
        target = f"{self.root}/v={max(known, default=0) + 1}"
        ch.split_valid(snapshot, self.keys)[1].write.mode("overwrite").parquet(f"{target}/_quarantine")
        state = F.when(F.col(ch.END).isNull(), "open").otherwise("closed")
        rows.withColumn("state", state).write.mode("append").partitionBy("state").parquet(target)
        self._files.touch(f"{target}/_COMMITTED.{at.strftime(_FORMAT)}")
