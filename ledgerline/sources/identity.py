"""Identity keys: whole numbers without gaps, given once to each business key and never again to another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.operators import changes as ch
from ledgerline.operators.joins import spread_join
from ledgerline.operators.pairing import number_rows
from ledgerline.sources.tables import BucketedTable, _Files, _index_names, _numbers
from ledgerline.workspace import materialize

_MARKER = "_COMMITTED"


class IdentityKeys:
    """The numbers given so far, under ``root``: ``keys`` and ``name`` in ``v=N/bucket=B``.

    A batch of rows reserves a dense block of numbers above the stored high-water mark, as many as it has new keys; the
    marker that commits the batch holds the new mark. Inside the block keys are numbered in their own order, by all
    tasks (no sort in one task). So numbers are unique and dense, a batch repeated under its token gets the numbers it
    had, and a batch that died before its marker leaves no gap. Only buckets of the batch's keys are read. Rows with a
    NULL key get no number. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], name: str = "id", buckets: int = 64):
        self.spark, self.root, self.keys, self.name = spark, root.rstrip("/"), list(keys), name
        self._files = _Files(spark, self.root)
        self._place = BucketedTable(spark, self.root, keys, buckets)

    def _commits(self) -> list[tuple[int, int, str]]:
        """Version, high-water mark and token of each committed batch."""
        found = []
        for path in self._files.glob(f"{self.root}/v=*/{_MARKER}.*"):
            version, marker = path.split("/")[-2:]
            _, mark, token = marker.split(".", 2)
            found.append((int(version.removeprefix("v=")), int(mark), token))
        return sorted(found)

    def high_water(self) -> int:
        """The largest number given; the next batch starts above it."""
        return max((mark for _, mark, _ in self._commits()), default=0)

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """Keys and numbers, of all or some buckets; their folders alone are listed and read."""
        wanted = None if buckets is None else set(buckets)
        committed = {version for version, _, _ in self._commits()}
        paths = []
        for path in self._files.glob(f"{self.root}/v=*/_BUCKETS.*"):
            folder, index = path.rsplit("/", 1)
            if int(folder.rsplit("v=", 1)[1]) in committed:
                paths += [f"{folder}/bucket={b}" for b in _numbers(index) if wanted is None or b in wanted]
        if not paths:
            raise FileNotFoundError(f"no numbers under {self.root}")
        return self.spark.read.parquet(*sorted(set(paths)))

    def assign(self, rows: DataFrame, token: str) -> DataFrame:
        """``rows`` with their numbers; keys that have none get theirs now, once per token."""
        usable, _ = ch.split_valid(rows.select(*self.keys), self.keys)
        wanted = materialize(usable.distinct(), "identity-keys")
        buckets = self._place.touched(wanted)
        if not any(t == token for _, _, t in self._commits()):
            self._give(wanted, buckets, token)
        if not buckets:
            return rows.withColumn(self.name, F.lit(None).cast("bigint"))
        return spread_join(rows, self.read(buckets), self.keys, "left")

    def _give(self, wanted: DataFrame, buckets: list[int], token: str) -> None:
        try:
            new = wanted.join(self.read(buckets), self.keys, "left_anti")
        except FileNotFoundError:
            new = wanted
        mark, known = self.high_water(), [int(p.split("=")[-1]) for p in self._files.glob(f"{self.root}/v=*")]
        target = f"{self.root}/v={max(known, default=0) + 1}"
        numbered = number_rows(new, self.keys, "_n").select(*self.keys, (F.col("_n") + mark).cast("bigint").alias(self.name))
        placed = numbered.withColumn("bucket", self._place.bucket()).hint("rebalance", "bucket")
        placed.write.mode("overwrite").partitionBy("bucket").parquet(target)
        held = [int(p.rsplit("=", 1)[1]) for p in self._files.glob(f"{target}/bucket=*")]
        given = self.spark.read.parquet(target).count() if held else 0
        for name in _index_names(held):
            self._files.touch(f"{target}/{name}")
        self._files.touch(f"{target}/{_MARKER}.{mark + given}.{token}")
