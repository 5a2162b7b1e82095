"""Clustering by several keys along a space-filling curve, so that a filter on any of them skips most of a table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from ledgerline.sources.tables import _Files

#: Bits of a key's rank; the curve takes one of each key in turn.
BITS = 8
#: Relative error of the quantiles that rank the values.
ERROR = 0.002


def ordered_number(df: DataFrame, name: str) -> Column:
    """A number in the order of a column's values: its value, its time, or the first six bytes of a text. NULL stays NULL."""
    kind, column = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (NumericType, BooleanType)):
        return column.cast("double")
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if isinstance(kind, StringType):
        head = F.rpad(F.substring(F.hex(column.cast("binary")), 1, 12), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    raise TypeError(f"cannot order column {name} of type {kind.simpleString()}")


def with_curve(df: DataFrame, keys: Sequence[str], name: str = "_curve") -> DataFrame:
    """Add the place of each row on a Hilbert curve over the ranks of its keys.

    Neighbours on this curve are neighbours in every key, so a file that holds any stretch of it covers a small range of
    each; a Z-order curve jumps, and files that are not cut exactly at its corners cover whole keys. Ranks come from approximate quantiles, so skewed values spread evenly; equal values have one rank, NULLs the first.
    The driver holds 2**BITS numbers for each key.
    """
    numbers = [f"_number_{k}" for k in range(len(keys))]
    numbered = df.withColumns({n: ordered_number(df, key) for n, key in zip(numbers, keys, strict=True)})
    shares = [k / (1 << BITS) for k in range(1, 1 << BITS)]
    cuts = numbered.approxQuantile(numbers, shares, ERROR)
    ranked = numbered.withColumns({n: _rank(F.col(n), sorted(bounds)) for n, bounds in zip(numbers, cuts, strict=True)})
    place = F.arrow_udf(_curve_function(len(keys)), "long")
    return ranked.withColumn(name, place(*numbers)).drop(*numbers)


def _curve_function(keys: int) -> Callable[..., pa.Array]:
    """Place on the curve of a batch of ranks. Shipped whole: executors need not have this package."""
    bits = BITS

    def place(*ranks: pa.Array) -> pa.Array:
        axes = [r.to_numpy(zero_copy_only=False).astype(np.int64) for r in ranks]
        step = 1 << (bits - 1)
        while step > 1:  # from the largest cells down: turn each cell so that its path meets its neighbours'
            for k in range(keys):
                far = axes[k] & step > 0
                swap = np.where(far, 0, (axes[0] ^ axes[k]) & (step - 1))
                axes[0] ^= np.where(far, step - 1, swap)
                axes[k] ^= swap
            step >>= 1
        for k in range(1, keys):
            axes[k] ^= axes[k - 1]
        turn, step = np.zeros_like(axes[0]), 1 << (bits - 1)
        while step > 1:
            turn ^= np.where(axes[-1] & step > 0, step - 1, 0)
            step >>= 1
        out = np.zeros_like(axes[0])
        for bit in reversed(range(bits)):
            for axis in axes:
                out = out << 1 | (axis ^ turn) >> bit & 1
        return pa.array(out)

    place.__annotations__ = {"ranks": pa.Array, "return": pa.Array}  # as objects: Spark reads them
    return place


def _rank(number: Column, bounds: list[float]) -> Column:
    """How many of the sorted bounds are below the number: halved step by step, as one expression."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(number > bounds[middle], search(middle + 1, high)).otherwise(search(low, middle))

    return F.coalesce(F.when(number.isNotNull(), search(0, len(bounds))), F.lit(0)).cast("int")


def write_on_curve(df: DataFrame, path: str, keys: Sequence[str], files: int | None = None, mode: str = "overwrite") -> None:
    """Write in the order of the curve. Each file covers a small range of every key, which its statistics show to scans."""
    curved = with_curve(df, keys)
    ranged = curved.repartitionByRange(files, "_curve") if files else curved.repartitionByRange("_curve")
    ranged.sortWithinPartitions("_curve").drop("_curve").write.mode(mode).parquet(path)


class ClusteredTable:
    """A table to which rows are appended as they come and whose new files alone are clustered later.

    Rows land in ``new/LOT``; ``cluster`` writes the lots that are not clustered yet, together, as one clustered folder and
    then names them in its marker. Readers take the clustered folders and the lots that none of them holds, so a run that
    dies changes nothing, and clustered files are never written again. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str]):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self._files = _Files(spark, self.root)

    def append(self, df: DataFrame, lot: str) -> None:
        """Write a lot, whole or not at all; a lot that was written before stays as it is."""
        if not self._files.exists(f"{self.root}/new/{lot}"):
            df.write.mode("overwrite").parquet(f"{self.root}/staged/{lot}")
            self._files.move(f"{self.root}/staged/{lot}", f"{self.root}/new/{lot}")

    def _clustered(self) -> dict[str, set[str]]:
        """Clustered folders that are complete, with the lots each holds."""
        found: dict[str, set[str]] = {}
        for path in self._files.glob(f"{self.root}/clustered/*/_LOT.*"):
            folder, name = path.rsplit("/", 1)
            if self._files.exists(f"{folder}/_COMMITTED"):
                found.setdefault(folder, set()).add(name.removeprefix("_LOT."))
        return found

    def waiting(self) -> list[str]:
        """Lots that no clustered folder holds."""
        held = set().union(*self._clustered().values(), set())
        return sorted(p.rsplit("/", 1)[1] for p in self._files.glob(f"{self.root}/new/*") if p.rsplit("/", 1)[1] not in held)

    def cluster(self, files: int | None = None) -> list[str]:
        """Cluster the waiting lots; returns them."""
        lots = self.waiting()
        if lots:
            number = len(self._files.glob(f"{self.root}/clustered/*")) + 1
            target = f"{self.root}/clustered/{number:08d}"
            write_on_curve(self.spark.read.parquet(*[f"{self.root}/new/{lot}" for lot in lots]), target, self.keys, files)
            for lot in lots:
                self._files.touch(f"{target}/_LOT.{lot}")
            self._files.touch(f"{target}/_COMMITTED")
        return lots

    def read(self) -> DataFrame:
        return self.spark.read.parquet(*self._clustered(), *[f"{self.root}/new/{lot}" for lot in self.waiting()])
