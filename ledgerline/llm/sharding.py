"""Shards of near-equal bytes through sampled splitters.

Rows are ordered by (MD5 of the text, id), so copies of one text lie side by side and the order is random otherwise. A
sample weighted by size gives quantile boundaries; every row goes to the range between two boundaries; ranges that turn
out too large are cut again by boundaries sampled inside them. Each range is then small enough for one task, which sums
its rows in order; with the exact sums of the ranges before it, every row knows its place among all bytes, and the
shard is that place in units of an N-th of the total. A shard therefore misses its share by less than one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import store

#: Rows that a range should hold, and the factor above which it is cut again.
RANGE_ROWS = 100_000
OVERFULL = 1.5
#: Expected sample rows per range; the sample has 16 bytes for each, whatever the rows hold.
SAMPLE_PER_RANGE = 24


def locate(hashes: np.ndarray, ids: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """For each (hash, id) the number of splitters that are at most it. Splitters: (n, 2), ascending."""
    left = np.searchsorted(splitters[:, 0], hashes, "left")
    right = np.searchsorted(splitters[:, 0], hashes, "right")
    place = right.copy()
    tied = np.flatnonzero(right > left)
    for a in np.unique(left[tied]):  # one turn for each hash that is cut
        rows = tied[left[tied] == a]
        place[rows] = a + np.searchsorted(splitters[a : right[rows[0]], 1], ids[rows], "right")
    return place


def _range_of(splitters: np.ndarray):
    def run(hashes: pa.Array, ids: pa.Array) -> pa.Array:
        return pa.array(locate(hashes.to_numpy(False), ids.to_numpy(False), splitters).astype(np.int32))

    run.__annotations__ = {"hashes": pa.Array, "ids": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "int")


def _quantiles(sample: np.ndarray, pieces: int) -> np.ndarray:
    """Up to ``pieces - 1`` distinct boundaries that cut the sorted sample evenly."""
    if not len(sample) or pieces < 2:
        return sample[:0]
    at = np.linspace(0, len(sample), pieces + 1)[1:-1].astype(int)
    return np.unique(sample[at], axis=0)


def _drawn(rows: DataFrame, rate: Column) -> np.ndarray:
    """(hash, id) of rows drawn with the given rate; the draw is a hash of the row, so reruns agree."""
    unit = F.pmod(F.xxhash64("_h", "_id", F.lit("draw")), F.lit(1 << 30)) / float(1 << 30)
    found = rows.where(unit < rate).select("_h", "_id").toPandas().to_numpy(dtype=np.int64).reshape(-1, 2)
    return np.unique(found, axis=0)


def splitters(rows: DataFrame, total: int, count: int, range_rows: int = RANGE_ROWS) -> np.ndarray:
    """Boundaries of ranges over ``rows`` (_h, _id, _size) with ``count`` rows and ``total`` bytes.

    The sample and the boundaries come to the driver: 24 x 16 bytes for each 100,000 rows, a four-thousandth of a byte
    per row. Ranges beyond ``OVERFULL`` times their rows or bytes are cut again until none is left that can be cut.
    """
    pieces = max(1, -(-count // range_rows))
    if pieces == 1:
        return np.zeros((0, 2), dtype=np.int64)
    mean = total / count
    weight = (F.col("_size") / mean + 1) / 2  # bytes and rows both matter to a task
    found = _quantiles(_drawn(rows, weight * (SAMPLE_PER_RANGE * pieces / count)), pieces)
    for _ in range(8):
        ranged = rows.withColumn("_range", _range_of(found)("_h", "_id"))
        full = (
            ranged.groupBy("_range").agg(F.count("*").alias("n"), F.sum("_size").alias("b"))
            .where((F.col("n") > OVERFULL * range_rows) | (F.col("b") > OVERFULL * mean * range_rows)).where("n > 1")
        ).toPandas()
        if full.empty:
            return found
        load = np.maximum(full["n"] / range_rows, full["b"] / (mean * range_rows))
        rates = {int(r): float(SAMPLE_PER_RANGE * 2 * x / n) for r, x, n in zip(full["_range"], load, full["n"], strict=True)}
        inside = ranged.where(F.col("_range").isin(list(rates)))
        rate = F.element_at(F.create_map(*[F.lit(v) for kv in rates.items() for v in kv]), F.col("_range"))
        sample = _drawn(inside, rate * weight)
        place = locate(sample[:, 0], sample[:, 1], found)
        new = [found]
        for r, x in zip(full["_range"], load, strict=True):
            new.append(_quantiles(sample[place == r], int(np.ceil(2 * x))))
        grown = np.unique(np.concatenate(new), axis=0)
        if len(grown) == len(found):
            return found
        found = grown
    return found


def shard(
    df: DataFrame, shards: int, text: str = "text", id_column: str = "doc_id", range_rows: int = RANGE_ROWS
) -> DataFrame:
    """``id``, ``size`` (UTF-8 bytes of the text plus 8), ``text_crc32``, ``shard`` and ``slot`` (gapless from 0) per row.

    The sizes of two shards differ by less than the two rows at their ends. Null texts count as empty, null ids come
    first, repeated rows get slots of their own. Of the input only id and text are read; columns of any other name do no
    harm. An empty table gives no rows.
    """
    spark = df.sparkSession
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = store(
        df.select(
            F.col(id_column).cast("long").alias("_key"),
            F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63))).alias("_id"),
            F.conv(F.substring(F.md5(content.cast("binary")), 1, 15), 16, 10).cast("long").alias("_h"),
            (F.octet_length(content).cast("long") + 8).alias("_size"),
            F.crc32(content.cast("binary")).alias("_crc"),
        ),
        "sizes",
    )
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("_size"), F.lit(0))).first()
    found = splitters(rows, total, max(n, 1), range_rows)
    parts = len(found) + 1
    ranged = rows.withColumn("_range", _range_of(found)("_h", "_id"))
    by = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = (  # one row for each range
        ranged.groupBy("_range").agg(F.sum("_size").alias("b"))
        .select("_range", F.coalesce(F.sum("b").over(by), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy("_range").orderBy("_h", "_id", "_crc", "_size")
    width = min(parts, 20_000)
    placed = (
        ranged.repartition(width, "_range").join(before, "_range")
        .withColumn("_sum", F.sum("_size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_middle", F.col("_before") + F.col("_sum") - F.col("_size") / 2)
        .withColumn("shard", F.least(F.floor(F.col("_middle") * shards / float(max(total, 1))), F.lit(shards - 1)).cast("int"))
        .withColumn("_row", F.row_number().over(Window.partitionBy("_range", "shard").orderBy("_h", "_id", "_crc", "_size")))
    )
    stored = store(placed.select("_key", "_size", "_crc", "_range", "shard", "_row"), "placed")
    over = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    first = (  # one row for each range and shard
        stored.groupBy("shard", "_range").agg(F.count("*").alias("n"))
        .select("shard", "_range", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("_first"))
    )
    return stored.join(first, ["shard", "_range"]).select(
        F.col("_key").alias(id_column),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        "shard",
        (F.col("_first") + F.col("_row") - 1).cast("long").alias("slot"),
    )
