"""What several operators share: words, row keys, stored tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.workspace import new_dir

#: Words are runs of characters other than ASCII white space, the set on which ``bytes.split()`` splits too.
WORD = r"[^\x20\x09-\x0D]+"

#: Shuffle files of a finished job go with it: its result is a stored table by then.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(df: DataFrame) -> None:
    """Let Spark hand texts to Python in batches of 8 MB; the default of 64 MB is held several times over in every task.

    A setting that the session has made itself stays.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH, None) in (None, "67108864b", "67108864", "64m", "64MB"):
        conf.set(_BATCH, "8m")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    if pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    return column.cast(pa.binary()).to_pylist()


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the stored rows, which no lost executor can take away."""
    spark = df.sparkSession
    path = new_dir(spark, label)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks of integer keys: equal keys have equal ranks."""
    return np.unique(keys, return_inverse=True)[1]


def window_keys(words: list[bytes], size: int) -> np.ndarray:
    """One integer per window of ``size`` words; windows are equal exactly if their integers are."""
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))
    if len(words) < size:
        return ids[:0]
    room, keys, covered = max(len(seen), 1), ids, 1
    limit = 2**62 // room
    top = room
    while covered < size:
        if top > limit:
            keys = ranks(keys)
            top = len(keys)
        keys = keys[:-1] * room + ids[covered:]
        top, covered = top * room, covered + 1
    return keys


def byte_set(members) -> np.ndarray:
    """Whether each byte is one of ``members``."""
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


SPACES = byte_set([0x20, *range(0x09, 0x0E)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


_BASE = 0xA0761D6478BD642F
_BASE_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, count: int) -> np.ndarray:
    """1, base, base**2 ... modulo 2**64."""
    out = np.full(count, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, out=out)


class Words:
    """The words of a column of texts, as positions in its UTF-8 bytes: no object per word.

    ``data`` holds the bytes of all texts, ``text_at`` where each text begins (one entry more than texts), ``starts`` and
    ``stops`` the bytes of each word, ``first`` the number of the first word of each text (one entry more). A null text
    has no words. Words are runs of bytes outside ``spaces``; ``lower`` turns A-Z small.
    """

    def __init__(self, column: pa.Array, spaces: np.ndarray = SPACES, lower: bool = False):
        held = filled(column)
        _, offsets, data = held.buffers()
        self.text_at = np.frombuffer(offsets, dtype=np.int64)[held.offset : held.offset + len(held) + 1]
        low, high = int(self.text_at[0]), int(self.text_at[-1])
        whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data, self.text_at = whole[low:high], self.text_at - low
        if lower:
            self.data = _LOWER[self.data]
        inside = ~spaces[self.data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edges = self.text_at[(self.text_at > 0) & (self.text_at < len(self.data))]
        begins[edges] = inside[edges]
        ends[edges - 1] = inside[edges - 1]
        self.starts, self.stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, self.text_at)

    def __len__(self) -> int:
        return len(self.starts)

    def spelled(self, at: np.ndarray | None = None) -> pa.Array:
        """The words, or those with the ascending numbers ``at``, as binary values."""
        starts, stops = (self.starts, self.stops) if at is None else (self.starts[at], self.stops[at])
        offsets = np.zeros(len(starts) + 1, dtype=np.int64)
        np.cumsum(stops - starts, out=offsets[1:])
        low, high = (int(starts[0]), int(stops[-1])) if len(starts) else (0, 0)
        turns = np.zeros(high - low + 1, dtype=np.int8)
        turns[starts - low] += 1
        turns[stops - low] -= 1
        letters = self.data[low:high][np.cumsum(turns[:-1], dtype=np.int8).view(bool)]
        return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, from powers of an odd number; words that differ may share one."""
        letters = (self.data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        sums = np.zeros(len(letters) + 1, dtype=np.uint64)
        np.cumsum(letters * _powers(_BASE, len(letters)), out=sums[1:])
        h = (sums[self.stops] - sums[self.starts]) * _powers(_BASE_INVERSE, len(letters) + 1)[self.starts]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))

    def ids(self) -> np.ndarray:
        """A number for each word, equal exactly for equal words."""
        return self.spelled().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def filled(column: pa.Array) -> pa.Array:
    """A string column as large binary without nulls."""
    held = column.cast(pa.large_string()).cast(pa.large_binary())
    return held.fill_null(b"") if held.null_count else held


def batch_function(run: Callable[[pa.Array], pa.Array], field_type: str) -> Callable[..., Column]:
    """``run`` as a column function on Arrow batches, each cut to at most 500 rows so that results stay small too."""

    def over(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [run(batch.slice(a, 500)) for a in range(0, len(batch), 500)]
            yield pa.concat_arrays(parts) if parts else run(batch)

    over.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}  # as objects: Spark reads them
    return F.arrow_udf(over, field_type)
