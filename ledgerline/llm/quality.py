"""Quality rules from compression: text that repeats itself compresses too well, noise too badly.

The whole text and fixed chunks of it are compressed by zstandard. Short texts pay for the frame and long ones find
more matches, so the accepted band of ratios (bytes before / bytes after) depends on the length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import small_batches, utf8, window_keys


@dataclass(frozen=True)
class Bands:
    """Limits of the compression rule.

    ``whole``: (bytes up to which the band holds, lowest ratio, highest ratio), ascending; the last holds for all longer texts.
    ``chunk``: the band of a full chunk of ``chunk_bytes`` bytes. A text goes if more than ``bad_share`` of its full chunks
    leave that band. The level is zstandard's.
    """

    whole: tuple[tuple[int, float, float], ...] = (
        (64, 0.50, 2.6), (256, 0.75, 3.6), (1024, 1.00, 4.0), (4096, 1.20, 4.6), (16384, 1.35, 5.2), (2**62, 1.40, 6.0),
    )
    chunk_bytes: int = 2048
    chunk: tuple[float, float] = (1.20, 4.6)
    bad_share: float = 0.25
    level: int = 3


@dataclass(frozen=True)
class BaseRules:
    """A text fails with fewer words than ``min_words`` or a share of repeated words above ``max_repeat_percent``."""

    min_words: int = 10
    window: int = 5
    max_repeat_percent: int = 20


FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "ratio double, n_chunks long, n_bad_chunks long, verdict string, kept boolean"
)
_TYPE = pa.struct([
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("ratio", pa.float64()), ("n_chunks", pa.int64()),
    ("n_bad_chunks", pa.int64()), ("verdict", pa.string()), ("kept", pa.bool_()),
])
_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\r\x0b\x0c"


def repeated_words(words: list[bytes], size: int) -> int:
    """Words that lie in a window of ``size`` words found twice or more."""
    keys = window_keys(words, size)
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(keys, twice)
    covered = np.zeros(len(words), dtype=bool)
    for k in range(size):
        covered[k : k + len(hit)] |= hit
    return int(covered.sum())


def compression(data: bytes, bands: Bands, compressor: zstandard.ZstdCompressor) -> tuple[float, int, int, str]:
    """Ratio of the whole text, full chunks, those outside the band, and the verdict."""
    if not data:
        return 0.0, 0, 0, "empty"
    ratio = len(data) / len(compressor.compress(data))
    low, high = next((a, b) for top, a, b in bands.whole if len(data) <= top)
    size, bad, chunks = bands.chunk_bytes, 0, len(data) // bands.chunk_bytes
    for k in range(chunks):
        part = size / len(compressor.compress(data[k * size : (k + 1) * size]))
        bad += not bands.chunk[0] <= part <= bands.chunk[1]
    verdict = "ok"
    if ratio > high:
        verdict = "repetitive"
    elif ratio < low:
        verdict = "incompressible"
    elif bad > bands.bad_share * chunks:
        verdict = "chunks"
    return ratio, chunks, bad, verdict


def _row(data: bytes, bands: Bands, base: BaseRules, compressor: zstandard.ZstdCompressor) -> tuple:
    words = data.split()
    repeats = repeated_words(words, base.window)
    lines = [x for x in data.split(b"\n") if x.strip(_SPACE)]
    joined = b"".join(words)
    # code points: all bytes but UTF-8 continuation bytes
    chars = len(joined) - len(joined.translate(None, bytes(set(range(256)) - set(range(0x80, 0xC0)))))
    failed = len(words) < base.min_words or 100 * repeats > base.max_repeat_percent * len(words)
    ratio, chunks, bad, verdict = compression(data, bands, compressor)
    if failed:
        verdict = "base"
    return (
        len(words), chars, len(data) - len(data.translate(None, _SYMBOLS)), len(lines) - len(set(lines)), repeats, failed,
        ratio, chunks, bad, verdict, verdict == "ok",
    )


def with_quality(
    df: DataFrame, text: str = "text", into: str = "quality", bands: Bands = Bands(), base: BaseRules = BaseRules()
) -> DataFrame:
    """Add the struct column ``into`` (see ``FIELDS``) to every row; no row moves, none is dropped.

    A null text counts as empty: no words, ``base_failed``. Repeated rows get the same result each. An existing column of
    the name ``into`` is replaced; other columns are untouched.
    """

    small_batches(df)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        compressor = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            parts = (batch.slice(a, 500) for a in range(0, len(batch), 500))
            rows = [_row(data or b"", bands, base, compressor) for part in parts for data in utf8(part)]
            columns = list(zip(*rows, strict=True)) or [()] * _TYPE.num_fields
            yield pa.StructArray.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, _TYPE, strict=True)], fields=list(_TYPE)
            )

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}  # as objects: Spark reads them
    return df.withColumn(into, F.arrow_udf(run, FIELDS)(F.col(text).cast("string")))
