"""Volume and throughput of a stored table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

_KIB = 1024.0


def volume(df: DataFrame) -> DataFrame:
    """``rows`` and ``text_bytes``: what all columns take as text. NULL takes nothing."""
    widths = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)).cast("bigint") for c in df.columns]
    width = reduce(lambda a, b: a + b, widths, F.lit(0).cast("bigint"))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("text_bytes"))


def throughput(df: DataFrame, seconds: float) -> DataFrame:
    """The volume of ``df`` with the rates of a run that took ``seconds``: rows and MiB a second, GiB a minute."""
    if seconds <= 0:
        raise ValueError("seconds must be positive")
    mib = F.col("text_bytes") / _KIB**2
    return volume(df).withColumns({
        "seconds": F.lit(float(seconds)),
        "rows_a_second": F.col("rows") / seconds,
        "mib_a_second": mib / seconds,
        "gib_a_minute": mib / _KIB * 60 / seconds,
    })
