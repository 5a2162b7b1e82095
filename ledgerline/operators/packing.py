"""Messages that carry an array of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerline.operators.ordered import with_stable_id

# Fixed value: records per message.
MESSAGE_SIZE = 10_500


def pack_batches(df: DataFrame, columns: Sequence[str] | None = None, size: int = MESSAGE_SIZE, body: str = "body") -> DataFrame:
    """Collect records into messages of at most ``size`` records.

    A message never crosses an input partition, so each one is complete after
    the map side; the shuffle only moves finished arrays.
    """
    columns = list(columns or df.columns)
    numbered = with_stable_id(df.select(*columns), "_id")
    # The upper bits of the id are the partition, the lower 33 bits the row in it.
    part, row = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit(2**33 - 1))
    return (
        numbered.groupBy(part.alias("_part"), F.floor(row / size).alias("_group"))
        .agg(F.collect_list(F.struct(*columns)).alias(body))
        .select(body)
    )


def unpack_batches(df: DataFrame, body: str = "body") -> DataFrame:
    """The records of all messages; works on streams as well."""
    return df.select(F.inline(F.col(body)))
