"""Row numbering, positional pairing and reproducible random picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.hashing import hash_index
from ledgerline.operators.joins import lookup_join, spread_join
from ledgerline.operators.ordered import ordered_columns


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_number", slices: int | None = None) -> DataFrame:
    """Consecutive numbers from 1 over the whole frame, without a one-task sort."""
    return ordered_columns(df, [], order, running={name: F.lit(1).cast("bigint")}, slices=slices)


def zip_rows(left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str]) -> DataFrame:
    """Pair the n-th row of one frame with the n-th of the other; the shorter side decides."""
    return number_rows(left, left_order).join(number_rows(right, right_order), "row_number")


def pick_one(
    rows: DataFrame,
    candidates: DataFrame,
    row_key: Column,
    candidate_order: Sequence[str],
    group: Sequence[str] = (),
    salt: str = "pick",
) -> DataFrame:
    """Give every row one candidate of its group, chosen by a hash of the row key.

    Candidates are numbered within their group, so that a row joins exactly one
    of them instead of all. Rows of a group without candidates drop out.
    """
    group = list(group)
    numbered = ordered_columns(
        candidates, group, candidate_order, running={"_number": F.lit(1).cast("bigint")}
    )
    sizes = candidates.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"))
    if group:
        sized = lookup_join(rows, sizes, group)
    else:
        sized = rows.withColumn("_size", sizes.scalar())
    chosen = sized.withColumn(
        "_number", F.when(F.col("_size") > 0, hash_index(row_key, salt, F.col("_size")) + 1)
    )
    return lookup_join(chosen, numbered, [*group, "_number"]).drop("_number", "_size")


def assign_locations(clients: DataFrame, addresses: DataFrame, client_key: Column, address_id: str) -> DataFrame:
    """Home location of every client: one address, and with it the preferred station."""
    return pick_one(clients, addresses, client_key, [address_id], salt="address")


def expand_schedule(df: DataFrame, templates: DataFrame, max_templates: int = 10_000) -> DataFrame:
    """Every row with every template (for example invoice dates for each subscription).

    The templates travel as one array in a one-row frame, so the big side is
    only exploded in place. Their number is checked; a larger template set is
    cut into numbered chunks and handled chunk by chunk by the same expansion.
    """
    rows = templates.limit(max_templates + 1).count()
    if rows <= max_templates:
        array = templates.agg(F.collect_list(F.struct(*templates.columns)).alias("a"))
        return df.withColumn("_t", F.explode(array.scalar())).select(*df.columns, "_t.*")
    numbered = number_rows(templates, templates.columns, "_n")
    chunks = numbered.groupBy(F.floor((F.col("_n") - 1) / max_templates).alias("_chunk")).agg(
        F.collect_list(F.struct(*templates.columns)).alias("_a")
    )
    count = chunks.agg(F.max("_chunk").alias("m"))
    copies = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), count.scalar())))
    joined = spread_join(copies, chunks, ["_chunk"]).withColumn("_t", F.explode("_a"))
    return joined.select(*df.columns, "_t.*")
