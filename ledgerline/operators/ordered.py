"""Neighbour values and running sums within a group, for groups of any size.

A plain window sends a whole group to one task. That is right for the usual
group, and wrong for a key that holds a large part of all rows, or for no key at
all. Here such input is range-partitioned on (group, order), so that a big
group spans many slices. Each slice works on its own rows, and only the first
and last row of a slice travel to its neighbours.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import MapType
from pyspark.sql.window import Window

from ledgerline.workspace import materialize

#: Rows that one task may reasonably sort for a single group.
GROUP_LIMIT = 2_000_000


#: Rows of a group at the limit that the size estimate should see.
_SEEN = 1_000


def large_groups(df: DataFrame, keys: Sequence[str], limit: int = GROUP_LIMIT, rows: str | None = None) -> DataFrame:
    """Keys with about ``limit`` rows or more; with ``rows``, also their estimated number under that name.

    The sizes are estimated from a sample of the key columns: they choose how the
    work is spread, never which rows take part. At most about (rows / limit)
    keys can come back.
    """
    fraction = min(1.0, _SEEN / limit)
    seen = df.select(*keys)
    seen = seen.sample(fraction=fraction, seed=11) if fraction < 1.0 else seen
    sizes = seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    large = sizes.filter(F.col("_n") > limit * fraction)
    return large.select(*keys, *([(F.col("_n") / fraction).cast("bigint").alias(rows)] if rows else []))


def sized_groups(df: DataFrame, keys: Sequence[str], limit: int = GROUP_LIMIT) -> DataFrame:
    """Large keys as ``_key`` with about how many rows they have, ``_rows``; all others together are the row of no key.

    The sample of ``large_groups`` in one pass that also tells about how many rows there are.
    """
    fraction = min(1.0, _SEEN / limit)
    seen = df.select(*keys)
    seen = seen.sample(fraction=fraction, seed=11) if fraction < 1.0 else seen
    sizes = seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    key = F.when(F.col("_n") > limit * fraction, F.struct(*keys)).alias("_key")
    return sizes.groupBy(key).agg((F.sum("_n") / fraction).cast("bigint").alias("_rows"))


def has_large_group(df: DataFrame, keys: Sequence[str], limit: int = GROUP_LIMIT) -> bool:
    return not large_groups(df, keys, limit).isEmpty()


def row_hash(df: DataFrame) -> Column:
    """Hash of the content of a row (map columns have no order and are left out)."""
    return F.xxhash64(*[F.col(f.name) for f in df.schema if not isinstance(f.dataType, MapType)])


def with_stable_id(df: DataFrame, name: str) -> DataFrame:
    """An id per row that a repeated task gives again.

    Row ids follow the order of rows in their partition, and after a shuffle that
    order may differ in a second attempt. Sorting by content fixes it.
    """
    return df.sortWithinPartitions(row_hash(df)).withColumn(name, F.monotonically_increasing_id())


def _struct(cols: Mapping[str, Column]) -> Column:
    return F.struct(*[c.alias(name) for name, c in cols.items()])


def ordered_columns(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    lag: Mapping[str, Column] | None = None,
    lead: Mapping[str, Column] | None = None,
    running: Mapping[str, Column] | None = None,
    split: bool | None = None,
    limit: int = GROUP_LIMIT,
    slices: int | None = None,
) -> DataFrame:
    """Add previous / next values and inclusive running sums per group.

    ``order`` (ascending) should be unique within a group; otherwise equal rows
    are numbered in an arbitrary but fixed order. ``split`` forces the choice
    of strategy; by default group sizes decide.
    """
    lag, lead, running = dict(lag or {}), dict(lead or {}), dict(running or {})
    if split is None:
        split = not keys or has_large_group(df, keys, limit)
    if not split:
        window = Window.partitionBy(*keys).orderBy(*order)
        upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns(
            {n: F.lag(c).over(window) for n, c in lag.items()}
            | {n: F.lead(c).over(window) for n, c in lead.items()}
            | {n: F.sum(c).over(upto) for n, c in running.items()}
        )
    return _split_columns(df, list(keys), list(order), lag, lead, running, slices, limit)


def _split_columns(df, keys, order, lag, lead, running, slices, limit):
    count = slices or max(2, -(-df.count() // limit))
    # _copy also separates rows that agree on every ordering column.
    position = [*order, "_copy"]
    sliced = materialize(
        with_stable_id(df, "_copy")
        .repartitionByRange(count, *keys, *position)
        .withColumn("_slice", F.spark_partition_id()),
        "slices",
    )

    window = Window.partitionBy("_slice", *keys).orderBy(*position)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = sliced.withColumns(
        {n: F.lag(c).over(window) for n, c in lag.items()}
        | {n: F.lead(c).over(window) for n, c in lead.items()}
        | {n: F.sum(c).over(upto) for n, c in running.items()}
        | {
            "_first": F.row_number().over(window) == 1,
            "_last": F.lead(F.lit(True)).over(window).isNull(),
        }
    )

    # One row per (slice, group) with what the neighbouring slices need to know.
    at = F.struct(*position)
    wanted = [F.count(F.lit(1)).alias("_rows")]
    if lag:
        wanted.append(F.max_by(_struct(lag), at).alias("_tail"))
    if lead:
        wanted.append(F.min_by(_struct(lead), at).alias("_head"))
    wanted += [F.sum(c).alias(f"_sum_{n}") for n, c in running.items()]
    edges = sliced.groupBy(*keys, "_slice").agg(*wanted)
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    across = group.orderBy("_slice")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = {"_parts": F.count(F.lit(1)).over(group)}
    if lag:
        carried["_prev"] = F.lag("_tail").over(across)
    if lead:
        carried["_next"] = F.lead("_head").over(across)
    carried |= {f"_base_{n}": F.sum(f"_sum_{n}").over(before) for n in running}
    # Slices are contiguous ranges, so at most 2 x slices rows pass this filter:
    # that is the proven bound which allows the broadcast.
    edges = (
        edges.withColumns(carried)
        .filter("_parts > 1")
        .select(
            *[F.col(k).alias(f"_key_{k}") for k in keys],
            F.col("_slice").alias("_edge_slice"),
            *[c for c in carried if c != "_parts"],
        )
    )
    match = F.col("_slice") == F.col("_edge_slice")
    for k in keys:
        match &= F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    joined = local.join(F.broadcast(edges), match, "left")

    patched = {n: F.when(F.col("_first"), F.col(f"_prev.{n}")).otherwise(F.col(n)) for n in lag}
    patched |= {n: F.when(F.col("_last"), F.col(f"_next.{n}")).otherwise(F.col(n)) for n in lead}
    # A running sum stays NULL until the first non-NULL value of the group.
    patched |= {
        n: F.when(F.col(f"_base_{n}").isNull(), F.col(n)).otherwise(
            F.col(f"_base_{n}") + F.coalesce(F.col(n), F.lit(0))
        )
        for n in running
    }
    return joined.withColumns(patched).select(*df.columns, *lag, *lead, *running)
