"""Exact k nearest points in the plane, by descending through nested grid cells.

Points are counted in square cells that are split again and again until a cell
is small. Every query walks down this pyramid and keeps only the cells that can
still hold one of its k nearest points: if some cells together hold k points no
further away than u, all cells that start beyond u are dropped. Dense places are
thus split, not compared pairwise, and sparse places cost few cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ledgerline.operators.joins import BROADCAST_BYTES, spread_join
from ledgerline.workspace import materialize

#: Halvings of the first level, and of each further step: a cell has up to 4**STEP children.
FIRST = 3
STEP = 2
DEEPEST = 23
#: Rows of pairs of query and cell that one task sorts; partitions by bytes would not see how much they unfold.
TASK_ROWS = 500_000
#: Quantiles per axis. Coordinates run evenly between neighbouring quantiles, so cells are small where points are dense,
#: and a far outlier takes one of many strips instead of stretching the grid for all.
STRIPS = 1024


def _cell(level: int, depth: int = DEEPEST) -> Column:
    """Number of the cell at ``level``, from the finest cell coordinates."""
    shift = depth - level
    return F.shiftleft(F.shiftright("_ix", shift), level) + F.shiftright("_iy", shift)


def _gap(value: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """Smallest and largest distance from a value to an interval, on one axis."""
    near = F.greatest(low - value, value - high, F.lit(0.0))
    far = F.greatest(F.abs(low - value), F.abs(high - value))
    return near, far


def _pyramid_level(places: DataFrame, level: int) -> DataFrame:
    """Cells of one level: parent cell, number of points, bounding box of the points."""
    return places.groupBy(
        _cell(max(level - STEP, 0)).alias("_parent"), _cell(level).alias("_cell")
    ).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_x").alias("_x0"),
        F.max("_x").alias("_x1"),
        F.min("_y").alias("_y0"),
        F.max("_y").alias("_y1"),
    )


def _dealt(queries: DataFrame, rows: int) -> DataFrame:
    """Rows by query, in so many partitions that ``rows`` pairs of them with cells are a bounded number in each."""
    return queries.repartition(max(1, -(-rows // TASK_ROWS)), "_q")


def _keep_useful(frontier: DataFrame, k: int) -> DataFrame:
    """Drop the cells that start further away than k points are known to be."""
    nx, fx = _gap(F.col("_qx"), F.col("_x0"), F.col("_x1"))
    ny, fy = _gap(F.col("_qy"), F.col("_y0"), F.col("_y1"))
    measured = frontier.withColumns({"_near": nx * nx + ny * ny, "_far": fx * fx + fy * fy})
    # The bound of the level above already excludes most children, before any sorting.
    measured = measured.filter(F.col("_bound").isNull() | (F.col("_near") <= F.col("_bound")))
    per_query = Window.partitionBy("_q")
    upto = per_query.orderBy("_far", "_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = measured.withColumn("_seen", F.sum("_n").over(upto))
    bound = F.min(F.when(F.col("_seen") >= k, F.col("_far"))).over(per_query)
    return (
        reached.withColumn("_bound", F.least("_bound", bound))
        .filter(F.col("_bound").isNull() | (F.col("_near") <= F.col("_bound")))
        .select("_q", "_qx", "_qy", "_bound", F.col("_cell").alias("_parent"))
    )


#: Edges that one coarse step passes over.
_COARSE = 32


def _descend(frontier: DataFrame, below: DataFrame, rows: int, expected: int) -> DataFrame:
    """Attach what lies below a cell. All columns are numbers, so the counted rows
    bound the size: broadcast a small table, else join with salted large cells."""
    if rows * 8 * (len(below.columns) + 2) <= BROADCAST_BYTES:
        return frontier.join(F.broadcast(below), "_parent")
    return _dealt(spread_join(materialize(frontier, "frontier"), below, ["_parent"]), expected)


def knn_join(
    queries: DataFrame,
    points: DataFrame,
    k: int,
    *,
    query_id: str,
    point_id: str,
    x: str = "lat",
    y: str = "lon",
    leaf_points: int = 32,
) -> DataFrame:
    """For every query its k nearest points by squared distance; ties go to the smaller id.

    Returns ``query_id``, ``point_id``, ``distance`` (squared) and ``rank``.
    """
    located = points.select(
        F.col(point_id).alias("_p"), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")
    ).filter("_x is not null and _y is not null")
    # Of points at one place no query needs more than k.
    same_place = Window.partitionBy("_x", "_y").orderBy("_p")
    located = located.withColumn("_rn", F.row_number().over(same_place)).filter(F.col("_rn") <= k).drop("_rn")
    x0, x1, y0, y1 = located.agg(F.min("_x"), F.max("_x"), F.min("_y"), F.max("_y")).first()
    schema = f"{query_id} {queries.schema[query_id].dataType.simpleString()}, " \
        f"{point_id} {points.schema[point_id].dataType.simpleString()}, distance double, rank int"
    if x0 is None:
        return queries.sparkSession.createDataFrame([], schema)
    finest = 2**DEEPEST
    steps = [k / STRIPS for k in range(1, STRIPS)]
    at = located.agg(F.percentile_approx("_x", steps, 20 * STRIPS), F.percentile_approx("_y", steps, 20 * STRIPS)).first()
    edges = {"_x": sorted({x0, *at[0], x1}), "_y": sorted({y0, *at[1], y1})}

    def coordinate(value: str) -> Column:
        known = F.lit(edges[value])
        strips = len(edges[value]) - 1
        if not strips:
            return F.lit(0).cast("bigint")
        # In two steps, so that a value meets some 64 edges instead of all.
        block = F.size(F.filter(F.lit(edges[value][::_COARSE]), lambda e: e <= F.col(value)))
        own = F.slice(known, (block - 1) * _COARSE + 1, F.lit(_COARSE))
        strip = F.least((block - 1) * _COARSE + F.size(F.filter(own, lambda e: e <= F.col(value))), F.lit(strips))
        low, high = F.element_at(known, strip), F.element_at(known, strip + 1)
        part = (strip - 1 + (F.col(value) - low) / (high - low)) / strips
        return F.greatest(F.lit(0), F.least(F.floor(part * finest), F.lit(finest - 1))).cast("bigint")

    places = materialize(located.withColumns({"_ix": coordinate("_x"), "_iy": coordinate("_y")}), "places")

    asked = queries.select(
        F.col(query_id).alias("_q"), F.col(x).cast("double").alias("_qx"), F.col(y).cast("double").alias("_qy")
    ).filter("_qx is not null and _qy is not null")
    # The first level has at most 4**FIRST cells: every query carries them as one array.
    cells = _pyramid_level(places, FIRST).drop("_parent")
    first = cells.agg(F.collect_list(F.struct(*cells.columns)).alias("_cells"))
    # Dealt while a query is one narrow row; all levels below keep to these partitions.
    expected = asked.count() * 4**FIRST
    asked = _dealt(asked, expected).withColumns({"_bound": F.lit(None).cast("double"), "_cells": first.scalar()})
    frontier = _keep_useful(asked.select("*", F.inline("_cells")), k)
    level, largest = FIRST, cells.agg(F.max("_n")).first()[0]
    while largest > leaf_points and level < DEEPEST:
        level += STEP
        cells = _pyramid_level(places, level)
        rows, largest = cells.agg(F.count(F.lit(1)), F.max("_n")).first()
        frontier = _keep_useful(_descend(frontier, cells, rows, expected), k)

    leaves = places.select(_cell(level).alias("_parent"), "_p", "_x", "_y")
    pairs = _descend(frontier, leaves, places.count(), expected)
    dx, dy = F.col("_x") - F.col("_qx"), F.col("_y") - F.col("_qy")
    nearest = Window.partitionBy("_q").orderBy("distance", "_p")
    return (
        pairs.withColumn("distance", dx * dx + dy * dy)
        .filter(F.col("_bound").isNull() | (F.col("distance") <= F.col("_bound")))
        .withColumn("rank", F.row_number().over(nearest))
        .filter(F.col("rank") <= k)
        .select(F.col("_q").alias(query_id), F.col("_p").alias(point_id), "distance", "rank")
    )
