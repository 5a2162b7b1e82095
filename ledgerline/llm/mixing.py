"""Mix sources to target weights: capped water-filling, then whole and fractional repetitions of documents.

Sources share a number of words by weight. A source stops at ``max_epochs`` times its own words; what it cannot take is
shared by the others by weight, until none is above its cap. A source that is to be read 1.7 times takes every document
once and, in an order given by a seeded hash, documents worth 0.7 of its words once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import store, word_count

#: Hex digits of the order hash that number the cells of a source.
CELL_DIGITS = 3
#: Cells, of about 100 bytes each, up to which their table is broadcast.
BROADCAST_CELLS = 300_000


def order_hash(seed: int, id_column: Column) -> Column:
    """The seeded order of documents: MD5 of seed and id, as text."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit("null"))).cast("binary"))


def targets(sizes: DataFrame, max_epochs: int = 3, cycle: int = 3, total: int | None = None) -> DataFrame:
    """``source``, ``source_size``, ``target`` from (source, source_size), one row for each source.

    Sources by code point, null last, weigh 1, 2, ... ``cycle``, repeating. Filling is solved at once instead of round by
    round: in ascending order of cap / weight, a source is clamped exactly if its cap is below its share of what the
    clamped ones before it leave. One row per source passes through one task, never one per document.
    """
    whole = Window.partitionBy()
    ranked = sizes.select("source", "source_size").withColumns({
        "_w": ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % cycle + 1).cast("long"),
        "_cap": F.col("source_size") * max_epochs,
        "_all": F.sum("source_size").over(whole) if total is None else F.lit(total).cast("long"),
    })
    rising = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    after = rising.rowsBetween(0, Window.unboundedFollowing)
    share = (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / F.sum("_w").over(after)
    filled = ranked.withColumns({"_share": share, "_turn": F.row_number().over(rising)}).withColumn(
        "_clamped", F.col("_cap") < F.col("_w") * F.col("_share")
    )
    level = F.min(F.when(~F.col("_clamped"), F.struct("_turn", F.col("_share").alias("s")))).over(whole)
    return filled.withColumn("_level", level["s"]).select(
        "source", "source_size",
        F.when(F.col("_clamped"), F.col("_cap").cast("double")).otherwise(F.col("_w") * F.col("_level")).alias("target"),
    )


def with_repeats(
    df: DataFrame, text: str = "text", id_column: str = "doc_id", source: str = "source", into: str = "mix",
    max_epochs: int = 3, cycle: int = 3, seed: int = 42,
) -> DataFrame:
    """Add the struct ``into``: ``size`` (words), ``source_size``, ``target``, ``repeats`` and ``taken`` (size x repeats).

    A source's taken words differ from its target by less than the one document at the cut. The cut is found from sums
    over 4,096 cells of the order hash per source; rows are only put in order inside the cell that holds it, so no source
    goes through one task whatever its size. Null texts have size 0, a null source is a source of its own (the last), null
    ids share one place in the order, repeated rows count each. An existing column of the name ``into`` is replaced. An
    empty table, or one without words, takes nothing.
    """
    rows = df.withColumns({
        "_mix_source": F.col(source).cast("string"),
        "_mix_size": word_count(F.col(text).cast("string")),
        "_mix_u": order_hash(seed, F.col(id_column)),
    }).withColumn("_mix_cell", F.substring("_mix_u", 1, CELL_DIGITS))
    cells = store(
        rows.groupBy(F.col("_mix_source").alias("_source"), F.col("_mix_cell").alias("_cell")).agg(F.sum("_mix_size").alias("_b")),
        "cells",
    )
    sizes = cells.groupBy(F.col("_source").alias("source")).agg(F.sum("_b").alias("source_size"))
    goal = targets(sizes, max_epochs, cycle).withColumns({
        "_whole": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"),
    }).withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size"))
    in_source = Window.partitionBy("_source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        cells.withColumn("_before", F.coalesce(F.sum("_b").over(in_source), F.lit(0)))
        .join(goal, F.col("_source").eqNullSafe(F.col("source")))
        .select(
            "_source", "_cell",
            F.struct("_before", "_b", "source_size", "target", "_whole", "_rest").alias("_mix_cut"),
        )
    )
    # Sources x 4,096 rows at most: broadcast while they are few, so that texts stay where they are; else a shuffle join.
    if cells.count() <= BROADCAST_CELLS:
        cut = F.broadcast(cut)
    joined = rows.join(
        cut, F.col("_mix_source").eqNullSafe(F.col("_source")) & (F.col("_mix_cell") == F.col("_cell"))
    ).drop("_source", "_cell")
    before, own, rest, whole = (F.col(f"_mix_cut.{n}") for n in ("_before", "_b", "_rest", "_whole"))
    inside = (before < rest) & (rest < before + own)
    order = Window.partitionBy("_mix_source", "_mix_cell").orderBy("_mix_u", F.col(id_column), "_mix_size")
    end = before + F.sum("_mix_size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    at_cut = joined.where(inside).withColumn("_mix_extra", end - F.col("_mix_size") / 2 <= rest)
    others = joined.where(~inside).withColumn("_mix_extra", before + own <= rest)
    repeats = whole + F.when(F.col("_mix_extra") & (whole < max_epochs), 1).otherwise(0)
    mixed = F.struct(
        F.col("_mix_size").alias("size"), F.col("_mix_cut.source_size").alias("source_size"),
        F.col("_mix_cut.target").alias("target"), repeats.alias("repeats"), (F.col("_mix_size") * repeats).alias("taken"),
    )
    columns = [F.col(c) for c in df.columns if c != into]
    return others.unionByName(at_cut).select(*columns, mixed.alias(into))
