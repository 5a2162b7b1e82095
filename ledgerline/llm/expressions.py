"""Column expressions that run in the JVM: bound values, running states over arrays, places of matches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` or a function inside it refers to it."""
    return F.element_at(F.transform(F.array(value), lambda bound: use(bound)), 1)


def scan(
    items: Column, zero: Column, step: Callable[[Column, Column], Column], state_type: str, out_type: str
) -> Column:
    """An output for each item, in order, from a running state.

    ``step(state, item)`` gives a struct of ``state``, the next state, and ``out``, the output of this item. An array grows
    by being copied, so the items are taken in blocks of the square root of their number: n items cost n to the power
    of 1.5, not its square.
    """
    done = f"struct<state:{state_type},out:array<{out_type}>>"
    all_done = f"struct<state:{state_type},out:array<array<{out_type}>>>"

    def one_block(state: Column, block: Column) -> Column:
        begin = F.struct(state.alias("state"), F.array().alias("out")).cast(done)

        def add(so_far: Column, item: Column) -> Column:
            return let(
                step(so_far["state"], item),
                lambda s: F.struct(s["state"].alias("state"), F.concat(so_far["out"], F.array(s["out"])).alias("out")).cast(done),
            )

        return F.aggregate(block, begin, add)

    def add_block(so_far: Column, block: Column) -> Column:
        return let(
            one_block(so_far["state"], block),
            lambda b: F.struct(b["state"].alias("state"), F.concat(so_far["out"], F.array(b["out"])).alias("out")).cast(all_done),
        )

    def blocks(all_items: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(all_items))).cast("int")
        starts = F.sequence(F.lit(0), F.size(all_items) - 1, F.greatest(size, F.lit(1)))
        return F.when(F.size(all_items) > 0, F.transform(starts, lambda at: F.slice(all_items, at + 1, size))).otherwise(
            F.array(all_items)
        )

    begin = F.struct(zero.alias("state"), F.array().alias("out")).cast(all_done)
    return let(items, lambda xs: F.flatten(F.aggregate(blocks(xs), begin, add_block)["out"]))


def places(text: Column, pattern: Column, length: Callable[[Column], Column] = F.length) -> Column:
    """Start and stop of all matches, leftmost and without overlap, as an array of structs.

    A match starts after the gaps and matches before it; ``length`` measures both (code points unless stated).
    """

    def walk(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        steps = F.zip_with(gaps, found, lambda g, m: F.struct(length(g).alias("gap"), length(m).alias("size")))

        def step(at: Column, item: Column) -> Column:
            start, stop = at + item["gap"], at + item["gap"] + item["size"]
            return F.struct(stop.alias("state"), F.struct(start.alias("start"), stop.alias("stop")).alias("out"))

        none = F.array().cast("array<struct<start:int,stop:int>>")
        return F.when(F.size(found) > 0, scan(steps, F.lit(0), step, "int", "struct<start:int,stop:int>")).otherwise(none)

    return let(F.regexp_extract_all(text, pattern, F.lit(0)), walk)
