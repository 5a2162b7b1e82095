"""Grouped views kept from a change feed: sums, counts, distinct counts, least and greatest values.

The view holds partial states of its groups. A batch of changes is reduced to one row per group it touches, and only the
buckets of these groups are read and rewritten. Rows that go are subtracted; a least or greatest value that went is
looked for again, in the source and for the groups concerned alone. Distinct counts rest on a table with the number of
rows for each group and value, of which likewise only touched buckets are read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

from ledgerline.operators import changes as ch
from ledgerline.operators.joins import lookup_join
from ledgerline.sources.tables import BucketedTable
from ledgerline.workspace import materialize

ROWS = "_rows"


@dataclass(frozen=True)
class Measures:
    """What a view shows for each group: names of new columns and the source columns that they come from."""

    sums: dict[str, str]
    least: dict[str, str]
    greatest: dict[str, str]
    distinct: dict[str, str]

    @classmethod
    def of(cls, *, sums=None, least=None, greatest=None, distinct=None) -> Measures:
        return cls(sums or {}, least or {}, greatest or {}, distinct or {})


class IncrementalView:
    """A view of ``groups`` and ``measures`` under ``root``. NULL group values are groups like any other.

    ``rows`` counts the rows of a group; a group without rows is gone. Sums skip NULLs and are NULL without other values;
    give sums decimal or integer columns, as floating-point sums depend on the order of changes. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, groups: Sequence[str], measures: Measures, buckets: int = 64):
        self.spark, self.groups, self.measures = spark, list(groups), measures
        self.state = BucketedTable(spark, f"{root.rstrip('/')}/state", groups, buckets)
        self.values = {
            name: BucketedTable(spark, f"{root.rstrip('/')}/values-{name}", [*groups, "_value"], buckets) for name in measures.distinct
        }

    # ---------------------------------------------------------------- reading

    def read(self) -> DataFrame | None:
        """The groups with their measures; None before the first batch."""
        rows = self.state.read()
        if rows is None:
            return None
        m = self.measures
        shown = [F.when(F.col(f"_n_{name}") > 0, F.col(name)).alias(name) for name in m.sums]
        return rows.select(*self.groups, F.col(ROWS).alias("rows"), *shown, *m.least, *m.greatest, *m.distinct)

    # ---------------------------------------------------------------- writing

    def apply(self, images: DataFrame, token: str, source: Callable[[DataFrame], DataFrame]) -> None:
        """Take the images of a feed (``_change_type``), once per token.

        ``source(groups)`` gives the present rows of the view's source for a frame of groups; it is called only where a
        least or greatest value has gone.
        """
        if self.state.has(token):
            return
        sign = F.when(F.col(ch.OP).isin("insert", "update_postimage"), 1).otherwise(-1)
        marked = materialize(images.withColumn("_sign", sign), "view-images")
        delta = materialize(self._delta(marked), "view-delta")
        buckets = self.state.touched(delta)
        if not buckets:
            return
        for name, column in self.measures.distinct.items():
            delta = self._with_distinct(marked, delta, name, column, token)
        before = self.state.read(buckets)
        merged = materialize(self._merged(before, delta), "view-merged")
        self.state.replace(self._searched(merged, source), token, buckets)

    def _delta(self, marked: DataFrame) -> DataFrame:
        """One row per touched group, combined before the shuffle."""
        m, sign = self.measures, F.col("_sign")
        parts = [F.sum(sign).cast("bigint").alias(ROWS)]
        for name, column in m.sums.items():
            parts += [
                F.coalesce(F.sum(F.col(column) * sign), F.lit(0)).alias(name),
                F.sum(F.when(F.col(column).isNotNull(), sign).otherwise(0)).cast("bigint").alias(f"_n_{name}"),
            ]
        for chosen, best in ((m.least, F.min), (m.greatest, F.max)):
            for name, column in chosen.items():
                parts += [
                    best(F.when(sign > 0, F.col(column))).alias(name),
                    best(F.when(sign < 0, F.col(column))).alias(f"_gone_{name}"),
                ]
        rows = marked.groupBy(*self.groups).agg(*parts)
        # Sums keep one type however many batches are added.
        wide = {f.name: f"decimal(38,{f.dataType.scale})" for f in rows.schema if isinstance(f.dataType, DecimalType) and f.name in m.sums}
        return rows.withColumns({name: F.col(name).cast(kind) for name, kind in wide.items()})

    def _with_distinct(self, marked: DataFrame, delta: DataFrame, name: str, column: str, token: str) -> DataFrame:
        """Add the change of a distinct count: values that came less values that went."""
        keys, table = [*self.groups, "_value"], self.values[name]
        counted = marked.where(F.col(column).isNotNull()).withColumn("_value", F.col(column)).groupBy(*keys).agg(
            F.sum("_sign").cast("bigint").alias("_n"))
        counted = materialize(counted, "view-values")
        buckets = table.touched(counted)
        done = table.has(token)  # of a batch that died between the two tables: the stored counts include it already
        before = table.read(buckets) if buckets else None
        news = counted if done else counted.where("_n <> 0")
        old = before if before is not None else counted.limit(0)
        both = _full(news.withColumnRenamed("_n", "_d"), old, keys)
        had = F.coalesce("_n", F.lit(0)) - (F.coalesce("_d", F.lit(0)) if done else F.lit(0))
        has = had + F.coalesce("_d", F.lit(0))
        after = materialize(both.select(*keys, had.alias("_had"), has.alias("_n"), F.col("_d").isNotNull().alias("_new")), "view-counts")
        turned = after.where("_new").groupBy(*self.groups).agg(
            F.sum((F.col("_n") > 0).cast("bigint") - (F.col("_had") > 0).cast("bigint")).alias(name))
        if buckets and not done:
            table.replace(after.where("_n > 0").select(*keys, "_n"), token, buckets)
        return materialize(_full(delta, turned, self.groups).withColumn(name, F.coalesce(name, F.lit(0))), "view-delta")

    def _merged(self, before: DataFrame | None, delta: DataFrame) -> DataFrame:
        """Old states and changes added; ``_again`` marks groups whose least or greatest value may have gone."""
        m = self.measures
        added = [ROWS, *m.sums, *[f"_n_{n}" for n in m.sums], *m.distinct]
        bests = [*[(n, F.least) for n in m.least], *[(n, F.greatest) for n in m.greatest]]
        new = delta.select(*self.groups, F.struct(*[c for c in delta.columns if c not in self.groups]).alias("_d"))
        if before is None:
            kept = [*added, *[n for n, _ in bests]]
            old = new.select(*self.groups, F.struct(*[F.col(f"_d.{c}") for c in kept]).alias("_o")).limit(0)
        else:
            old = before.drop("bucket").select(*self.groups, F.struct(*[c for c in before.columns if c not in (*self.groups, "bucket")]).alias("_o"))
        both = _full(new, old, self.groups)
        zero = F.lit(0)
        columns = [
            (F.coalesce(F.col(f"_o.{c}"), zero) + F.coalesce(F.col(f"_d.{c}"), zero)).cast(delta.schema[c].dataType).alias(c) for c in added
        ]
        again = F.lit(False)
        for name, better in bests:
            was, came, gone = F.col(f"_o.{name}"), F.col(f"_d.{name}"), F.col(f"_d._gone_{name}")
            columns.append(better(was, came).alias(name))
            # The value that went is as good as the one known; what came in its place may be worse than another row.
            again = again | F.coalesce((gone == better(was, came)) | (better(gone, was) != was), F.lit(False))
        return both.select(*self.groups, *columns, again.alias("_again")).where(F.col(ROWS) > 0)

    def _searched(self, merged: DataFrame, source: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The states with least and greatest values found anew where they may have gone."""
        m, fine = self.measures, merged.where(~F.col("_again")).drop("_again")
        open_ = merged.where("_again")
        if not (m.least or m.greatest) or open_.isEmpty():
            return merged.drop("_again")
        rows = source(open_.select(*self.groups))
        found = rows.groupBy(*self.groups).agg(
            *[F.min(c).alias(n) for n, c in m.least.items()], *[F.max(c).alias(n) for n, c in m.greatest.items()])
        names = [*m.least, *m.greatest]
        again = _full(open_.drop("_again", *names).withColumn("_open", F.lit(True)), found, self.groups).where("_open").drop("_open")
        return fine.unionByName(again.select(*fine.columns))


def rows_of_groups(source: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a source whose groups are wanted; NULLs are groups too. Few groups are broadcast, so that no row moves."""
    marked = [F.struct(F.col(k).isNull(), F.coalesce(F.col(k).cast("string"), F.lit(""))).alias(f"_k{n}") for n, k in enumerate(keys)]
    names = [f"_k{n}" for n in range(len(keys))]
    return lookup_join(source.select("*", *marked), groups.select(*marked).distinct(), names).drop(*names)


def _full(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on keys of which NULLs are equal; both sides have each key once."""
    a = left.select(F.struct(*keys).alias("_key"), *[c for c in left.columns if c not in keys])
    b = right.select(F.struct(*keys).alias("_key"), *[c for c in right.columns if c not in (*keys, "bucket")])
    # A struct is never NULL itself, so its NULL fields compare as equal.
    return a.join(b, "_key", "full_outer").select("_key.*", *[c for c in a.columns + b.columns if c != "_key"])
