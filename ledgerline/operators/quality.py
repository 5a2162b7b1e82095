"""Expectations, quarantine, key checks and deliberate faults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.hashing import hash_unit
from ledgerline.operators.joins import spread_join

WARN, DROP, FAIL = "warn", "drop", "fail"


def expectation_metrics(df: DataFrame, dataset: str, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule: how many rows passed and failed. NULL counts as failed."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(rule).alias(f"p{i}") for i, rule in enumerate(rules.values())]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(dataset).alias("dataset"),
                F.lit(name).alias("rule"),
                F.col(f"p{i}").alias("passed"),
                (F.col("n") - F.col(f"p{i}")).alias("failed"),
            )
            for i, name in enumerate(rules)
        ]
    )
    return counts.select(F.inline(rows))


def expect(df: DataFrame, rules: Mapping[str, Column], action: str = WARN) -> DataFrame:
    """Apply expectations: keep all rows, drop the failing ones, or stop the job on one."""
    if action == WARN:
        return df
    passes = F.lit(True)
    for rule in rules.values():
        passes = passes & F.coalesce(rule, F.lit(False))
    if action == DROP:
        return df.filter(passes)
    if action == FAIL:
        message = F.lit(f"expectation failed: {', '.join(rules)}")
        return df.filter(F.when(passes, True).otherwise(F.raise_error(message).cast("boolean")))
    raise ValueError(f"unknown action {action!r}")


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return key_counts(df, keys).filter(F.col("count") >= 2)


def quarantine(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once, with the number of occurrences.

    The counts are joined back, not a window: rows of a frequent key must not
    meet in one task.
    """
    return spread_join(df, duplicate_keys(df, keys), keys).select(*df.columns, "count")


def check_primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, rows with a NULL in the key, whether the key holds."""
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    totals = key_counts(df, keys).agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(has_null, F.col("count"))), F.lit(0)).alias("null_key_rows"),
    )
    holds = (F.col("total_rows") == F.col("distinct_keys")) & (F.col("null_key_rows") == 0)
    return totals.withColumn("unique_key", holds)


def check_foreign_key(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """One row: rows without partner, distinct missing keys, rows with NULL key.

    Fact keys are counted first, so the join sees each key once.
    """
    used = fact.groupBy(F.col(fact_key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(F.col(dim_key).alias("k")).distinct().withColumn("known", F.lit(True))
    found = used.join(known, "k", "left")
    orphan = F.col("known").isNull() & F.col("k").isNotNull()
    return found.agg(
        F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("orphan_rows"),
        F.count_if(orphan).alias("missing_keys"),
        F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("null_rows"),
    )


def inject_faults(df: DataFrame, key: Column, rules: Sequence[tuple[str, float, Column]]) -> DataFrame:
    """Replace column values at given rates. A rule is (column, rate, faulty value).

    Rules apply in order, and a later rule sees the values left by an earlier
    one. Whether a row is hit depends only on its key and the column name.
    """
    for column, rate, fault in rules:
        df = df.withColumn(
            column, F.when(hash_unit(key, f"fault:{column}") < rate, fault).otherwise(F.col(column))
        )
    return df


def ticket_fault_rules(*, opened: str, due: str, channel: str, level: str, protocol: str, future: Column):
    """The five ticket faults with their rates (fixed values)."""
    return [
        (opened, 0.05, F.date_add(future, 30).cast("timestamp_ntz")),
        (due, 0.05, F.date_sub(F.col(opened), 1).cast("timestamp_ntz")),
        (channel, 0.1, F.lit("BAD")),
        (level, 0.05, F.lit("BAD")),
        (protocol, 0.05, F.lit(None)),
    ]
