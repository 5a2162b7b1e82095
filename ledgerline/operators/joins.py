"""Joins whose strategy depends on measured sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType

from ledgerline.operators.ordered import GROUP_LIMIT, sized_groups, with_stable_id
from ledgerline.workspace import materialize

#: Bytes up to which a lookup side may be copied to every executor.
BROADCAST_BYTES = 128 * 2**20
#: Large keys that are collected and broadcast; more are stored and joined.
HOT_KEYS = 10_000
#: Left rows, and bytes of a stored right side by ``known_bytes``, that one task of a shuffle join is given to sort.
JOIN_ROWS, JOIN_BYTES = 1_000_000, 2**31
#: What rows may take in memory, against their size in a compressed columnar file: texts from a dictionary take much more.
_UNPACKED = 64
#: An estimate of as many bytes says that the optimizer knows no size.
_NO_SIZE = 2**50
_FIXED_WIDTH = (NumericType, BooleanType, DateType, TimestampNTZType, TimestampType)
#: Plan nodes behind which the optimizer's size estimate may be too small.
_GROWING = ("Generate", "MapIn", "FlatMap", "Expand", "Join", "Union", "Scalar", "Window")


def known_bytes(df: DataFrame) -> int | None:
    """An upper estimate of the size without running anything: for scans, filters, projections and groupings of stored data."""
    plan = df._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    if any(node in text for node in _GROWING):
        return None
    size = int(str(plan.stats().sizeInBytes()))
    return size * _UNPACKED if size < _NO_SIZE else None


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` may be broadcast: by the optimizer's size where that is an upper bound, else measured, by all tasks."""
    known = known_bytes(df)
    if known is not None and known <= max_bytes:
        return True
    width = F.lit(16)
    for field in df.schema:
        if isinstance(field.dataType, _FIXED_WIDTH):
            width = width + 8
        else:
            width = width + 8 + F.coalesce(F.octet_length(F.col(f"`{field.name}`").cast("string")), F.lit(0))
    return (df.agg(F.sum(width.cast("bigint"))).first()[0] or 0) <= max_bytes


def _join_tasks(rows: int, right: DataFrame) -> int | None:
    """How many tasks a shuffle join of about so many left rows needs; None where the session has as many."""
    needed = -(-rows // JOIN_ROWS) + (known_bytes(right) or 0) // JOIN_BYTES
    return needed if needed > int(right.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    limit: int = GROUP_LIMIT,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Equi-join in which the large keys of the left side are salted.

    A key with n > ``limit`` left rows is dealt to 2 n / limit salts by the number of the row, so equal rows spread too;
    the matching right rows are repeated once per salt. Rows with a NULL key match nothing and are dealt out likewise.
    All other keys keep salt 0, so the join stays one plain shuffle join for them. ``sized_by`` is a cheaper frame with
    the same keys in about the same numbers, where ``left`` is itself the result of much work. Where the rows are too many
    for the shuffle partitions of the session, there are more of them, so what a task sorts does not grow with the data.
    """
    if how not in ("inner", "left"):
        raise ValueError("spread_join supports inner and left joins")
    on = list(on)
    sizes = sized_groups(left if sized_by is None else sized_by, on, limit)
    found = sizes.head(HOT_KEYS + 2)
    if len(found) > HOT_KEYS + 1:  # about (rows / limit) keys: more than the driver should hold
        sizes = materialize(sizes, "hot-keys")
        rows = sizes.agg(F.sum("_rows")).first()[0]
    else:
        rows = sum(r["_rows"] for r in found)
    tasks = _join_tasks(rows, right)

    def dealt(side: DataFrame, keys: Sequence[str]) -> DataFrame:
        return side.repartition(tasks, *keys) if tasks else side

    few = [r for r in found if r["_key"] is not None]
    if not few:
        return dealt(left, on).join(dealt(right, on), on, how)
    if len(few) <= HOT_KEYS:
        hot = F.broadcast(left.sparkSession.createDataFrame(few, sizes.schema))
    else:
        hot = sizes.filter(F.col("_key").isNotNull())
    hot = hot.select("_key.*", F.col("_rows").alias("_n"))
    hot = hot.select(*[F.col(c).alias(f"_hot_{c}") for c in on], F.ceil(F.col("_n") * 2 / limit).cast("int").alias("_salts"))

    def marked(side: DataFrame) -> DataFrame:
        match = F.lit(True)
        for c in on:
            match &= F.col(c).eqNullSafe(F.col(f"_hot_{c}"))
        return side.join(hot, match, "left").drop(*[f"_hot_{c}" for c in on])

    salted_left = marked(with_stable_id(left, "_row")).withColumn(
        "_salt", F.when(F.col("_salts") > 1, F.pmod(F.xxhash64("_row"), F.col("_salts")).cast("int")).otherwise(0)
    )
    salts = F.when(F.col("_salts") > 1, F.sequence(F.lit(0), F.col("_salts") - 1)).otherwise(F.array(F.lit(0)))
    usable = F.lit(True)
    for c in on:
        usable &= F.col(c).isNotNull()
    salted_right = marked(right.filter(usable)).withColumn("_salt", F.explode(salts))
    salted = [*on, "_salt"]
    left, right = dealt(salted_left.drop("_salts", "_row"), salted), dealt(salted_right.drop("_salts"), salted)
    return left.join(right, salted, how).drop("_salt")


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    max_bytes: int = BROADCAST_BYTES,
    limit: int = GROUP_LIMIT,
    small: bool | None = None,
) -> DataFrame:
    """Join a big frame to a lookup table.

    The lookup is broadcast when its size in bytes allows it; beyond that the join is a shuffle join with salted large
    keys. A stream is planned anew for every micro-batch, so there Spark's own estimate decides each time.
    ``small`` passes on an earlier measurement of the same lookup.
    """
    if fact.isStreaming:
        return fact.join(dim, list(on), how)
    if fits_broadcast(dim, max_bytes) if small is None else small:
        return fact.join(F.broadcast(dim), list(on), how)
    return spread_join(fact, dim, on, how, limit=limit)
