"""Dimensions, facts and the joins between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerline.operators.changes import END, START, current, surrogate_key
from ledgerline.operators.joins import lookup_join

INVOICE_FACT = (
    "SK_DIM_DATE", "SK_DIM_CUSTOMER", "SK_DIM_PRODUCT",
    "DT_VNCMT", "DT_PGTO", "VL_FTRA", "VL_RCRG", "GOLD_TS",
)
SUBSCRIPTION_FACT = (
    "SK_DIM_DATE", "SK_DIM_CUSTOMER", "SK_DIM_PRODUCT",
    "ID_ESTD_LNHA", "FL_DEBT_AUTM", "FL_CNTA_ONLN", "FL_PLNO_TTLR", "GOLD_TS",
)


def dimension(versions: DataFrame, business_key: list[str], key_name: str) -> DataFrame:
    """Add a surrogate key that stays the same when the table is rebuilt."""
    return surrogate_key(versions, [*business_key, START], key_name)


def open_versions(rows: DataFrame) -> DataFrame:
    """Give rows without history the two validity columns, valid since ever."""
    return rows.withColumns({START: F.lit("1900-01-01").cast("timestamp"), END: F.lit(None).cast("timestamp")})


def invoice_fact(invoices: DataFrame, dates: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Invoices (batch or stream) with the keys of date, customer and product.

    Only current customer and product versions match. Products are found by
    plan and type text.
    """
    joined = lookup_join(
        invoices.withColumn("DATA", F.col("dt_ciclo_rcrg")), dates.select("DATA", "SK_DIM_DATE"), ["DATA"]
    )
    joined = lookup_join(joined, current(customers).select("nu_doct", "SK_DIM_CUSTOMER"), ["nu_doct"])
    joined = lookup_join(
        joined, current(products).select("ds_plno", "ds_prdt", "SK_DIM_PRODUCT"), ["ds_plno", "ds_prdt"]
    )
    return joined.withColumn("GOLD_TS", F.current_timestamp()).select(
        *[F.col(c).alias(c) for c in INVOICE_FACT]
    )


def subscription_fact(subscriptions: DataFrame, dates: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Current subscriptions; customers match on document and phone, products on id."""
    joined = lookup_join(
        current(subscriptions).withColumn("DATA", F.col("dt_ini_plno")),
        dates.select("DATA", "SK_DIM_DATE"),
        ["DATA"],
    )
    joined = lookup_join(
        joined, current(customers).select("nu_doct", "nu_tlfn", "SK_DIM_CUSTOMER"), ["nu_doct", "nu_tlfn"]
    )
    joined = lookup_join(joined, current(products).select("id_prdt", "SK_DIM_PRODUCT"), ["id_prdt"])
    return joined.withColumn("GOLD_TS", F.current_timestamp()).select(
        *[F.col(c).alias(c) for c in SUBSCRIPTION_FACT]
    )


def join_star(fact: DataFrame, **dims: tuple[DataFrame, str]) -> DataFrame:
    """Join a fact to dimensions, each given as (frame, key column)."""
    for frame, key in dims.values():
        fact = lookup_join(fact, frame, [key])
    return fact
