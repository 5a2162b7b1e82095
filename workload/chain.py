"""The way from changed source tables to a report: dimensions with history, facts from streams, revenue on top."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions.labels import client_category
from ledgerline.operators import changes as ch
from ledgerline.plans import star
from ledgerline.streaming import ingest
from ledgerline.workspace import new_dir
from workload import stage
from workload.registry import query
from workload.stage import CATEGORY_SQL, INVOICES_SQL

_CODE = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'P' WHEN 'BUILDING' THEN 'S' WHEN 'FURNITURE' THEN 'G'
           WHEN 'HOUSEHOLD' THEN 'PL' WHEN 'MACHINERY' THEN 'V' END"""


@query("dim_customer_from_feed", f"""
    WITH c AS (SELECT c_custkey, c_name, {_CODE} AS code FROM customer),
    v AS (SELECT *, c_custkey % 10 <> 0 AS was, c_custkey % 7 = 0 AND code <> 'P' AS changed FROM c)
    SELECT c_custkey, 'P' AS client, 1900 AS start_year, 1950 AS end_year FROM v WHERE was AND changed
    UNION ALL SELECT c_custkey, code, CASE WHEN was AND NOT changed THEN 1900 ELSE 1950 END, NULL FROM v
""")
def dim_customer_from_feed(spark, sf):
    """All versions of the customers, from the change feed between two states."""
    return stage.dim_customer(spark, sf).select(
        F.col("nu_doct").cast("long").alias("c_custkey"), F.col("CLIENT").alias("client"),
        F.year(ch.START).alias("start_year"), F.year(ch.END).alias("end_year"),
    )


@query("dim_product_from_snapshots", """
    WITH p AS (SELECT DISTINCT p_type, p_brand FROM part)
    SELECT p_type, p_brand, CASE WHEN p_brand LIKE '%1' THEN 1950 ELSE 1900 END AS start_year,
           CAST(NULL AS INTEGER) AS end_year, true AS key_kept FROM p
    UNION ALL SELECT 'withdrawn', 'withdrawn', 1900, 1950, true
""")
def dim_product_from_snapshots(spark, sf):
    """All versions of the products, from two snapshots; the key is the one of the snapshot that opened the version."""
    return stage.dim_product(spark, sf).select(
        F.col("ds_prdt").alias("p_type"), F.col("ds_plno").alias("p_brand"),
        F.year(ch.START).alias("start_year"), F.year(ch.END).alias("end_year"),
        (F.col("SK_DIM_PRODUCT") == F.xxhash64("ds_prdt", "ds_plno", ch.START)).alias("key_kept"),
    )


@query("star_chain", f"""
    SELECT {CATEGORY_SQL} AS categoria_cliente, year(dt_ciclo_rcrg) AS ano, count(*) AS invoices,
           CAST(sum(vl_ftra) AS DOUBLE) AS revenue
    FROM ({INVOICES_SQL}) JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2
""")
def star_chain(spark, sf):
    """Feed and snapshots give the dimensions, their current rows the fact, written by a stream; a report reads it."""
    invoices = stage.invoices(spark, sf)
    landing, home = stage.land(invoices, spark, "chain-invoices"), new_dir(spark, "star-chain")
    dates, customers, products = stage.dim_date(spark, sf), stage.dim_customer(spark, sf), stage.dim_product(spark, sf)
    fact = star.invoice_fact(ingest.file_stream(spark, landing, invoices.schema), dates, customers, products)
    ingest.run_stream(fact, f"{home}/fact", f"{home}/checkpoint")
    named = star.join_star(
        spark.read.parquet(f"{home}/fact"),
        dates=(dates.select("SK_DIM_DATE", F.year("DATA").alias("ano")), "SK_DIM_DATE"),
        customers=(customers.select(
            "SK_DIM_CUSTOMER", client_category(F.col("CLIENT")).alias("categoria_cliente")), "SK_DIM_CUSTOMER"),
    )
    return named.groupBy("categoria_cliente", "ano").agg(
        F.count(F.lit(1)).alias("invoices"), F.sum("VL_FTRA").cast("double").alias("revenue")
    )
