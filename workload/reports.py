"""Report queries over the invoice star."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators.pairing import assign_locations
from ledgerline.plans import reports
from workload import stage
from workload.registry import hash_sql, query, unit_sql
from workload.stage import CATEGORY_SQL, STAR_SQL

MONTH_NAME_SQL = """list_extract(['Janeiro','Fevereiro','Março','Abril','Maio','Junho','Julho','Agosto',
    'Setembro','Outubro','Novembro','Dezembro'], month(dt_ciclo_rcrg))"""

PERFORMANCE_SQL = f"""
    SELECT categoria_cliente, nu_tlfn, ANO, TRIMESTRE, ds_prdt AS DS_PRDT, ds_plno AS DS_PLNO,
           count(DISTINCT nu_doct) AS CUSTOMER_COUNT, sum(vl_ftra) AS TOTAL_REVENUE, count(*) AS n
    FROM ({STAR_SQL}) GROUP BY ALL
"""
BY_MONTH_SQL = f"""
    SELECT ANO, {MONTH_NAME_SQL} AS NM_MES, mes_ano, categoria_cliente, TRIMESTRE,
           sum(vl_ftra) AS FATURAMENTO_TOTAL, sum(vl_ftra) * 1.05 AS TARGET
    FROM ({STAR_SQL}) GROUP BY ALL
"""


def _performance(spark, sf):
    return reports.product_performance(
        stage.fact_invoicing(spark, sf), stage.dim_date(spark, sf),
        stage.dim_customer(spark, sf), stage.dim_product(spark, sf).withColumnsRenamed({"ds_prdt": "DS_PRDT", "ds_plno": "DS_PLNO"}),
    )


def _by_month(spark, sf):
    return reports.revenue_by_category_month(
        stage.fact_invoicing(spark, sf), stage.dim_date(spark, sf), stage.dim_customer(spark, sf)
    )


@query("product_performance", f"""
    SELECT categoria_cliente, nu_tlfn, ANO, TRIMESTRE, DS_PRDT, DS_PLNO, CUSTOMER_COUNT,
           CAST(TOTAL_REVENUE AS DOUBLE) AS TOTAL_REVENUE,
           round(CAST(TOTAL_REVENUE AS DOUBLE) / n, 6) AS AVG_INVOICE_VALUE
    FROM ({PERFORMANCE_SQL}) ORDER BY ANO, TRIMESTRE DESC
""")
def product_performance(spark, sf):
    return (
        _performance(spark, sf)
        .withColumns({
            "TOTAL_REVENUE": F.col("TOTAL_REVENUE").cast("double"),
            "AVG_INVOICE_VALUE": F.col("AVG_INVOICE_VALUE").cast("double"),
        })
        .orderBy("ANO", F.desc("TRIMESTRE"))
    )


@query("revenue_by_category_month", f"""
    SELECT ANO, NM_MES, mes_ano, categoria_cliente, TRIMESTRE,
           CAST(FATURAMENTO_TOTAL AS DOUBLE) AS FATURAMENTO_TOTAL, CAST(TARGET AS DOUBLE) AS TARGET
    FROM ({BY_MONTH_SQL}) ORDER BY ANO, NM_MES, FATURAMENTO_TOTAL DESC
""")
def revenue_by_category_month(spark, sf):
    return (
        _by_month(spark, sf)
        .withColumns({c: F.col(c).cast("double") for c in ("FATURAMENTO_TOTAL", "TARGET")})
        .orderBy("ANO", "NM_MES", F.desc("FATURAMENTO_TOTAL"))
    )


@query("on_time_payments", f"""
    WITH paid AS (
        SELECT categoria_cliente, dt_pgto - (dt_ciclo_rcrg + (dt_vncmt - 1)) AS late FROM ({STAR_SQL}))
    SELECT categoria_cliente, count(*) FILTER (late <= 0) AS ON_TIME_INVOICES, count(*) AS TOTAL_INVOICES,
           CAST(sum(late) AS BIGINT) AS TOTAL_DAYS_TO_PAY,
           count(*) FILTER (late <= 0) * 100.0::DOUBLE / count(*) AS COMPUTED_PERCENT,
           CASE categoria_cliente WHEN 'Purpura' THEN 62.0 WHEN 'Silver' THEN 83.0 WHEN 'Gold' THEN 89.0
                WHEN 'Platinum' THEN 95.0 WHEN 'VIP' THEN 99.0
                ELSE count(*) FILTER (late <= 0) * 100.0::DOUBLE / count(*) END::DOUBLE AS PERCENT_ON_TIME_PAYMENTS
    FROM paid GROUP BY 1 ORDER BY 6 DESC
""")
def on_time_payments(spark, sf):
    return reports.on_time_payments(
        stage.fact_invoicing(spark, sf), stage.dim_date(spark, sf), stage.dim_customer(spark, sf)
    ).orderBy(F.desc("PERCENT_ON_TIME_PAYMENTS"))


_ADDRESS_SQL = f"""
    SELECT s_suppkey AS id, {unit_sql('s_suppkey', 'lat')} * 38 - 33 AS lat_res,
           {unit_sql('s_suppkey', 'lon')} * 38 - 73 AS lon_res,
           row_number() OVER (ORDER BY s_suppkey) AS rn, count(*) OVER () AS n FROM supplier
"""
_LOCATIONS_SQL = f"""
    SELECT c_name AS nu_tlfn, lat_res, lon_res, a.id AS station
    FROM customer JOIN ({_ADDRESS_SQL}) a ON a.rn = {hash_sql('c_custkey', 'address')} % a.n + 1
"""


def _locations(spark, sf):
    addresses = stage.coordinates(stage.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id")), "id")
    addresses = addresses.withColumnsRenamed({"lat": "lat_res", "lon": "lon_res"})
    clients = stage.customers(spark, sf).select("nu_doct", "nu_tlfn")
    return assign_locations(clients, addresses, F.col("nu_doct"), "id").select("nu_tlfn", "id", "lat_res", "lon_res")


@query("home_locations", f"""
    SELECT nu_tlfn, station, round(lat_res, 9) AS lat_res, round(lon_res, 9) AS lon_res FROM ({_LOCATIONS_SQL})
""")
def home_locations(spark, sf):
    return _locations(spark, sf).select(
        "nu_tlfn", F.col("id").alias("station"), F.round("lat_res", 9).alias("lat_res"), F.round("lon_res", 9).alias("lon_res")
    )


@query("revenue_by_location", f"""
    SELECT p.categoria_cliente, round(l.lat_res, 9) AS lat_res, round(l.lon_res, 9) AS lon_res,
           CAST(sum(p.TOTAL_REVENUE) AS DOUBLE) AS TOTAL_REVENUE
    FROM ({PERFORMANCE_SQL}) p LEFT JOIN ({_LOCATIONS_SQL}) l ON p.nu_tlfn = l.nu_tlfn GROUP BY 1, 2, 3
""")
def revenue_by_location(spark, sf):
    locations = stage.stored(spark, sf, "locations", lambda: _locations(spark, sf))
    return reports.revenue_by_location(_performance(spark, sf), locations).select(
        "categoria_cliente", F.round("lat_res", 9).alias("lat_res"), F.round("lon_res", 9).alias("lon_res"),
        F.col("TOTAL_REVENUE").cast("double").alias("TOTAL_REVENUE"),
    )


@query("plan_year_revenue", f"""
    SELECT DS_PLNO, ANO, CAST(sum(TOTAL_REVENUE) AS DOUBLE) AS TOTAL_REVENUE FROM ({PERFORMANCE_SQL}) GROUP BY 1, 2
""")
def plan_year_revenue(spark, sf):
    return reports.plan_year_revenue(_performance(spark, sf)).withColumn(
        "TOTAL_REVENUE", F.col("TOTAL_REVENUE").cast("double")
    )


@query("category_year_revenue", f"""
    SELECT categoria_cliente, ANO, CAST(sum(FATURAMENTO_TOTAL) AS DOUBLE) AS FATURAMENTO_TOTAL
    FROM ({BY_MONTH_SQL}) GROUP BY 1, 2
""")
def category_year_revenue(spark, sf):
    return reports.category_year_revenue(_by_month(spark, sf)).withColumn(
        "FATURAMENTO_TOTAL", F.col("FATURAMENTO_TOTAL").cast("double")
    )


@query("revenue_vs_target", f"""
    SELECT ANO, CAST(sum(FATURAMENTO_TOTAL) AS DOUBLE) AS FATURAMENTO_TOTAL, CAST(sum(TARGET) AS DOUBLE) AS TARGET
    FROM ({BY_MONTH_SQL}) GROUP BY 1
""")
def revenue_vs_target(spark, sf):
    return reports.revenue_vs_target(_by_month(spark, sf)).withColumns(
        {c: F.col(c).cast("double") for c in ("FATURAMENTO_TOTAL", "TARGET")}
    )


@query("filter_options", f"""
    WITH m AS ({BY_MONTH_SQL}),
    f AS (SELECT *, mes_ano BETWEEN DATE '1996-01-01' AND DATE '2000-09-30' AS p_month,
                 categoria_cliente IN ('Gold', 'VIP') AS p_category, TRIMESTRE IN ('T1', 'T3') AS p_quarter FROM m)
    SELECT 'mes_ano' AS field, CAST(mes_ano AS VARCHAR) AS option,
           count(*) FILTER (p_category AND p_quarter) AS matching_rows FROM f GROUP BY 1, 2
    UNION ALL SELECT 'categoria_cliente', categoria_cliente, count(*) FILTER (p_month AND p_quarter) FROM f GROUP BY 1, 2
    UNION ALL SELECT 'TRIMESTRE', TRIMESTRE, count(*) FILTER (p_month AND p_category) FROM f GROUP BY 1, 2
""")
def filter_options(spark, sf):
    month, category, quarter = F.col("mes_ano"), F.col("categoria_cliente"), F.col("TRIMESTRE")
    return reports.filter_options(
        _by_month(spark, sf),
        {
            "mes_ano": (F.trunc(month, "MONTH"), month.between(dt.date(1996, 1, 1), dt.date(2000, 9, 30))),
            "categoria_cliente": (category, category.isin("Gold", "VIP")),
            "TRIMESTRE": (quarter, quarter.isin("T1", "T3")),
        },
    )


@query("applied_filters_label", f"""
    WITH c AS (SELECT DISTINCT {CATEGORY_SQL} AS categoria_cliente FROM customer),
    d AS (SELECT DISTINCT CAST(date_trunc('month', day) AS DATE) AS mes_ano, 'T' || quarter(day) AS TRIMESTRE
          FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
                                              INTERVAL 1 DAY)) AS day FROM orders))
    SELECT categoria_cliente, mes_ano, TRIMESTRE, 'Filtros aplicados -> Categoria Cliente: ' || categoria_cliente
           || ' | Trimestre: ' || TRIMESTRE AS filtros_aplicados
    FROM c LEFT JOIN d ON true
""")
def applied_filters_label(spark, sf):
    return reports.applied_filters_label(stage.dim_customer(spark, sf), stage.dim_date(spark, sf))
