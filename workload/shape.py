"""Projection queries: decoding, prices, amounts, flags, deadlines, calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.functions import billing, checkdigits, labels
from ledgerline.functions.hashing import hash_index, hash_int, hash_unit
from ledgerline.operators import assign
from ledgerline.operators.joins import fits_broadcast, lookup_join, spread_join
from ledgerline.plans import calendar as cal
from ledgerline.sources.files import named_table
from workload import stage
from workload.registry import hash_sql, query, unit_sql
from workload.stage import CATEGORY_SQL, table


@query("decode_category", f"SELECT c_custkey, {CATEGORY_SQL} AS categoria_cliente FROM customer")
def decode_category(spark, sf):
    code = stage.client_code(F.col("c_mktsegment"))
    return table(spark, sf, "customer").select("c_custkey", labels.client_category(code).alias("categoria_cliente"))


# Expected prices of the inline products, written out one by one: independent of the price rules.
_PRODUCT_ROWS = ", ".join(str(row) for row in billing.PRODUCTS)
_EXPECTED_PRICES = """
    (1, 159.99), (2, 20.00), (3, 249.99), (4, 79.99), (5, 30.00), (6, 59.99),
    (7, 199.99), (8, 25.00), (9, 199.99), (10, 179.99), (11, 15.00), (12, 69.99),
    (13, 79.99), (14, 10.00), (15, 349.99), (16, 159.99), (17, 60.00), (18, 99.99),
    (19, 249.99), (20, 40.00), (21, 99.99), (22, 219.99), (23, 45.00), (24, 89.99),
    (25, 279.99), (26, 20.00), (27, 449.99), (28, 119.99), (29, 90.00), (30, 199.99)
"""
PRICED_PARTS_SQL = f"""
    SELECT p_partkey, t.id_prdt, ds_prdt, ds_plno, CAST(gross AS DECIMAL(5,2)) AS gross
    FROM part JOIN (VALUES {_PRODUCT_ROWS}) AS t(id_prdt, ds_prdt, ds_plno) ON t.id_prdt = p_partkey % 30 + 1
    JOIN (VALUES {_EXPECTED_PRICES}) AS e(id_prdt, gross) ON e.id_prdt = t.id_prdt
"""


def priced_parts(spark, sf):
    """Each part stands for one of the inline products; 30 rows by construction, so broadcast."""
    billing.products(spark).createOrReplaceTempView("inline_products")
    parts = table(spark, sf, "part").select("p_partkey", (F.col("p_partkey") % 30 + 1).cast("int").alias("id_prdt"))
    named = parts.join(F.broadcast(named_table(spark, "inline_products")), "id_prdt")
    return named.withColumn("gross", billing.plan_price(F.col("ds_prdt"), F.col("ds_plno")))


@query("price_rules", f"""
    SELECT p_partkey, id_prdt, ds_prdt, ds_plno, CAST(gross AS DOUBLE) AS gross FROM ({PRICED_PARTS_SQL})
""")
def price_rules(spark, sf):
    return priced_parts(spark, sf).withColumn("gross", F.col("gross").cast("double"))


_SERVICES_SQL = """
    SELECT event_id, user_id, CAST(floor(value) AS INTEGER) AS grossvalue,
           CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN floor(value) * 0.02
                WHEN 'FURNITURE' THEN floor(value) * 0.05 WHEN 'HOUSEHOLD' THEN floor(value) * 0.10
                WHEN 'MACHINERY' THEN floor(value) * 0.15 END AS discount
    FROM events JOIN customer ON c_custkey = user_id
"""


def _services(spark, sf):
    bought = table(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("o_custkey"), F.floor("value").cast("int").alias("grossvalue")
    )
    clients = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), stage.client_code(F.col("c_mktsegment")).alias("client")
    )
    named = lookup_join(bought, clients, ["o_custkey"])
    return named.withColumn("discountvalue", billing.service_discount(F.col("client"), F.col("grossvalue")))


@query("service_discounts", f"SELECT event_id, grossvalue, CAST(discount AS DOUBLE) AS discount FROM ({_SERVICES_SQL})")
def service_discounts(spark, sf):
    return _services(spark, sf).select("event_id", "grossvalue", F.col("discountvalue").cast("double").alias("discount"))


@query("invoice_amounts", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, event_id,
           grossvalue - CAST(trunc(CAST(discount AS FLOAT)) AS INTEGER) AS valor_total_servicos,
           CAST(coalesce(grossvalue - CAST(trunc(CAST(discount AS FLOAT)) AS INTEGER), 0) + gross AS DOUBLE) AS vl_ftra,
           CASE WHEN ds_prdt = 'Pré Pago' AND ds_plno LIKE '%Recarga%' OR ds_plno LIKE '%Pré-pago%'
                THEN CAST(gross AS DOUBLE) END AS vl_rcrg,
           CASE WHEN ds_prdt = 'Pré Pago' AND ds_plno LIKE '%Recarga%' OR ds_plno LIKE '%Pré-pago%'
                THEN CASE WHEN o_orderstatus = 'F' THEN 'BANCARIO' ELSE 'ELETRONICO' END END AS ds_cnl_rcrg
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN ({PRICED_PARTS_SQL}) ON p_partkey = l_partkey
    LEFT JOIN ({_SERVICES_SQL}) ON user_id = o_custkey
""")
def invoice_amounts(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey",
        F.when(F.col("o_orderstatus") == "F", "BANCARIO").otherwise("ELETRONICO").alias("ds_cnl_rcrg"),
    )
    parts = priced_parts(spark, sf).withColumnRenamed("p_partkey", "l_partkey")
    # Parts gain a few narrow columns from the inline products, so the size of their table decides.
    small = fits_broadcast(table(spark, sf, "part"))
    invoices = lookup_join(spread_join(lines, orders, ["l_orderkey"]), parts, ["l_partkey"], small=small)
    # Both sides carry a prefix through the join, as the amounts are computed from a wide row.
    clients = billing.prefix_columns(invoices, "clientes_").withColumnRenamed("clientes_o_custkey", "phone")
    services = billing.prefix_columns(_services(spark, sf), "servicos_").withColumnRenamed("servicos_o_custkey", "phone")
    amounts = billing.invoice_amounts(
        spread_join(clients, services, ["phone"], "left", sized_by=orders.select(F.col("o_custkey").alias("phone"))),
        kind="clientes_ds_prdt", plan="clientes_ds_plno", price="clientes_gross",
        service_price="servicos_grossvalue", discount="servicos_discountvalue", channel="clientes_ds_cnl_rcrg",
    )
    plain = billing.strip_prefix(billing.strip_prefix(amounts.drop("servicos_gross"), "clientes_"), "servicos_")
    return plain.select(
        "l_orderkey", "l_linenumber", "l_partkey", "event_id", "valor_total_servicos",
        F.col("vl_ftra").cast("double").alias("vl_ftra"), F.col("vl_rcrg").cast("double").alias("vl_rcrg"), "ds_cnl_rcrg",
    )


@query("subscription_flags", f"""
    WITH b AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) + CAST(floor(o_totalprice) AS INTEGER) % 3000 AS ends,
        CASE WHEN {unit_sql('o_orderkey', 'xdsl')} < 0.25 THEN 1 ELSE 0 END AS x,
        CASE WHEN {unit_sql('o_orderkey', 'fttc')} < 0.25 THEN 1 ELSE 0 END AS c,
        CASE WHEN {unit_sql('o_orderkey', 'ftth')} < 0.25 THEN 1 ELSE 0 END AS h FROM orders)
    SELECT o_orderkey, CASE WHEN ends <= DATE '2001-09-01' THEN ends END AS dt_dstv_lnha,
           CASE WHEN ends <= DATE '2001-09-01' THEN 0 ELSE 1 END AS id_estd_lnha, x AS id_disp_xdsl,
           CASE WHEN x = 0 THEN c ELSE 0 END AS id_disp_fttc,
           CASE WHEN x = 0 AND c = 0 THEN h ELSE 0 END AS id_disp_ftth
    FROM b
""")
def subscription_flags(spark, sf):
    key = F.col("o_orderkey")
    base = table(spark, sf, "orders").select(
        key,
        F.date_add(F.col("o_orderdate").cast("date"), F.floor("o_totalprice").cast("int") % 3000).alias("ends"),
        *[assign.weighted(key, name, [1, 0], [1, 3]).alias(name) for name in ("xdsl", "fttc", "ftth")],
    )
    flagged = billing.subscription_flags(
        base, end="ends", cutoff=F.lit(dt.date(2001, 9, 1)), dsl="xdsl", fttc="fttc", ftth="ftth"
    )
    return billing.select_in_order(
        flagged, ["o_orderkey", "dt_dstv_lnha", "id_estd_lnha", "id_disp_xdsl", "id_disp_fttc", "id_disp_ftth"]
    )


_TICKETS_SQL = f"""
    SELECT event_id, date_trunc('second', ts) AS opened, {hash_sql('event_id', 'allowed')} % 70 + 2 AS allowed,
           CASE WHEN {unit_sql('event_id', 'open')} >= 0.2 THEN {hash_sql('event_id', 'handled')} % 79 + 1 END AS handled
    FROM events
"""


def tickets(spark, sf):
    """Events as service tickets."""
    key = F.col("event_id")
    return table(spark, sf, "events").select(
        key,
        F.date_trunc("second", F.col("ts")).cast("timestamp_ntz").alias("opened"),
        (hash_index(key, "allowed", 70) + 2).cast("int").alias("allowed"),
        F.when(hash_unit(key, "open") >= 0.2, hash_index(key, "handled", 79) + 1).cast("int").alias("handled"),
    )


@query("ticket_sla", f"""
    WITH t AS (SELECT *, opened + to_hours(CAST(allowed AS INTEGER)) AS due FROM ({_TICKETS_SQL}))
    SELECT event_id, due AS dtprazofinalinterno, allowed AS expected_time, opened + INTERVAL 2 HOUR AS dtultimaalteracao,
           due + INTERVAL 5 DAY AS dtprazofinalanatel, CAST(epoch(opened) AS BIGINT) AS nrprotocolo,
           CASE WHEN coalesce(handled, ceil((epoch(TIMESTAMP '2024-02-02 00:00:01') - epoch(opened)) / 3600.0)) > allowed
                THEN 1 ELSE 0 END AS inalarme
    FROM t
""")
def ticket_sla(spark, sf):
    now = F.lit("2024-02-02 00:00:01").cast("timestamp_ntz")
    timed = billing.ticket_sla(
        tickets(spark, sf), opened="opened", allowed_hours="allowed", handled_hours="handled", now=now
    )
    return timed.drop("opened", "allowed", "handled")


_DEVICE_SQL = f"""
    SELECT c_custkey, lpad(CAST({hash_sql('c_custkey', 'maker')} % 10000000 AS VARCHAR), 7, '3')
           || lpad(CAST({hash_sql('c_custkey', 'serial')} % 10000000 AS VARCHAR), 7, '0')
           || CAST({hash_sql('c_custkey', 'check')} % 10 AS VARCHAR) AS device,
           lpad(CAST({hash_sql('c_custkey', 'tax')} AS VARCHAR), 11, '0') AS tax FROM customer
"""
_LUHN_SQL = """(list_sum(list_transform(range(1, 15), lambda p: CASE WHEN p % 2 = 1 THEN CAST(substr(device, p, 1) AS INTEGER)
    ELSE list_extract([0, 2, 4, 6, 8, 1, 3, 5, 7, 9], CAST(substr(device, p, 1) AS INTEGER) + 1) END)) * 9) % 10"""


def _tax_sql(length: int) -> str:
    total = f"""list_sum(list_transform(range(1, {length + 1}),
        lambda p: CAST(substr(tax, p, 1) AS INTEGER) * ({length + 2} - p)))"""
    return f"(CASE WHEN {total} % 11 < 2 THEN 0 ELSE 11 - {total} % 11 END)"


@query("validate_ids", f"""
    SELECT c_custkey, CAST({_LUHN_SQL} AS INTEGER) AS device_digit, {_LUHN_SQL} = CAST(substr(device, 15, 1) AS INTEGER) AS device_valid,
           list_extract(['Apple','Samsung','Xiaomi','OnePlus','Google','Motorola','Lenovo','Sony','Huawei'],
                        CAST(substr(device, 1, 1) AS INTEGER)) AS brand,
           {_tax_sql(9)} = CAST(substr(tax, 10, 1) AS INTEGER) AND {_tax_sql(10)} = CAST(substr(tax, 11, 1) AS INTEGER) AS tax_valid
    FROM ({_DEVICE_SQL})
""")
def validate_ids(spark, sf):
    key = F.col("c_custkey")
    ids = table(spark, sf, "customer").select(
        key,
        F.concat(
            F.lpad(hash_index(key, "maker", 10**7).cast("string"), 7, "3"),
            F.lpad(hash_index(key, "serial", 10**7).cast("string"), 7, "0"),
            hash_index(key, "check", 10).cast("string"),
        ).alias("device"),
        F.lpad(hash_int(key, "tax").cast("string"), 11, "0").alias("tax"),
    )
    device, tax = F.col("device"), F.col("tax")
    return ids.select(
        key,
        checkdigits.device_check_digit(device).alias("device_digit"),
        checkdigits.is_device_number(device).alias("device_valid"),
        checkdigits.device_brand(device).alias("brand"),
        checkdigits.is_tax_number(tax).alias("tax_valid"),
    )


_NAMES = "['Janeiro','Fevereiro','Março','Abril','Maio','Junho','Julho','Agosto','Setembro','Outubro','Novembro','Dezembro']"
_SHORT = "['Jan','Fev','Mar','Abr','Mai','Jun','Jul','Ago','Set','Out','Nov','Dez']"
_DAYS = "['Domingo','Segunda-feira','Terça-feira','Quarta-feira','Quinta-feira','Sexta-feira','Sábado']"
_DAYS_SHORT = "['Dom','Seg','Ter','Qua','Qui','Sex','Sab']"


@query("calendar", f"""
    WITH d AS (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
                                                  INTERVAL 1 DAY)) AS DATE) AS "DATA" FROM orders),
    n AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS order_count FROM orders GROUP BY 1)
    SELECT CAST(strftime("DATA", '%Y%m%d') AS INTEGER) AS SK_DIM_DATE, "DATA", year("DATA") AS ANO,
           CASE WHEN month("DATA") <= 6 THEN 'S1' ELSE 'S2' END AS SEMESTRE, 'T' || quarter("DATA") AS TRIMESTRE,
           month("DATA") AS MES, dayofweek("DATA") + 1 AS SEMANA_DO_ANO,
           list_extract({_DAYS}, dayofweek("DATA") + 1) AS NM_DIA_SEMANA,
           list_extract({_DAYS_SHORT}, dayofweek("DATA") + 1) AS NM_DIA_SEMANA_ABRV, dayofyear("DATA") AS DIA_DO_ANO,
           day("DATA") AS DIA, strftime("DATA", '%m-%Y') AS MES_ANO,
           list_extract({_NAMES}, month("DATA")) || '-' || year("DATA") AS NM_MES_ANO,
           list_extract({_SHORT}, month("DATA")) || '-' || year("DATA") AS NM_MES_ANO_ABRV,
           list_extract({_NAMES}, month("DATA")) AS NM_MES, list_extract({_SHORT}, month("DATA")) AS NM_MES_ABRV,
           coalesce(order_count, 0) AS order_count
    FROM d LEFT JOIN n ON day = "DATA"
""")
def calendar(spark, sf):
    orders = table(spark, sf, "orders")
    counts = orders.groupBy(F.col("o_orderdate").cast("date").alias("DATA")).agg(F.count(F.lit(1)).alias("order_count"))
    days = cal.calendar(cal.date_range_of(orders, "o_orderdate")).drop("ROW_INGESTION_TIMESTAMP")
    return days.join(counts, "DATA", "left").withColumn("order_count", F.coalesce("order_count", F.lit(0)))


@query("calendar_names", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, list_extract({_NAMES}, month(l_shipdate)) AS month_name,
           list_extract({_SHORT}, month(l_shipdate)) || '-' || year(l_shipdate) AS month_year,
           list_extract({_DAYS}, dayofweek(l_shipdate) + 1) AS weekday,
           'T' || quarter(l_shipdate) AS quarter_label
    FROM lineitem
""")
def calendar_names(spark, sf):
    day = F.col("l_shipdate")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        labels.translate(F.date_format(day, "MMMM"), labels.MONTHS).alias("month_name"),
        labels.month_year_label(day, short=True).alias("month_year"),
        labels.translate(F.date_format(day, "EEEE"), labels.WEEKDAYS).alias("weekday"),
        labels.quarter_label(day).alias("quarter_label"),
    )


@query("assign_weighted", f"""
    SELECT c_custkey, CASE WHEN u < 0.3 THEN 'P' WHEN u < 0.55 THEN 'S' WHEN u < 0.75 THEN 'G'
                           WHEN u < 0.9 THEN 'PL' ELSE 'V' END AS client
    FROM (SELECT c_custkey, {unit_sql('c_custkey', 'client')} AS u FROM customer)
""")
def assign_weighted(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        assign.weighted(F.col("c_custkey"), "client", ["P", "S", "G", "PL", "V"], [30, 25, 20, 15, 10]).alias("client"),
    )


@query("assign_dates", f"""
    SELECT c_custkey, DATE '2016-01-01' + CAST({hash_sql('c_custkey', 'day')} % 3167 AS INTEGER) AS day,
           TIMESTAMP '2023-01-01 00:00:00' + to_hours(CAST({hash_sql('c_custkey', 'hour')} % 1457 * 6 AS INTEGER)) AS at
    FROM customer
""")
def assign_dates(spark, sf):
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        key,
        assign.stepped_date(key, "day", dt.date(2016, 1, 1), dt.date(2024, 9, 1)).alias("day"),
        assign.stepped_timestamp(
            key, "hour", dt.datetime(2023, 1, 1), dt.datetime(2023, 12, 31), dt.timedelta(hours=6)
        ).alias("at"),
    )


@query("assign_numbers", f"""
    SELECT c_custkey, {hash_sql('c_custkey', 'whole')} % 11 AS whole,
           ({hash_sql('c_custkey', 'money')} % 20001) / 100.0::DOUBLE AS money FROM customer
""")
def assign_numbers(spark, sf):
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        key, assign.bounded(key, "whole", 0, 10).alias("whole"),
        assign.bounded(key, "money", 0, 200, scale=2).cast("double").alias("money"),
    )


_ALNUM = "'0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
_LETTERS = " || ".join(f"substr({_ALNUM}, CAST((k // 1000000 // {36**i}) % 36 + 1 AS INTEGER), 1)" for i in range(6, -1, -1))


@query("assign_codes", f"""
    SELECT k AS o_orderkey, {_LETTERS} || '-' || lpad(CAST(k % 1000000 AS VARCHAR), 6, '0') AS code
    FROM (SELECT o_orderkey AS k FROM orders)
""")
def assign_codes(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", assign.code(F.col("o_orderkey"), "KKKKKKK-dddddd").alias("code"))


@query("seeded_sample", f"SELECT o_orderkey, o_totalprice FROM orders WHERE {unit_sql('o_orderkey', 'sample')} < 0.1")
def seeded_sample(spark, sf):
    """Sampling is the feature here: a tenth of the orders, the same tenth each time."""
    return table(spark, sf, "orders").filter(hash_unit(F.col("o_orderkey"), "sample") < 0.1).select(
        "o_orderkey", "o_totalprice"
    )
