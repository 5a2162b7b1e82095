import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerline.functions import billing, checkdigits, geography, labels
from ledgerline.operators import assign
from ledgerline.plans import calendar as cal
from tests.conftest import rows


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_all_thirty_prices(spark):
    priced = billing.products(spark).select("id_prdt", billing.plan_price(F.col("ds_prdt"), F.col("ds_plno")).alias("p"))
    found = {r["id_prdt"]: r["p"] for r in priced.collect()}
    # Price by product id. Product 16 (150GB) has the 50GB price, as its text contains '50GB'.
    expected = dict(enumerate((
        "159.99 20.00 249.99 79.99 30.00 59.99 199.99 25.00 199.99 179.99 15.00 69.99 79.99 10.00 349.99 "
        "159.99 60.00 99.99 249.99 40.00 99.99 219.99 45.00 89.99 279.99 20.00 449.99 119.99 90.00 199.99").split(), 1))
    assert {k: str(v) for k, v in found.items()} == expected


def test_price_fallbacks(spark):
    df = spark.createDataFrame(
        [("Pós Pago", "Outro"), ("Pós Pago", "Família X"), ("Pré Pago", "Outro"), ("Fixa", "Família 50GB")], "t string, p string")
    assert [str(v) for v in one(df, billing.plan_price(F.col("t"), F.col("p")))] == ["99.99", "199.99", "30.00", "0.00"]


def test_invoice_amounts_corner_cases(spark):
    D = Decimal
    df = spark.createDataFrame(
        [
            (1, "Pós Pago", "Plano Jovem 30GB", D("79.99"), None, None, "BANCARIO"),
            (2, "Pós Pago", "Plano Jovem 30GB", D("79.99"), 100, "12.5", "BANCARIO"),
            (3, "Pré Pago", "Recarga Fácil 20", D("20.00"), 3, "0.06", "ELETRONICO"),
            (4, None, "Plano Jovem 30GB", D("79.99"), 10, "0", "BANCARIO"),
            (5, "Pós Pago", "Cartão Pré-pago 30 Dias", D("30.00"), None, None, "BANCARIO"),
            (6, "Pós Pago", "Recarga Fácil 20", D("20.00"), None, None, "BANCARIO"),
        ],
        "id int, ds_prdt string, ds_plno string, gross decimal(5,2), grossvalue int, discountvalue string, ds_cnl_rcrg string",
    )
    out = rows(billing.invoice_amounts(df).select("id", "valor_total_servicos", "vl_ftra", "vl_rcrg", "ds_cnl_rcrg"))
    assert out == [
        (1, None, D("79.99"), None, None), (2, 88, D("167.99"), None, None), (3, 3, D("23.00"), D("20.00"), "ELETRONICO"),
        (4, 10, None, None, None), (5, None, D("30.00"), D("30.00"), "BANCARIO"), (6, None, D("20.00"), None, None),
    ]


def test_service_discount_is_text(spark):
    df = spark.createDataFrame([("P", 10), ("S", 3), ("V", 10), ("?", 10)], "c string, g int")
    assert one(df, billing.service_discount(F.col("c"), F.col("g"))) == ["0", "0.06", "1.50", None]


def test_ticket_deadlines(spark):
    opened = dt.datetime(2024, 9, 1, 1)
    df = spark.createDataFrame([(opened, 24, 25), (opened, 24, 24), (opened, 24, None)], "o timestamp, a int, h int")
    out = billing.ticket_sla(df, opened="o", allowed_hours="a", handled_hours="h", now=F.lit(dt.datetime(2024, 9, 2, 2)))
    assert one(out, "inalarme") == [1, 0, 1]
    first = out.first()
    assert (first["dtprazofinalinterno"], first["dtprazofinalanatel"], first["dtultimaalteracao"], first["expected_time"]) == (
        dt.datetime(2024, 9, 2, 1), dt.datetime(2024, 9, 7, 1), dt.datetime(2024, 9, 1, 3), 24)


def test_subscription_flags_are_exclusive(spark):
    df = spark.createDataFrame([(dt.date(2024, 9, 2), 1, 1, 1), (dt.date(2024, 9, 1), 0, 1, 1), (None, 0, 0, 1)],
                               "e date, x int, c int, h int")
    out = billing.subscription_flags(df, end="e", cutoff=F.lit(dt.date(2024, 9, 1)), dsl="x", fttc="c", ftth="h")
    assert [tuple(r) for r in out.select("dt_dstv_lnha", "id_estd_lnha", "id_disp_xdsl", "id_disp_fttc", "id_disp_ftth").collect()] == [
        (None, 1, 1, 0, 0), (dt.date(2024, 9, 1), 0, 0, 1, 0), (None, 1, 0, 0, 1)]


def test_calendar_bounds_and_names(spark):
    days = cal.calendar(cal.date_range(spark, dt.date(2000, 1, 1), dt.date(2099, 1, 1))).cache()
    assert days.count() == 36_161
    leap = days.filter("SK_DIM_DATE = 20240229").first()
    assert (leap["SEMESTRE"], leap["TRIMESTRE"], leap["NM_DIA_SEMANA"], leap["NM_DIA_SEMANA_ABRV"], leap["DIA_DO_ANO"],
            leap["MES_ANO"], leap["NM_MES_ANO"], leap["NM_MES_ANO_ABRV"], leap["NM_MES"], leap["NM_MES_ABRV"]) == (
        "S1", "T1", "Quinta-feira", "Qui", 60, "02-2024", "Fevereiro-2024", "Fev-2024", "Fevereiro", "Fev")
    sunday = days.filter("SK_DIM_DATE = 20241201").first()
    assert sunday["SEMANA_DO_ANO"] == 1 and sunday["NM_DIA_SEMANA"] == "Domingo" and sunday["SEMESTRE"] == "S2"
    assert days.filter("SK_DIM_DATE in (20000101, 20990101, 20241231)").count() == 3
    days.unpersist()


def test_translation_falls_back_to_the_input(spark):
    df = spark.createDataFrame([("May",), ("Xyz",)], "t string")
    assert one(df, labels.translate(F.col("t"), labels.MONTHS_SHORT)) == ["Mai", "Xyz"]
    assert one(df, labels.client_category(F.lit("PL"))) == ["Platinum"] * 2
    assert one(df, labels.client_category(F.col("t"))) == [None, None]


def test_device_numbers(spark):
    # Known valid and invalid numbers and check digits.
    valid = ["358065019104265", "357805023984942", "356938035643809"]
    invalid = ["358065019104263", "357805023984941", "356938035643801", "35806501910426", "35806501910426x", ""]
    df = spark.createDataFrame([(v,) for v in valid + invalid], "t string")
    assert one(df, checkdigits.is_device_number(F.col("t"))) == [True] * 3 + [False] * 6
    digits = spark.createDataFrame([("35806501910426",), ("35780502398494",), ("35693803564380",), ("49015420323751",)], "t string")
    assert one(digits, checkdigits.device_check_digit(F.col("t"))) == [5, 2, 9, 8]
    assert one(digits, checkdigits.device_brand(F.col("t"))) == ["Xiaomi", "Xiaomi", "Xiaomi", "OnePlus"]


def test_tax_numbers(spark):
    df = spark.createDataFrame([("529.982.247-25",), ("52998224725",), ("52998224724",), ("5299822472",), ("529.982.24725",)], "t string")
    assert one(df, checkdigits.is_tax_number(F.col("t"))) == [True, True, False, False, False]


def test_degrees_from_text(spark):
    df = spark.createDataFrame([("23S3036", "46W0000"), ("04N1500", "38W5512")], "Latitude string, Longitude string")
    out = geography.decimal_stations(df).select("lat_decimal", "lon_decimal").collect()
    assert [tuple(round(v, 6) for v in r) for r in out] == [(-23.51, -46.0), (4.25, -38.92)]


def test_scatter_stays_near_and_does_not_repeat(spark):
    places = spark.createDataFrame([(1, -10.0, -50.0), (2, 5.0, -40.0)], "s int, a double, o double")
    points = geography.scatter(places, F.col("s"), 40, 2.0, "a", "o")
    assert points.count() == 80
    reach = 2.0 / 111.11
    assert points.filter((F.abs(F.col("lat") - F.col("a")) > reach) | (F.abs(F.col("lon") - F.col("o")) > reach)).count() == 0
    assert points.select(F.round(F.col("lat") - F.col("a"), 9)).distinct().count() == 80


def test_grid_without_extent(spark):
    same = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0)], "lat double, lon double")
    assert one(geography.grid_cells(same, 100), "grp") == [0, 0]
    small = spark.createDataFrame([(1.0, 2.0), (1.01, 2.0)], "lat double, lon double")
    assert sorted(one(geography.grid_cells(small, 100), "grp"))[0] == 0


def test_weighted_shares(spark):
    df = spark.range(20_000).select(assign.weighted(F.col("id"), "w", ["a", "b", "c"], [0.7, 0.2, 0.1]).alias("v"))
    share = {r["v"]: r["count"] / 20_000 for r in df.groupBy("v").count().collect()}
    assert all(abs(share[v] - w) < 0.02 for v, w in {"a": 0.7, "b": 0.2, "c": 0.1}.items())


def test_dates_and_numbers_stay_in_range(spark):
    key = F.col("id")
    df = spark.range(3000).select(
        assign.stepped_date(key, "d", dt.date(2024, 1, 1), dt.date(2024, 1, 15), 7).alias("d"),
        assign.bounded(key, "n", Decimal("-1"), Decimal("1"), 1).alias("n"))
    assert sorted(one(df.select("d").distinct(), "d")) == [dt.date(2024, 1, 1), dt.date(2024, 1, 8), dt.date(2024, 1, 15)]
    assert df.agg(F.min("n"), F.max("n")).first()[:] == (Decimal("-1.0"), Decimal("1.0"))
    assert df.select("n").distinct().count() == 21


def test_codes_are_unique_and_bounded(spark):
    df = spark.range(50_000).select(assign.code(F.col("id"), "KK-ddd").alias("c"))
    assert df.distinct().count() == 50_000 and df.first()["c"] == "00-000"
    big = spark.range(1).select(assign.code(F.lit(36**7 * 10**6 - 1), "KKKKKKK-dddddd").alias("c"))
    assert big.first()["c"] == "ZZZZZZZ-999999"
    with pytest.raises(PySparkException):
        spark.range(1).select(assign.code(F.lit(1000), "ddd").alias("c")).collect()


def test_prefixes_come_and_go(spark):
    df = spark.range(1).withColumn("x", F.lit(1))
    assert billing.prefix_columns(df, "p_").columns == ["p_id", "p_x"]
    assert billing.strip_prefix(billing.prefix_columns(df, "p_"), "p_").columns == ["id", "x"]
