"""Revenue, payment and filter reports over the invoice star."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.labels import client_category
from ledgerline.operators.joins import lookup_join
from ledgerline.plans.star import join_star

# Published on-time percentages of the five client categories.
ON_TIME_PERCENT = {"Purpura": 62, "Silver": 83, "Gold": 89, "Platinum": 95, "VIP": 99}


def _star(fact: DataFrame, dates: DataFrame, customers: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Fact rows with the category and the date and product attributes they need."""
    customers = customers.select(
        "SK_DIM_CUSTOMER", "nu_tlfn", client_category(F.col("CLIENT")).alias("categoria_cliente")
    )
    dims = {"dates": (dates, "SK_DIM_DATE"), "customers": (customers, "SK_DIM_CUSTOMER")}
    if products is not None:
        dims["products"] = (products.select("SK_DIM_PRODUCT", "DS_PRDT", "DS_PLNO"), "SK_DIM_PRODUCT")
    return join_star(fact, **dims)


def product_performance(fact: DataFrame, dates: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Customers, revenue and mean invoice by category, phone, quarter and product.

    Rows come unordered; sort where the result is shown.
    """
    fact = fact.select("SK_DIM_DATE", "SK_DIM_CUSTOMER", "SK_DIM_PRODUCT", "VL_FTRA")
    rows = _star(fact, dates.select("SK_DIM_DATE", "ANO", "TRIMESTRE"), customers, products)
    return rows.groupBy("categoria_cliente", "nu_tlfn", "ANO", "TRIMESTRE", "DS_PRDT", "DS_PLNO").agg(
        F.countDistinct("SK_DIM_CUSTOMER").alias("CUSTOMER_COUNT"),
        F.sum("VL_FTRA").alias("TOTAL_REVENUE"),
        F.avg("VL_FTRA").alias("AVG_INVOICE_VALUE"),
    )


def revenue_by_category_month(fact: DataFrame, dates: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue and its 5 % higher target by category and month."""
    fact = fact.select("SK_DIM_DATE", "SK_DIM_CUSTOMER", "VL_FTRA")
    dates = dates.select(
        "SK_DIM_DATE", "ANO", "NM_MES", "TRIMESTRE", F.to_date("MES_ANO", "MM-yyyy").alias("mes_ano")
    )
    return (
        _star(fact, dates, customers)
        .groupBy("ANO", "NM_MES", "mes_ano", "categoria_cliente", "TRIMESTRE")
        .agg(F.sum("VL_FTRA").alias("FATURAMENTO_TOTAL"))
        .withColumn("TARGET", F.col("FATURAMENTO_TOTAL") * F.lit("1.05").cast("decimal(3,2)"))
    )


def on_time_payments(
    fact: DataFrame, dates: DataFrame, customers: DataFrame, overrides: Mapping[str, int] = ON_TIME_PERCENT
) -> DataFrame:
    """Share of invoices paid by the due date, per category.

    The due date is the cycle date plus (due day - 1) days. Categories with a
    published percentage show that one; the computed value stands next to it.
    """
    fact = fact.select("SK_DIM_DATE", "SK_DIM_CUSTOMER", "DT_VNCMT", "DT_PGTO")
    due = F.date_add(F.col("DATA"), F.col("DT_VNCMT").cast("int") - 1)
    rows = _star(fact, dates.select("SK_DIM_DATE", "DATA"), customers).select(
        "categoria_cliente",
        F.date_diff("DT_PGTO", due).alias("days_to_pay"),
        F.when(F.col("DT_PGTO") <= due, 1).otherwise(0).alias("on_time"),
    )
    report = rows.groupBy("categoria_cliente").agg(
        F.sum("on_time").alias("ON_TIME_INVOICES"),
        F.count(F.lit(1)).alias("TOTAL_INVOICES"),
        F.sum("days_to_pay").alias("TOTAL_DAYS_TO_PAY"),
    )
    computed = F.col("ON_TIME_INVOICES") * F.lit(100.0) / F.col("TOTAL_INVOICES")
    shown = computed
    for category, percent in overrides.items():
        shown = F.when(F.col("categoria_cliente") == category, F.lit(float(percent))).otherwise(shown)
    return report.withColumn("COMPUTED_PERCENT", computed).withColumn("PERCENT_ON_TIME_PAYMENTS", shown)


def revenue_by_location(performance: DataFrame, locations: DataFrame) -> DataFrame:
    """Revenue by category and home location; customers without location keep a NULL place.

    Revenue is summed per phone first, so that a phone with many rows joins once.
    """
    per_phone = performance.groupBy("categoria_cliente", "nu_tlfn").agg(F.sum("TOTAL_REVENUE").alias("revenue"))
    placed = lookup_join(per_phone, locations.select("nu_tlfn", "lat_res", "lon_res"), ["nu_tlfn"], "left")
    return placed.groupBy("categoria_cliente", "lat_res", "lon_res").agg(F.sum("revenue").alias("TOTAL_REVENUE"))


def plan_year_revenue(performance: DataFrame) -> DataFrame:
    return performance.groupBy("DS_PLNO", "ANO").agg(F.sum("TOTAL_REVENUE").alias("TOTAL_REVENUE"))


def category_year_revenue(by_month: DataFrame) -> DataFrame:
    return by_month.groupBy("categoria_cliente", "ANO").agg(F.sum("FATURAMENTO_TOTAL").alias("FATURAMENTO_TOTAL"))


def revenue_vs_target(by_month: DataFrame) -> DataFrame:
    return by_month.groupBy("ANO").agg(
        F.sum("FATURAMENTO_TOTAL").alias("FATURAMENTO_TOTAL"), F.sum("TARGET").alias("TARGET")
    )


def filter_options(df: DataFrame, filters: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Values of every filter field with the number of rows the other filters let through.

    ``filters`` maps a field name to (value expression, active predicate). All
    fields are answered in one pass: a row becomes one entry per field, and
    entries are counted before the shuffle.
    """
    entries = []
    for name, (value, _) in filters.items():
        passes = F.lit(True)
        for other, (_, predicate) in filters.items():
            if other != name:
                passes = passes & predicate
        entries.append(
            F.struct(F.lit(name).alias("field"), value.cast("string").alias("option"), passes.alias("passes"))
        )
    return (
        df.select(F.inline(F.array(*entries)))
        .groupBy("field", "option")
        .agg(F.count_if(F.col("passes")).alias("matching_rows"))
    )


def applied_filters_label(customers: DataFrame, dates: DataFrame) -> DataFrame:
    """Every category with every calendar month and the text that describes the choice.

    The months are one array in a one-row frame, bounded by the calendar, not by
    the facts. A category stays, with NULL dates, when there is no month.
    """
    months = dates.select(F.to_date("MES_ANO", "MM-yyyy").alias("mes_ano"), "TRIMESTRE").distinct()
    months = months.agg(F.collect_list(F.struct("mes_ano", "TRIMESTRE")).alias("months"))
    categories = customers.select(client_category(F.col("CLIENT")).alias("categoria_cliente")).distinct()
    return (
        categories.withColumn("months", months.scalar())
        .select("categoria_cliente", F.explode_outer("months").alias("m"))
        .select("categoria_cliente", "m.*")
        .withColumn(
            "filtros_aplicados",
            F.concat(
                F.lit("Filtros aplicados -> Categoria Cliente: "),
                F.col("categoria_cliente"),
                F.lit(" | Trimestre: "),
                F.col("TRIMESTRE"),
            ),
        )
    )
