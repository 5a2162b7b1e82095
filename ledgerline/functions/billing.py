"""Prices, invoice amounts, subscription flags and ticket deadlines as expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.sources.files import inline_values

POSTPAID, PREPAID = "Pós Pago", "Pré Pago"

# The product list (id, type, plan).
PRODUCTS = (
    (1, POSTPAID, "Plano Família 50GB"),
    (2, PREPAID, "Recarga Fácil 20"),
    (3, POSTPAID, "Plano Empresarial 100GB"),
    (4, POSTPAID, "Plano Jovem 30GB"),
    (5, PREPAID, "Cartão Pré-pago 30 Dias"),
    (6, POSTPAID, "Plano Controle 20GB"),
    (7, POSTPAID, "Plano Premium Ilimitado"),
    (8, PREPAID, "Recarga Mensal 5GB"),
    (9, POSTPAID, "Plano Família 100GB"),
    (10, POSTPAID, "Plano Executivo 80GB"),
    (11, PREPAID, "Cartão Pré-pago 15 Dias"),
    (12, POSTPAID, "Plano Estudante 40GB"),
    (13, POSTPAID, "Plano Controle 40GB"),
    (14, PREPAID, "Recarga Semanal 2GB"),
    (15, POSTPAID, "Plano Empresarial 200GB"),
    (16, POSTPAID, "Plano Família 150GB"),
    (17, PREPAID, "Cartão Pré-pago 60 Dias"),
    (18, POSTPAID, "Plano Jovem 50GB"),
    (19, POSTPAID, "Plano Premium 5G"),
    (20, PREPAID, "Recarga Mensal 10GB"),
    (21, POSTPAID, "Plano Controle 60GB"),
    (22, POSTPAID, "Plano Executivo 120GB"),
    (23, PREPAID, "Cartão Pré-pago 45 Dias"),
    (24, POSTPAID, "Plano Estudante 60GB"),
    (25, POSTPAID, "Plano Família 200GB"),
    (26, PREPAID, "Recarga Quinzenal 3GB"),
    (27, POSTPAID, "Plano Empresarial 300GB"),
    (28, POSTPAID, "Plano Controle 80GB"),
    (29, PREPAID, "Cartão Pré-pago 90 Dias"),
    (30, POSTPAID, "Plano Premium 5G Ilimitado"),
)

# The price table. Per product type, the plan families in order of
# precedence; per family, the price of the first contained text, then the
# family's own price under "". "" as family is the price of the product type.
PRICES = {
    POSTPAID: {
        "Família": {"50GB": "159.99", "100GB": "199.99", "150GB": "239.99", "200GB": "279.99", "": "199.99"},
        "Empresarial": {"100GB": "249.99", "200GB": "349.99", "300GB": "449.99", "": "299.99"},
        "Jovem": {"30GB": "79.99", "50GB": "99.99", "": "89.99"},
        "Controle": {"20GB": "59.99", "40GB": "79.99", "60GB": "99.99", "80GB": "119.99", "": "89.99"},
        "Premium": {"Ilimitado": "199.99", "5G": "249.99", "": "179.99"},
        "Executivo": {"80GB": "179.99", "120GB": "219.99", "": "199.99"},
        "Estudante": {"40GB": "69.99", "60GB": "89.99", "": "79.99"},
        "": {"": "99.99"},
    },
    PREPAID: {
        "Recarga Fácil": {"": "20.00"},
        "Cartão Pré-pago 30 Dias": {"": "30.00"},
        "Recarga Mensal 5GB": {"": "25.00"},
        "Cartão Pré-pago 15 Dias": {"": "15.00"},
        "Recarga Semanal 2GB": {"": "10.00"},
        "Cartão Pré-pago 60 Dias": {"": "60.00"},
        "Recarga Mensal 10GB": {"": "40.00"},
        "Cartão Pré-pago 45 Dias": {"": "45.00"},
        "Recarga Quinzenal 3GB": {"": "20.00"},
        "Cartão Pré-pago 90 Dias": {"": "90.00"},
        "": {"": "30.00"},
    },
}
# Discount of a service per client class.
DISCOUNT_RATES = {"P": "0.00", "S": "0.02", "G": "0.05", "PL": "0.10", "V": "0.15"}


def products(spark) -> DataFrame:
    """The inline product relation."""
    return inline_values(spark, PRODUCTS, ["id_prdt", "ds_prdt", "ds_plno"])


def first_match(text: Column, rules: Mapping[str, Column]) -> Column:
    """Value of the first rule whose text is contained; the rule "" always matches."""
    result = rules.get("", F.lit(None))
    for part, value in reversed([item for item in rules.items() if item[0]]):
        result = F.when(text.contains(part), value).otherwise(result)
    return result


def plan_price(kind: Column, plan: Column, prices: Mapping = PRICES) -> Column:
    """Price from ordered rules; 0 for an unknown product type."""
    result = F.lit("0.00").cast("decimal(5,2)")
    for name, families in prices.items():
        per_family = {
            family: first_match(plan, {part: F.lit(p).cast("decimal(5,2)") for part, p in rules.items()})
            for family, rules in families.items()
        }
        result = F.when(kind == name, first_match(plan, per_family)).otherwise(result)
    return result


def service_discount(client: Column, gross: Column, rates: Mapping[str, str] = DISCOUNT_RATES) -> Column:
    """Discount as text; NULL for an unknown client class."""
    result = F.lit(None).cast("string")
    for code, rate in rates.items():
        # The zero class is the literal 0, not 0 times the gross value.
        value = F.lit(0).cast("string") if float(rate) == 0 else (gross * F.lit(rate).cast("decimal(3,2)")).cast("string")
        result = F.when(client == code, value).otherwise(result)
    return result


def invoice_amounts(
    df: DataFrame,
    *,
    kind: str = "ds_prdt",
    plan: str = "ds_plno",
    price: str = "gross",
    service_price: str = "grossvalue",
    discount: str = "discountvalue",
    channel: str = "ds_cnl_rcrg",
) -> DataFrame:
    """Add service total, invoice total, recharge value and recharge channel.

    The discount text is read as a number and cut to whole units before it is
    subtracted. A recharge is a prepaid plan with 'Recarga' in its name, or any
    plan with 'Pré-pago' in its name, whatever its type.
    """
    whole_discount = F.col(discount).cast("float").cast("int")
    recharge = ((F.col(kind) == PREPAID) & F.col(plan).contains("Recarga")) | F.col(plan).contains("Pré-pago")
    amounts = df.withColumn("valor_total_servicos", F.col(service_price) - whole_discount)
    amounts = amounts.withColumns(
        {
            "vl_ftra": F.when(
                F.col(kind).isNotNull(),
                (F.coalesce(F.col("valor_total_servicos"), F.lit(0)) + F.col(price)).cast("decimal(13,2)"),
            ),
            "vl_rcrg": F.when(recharge, F.col(price)).cast("decimal(5,2)"),
        }
    )
    return amounts.withColumn(channel, F.when(F.col("vl_rcrg").isNotNull(), F.col(channel)))


def subscription_flags(
    df: DataFrame, *, end: str, cutoff: Column, dsl: str, fttc: str, ftth: str
) -> DataFrame:
    """Dependent flags: end date up to a cutoff, line state, one access technology at most."""
    kept_end = F.when(F.col(end) <= cutoff, F.col(end))
    return (
        df.withColumn("dt_dstv_lnha", kept_end)
        .withColumn("id_estd_lnha", F.when(F.col("dt_dstv_lnha").isNull(), 1).otherwise(0).cast("smallint"))
        .withColumn("id_disp_xdsl", F.col(dsl).cast("tinyint"))
        .withColumn("id_disp_fttc", F.when(F.col("id_disp_xdsl") == 0, F.col(fttc)).otherwise(0).cast("tinyint"))
        .withColumn(
            "id_disp_ftth",
            F.when((F.col("id_disp_xdsl") == 0) & (F.col("id_disp_fttc") == 0), F.col(ftth))
            .otherwise(0)
            .cast("tinyint"),
        )
    )


def _hours_between(start: Column, end: Column) -> Column:
    return F.ceil((F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(3600.0))


def ticket_sla(df: DataFrame, *, opened: str, allowed_hours: str, handled_hours: str, now: Column) -> DataFrame:
    """Deadlines and alarm of a service ticket.

    A ticket without handling time is still open; its age at ``now`` counts.
    """
    hour = lambda n: F.make_dt_interval(F.lit(0), n)
    due = df.withColumn("dtprazofinalinterno", F.col(opened) + hour(F.col(allowed_hours)))
    spent = F.coalesce(F.col(handled_hours), _hours_between(F.col(opened), now))
    return due.withColumns(
        {
            "expected_time": _hours_between(F.col(opened), F.col("dtprazofinalinterno")),
            "dtultimaalteracao": F.col(opened) + hour(F.lit(2)),
            "dtprazofinalanatel": F.col("dtprazofinalinterno") + hour(F.lit(5 * 24)),
            "nrprotocolo": F.unix_timestamp(F.col(opened)),
        }
    ).withColumn("inalarme", F.when(spent > F.col("expected_time"), 1).otherwise(0))


def select_in_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns})


def strip_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: c.removeprefix(prefix) for c in df.columns})
