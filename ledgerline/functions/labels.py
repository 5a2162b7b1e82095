"""Code-to-name translation and the fixed names used by the billing tables."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, functions as F

# Names of the client classes and of Brazilian-Portuguese dates.
CLIENT_CATEGORIES = {"P": "Purpura", "S": "Silver", "G": "Gold", "PL": "Platinum", "V": "VIP"}

MONTHS = {
    "January": "Janeiro", "February": "Fevereiro", "March": "Março", "April": "Abril",
    "May": "Maio", "June": "Junho", "July": "Julho", "August": "Agosto",
    "September": "Setembro", "October": "Outubro", "November": "Novembro", "December": "Dezembro",
}
MONTHS_SHORT = {
    "Jan": "Jan", "Feb": "Fev", "Mar": "Mar", "Apr": "Abr", "May": "Mai", "Jun": "Jun",
    "Jul": "Jul", "Aug": "Ago", "Sep": "Set", "Oct": "Out", "Nov": "Nov", "Dec": "Dez",
}
WEEKDAYS = {
    "Monday": "Segunda-feira", "Tuesday": "Terça-feira", "Wednesday": "Quarta-feira",
    "Thursday": "Quinta-feira", "Friday": "Sexta-feira", "Saturday": "Sábado", "Sunday": "Domingo",
}
WEEKDAYS_SHORT = {
    "Monday": "Seg", "Tuesday": "Ter", "Wednesday": "Qua", "Thursday": "Qui",
    "Friday": "Sex", "Saturday": "Sab", "Sunday": "Dom",
}
#: Brands by the first digit of a device code (fixed values).
DEVICE_BRANDS = {
    "1": "Apple", "2": "Samsung", "3": "Xiaomi", "4": "OnePlus", "5": "Google",
    "6": "Motorola", "7": "Lenovo", "8": "Sony", "9": "Huawei",
}


def decode(code: Column, names: Mapping[str, str]) -> Column:
    """Name of a code; NULL for an unknown code."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(names.items())])
    return F.try_element_at(table, code)


def translate(text: Column, names: Mapping[str, str]) -> Column:
    """Translation of a text; the text itself when there is none."""
    return F.coalesce(decode(text, names), text)


def client_category(code: Column) -> Column:
    return decode(code, CLIENT_CATEGORIES)


def quarter_label(day: Column) -> Column:
    return F.concat(F.lit("T"), F.quarter(day))


def semester_label(day: Column) -> Column:
    return F.when(F.month(day) <= 6, "S1").otherwise("S2")


def month_year_label(day: Column, short: bool = False) -> Column:
    """For example Janeiro-2024, or Jan-2024."""
    name = (
        translate(F.date_format(day, "MMM"), MONTHS_SHORT)
        if short
        else translate(F.date_format(day, "MMMM"), MONTHS)
    )
    return F.concat_ws("-", name, F.date_format(day, "yyyy"))
