"""Check-digit tests for device numbers (15 digits) and tax numbers (11 digits)."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from ledgerline.functions.labels import DEVICE_BRANDS, decode


def _digit(text: Column, position: int) -> Column:
    return F.substring(text, position, 1).cast("int")


def device_check_digit(text: Column) -> Column:
    """Luhn digit of the first 14 digits: every second digit counts double, as digit sum."""
    def weight(position: int) -> Column:
        d = _digit(text, position)
        if position % 2 == 1:
            return d
        return F.when(d >= 5, d * 2 - 9).otherwise(d * 2)

    return (reduce(add, [weight(p) for p in range(1, 15)]) * 9) % 10


def is_device_number(text: Column) -> Column:
    shape = text.rlike("^[0-9]{15}$")
    return F.when(shape, device_check_digit(text) == _digit(text, 15)).otherwise(False)


def device_brand(text: Column) -> Column:
    return decode(F.substring(text, 1, 1), DEVICE_BRANDS)


def tax_check_digit(text: Column, length: int) -> Column:
    """Mod-11 digit of the first ``length`` digits, weights length+1 down to 2."""
    total = reduce(add, [_digit(text, p) * (length + 2 - p) for p in range(1, length + 1)])
    return F.when(total % 11 < 2, 0).otherwise(11 - total % 11)


def is_tax_number(text: Column) -> Column:
    """Accepts plain digits and the 000.000.000-00 form."""
    digits = F.regexp_replace(text, "[.-]", "")
    shape = text.rlike(r"^([0-9]{11}|[0-9]{3}\.[0-9]{3}\.[0-9]{3}-[0-9]{2})$")
    both = (tax_check_digit(digits, 9) == _digit(digits, 10)) & (tax_check_digit(digits, 10) == _digit(digits, 11))
    return F.when(shape, both).otherwise(False)
