"""Reproducible value assignment: weighted categories, dates, numbers, codes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, functions as F

from ledgerline.functions.hashing import hash_index, hash_unit


def weighted(key: Column, salt: str, values: Sequence, weights: Sequence[float] | None = None) -> Column:
    """One of ``values`` with probability in proportion to its weight."""
    weights = list(weights or [1] * len(values))
    total, seen, choice = sum(weights), 0.0, None
    unit = hash_unit(key, salt)
    for value, weight in list(zip(values, weights))[:-1]:
        seen += weight
        hit = unit < F.lit(seen / total)
        choice = F.when(hit, F.lit(value)) if choice is None else choice.when(hit, F.lit(value))
    last = F.lit(values[-1])
    return last if choice is None else choice.otherwise(last)


def stepped_date(key: Column, salt: str, begin: dt.date, end: dt.date, step_days: int = 1) -> Column:
    """A date in [begin, end] that is a whole number of steps after ``begin``."""
    steps = (end - begin).days // step_days + 1
    return F.date_add(F.lit(begin), (hash_index(key, salt, steps) * step_days).cast("int"))


def stepped_timestamp(key: Column, salt: str, begin: dt.datetime, end: dt.datetime, step: dt.timedelta) -> Column:
    """A time in [begin, end] that is a whole number of steps after ``begin`` (no time zone)."""
    steps = (end - begin) // step + 1
    seconds = hash_index(key, salt, steps) * int(step.total_seconds())
    start = F.lit(begin.isoformat(sep=" ")).cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def bounded(key: Column, salt: str, low: Decimal | int, high: Decimal | int, scale: int = 0) -> Column:
    """A number in [low, high] with ``scale`` decimals, all steps equally likely."""
    unit = 10**scale
    steps = int((Decimal(high) - Decimal(low)) * unit) + 1
    whole = hash_index(key, salt, steps) + int(Decimal(low) * unit)
    if scale == 0:
        return whole
    return (whole.cast("decimal(18,0)") / F.lit(unit).cast("decimal(10,0)")).cast(f"decimal(18,{scale})")


# What each template letter stands for.
ALPHABETS = {"d": "0123456789", "K": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def code(key: Column, template: str) -> Column:
    """Write a non-negative integer key in the digits that ``template`` describes.

    Different keys give different codes. A key beyond the capacity of the
    template stops the job; it is not wrapped around.
    """
    parts, place = [], 1
    for letter in reversed(template):
        if letter not in ALPHABETS:
            parts.append(F.lit(letter))
            continue
        alphabet = ALPHABETS[letter]
        # Integer division: a double would lose the low digits of large keys.
        quotient = F.call_function("div", key, F.lit(place).cast("bigint")) if place > 1 else key
        digit = F.pmod(quotient, F.lit(len(alphabet)))
        parts.append(F.substring(F.lit(alphabet), (digit + 1).cast("int"), F.lit(1)))
        place *= len(alphabet)
    text = F.concat(*reversed(parts))
    outside = (key < 0) | (key > F.lit(min(place - 1, 2**63 - 1)))
    return F.when(outside, F.raise_error(F.lit(f"key does not fit {template}"))).otherwise(text)
