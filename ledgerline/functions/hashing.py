"""Reproducible pseudo-random values derived from a row key.

Random numbers are drawn again when a task is repeated; a hash of the key is
not. md5 is used since every SQL engine has it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: 15 hex digits, the most that a signed 64-bit integer holds.
_DIGITS = 15
_RANGE = 16**_DIGITS


def hash_int(key: Column, salt: str) -> Column:
    """Integer in [0, 2**60) from the first 15 hex digits of md5(key '|' salt)."""
    text = F.concat(key.cast("string"), F.lit(f"|{salt}"))
    return F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("bigint")


def hash_unit(key: Column, salt: str) -> Column:
    """Double in [0, 1), uniform over keys."""
    return hash_int(key, salt) / F.lit(float(_RANGE))


def hash_index(key: Column, salt: str, size: Column | int) -> Column:
    """Integer in [0, size)."""
    size = F.lit(size) if isinstance(size, int) else size
    return F.pmod(hash_int(key, salt), size.cast("bigint"))
