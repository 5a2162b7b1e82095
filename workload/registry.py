"""Registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def hash_sql(key: str, salt: str) -> str:
    """SQL form of ``functions.hashing.hash_int``."""
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{salt}'), 1, 15))::BIGINT)"


def unit_sql(key: str, salt: str) -> str:
    return f"({hash_sql(key, salt)} / 1152921504606846976.0::DOUBLE)"
