"""Append to a database table over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    *,
    batch_size: int = 10_000,
    connections: int = 8,
    mode: str = "append",
    properties: Mapping[str, str] | None = None,
) -> None:
    """Write in batches over a bounded number of connections.

    ``coalesce`` only lowers the number of writing tasks; it adds no shuffle.
    """
    options = {**(properties or {}), "batchsize": str(batch_size)}
    df.coalesce(connections).write.jdbc(url=url, table=table, mode=mode, properties=options)
