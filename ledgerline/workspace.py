"""Shared scratch storage: where intermediate tables are written to cut lineage.

Executors come and go, so nothing here relies on executor-local storage. Every
intermediate result is a parquet table in the folder that the session names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session.

    A local session without the setting gets a fresh temporary folder; on a
    cluster a machine-local folder would be invisible to the executors, so the
    missing setting is an error there.
    """
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors can reach")
    chosen = tempfile.mkdtemp(prefix="ledgerline-")
    spark.conf.set(_SETTING, chosen)
    return chosen


def new_dir(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses. Nothing is created yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the stored copy.

    Use it where a later step reads the frame more than once and must see the
    same rows each time, or where an iteration would grow the plan.
    """
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
