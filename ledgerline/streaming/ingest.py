"""File and table streams, and the ways to run them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerline.sources.tables import is_versioned


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    *,
    max_files: int | None = None,
    max_bytes: int | None = None,
    options: Mapping[str, str] | None = None,
    nested: bool = True,
) -> DataFrame:
    """New files of a directory as a stream. With ``nested`` subdirectories are landing lots; without, they are partitions."""
    reader = spark.readStream.format(fmt).schema(schema)
    if nested:
        reader = reader.option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.options(**(options or {})).load(path)


def with_lineage(stream: DataFrame) -> DataFrame:
    """Add ingestion time, source file and its modification time."""
    return stream.select(
        "*",
        F.current_timestamp().alias("bronze_ts"),
        F.col("_metadata.file_path").alias("_metadata_file_path"),
        F.col("_metadata.file_modification_time").alias("_metadata_file_modification_time"),
    )


def table_stream(
    spark: SparkSession, path: str, schema: StructType | str, where: Column | None = None, max_bytes: int | None = None
) -> DataFrame:
    """A stored table as a stream, limited by bytes per micro-batch, filtered at the scan.

    ``schema`` includes the partition columns, and a filter on them skips folders. Versioned and bucketed tables hold
    superseded and unfinished states side by side: stream their change log, not their root.
    """
    if is_versioned(spark, path):
        raise ValueError(f"{path} holds versions of a table; a stream would read all of them")
    stream = file_stream(spark, path, schema, max_bytes=max_bytes, nested=False)
    return stream if where is None else stream.filter(where)


def run_stream(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    name: str | None = None,
    partition_by: Sequence[str] = (),
    available_now: bool = True,
) -> StreamingQuery:
    """Append a stream to a parquet table. With ``available_now`` it ends with the input."""
    writer = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Call ``handle`` for every micro-batch until the present input is used up."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def ingest_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    target: str,
    checkpoint: str,
    fmt: str = "parquet",
    **limits,
) -> StreamingQuery:
    """Load every file of ``path`` that this checkpoint has not seen, with lineage columns."""
    return run_stream(with_lineage(file_stream(spark, path, schema, fmt, **limits)), target, checkpoint)


def run_for(query: StreamingQuery, seconds: float) -> None:
    """Let a continuous query run for a while, then stop it."""
    query.awaitTermination(seconds)
    query.stop()
