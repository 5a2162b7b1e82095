"""Batch scans: snapshots with lineage, reference files, drifted columns, source size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

RESCUED = "_rescued_data"


def snapshot_scan(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A full snapshot with ingestion time and source file of every row."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path).select(
        "*",
        F.current_timestamp().alias("bronze_ts"),
        F.col("_metadata.file_path").alias("_metadata_file_path"),
    )


def with_audit_time(df: DataFrame, name: str) -> DataFrame:
    """Add the processing time, the same for all rows of one run."""
    return df.withColumn(name, F.current_timestamp())


def reference_csv(
    spark: SparkSession, path: str, schema: StructType | str, sep: str = ",", header: bool = True
) -> DataFrame:
    """A delimited reference file, read in parallel.

    A byte-order mark at the start of the file belongs to the header line and is
    dropped with it; the declared schema gives the names.
    """
    return spark.read.schema(schema).csv(path, sep=sep, header=header, enforceSchema=True, encoding="UTF-8")


def rescue_columns(df: DataFrame, expected: Sequence[str], into: str = RESCUED) -> DataFrame:
    """Move columns that are not expected into one JSON column, NULL when all are NULL."""
    known = {c.lower() for c in expected}
    extra = [c for c in df.columns if c.lower() not in known]
    missing = [F.lit(None).cast("string").alias(c) for c in expected if c.lower() not in {x.lower() for x in df.columns}]
    if not extra:
        rescued = F.lit(None).cast("string")
    else:
        present = F.coalesce(*[F.col(c).cast("string") for c in extra]).isNotNull()
        rescued = F.when(present, F.to_json(F.struct(*extra)))
    kept = [F.col(c) for c in df.columns if c.lower() in known]
    return df.select(*kept, *missing, rescued.alias(into))


def csv_with_rescue(spark: SparkSession, path: str, schema: StructType, sep: str = ",", header: bool = True) -> DataFrame:
    """CSV scan that keeps lines which do not fit the schema, as text in the rescue column."""
    full = StructType([*schema.fields]).add(RESCUED, "string")
    return spark.read.schema(full).csv(
        path, sep=sep, header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=RESCUED
    )


def source_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Number of files and their total length, from file metadata only."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listing.agg(F.count("path").alias("files"), F.sum("length").alias("bytes"))


def inline_values(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A small relation written in the program text."""
    def sql(value):
        if value is None:
            return "NULL"
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else str(value)

    body = ", ".join("(" + ", ".join(map(sql, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")


def named_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view whose name is a parameter, never part of the SQL text."""
    return spark.sql("SELECT * FROM IDENTIFIER(:name)", args={"name": name})
