"""File streams whose files do not all have the declared columns: what does not fit is kept, not lost."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from ledgerline.sources.files import RESCUED
from ledgerline.streaming.apply import batch_token
from ledgerline.streaming.ingest import run_batches

FILE = "_file"


def conformed(df: DataFrame, schema: StructType, into: str = RESCUED) -> DataFrame:
    """``df`` with exactly the columns of ``schema`` and what does not fit as JSON in ``into``, NULL where all fits.

    Names compare without case. A missing column is NULL. A value that cannot be cast is NULL in its column and goes, as
    text, to ``into`` under its name, and so do the values of columns that are not declared.
    """
    held = {name.lower(): name for name in df.columns}
    columns: list[Column] = []
    spare: list[Column] = []
    for field in schema:
        name = held.pop(field.name.lower(), None)
        if name is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value, kind = F.col(f"`{name}`"), df.schema[name].dataType
        if kind == field.dataType:
            columns.append(value.alias(field.name))
            continue
        cast = value.try_cast(field.dataType)
        try:
            df.select(cast).schema  # noqa: B018
        except AnalysisException:  # no cast between these types at all
            cast = F.lit(None).cast(field.dataType)
        columns.append(cast.alias(field.name))
        spare.append(F.when(cast.isNull() | _changed(value, cast), _as_text(value, kind)).alias(field.name))
    spare += [_as_text(F.col(f"`{name}`"), df.schema[name].dataType).alias(name) for name in held.values()]
    if not spare:
        return df.select(*columns, F.lit(None).cast("string").alias(into))
    rescued = F.to_json(F.struct(*spare))  # NULL fields are left out
    return df.select(*columns, F.when(F.coalesce(*spare).isNotNull(), rescued).alias(into))


def _changed(value: Column, cast: Column) -> Column:
    """Whether a cast has lost something: a number that does not come back, a time of day."""
    back = cast.cast("string")
    return F.coalesce(back.try_cast("decimal(38,9)") != value.cast("string").try_cast("decimal(38,9)"), F.lit(False))


def _as_text(value: Column, kind: DataType) -> Column:
    if isinstance(kind, StringType):
        return value
    return F.to_json(value) if isinstance(kind, (StructType, ArrayType, MapType)) else value.cast("string")


def read_by_schema(spark: SparkSession, paths: list[str], schema: StructType, fmt: str, options: Mapping[str, str]) -> DataFrame | None:
    """The files, each read with the schema it has, in the declared form; files of equal schema are one scan."""
    alike: dict[str, list[str]] = {}
    for path in paths:
        reader = spark.read.format(fmt).options(**options)
        if fmt == "csv":
            reader = reader.option("inferSchema", "false")  # all text: the declared types are cast to below
        alike.setdefault(reader.load(path).schema.json(), []).append(path)
    out = None
    for found, files in sorted(alike.items()):
        rows = spark.read.format(fmt).schema(StructType.fromJson(json.loads(found))).options(**options).load(files)
        part = conformed(rows.withColumn(FILE, F.col("_metadata.file_path")), StructType([*schema.fields]).add(FILE, "string"))
        out = part if out is None else out.unionByName(part)
    return out


def ingest_drifting(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    target: str,
    checkpoint: str,
    fmt: str = "parquet",
    *,
    max_files: int = 100,
    options: Mapping[str, str] | None = None,
) -> None:
    """Load the new files of a directory into ``target``, a folder ``batch=TOKEN`` for each micro-batch.

    The stream only names files; each batch looks up the schemas of its files (at most ``max_files``, by their footers or
    first lines) and reads those that are alike together. Every row arrives, with the declared columns, its file, and
    in ``_rescued_data`` what was not declared or could not be cast. A repeated batch replaces itself.
    """
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    options = dict(options or {})
    # The content is not read: a listing of names, lengths and times.
    names = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    listed = names.option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files).load(path).select("path")

    def load(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r["path"] for r in batch.collect())  # at most max_files names
        rows = read_by_schema(spark, paths, schema, fmt, options)
        if rows is not None:
            token = batch_token(spark, checkpoint, batch_id)
            rows.write.mode("overwrite").parquet(f"{target}/batch={token}")

    run_batches(listed, load, checkpoint)
