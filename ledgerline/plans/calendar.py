"""The calendar dimension with Brazilian-Portuguese names."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.functions import labels


def date_range(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day, both ends included."""
    days = (end - start).days + 1
    return spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("DATA"))


def date_range_of(df: DataFrame, column: str) -> DataFrame:
    """One row per day between the first and the last date of ``column``."""
    ends = df.agg(F.min(column).cast("date").alias("a"), F.max(column).cast("date").alias("b"))
    return ends.select(F.explode(F.sequence("a", "b")).alias("DATA"))


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes for the dates in column DATA.

    SEMANA_DO_ANO is the day of the week (1 = Sunday), as in the tables that
    this dimension must be compatible with.
    """
    day = F.col("DATA")
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("SK_DIM_DATE"),
        F.current_timestamp().alias("ROW_INGESTION_TIMESTAMP"),
        day,
        F.year(day).alias("ANO"),
        labels.semester_label(day).alias("SEMESTRE"),
        labels.quarter_label(day).alias("TRIMESTRE"),
        F.month(day).alias("MES"),
        F.dayofweek(day).alias("SEMANA_DO_ANO"),
        labels.translate(F.date_format(day, "EEEE"), labels.WEEKDAYS).alias("NM_DIA_SEMANA"),
        labels.translate(F.date_format(day, "EEEE"), labels.WEEKDAYS_SHORT).alias("NM_DIA_SEMANA_ABRV"),
        F.dayofyear(day).alias("DIA_DO_ANO"),
        F.dayofmonth(day).alias("DIA"),
        F.date_format(day, "MM-yyyy").alias("MES_ANO"),
        labels.month_year_label(day).alias("NM_MES_ANO"),
        labels.month_year_label(day, short=True).alias("NM_MES_ANO_ABRV"),
        labels.translate(F.date_format(day, "MMMM"), labels.MONTHS).alias("NM_MES"),
        labels.translate(F.date_format(day, "MMM"), labels.MONTHS_SHORT).alias("NM_MES_ABRV"),
    )
