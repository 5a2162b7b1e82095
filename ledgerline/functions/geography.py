"""Coordinates: text forms, scattering around a place, grid cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.hashing import hash_unit

# Fixed value: kilometres per degree.
KM_PER_DEGREE = 111.11


def dms_to_decimal(text: Column, negative: str) -> Column:
    """Degrees from text like 23S3045...: degrees, hemisphere letter, minutes, seconds.

    ``negative`` is the hemisphere (S or W) with a negative sign.
    """
    part = lambda start: F.substring(text, start, 2).cast("int")
    size = part(1) + part(4) / 60 + part(6) / 3600
    return F.when(F.substring(text, 3, 1) == negative, -size).otherwise(size)


def decimal_stations(df: DataFrame, latitude: str = "Latitude", longitude: str = "Longitude") -> DataFrame:
    return df.withColumns(
        {
            "lat_decimal": dms_to_decimal(F.col(latitude), "S"),
            "lon_decimal": dms_to_decimal(F.col(longitude), "W"),
        }
    )


def scatter(df: DataFrame, key: Column, copies: int, km: float, lat: str, lon: str) -> DataFrame:
    """``copies`` points around every place, uniform within +-km on both axes.

    The offsets depend on the place and the copy number, so no two places
    repeat the same pattern and a repeated task gives the same points.
    """
    reach = km / KM_PER_DEGREE
    rows = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    point = F.concat_ws(":", key.cast("string"), F.col("copy"))
    offset = lambda axis: (hash_unit(point, axis) * 2 - 1) * F.lit(reach)
    return rows.withColumns({"lat": F.col(lat) + offset("lat"), "lon": F.col(lon) + offset("lon")})


def grid_cells(df: DataFrame, columns: int, lat: str = "lat", lon: str = "lon", name: str = "grp") -> DataFrame:
    """Grid cell number over the bounding box of all rows.

    Cell sizes are rounded to one decimal degree. Where that gives zero the
    unrounded size counts, and an axis without extent has the single cell 0.
    """
    box = df.agg(
        F.struct(
            F.min(lat).alias("lat0"), F.max(lat).alias("lat1"), F.min(lon).alias("lon0"), F.max(lon).alias("lon1")
        ).alias("box")
    )

    def index(value: str, low: str, high: str) -> Column:
        exact = (F.col(f"_box.{high}") - F.col(f"_box.{low}")) / columns
        rounded = F.round(exact, 1)
        size = F.when(rounded > 0, rounded).otherwise(exact)
        return F.when(size > 0, ((F.col(value) - F.col(f"_box.{low}")) / size).cast("int")).otherwise(0)

    return (
        df.withColumn("_box", box.scalar())
        .withColumn(name, index(lat, "lat0", "lat1") * columns + index(lon, "lon0", "lon1"))
        .drop("_box")
    )
