"""Coordinates and provider grid ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Inclusive coordinate bounds in degrees.
MAX_LAT = 90.0
MAX_LON = 180.0


def valid_lat_lon(lat: Column, lon: Column) -> Column:
    """True iff both are numbers (or numeric text) inside the bounds; never NULL.

    NaN sorts above every number in Spark, so the upper bound rejects it.
    """
    lat, lon = lat.try_cast("double"), lon.try_cast("double")
    inside = lat.between(-MAX_LAT, MAX_LAT) & lon.between(-MAX_LON, MAX_LON)
    return F.coalesce(inside, F.lit(False))


def float_text(x: Column) -> Column:
    """Shortest decimal text of a double with plain digits down to 0.0001.

    Spark switches to exponents below 0.001; grid keys must not.
    """
    java = x.cast("string")
    digits = F.regexp_replace(F.regexp_extract(java, r"^-?(\d\.\d+)E", 1), r"\.0$", "")
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    size = F.abs(x)
    return (
        F.when((size >= 1e-3) | (x == 0), java)
        .when(size >= 1e-4, F.concat(sign, F.lit("0.000"), F.replace(digits, F.lit("."), F.lit(""))))
        .otherwise(F.concat(
            sign, digits, F.lit("e-"),
            F.lpad(F.regexp_extract(java, r"E-(\d+)$", 1), 2, "0")))
    )


def nws_grid_id(url: Column) -> Column:
    """``…/gridpoints/LOT/76,73/…`` to ``LOT/76,73``; NULL when the URL has no grid."""
    office, x, y = (
        F.regexp_extract(url, r"/gridpoints/([A-Z]+)/(\d+),(\d+)/", i) for i in (1, 2, 3)
    )
    return F.when(office != "", F.concat(office, F.lit("/"), x, F.lit(","), y))


def grid_coordinates(grid_id: Column) -> Column:
    """``"lat,lon"`` to ``struct<lat, lon>``; NULL unless exactly two valid numbers."""
    parts = F.split(grid_id, ",", -1)
    lat = F.get(parts, F.lit(0)).try_cast("double")
    lon = F.get(parts, F.lit(1)).try_cast("double")
    good = (F.size(parts) == 2) & valid_lat_lon(lat, lon)
    return F.when(good, F.struct(lat.alias("lat"), lon.alias("lon")))
