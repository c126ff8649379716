"""Station weather from three providers joined by grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from headway.functions.geo import float_text
from headway.functions.text import text_or_null
from headway.schemas import FALLBACK_ONLY, WEATHER

# Precedence of the sources, highest first.
SOURCES = ("nws", "om", "owm")
_STATION_COLUMNS = ("station_id", "nws_grid_id", "open_meteo_grid_id", "latitude", "longitude",
                    "collection_timestamp")


def effective_grid(grid_id: Column, lat: Column, lon: Column) -> Column:
    """The learned grid id, or ``"lat,lon"`` while none is known (NULL or empty)."""
    return F.coalesce(text_or_null(grid_id),
                      F.concat(float_text(lat), F.lit(","), float_text(lon)))


def station_grids(stations: DataFrame, nws_map: DataFrame, om_map: DataFrame) -> DataFrame:
    """Stations with their grids; a station without an NWS grid drops out.

    The maps hold one row per station (``station_id, grid_id``); join strategies
    are left to the optimizer, which broadcasts a map only while it is small.
    """
    nws = nws_map.select("station_id", F.col("grid_id").alias("nws_grid_id"))
    om = om_map.select("station_id", F.col("grid_id").alias("om_grid_id"))
    return (
        stations.select(F.col("id").alias("station_id"), "latitude", "longitude")
        .join(nws, "station_id").join(om, "station_id", "left")
        .withColumn("om_key", effective_grid(
            F.col("om_grid_id"), F.col("latitude"), F.col("longitude")))
        .select("station_id", "latitude", "longitude", "nws_grid_id", "om_grid_id", "om_key")
    )


def fallback_grids(mapping: DataFrame, nws: DataFrame, om: DataFrame) -> DataFrame:
    """Distinct effective grids of stations that lack a reading of either primary source.

    Stations collapse to distinct grid pairs before any join.
    """
    pairs = mapping.select("nws_grid_id", "om_key").distinct()
    no_nws = pairs.join(nws.select(F.col("grid_id").alias("nws_grid_id")), "nws_grid_id", "left_anti")
    no_om = pairs.join(om.select(F.col("grid_id").alias("om_key")), "om_key", "left_anti")
    return no_nws.select("om_key").union(no_om.select("om_key")).distinct()


def grid_usage(mapping: DataFrame, grid: str) -> DataFrame:
    """Stations per distinct grid, and how many of them still use raw coordinates."""
    return mapping.groupBy(grid).agg(
        F.count(F.lit(1)).alias("stations"),
        F.count_if(text_or_null(F.col("om_grid_id")).isNull()).alias("cache_misses"))


def merge_weather(mapping: DataFrame, nws: DataFrame, om: DataFrame, owm: DataFrame,
                  collected_at: Column, mode: str = "presence") -> DataFrame:
    """One weather row per station with at least one reading.

    ``presence`` takes each column from the highest source that has a row, even
    if its value is NULL; ``coalesce`` takes the highest non-NULL value.  The
    provider tables hold one row per ``grid_id``; coordinates are the station's.
    """
    if mode not in ("presence", "coalesce"):
        raise ValueError("mode must be 'presence' or 'coalesce'")
    frames = dict(zip(SOURCES, (nws, om, owm)))
    keys = dict(zip(SOURCES, ("nws_grid_id", "om_key", "om_key")))
    joined = mapping
    columns: dict[str, list[str]] = {}
    for source, frame in frames.items():
        values = [c for c in frame.columns if c not in ("grid_id", "collected_at")]
        for c in values:
            columns.setdefault(c, []).append(source)
        side = frame.select(
            F.col("grid_id").alias(f"{source}__key"),
            *[F.col(c).alias(f"{source}__{c}") for c in values])
        joined = joined.join(side, F.col(keys[source]) == F.col(f"{source}__key"), "left")

    has = {s: F.col(f"{s}__key").isNotNull() for s in SOURCES}

    def pick(name: str, wanted: str) -> Column:
        owners = columns.get(name, [])
        cells = [F.col(f"{s}__{name}").cast(wanted) for s in owners]
        if not owners:
            return F.lit(None).cast(wanted)
        if mode == "coalesce":
            return F.coalesce(*cells)
        chosen = F.when(has[owners[0]], cells[0])
        for s, cell in zip(owners[1:], cells[1:]):
            chosen = chosen.when(has[s], cell)
        return chosen

    station = {
        "station_id": F.col("station_id"), "nws_grid_id": F.col("nws_grid_id"),
        "open_meteo_grid_id": F.col("om_key"), "latitude": F.col("latitude"),
        "longitude": F.col("longitude"), "collection_timestamp": collected_at,
    }
    measured = [f for f in [*WEATHER, *FALLBACK_ONLY] if f.name not in _STATION_COLUMNS]
    return joined.filter(has["nws"] | has["om"] | has["owm"]).select(
        *[station[c].alias(c) for c in _STATION_COLUMNS],
        *[pick(f.name, f.dataType.simpleString()).alias(f.name) for f in measured])
