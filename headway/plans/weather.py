"""Weather cycle: landed provider payloads to one stored row per station."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from headway.operators import forecasts, merge
from headway.operators.ordered import latest_per_key
from headway.plans.store import write_dataset


def newest_readings(readings: DataFrame) -> DataFrame:
    """One reading per grid, the last collected."""
    return latest_per_key(readings, ["grid_id"], ["collected_at"])


def weather_cycle(stations: DataFrame, nws_map: DataFrame, om_map: DataFrame,
                  nws_raw: DataFrame, om_raw: DataFrame, owm_raw: DataFrame,
                  collected_at: Column, mode: str = "presence") -> tuple[DataFrame, DataFrame]:
    """``(weather rows, rejected payloads)`` of a cycle.

    The fallback provider counts only for grids where a primary one is missing.
    """
    nws, bad_nws = forecasts.nws_hourly(nws_raw)
    om, bad_om = forecasts.open_meteo_current(om_raw)
    owm, bad_owm = forecasts.owm_current(owm_raw)
    nws, om, owm = (newest_readings(r) for r in (nws, om, owm))
    mapping = merge.station_grids(stations, nws_map, om_map)
    needed = merge.fallback_grids(mapping, nws, om).withColumnRenamed("om_key", "grid_id")
    owm = owm.join(needed, "grid_id", "left_semi")
    rejected = bad_nws.withColumn("provider", F.lit("nws")).unionByName(
        bad_om.withColumn("provider", F.lit("open_meteo"))).unionByName(
        bad_owm.withColumn("provider", F.lit("openweathermap")))
    return merge.merge_weather(mapping, nws, om, owm, collected_at, mode), rejected


def store_weather(weather: DataFrame, root: str) -> None:
    """Append by service day of the collection time."""
    write_dataset(
        weather.withColumn("collected", F.timestamp_seconds("collection_timestamp")),
        root, "collected")
