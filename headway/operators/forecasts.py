"""Weather payloads of the three providers to flat readings per grid.

Input rows are ``grid_id, payload, collected_at``; each function returns
``(good, rejected)`` and keeps ``grid_id`` and ``collected_at``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from headway.functions import payload as p
from headway.functions.geo import float_text
from headway.functions.numeric import (
    c_to_f, feet_to_miles, fraction_to_pct, meters_to_miles,
)
from headway.functions.text import leading_number, text_or_null

_CELSIUS = "wmoUnit:degC"


def _split(raw: DataFrame, problem: Column, fields: dict[str, Column],
           root: str | None = None) -> tuple[DataFrame, DataFrame]:
    keep = ["grid_id", "collected_at", "payload"]
    parsed = p.with_document(raw.select(*keep), "__v", p.parse(F.col("payload")))
    if root is not None:
        first = F.get(p.elements(p.at(F.col("__v"), root)), F.lit(0))
        parsed = p.with_document(parsed, "__p", first)
    checked = p.extract(parsed, keep, reason=problem, **fields)
    good = checked.filter(F.col("reason").isNull()).select("grid_id", "collected_at", *fields)
    return good, checked.filter(F.col("reason").isNotNull()).select("grid_id", "payload", "reason")


def _unreadable(value: Column, *paths: str) -> list[tuple[Column, str]]:
    """Optional numbers may be absent, or numbers, or numeric text."""
    return [(~p.is_absent(p.at(value, path)) & p.number_or_text(value, path).isNull(),
             f"'{path}' is not numeric") for path in paths]


def nws_hourly(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First period of an hourly forecast; temperature and dew point are required."""
    v, period = F.col("__v"), F.col("__p")

    def fahrenheit(path: str, unit: str) -> Column:
        degrees = p.number(period, path)
        return F.when(p.text(period, unit) == _CELSIUS, c_to_f(degrees)).otherwise(degrees)

    problem = p.first_problem(
        (v.isNull(), "payload is not JSON"),
        (~p.is_object(p.at(v, "properties")), "'properties' is missing or not an object"),
        (F.coalesce(F.size(p.elements(p.at(v, "properties.periods"))), F.lit(0)) < 1,
         "'periods' is missing or empty"),
        (~p.is_object(period), "period is not an object"),
        (p.number(period, "temperature").isNull(), "'temperature' is not numeric"),
        (p.number(period, "dewpoint.value").isNull(), "'dewpoint.value' is not numeric"),
        *_unreadable(period, "probabilityOfPrecipitation.value", "relativeHumidity.value"),
    )
    return _split(raw, problem, {
        "start_time": p.text(period, "startTime"),
        "end_time": p.text(period, "endTime"),
        "temperature_f": fahrenheit("temperature", "temperatureUnit"),
        "prob_precip_pct": p.number_or_text(period, "probabilityOfPrecipitation.value"),
        "dewpoint_f": fahrenheit("dewpoint.value", "dewpoint.unitCode"),
        "humidity_pct": p.number_or_text(period, "relativeHumidity.value"),
        "wind_speed_mph": leading_number(p.text(period, "windSpeed")),
        "wind_direction": p.text(period, "windDirection"),
        "forecast_desc": p.text(period, "shortForecast"),
    }, root="properties.periods")


def open_meteo_current(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Supplementary current conditions; visibility comes in feet."""
    v = F.col("__v")
    plain = {
        "snow_depth_in": "current.snow_depth",
        "surface_pressure_hpa": "current.surface_pressure",
        "wind_gusts_mph": "current.wind_gusts_10m",
        "apparent_temp_f": "current.apparent_temperature",
        "rain_in": "current.rain",
        "showers_in": "current.showers",
        "snowfall_in": "current.snowfall",
    }
    problem = p.first_problem(
        (v.isNull(), "payload is not JSON"),
        (~p.is_object(p.at(v, "current")), "'current' is missing or not an object"),
        (p.number(v, "latitude").isNull() | p.number(v, "longitude").isNull(),
         "coordinates are not numeric"),
        (p.is_absent(p.at(v, "current.time")), "missing 'current.time'"),
        *_unreadable(v, *plain.values()),
    )
    return _split(raw, problem, {
        "latitude": p.number(v, "latitude"),
        "longitude": p.number(v, "longitude"),
        "timestamp": p.text(v, "current.time"),
        "visibility_mi": feet_to_miles(p.number(v, "current.visibility")),
        **{name: p.number_or_text(v, path) for name, path in plain.items()},
    })


def _owm_fields(body: Column) -> dict[str, Column]:
    """Fields shared by current conditions and forecast entries."""
    sky = F.get(p.elements(p.at(body, "weather")), F.lit(0))
    return {
        "temperature_f": p.number_or_text(body, "main.temp"),
        "feels_like_f": p.number_or_text(body, "main.feels_like"),
        "temp_min_f": p.number_or_text(body, "main.temp_min"),
        "temp_max_f": p.number_or_text(body, "main.temp_max"),
        "pressure_hpa": p.number_or_text(body, "main.pressure"),
        "humidity_pct": p.whole(body, "main.humidity"),
        "visibility_mi": meters_to_miles(p.number(body, "visibility")),
        "wind_speed_mph": p.number_or_text(body, "wind.speed"),
        "wind_direction_deg": p.whole(body, "wind.deg"),
        "wind_gust_mph": p.number_or_text(body, "wind.gust"),
        "cloud_cover_pct": p.whole(body, "clouds.all"),
        "weather_main": text_or_null(p.text(sky, "main")),
        "weather_desc": text_or_null(p.text(sky, "description")),
    }


def _owm_body_problems(body: Column) -> list[tuple[Column, str]]:
    sky = p.elements(p.at(body, "weather"))
    return [
        (~p.is_object(p.at(body, "main")), "'main' is missing or not an object"),
        (~p.is_object(p.at(body, "wind")), "'wind' is missing or not an object"),
        (F.coalesce(F.size(sky), F.lit(0)) < 1, "'weather' is missing or empty"),
        (~p.is_object(F.get(sky, F.lit(0))), "'weather[0]' is not an object"),
        *_unreadable(body, "main.temp", "main.feels_like", "main.temp_min", "main.temp_max",
                     "main.pressure", "main.humidity", "wind.speed", "wind.deg", "wind.gust",
                     "clouds.all"),
    ]


def _no_coordinates(body: Column, path: str) -> tuple[Column, str]:
    lat, lon = (p.number(body, f"{path}.{c}") for c in ("lat", "lon"))
    return lat.isNull() | lon.isNull(), f"'{path}' has no numeric coordinates"


def owm_current(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fallback provider, current conditions; visibility comes in metres."""
    v = F.col("__v")
    problem = p.first_problem(
        (v.isNull(), "payload is not JSON"),
        *_owm_body_problems(v),
        _no_coordinates(v, "coord"),
        (p.is_absent(p.at(v, "dt")), "missing 'dt'"),
    )
    return _split(raw, problem, {
        "latitude": p.number(v, "coord.lat"),
        "longitude": p.number(v, "coord.lon"),
        "timestamp": p.number(v, "dt").cast("bigint"),
        **_owm_fields(v),
    })


def owm_forecast(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fallback provider, first forecast entry; coordinates are the city's."""
    v, entry = F.col("__v"), F.col("__p")
    problem = p.first_problem(
        (v.isNull(), "payload is not JSON"),
        (F.coalesce(F.size(p.elements(p.at(v, "list"))), F.lit(0)) < 1,
         "'list' is missing or empty"),
        (~p.is_object(entry), "'list[0]' is not an object"),
        *_owm_body_problems(entry),
        (~p.is_object(p.at(v, "city")), "'city' is missing or not an object"),
        _no_coordinates(v, "city.coord"),
        (~p.is_absent(p.at(entry, "dt")) & p.whole(entry, "dt").isNull(), "'dt' is not numeric"),
    )
    return _split(raw, problem, {
        "latitude": p.number(v, "city.coord.lat"),
        "longitude": p.number(v, "city.coord.lon"),
        "timestamp": p.whole(entry, "dt"),
        "dt_txt": text_or_null(p.text(entry, "dt_txt")),
        **_owm_fields(entry),
        "prob_precip_pct": fraction_to_pct(p.number(entry, "pop")),
    }, root="list")


def owm_grid_id(payload: Column) -> Column:
    """``"lat,lon"`` of the returned coordinates; NULL when they are not numeric."""
    doc = p.parse(payload)
    lat, lon = p.number(doc, "coord.lat"), p.number(doc, "coord.lon")
    return F.when(lat.isNotNull() & lon.isNotNull(),
                  F.concat(float_text(lat), F.lit(","), float_text(lon)))
