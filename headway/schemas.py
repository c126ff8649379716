"""Table schemas: one source of truth for readers, writers and the registry."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DataType, DoubleType, IntegerType, LongType, MapType, StringType,
    StructField, StructType, TimestampType,
)

_TYPES = {"string": StringType(), "double": DoubleType(), "bigint": LongType(),
          "int": IntegerType(), "boolean": BooleanType(), "timestamp": TimestampType()}


def table(columns: str, **nested: DataType) -> StructType:
    """``"name type, …"`` (plus nested columns) to a schema, without a session."""
    pairs = [column.split() for column in columns.split(",")]
    simple = [StructField(name, _TYPES[kind]) for name, kind in pairs]
    return StructType(simple + [StructField(n, t) for n, t in nested.items()])


# Column names and types of the stored datasets.
TRAIN_POSITIONS = table("""
    poll_timestamp timestamp, api_timestamp string, route string, train_id string,
    lat double, lon double, heading bigint,
    next_station_id string, next_station_name string,
    destination_id string, destination_name string,
    prediction_time string, predicted_arrival_time string,
    is_approaching boolean, is_delayed boolean
""")

WEATHER = table("""
    station_id string, nws_grid_id string, open_meteo_grid_id string,
    latitude double, longitude double, collection_timestamp double,
    start_time string, end_time string, temperature_f double, prob_precip_pct double,
    dewpoint_f double, humidity_pct double, wind_speed_mph double,
    wind_direction string, forecast_desc string,
    timestamp string, visibility_mi double, snow_depth_in double,
    surface_pressure_hpa double, wind_gusts_mph double, apparent_temp_f double,
    rain_in double, showers_in double, snowfall_in double
""")

# Columns only the fallback provider delivers; absent from the weather table.
FALLBACK_ONLY = table("""
    feels_like_f double, temp_min_f double, temp_max_f double, pressure_hpa double,
    wind_direction_deg bigint, wind_gust_mph double, cloud_cover_pct bigint,
    weather_main string, weather_desc string
""")

STATIONS = table(
    "id string, name string, address string, lines string, latitude double, longitude double")

WEATHER_PAYLOAD = table("grid_id string, payload string, collected_at double, provider string")

TELEMETRY_EVENT = table("""
    ts double, kind string, daemon_class string, diag_run_id string, name string,
    ok boolean, elapsed_ms double, error_type string, error_message string,
    http_status int, http_url string, http_method string, cycle_id string
""")

WINDOW_METRICS = table(
    "overall_success_rate double, total_calls bigint",
    per_span_metrics=MapType(StringType(), table("""
        success_rate double, error_rate double, total_calls bigint,
        p50_ms double, p95_ms double, p99_ms double""")))
METRICS_SNAPSHOT = table(
    "ts double, daemon_class string, diag_run_id string",
    metrics=StructType([
        StructField("time_window_metrics", StructType([
            StructField("last_hour", WINDOW_METRICS), StructField("last_24h", WINDOW_METRICS)])),
        StructField("overall_health", DoubleType())]))

COLLECTOR_STATE = table("""
    last_poll_timestamp double, last_collection_timestamp double,
    total_records_collected bigint
""")

HEARTBEAT = table("timestamp string, daemon string, pid bigint")

COMPACTION_RUN = table("""
    date string, daemon string, status string,
    journals_found bigint, journals_repaired bigint, journals_skipped bigint,
    rows_written bigint, upload_bytes bigint, elapsed_seconds double, error string
""")

SCHEMA_FIELDS = table("name string, type string, nullable boolean")

DATASETS = {"train_positions": TRAIN_POSITIONS, "weather": WEATHER}
