"""Weather payloads (parts as grids) and station weather (customers as stations)."""

from __future__ import annotations

from pyspark.sql import functions as F

from headway.functions import epoch_seconds, float_text
from headway.operators import forecasts, merge
from headway.operators.mapping import expired, fresh, latest_mapping
from workload.payloads import arr, num, obj, txt
from workload.tables import newest, table

C = F.col


def _raw(spark, sf_dir, payload):
    return table(spark, sf_dir, "part").select(
        C("p_partkey").cast("string").alias("grid_id"), payload.alias("payload"),
        F.lit(0.0).alias("collected_at"))


def _nws_payload():
    size, price = C("p_size"), C("p_retailprice")
    unit = F.when(size % 2 == 0, txt("wmoUnit:degC")).otherwise(txt("F"))
    period = obj(
        startTime=txt("s"), endTime=F.when(size > 10, txt("e")),
        temperature=F.when(size == 7, txt("7")).otherwise(num(size)), temperatureUnit=unit,
        probabilityOfPrecipitation=F.when(size < 40, obj(value=F.when(
            size < 20, num(size * 2)).otherwise(F.lit("null")))),
        dewpoint=F.when(size != 9, obj(value=num(price / 100), unitCode=unit)),
        relativeHumidity=obj(value=txt(size)),
        windSpeed=F.when(size % 3 == 0, txt(F.concat(size, F.lit(" to 40 mph")))).when(
            size % 3 == 1, txt("calm")),
        windDirection=txt("NW"), shortForecast=txt(C("p_type")))
    periods = F.when(size == 11, F.lit("[]")).otherwise(arr(period, F.lit("5")))
    return F.when(size == 13, F.lit('{"properties":3}')).otherwise(
        obj(properties=obj(periods=periods)))


def nws_hourly(spark, sf_dir):
    return forecasts.nws_hourly(_raw(spark, sf_dir, _nws_payload()))[0].drop("collected_at")


def rejected_forecasts(spark, sf_dir):
    bad = forecasts.nws_hourly(_raw(spark, sf_dir, _nws_payload()))[1]
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("rejected"))


def open_meteo_current(spark, sf_dir):
    size, price = C("p_size"), C("p_retailprice")
    current = obj(
        time=F.when(size != 5, txt("2026-01-01T00:00")),
        visibility=F.when(size % 4 == 0, txt(price)).otherwise(num(price)),
        snow_depth=F.when(size > 25, num(size / 4)), surface_pressure=txt(size),
        wind_gusts_10m=F.lit("null"), apparent_temperature=num(price / 7), rain=F.lit("0"),
        snowfall=num(size * -1))
    payload = obj(latitude=F.when(size == 6, txt("41")).otherwise(num(price / 50)),
                  longitude=num(size * -1.25), current=current)
    return forecasts.open_meteo_current(_raw(spark, sf_dir, payload))[0].drop("collected_at")


def _owm_body():
    size, price = C("p_size"), C("p_retailprice")
    return dict(
        main=F.when(size != 4, obj(temp=num(price / 30), feels_like=txt(size), pressure=num(size),
                                   humidity=F.when(size % 2 == 0, num(size + 0.75)).otherwise(txt(size)))),
        wind=obj(speed=num(size), deg=num(size * 7), gust=F.when(size > 30, num(price / 90))),
        weather=F.when(size == 8, F.lit("[]")).otherwise(
            arr(obj(main=txt(C("p_type")), description=txt("")))),
        visibility=F.when(size > 3, num(price * 10)),
        clouds=F.when(size % 5 != 0, obj(all=num(size))))


def owm_current(spark, sf_dir):
    size = C("p_size")
    payload = obj(coord=obj(lat=num(size), lon=num(size * -0.5)),
                  dt=F.when(size == 10, txt("soon")).when(size != 12, num(size * 1000)), **_owm_body())
    return forecasts.owm_current(_raw(spark, sf_dir, payload))[0].drop("collected_at")


def owm_forecast(spark, sf_dir):
    size = C("p_size")
    entry = obj(dt=num(size * 1000), dt_txt=F.when(size > 20, txt("noon")).otherwise(txt("")),
                pop=num(size / 64), **_owm_body())
    payload = obj(list=arr(entry, F.lit("{}")), city=obj(coord=F.when(
        size != 15, obj(lat=num(size), lon=num(size * -0.5)))))
    return forecasts.owm_forecast(_raw(spark, sf_dir, payload))[0].drop("collected_at")


def owm_grid(spark, sf_dir):
    size = C("p_size")
    payload = obj(coord=obj(lat=num(size / 4), lon=F.when(size == 3, txt("1")).otherwise(num(size * -1))))
    return table(spark, sf_dir, "part").select(
        "p_partkey", forecasts.owm_grid_id(payload).alias("grid_id"))


def _mapping(spark, sf_dir):
    """NWS grid = nation (none for nation 24); Open-Meteo id unknown for odd nations."""
    people = table(spark, sf_dir, "customer").withColumn("station_id", C("c_custkey").cast("string"))
    stations = people.select(
        C("station_id").alias("id"), (C("c_nationkey") / 4).alias("latitude"),
        (C("c_nationkey") * -2.5).alias("longitude"))
    nws_map = people.filter("c_nationkey <> 24").select(
        "station_id", F.concat(F.lit("N/"), C("c_nationkey")).alias("grid_id"))
    om_map = people.filter("c_nationkey % 3 <> 0").select(
        "station_id", F.when(C("c_nationkey") % 2 == 0, F.concat(F.lit("om"), C("c_nationkey")))
        .otherwise("").alias("grid_id"))
    return merge.station_grids(stations, nws_map, om_map)


def _sources(spark, sf_dir):
    """NWS from suppliers (nations below 20), Open-Meteo from customers (nations not
    divisible by 5), fallback from nations (divisible by 2)."""
    om_key = merge.effective_grid(
        F.when(C("k") % 3 != 0, F.when(C("k") % 2 == 0, F.concat(F.lit("om"), C("k")))),
        C("k") / 4, C("k") * -2.5)
    nws = table(spark, sf_dir, "supplier").filter("s_nationkey < 20").groupBy("s_nationkey").agg(
        F.max("s_acctbal").alias("temperature_f"),
        F.when(F.min("s_nationkey") % 4 != 0, F.min("s_acctbal")).alias("wind_speed_mph"),
        F.lit("NE").alias("wind_direction"))
    nws = nws.select(F.concat(F.lit("N/"), C("s_nationkey")).alias("grid_id"), "temperature_f",
                     "wind_speed_mph", "wind_direction")
    om = table(spark, sf_dir, "customer").filter("c_nationkey % 5 <> 0").groupBy(
        C("c_nationkey").alias("k")).agg(
        F.max("c_acctbal").alias("visibility_mi"), F.min("c_acctbal").alias("rain_in"))
    om = om.select(om_key.alias("grid_id"), "visibility_mi", "rain_in",
                   F.lit("t").alias("timestamp"))
    owm = table(spark, sf_dir, "nation").filter("n_nationkey % 2 = 0").withColumn("k", C("n_nationkey"))
    owm = owm.select(om_key.alias("grid_id"), (C("k") * 1.5).alias("temperature_f"),
                     (C("k") * 2.5).alias("wind_speed_mph"), (C("k") * 3.5).alias("visibility_mi"),
                     C("n_name").alias("weather_desc"), (C("k") * 100).cast("bigint").alias("timestamp"))
    return nws, om, owm


MERGED = ("station_id", "nws_grid_id", "open_meteo_grid_id", "latitude", "longitude",
          "collection_timestamp", "temperature_f", "wind_speed_mph", "wind_direction",
          "visibility_mi", "rain_in", "timestamp", "weather_desc")


def merge_precedence(spark, sf_dir):
    merged = merge.merge_weather(_mapping(spark, sf_dir), *_sources(spark, sf_dir), F.lit(1.5))
    return merged.select(*MERGED)


def merge_coalesce(spark, sf_dir):
    merged = merge.merge_weather(
        _mapping(spark, sf_dir), *_sources(spark, sf_dir), F.lit(1.5), mode="coalesce")
    return merged.select(*MERGED)


def fallback_grids(spark, sf_dir):
    nws, om, _ = _sources(spark, sf_dir)
    return merge.fallback_grids(_mapping(spark, sf_dir), nws, om)


def grid_dedup(spark, sf_dir):
    return merge.grid_usage(_mapping(spark, sf_dir), "om_key")


def _changes(spark, sf_dir):
    """Learned mapping per customer: each order is a change, urgent ones delete."""
    return table(spark, sf_dir, "orders").select(
        C("o_custkey").alias("station_id"),
        float_text(C("o_totalprice")).alias("grid_id"),
        epoch_seconds(C("o_orderdate").cast("timestamp")).alias("updated_at"), "o_orderkey",
        (C("o_orderpriority") == "1-URGENT").alias("deleted"))


def latest(spark, sf_dir):
    return latest_mapping(_changes(spark, sf_dir), ["station_id"], ["updated_at", "o_orderkey"])


def _now(spark, sf_dir):
    return newest(table(spark, sf_dir, "orders").withColumn(
        "ts", C("o_orderdate").cast("timestamp")))


def fresh_mapping(spark, sf_dir):
    return fresh(latest(spark, sf_dir), 90 * 86400, _now(spark, sf_dir))


def expired_mapping(spark, sf_dir):
    return expired(latest(spark, sf_dir), 90 * 86400, _now(spark, sf_dir)).select("station_id")


QUERIES = {
    "nws_hourly": nws_hourly,
    "rejected_forecasts": rejected_forecasts,
    "open_meteo_current": open_meteo_current,
    "owm_current": owm_current,
    "owm_forecast": owm_forecast,
    "owm_grid": owm_grid,
    "merge_precedence": merge_precedence,
    "merge_coalesce": merge_coalesce,
    "fallback_grids": fallback_grids,
    "grid_dedup": grid_dedup,
    "latest_mapping": latest,
    "fresh_mapping": fresh_mapping,
    "expired_mapping": expired_mapping,
}

_OM_KEY = """CASE WHEN {k} % 3 <> 0 AND {k} % 2 = 0 THEN 'om' || {k}
    ELSE ({k} / 4)::VARCHAR || ',' || ({k} * -2.5::DOUBLE)::VARCHAR END"""
_OM_KEY_STATION = _OM_KEY.format(k="c_nationkey")
_STATIONS = f"""stations AS (SELECT c_custkey::VARCHAR AS station_id, c_nationkey AS k,
        'N/' || c_nationkey AS nws_grid_id, {_OM_KEY_STATION} AS om_key,
        c_nationkey / 4 AS latitude, c_nationkey * -2.5::DOUBLE AS longitude
        FROM customer WHERE c_nationkey <> 24)"""
_MERGE = f"""{_STATIONS},
    nws AS (SELECT s_nationkey AS k, max(s_acctbal) AS t,
        CASE WHEN s_nationkey % 4 <> 0 THEN min(s_acctbal) END AS w
        FROM supplier WHERE s_nationkey < 20 GROUP BY 1),
    om AS (SELECT c_nationkey AS k, max(c_acctbal) AS vis, min(c_acctbal) AS rain
        FROM customer WHERE c_nationkey % 5 <> 0 GROUP BY 1),
    owm AS (SELECT n_nationkey AS k, n_name FROM nation WHERE n_nationkey % 2 = 0),
    joined AS (SELECT s.*, n.k IS NOT NULL AS a, o.k IS NOT NULL AS b, f.k IS NOT NULL AS c,
        n.t, n.w, o.vis, o.rain, f.n_name FROM stations s LEFT JOIN nws n ON n.k = s.k
        LEFT JOIN om o ON o.k = s.k LEFT JOIN owm f ON f.k = s.k)"""
_MERGED = """SELECT station_id, nws_grid_id, om_key AS open_meteo_grid_id, latitude, longitude,
    1.5::DOUBLE AS collection_timestamp, {t} AS temperature_f, {w} AS wind_speed_mph,
    CASE WHEN a THEN 'NE' END AS wind_direction, {v} AS visibility_mi,
    CASE WHEN b THEN rain END AS rain_in,
    CASE WHEN b THEN 't' WHEN c THEN (k * 100)::VARCHAR END AS timestamp,
    CASE WHEN c THEN n_name END AS weather_desc FROM joined WHERE a OR b OR c"""
_FALL = "CASE WHEN c THEN k * {f}::DOUBLE END"
_LATEST = """latest AS (SELECT o_custkey AS station_id, o_totalprice::VARCHAR AS grid_id,
        epoch_us(o_orderdate) / 1e6 AS updated_at, o_orderkey FROM (SELECT *, row_number() OVER (
            PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
        WHERE rn = 1 AND o_orderpriority <> '1-URGENT')"""
_LIMIT = "(SELECT epoch_us(max(o_orderdate)) / 1e6 FROM orders) - updated_at"
_OWM = """p_retailprice / 30 AS temperature_f, p_size::DOUBLE AS feels_like_f,
    NULL::DOUBLE AS temp_min_f, NULL::DOUBLE AS temp_max_f, p_size::DOUBLE AS pressure_hpa,
    p_size::BIGINT AS humidity_pct,
    CASE WHEN p_size > 3 THEN p_retailprice * 10 / 1609.34::DOUBLE END AS visibility_mi,
    p_size::DOUBLE AS wind_speed_mph, (p_size * 7)::BIGINT AS wind_direction_deg,
    CASE WHEN p_size > 30 THEN p_retailprice / 90 END AS wind_gust_mph,
    CASE WHEN p_size % 5 <> 0 THEN p_size::BIGINT END AS cloud_cover_pct,
    p_type AS weather_main, NULL::VARCHAR AS weather_desc,
    p_partkey::VARCHAR AS grid_id, p_size::DOUBLE AS latitude, p_size * -0.5::DOUBLE AS longitude"""

ORACLE = {
    "nws_hourly": """WITH f AS (SELECT *, p_size % 2 = 0 AS c, p_retailprice / 100 AS dew FROM part)
        SELECT p_partkey::VARCHAR AS grid_id, 's' AS start_time,
        CASE WHEN p_size > 10 THEN 'e' END AS end_time,
        CASE WHEN c THEN p_size::DOUBLE * 9 / 5 + 32 ELSE p_size::DOUBLE END AS temperature_f,
        CASE WHEN p_size < 20 THEN (p_size * 2)::DOUBLE END AS prob_precip_pct,
        CASE WHEN c THEN dew * 9 / 5 + 32 ELSE dew END AS dewpoint_f,
        p_size::DOUBLE AS humidity_pct,
        CASE WHEN p_size % 3 = 0 THEN p_size::DOUBLE END AS wind_speed_mph,
        'NW' AS wind_direction, p_type AS forecast_desc
        FROM f WHERE p_size NOT IN (7, 9, 11, 13)""",
    "rejected_forecasts": """SELECT CASE p_size WHEN 7 THEN '''temperature'' is not numeric'
        WHEN 9 THEN '''dewpoint.value'' is not numeric' WHEN 11 THEN '''periods'' is missing or empty'
        ELSE '''properties'' is missing or not an object' END AS reason, count(*) AS rejected
        FROM part WHERE p_size IN (7, 9, 11, 13) GROUP BY 1""",
    "open_meteo_current": """SELECT p_partkey::VARCHAR AS grid_id, p_retailprice / 50 AS latitude,
        p_size * -1.25::DOUBLE AS longitude, '2026-01-01T00:00' AS timestamp,
        CASE WHEN p_size % 4 <> 0 THEN p_retailprice / 5280.0::DOUBLE END AS visibility_mi,
        CASE WHEN p_size > 25 THEN p_size / 4 END AS snow_depth_in,
        p_size::DOUBLE AS surface_pressure_hpa, NULL::DOUBLE AS wind_gusts_mph,
        p_retailprice / 7 AS apparent_temp_f, 0.0::DOUBLE AS rain_in, NULL::DOUBLE AS showers_in,
        -p_size::DOUBLE AS snowfall_in FROM part WHERE p_size NOT IN (5, 6)""",
    "owm_current": f"""SELECT {_OWM}, CASE WHEN p_size <> 10 THEN (p_size * 1000)::BIGINT END
        AS timestamp FROM part WHERE p_size NOT IN (4, 8, 12)""",
    "owm_forecast": f"""SELECT {_OWM}, (p_size * 1000)::BIGINT AS timestamp,
        CASE WHEN p_size > 20 THEN 'noon' END AS dt_txt,
        p_size / 64 * 100 AS prob_precip_pct FROM part WHERE p_size NOT IN (4, 8, 15)""",
    "owm_grid": """SELECT p_partkey, CASE WHEN p_size <> 3 THEN CASE WHEN p_size % 4 = 0
        THEN (p_size // 4) || '.0' ELSE (p_size / 4)::VARCHAR END || ',-' || p_size || '.0' END
        AS grid_id FROM part""",
    "merge_precedence": f"WITH {_MERGE} " + _MERGED.format(
        t=f"CASE WHEN a THEN t ELSE {_FALL.format(f=1.5)} END",
        w=f"CASE WHEN a THEN w ELSE {_FALL.format(f=2.5)} END",
        v=f"CASE WHEN b THEN vis ELSE {_FALL.format(f=3.5)} END"),
    "merge_coalesce": f"WITH {_MERGE} " + _MERGED.format(
        t=f"coalesce(t, {_FALL.format(f=1.5)})", w=f"coalesce(w, {_FALL.format(f=2.5)})",
        v=f"coalesce(vis, {_FALL.format(f=3.5)})"),
    "fallback_grids": f"""WITH {_STATIONS} SELECT DISTINCT om_key FROM stations s WHERE
        NOT EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = s.k AND s_nationkey < 20)
        OR NOT EXISTS (SELECT 1 FROM customer WHERE c_nationkey = s.k AND c_nationkey % 5 <> 0)""",
    "grid_dedup": f"""WITH {_STATIONS} SELECT om_key, count(*) AS stations,
        count(*) FILTER (k % 3 = 0 OR k % 2 = 1) AS cache_misses FROM stations GROUP BY 1""",
    "latest_mapping": f"WITH {_LATEST} SELECT * FROM latest",
    "fresh_mapping": f"WITH {_LATEST} SELECT * FROM latest WHERE {_LIMIT} <= 7776000",
    "expired_mapping": f"WITH {_LATEST} SELECT station_id FROM latest WHERE {_LIMIT} > 7776000",
}
