"""Normalisers on the shapes that matter: presence, types and object-or-list."""

import datetime as dt
import hashlib
import json

import pytest

from headway.operators import forecasts, merge, network, trains
from pyspark.sql import functions as F

AT = dt.datetime(2026, 2, 17, 12, tzinfo=dt.UTC)
TRAIN = {"rn": "101", "lat": "41.9", "lon": "-87.6", "heading": "89", "isApp": "1", "isDly": "0",
         "nextStaId": "40", "nextStaNm": "N", "destSt": "3", "destNm": "D", "prdt": "p", "arrT": "a"}


def body(train, **extra):
    route = {"@name": "red"} if train is ... else {"@name": "red", "train": train}
    return {"ctatt": {"tmst": "t", "errCd": "0", "route": [route], **extra}}


def run(spark, *docs, **kwargs):
    rows = [(d if isinstance(d, str) else json.dumps(d), AT) for d in docs]
    raw = spark.createDataFrame(rows, "payload string, poll_timestamp timestamp")
    good, bad = trains.train_positions(raw, **kwargs)
    return good.collect(), [r.reason for r in bad.collect()]


def test_single_object_and_list(spark):
    good, bad = run(spark, body(TRAIN), body([TRAIN, {**TRAIN, "rn": "102"}]), body([]), body(...))
    assert sorted(r.train_id for r in good) == ["101", "101", "102"] and bad == []
    row = good[0]
    assert (row.lat, row.lon, row.heading, row.is_approaching, row.is_delayed) == (41.9, -87.6, 89, True, False)
    assert row.api_timestamp == "t" and row.route == "red" and row.poll_timestamp is not None


@pytest.mark.parametrize("change, reason", [
    ({"lat": "north"}, "invalid coordinates"), ({"lat": None}, "invalid coordinates"),
    ({"lon": "181"}, "invalid coordinates"), ({"isApp": "not-a-number"}, "invalid isApp flag"),
    ({"isDly": None}, "invalid isDly flag"), ({"heading": "west"}, "invalid heading"),
])
def test_bad_trains_are_set_aside(spark, change, reason):
    good, bad = run(spark, body([TRAIN, {**TRAIN, **change}]))
    assert len(good) == 1 and bad == [reason]
    good, bad = run(spark, body([TRAIN, {**TRAIN, **change}]), strict_poll=True)
    assert good == [] and len(bad) == 2


def test_missing_parts(spark):
    flagless = {k: v for k, v in TRAIN.items() if k not in ("isApp", "isDly", "heading")}
    good, bad = run(spark, {}, {"ctatt": {}}, {"ctatt": {"route": []}}, body(flagless))
    assert bad == [] and [(r.is_approaching, r.heading) for r in good] == [(False, None)]
    _, bad = run(spark, "nope", "[1]", {"ctatt": {"errCd": "102"}}, {"ctatt": {"errCd": 500}}, body(None),
                 {"ctatt": None}, {"ctatt": {"route": {"@name": "x"}}})
    assert sorted(bad) == sorted([
        "payload is not JSON", "payload is not an object", "API error", "API error",
        "train is not an object", "ctatt is not an object", "route is not a list"])


def test_api_errors(spark):
    raw = spark.createDataFrame(
        [(json.dumps({"ctatt": {"errCd": c, "errNm": "why"}}), AT) for c in ("0", "102", None)],
        "payload string, poll_timestamp timestamp")
    assert [(r.err_cd, r.err_nm) for r in trains.api_errors(raw).collect()] == [("102", "why")]


def payloads(spark, *docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "payload string")


def test_stations(spark):
    point = lambda *xy: {"type": "Point", "coordinates": list(xy)}
    good, bad = network.stations(payloads(
        spark, {"station_id": "900", "longname": "L", "the_geom": point(-87.6, 41.8)},
        {"station_id": "1", "the_geom": None}, {"station_id": "2", "the_geom": point(1)},
        {"station_id": "3", "the_geom": {"coordinates": "x"}}, {"station_id": "4", "the_geom": point("e", 1)}))
    row = good.first()
    assert tuple(row) == ("900", "L", "", "", 41.8, -87.6)
    assert bad.count() == 4
    listed = network.station_rows(payloads(spark, [{"station_id": "1"}, {"station_id": "2"}]))
    assert [json.loads(r.payload)["station_id"] for r in listed.collect()] == ["1", "2"]


def test_track_geometry_and_id(spark):
    geometry = {"type": "MultiLineString", "coordinates": [
        [], "x", [["a", 1], [-87.6, 41.8, 9], [3]], [[-87.5, 41.9], [-87.7, 41.7]]]}
    good, bad = network.track_segments(payloads(
        spark, {"lines": " Red ,, Blue", "description": " A to B to C ", "type": "Subway", "legend": "",
                "shape_len": "12.5", "the_geom": geometry},
        {"the_geom": {"type": "LineString", "coordinates": [[[1, 2]]]}},
        {"the_geom": {"type": "MultiLineString", "coordinates": [[["1", "2"]]]}},
        {"the_geom": {"type": "MultiLineString", "coordinates": [[[-200, 2]]]}}))
    row = good.first()
    assert row.lines == ["Red", "Blue"] and (row.endpoint_a, row.endpoint_b) == ("A", "B to C")
    assert row.geometry.coordinates == [[[-87.6, 41.8]], [[-87.5, 41.9], [-87.7, 41.7]]]
    assert tuple(row.bbox) == (-87.7, 41.7, -87.5, 41.9) and row.legend is None
    assert (row.start_lon, row.start_lat, row.end_lon, row.end_lat) == (-87.6, 41.8, -87.7, 41.7)
    text = "Red,Blue|A to B to C|Subway||12.500000|-87.600000,41.800000|-87.700000,41.700000"
    assert row.segment_id == hashlib.blake2s(text.encode(), digest_size=8).hexdigest()
    assert sorted(r.reason for r in bad.collect()) == [
        "coordinates out of range", "no usable geometry", "no usable geometry"]


@pytest.mark.parametrize("text, ends", [
    ("Tower 12 to Library", ("Tower 12", "Library")), ("NoDelimiterHere", ("NoDelimiterHere",) * 2),
    ("  ", ("", "")), ("A to ", ("A to", "A to")), (" to B", ("to B", "to B"))])
def test_description_ends(spark, text, ends):
    row = spark.createDataFrame([(text,)], "d string").select(
        network.description_ends(F.col("d")).alias("e")).first()
    assert tuple(row.e) == ends


def readings(spark, *docs):
    return spark.createDataFrame([("g", json.dumps(d), 1.0) for d in docs],
                                 "grid_id string, payload string, collected_at double")


PERIOD = {"temperature": 0, "temperatureUnit": "wmoUnit:degC", "dewpoint": {"value": 50, "unitCode": "F"},
          "windSpeed": "5 to 10 mph", "probabilityOfPrecipitation": {"value": None}}


def test_nws(spark):
    doc = lambda p: {"properties": {"periods": [p]}}
    good, bad = forecasts.nws_hourly(readings(
        spark, doc(PERIOD), doc({**PERIOD, "temperature": "0"}), doc({**PERIOD, "dewpoint": None}),
        {"properties": {"periods": []}}, {"properties": 1}, {}, doc(3)))
    row = good.first()
    assert (row.temperature_f, row.dewpoint_f, row.wind_speed_mph, row.prob_precip_pct) == (32.0, 50.0, 5.0, None)
    assert good.count() == 1 and bad.count() == 6


def test_open_meteo_and_owm(spark):
    good, bad = forecasts.open_meteo_current(readings(
        spark, {"latitude": 41.8, "longitude": -87, "current": {"time": "t", "visibility": 10560}},
        {"latitude": 41.8, "longitude": -87, "current": {}},
        {"latitude": "41.8", "longitude": -87, "current": {"time": "t"}}))
    assert good.first().visibility_mi == 2.0 and good.first().rain_in is None and bad.count() == 2
    base = {"coord": {"lat": 41.8, "lon": -87.6}, "dt": 5, "main": {"temp": 70, "humidity": 55}, "wind": {},
            "weather": [{"main": "Rain", "description": ""}], "visibility": 1609.34, "clouds": {"all": 7}}
    good, bad = forecasts.owm_current(readings(
        spark, base, {**base, "weather": []}, {k: v for k, v in base.items() if k != "dt"}, {**base, "wind": 3}))
    row = good.first()
    assert (row.visibility_mi, row.humidity_pct, row.cloud_cover_pct, row.weather_desc) == (1.0, 55, 7, None)
    assert bad.count() == 3
    good, _ = forecasts.owm_forecast(readings(
        spark, {"list": [{**base, "pop": 0.25, "dt_txt": "x"}, {}], "city": {"coord": {"lat": 1, "lon": 2}}}))
    assert (good.first().prob_precip_pct, good.first().latitude) == (25.0, 1.0)


def test_merge_precedence_by_presence(spark):
    stations = spark.createDataFrame([("s1", 41.0, -87.0), ("s2", 41.0, -87.0), ("s3", 1.0, 1.0), ("s4", 0.0, 0.0)],
                                     "id string, latitude double, longitude double")
    nws_map = spark.createDataFrame([("s1", "LOT/1,2"), ("s2", "LOT/9,9"), ("s3", "LOT/8,8")],
                                    "station_id string, grid_id string")
    om_map = spark.createDataFrame([("s2", ""), ("s3", "om3")], "station_id string, grid_id string")
    mapping = merge.station_grids(stations, nws_map, om_map)
    assert {r.station_id: r.om_key for r in mapping.collect()} == {
        "s1": "41.0,-87.0", "s2": "41.0,-87.0", "s3": "om3"}
    nws = spark.createDataFrame([("LOT/1,2", None, 5.0)],
                                "grid_id string, temperature_f double, wind_speed_mph double")
    om = spark.createDataFrame([], "grid_id string, visibility_mi double")
    owm = spark.createDataFrame([("41.0,-87.0", 60.0, 9.0)],
                                "grid_id string, temperature_f double, wind_speed_mph double")
    assert {r.om_key for r in merge.fallback_grids(mapping, nws, om).collect()} == {"41.0,-87.0", "om3"}
    got = {r.station_id: (r.temperature_f, r.wind_speed_mph, r.latitude)
           for r in merge.merge_weather(mapping, nws, om, owm, F.lit(1.0)).collect()}
    assert got == {"s1": (None, 5.0, 41.0), "s2": (60.0, 9.0, 41.0)}
    filled = merge.merge_weather(mapping, nws, om, owm, F.lit(1.0), mode="coalesce")
    assert {r.station_id: r.temperature_f for r in filled.collect()} == {"s1": 60.0, "s2": 60.0}
