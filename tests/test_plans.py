"""Whole cycles: weather payloads to stored rows, spans to alerts."""

import datetime as dt
import json

from pyspark.sql import functions as F

from headway.plans import monitoring, weather
from headway.sources import files

NOW = dt.datetime(2026, 2, 17, 12, tzinfo=dt.UTC)


def test_weather_cycle_falls_back(spark, tmp_path):
    stations = spark.createDataFrame([("s1", 41.0, -87.0)], "id string, latitude double, longitude double")
    grids = "station_id string, grid_id string"
    nws_map = spark.createDataFrame([("s1", "LOT/1,2")], grids)
    om_map = spark.createDataFrame([], grids)
    owm = {"coord": {"lat": 41, "lon": -87}, "dt": 5, "main": {"temp": 70.5}, "wind": {}, "weather": [{}]}
    om = {"latitude": 41, "longitude": -87, "current": {"time": "t", "rain": 0.5}}
    landed = tmp_path / "landed"
    for provider, grid, doc in (("nws", "LOT/1,2", {"properties": 3}), ("om", "41.0,-87.0", om),
                                ("owm", "41.0,-87.0", owm)):
        folder = landed / f"provider={provider}"
        folder.mkdir(parents=True)
        (folder / "a.json").write_text(json.dumps(
            {"grid_id": grid, "payload": json.dumps(doc), "collected_at": 1.0}))
    raw = [files.weather_payloads(spark, str(landed), p) for p in ("nws", "om", "owm")]
    rows, rejected = weather.weather_cycle(stations, nws_map, om_map, *raw, F.lit(NOW.timestamp()))
    row = rows.first()
    assert rows.count() == 1 and (row.temperature_f, row.rain_in, row.latitude) == (70.5, 0.5, 41.0)
    assert row.open_meteo_grid_id == "41.0,-87.0" and row.timestamp == "t"
    assert [r.provider for r in rejected.collect()] == ["nws"]
    weather.store_weather(rows, str(tmp_path / "weather"))
    assert files.dataset(spark, str(tmp_path / "weather")).filter("date = '2026-02-17'").count() == 1


def test_alert_check_and_cooldown(spark):
    spans = spark.createDataFrame(
        [("d", "a", NOW, ok, 1.0) for ok in (True, False, False)],
        "daemon string, span string, ts timestamp, ok boolean, elapsed_ms double")
    later = [0, 3600, 4 * 3600, 4 * 3600 + 1]
    checks = None
    for seconds in later:
        check = monitoring.alert_check(spans, F.lit(NOW), 3600).withColumn(
            "ts", F.lit(NOW + dt.timedelta(seconds=seconds)))
        checks = check if checks is None else checks.unionByName(check)
    sent = monitoring.alerts(checks).orderBy("ts").collect()
    assert [(r.ts.timestamp() - NOW.timestamp()) for r in sent] == [0, 4 * 3600 + 1]
    assert sent[0].overall_status == "critical" and "33.3%" in sent[0].text


def test_ordered_dimensions(spark):
    point = lambda i: {"station_id": i, "the_geom": {"coordinates": [1, 2]}}
    raw = spark.createDataFrame([(json.dumps([point("900"), point("100")]),)], "payload string")
    assert [r.id for r in monitoring.station_table(raw).collect()] == ["100", "900"]
    track = spark.createDataFrame([(json.dumps({"the_geom": {
        "type": "MultiLineString", "coordinates": [[[1, y]]]}}),) for y in range(5)], "payload string")
    ids = [r.segment_id for r in monitoring.segment_table(track).collect()]
    assert ids == sorted(ids) and len(ids) == 5
