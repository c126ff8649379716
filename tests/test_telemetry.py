"""Percentiles, rolling windows, health and cooldown."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from headway.operators import health, telemetry
from headway.operators.cooldown import alerts_to_send
from headway.operators.mapping import fresh, latest_mapping
from headway.operators.percentiles import approximate_percentiles, exact_percentiles, histogram

NOW = dt.datetime(2026, 2, 17, 12, tzinfo=dt.UTC)


def interpolated(values, pct):
    values = sorted(values)
    k = (len(values) - 1) * (pct / 100.0)
    low = int(k)
    high = min(low + 1, len(values) - 1)
    return round(values[low] if low == high else values[low] * (high - k) + values[high] * (k - low), 2)


def test_exact_percentiles(spark):
    rng = random.Random(11)
    groups = {
        "one": [4.2], "two": [1.0, 2.03], "ties": [5.0] * 50 + [7.0], "signs": [-3.5, 0.0, 2.25, 9.0],
        "wide": [round(rng.lognormvariate(3, 2), 2) for _ in range(3000)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("one", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = exact_percentiles(histogram(df, ["g"], "x"), ["g"], "x", [0, 50, 95, 99, 100]).collect()
    assert {r.g: tuple(r)[1:] for r in got} == {
        g: tuple(interpolated(vs, p) for p in (0, 50, 95, 99, 100)) for g, vs in groups.items()}


def spans(spark, rows):
    return spark.createDataFrame(
        [(d, s, NOW - dt.timedelta(seconds=age), ok, ms) for d, s, age, ok, ms in rows],
        "daemon string, span string, ts timestamp, ok boolean, elapsed_ms double")


def test_windows_include_their_edge_and_null_spans_are_totals(spark):
    source = spans(spark, [("d", "a", 3600.0, True, 10.0), ("d", "a", 3600.000001, False, 30.0),
                           ("d", "b", 86400.0, True, 5.0), ("d", "b", 86401.0, False, 5.0)])
    got = {(r.window_s, r.span): r for r in telemetry.span_metrics(source, F.lit(NOW)).collect()}
    assert set(got) == {(3600, "a"), (3600, None), (86400, "a"), (86400, "b"), (86400, None)}
    assert got[3600, "a"].total_calls == 1 and got[3600, "a"].success_rate == 1.0
    assert got[86400, "a"].p50_ms == 20.0 and got[86400, "a"].error_rate == 0.5
    assert got[86400, None].total_calls == 3
    sketched = telemetry.span_metrics(source, F.lit(NOW), exact=False).filter("span = 'b'").first()
    assert sketched.p50_ms == 5.0


def test_daemon_level_reports(spark):
    rows = [("bad", "a", 10, i < 4, 100.0) for i in range(10)] + [
        ("weak", "a", 10, i < 8, 1.0) for i in range(10)] + [("good", "a", 10, True, 2.0)]
    daemons = telemetry.daemon_metrics(telemetry.span_metrics(spans(spark, rows), F.lit(NOW), (3600,)))
    found = {r.daemon: (r.severity, r.message) for r in telemetry.violations(daemons).collect()}
    assert found == {"bad": ("critical", "bad success rate: 40.0%"),
                     "weak": ("warning", "weak success rate: 80.0%")}
    assert telemetry.overall_status(daemons).first().overall_status == "critical"
    text = telemetry.alert_text(telemetry.violations(daemons), ["window_s"]).first().text
    assert text.splitlines() == ["- critical: bad success rate: 40.0%", "- warning: weak success rate: 80.0%"]


def test_collector_and_heartbeat_status(spark):
    now = NOW.timestamp()
    state = spark.createDataFrame(
        [("a", now - 60, None, 5), ("b", None, now - 9000, 7), ("c", None, None, None),
         ("d", now - 300, now, 1)],
        "daemon string, last_poll_timestamp double, last_collection_timestamp double, "
        "total_records_collected long")
    status = health.collector_status(state, F.lit(NOW))
    assert {r.daemon: (r.status, r.last_poll) for r in status.collect()} == {
        "a": ("active", "1m ago"), "b": ("stale", "2h 30m ago"), "c": ("unknown", None),
        "d": ("active", "5m ago")}
    assert health.overall_health(status).first().overall_status == "degraded"
    assert health.overall_health(status.filter("status <> 'stale'")).first().overall_status == "unknown"
    assert health.overall_health(status.filter("false")).first().overall_status == "unknown"
    beats = spark.createDataFrame([("a", str(now - 600.4), 1), ("b", "soon", 2)],
                                  "daemon string, timestamp string, pid long")
    checked = health.heartbeat_status(beats, F.lit(NOW))
    assert [tuple(r) for r in checked.collect()] == [("a", "stale", 600, 1)]
    assert health.overall_heartbeat(checked.filter("false")).first().overall_status == "healthy"


@pytest.mark.parametrize("blocks", [1, 2, 64])
def test_cooldown_equals_a_plain_walk(spark, blocks):
    rng = random.Random(blocks)
    base, pause = 1_700_000_000, 600
    rows, sent = [], set()
    for key in ("x", "y", None):
        times = sorted({base + rng.randrange(0, 200_000) for _ in range(400)} | {base, base + pause, base + 2 * pause + 1})
        last = None
        for t in times:
            ask = rng.random() < 0.7
            rows.append((key, dt.datetime.fromtimestamp(t, dt.UTC), ask))
            if ask and (last is None or t - last > pause):
                sent.add((key, t))
                last = t
    df = spark.createDataFrame(rows, "k string, ts timestamp, should_alert boolean")
    got = alerts_to_send(df, ["k"], "ts", pause, block_cooldowns=blocks)
    assert got.count() == len(rows)
    assert {(r.k, int(r.ts.timestamp())) for r in got.filter("send").select(
        "k", F.col("ts")).collect()} == sent


def test_mapping_log_and_ttl(spark):
    now = NOW.timestamp()
    log = spark.createDataFrame(
        [("a", "1", now - 100, False), ("a", "2", now - 50, False), ("b", "3", now - 50, False),
         ("b", None, now - 10, True), ("c", "4", now - 101, False)],
        "station_id string, grid_id string, updated_at double, deleted boolean")
    current = latest_mapping(log, ["station_id"])
    assert {(r.station_id, r.grid_id) for r in current.collect()} == {("a", "2"), ("c", "4")}
    assert {r.station_id for r in fresh(current, 101, F.lit(NOW)).collect()} == {"a", "c"}
    assert {r.station_id for r in fresh(current, 100, F.lit(NOW)).collect()} == {"a"}
    assert fresh(current, None, F.lit(NOW)).count() == 2


def test_sketches_count_repeated_values(spark):
    df = spark.createDataFrame([("g", 1.0)] * 99 + [("g", 100.0)] + [("n", None)], "g string, x double")
    got = approximate_percentiles(df, ["g"], "x", [50, 95, 100]).collect()
    assert [tuple(r) for r in got] == [("g", 1.0, 1.0, 100.0)]


def test_percentiles_of_infinities(spark):
    inf = float("inf")
    df = spark.createDataFrame([("g", x) for x in (-inf, 0.0, 1.0, 2.0, inf)], "g string, x double")
    got = exact_percentiles(histogram(df, ["g"], "x"), ["g"], "x", [0, 25, 50, 100]).first()
    assert tuple(got) == ("g", -inf, 0.0, 1.0, inf)


def test_mapping_without_a_tombstone_flag_stays(spark):
    log = spark.createDataFrame([("a", 1, None, 1.0), ("b", 2, True, 1.0)], "k string, v int, deleted boolean, updated_at double")
    assert [r.k for r in latest_mapping(log, ["k"]).collect()] == ["a"]
