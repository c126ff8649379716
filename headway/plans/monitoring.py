"""Reports over stored tables: network dimensions, alerts, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from headway.operators import network, telemetry
from headway.operators.cooldown import alerts_to_send

# Fixed value: hours between two alerts.
COOLDOWN_HOURS = 4


def station_table(raw: DataFrame) -> DataFrame:
    """Stations in id order, for reproducible dimension files."""
    return network.stations(network.station_rows(raw))[0].orderBy("id")


def segment_table(raw: DataFrame) -> DataFrame:
    """Track segments in id order."""
    return network.track_segments(raw)[0].orderBy("segment_id")


def alert_check(spans: DataFrame, as_of: Column, window_s: int = 3600) -> DataFrame:
    """One row per check: time, whether to alert, and the text of the violations."""
    metrics = telemetry.span_metrics(spans, as_of, (window_s,))
    daemons = telemetry.daemon_metrics(metrics)
    text = telemetry.alert_text(telemetry.violations(daemons), ["window_s"])
    status = telemetry.overall_status(daemons)
    return status.join(text, "window_s", "left").select(
        F.lit("metrics").alias("key"), as_of.alias("ts"),
        F.col("text").isNotNull().alias("should_alert"), "overall_status", "text")


def alerts(checks: DataFrame, cooldown_hours: float = COOLDOWN_HOURS) -> DataFrame:
    """Checks whose alert is sent; the others fall into the cooldown or found nothing."""
    sent = alerts_to_send(checks, ["key"], "ts", cooldown_hours * 3600).filter("send")
    return checks.join(sent.drop("send"), ["key", "ts"], "left_semi").filter("should_alert")
