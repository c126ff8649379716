"""Collector health over events: one collector per user."""

from __future__ import annotations

from pyspark.sql import functions as F

from headway.functions import epoch_seconds, staleness
from headway.operators import health as h
from headway.operators.cooldown import alerts_to_send
from workload.tables import events, newest

COOLDOWN_S = 4 * 3600


def _state(spark, sf_dir):
    """Users divisible by 5 keep only the alternate time; by 7, no time at all."""
    last = epoch_seconds(F.max("ts"))
    user = F.col("user_id")
    return events(spark, sf_dir).groupBy("user_id").agg(
        last.alias("last"), F.count(F.lit(1)).alias("total_records_collected")
    ).select(
        user.cast("string").alias("daemon"),
        F.when((user % 5 != 0) & (user % 7 != 0), F.col("last")).alias("last_poll_timestamp"),
        F.when((user % 5 == 0) & (user % 7 != 0), F.col("last")).alias("last_collection_timestamp"),
        "total_records_collected")


def latest_status(spark, sf_dir):
    return h.collector_status(
        _state(spark, sf_dir), newest(events(spark, sf_dir)), stale_s=36 * 3600)


def overall_health(spark, sf_dir):
    return h.overall_health(latest_status(spark, sf_dir))


def _heartbeats(spark, sf_dir):
    return events(spark, sf_dir).groupBy("user_id").agg(
        F.when(F.col("user_id") % 6 != 0, epoch_seconds(F.max("ts")).cast("string"))
        .otherwise("not a number").alias("timestamp"), F.max("event_id").alias("pid")
    ).withColumnRenamed("user_id", "daemon")


def heartbeat_status(spark, sf_dir):
    return h.heartbeat_status(_heartbeats(spark, sf_dir), newest(events(spark, sf_dir)),
                              stale_s=36 * 3600)


def overall_heartbeat(spark, sf_dir):
    return h.overall_heartbeat(heartbeat_status(spark, sf_dir))


def event_staleness(spark, sf_dir):
    source = events(spark, sf_dir)
    age = epoch_seconds(newest(source)) - epoch_seconds(F.col("ts"))
    known = F.when(F.col("event_type") != "signup", age)
    return source.select("event_id", staleness(known, 10 * 86400).alias("status"))


def alert_cooldown(spark, sf_dir):
    """Each error event of a user asks for an alert; the others do not."""
    candidates = events(spark, sf_dir).select(
        F.col("user_id").alias("key"), "ts",
        (F.col("event_type") == "error").alias("should_alert"))
    sent = alerts_to_send(candidates, ["key"], "ts", COOLDOWN_S)
    return sent.select("key", epoch_seconds(F.col("ts")).alias("ts"), "send")


QUERIES = {
    "latest_status": latest_status,
    "overall_health": overall_health,
    "heartbeat_status": heartbeat_status,
    "overall_heartbeat": overall_heartbeat,
    "staleness": event_staleness,
    "alert_cooldown": alert_cooldown,
}

_NOW = "(SELECT epoch_us(max(ts)) / 1e6 FROM events)"
_TEXT = """CASE WHEN s < 60 THEN s || 's'
    WHEN s < 3600 THEN (s // 60) || 'm' || CASE WHEN s % 60 > 0 THEN ' ' || (s % 60) || 's' ELSE '' END
    WHEN s < 86400 THEN (s // 3600) || 'h' || CASE WHEN s % 3600 // 60 > 0
        THEN ' ' || (s % 3600 // 60) || 'm' ELSE '' END
    ELSE (s // 86400) || 'd' || CASE WHEN s % 86400 // 3600 > 0
        THEN ' ' || (s % 86400 // 3600) || 'h' ELSE '' END END"""
_STATUS = f"""state AS (SELECT user_id::VARCHAR AS daemon, count(*) AS records,
        CASE WHEN user_id % 7 <> 0 THEN {_NOW} - epoch_us(max(ts)) / 1e6 END AS age_seconds
        FROM events GROUP BY user_id),
    status AS (SELECT daemon, records, age_seconds, CASE WHEN age_seconds IS NULL THEN 'unknown'
        WHEN age_seconds > 129600 THEN 'stale' ELSE 'active' END AS status,
        trunc(age_seconds)::BIGINT AS s FROM state)"""
_HEARTBEAT = f"""beats AS (SELECT user_id AS daemon, max(event_id) AS pid,
        {_NOW} - epoch_us(max(ts)) / 1e6 AS age FROM events WHERE user_id % 6 <> 0 GROUP BY 1),
    status AS (SELECT daemon, pid, printf('%.0f', age)::BIGINT AS age_seconds,
        CASE WHEN age > 129600 THEN 'stale' ELSE 'healthy' END AS status FROM beats)"""

ORACLE = {
    "latest_status": f"""WITH {_STATUS} SELECT daemon, status, age_seconds,
        {_TEXT} || ' ago' AS last_poll, records FROM status""",
    "overall_health": f"""WITH {_STATUS}, c AS (SELECT count(*) FILTER (status = 'stale') AS stale,
        count(*) FILTER (status = 'unknown') AS unknown FROM status)
        SELECT CASE WHEN stale > 0 THEN 'degraded' WHEN unknown > 0 THEN 'unknown'
        ELSE 'healthy' END AS overall_status, stale, unknown FROM c""",
    "heartbeat_status": f"WITH {_HEARTBEAT} SELECT daemon, status, age_seconds, pid FROM status",
    "overall_heartbeat": f"""WITH {_HEARTBEAT} SELECT CASE WHEN bool_or(status = 'stale')
        THEN 'degraded' ELSE 'healthy' END AS overall_status FROM status""",
    "staleness": f"""SELECT event_id, CASE WHEN event_type = 'signup' THEN 'unknown'
        WHEN {_NOW} - epoch_us(ts) / 1e6 > 864000 THEN 'stale' ELSE 'active' END AS status
        FROM events""",
    "alert_cooldown": f"""WITH RECURSIVE
        asked AS (SELECT DISTINCT user_id, epoch_us(ts) AS us FROM events WHERE event_type = 'error'),
        sent(user_id, us) AS (
          SELECT user_id, min(us) FROM asked GROUP BY user_id
          UNION ALL
          SELECT user_id, us FROM (
            SELECT a.user_id, a.us, row_number() OVER (PARTITION BY a.user_id ORDER BY a.us) AS rn
            FROM sent s JOIN asked a ON a.user_id = s.user_id
              AND a.us - s.us > {COOLDOWN_S * 1_000_000}) WHERE rn = 1)
        SELECT e.user_id AS key, epoch_us(e.ts) / 1e6 AS ts, s.us IS NOT NULL AS send
        FROM (SELECT DISTINCT user_id, ts FROM events) e
        LEFT JOIN sent s ON s.user_id = e.user_id AND s.us = epoch_us(e.ts)""",
}
