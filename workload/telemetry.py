"""Span telemetry over events: daemon = user mod 3, span = event type."""

from __future__ import annotations

from pyspark.sql import functions as F

from headway.functions import duration_text, error_category, from_epoch
from headway.operators import telemetry as t
from headway.operators.ordered import latest_per_key
from workload.tables import events, newest, spans, telemetry_events


def _metrics(spark, sf_dir, windows_s=t.WINDOWS_S):
    source = spans(spark, sf_dir)
    return t.span_metrics(source, newest(source), windows_s)


MONTH_S = 31 * 86400


def span_counts(spark, sf_dir):
    return t.span_counts(spans(spark, sf_dir))


def duration_percentiles(spark, sf_dir):
    return t.duration_summary(spans(spark, sf_dir))


def span_metrics(spark, sf_dir):
    """A window wide enough for the whole table."""
    return _metrics(spark, sf_dir, (MONTH_S,))


def window_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir)


def worst_span(spark, sf_dir):
    return t.daemon_metrics(_metrics(spark, sf_dir, (86400, MONTH_S)))


def violations(spark, sf_dir):
    return t.violations(t.daemon_metrics(_metrics(spark, sf_dir, (86400, MONTH_S))))


def alert_text(spark, sf_dir):
    found = t.violations(t.daemon_metrics(_metrics(spark, sf_dir, (86400, MONTH_S))))
    return t.alert_text(found, ["window_s"])


def overall_status(spark, sf_dir):
    return t.overall_status(t.daemon_metrics(_metrics(spark, sf_dir, (3600, 86400, MONTH_S))))


def top_errors(spark, sf_dir):
    return t.recent_errors(telemetry_events(spark, sf_dir))


def error_report(spark, sf_dir):
    return t.error_report(telemetry_events(spark, sf_dir))


def error_types(spark, sf_dir):
    return t.error_type_counts(telemetry_events(spark, sf_dir))


def error_categories(spark, sf_dir):
    source = events(spark, sf_dir).withColumn("pick", F.col("event_id") % 7)
    kinds = ["BodyCodeError", "ConfigurationError", "APIResponseError", "ValueError",
             "HTTPStatusError", "ReadTimeout", "KeyError"]
    kind = F.get(F.array(*map(F.lit, kinds)), F.col("pick").cast("int"))
    message = F.when(F.col("event_type") == "view", "Key is MISSING").otherwise(F.col("props"))
    status = (F.lit(400) + F.floor("value")).cast("int")
    code = F.when(F.col("event_type") == "click", "102").when(
        F.col("event_type") == "error", "106").when(F.col("event_type") == "signup", "0")
    return source.select("event_id", error_category(kind, message, status, code, ("BodyCodeError",)).alias("category"))


def latest_event(spark, sf_dir):
    """Newest record per collector."""
    source = telemetry_events(spark, sf_dir).select("daemon_class", "ts", "event_id", "name")
    return latest_per_key(source, ["daemon_class"], ["ts", "event_id"])


def durations_text(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id", duration_text(F.col("value") * F.pow(F.lit(10.0), F.col("event_id") % 5))
        .alias("text"))


def epoch_instants(spark, sf_dir):
    """Epoch seconds back to instants, shown as UTC text."""
    source = telemetry_events(spark, sf_dir)
    return source.select("event_id", F.date_format(
        from_epoch(F.col("ts")), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"))


QUERIES = {
    "span_counts": span_counts,
    "duration_percentiles": duration_percentiles,
    "span_metrics": span_metrics,
    "window_metrics": window_metrics,
    "worst_span": worst_span,
    "violations": violations,
    "alert_text": alert_text,
    "overall_status": overall_status,
    "top_errors": top_errors,
    "error_report": error_report,
    "error_types": error_types,
    "error_category": error_categories,
    "latest_event": latest_event,
    "duration_text": durations_text,
    "epoch_instants": epoch_instants,
}

_SPANS = """spans AS (SELECT user_id % 3 AS daemon, event_type AS span, ts,
    event_type <> 'error' AS ok, value AS elapsed_ms FROM events)"""


def _pct(p: int) -> str:
    """Interpolated percentile of the sorted list ``v`` of length ``n``."""
    k = f"((n - 1) * {p / 100.0}::DOUBLE)"
    low = f"floor({k})::BIGINT"
    return (f"printf('%.2f', CASE WHEN {low} >= n - 1 THEN v[n] ELSE"
            f" v[{low} + 1] * (({low} + 1) - {k}) + v[{low} + 2] * ({k} - {low}) END)::DOUBLE")


def _metrics_sql(windows: tuple[int, ...]) -> str:
    rows = ", ".join(f"({w})" for w in windows)
    return f"""{_SPANS},
recent AS (SELECT s.*, w.window_s FROM spans s, (VALUES {rows}) w(window_s)
    WHERE s.ts >= (SELECT max(ts) FROM events) - to_seconds(w.window_s)),
grouped AS (SELECT daemon, window_s, span, count(*) AS n, count(*) FILTER (ok) AS good,
    list_sort(list(elapsed_ms)) AS v FROM recent GROUP BY 1, 2, 3),
metrics AS (
    SELECT daemon, window_s, span, n AS total_calls, good / n AS success_rate,
        (n - good) / n AS error_rate,
        {_pct(50)} AS p50_ms, {_pct(95)} AS p95_ms, {_pct(99)} AS p99_ms FROM grouped
    UNION ALL
    SELECT daemon, window_s, NULL, sum(n)::BIGINT, sum(good) / sum(n),
        (sum(n) - sum(good)) / sum(n), NULL, NULL, NULL FROM grouped GROUP BY 1, 2),
daemons AS (SELECT daemon, window_s,
    max(success_rate) FILTER (span IS NULL) AS success_rate,
    max(total_calls) FILTER (span IS NULL) AS total_calls,
    max(p95_ms) FILTER (span IS NOT NULL) AS p95_latency_ms,
    1.0::DOUBLE - max(success_rate) FILTER (span IS NULL) AS error_rate
    FROM metrics GROUP BY 1, 2),
violations AS (SELECT daemon, window_s,
    CASE WHEN success_rate < 0.5 THEN 'critical' ELSE 'warning' END AS severity,
    daemon || ' success rate: ' || printf('%.1f', success_rate * 100) || '%' AS message
    FROM daemons WHERE success_rate < 0.9)"""


_EVENTS = """records AS (SELECT epoch_us(ts) / 1e6 AS ts, event_id, value,
    (user_id % 3)::VARCHAR AS daemon_class,
    CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'error' ELSE 'span' END AS kind,
    'call' || event_id || CASE WHEN event_type = 'error' AND event_id % 2 = 1
        THEN '.error' ELSE '' END AS name,
    CASE WHEN event_type = 'error' THEN CASE WHEN value < 20 THEN 'ReadTimeout'
        WHEN value < 60 THEN 'HTTPStatusError' ELSE 'ValueError' END END AS error_type,
    CASE WHEN event_type = 'error' THEN props END AS error_message,
    CASE WHEN event_type = 'error' AND value BETWEEN 20 AND 59.99
        THEN (400 + floor(value))::INTEGER END AS http_status FROM events),
errors AS (SELECT * FROM records WHERE kind = 'error' OR name LIKE '%.error')"""
_REPORT = ("SELECT ts AS timestamp, daemon_class AS daemon_name, name AS span_name,"
           " error_type, error_message, http_status FROM errors")

ORACLE = {
    "span_counts": f"""WITH {_SPANS} SELECT daemon, span, count(*) AS calls,
        count(*) FILTER (NOT ok) AS errors FROM spans GROUP BY 1, 2""",
    "duration_percentiles": f"""WITH {_SPANS}, g AS (SELECT daemon, span, count(*) AS n,
        list_sort(list(elapsed_ms)) AS v FROM spans GROUP BY 1, 2)
        SELECT daemon, span, {_pct(50)} AS p50_ms, {_pct(95)} AS p95_ms FROM g""",
    "span_metrics": f"""WITH {_metrics_sql((MONTH_S,))}
        SELECT * REPLACE (window_s::INTEGER AS window_s) FROM metrics""",
    "window_metrics": f"""WITH {_metrics_sql((3600, 86400))}
        SELECT * REPLACE (window_s::INTEGER AS window_s) FROM metrics""",
    "worst_span": f"""WITH {_metrics_sql((86400, MONTH_S))}
        SELECT * REPLACE (window_s::INTEGER AS window_s) FROM daemons""",
    "violations": f"""WITH {_metrics_sql((86400, MONTH_S))}
        SELECT * REPLACE (window_s::INTEGER AS window_s) FROM violations""",
    "alert_text": f"""WITH {_metrics_sql((86400, MONTH_S))}
        SELECT window_s::INTEGER AS window_s, string_agg('- ' || severity || ': ' || message,
        chr(10) ORDER BY severity, message) AS text FROM violations GROUP BY 1""",
    "overall_status": f"""WITH {_metrics_sql((3600, 86400, MONTH_S))}
        SELECT window_s::INTEGER AS window_s, CASE WHEN min(success_rate) < 0.5 THEN 'critical'
        WHEN min(success_rate) < 0.9 THEN 'degraded' ELSE 'healthy' END AS overall_status
        FROM daemons GROUP BY 1""",
    "top_errors": f"""WITH {_EVENTS} {_REPORT}
        ORDER BY timestamp DESC, daemon_name, span_name LIMIT 20""",
    "error_report": f"WITH {_EVENTS} {_REPORT}",
    "error_types": f"""WITH {_EVENTS} SELECT daemon_class, error_type, count(*) AS errors
        FROM errors GROUP BY 1, 2""",
    "error_category": """WITH e AS (SELECT event_id, event_id % 7 AS pick, event_type,
        400 + floor(value)::INTEGER AS status FROM events)
        SELECT event_id, CASE
          WHEN pick = 0 AND event_type = 'click' THEN 'daily_quota'
          WHEN pick IN (0, 1) THEN 'configuration'
          WHEN pick = 2 THEN 'transient'
          WHEN pick = 3 AND event_type = 'view' THEN 'configuration'
          WHEN pick = 4 AND status = 429 THEN 'rate_limit'
          WHEN pick = 4 AND event_type = 'click' THEN 'daily_quota'
          WHEN pick = 4 AND event_type = 'error' THEN 'configuration'
          WHEN pick = 5 THEN 'transient'
          WHEN pick = 4 AND status IN (500, 501) THEN 'transient'
          WHEN pick = 4 AND status BETWEEN 400 AND 499 THEN 'configuration'
          ELSE 'unknown' END AS category FROM e""",
    "latest_event": f"""WITH {_EVENTS} SELECT daemon_class, ts, event_id, name FROM (
        SELECT *, row_number() OVER (PARTITION BY daemon_class ORDER BY ts DESC, event_id DESC)
        AS rn FROM records) WHERE rn = 1""",
    "duration_text": """WITH d AS (SELECT event_id, value * pow(10.0, event_id % 5) AS s FROM events),
        w AS (SELECT event_id, trunc(s)::BIGINT AS s FROM d)
        SELECT event_id, CASE
          WHEN s < 60 THEN s || 's'
          WHEN s < 3600 THEN (s // 60) || 'm' || CASE WHEN s % 60 > 0 THEN ' ' || (s % 60) || 's' ELSE '' END
          WHEN s < 86400 THEN (s // 3600) || 'h' || CASE WHEN s % 3600 // 60 > 0
            THEN ' ' || (s % 3600 // 60) || 'm' ELSE '' END
          ELSE (s // 86400) || 'd' || CASE WHEN s % 86400 // 3600 > 0
            THEN ' ' || (s % 86400 // 3600) || 'h' ELSE '' END END AS text FROM w""",
    "epoch_instants": """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at FROM events""",
}
