"""Span telemetry: counters, rolling metrics, error reports, violations.

Span rows carry ``daemon, span, ts, ok, elapsed_ms``; event rows carry the
columns of ``headway.schemas.TELEMETRY_EVENT``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from headway.functions.numeric import py_round
from headway.functions.status import is_error_event
from headway.operators.percentiles import (
    approximate_percentiles, exact_percentiles, histogram,
)

# Rolling windows in seconds, reported percentiles, success limits.
WINDOWS_S = (3600, 86400)
PERCENTS = (50, 95, 99)
WARN_BELOW = 0.9
CRITICAL_BELOW = 0.5

REPORT_COLUMNS = {
    "ts": "timestamp", "daemon_class": "daemon_name", "name": "span_name",
    "error_type": "error_type", "error_message": "error_message",
    "http_status": "http_status",
}


def _good() -> Column:
    """A span without a known outcome counts as failed, everywhere."""
    return F.coalesce(F.col("ok"), F.lit(False))


def span_counts(spans: DataFrame, keys: Sequence[str] = ("daemon", "span")) -> DataFrame:
    """Calls and failed calls per span."""
    return spans.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(~_good()).alias("errors"))


def error_type_counts(events: DataFrame) -> DataFrame:
    return (
        events.filter(is_error_event(F.col("kind"), F.col("name")))
        .groupBy("daemon_class", "error_type").agg(F.count(F.lit(1)).alias("errors"))
    )


def duration_summary(spans: DataFrame, keys: Sequence[str] = ("daemon", "span"),
                     percents: Sequence[int] = (50, 95), exact: bool = True) -> DataFrame:
    """``p<percent>_ms`` per span over all its durations."""
    found = (exact_percentiles(histogram(spans, keys, "elapsed_ms"), keys, "elapsed_ms", percents) if exact
             else approximate_percentiles(spans, keys, "elapsed_ms", percents))
    return found.select(*keys, *[F.col(f"p{p}").alias(f"p{p}_ms") for p in percents])


def span_metrics(spans: DataFrame, as_of: Column, windows_s: Sequence[int] = WINDOWS_S,
                 exact: bool = True) -> DataFrame:
    """Success and error rate, calls and percentiles per daemon, window and span.

    ``span`` is NULL in the row over all spans of a daemon, which has no
    percentiles.  A window includes both its edges, so that spans after ``as_of`` belong to
    none; all windows share one pass, and the longest bounds the scan by time.
    """
    keys = ["daemon", "window_s", "span"]
    since = {w: as_of - F.make_dt_interval(secs=F.lit(w)) for w in windows_s}
    member = F.array_compact(F.array(*[F.when(F.col("ts") >= since[w], F.lit(w)) for w in windows_s]))
    recent = (
        spans.filter((F.col("ts") <= as_of) & (F.col("ts") >= since[max(windows_s)]))
        .select("daemon", "span", _good().alias("ok"), "elapsed_ms", F.explode(member).alias("window_s"))
    )
    hist = histogram(recent, keys, "elapsed_ms", F.count_if("ok").alias("n_ok"))
    counts = hist.groupBy(*keys).agg(
        F.sum("n").alias("total_calls"), F.sum("n_ok").alias("good"))
    tails = (exact_percentiles(hist, keys, "elapsed_ms", PERCENTS) if exact
             else approximate_percentiles(recent, keys, "elapsed_ms", PERCENTS))
    same = None
    for k in keys:
        match = F.col(f"c.{k}").eqNullSafe(F.col(f"t.{k}"))
        same = match if same is None else same & match
    per_span = counts.alias("c").join(tails.alias("t"), same, "left").select(
        "c.*", *[F.coalesce(f"p{p}", F.lit(0.0)).alias(f"p{p}_ms") for p in PERCENTS])
    overall = (
        counts.groupBy("daemon", "window_s")
        .agg(F.sum("total_calls").alias("total_calls"), F.sum("good").alias("good"))
    )
    return per_span.unionByName(overall, allowMissingColumns=True).select(
        "daemon", "window_s", "span", "total_calls",
        (F.col("good") / F.col("total_calls")).alias("success_rate"),
        ((F.col("total_calls") - F.col("good")) / F.col("total_calls")).alias("error_rate"),
        *[f"p{p}_ms" for p in PERCENTS])


def daemon_metrics(metrics: DataFrame) -> DataFrame:
    """One row per daemon and window; the latency is that of its slowest span."""
    overall = F.col("span").isNull()
    return (
        metrics.groupBy("daemon", "window_s").agg(
            F.max(F.when(overall, F.col("success_rate"))).alias("success_rate"),
            F.max(F.when(overall, F.col("total_calls"))).alias("total_calls"),
            F.coalesce(F.max(F.when(~overall, F.col("p95_ms"))), F.lit(0.0))
            .alias("p95_latency_ms"))
        .withColumn("error_rate", 1.0 - F.col("success_rate"))
    )


def violations(daemons: DataFrame) -> DataFrame:
    """Daemons below the success limits, with severity and text."""
    rate = F.col("success_rate")
    return daemons.filter(rate < WARN_BELOW).select(
        "daemon", "window_s",
        F.when(rate < CRITICAL_BELOW, "critical").otherwise("warning").alias("severity"),
        F.format_string("%s success rate: %.1f%%", F.col("daemon").cast("string"),
                        py_round(rate * 100, 1)).alias("message"))


def overall_status(daemons: DataFrame, by: Sequence[str] = ("window_s",)) -> DataFrame:
    rate = F.col("success_rate")
    return daemons.groupBy(*by).agg(
        F.when(F.bool_or(rate < CRITICAL_BELOW), "critical")
        .when(F.bool_or(rate < WARN_BELOW), "degraded")
        .otherwise("healthy").alias("overall_status"))


def alert_text(found: DataFrame, by: Sequence[str]) -> DataFrame:
    """One message per alert run; a run has one violation per daemon at most."""
    line = F.concat(F.lit("- "), F.col("severity"), F.lit(": "), F.col("message"))
    return found.groupBy(*by).agg(
        F.concat_ws("\n", F.sort_array(F.collect_list(line))).alias("text"))


def error_events(events: DataFrame) -> DataFrame:
    return events.filter(is_error_event(F.col("kind"), F.col("name")))


def error_report(events: DataFrame) -> DataFrame:
    """Error events under their report names."""
    return error_events(events).select(
        *[F.col(old).alias(new) for old, new in REPORT_COLUMNS.items()])


def recent_errors(events: DataFrame, limit: int = 20) -> DataFrame:
    """Newest errors over all collectors; every task keeps only its own ``limit``."""
    if limit <= 0:
        raise ValueError("limit must be > 0")
    ranked = error_report(events).withColumn("__ts", F.coalesce("timestamp", F.lit(0.0)))
    ties = [F.col(c).asc_nulls_last() for c in REPORT_COLUMNS.values() if c != "timestamp"]
    return ranked.orderBy(F.desc("__ts"), *ties).limit(limit).drop("__ts")
