"""Gap detection over events: dataset = user, poll = event instant."""

from __future__ import annotations

from pyspark.sql import functions as F

from headway.functions import epoch_seconds, next_local_midnight, service_date
from headway.operators.gaps import (
    daily_gap_summary, detect_gaps, gap_report, recent_polls, gap_summary,
)
from headway.operators.ordered import newest_per_key, with_running_sum
from workload.tables import events, newest, polls

INTERVAL_S = 120


def _shown(gaps):
    return gaps.withColumn("poll_ts", epoch_seconds(F.col("poll_ts")))


def gap_detect(spark, sf_dir):
    return _shown(detect_gaps(
        polls(spark, sf_dir).select("dataset", "poll_ts"), "poll_ts", ["dataset"], INTERVAL_S))


def gap_busy_hours(spark, sf_dir):
    """All users as one dataset, whose busy hours are cut by counted polls."""
    source = polls(spark, sf_dir).withColumn("dataset", F.lit(0).cast("long"))
    return _shown(detect_gaps(source, "poll_ts", ["dataset"], INTERVAL_S, most_rows=8))


def gap_totals(spark, sf_dir):
    gaps = detect_gaps(polls(spark, sf_dir), "poll_ts", ["dataset"], INTERVAL_S)
    return daily_gap_summary(gaps, "poll_ts").withColumn(
        "service_day", F.col("service_day").cast("string"))


def gap_by_dataset(spark, sf_dir):
    gaps = detect_gaps(polls(spark, sf_dir), "poll_ts", ["dataset"], INTERVAL_S)
    return gap_summary(gaps, ["dataset"])


def _recent_gaps(spark, sf_dir, days):
    source = polls(spark, sf_dir)
    as_of = newest(source, "poll_ts")
    window = recent_polls(source, "poll_ts", ["dataset"], as_of - F.make_dt_interval(days=F.lit(days)))
    return gap_report(detect_gaps(window, "poll_ts", ["dataset"], INTERVAL_S), days, as_of)


def missing_data_report(spark, sf_dir, days: int = 7):
    """Where data is missing, for how long and why: the last days, worst first."""
    recent = _recent_gaps(spark, sf_dir, days).withColumn(
        "service_day", service_date(F.col("poll_ts")).cast("string"))
    return gap_summary(recent, ["service_day", "gap_reason"]).orderBy(
        F.desc("service_day"), "gap_reason")


def report_window(spark, sf_dir):
    return _shown(_recent_gaps(spark, sf_dir, 5))


def restart_gap(spark, sf_dir):
    return _shown(detect_gaps(polls(spark, sf_dir), "poll_ts", ["dataset"], INTERVAL_S,
                              restart_reason="downtime", run_id="run_id"))


def quota_gap(spark, sf_dir):
    """Error events are failed polls: those above 50 hit the quota, none is stored."""
    source = polls(spark, sf_dir)
    stored = source.filter("event_type <> 'error'")
    quota = source.filter("event_type = 'error' AND value > 50").select("dataset", "poll_ts")
    return _shown(detect_gaps(stored, "poll_ts", ["dataset"], INTERVAL_S, quota_errors=quota))


def service_day(spark, sf_dir):
    day = service_date(F.col("ts")).cast("string").alias("service_day")
    return events(spark, sf_dir).select("event_id", day)


def local_midnight(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id", epoch_seconds(next_local_midnight(F.col("ts"))).alias("midnight"))


def running_totals(spark, sf_dir):
    sums = {"polls": F.lit(1), "records": F.floor("value")}
    return with_running_sum(
        events(spark, sf_dir), ["user_id"], "ts", sums, ties=["event_id"], most_rows=4096
    ).select("event_id", "user_id", "polls", "records")


def recent_n(spark, sf_dir):
    return newest_per_key(events(spark, sf_dir), ["event_type"], ["ts", "event_id"], 50).select(
        "event_type", "event_id", "recency")


def volume_15min(spark, sf_dir):
    return (
        events(spark, sf_dir)
        .groupBy("event_type", F.window("ts", "15 minutes").alias("w"))
        .agg(F.count(F.lit(1)).alias("records"))
        .select("event_type", epoch_seconds(F.col("w.start")).alias("window_start"), "records")
    )


QUERIES = {
    "gap_detect": gap_detect,
    "gap_busy_hours": gap_busy_hours,
    "gap_summary": gap_totals,
    "gap_by_dataset": gap_by_dataset,
    "missing_data_report": missing_data_report,
    "report_window": report_window,
    "restart_gap": restart_gap,
    "quota_gap": quota_gap,
    "service_day": service_day,
    "local_midnight": local_midnight,
    "running_totals": running_totals,
    "recent_n": recent_n,
    "volume_15min": volume_15min,
}

_SERVICE_DAY = ("strftime(({ts} AT TIME ZONE 'UTC' AT TIME ZONE 'America/Chicago')"
                " - INTERVAL 3 HOUR, '%Y-%m-%d')")


def _gaps(stored: str = "events", restart: bool = False, quota: bool = False) -> str:
    reason = "CASE WHEN delta < 600000000 THEN 'retry_exhausted' ELSE 'downtime' END"
    if restart:
        reason = f"CASE WHEN run_id <> prev_run THEN 'downtime' ELSE {reason} END"
    if quota:
        reason = ("CASE WHEN EXISTS (SELECT 1 FROM events q WHERE q.event_type = 'error' AND"
                  " q.value > 50 AND q.user_id = dataset AND q.ts > prev_ts AND q.ts <= poll)"
                  f" THEN 'daily_quota' ELSE {reason} END")
    return f"""
polls AS (SELECT DISTINCT user_id AS dataset, ts AS poll,
                 strftime(ts, '%Y-%m-%d') AS run_id FROM {stored}),
linked AS (SELECT *, lag(poll) OVER w AS prev_ts, lag(run_id) OVER w AS prev_run
           FROM polls WINDOW w AS (PARTITION BY dataset ORDER BY poll)),
measured AS (SELECT *, epoch_us(poll) - epoch_us(prev_ts) AS delta FROM linked),
gaps AS (SELECT dataset, poll, run_id, epoch_us(poll) / 1e6 AS poll_ts,
  coalesce(delta > 240000000, false) AS is_gap,
  CASE WHEN delta > 240000000 THEN epoch_us(prev_ts) / 1e6 END AS gap_start_timestamp,
  CASE WHEN delta > 240000000 THEN epoch_us(poll) / 1e6 END AS gap_end_timestamp,
  CASE WHEN delta > 240000000 THEN delta / 1e6 END AS gap_duration_seconds,
  CASE WHEN delta > 240000000 THEN {reason} END AS gap_reason,
  CASE WHEN delta > 240000000 THEN delta // 120000000 END AS missed_poll_cycles,
  delta FROM measured)"""


_COLUMNS = ("dataset, poll_ts, is_gap, gap_start_timestamp, gap_end_timestamp,"
            " gap_duration_seconds, gap_reason, missed_poll_cycles")
_SUMS = ("count(*) AS gaps, (sum(delta) / 1e6)::DOUBLE AS total_seconds,"
         " sum(missed_poll_cycles)::BIGINT AS cycles_missed")
_DAY = _SERVICE_DAY.format(ts="poll")

ORACLE = {
    "gap_detect": f"WITH {_gaps()} SELECT {_COLUMNS} FROM gaps",
    "gap_busy_hours": f"WITH {_gaps('(SELECT 0::BIGINT AS user_id, ts FROM events)')} SELECT {_COLUMNS} FROM gaps",
    "gap_summary": f"""WITH {_gaps()} SELECT {_DAY} AS service_day, {_SUMS}
        FROM gaps WHERE is_gap GROUP BY 1""",
    "gap_by_dataset": f"WITH {_gaps()} SELECT dataset, {_SUMS} FROM gaps WHERE is_gap GROUP BY 1",
    "missing_data_report": f"""WITH {_gaps()} SELECT {_DAY} AS service_day, gap_reason, {_SUMS}
        FROM gaps WHERE is_gap AND poll >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY
        GROUP BY 1, 2""",
    "report_window": f"""WITH {_gaps()} SELECT {_COLUMNS} FROM gaps
        WHERE is_gap AND poll >= (SELECT max(ts) FROM events) - INTERVAL 5 DAY""",
    "restart_gap": f"WITH {_gaps(restart=True)} SELECT {_COLUMNS}, run_id FROM gaps",
    "quota_gap": f"""WITH {_gaps("(SELECT * FROM events WHERE event_type <> 'error')", quota=True)}
        SELECT {_COLUMNS} FROM gaps""",
    "service_day": f"SELECT event_id, {_SERVICE_DAY.format(ts='ts')} AS service_day FROM events",
    "local_midnight": """SELECT event_id, epoch_us((date_trunc('day',
        ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Chicago') + INTERVAL 1 DAY)
        AT TIME ZONE 'America/Chicago') / 1e6 AS midnight FROM events""",
    "running_totals": """SELECT event_id, user_id, count(*) OVER w AS polls,
        (sum(floor(value)::BIGINT) OVER w)::BIGINT AS records FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "recent_n": """SELECT event_type, event_id, recency::INTEGER AS recency FROM (
        SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC)
        AS recency FROM events) WHERE recency <= 50""",
    "volume_15min": """SELECT event_type, epoch_us(time_bucket(INTERVAL 15 MINUTE, ts)) / 1e6
        AS window_start, count(*) AS records FROM events GROUP BY 1, 2""",
}
