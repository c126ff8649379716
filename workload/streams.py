"""Streaming twins: the tables are read as streams until all is taken, results as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from headway.functions import epoch_seconds, service_date, to_instant
from headway.plans.compaction import Tables
from headway.plans.streamed import publish_streamed
from headway.session import configure, work_dir
from headway.sources import files
from headway.streaming import polls as poll_stream
from headway.streaming.stateful import alerts_to_send_stream, detect_gaps_stream
from headway.streaming.telemetry import append_events, newest_windows, upsert_windows, windowed_metrics
from workload import gaps as gap_queries
from workload import health, payloads
from workload.tables import table

C = F.col


def _stream(spark, sf_dir, name):
    configure(spark)
    schema = table(spark, sf_dir, name).schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
            .parquet(sf_dir))


def _events(spark, sf_dir):
    return _stream(spark, sf_dir, "events").withColumn("ts", to_instant(C("ts")))


def gap_stream(spark, sf_dir):
    return _in_turns(spark, sf_dir, lambda s: detect_gaps_stream(
        _polls(s).select("dataset", "poll_ts"), "poll_ts", ["dataset"], gap_queries.INTERVAL_S))


def _in_turns(spark, sf_dir, build, turns: int = 4, ts: str = "poll_ts", late=None):
    """The events land in turns, by time; after each the stream takes what is new, from its saved state.

    Rows for which ``late`` holds land a turn later.
    """
    configure(spark)
    source = table(spark, sf_dir, "events").withColumn("ts", to_instant(C("ts")))
    ends = source.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    us = F.unix_micros("ts")
    lo, hi = (ends.select(F.unix_micros(c)).scalar() for c in ("lo", "hi"))
    part = F.floor((us - lo) * turns / (hi - lo + 1))
    if late is not None:
        part = part + late.cast("int")
    out = work_dir(spark, "turns")
    for turn in range(turns + (late is not None)):
        source.filter(part == turn).write.mode("append").parquet(f"{out}/landed")
        stream = build(spark.readStream.schema(source.schema).parquet(f"{out}/landed"))
        append_events(stream, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows").withColumn(ts, epoch_seconds(C(ts)))


def _polls(stream):
    return stream.select(C("user_id").alias("dataset"), C("ts").alias("poll_ts"),
                         F.date_format("ts", "yyyy-MM-dd").alias("run_id"), "event_type", "value")


def restart_gap_stream(spark, sf_dir):
    return _in_turns(spark, sf_dir, lambda s: detect_gaps_stream(
        _polls(s), "poll_ts", ["dataset"], gap_queries.INTERVAL_S, restart_reason="downtime", run_id="run_id"))


def quota_gap_stream(spark, sf_dir):
    """Error events are failed polls: those above 50 hit the quota, none is stored."""
    def build(stream):
        polled = _polls(stream)
        return detect_gaps_stream(
            polled.filter("event_type <> 'error'"), "poll_ts", ["dataset"], gap_queries.INTERVAL_S,
            quota_errors=polled.filter("event_type = 'error' AND value > 50"))

    return _in_turns(spark, sf_dir, build)


def deduped_stream(spark, sf_dir, turns: int = 4):
    """Every turn lands the events of its time and, once more, the last hour of the turn before."""
    source = table(spark, sf_dir, "events").withColumn("ts", to_instant(C("ts")))
    lo, hi = (source.agg(F.unix_micros(f("ts")).alias("us")).scalar() for f in (F.min, F.max))
    us, width = F.unix_micros("ts"), hi - lo + 1
    part = F.floor((us - lo) * turns / width)
    out = work_dir(spark, "deduped")
    for turn in range(turns):
        again = (part == turn - 1) & (us >= lo + width * turn / turns - 3_600_000_000)
        source.filter((part == turn) | again).write.mode("append").parquet(f"{out}/landed")
        stream = spark.readStream.schema(source.schema).parquet(f"{out}/landed")
        kept = poll_stream.deduplicated(stream, ["event_id"], "ts", "2 hours")
        append_events(kept, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema(source.schema).parquet(f"{out}/rows").select(
        "event_id", "user_id", "event_type", "value", F.unix_micros("ts").alias("us"))


def stream_to_day(spark, sf_dir):
    """A poll stream's days in the daily dataset, after a killed task, a restart and late polls.

    A tenth of the table's time: four days.  Every fiftieth poll lands only after the days
    were published for the first time.
    """
    at = F.timestamp_micros(F.floor(F.unix_micros("ts") / 10).cast("long"))
    source = _table_events(spark, sf_dir).select("event_id", at.alias("poll_ts"), "event_type", "value")
    middle = source.select(F.timestamp_micros(((F.unix_micros(F.min("poll_ts")) + F.unix_micros(F.max("poll_ts"))) / 2).cast("long"))).scalar()
    late, early = C("event_id") % 50 == 0, C("poll_ts") < middle
    tables = Tables(work_dir(spark, "streamed"))
    root = work_dir(spark, "sink")
    for turn, landed in enumerate((~late & early, ~late & ~early, late)):
        source.filter(landed).write.mode("append").parquet(f"{root}/landed")
        stream = spark.readStream.schema(source.schema).parquet(f"{root}/landed")
        poll_stream.append(stream, "poll_ts", f"{root}/rows", f"{root}/checkpoint", interval=None).awaitTermination()
        if turn == 0:  # what a killed query leaves: files that no commit names
            day = service_date(C("poll_ts"))
            source.filter(early).withColumns({n: F.date_format(day, f) for n, f in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))}) \
                .write.mode("append").partitionBy("year", "month", "day").parquet(f"{root}/rows")
        else:
            publish_streamed(spark, tables, "polls", f"{root}/rows", source.schema, "poll_ts")
    return files.dataset(spark, tables.dataset("polls"), source.schema).select(
        "date", "event_id", F.unix_micros("poll_ts").alias("us"), "event_type", "value")


def _table_events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("ts", to_instant(C("ts")))


def cooldown_stream(spark, sf_dir):
    return _in_turns(spark, sf_dir, lambda s: alerts_to_send_stream(
        s.select(C("user_id").alias("key"), "ts", (C("event_type") == "error").alias("should_alert")),
        ["key"], "ts", health.COOLDOWN_S), ts="ts")


def late_polls(spark, sf_dir):
    """Polls that land a turn later than others of their time, counted per dataset where that is late."""
    told = _in_turns(spark, sf_dir, lambda s: detect_gaps_stream(
        _polls(s).select("dataset", "poll_ts"), "poll_ts", ["dataset"], gap_queries.INTERVAL_S, with_late=True),
        late=C("event_id") % 40 == 0)
    return told.groupBy("dataset").agg(F.count_if("is_late").alias("late"), F.count_if("is_gap").alias("gaps"))


def windowed_stream(spark, sf_dir):
    """Every window as last logged, with its sketched percentiles."""
    spans = _events(spark, sf_dir).select(
        (C("user_id") % 3).alias("daemon"), C("event_type").alias("span"), "ts",
        (C("event_type") != "error").alias("ok"), C("value").alias("elapsed_ms"))
    metrics = windowed_metrics(spans)
    out = work_dir(spark, "windows")
    upsert_windows(metrics, f"{out}/log", f"{out}/checkpoint").awaitTermination()
    log = spark.read.schema(f"{_ddl(metrics)}, batch long").parquet(f"{out}/log")
    return newest_windows(log).select(
        "daemon", "span", epoch_seconds(C("window_start")).alias("window_start"), "total_calls", "success_rate",
        "p50_ms", "p95_ms", "p99_ms")


def position_stream(spark, sf_dir):
    """Polls normalised on the fly and stored by their own service day."""
    raw = payloads.snapshots_of(_stream(spark, sf_dir, "lineitem"))
    out = work_dir(spark, "positions")
    good, _ = poll_stream.positions(raw)
    poll_stream.append(good, "poll_timestamp", f"{out}/rows", f"{out}/checkpoint",
                       interval=None).awaitTermination()
    stored = spark.read.schema(f"{_ddl(good)}, year string, month string, day string").parquet(
        f"{out}/rows")
    return stored.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("trains"), F.count_if("is_delayed").alias("delayed"))


def _ddl(df):
    return ", ".join(f"{n} {t}" for n, t in df.dtypes)


QUERIES = {
    "gap_stream": gap_stream,
    "cooldown_stream": cooldown_stream,
    "windowed_stream": windowed_stream,
    "position_stream": position_stream,
    "quota_gap_stream": quota_gap_stream,
    "restart_gap_stream": restart_gap_stream,
    "late_polls": late_polls,
    "deduped_stream": deduped_stream,
    "stream_to_day": stream_to_day,
}

ORACLE = {
    "gap_stream": f"""WITH {gap_queries._gaps()} SELECT {gap_queries._COLUMNS} FROM gaps
        WHERE is_gap""",
    "restart_gap_stream": f"""WITH {gap_queries._gaps(restart=True)} SELECT {gap_queries._COLUMNS} FROM gaps
        WHERE is_gap""",
    "quota_gap_stream": f"""WITH {gap_queries._gaps("(SELECT * FROM events WHERE event_type <> 'error')", quota=True)}
        SELECT {gap_queries._COLUMNS} FROM gaps WHERE is_gap""",
    "late_polls": """WITH ends AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
        landed AS (SELECT DISTINCT user_id AS dataset, epoch_us(ts) AS us,
            floor((epoch_us(ts) - lo) * 4 / (hi - lo + 1)) + (event_id % 40 = 0)::INTEGER AS turn FROM events, ends),
        before AS (SELECT *, max(us) OVER (PARTITION BY dataset ORDER BY turn RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last
                   FROM landed),
        taken AS (SELECT *, lag(us) OVER (PARTITION BY dataset ORDER BY us) AS prev FROM before WHERE last IS NULL OR us > last),
        gaps AS (SELECT dataset, count(*) AS gaps FROM taken WHERE us - prev > 240000000 GROUP BY 1),
        late AS (SELECT dataset, count(*) AS late FROM before WHERE us < last GROUP BY 1)
        SELECT dataset, coalesce(late, 0)::BIGINT AS late, coalesce(gaps, 0)::BIGINT AS gaps FROM late FULL JOIN gaps USING (dataset)""",
    "deduped_stream": "SELECT event_id, user_id, event_type, value, epoch_us(ts) AS us FROM events",
    "stream_to_day": f"""WITH polls AS (SELECT event_id, event_type, value, make_timestamp(epoch_us(ts) // 10) AS poll_ts FROM events),
        days AS (SELECT *, {gap_queries._SERVICE_DAY.format(ts='poll_ts')} AS date FROM polls)
        SELECT date, event_id, epoch_us(poll_ts) AS us, event_type, value FROM days
        WHERE date < (SELECT {gap_queries._SERVICE_DAY.format(ts="(max(poll_ts) - INTERVAL 1 HOUR)")} FROM polls)""",
    "cooldown_stream": health.ORACLE["alert_cooldown"],
    "windowed_stream": """WITH slots AS (SELECT user_id % 3 AS daemon, event_type AS span,
            event_type <> 'error' AS ok, ts, value,
            time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(5 * i) AS start
            FROM events, range(12) r(i))
        SELECT daemon, span, epoch_us(start) / 1e6 AS window_start, count(*) AS total_calls,
        count(*) FILTER (ok) / count(*) AS success_rate, quantile_disc(value, 0.5) AS p50_ms,
        quantile_disc(value, 0.95) AS p95_ms, quantile_disc(value, 0.99) AS p99_ms FROM slots
        GROUP BY 1, 2, 3""",
    "position_stream": f"""WITH {payloads._SNAPSHOTS}, days AS (SELECT is_delayed,
            (l_shipdate AT TIME ZONE 'UTC' AT TIME ZONE 'America/Chicago') - INTERVAL 3 HOUR AS d
            FROM judged WHERE reason IS NULL)
        SELECT strftime(d, '%Y') AS year, strftime(d, '%m') AS month, strftime(d, '%d') AS day,
        count(*) AS trains, count(*) FILTER (is_delayed) AS delayed FROM days GROUP BY 1, 2, 3""",
}
