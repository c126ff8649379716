"""Landed files as sources: the tables are written as collectors leave them, then read."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window, functions as F

from headway.functions import epoch_seconds
from headway.plans import monitoring
from headway.session import work_dir
from headway.sources import files
from headway.sources.journals import open_folder
from headway.streaming.telemetry import append_events
from workload.payloads import arr, num, obj, txt
from workload.tables import events, table

C = F.col


def land(lines: DataFrame, folder: str) -> None:
    """Write ``lines`` (file, no, line) as text files of these names, each by one task."""
    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        filesystem, inner = open_folder(folder)
        filesystem.create_dir(inner, recursive=True)
        name = sink = None
        n = 0
        for batch in batches:
            for file, line in zip(batch.column("file").to_pylist(), batch.column("line").to_pylist()):
                if file != name:
                    if sink:
                        sink.close()
                    name, sink = file, filesystem.open_output_stream(f"{inner}/{file}")
                sink.write(line.encode() + b"\n")
                n += 1
        if sink:
            sink.close()
        yield pa.RecordBatch.from_pydict({"lines": pa.array([n], pa.int64())})

    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (lines.select("file", "no", "line").repartition(tasks, "file").sortWithinPartitions("file", "no")
     .mapInArrow(write, "lines bigint").write.format("noop").mode("overwrite").save())


def _ranked(df: DataFrame) -> DataFrame:
    """The place of each row in the order in which the frame gives them."""
    return df.coalesce(1).withColumn("place", F.monotonically_increasing_id())


def _telemetry(spark, sf_dir):
    kind = F.when(C("event_type") == "error", "error").otherwise("span")
    return events(spark, sf_dir).withColumns({
        "daemon_class": F.concat(F.lit("d"), (C("user_id") % 3).cast("string")), "kind": kind, "at": epoch_seconds(C("ts"))})


def landed_telemetry(spark, sf_dir):
    """JSON lines per daemon: of fifty events one is cut off, one blank and one without a time."""
    place = C("event_id") % 50
    whole = F.to_json(F.struct(
        F.when(place != 2, C("at")).alias("ts"), "kind", "daemon_class", C("event_type").alias("name"),
        (C("kind") == "span").alias("ok"), C("value").alias("elapsed_ms")))
    line = F.when(place == 0, F.substring(whole, 1, 20)).when(place == 1, "").otherwise(whole)
    root = work_dir(spark, "telemetry")
    land(_telemetry(spark, sf_dir).select(
        F.concat("daemon_class", F.lit(".events.jsonl")).alias("file"), C("event_id").alias("no"), line.alias("line")), root)
    return files.telemetry_events(spark, root).select("ts", "kind", "daemon_class", "name", "ok", "elapsed_ms")


def landed_snapshots(spark, sf_dir):
    """A metrics snapshot per daemon and day; the newest counts, and d2's newest has no calls."""
    day = F.date_trunc("day", C("ts"))
    per_span = _telemetry(spark, sf_dir).groupBy("daemon_class", day.alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("calls"), F.max("value").alias("p95"), F.count_if(C("kind") == "span").alias("good"))
    spans = F.map_from_entries(F.collect_list(F.struct("event_type", F.struct(C("p95").alias("p95_ms")))))
    daily = per_span.groupBy("daemon_class", "day").agg(
        (F.sum("good") / F.sum("calls")).alias("rate"), F.sum("calls").alias("calls"), spans.alias("spans"))
    newest = F.row_number().over(Window.partitionBy("daemon_class").orderBy(F.desc("day"))) == 1
    shown = ~((C("daemon_class") == "d2") & C("newest"))
    window = F.struct(F.when(shown, C("rate")).alias("overall_success_rate"), F.when(shown, C("calls")).alias("total_calls"),
                      C("spans").alias("per_span_metrics"))
    line = F.to_json(F.struct(F.unix_seconds("day").cast("double").alias("ts"), "daemon_class", F.struct(
        F.struct(window.alias("last_hour")).alias("time_window_metrics")).alias("metrics")))
    root = work_dir(spark, "snapshots")
    land(daily.withColumn("newest", newest).select(
        F.concat("daemon_class", F.lit(".metrics.jsonl")).alias("file"), F.unix_seconds("day").alias("no"), line.alias("line")), root)
    return files.latest_snapshot_metrics(files.metrics_snapshots(spark, root)).select(
        "daemon", "success_rate", "total_calls", "p95_latency_ms")


def _collectors(spark, sf_dir):
    return events(spark, sf_dir).groupBy((C("user_id") % 20).alias("c")).agg(
        F.max(epoch_seconds(C("ts"))).alias("last"), F.count(F.lit(1)).alias("records"))


def _file(df, name, *lines):
    """One landed file per row from its lines."""
    return df.select(name.alias("file"), F.posexplode(F.array(*lines)).alias("no", "line"))


def landed_states(spark, sf_dir):
    """State files of collectors over several lines; one is broken, and other files lie beside them."""
    rows = _collectors(spark, sf_dir)
    name = F.concat(F.lit("c"), C("c").cast("string"))
    broken = C("c") == 7
    state = _file(rows, F.concat(name, F.lit(".json")), F.when(broken, "no").otherwise(F.lit("{")),
                  F.concat(F.lit('"last_poll_timestamp": '), num(C("last")), F.lit(",")),
                  F.concat(F.lit('"total_records_collected": '), num(C("records"))), F.lit("}"))
    beats = _file(rows, F.concat(name, F.lit(".heartbeat.json")), F.lit("{}"))
    root = work_dir(spark, "states")
    land(state.unionByName(beats), root)
    return files.collector_state(spark, root).select("daemon", "last_poll_timestamp", "total_records_collected")


def landed_heartbeats(spark, sf_dir):
    """Heartbeats; some name no daemon and take their file's name, some are not JSON."""
    rows = _collectors(spark, sf_dir)
    body = obj(timestamp=txt(C("last")), daemon=F.when(C("c") % 4 != 0, txt(F.concat(F.lit("n"), C("c")))), pid=num(C("records")))
    line = F.when(C("c") % 5 == 3, "{cut").otherwise(body)
    root = work_dir(spark, "heartbeats")
    land(_file(rows, F.concat(F.lit("c"), C("c").cast("string"), F.lit(".heartbeat.json")), line), root)
    return files.heartbeats(spark, root).select("daemon", C("timestamp").cast("double").alias("timestamp"), "pid")


def landed_runs(spark, sf_dir):
    """Run records by newest file name: a record per day, the unreadable ones left out."""
    days = events(spark, sf_dir).groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    body = obj(date=txt(C("day")), daemon=txt("events"), status=F.when(C("n") % 2 == 0, txt("success")).otherwise(txt("failed")),
               rows_written=num(C("n")), elapsed_seconds=F.lit("0.5"))
    line = F.when(F.dayofmonth(C("day").cast("date")) == 3, "[").otherwise(body)
    root = work_dir(spark, "sidecars")
    land(_file(days, F.concat(F.lit("compaction-"), C("day"), F.lit("-events.json")), line), root)
    return _ranked(files.run_sidecars(spark, root).select("date", "daemon", "status", "rows_written"))


def station_list(spark, sf_dir):
    """Station list bodies (one per nation; two are no list) as the station table, in id order."""
    point = obj(type=txt("Point"), coordinates=arr(num(C("c_acctbal") / 1000), num(C("c_nationkey") * 1.5)))
    station = obj(station_id=txt(C("c_custkey")), longname=txt(C("c_name")), address=txt(C("c_mktsegment")), lines=txt("A, B"), the_geom=point)
    bodies = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.concat_ws(",", F.collect_list(station)).alias("all"))
    line = F.when(C("c_nationkey") < 2, F.concat(F.lit('{"stations":['), C("all"), F.lit("]}"))).otherwise(F.concat(F.lit("["), C("all"), F.lit("]")))
    root = work_dir(spark, "stations")
    land(_file(bodies, F.concat(F.lit("page"), C("c_nationkey").cast("string"), F.lit(".json")), line), root)
    return _ranked(monitoring.station_table(files.raw_payloads(spark, root, multi_line=True)))


def landed_pages(spark, sf_dir):
    """Pages of track rows: their elements, and the pages that hold no list, by reason."""
    key = C("p_partkey")
    row = obj(id=num(key), lines=txt("A"), size=num(C("p_size")))
    pages = table(spark, sf_dir, "part").groupBy(F.floor(key / 100).alias("page")).agg(F.concat_ws(",", F.collect_list(row)).alias("all"))
    line = (F.when(C("page") % 7 == 3, F.concat(F.lit("{"), C("all"))).when(C("page") % 7 == 5, F.lit('{"error": true}'))
            .otherwise(F.concat(F.lit("["), C("all"), F.lit("]"))))
    root = work_dir(spark, "pages")
    land(_file(pages, F.concat(F.lit("page"), C("page").cast("string"), F.lit(".json")), line), root)
    rows, rejected = files.list_pages(files.raw_payloads(spark, root, multi_line=True))
    good = rows.select(F.get_json_object("payload", "$.id").cast("long").alias("id"), F.get_json_object("payload", "$.size").cast("int").alias("size"),
                       F.lit(None).cast("string").alias("reason"), F.lit(1).cast("long").alias("n"))
    bad = rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(None).cast("long").alias("id"), F.lit(None).cast("int").alias("size"), "reason", "n")
    return good.unionByName(bad)


def landed_weather(spark, sf_dir):
    """Landed responses of two providers; one provider's folder is read."""
    root = work_dir(spark, "weather")
    body = obj(properties=obj(size=num(C("p_size")), name=txt(C("p_name"))))
    (table(spark, sf_dir, "part").select(
        C("p_partkey").cast("string").alias("grid_id"), body.alias("payload"), C("p_retailprice").alias("collected_at"),
        F.when(C("p_size") % 2 == 0, "nws").otherwise("open_meteo").alias("provider"))
     .write.partitionBy("provider").json(root))
    return files.weather_payloads(spark, root, "nws").select("grid_id", "payload", "collected_at")


def telemetry_appended(spark, sf_dir, turns: int = 3):
    """Telemetry rows that land in turns, appended by a stream that is started again each time."""
    rows = _telemetry(spark, sf_dir).select("event_id", "at", "kind", "daemon_class", "value")
    root = work_dir(spark, "appended")
    for turn in range(turns):
        rows.filter(C("event_id") % turns == turn).write.mode("append").parquet(f"{root}/landed")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/landed")
        append_events(stream, f"{root}/rows", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{root}/rows")


QUERIES = {
    "landed_telemetry": landed_telemetry,
    "landed_snapshots": landed_snapshots,
    "landed_states": landed_states,
    "landed_heartbeats": landed_heartbeats,
    "landed_runs": landed_runs,
    "station_list": station_list,
    "landed_pages": landed_pages,
    "landed_weather": landed_weather,
    "telemetry_appended": telemetry_appended,
}

_TELEMETRY = """t AS (SELECT *, 'd' || user_id % 3 AS daemon_class, CASE WHEN event_type = 'error' THEN 'error' ELSE 'span' END AS kind,
    epoch_us(ts) / 1e6 AS at_s FROM events)"""
_COLLECTORS = "c AS (SELECT user_id % 20 AS c, max(epoch_us(ts)) / 1e6 AS last, count(*) AS records FROM events GROUP BY 1)"

ORACLE = {
    "landed_telemetry": f"""WITH {_TELEMETRY} SELECT CASE WHEN event_id % 50 = 2 THEN 0 ELSE at_s END AS ts, kind, daemon_class,
        event_type AS name, kind = 'span' AS ok, value AS elapsed_ms FROM t WHERE event_id % 50 > 1""",
    "landed_snapshots": f"""WITH {_TELEMETRY}, days AS (SELECT daemon_class, date_trunc('day', ts) AS day,
            count(*) FILTER (kind = 'span') / count(*) AS rate, count(*) AS calls, max(value) AS p95 FROM t GROUP BY 1, 2)
        SELECT daemon_class AS daemon, rate AS success_rate, calls AS total_calls, p95 AS p95_latency_ms FROM days
        WHERE daemon_class <> 'd2' QUALIFY row_number() OVER (PARTITION BY daemon_class ORDER BY day DESC) = 1""",
    "landed_states": f"""WITH {_COLLECTORS} SELECT 'c' || c AS daemon, CASE WHEN c <> 7 THEN last END AS last_poll_timestamp,
        CASE WHEN c <> 7 THEN records END AS total_records_collected FROM c""",
    "landed_heartbeats": f"""WITH {_COLLECTORS} SELECT CASE WHEN c % 4 <> 0 THEN 'n' || c ELSE 'c' || c || '.heartbeat' END AS daemon,
        last AS timestamp, records AS pid FROM c WHERE c % 5 <> 3""",
    "landed_runs": """SELECT strftime(ts, '%Y-%m-%d') AS date, 'events' AS daemon,
        CASE WHEN count(*) % 2 = 0 THEN 'success' ELSE 'failed' END AS status, count(*) AS rows_written,
        row_number() OVER (ORDER BY strftime(ts, '%Y-%m-%d') DESC) - 1 AS place
        FROM events WHERE day(ts) <> 3 GROUP BY strftime(ts, '%Y-%m-%d')""",
    "station_list": """SELECT c_custkey::VARCHAR AS id, c_name AS name, c_mktsegment AS address, 'A, B' AS lines,
        c_nationkey * 1.5::DOUBLE AS latitude, c_acctbal / 1000 AS longitude,
        row_number() OVER (ORDER BY c_custkey::VARCHAR COLLATE "C") - 1 AS place FROM customer WHERE c_nationkey >= 2""",
    "landed_pages": """SELECT p_partkey AS id, p_size AS size, NULL::VARCHAR AS reason, 1::BIGINT AS n FROM part WHERE p_partkey // 100 % 7 NOT IN (3, 5)
        UNION ALL SELECT NULL, NULL, CASE WHEN p // 1 % 7 = 3 THEN 'page is not JSON' ELSE 'page is not a list' END, count(*)
        FROM (SELECT DISTINCT p_partkey // 100 AS p FROM part) WHERE p % 7 IN (3, 5) GROUP BY 3""",
    "landed_weather": """SELECT p_partkey::VARCHAR AS grid_id, '{"properties":{"size":' || p_size || ',"name":"' || p_name || '"}}' AS payload,
        p_retailprice AS collected_at FROM part WHERE p_size % 2 = 0""",
    "telemetry_appended": f"WITH {_TELEMETRY} SELECT event_id, at_s AS at, kind, daemon_class, value FROM t".replace("AS at,", 'AS "at",'),
}
