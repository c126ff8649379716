"""Runs, retention, stored partitions and journals; files go to the session's work folder."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from headway.plans import compaction, store
from headway.plans.compaction import Tables
from headway.session import work_dir
from headway.sources import files
from headway.sources.journals import day_folder, journal_fields, open_folder, read_journals
from workload.tables import events, newest, table

C = F.col
WINDOW_DAYS = 700


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("ts", C("o_orderdate").cast("timestamp"))


def _runs(spark, sf_dir):
    """Every order is a run: dataset = priority, status from the order status."""
    status = F.when(C("o_orderstatus") == "F", "failed").when(
        C("o_orderstatus") == "P", "partial").otherwise("success")
    return _orders(spark, sf_dir).select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"), C("o_orderpriority").alias("daemon"),
        status.alias("status"), "o_orderkey")


def run_summary(spark, sf_dir):
    return compaction.run_summary(_runs(spark, sf_dir), WINDOW_DAYS, newest(_orders(spark, sf_dir)))


def runs_with_drift(spark, sf_dir):
    """A stored day (one with an order that did not fail) is drifted when one is above 300000."""
    flags = _orders(spark, sf_dir).filter("o_orderstatus = 'O'").groupBy(
        C("o_orderpriority").alias("daemon"), F.date_format("ts", "yyyy-MM-dd").alias("date")
    ).agg(F.when(F.max("o_totalprice") > 300000, "DRIFT").otherwise("OK").alias("drift"))
    return compaction.runs_with_drift(_runs(spark, sf_dir), flags)


def retention_doomed(spark, sf_dir):
    """One folder per order; partial orders have a name that is no date."""
    orders = _orders(spark, sf_dir)
    name = F.concat(F.when(C("o_orderstatus") == "P", F.lit("date=x")).otherwise(F.lit("date=")),
                    F.date_format("ts", "yyyy-MM-dd"))
    folders = orders.select("o_orderkey", name.alias("name"))
    return store.doomed_partitions(folders, 400, newest(orders))


def pending_files(spark, sf_dir):
    paths = _orders(spark, sf_dir).select(
        F.concat(F.lit("journal_"), C("o_orderkey")).alias("path"), "o_orderstatus")
    return compaction.pending_files(
        paths.select("path"), paths.filter("o_orderstatus = 'F'"))


def partition_roundtrip(spark, sf_dir):
    """All events written by service day and read back from the folders."""
    root = work_dir(spark, "events")
    store.write_dataset(events(spark, sf_dir), root, "ts")
    return files.dataset(spark, root).groupBy(C("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("records"), F.min("event_id").alias("first_id"),
        F.count_if(C("request_timestamp") == C("ts")).alias("stamped"))


DAY = date(2024, 2, 1)
JOURNALS = 16
SLICE_DAYS = 15


def write_journals(spark, sf_dir, root, day=DAY, part=None, drifted=True):
    """All events as journal files by writer (user modulo 16) and slice of time, so that a
    file is bounded by its slice; even writers' as they are, odd ones' with the value as
    text.  Files of writer 5 lack their end mark, those of 6 have a damaged tail, those of 7
    a damaged header, and an empty file lies next to them."""
    folder = day_folder(root, "events", day)

    def write(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        filesystem, inner = open_folder(folder)
        filesystem.create_dir(inner, recursive=True)
        writers, sinks = {}, {}
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            for name in pc.unique(rows["journal"]).to_pylist():
                number = int(name[:3])
                part = rows.filter(pc.equal(rows["journal"], name)).drop_columns(["journal"])
                if number % 2 and drifted:
                    text = pc.if_else(pc.equal(part["event_type"], "error"), "n/a",
                                      part["value"].cast(pa.string()))
                    part = part.set_column(part.schema.get_field_index("value"), "value", text)
                if name not in writers:
                    sinks[name] = filesystem.open_output_stream(f"{inner}/journal_{name}.ipc")
                    writers[name] = pa.ipc.new_stream(sinks[name], part.schema)
                writers[name].write_table(part)
        for name, writer in writers.items():
            number = int(name[:3])
            if number not in (5, 6):
                writer.close()
            if number == 6:
                sinks[name].write(b"\xff\xff\xff\xff\x00\x01\x00\x00damaged")
            sinks[name].close()
            if number == 7:
                with filesystem.open_output_stream(f"{inner}/journal_{name}.ipc") as broken:
                    broken.write(b"not an arrow stream")
        yield pa.RecordBatch.from_pydict({"files": pa.array([len(writers)], pa.int64())})

    since = F.floor(F.unix_micros("ts") / (SLICE_DAYS * 86_400_000_000))
    source = events(spark, sf_dir).withColumn("journal", F.format_string("%03d_%d", C("user_id") % JOURNALS, since))
    if part is not None:  # the slices of even or of odd number
        source = source.filter(since % 2 == part)
    source.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "journal").mapInArrow(write, "files bigint").write.format(
        "noop").mode("overwrite").save()
    filesystem, inner = open_folder(folder)
    filesystem.open_output_stream(f"{inner}/journal_empty{'' if part is None else part}.ipc").close()


def _schema(spark, sf_dir):
    from pyspark.sql.types import MapType, StringType, StructField, StructType

    return StructType([*events(spark, sf_dir).schema,
                       StructField("_rescued", MapType(StringType(), StringType()))])


def journal_salvage(spark, sf_dir):
    root = work_dir(spark, "journals")
    write_journals(spark, sf_dir, root)
    rows, _ = read_journals(spark, root, "events", DAY, _schema(spark, sf_dir))
    return rows.select("event_id", "user_id", "value", C("_rescued")["value"].alias("rescued"),
                       F.unix_micros("ts").alias("us"))


def journal_status(spark, sf_dir):
    root = work_dir(spark, "journals")
    write_journals(spark, sf_dir, root)
    _, status = read_journals(spark, root, "events", DAY, _schema(spark, sf_dir))
    return status.select(F.element_at(F.split("path", "/"), -1).alias("file"), "status", "rows")


def journal_schemas(spark, sf_dir):
    root = work_dir(spark, "journals")
    write_journals(spark, sf_dir, root)
    return journal_fields(spark, root, "events", DAY).filter("name = 'value'").groupBy("type").agg(
        F.count(F.lit(1)).alias("files"))


def _compacted(spark, sf_dir):
    tables = Tables(work_dir(spark, "compaction"))
    write_journals(spark, sf_dir, tables.journals)
    registered = events(spark, sf_dir).schema
    compaction.save_registry(spark, tables, "events", registered)
    compaction.compact_day(spark, tables, "events", DAY, F.lit(DAY).cast("timestamp"))
    return tables


def compaction_run(spark, sf_dir):
    """Run record, drift verdict and archive list of a whole compaction."""
    tables = _compacted(spark, sf_dir)
    runs = spark.read.parquet(tables.runs)
    drifted = compaction.load_drift(spark, tables).select(
        "date", F.get_json_object("drift_summary", "$.breaking_fields[0].name").alias("drifted"))
    archived = spark.read.parquet(tables.archived).groupBy("date").agg(
        F.count(F.lit(1)).alias("archived"))
    return runs.join(drifted, "date").join(archived, "date").select(
        "date", "status", "journals_found", "journals_repaired", "journals_skipped",
        "rows_written", "drifted", "archived")


def compacted_rows(spark, sf_dir):
    tables = _compacted(spark, sf_dir)
    return _stored_events(spark, tables)


def _stored_events(spark, tables):
    return files.dataset(spark, tables.dataset("events")).select(
        C("date").cast("string").alias("date"), "event_id", "user_id", F.unix_micros("ts").alias("us"), "event_type", "value",
        C("_rescued")["value"].alias("rescued"))


def compact_after_promote(spark, sf_dir):
    """The stored day's schema is registered as the next version and another day compacted under it."""
    tables = _compacted(spark, sf_dir)
    compaction.promote_schema(spark, tables, "events")
    later = DAY + timedelta(days=1)
    write_journals(spark, sf_dir, tables.journals, later)
    compaction.compact_day(spark, tables, "events", later, F.lit(later).cast("timestamp"))
    return _stored_events(spark, tables)


def reprocess_day(spark, sf_dir):
    """Late journals complete a stored day, and the day is then compacted once more from the archive."""
    tables = Tables(work_dir(spark, "late"))
    compaction.save_registry(spark, tables, "events", events(spark, sf_dir).schema)
    for part in (0, 1):
        write_journals(spark, sf_dir, tables.journals, part=part)
        compaction.compact_day(spark, tables, "events", DAY, F.lit(DAY).cast("timestamp"))
    compaction.compact_day(spark, tables, "events", DAY, F.lit(DAY).cast("timestamp"), reprocess=True)
    return _stored_events(spark, tables)


def compact_nested_types(spark, sf_dir):
    """Columns of dates, lists and structs keep their types through journals and compaction."""
    tables = Tables(work_dir(spark, "nested"))
    source = _orders(spark, sf_dir).select(
        F.format_string("%03d_0", C("o_orderkey") % JOURNALS).alias("journal"), "o_orderkey",
        C("ts").cast("date").alias("ordered"), F.array("o_orderstatus", "o_orderpriority").alias("tags"),
        F.struct(C("o_custkey").alias("cust"), C("o_totalprice").alias("price")).alias("detail"))
    folder = day_folder(tables.journals, "orders", DAY)

    def write(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        filesystem, inner = open_folder(folder)
        filesystem.create_dir(inner, recursive=True)
        held = list(batches)
        rows = pa.Table.from_batches(held) if held else pa.table({"journal": pa.array([], pa.string())})
        for name in pc.unique(rows["journal"]).to_pylist():
            part = rows.filter(pc.equal(rows["journal"], name)).drop_columns(["journal"])
            with filesystem.open_output_stream(f"{inner}/journal_{name}.ipc") as sink, pa.ipc.new_stream(sink, part.schema) as out:
                out.write_table(part)
        yield pa.RecordBatch.from_pydict({"files": pa.array([rows.num_rows], pa.int64())})

    source.repartition(JOURNALS, "journal").mapInArrow(write, "files bigint").write.format("noop").mode("overwrite").save()
    compaction.compact_day(spark, tables, "orders", DAY, F.lit(DAY).cast("timestamp"))
    return files.dataset(spark, tables.dataset("orders")).select(
        "o_orderkey", F.date_format("ordered", "yyyy-MM-dd").alias("ordered"), F.array_join("tags", "|").alias("tags"),
        C("detail.cust").alias("cust"), C("detail.price").alias("price"))


def compaction_report(spark, sf_dir):
    """Runs of a day with drift and a day without any, with the flags of what is stored."""
    tables = _compacted(spark, sf_dir)
    plain, empty = DAY + timedelta(days=1), DAY + timedelta(days=2)
    write_journals(spark, sf_dir, tables.journals, plain, drifted=False)
    for day in (plain, empty):
        compaction.compact_day(spark, tables, "events", day, F.lit(day).cast("timestamp"))
    runs = spark.read.parquet(tables.runs)
    flags = compaction.stored_drift(runs, compaction.load_drift(spark, tables))
    return compaction.runs_with_drift(runs, flags).select("date", "status", "rows_written", "drift")


def footer_report(spark, sf_dir):
    """Footers of a folder per kind of event: errors' file is marked as drifted, one file is broken."""
    root = work_dir(spark, "footers")
    source = events(spark, sf_dir)
    for drifted in (True, False):
        rows = source.filter((C("event_type") == "error") == drifted)
        marked = rows.withMetadata("event_id", {"schema_drift": "true"}) if drifted else rows
        marked.repartition(4, "event_type").withColumn("kind", C("event_type")).write.mode("append").partitionBy("kind").parquet(root)
    filesystem, inner = open_folder(f"{root}/kind=broken")
    filesystem.create_dir(inner, recursive=True)
    with filesystem.open_output_stream(f"{inner}/part-broken.parquet") as sink:
        sink.write(b"PAR1 cut off")
    report = files.footer_report(spark, root)
    return report.withColumn("kind", F.regexp_extract("path", "kind=([^/]+)", 1)).groupBy("kind", "drift").agg(
        F.sum("num_rows").alias("rows_stored"), F.count_if("has_gap").alias("gaps"))


QUERIES = {
    "footer_report": footer_report,
    "run_summary": run_summary,
    "runs_with_drift": runs_with_drift,
    "retention_doomed": retention_doomed,
    "pending_files": pending_files,
    "partition_roundtrip": partition_roundtrip,
    "journal_salvage": journal_salvage,
    "journal_status": journal_status,
    "journal_schemas": journal_schemas,
    "compaction_run": compaction_run,
    "compacted_rows": compacted_rows,
    "compact_after_promote": compact_after_promote,
    "compact_nested_types": compact_nested_types,
    "compaction_report": compaction_report,
    "reprocess_day": reprocess_day,
}

_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'P' THEN 'partial' ELSE 'success' END"
_LAST = "(SELECT max(o_orderdate)::DATE FROM orders)"
_DAY = ("strftime((ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Chicago') - INTERVAL 3 HOUR,"
        " '%Y-%m-%d')")



def _stored(day):
    return f"""SELECT {day} AS date, event_id, user_id, epoch_us(ts) AS us, event_type,
        CASE WHEN user_id % {JOURNALS} % 2 = 0 OR event_type <> 'error' THEN value END AS value,
        CASE WHEN user_id % {JOURNALS} % 2 = 1 AND event_type = 'error' THEN 'n/a' END AS rescued
        FROM events WHERE user_id % {JOURNALS} <> 7"""


_FILE = f"printf('%03d_%d', user_id % {JOURNALS}, epoch_us(ts) // {SLICE_DAYS * 86_400_000_000})"

ORACLE = {
    "footer_report": """SELECT event_type AS kind, CASE WHEN event_type = 'error' THEN 'DRIFT' ELSE 'OK' END AS drift,
        count(*) AS rows_stored, 0::BIGINT AS gaps FROM events GROUP BY 1, 2
        UNION ALL SELECT 'broken', '?', NULL, 0""",
    "run_summary": f"""SELECT count(DISTINCT o_orderdate) AS days, count(*) AS runs,
        count(*) FILTER (o_orderstatus = 'F') AS failures FROM orders
        WHERE o_orderdate::DATE >= {_LAST} - {WINDOW_DAYS}""",
    "runs_with_drift": f"""WITH flags AS (SELECT o_orderpriority, o_orderdate,
        CASE WHEN max(o_totalprice) > 300000 THEN 'DRIFT' ELSE 'OK' END AS drift
        FROM orders WHERE o_orderstatus = 'O' GROUP BY 1, 2)
        SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderpriority AS daemon,
        {_STATUS} AS status, o_orderkey, coalesce(drift, '?') AS drift
        FROM orders LEFT JOIN flags USING (o_orderpriority, o_orderdate)""",
    "retention_doomed": f"""SELECT o_orderkey, 'date=' || strftime(o_orderdate, '%Y-%m-%d') AS name
        FROM orders WHERE o_orderstatus <> 'P' AND o_orderdate::DATE < {_LAST} - 400""",
    "pending_files": """SELECT 'journal_' || o_orderkey AS path FROM orders o WHERE NOT EXISTS
        (SELECT 1 FROM orders a WHERE a.o_orderkey = o.o_orderkey AND a.o_orderstatus = 'F')""",
    "partition_roundtrip": f"""SELECT {_DAY} AS date, count(*) AS records,
        min(event_id) AS first_id, count(*) AS stamped FROM events GROUP BY 1""",
    "journal_salvage": f"""SELECT event_id, user_id,
        CASE WHEN user_id % {JOURNALS} % 2 = 0 OR event_type <> 'error' THEN value END AS value,
        CASE WHEN user_id % {JOURNALS} % 2 = 1 AND event_type = 'error' THEN 'n/a' END AS rescued,
        epoch_us(ts) AS us FROM events WHERE user_id % {JOURNALS} <> 7""",
    "journal_status": f"""SELECT printf('journal_%s.ipc', {_FILE}) AS file,
        CASE user_id % {JOURNALS} WHEN 6 THEN 'repaired' WHEN 7 THEN 'skipped' ELSE 'clean' END
        AS status, count(*) FILTER (user_id % {JOURNALS} <> 7) AS rows FROM events GROUP BY 1, 2
        UNION ALL SELECT 'journal_empty.ipc', 'skipped', 0""",
    "journal_schemas": f"""SELECT CASE WHEN user_id % {JOURNALS} % 2 = 1 THEN 'string' ELSE 'double'
        END AS type, count(DISTINCT {_FILE}) AS files FROM events
        WHERE user_id % {JOURNALS} <> 7 GROUP BY 1""",
    "compaction_run": f"""SELECT '{DAY}' AS date, 'success' AS status,
        count(DISTINCT {_FILE}) + 1 AS journals_found,
        count(DISTINCT {_FILE}) FILTER (user_id % {JOURNALS} = 6) AS journals_repaired,
        count(DISTINCT {_FILE}) FILTER (user_id % {JOURNALS} = 7) + 1 AS journals_skipped,
        count(*) FILTER (user_id % {JOURNALS} <> 7) AS rows_written, 'value' AS drifted,
        count(DISTINCT {_FILE}) + 1 AS archived FROM events""",
    "compacted_rows": _stored(f"'{DAY}'"),
    "compact_after_promote": f"""{_stored(f"'{DAY}'")} UNION ALL {_stored(f"'{DAY + timedelta(days=1)}'")}""",
    "reprocess_day": _stored(f"'{DAY}'"),
    "compact_nested_types": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS ordered,
        o_orderstatus || '|' || o_orderpriority AS tags, o_custkey AS cust, o_totalprice AS price FROM orders""",
    "compaction_report": f"""SELECT '{DAY}' AS date, 'success' AS status,
        count(*) FILTER (user_id % {JOURNALS} <> 7) AS rows_written, 'DRIFT' AS drift FROM events
        UNION ALL SELECT '{DAY + timedelta(days=1)}', 'success', count(*) FILTER (user_id % {JOURNALS} <> 7), 'OK' FROM events
        UNION ALL SELECT '{DAY + timedelta(days=2)}', 'partial', 0, '?'""",
}
