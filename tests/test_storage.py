"""Drift rules, damaged journals, compaction, retention and landed files."""

import datetime as dt
import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from headway.operators import drift
from headway.plans import compaction, store
from headway.plans.compaction import Tables
from headway.sources import files
from headway.sources.journals import day_folder, journal_status

DAY = dt.date(2026, 2, 17)


def now():
    return F.lit(dt.datetime(2026, 2, 18, tzinfo=dt.UTC))


@pytest.mark.parametrize("old, new, verdict", [
    ([("a", "int64", True)], [("a", "string", True)], "breaking"),
    ([("a", "double", True)], [("a", "int64", True)], "breaking"),
    ([("a", "int32", True)], [("a", "int64", True)], "none"),
    ([("a", "int8", True)], [("a", "int64", True)], "none"),
    ([("a", "float", True)], [("a", "double", True)], "none"),
    ([("a", "int16", True)], [("a", "double", True)], "breaking"),
    ([("a", "int64", True)], [("a", "int64", False)], "breaking"),
    ([("a", "int64", True), ("b", "string", True)], [("b", "string", True), ("a", "int64", True)], "none"),
    ([("a", "int64", True), ("b", "string", True)], [("a", "int64", True)], "breaking"),
    ([("a", "int64", True)], [("a", "int64", True), ("c", "bool", True)], "additive"),
    ([("t", "timestamp[us, tz=UTC]", True)], [("t", "timestamp[us, tz=America/Chicago]", True)], "none"),
])
def test_classify_drift(spark, old, new, verdict):
    ddl = "name string, type string, nullable boolean"
    _, verdicts = drift.classify_drift(
        spark.createDataFrame(old, ddl),
        spark.createDataFrame(new, ddl).withColumn("file", F.lit("f")), ["file"])
    assert [tuple(r) for r in verdicts.collect()] == [("f", verdict)]


def test_conform_keeps_what_it_cannot_cast(spark):
    registry = StructType([StructField("n", LongType()), StructField("s", StringType())])
    frames = [spark.createDataFrame([("1",), ("x",)], "n string"),
              spark.createDataFrame([(2, "b", True)], "n int, s string, extra boolean")]
    rows = {(r.n, r.s, r.extra, (r._rescued or {}).get("n"))
            for r in drift.union_drifted(frames, registry).collect()}
    assert rows == {(1, None, None, None), (None, None, None, "x"), (2, "b", True, None)}


def stream_bytes(batches, close=True):
    sink = pa.BufferOutputStream()
    writer = pa.ipc.new_stream(sink, batches[0].schema)
    for batch in batches:
        writer.write_batch(batch)
    if close:
        writer.close()
    return sink.getvalue().to_pybytes()


def batches(values=pa.array([1, 2, 3])):
    return [pa.record_batch({"name": pa.array(["a", "b", "c"]), "value": values})] * 2


def put_journals(tables, **contents):
    from pathlib import Path

    folder = Path(day_folder(tables.journals, "readings", DAY))
    folder.mkdir(parents=True)
    for name, data in contents.items():
        (folder / f"journal_{name}.ipc").write_bytes(data)
    (folder / "other.txt").write_text("x")


def test_journal_salvage_statuses(spark, tmp_path):
    tables = Tables(str(tmp_path))
    whole = stream_bytes(batches())
    put_journals(tables, a=whole, b=stream_bytes(batches(), close=False),
                 c=whole[:int(len(whole) * 0.8)], d=b"garbage header", e=b"")
    got = {r.path.rsplit("_", 1)[1]: (r.status, r.rows)
           for r in journal_status(spark, tables.journals, "readings", DAY).collect()}
    assert got == {"a.ipc": ("clean", 6), "b.ipc": ("clean", 6), "c.ipc": ("repaired", 3),
                   "d.ipc": ("skipped", 0), "e.ipc": ("skipped", 0)}
    assert journal_status(spark, tables.journals, "readings", dt.date(2020, 1, 1)).count() == 0


def test_compaction_with_drift_archive_and_rerun(spark, tmp_path):
    tables = Tables(str(tmp_path))
    text = batches(pa.array(["4", "five", "6"]))
    put_journals(tables, a=stream_bytes(batches()), b=stream_bytes(text), c=b"")
    compaction.save_registry(spark, tables, "readings", StructType(
        [StructField("name", StringType()), StructField("value", LongType())]))
    run = compaction.compact_day(spark, tables, "readings", DAY, now())
    assert (run["status"], run["error"], run["rows_written"], run["journals_found"],
            run["journals_skipped"]) == ("success", None, 12, 3, 1)
    stored = spark.read.parquet(tables.dataset("readings"))
    assert stored.agg(F.sum("value")).first()[0] == 12 + 20
    assert [r[0] for r in stored.select(F.col("_rescued")["value"].alias("v")).filter(
        "v is not null").collect()] == ["five", "five"]
    events = spark.read.parquet(tables.drift_events).collect()
    assert json.loads(events[0].drift_summary)["breaking_fields"] == [
        {"name": "value", "old_type": "int64", "new_type": "string"}]
    assert spark.read.parquet(tables.archived).count() == 3
    again = compaction.compact_day(spark, tables, "readings", DAY, now())
    assert (again["status"], again["journals_found"]) == ("partial", 0)
    assert stored.count() == 12
    assert compaction.promote_schema(spark, tables, "readings") == 2
    assert spark.read.parquet(tables.runs).count() == 2


def test_late_journals_complete_the_day(spark, tmp_path):
    tables = Tables(str(tmp_path))
    day = dt.date(2026, 2, 17)
    put_journals(tables, a=stream_bytes(batches()))
    assert compaction.compact_day(spark, tables, "readings", day, now())["rows_written"] == 6
    late = f"{day_folder(tables.journals, 'readings', day)}/journal_late.ipc"
    with open(late, "wb") as f:
        f.write(stream_bytes(batches()[:1]))
    run = compaction.compact_day(spark, tables, "readings", day, now())
    assert (run["status"], run["rows_written"], run["journals_found"]) == ("success", 9, 2)
    assert spark.read.parquet(tables.dataset("readings")).count() == 9
    again = compaction.compact_day(spark, tables, "readings", day, now(), reprocess=True)
    assert (again["status"], again["rows_written"]) == ("success", 9)
    store.delete(spark, f"{tables.archive}/readings")
    with open(late, "wb") as f:
        f.write(stream_bytes(batches()[:1]))
    lost = compaction.compact_day(spark, tables, "readings", day, now())
    assert lost["status"] == "failed" and "archived journals are gone" in lost["error"]
    assert spark.read.parquet(tables.dataset("readings")).count() == 9


def test_widening_within_a_day_and_bootstrap(spark, tmp_path):
    tables = Tables(str(tmp_path))
    put_journals(tables, a=stream_bytes(batches(pa.array([1, 2, 3], pa.int32()))),
                 b=stream_bytes(batches(pa.array([2**40] * 3))))
    run = compaction.compact_day(spark, tables, "readings", DAY, now())
    assert (run["status"], run["rows_written"]) == ("success", 12)
    assert dict(spark.read.parquet(tables.dataset("readings")).dtypes)["value"] == "bigint"
    assert compaction.load_registry(spark, tables, "readings").count() == 2
    assert not compaction.bootstrap_registry(spark, tables, "readings", StructType())


def test_failed_run_is_recorded_and_keeps_journals(spark, tmp_path, monkeypatch):
    tables = Tables(str(tmp_path))
    put_journals(tables, a=stream_bytes(batches()))
    monkeypatch.setattr(store, "stored_rows", lambda *a: 0)
    run = compaction.compact_day(spark, tables, "readings", DAY, now())
    assert run["status"] == "failed" and "row count mismatch" in run["error"]
    assert journal_status(spark, tables.journals, "readings", DAY).count() == 1
    assert spark.read.parquet(tables.runs).first().status == "failed"


def test_prune_keeps_the_cutoff_day(spark, tmp_path):
    for name in ("date=2026-02-10", "date=2026-02-11", "date=2026-02-17", "date=soon"):
        (tmp_path / name).mkdir()
    gone = store.prune(spark, str(tmp_path), 7, now())
    assert [g.rsplit("/", 1)[1] for g in gone] == ["date=2026-02-10"]
    assert not (tmp_path / "date=2026-02-10").exists() and (tmp_path / "date=soon").exists()


def test_write_by_service_day_and_pruned_read(spark, tmp_path):
    rows = [(1, dt.datetime(2026, 1, 15, 8, 59, tzinfo=dt.UTC)), (2, dt.datetime(2026, 1, 15, 9, tzinfo=dt.UTC))]
    store.write_dataset(spark.createDataFrame(rows, "id int, ts timestamp"), str(tmp_path), "ts")
    read = files.dataset(spark, str(tmp_path)).filter("date = '2026-01-14'")
    assert [r.id for r in read.collect()] == [1]
    assert "PartitionFilters: [isnotnull(date" in read._jdf.queryExecution().toString()


def test_landed_files(spark, tmp_path):
    (tmp_path / "A.events.jsonl").write_text(
        '{"ts":1.5,"kind":"error","daemon_class":"A","name":"x"}\n\n{bad\n{"kind":"span","name":"y.error"}\n')
    (tmp_path / "A.json").write_text('{\n "last_poll_timestamp": 5.0,\n "total_records_collected": 3}')
    (tmp_path / "B.json").write_text("not json")
    (tmp_path / "A.heartbeat.json").write_text('{"timestamp": 7.5, "pid": 1}')
    (tmp_path / "last_alert.json").write_text('{"last_alert": 1}')
    window = {"overall_success_rate": 0.75, "total_calls": 4, "per_span_metrics": {
        "a": {"p95_ms": 5.0}, "b": {"p95_ms": 9.0}}}
    snapshots = [{"ts": t, "daemon_class": "A", "metrics": {"time_window_metrics": {"last_hour": w, "last_24h": {}}}}
                 for t, w in ((1.0, {}), (2.0, window))]
    (tmp_path / "A.metrics.jsonl").write_text("\n".join(map(json.dumps, snapshots)))
    (tmp_path / "compaction-2026-02-16-x.json").write_text('{"date": "2026-02-16", "daemon": "x", "status": "failed"}')
    (tmp_path / "compaction-2026-02-17-x.json").write_text('{"date": "2026-02-17", "daemon": "x", "status": "success"}')
    root = str(tmp_path)
    assert sorted(r.ts for r in files.telemetry_events(spark, root).collect()) == [0.0, 1.5]
    state = {r.daemon: r.last_poll_timestamp for r in files.collector_state(spark, root).collect()}
    assert state["A"] == 5.0 and state["B"] is None and "last_alert" not in state
    assert [tuple(r) for r in files.heartbeats(spark, root).collect()] == [("7.5", "A.heartbeat", 1)]
    found = files.latest_snapshot_metrics(files.metrics_snapshots(spark, root)).collect()
    assert [(r.daemon, r.success_rate, r.total_calls, r.p95_latency_ms) for r in found] == [("A", 0.75, 4, 9.0)]
    assert files.latest_snapshot_metrics(files.metrics_snapshots(spark, root), "last_24h").count() == 0
    runs = files.run_sidecars(spark, root)
    assert [r.date for r in runs.collect()] == ["2026-02-17", "2026-02-16"]
    summary = compaction.run_summary(runs, 7, now()).first()
    assert tuple(summary) == (2, 2, 1)


def test_parquet_footers(spark, tmp_path):
    gap = {"is_gap": True, "gap_end_timestamp": 5.0, "gap_reason": "downtime", "missed_poll_cycles": 2}
    table = pa.table({"a": pa.array([1, 2])}, schema=pa.schema([pa.field("a", pa.int64(), nullable=False)]))
    pq.write_table(table.replace_schema_metadata({"gap_metadata": json.dumps(gap), "schema_drift": "true"}),
                   tmp_path / "a.parquet")
    pq.write_table(table, tmp_path / "b.parquet")
    (tmp_path / "c.parquet").write_text("broken")
    paths = spark.createDataFrame([(str(tmp_path / f"{n}.parquet"),) for n in "abcd"], "path string")
    footers = files.parquet_footers(paths)
    rows = {r.path[-9]: r for r in footers.collect()}
    assert rows["a"].num_rows == 2 and rows["a"].fields[0].nullable is False and rows["d"].num_rows is None
    assert [r.gap_reason for r in files.footer_gaps(footers).collect()] == ["downtime"]
    assert {r.path[-9]: r.drift for r in files.footer_drift(footers).collect()} == {
        "a": "DRIFT", "b": "OK", "c": "?", "d": "?"}


def test_pages_and_raw_payloads(spark, tmp_path):
    (tmp_path / "p1.json").write_text('[{"a":1},{"a":2}]')
    (tmp_path / "p2.json").write_text("[]")
    pages = files.raw_payloads(spark, str(tmp_path), multi_line=True)
    assert sorted(r.payload for r in files.list_rows(pages).collect()) == ['{"a":1}', '{"a":2}']


def test_a_failed_publish_leaves_the_day(spark, tmp_path):
    root = str(tmp_path / "data")
    store.publish_day(spark.range(5), root, "2026-02-17")
    with pytest.raises(RuntimeError, match="row count mismatch"):
        store.publish_day(spark.range(9), root, "2026-02-17", expected=10)
    broken = spark.range(9).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        store.publish_day(broken, root, "2026-02-17")
    assert store.stored_rows(spark, root, "2026-02-17") == 5
    assert store.publish_day(spark.range(7), root, "2026-02-17", expected=7) == (7, 5)
    assert [p.name for p in (tmp_path / "data").iterdir()] == ["date=2026-02-17"]


def test_a_day_after_promotion_and_nested_types(spark, tmp_path):
    tables = Tables(str(tmp_path))
    batch = pa.record_batch({"d": pa.array([dt.date(2026, 1, 2), None]), "l": pa.array([["a"], []]),
                             "s": pa.array([{"x": 1}, None]), "n": pa.array([1, 2])})
    for i, day in enumerate((DAY, DAY + dt.timedelta(days=1))):
        folder = day_folder(tables.journals, "readings", day)
        tmp_path.joinpath(folder).mkdir(parents=True)
        with open(f"{folder}/journal_a.ipc", "wb") as f:
            f.write(stream_bytes([batch]))
        run = compaction.compact_day(spark, tables, "readings", day, now())
        assert (run["status"], run["error"]) == ("success", None)
        assert compaction.promote_schema(spark, tables, "readings") == 2 + i
    assert not store.exists(spark, tables.drift_events)
    rows = spark.read.parquet(tables.dataset("readings"))
    assert dict(rows.dtypes)["d"] == "date" and dict(rows.dtypes)["l"] == "array<string>"
    assert rows.filter("n = 1 and d = date'2026-01-02' and l[0] = 'a' and s.x = 1").count() == 2
    assert "_rescued" not in {r.name for r in compaction.load_registry(spark, tables, "readings").collect()}


def test_bad_pages_are_rejected_with_a_reason(spark):
    pages = spark.createDataFrame([('[{"a":1}]',), ('{"a":1}',), ("nope",), (None,), ("[]",)], "payload string")
    rows, rejected = files.list_pages(pages)
    assert [r.payload for r in rows.collect()] == ['{"a":1}']
    assert sorted(r.reason for r in rejected.collect()) == ["empty page", "page is not JSON", "page is not a list"]
