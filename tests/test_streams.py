"""State survives between runs of a stream; batch and stream agree."""

import datetime as dt
import json

from headway.operators.gaps import detect_gaps
from headway.streaming import polls
from headway.streaming.stateful import alerts_to_send_stream, detect_gaps_stream
from headway.streaming.telemetry import append_events

T0 = 1_700_000_000


def land(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def at(offset):
    return dt.datetime.fromtimestamp(T0 + offset, dt.UTC)


def drain(spark, stream, out):
    append_events(stream, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def test_gap_state_across_restarts(spark, tmp_path):
    schema, source = "dataset string, ts timestamp", str(tmp_path / "in")
    parts = [[("a", at(o)) for o in (0, 15, 100)] + [("b", at(5))], [("a", at(700)), ("a", at(715)), ("b", at(6))]]
    for part in parts:
        land(spark, source, part, schema)
        stream = spark.readStream.schema(schema).parquet(source)
        got = drain(spark, detect_gaps_stream(stream, "ts", ["dataset"], 15), str(tmp_path / "out"))
    batch = detect_gaps(spark.read.parquet(source), "ts", ["dataset"], 15).filter("is_gap")
    assert got.count() == 2
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_cooldown_state_across_restarts(spark, tmp_path):
    schema, source = "key string, ts timestamp, should_alert boolean", str(tmp_path / "in")
    for part in ([("k", at(0), True), ("k", at(600), True), ("k", at(601), False)],
                 [("k", at(602), True), ("k", at(1203), True), ("n", at(0), None)]):
        land(spark, source, part, schema)
        stream = spark.readStream.schema(schema).parquet(source)
        got = drain(spark, alerts_to_send_stream(stream, ["key"], "ts", 600), str(tmp_path / "out"))
    sent = sorted(int(r.ts.timestamp()) - T0 for r in got.filter("send").collect())
    assert sent == [0, 602, 1203] and got.count() == 6


def test_poll_stream_partitions_by_own_service_day(spark, tmp_path):
    (tmp_path / "in").mkdir()
    train = {"rn": "1", "lat": "1", "lon": "2"}
    lines = [json.dumps({"payload": json.dumps({"ctatt": {"route": [{"@name": "red", "train": train}]}}),
                         "poll_timestamp": stamp})
             for stamp in ("2026-01-15T08:59:59Z", "2026-01-15T09:00:00Z", "2026-01-15T09:00:00Z")]
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    for dedup, trains in ((None, 3), ("1 hour", 2)):
        out = str(tmp_path / f"out-{trains}")
        good, _ = polls.positions(polls.landed_payloads(spark, str(tmp_path / "in")), dedup)
        polls.append(good, "poll_timestamp", f"{out}/rows", f"{out}/check", interval=None).awaitTermination()
        rows = spark.read.parquet(f"{out}/rows")
        assert rows.count() == trains and rows.filter("year = 2026 and month = 1 and day = 14").count() == 1


def test_late_polls_are_told_and_move_nothing(spark, tmp_path):
    schema, source = "dataset string, ts timestamp", str(tmp_path / "in")
    parts = [[("a", at(0)), ("a", at(100))], [("a", at(50)), ("a", at(100)), ("a", at(115)), ("b", at(7))], [("b", at(1)), ("a", at(400))]]
    for part in parts:
        land(spark, source, part, schema)
        stream = spark.readStream.schema(schema).parquet(source)
        got = drain(spark, detect_gaps_stream(stream, "ts", ["dataset"], 15, with_late=True), str(tmp_path / "out"))
    shown = sorted((r.dataset, int(r.ts.timestamp()) - T0, r.is_late, r.is_gap) for r in got.collect())
    assert shown == [("a", 50, True, False), ("a", 100, False, True), ("a", 400, False, True), ("b", 1, True, False)]
