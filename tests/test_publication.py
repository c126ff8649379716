"""No path may lose a stored day, count drift twice or store a streamed row twice."""

import datetime as dt

import pyarrow as pa
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from headway.plans import compaction, store
from headway.plans.compaction import Tables
from headway.plans.streamed import committed, due_days, publish_streamed, taken_files
from headway.streaming import polls
from test_storage import batches, now, put_journals, stream_bytes

DAY = "2026-02-17"


class Failing:
    """A filesystem whose renames fail where told: by False or by an error."""

    def __init__(self, inner, fails):
        self.inner, self.fails = inner, fails

    def __getattr__(self, name):
        return getattr(self.inner, name)

    def rename(self, source, target):
        for part in self.fails:
            if part in source.toString():
                return False
        return self.inner.rename(source, target)


def failing(monkeypatch, *parts):
    whole = store._path
    monkeypatch.setattr(store, "_path", lambda spark, path: (lambda f, p: (Failing(f, parts), p))(*whole(spark, path)))


def test_failed_renames_lose_no_day(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "data")
    store.publish_day(spark.range(5), root, DAY)
    # The new day cannot take its place: the old one goes back.
    failing(monkeypatch, "_staged-")
    with pytest.raises(OSError, match="cannot publish"):
        store.publish_day(spark.range(7), root, DAY)
    assert store.stored_rows(spark, root, DAY) == 5
    monkeypatch.undo()
    # Nor can the old one go back: it waits aside and the next publication restores it first.
    failing(monkeypatch, "_staged-", "_replaced")
    with pytest.raises(OSError, match="the day as it was is in"):
        store.publish_day(spark.range(7), root, DAY)
    assert store.stored_rows(spark, root, DAY) == 0
    with pytest.raises(OSError, match="cannot put back"):
        store.publish_day(spark.range(7), root, DAY)
    monkeypatch.undo()
    assert spark.read.parquet(f"{root}/_replaced/date={DAY}").count() == 5
    assert store.publish_day(spark.range(7), root, DAY) == (7, 5)
    assert [p.name for p in (tmp_path / "data").iterdir()] == [f"date={DAY}"]


def test_setting_aside_fails_and_leftovers_go(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "data")
    store.publish_day(spark.range(5), root, DAY)
    failing(monkeypatch, f"/date={DAY}")
    with pytest.raises(OSError, match="cannot set"):
        store.publish_day(spark.range(7), root, DAY)
    monkeypatch.undo()
    assert store.stored_rows(spark, root, DAY) == 5
    # A copy left over beside a live day: the live day is the newer one.
    spark.range(3).write.parquet(f"{root}/_replaced/date={DAY}")
    assert store.restore_day(spark, root, DAY) is False
    assert store.stored_rows(spark, root, DAY) == 5 and not store.exists(spark, f"{root}/_replaced")
    spark.range(3).write.parquet(f"{root}/_replaced/date=2026-02-18")
    assert store.restore_day(spark, root, "2026-02-18") is True
    assert store.stored_rows(spark, root, "2026-02-18") == 3


def test_errors_of_a_filesystem_count_as_failed_renames(spark, tmp_path):
    filesystem, here = store._path(spark, str(tmp_path))

    class Raises:
        def rename(self, *_):
            raise Py4JJavaError("no", spark.sparkContext._jvm.java.io.IOException("no"))

    assert store._renamed(Raises(), here, here) is False


def test_drift_is_recorded_with_the_publication(spark, tmp_path, monkeypatch):
    tables = Tables(str(tmp_path))
    text = batches(pa.array(["4", "five", "6"]))
    put_journals(tables, a=stream_bytes(batches()), b=stream_bytes(text))
    compaction.save_registry(spark, tables, "readings", StructType(
        [StructField("name", StringType()), StructField("value", LongType())]))
    assert compaction.load_drift(spark, tables).count() == 0
    day = dt.date.fromisoformat(DAY)
    publish = store.publish_day

    def breaks(*_):
        raise OSError("disk")

    monkeypatch.setattr(store, "publish_day", breaks)
    run = compaction.compact_day(spark, tables, "readings", day, now())
    assert run["status"] == "failed" and compaction.load_drift(spark, tables).count() == 0
    monkeypatch.setattr(store, "publish_day", publish)
    for again in (False, True):
        run = compaction.compact_day(spark, tables, "readings", day, now(), reprocess=again)
        assert run["status"] == "success"
        assert compaction.load_drift(spark, tables).select("dataset", "date").collect() == [("readings", DAY)]
    runs = spark.read.parquet(tables.runs)
    flags = compaction.stored_drift(runs, compaction.load_drift(spark, tables)).collect()
    assert [(r.date, r.drift) for r in flags] == [(DAY, "DRIFT")]
    # The registered schema takes the text: nothing drifts any more, and the day says so.
    compaction.record_drift(spark, tables, "readings", day, None)
    assert compaction.load_drift(spark, tables).count() == 0


SCHEMA = StructType([StructField("id", LongType()), StructField("at", LongType())])


def streamed(spark, root, rows):
    """Polls (id, seconds after the start of the service day) land and the stream takes them."""
    start = int(dt.datetime(2026, 2, 17, 9, tzinfo=dt.timezone.utc).timestamp())
    frame = spark.createDataFrame(rows, "id long, at long").withColumn("ts", F.timestamp_seconds(F.col("at") + start))
    frame.write.mode("append").parquet(f"{root}/landed")
    stream = spark.readStream.schema(frame.schema).parquet(f"{root}/landed")
    polls.append(stream, "ts", f"{root}/rows", f"{root}/checkpoint", interval=None).awaitTermination()
    return frame.schema


def test_streamed_days_are_stored_once(spark, tmp_path):
    tables, root = Tables(str(tmp_path / "lake")), str(tmp_path / "sink")
    hour, day = 3600, 86400
    schema = streamed(spark, root, [(i, i * hour) for i in range(20)])
    publish = lambda: publish_streamed(spark, tables, "polls", f"{root}/rows", schema, "ts")
    stored = lambda: sorted((r.date, r.id) for r in spark.read.parquet(tables.dataset("polls")).select(
        F.col("date").cast("string"), "id").collect())
    assert publish() == []  # no day is over
    # What a killed query leaves: a file that no commit names.
    spark.createDataFrame([(99, 0)], "id long, at long").withColumn("ts", F.timestamp_seconds(F.lit(1771318800))) \
        .coalesce(1).write.mode("append").parquet(f"{root}/rows/year=2026/month=02/day=17")
    schema = streamed(spark, root, [(100 + i, day + i * hour) for i in range(3)])
    first = publish()
    assert [(r["date"], r["status"], r["rows_written"]) for r in first] == [(DAY, "success", 20)]
    assert stored() == [(DAY, i) for i in range(20)]
    assert publish() == []
    # Late polls of the closed day make it due again; polls of the open one do not.
    streamed(spark, root, [(50, 5), (103, day + 4 * hour)])
    rows = committed(spark, f"{root}/rows", schema)
    assert due_days(spark, tables, "polls", rows, "ts", 3600) == [DAY]
    assert [r["rows_written"] for r in publish()] == [21]
    assert stored() == sorted([(DAY, i) for i in range(20)] + [(DAY, 50)])
    # A run that broke off before its list of files was written repeats itself, to the same rows.
    store.delete(spark, tables.streamed)
    assert [r["rows_written"] for r in publish()] == [21] and len(stored()) == 21
    assert taken_files(spark, tables).count() == committed(spark, f"{root}/rows", schema).filter(
        F.col("date") == DAY).select("path").distinct().count()
    streamed(spark, root, [(200, 2 * day + 2 * hour)])
    assert [r["date"] for r in publish()] == ["2026-02-18"]
    assert spark.read.parquet(tables.runs).filter("status = 'success'").count() == 4


def test_a_failed_publication_is_recorded_and_tried_again(spark, tmp_path, monkeypatch):
    tables, root = Tables(str(tmp_path / "lake")), str(tmp_path / "sink")
    schema = streamed(spark, root, [(1, 0), (2, 2 * 86400)])
    monkeypatch.setattr(store, "publish_day", lambda *_: 1 / 0)
    run = publish_streamed(spark, tables, "polls", f"{root}/rows", schema, "ts")
    assert [r["status"] for r in run] == ["failed"] and "ZeroDivision" in run[0]["error"]
    monkeypatch.undo()
    assert [r["status"] for r in publish_streamed(spark, tables, "polls", f"{root}/rows", schema, "ts")] == ["success"]


def test_dedup_state_shrinks(spark, tmp_path):
    source, start = str(tmp_path / "landed"), dt.datetime(2026, 2, 17, tzinfo=dt.timezone.utc)
    states, total = [], 0
    for turn in range(3):
        rows = [(i, start + dt.timedelta(hours=10 * turn, minutes=i % 60)) for i in range(1000 * turn, 1000 * turn + 300)]
        frame = spark.createDataFrame(rows + rows[:50], "id long, ts timestamp")
        frame.write.mode("append").parquet(source)
        total += len(rows)
        kept = polls.deduplicated(spark.readStream.schema(frame.schema).parquet(source), ["id"], "ts", "1 hour")
        query = kept.writeStream.format("parquet").option("path", str(tmp_path / "rows")).option(
            "checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        query.awaitTermination()
        states += [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    got = spark.read.parquet(str(tmp_path / "rows"))
    assert (got.count(), got.select("id").distinct().count()) == (total, total)
    # Keys of earlier turns are gone: state holds one turn, not all that was ever seen.
    assert max(states) <= 600 and states[-1] <= 300
