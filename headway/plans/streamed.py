"""Days of a streamed sink into the daily dataset, each exactly as committed."""

from __future__ import annotations

import time
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from headway.functions.clock import service_date
from headway.plans import store
from headway.plans.compaction import Tables
from headway.schemas import COMPACTION_RUN

_TAKEN = "path string, dataset string, date string"
_PARTITIONS = ("year", "month", "day")


def committed(spark: SparkSession, sink: str, schema: StructType) -> DataFrame:
    """Rows of a file sink with their service ``date`` and file ``path``.

    Spark reads such a folder by the sink's commit log: files of a batch that was never
    committed, as a killed query leaves them, are not seen.
    """
    given = StructType([*schema, *[StructField(p, StringType()) for p in _PARTITIONS]])
    return (spark.read.schema(given).parquet(sink)
            .withColumn("path", F.col("_metadata.file_path"))
            .withColumn("date", F.concat_ws("-", *_PARTITIONS)).drop(*_PARTITIONS))


def taken_files(spark: SparkSession, tables: Tables) -> DataFrame:
    """Files of sinks that the stored days hold: path, dataset, date."""
    if not store.exists(spark, tables.streamed):
        return spark.createDataFrame([], _TAKEN)
    return spark.read.schema(_TAKEN).parquet(tables.streamed)


def due_days(spark: SparkSession, tables: Tables, dataset: str, rows: DataFrame, ts: str,
             lateness_seconds: float) -> list[str]:
    """Closed days with files that the stored day lacks; as many as days, not as data.

    A day is closed when a poll later than its end by ``lateness_seconds`` is committed.
    Files that come for a closed day make it due again.
    """
    wait = F.make_dt_interval(secs=F.lit(float(lateness_seconds)))
    open_day = rows.select(service_date(F.max(ts) - wait).cast("string").alias("d")).first()["d"]
    if open_day is None:
        return []
    taken = taken_files(spark, tables).filter(F.col("dataset") == dataset).select("path")
    files = rows.filter(F.col("date") < open_day).select("date", "path").distinct()
    return [r.date for r in files.join(taken, "path", "left_anti").select("date").distinct().orderBy("date").collect()]


def publish_streamed(spark: SparkSession, tables: Tables, dataset: str, sink: str, schema: StructType, ts: str,
                     lateness_seconds: float = 3600.0) -> list[dict]:
    """Publish every due day of a sink and return the run records, which are stored as well.

    A day is always published whole, from all files that the commit log holds for it, and
    verified by their rows; afterwards its list of files is replaced.  A run that breaks
    off in between publishes the same rows again, so each committed row is stored once.
    """
    rows = committed(spark, sink, schema)
    return [_publish(spark, tables, dataset, rows, day)
            for day in due_days(spark, tables, dataset, rows, ts, lateness_seconds)]


def _publish(spark: SparkSession, tables: Tables, dataset: str, rows: DataFrame, day: str) -> dict:
    started = time.monotonic()
    run = dict(date=day, daemon=dataset, status="failed", journals_found=0, journals_repaired=0, journals_skipped=0,
               rows_written=0, upload_bytes=0, elapsed_seconds=0.0, error=None)
    try:
        date.fromisoformat(day)
        own = rows.filter(F.col("date") == day)
        # Rows by file: what is verified and what is listed are the same files.
        files = own.groupBy("path").agg(F.count(F.lit(1)).alias("n")).persist()
        try:
            found = files.agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("n")).first()
            out = tables.dataset(dataset)
            run["journals_found"] = found["files"]
            run["rows_written"], _ = store.publish_day(own.drop("path"), out, day, found["n"])
            run["upload_bytes"] = store.day_bytes(spark, out, day)
            (files.select("path").coalesce(1).write.mode("overwrite")
             .parquet(f"{tables.streamed}/dataset={dataset}/date={day}"))
        finally:
            files.unpersist()
        run["status"] = "success"
    except Exception as exc:  # the run record carries the failure
        run.update(status="failed", error=f"{type(exc).__name__}: {exc}")
    finally:
        run["elapsed_seconds"] = time.monotonic() - started
        spark.createDataFrame([tuple(run[f.name] for f in COMPACTION_RUN)], COMPACTION_RUN) \
            .write.mode("append").parquet(tables.runs)
    return run
