"""Daily compaction of a dataset's journals into one verified partition."""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import date

from pyspark.errors import ParseException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    BooleanType, ByteType, DoubleType, FloatType, IntegerType, LongType, MapType, ShortType,
    StringType, StructField, StructType, TimestampType, _parse_datatype_string,
)

from headway.operators import drift
from headway.operators.ordered import latest_per_key
from headway.plans import store
from headway.schemas import COMPACTION_RUN, DATASETS
from headway.sources.journals import (
    journal_fields, list_archived, list_journals, read_journals,
)

_SPARK_TYPES = {
    "int8": ByteType(), "int16": ShortType(), "int32": IntegerType(), "int64": LongType(),
    "float": FloatType(), "double": DoubleType(), "bool": BooleanType(), "string": StringType(),
}
_RANK = ["int8", "int16", "int32", "int64", "float", "double"]


def spark_type(names: Sequence[str]):
    """Type that holds all the given types: the widest number, else text.

    Names are Arrow's for plain types and Spark's for dates, decimals, binaries and nested types.
    """
    plain = {n.split(",")[0].rstrip("]") for n in names}
    if all(n in _RANK for n in names):
        return _SPARK_TYPES[max(names, key=_RANK.index)]
    if len(plain) == 1 and next(iter(plain)).startswith("timestamp["):
        return TimestampType()
    if len(set(names)) > 1:
        return StringType()
    return _SPARK_TYPES.get(names[0]) or _parsed(names[0])


def _parsed(name: str):
    """Type of one name of ``arrow_type_name``; text where Spark has no such type."""
    try:
        return _parse_datatype_string(name)
    except ParseException:
        return StringType()


class Tables:
    """Folders of one installation; ``root`` is any Hadoop filesystem URI."""

    def __init__(self, root: str):
        root = root.rstrip("/")
        self.journals = f"{root}/journals"
        self.raw = f"{root}/raw"
        self.archive = f"{root}/archive"
        self.registry = f"{root}/schema_registry"
        self.drift_events = f"{root}/drift_events"
        self.runs = f"{root}/compaction_runs"
        self.archived = f"{root}/archived_files"
        self.streamed = f"{root}/streamed_files"

    def dataset(self, name: str) -> str:
        return f"{self.raw}/{name}"


REGISTRY_DDL = ("dataset string, version bigint, name string, type string, nullable boolean")


def load_registry(spark: SparkSession, tables: Tables, dataset: str) -> DataFrame | None:
    """Fields of the newest registered version, None when nothing is registered."""
    if not store.exists(spark, tables.registry):
        return None
    rows = spark.read.schema(REGISTRY_DDL).parquet(tables.registry).filter(
        F.col("dataset") == dataset)
    newest = rows.select(F.max("version")).scalar()
    found = rows.filter(F.col("version") == newest)
    return None if found.isEmpty() else found.drop("version", "dataset")


def save_registry(spark: SparkSession, tables: Tables, dataset: str, schema: StructType) -> int:
    """Register the next version of a dataset's schema."""
    version = 1
    if store.exists(spark, tables.registry):
        last = spark.read.schema(REGISTRY_DDL).parquet(tables.registry).filter(
            F.col("dataset") == dataset).agg(F.max("version").alias("v")).first()["v"]
        version = (last or 0) + 1
    fields = drift.schema_fields(spark, schema, dataset=dataset).withColumn(
        "version", F.lit(version).cast("long"))
    fields.select("dataset", "version", "name", "type", "nullable").coalesce(1).write.mode(
        "append").parquet(tables.registry)
    return version


def bootstrap_registry(spark: SparkSession, tables: Tables, dataset: str,
                       schema: StructType) -> bool:
    """Register a first version unless there is one."""
    if load_registry(spark, tables, dataset) is not None:
        return False
    save_registry(spark, tables, dataset, schema)
    return True


def promote_schema(spark: SparkSession, tables: Tables, dataset: str) -> int | None:
    """Register the schema of the newest stored day; None when nothing is stored."""
    newest = (
        store.partitions(spark, tables.dataset(dataset)).select(F.max("path")).first()[0])
    if newest is None:
        return None
    stored = spark.read.parquet(newest).schema
    return save_registry(spark, tables, dataset, StructType([f for f in stored if f.name != drift.RESCUED]))


def _target_schema(registry: Sequence, observed: Sequence) -> StructType:
    """Registry columns, then new ones; widened within the day where only that differs.

    Both arguments are field lists of a schema, so their size is a column count.
    """
    seen: dict[str, list[str]] = {}
    for row in observed:
        seen.setdefault(row["name"], []).append(row["type"])
    fields = []
    for row in registry:
        wanted = [row["type"]]
        wider = [t for t in seen.get(row["name"], []) if t in _RANK and row["type"] in _RANK
                 and (row["type"], t) in _WIDENING]
        fields.append(StructField(row["name"], spark_type(wanted + wider)))
    known = {row["name"] for row in registry}
    fields += [StructField(n, spark_type(t)) for n, t in sorted(seen.items()) if n not in known]
    return StructType([*fields, StructField(drift.RESCUED, MapType(StringType(), StringType()))])


def _widening_pairs() -> set[tuple[str, str]]:
    from headway.functions.status import WIDENING

    return set(WIDENING)


_WIDENING = _widening_pairs()


def compact_day(spark: SparkSession, tables: Tables, dataset: str, day: date, as_of: Column,
                retention_days: int = 7, reprocess: bool = False) -> dict:
    """Compact one day and return its run record, which is always stored as well.

    Journals move to the archive only after the written rows were verified.  Late
    journals are compacted together with the archived ones, so the day is replaced
    by the whole of it; once the archive has expired, only ``reprocess`` replaces
    a stored day.  ``reprocess`` also compacts a day without new journals again.
    """
    started = time.monotonic()
    run = dict(date=day.isoformat(), daemon=dataset, status="failed", journals_found=0,
               journals_repaired=0, journals_skipped=0, rows_written=0, upload_bytes=0,
               elapsed_seconds=0.0, error=None)
    try:
        _compact(spark, tables, dataset, day, as_of, retention_days, reprocess, run)
    except Exception as exc:  # the run record carries the failure
        run.update(status="failed", error=f"{type(exc).__name__}: {exc}")
    finally:
        run["elapsed_seconds"] = time.monotonic() - started
        spark.createDataFrame([tuple(run[f.name] for f in COMPACTION_RUN)], COMPACTION_RUN) \
            .write.mode("append").parquet(tables.runs)
    return run


def run_counters(status: DataFrame) -> DataFrame:
    """Found, repaired and skipped files (one row)."""
    state = F.col("status")
    return status.agg(
        F.count(F.lit(1)).alias("journals_found"),
        F.count_if(state == "repaired").alias("journals_repaired"),
        F.count_if(state == "skipped").alias("journals_skipped"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_read"))


def _compact(spark, tables, dataset, day, as_of, retention_days, reprocess, run) -> None:
    files = list_journals(tables.journals, dataset, day)
    archived = list_archived(tables.archive, dataset, day)
    if not files and not (reprocess and archived):
        run["status"] = "partial"
        return
    stored = tables.dataset(dataset)
    if not archived and not reprocess and store.stored_rows(spark, stored, day.isoformat()):
        raise RuntimeError(f"{day} is stored and its archived journals are gone; "
                           "reprocess to replace it")
    # One row per file and column; kept, because drift is judged in several steps.
    fields = journal_fields(spark, tables.journals, dataset, day, tables.archive).persist()
    try:
        _publish(spark, tables, dataset, day, fields, run)
    finally:
        fields.unpersist()
    if run["status"] == "success":
        _archive(spark, tables, dataset, day, [f.path for f in files])
        store.prune(spark, f"{tables.archive}/{dataset}", retention_days, as_of)


def _publish(spark, tables, dataset, day, fields, run) -> None:
    registry = load_registry(spark, tables, dataset)
    if registry is None and dataset in DATASETS:
        registry = drift.schema_fields(spark, DATASETS[dataset])
    observed = fields.groupBy("name", "type").agg(F.min("path").alias("path")).collect()
    expected = [] if registry is None else registry.collect()
    target = _target_schema(expected, observed)
    rows, status = read_journals(
        spark, tables.journals, dataset, day, target, tables.archive)
    counters = run_counters(status).first().asDict()
    expected = counters.pop("rows_read")
    run.update(counters)
    if run["journals_found"] == run["journals_skipped"]:
        run["status"] = "partial"
        return
    found = None
    if registry is not None:
        changes, verdicts = drift.classify_drift(registry, fields, ["path"])
        last = verdicts.filter("drift_type = 'breaking'").agg(F.max("path").alias("path"))
        found = drift.drift_summary(changes.join(last, "path", "left_semi"), ["path"]).first()
        if found is not None:
            first = rows.columns[0]
            rows = rows.withMetadata(
                first, {"schema_drift": "true", "drift_summary": found["drift_summary"]})
    out = tables.dataset(dataset)
    run["rows_written"], _ = store.publish_day(rows, out, day.isoformat(), expected)
    run["upload_bytes"] = store.day_bytes(spark, out, day.isoformat())
    record_drift(spark, tables, dataset, day, found)
    bootstrap_registry(spark, tables, dataset, StructType(
        [f for f in target if f.name != drift.RESCUED]))
    run["status"] = "success"


DRIFT_DDL = "path string, drift_summary string, dataset string, date string"


def record_drift(spark: SparkSession, tables: Tables, dataset: str, day: date, found) -> None:
    """What the day as now stored shows: replaces what was recorded for it before.

    It follows the publication, so that a failed run records nothing and a run that is
    repeated records nothing twice.
    """
    folder = f"{tables.drift_events}/dataset={dataset}/date={day.isoformat()}"
    if found is None:
        if store.exists(spark, folder):
            store.delete(spark, folder)
        return
    spark.createDataFrame([(found["path"], found["drift_summary"])], "path string, drift_summary string") \
        .coalesce(1).write.mode("overwrite").parquet(folder)


def load_drift(spark: SparkSession, tables: Tables) -> DataFrame:
    """Recorded drift of all stored days; no rows where none was ever recorded."""
    if not store.exists(spark, tables.drift_events):
        return spark.createDataFrame([], DRIFT_DDL)
    return spark.read.schema(DRIFT_DDL).parquet(tables.drift_events)


def _archive(spark, tables, dataset, day, paths) -> None:
    """Move journals and list them as archived, so they are not compacted again."""
    folder = store.day_path(f"{tables.archive}/{dataset}", day.isoformat())
    rows = [(p, store.move(spark, p, folder)) for p in paths]
    spark.createDataFrame(rows, "path string, archived_as string").withColumns(
        {"dataset": F.lit(dataset), "date": F.lit(day.isoformat())}
    ).coalesce(1).write.mode("append").parquet(tables.archived)


def pending_files(files: DataFrame, archived: DataFrame) -> DataFrame:
    """Files not listed as archived."""
    return files.join(archived.select("path"), "path", "left_anti")


def recent_runs(runs: DataFrame, days: int, as_of: Column) -> DataFrame:
    """Runs dated within ``days`` of ``as_of``, the cutoff day included."""
    return runs.filter(F.col("date").try_cast("date") >= F.date_sub(as_of.cast("date"), days))


def run_summary(runs: DataFrame, days: int, as_of: Column) -> DataFrame:
    """Distinct days, runs and failures of the window."""
    return recent_runs(runs, days, as_of).agg(
        F.count_distinct("date").alias("days"), F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("status") == "failed").alias("failures"))


def runs_with_drift(runs: DataFrame, flags: DataFrame) -> DataFrame:
    """Runs with the drift flag of their stored day; ``?`` where there is none."""
    return runs.join(flags.select("daemon", "date", "drift"), ["daemon", "date"], "left") \
        .withColumn("drift", F.coalesce("drift", F.lit("?")))


def stored_drift(runs: DataFrame, drift_events: DataFrame) -> DataFrame:
    """Drift flag of every stored day: ``DRIFT`` where a breaking file was recorded, else ``OK``.

    Days without a successful run are not stored and have no flag.
    """
    events = drift_events.select(F.col("dataset").alias("daemon"), "date").distinct().withColumn("__hit", F.lit(True))
    days = runs.filter("status = 'success'").select("daemon", "date").distinct()
    return days.join(events, ["daemon", "date"], "left").select(
        "daemon", "date", F.when(F.col("__hit"), "DRIFT").otherwise("OK").alias("drift"))


def latest_runs(runs: DataFrame) -> DataFrame:
    """Newest run per dataset."""
    return latest_per_key(runs, ["daemon"], ["date", "elapsed_seconds"])
