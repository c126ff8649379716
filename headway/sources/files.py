"""Landed JSON, telemetry and Parquet files as DataFrames, always with given schemas."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from headway import schemas
from headway.sources.journals import open_folder

_CORRUPT = "_corrupt_record"


def _json(spark: SparkSession, path: str, schema: StructType, multi_line: bool,
          glob: str | None = None) -> DataFrame:
    """Parsable records only, with their file name."""
    reader = spark.read.schema(StructType([*schema, StructField(_CORRUPT, StringType())]))
    reader = reader.option("mode", "PERMISSIVE").option("multiLine", multi_line)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.json(path).select("*", F.col("_metadata.file_name").alias("file_name"))


def dataset(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """Date-partitioned Parquet; filters on ``date`` prune folders."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(StructType([*schema, StructField("date", StringType())]))
    return reader.parquet(root)


def telemetry_events(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines events; blank and broken lines are dropped, a missing time is 0.0."""
    found = _json(spark, path, schemas.TELEMETRY_EVENT, False, "*.events.jsonl*")
    return found.filter(F.col(_CORRUPT).isNull()).withColumn(
        "ts", F.coalesce("ts", F.lit(0.0))).drop(_CORRUPT)


def metrics_snapshots(spark: SparkSession, path: str) -> DataFrame:
    found = _json(spark, path, schemas.METRICS_SNAPSHOT, False, "*.metrics.jsonl*")
    return found.filter(F.col(_CORRUPT).isNull()).drop(_CORRUPT)


def latest_snapshot_metrics(snapshots: DataFrame, window: str = "last_hour") -> DataFrame:
    """Daemon metrics of the newest snapshot per collector; empty windows drop out."""
    if window not in ("last_hour", "last_24h"):
        raise ValueError("window must be 'last_hour' or 'last_24h'")
    newest = snapshots.groupBy("daemon_class").agg(F.max_by("metrics", "ts").alias("m"))
    found = F.col(f"m.time_window_metrics.{window}")
    slowest = F.array_max(F.transform(
        F.map_values(found.per_span_metrics), lambda s: F.coalesce(s.p95_ms, F.lit(0.0))))
    return newest.filter(found.total_calls.isNotNull()).select(
        F.col("daemon_class").alias("daemon"),
        F.coalesce(found.overall_success_rate, F.lit(0.0)).alias("success_rate"),
        (1.0 - F.coalesce(found.overall_success_rate, F.lit(0.0))).alias("error_rate"),
        found.total_calls.alias("total_calls"),
        F.coalesce(slowest, F.lit(0.0)).alias("p95_latency_ms"))


def _stem(ending: str) -> Column:
    return F.regexp_replace("file_name", ending, "")


def collector_state(spark: SparkSession, path: str) -> DataFrame:
    """State per collector, named by its file; an unreadable file has no values."""
    found = _json(spark, path, schemas.COLLECTOR_STATE, True, "*.json")
    other = F.col("file_name").rlike(r"\.(diagnostics|heartbeat)\.json$") | (
        F.col("file_name") == "last_alert.json")
    return found.filter(~other).select(_stem(r"\.json$").alias("daemon"),
                                       *schemas.COLLECTOR_STATE.names)


def heartbeats(spark: SparkSession, path: str) -> DataFrame:
    """Heartbeats; the name falls back to the file's, unreadable files drop out."""
    found = _json(spark, path, schemas.HEARTBEAT, True, "*.heartbeat.json")
    return found.filter(F.col(_CORRUPT).isNull()).select(
        "timestamp", F.coalesce("daemon", _stem(r"\.json$")).alias("daemon"), "pid")


def run_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """Compaction run records, newest file name first."""
    found = _json(spark, path, schemas.COMPACTION_RUN, True, "compaction-*.json")
    return found.filter(F.col(_CORRUPT).isNull()).orderBy(F.desc("file_name")).drop(
        _CORRUPT, "file_name")


def raw_payloads(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Landed response bodies, one per line or one per file, unparsed."""
    return spark.read.option("wholetext", multi_line).text(path).select(
        F.col("value").alias("payload"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("landed_at"))


def weather_payloads(spark: SparkSession, path: str, provider: str) -> DataFrame:
    """Landed responses below ``provider=``: JSON lines of grid, body text and time."""
    return spark.read.schema(schemas.WEATHER_PAYLOAD).json(path).filter(
        F.col("provider") == provider).drop("provider")


def list_pages(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejected)``: one payload per element of pages that hold a JSON list each.

    A page that is no JSON or no list is rejected as a whole, with its reason.
    """
    parsed = raw.withColumn("__v", F.try_parse_json("payload"))
    parsed = parsed.withColumn("__list", F.try_variant_get("__v", "$", "array<variant>"))
    rows = parsed.filter(F.col("__list").isNotNull()).select(F.explode("__list").alias("v")).select(
        F.to_json("v").alias("payload"))
    rejected = parsed.filter(F.col("__list").isNull()).withColumn(
        "reason", F.when(F.col("payload").isNull(), "empty page").when(F.col("__v").isNull(), "page is not JSON")
        .otherwise("page is not a list")).drop("__v", "__list")
    return rows, rejected


def list_rows(raw: DataFrame) -> DataFrame:
    """The elements of ``list_pages`` only."""
    return list_pages(raw)[0]


FOOTER_SCHEMA = ("path string, num_rows bigint, key_values map<string,string>, "
                 "fields array<struct<name: string, type: string, nullable: boolean>>")


def parquet_footers(files: DataFrame) -> DataFrame:
    """Row count, key/value metadata and fields of Parquet files (column ``path``).

    Only footers are read; a file that cannot be read keeps a row of NULLs.
    """
    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import (
            ArrayType, BooleanType, LongType, MapType, StringType, StructField, StructType)

        field = StructType([StructField("name", StringType()), StructField("type", StringType()),
                            StructField("nullable", BooleanType())])
        target = to_arrow_schema(StructType([
            StructField("path", StringType()), StructField("num_rows", LongType()),
            StructField("key_values", MapType(StringType(), StringType())),
            StructField("fields", ArrayType(field))]))
        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                row = {"path": path, "num_rows": None, "key_values": None, "fields": None}
                try:
                    filesystem, inner = open_folder(path)
                    with filesystem.open_input_file(inner) as stream:
                        footer = pq.ParquetFile(stream)
                        meta = footer.metadata.metadata or {}
                        row["num_rows"] = footer.metadata.num_rows
                        row["key_values"] = [(k.decode(), v.decode("utf-8", "replace"))
                                             for k, v in meta.items() if k != b"ARROW:schema"]
                        row["fields"] = [{"name": f.name, "type": str(f.type),
                                          "nullable": f.nullable} for f in footer.schema_arrow]
                except (OSError, pa.ArrowInvalid):
                    pass
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=target)

    return files.select("path").mapInArrow(read, FOOTER_SCHEMA)


def footer_gaps(footers: DataFrame) -> DataFrame:
    """Gap records that writers left in footer metadata."""
    gap = F.from_json(F.col("key_values").getItem("gap_metadata"), """is_gap boolean,
        gap_start_timestamp double, gap_end_timestamp double, gap_duration_seconds double,
        gap_reason string, missed_poll_cycles bigint""")
    return footers.select(gap.alias("g")).select("g.*").filter("is_gap")


def drift_flag() -> Column:
    """``DRIFT``, ``OK`` or ``?`` (unreadable) of a footer.

    A file's flag is in its key/value metadata if another writer left it there, and in the
    metadata of a column of the Spark schema in files that compaction published.
    """
    values = F.col("key_values")
    flag = F.get_json_object(values.getItem("org.apache.spark.sql.parquet.row.metadata"), "$.fields[*].metadata.schema_drift")
    drifted = F.coalesce(values.getItem("schema_drift") == "true", F.lit(False)) | F.coalesce(flag.contains("true"), F.lit(False))
    return F.when(F.col("num_rows").isNull(), "?").when(drifted, "DRIFT").otherwise("OK")


def footer_drift(footers: DataFrame) -> DataFrame:
    """The drift flag of each file."""
    return footers.select("path", drift_flag().alias("drift"))


def footer_report(spark: SparkSession, root: str) -> DataFrame:
    """Every Parquet file below a folder: path, num_rows, drift and has_gap of its footer.

    Only names and footers are read, and the files are dealt over all tasks; a file that
    cannot be read keeps its row, with ``?``.
    """
    names = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", True).load(root).select("path"))
    gap = F.get_json_object(F.col("key_values").getItem("gap_metadata"), "$.is_gap") == "true"
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return parquet_footers(names.repartition(tasks, "path")).select(
        "path", "num_rows", drift_flag().alias("drift"), F.coalesce(gap, F.lit(False)).alias("has_gap"))
