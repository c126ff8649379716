"""Writing, publishing and expiring date-partitioned Parquet datasets."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from headway.functions.clock import LOCAL_TZ, PARTITION_HOUR, service_date


def with_service_date(df: DataFrame, ts: str, tz: str = LOCAL_TZ,
                      partition_hour: int = PARTITION_HOUR) -> DataFrame:
    """Partition column ``date`` per row, so a poll at the boundary lands on its own day."""
    return df.withColumn("date", service_date(F.col(ts), tz, partition_hour).cast("string"))


def write_dataset(df: DataFrame, root: str, ts: str, mode: str = "append",
                  requested_at: Column | None = None) -> None:
    """Append to ``date=`` folders with Snappy.

    The rebalance hint lets AQE merge small and split large date partitions into
    even files.  ``request_timestamp`` is added where the data lacks it.
    """
    if "request_timestamp" not in df.columns:
        df = df.withColumn("request_timestamp", F.col(ts) if requested_at is None else requested_at)
    (with_service_date(df, ts).hint("rebalance", "date")
     .write.mode(mode).partitionBy("date").option("compression", "snappy").parquet(root))


def publish_day(df: DataFrame, root: str, date: str, expected: int | None = None) -> tuple[int, int]:
    """Replace one day by a verified copy: ``(rows written, rows replaced)``.

    Rows are written to a staging folder, counted while they are written, counted again
    from the stored files and compared with ``expected``; only then does the staged day
    take the place of the live one.  Whatever fails before leaves the live day as it is,
    and the old copy is deleted only once the new one is in its place; a publication that
    broke off between the two renames is undone first.
    """
    spark = df.sparkSession
    restore_day(spark, root, date)
    replaced = stored_rows(spark, root, date)
    staging = f"{root.rstrip('/')}/_staged-{uuid.uuid4().hex[:12]}"  # hidden from readers
    seen = Observation(f"publish-{uuid.uuid4().hex[:8]}")
    try:
        (df.drop("date").observe(seen, F.count(F.lit(1)).alias("n")).hint("rebalance")
         .write.option("compression", "snappy").parquet(day_path(staging, date)))
        written = seen.get["n"]
        counts = [written, stored_rows(spark, staging, date), *([] if expected is None else [expected])]
        if len(set(counts)) > 1:
            raise RuntimeError(f"row count mismatch for {date}: written, stored, expected {counts}")
        _swap(spark, day_path(staging, date), day_path(root, date), _aside(root, date))
    finally:
        delete(spark, staging)
    return written, replaced


def _aside(root: str, date: str) -> str:
    """Where the live day waits while it is replaced; hidden from readers."""
    return day_path(f"{root.rstrip('/')}/_replaced", date)


def _swap(spark: SparkSession, staged: str, live: str, aside: str) -> None:
    """Put a staged folder in the place of the live one, which goes back if that fails.

    If it cannot go back either, it stays aside, where ``restore_day`` finds it.
    """
    filesystem, target = _path(spark, live)
    kept = _path(spark, aside)[1]
    had = filesystem.exists(target)
    if had:
        filesystem.mkdirs(kept.getParent())
        if not _renamed(filesystem, target, kept):
            raise OSError(f"cannot set {live} aside")
    if not _renamed(filesystem, _path(spark, staged)[1], target):
        if had and not _renamed(filesystem, kept, target):
            raise OSError(f"cannot publish {live}; the day as it was is in {aside}")
        raise OSError(f"cannot publish {live}")
    if had:
        _forget(filesystem, kept)


def _renamed(filesystem, source, target) -> bool:
    """Whether the folder is now ``target``; errors of the filesystem count as no."""
    try:
        return bool(filesystem.rename(source, target))
    except Py4JJavaError:
        return False


def _forget(filesystem, kept) -> None:
    filesystem.delete(kept, True)
    if not filesystem.listStatus(kept.getParent()):
        filesystem.delete(kept.getParent(), False)


def restore_day(spark: SparkSession, root: str, date: str) -> bool:
    """Put back a live day that a broken publication left aside: whether there was one.

    Where the new day is in place already, only the old copy is left over and goes.
    """
    filesystem, target = _path(spark, day_path(root, date))
    kept = _path(spark, _aside(root, date))[1]
    if not filesystem.exists(kept):
        return False
    if filesystem.exists(target):
        _forget(filesystem, kept)
        return False
    if not _renamed(filesystem, kept, target):
        raise OSError(f"cannot put back {date} from {kept.toString()}")
    return True


def day_path(root: str, date: str) -> str:
    return f"{root.rstrip('/')}/date={date}"


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    filesystem, hadoop = _path(spark, path)
    return filesystem.exists(hadoop)


def delete(spark: SparkSession, path: str) -> bool:
    filesystem, hadoop = _path(spark, path)
    return filesystem.delete(hadoop, True)


def move(spark: SparkSession, source: str, folder: str) -> str:
    """Move a file into a folder on the same filesystem."""
    filesystem, hadoop = _path(spark, source)
    _, target = _path(spark, folder)
    filesystem.mkdirs(target)
    goal = f"{folder.rstrip('/')}/{hadoop.getName()}"
    if exists(spark, goal):
        raise OSError(f"{goal} is already there")
    if not filesystem.rename(hadoop, _path(spark, goal)[1]):
        raise OSError(f"cannot move {source} to {folder}")
    return goal


def day_bytes(spark: SparkSession, root: str, date: str) -> int:
    filesystem, hadoop = _path(spark, day_path(root, date))
    return filesystem.getContentSummary(hadoop).getLength()


def stored_rows(spark: SparkSession, root: str, date: str) -> int:
    """Rows of a stored day; no column is read."""
    path = day_path(root, date)
    return spark.read.parquet(path).count() if exists(spark, path) else 0


def partitions(spark: SparkSession, root: str) -> DataFrame:
    """Folders of a dataset: ``path, name`` (one row per ``date=`` folder)."""
    filesystem, hadoop = _path(spark, f"{root.rstrip('/')}/date=*")
    found = filesystem.globStatus(hadoop) or []
    rows = [(f.getPath().toString(), f.getPath().getName()) for f in found]
    return spark.createDataFrame(rows, "path string, name string")


def doomed_partitions(folders: DataFrame, retention_days: int, as_of: Column) -> DataFrame:
    """Folders dated strictly before ``as_of`` minus the retention; bad names are skipped."""
    from headway.functions.clock import iso_date

    day = iso_date(F.regexp_replace("name", "^date=", ""))
    return folders.filter(day < F.date_sub(as_of.cast("date"), retention_days))


def prune(spark: SparkSession, root: str, retention_days: int, as_of: Column) -> list[str]:
    """Delete expired folders; their number is bounded by days, not by data."""
    doomed = doomed_partitions(partitions(spark, root), retention_days, as_of)
    return [r.path for r in doomed.orderBy("path").collect() if delete(spark, r.path)]
