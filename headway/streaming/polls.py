"""Poll stream: landed payloads to a partitioned append-only table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from headway.functions.clock import service_date
from headway.operators.trains import train_positions

RAW_PAYLOAD = StructType([StructField("payload", StringType()),
                          StructField("poll_timestamp", TimestampType())])


def landed_payloads(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Landed polls, a bounded number of files per micro-batch."""
    return (spark.readStream.schema(RAW_PAYLOAD).option("maxFilesPerTrigger", max_files)
            .json(path))


def positions(raw: DataFrame, dedup_within: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)`` trains of a poll stream.

    Collection keeps duplicates; ``dedup_within`` (a watermark delay) opts in to
    dropping repeated (poll, train) rows.
    """
    good, rejected = train_positions(raw)
    if dedup_within is not None:
        good = deduplicated(good, ["poll_timestamp", "train_id"], "poll_timestamp", dedup_within)
    return good, rejected


def deduplicated(stream: DataFrame, keys: Sequence[str], ts: str, within: str) -> DataFrame:
    """The first row of every key; a repeat counts as one up to ``within`` later in event time.

    A key is kept as state until the watermark has passed its row by ``within``, so state
    holds the keys of that much event time, however long the stream runs.
    """
    return stream.withWatermark(ts, within).dropDuplicatesWithinWatermark(list(keys))


def append(stream: DataFrame, ts: str, out: str, checkpoint: str,
           interval: str | None = "15 minutes", salts: int = 8) -> StreamingQuery:
    """Append to ``year=/month=/day=`` folders of each row's own service day.

    Each micro-batch is shuffled by day and ``salts`` parts of it: a live stream's single
    day is written by so many tasks and gets at most so many files.  Without an interval the
    query takes what has landed and ends.
    """
    day = service_date(F.col(ts))
    salt = F.pmod(F.xxhash64(*stream.columns), F.lit(salts))
    dated = stream.withColumns({"year": F.date_format(day, "yyyy"), "month": F.date_format(day, "MM"),
                                "day": F.date_format(day, "dd"), "__salt": salt})
    parts = int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    writer = (
        dated.repartition(parts, "year", "month", "day", "__salt").drop("__salt")
        .writeStream.format("parquet").partitionBy("year", "month", "day")
        .option("path", out).option("checkpointLocation", checkpoint).outputMode("append"))
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
