"""Windowed span metrics over an event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def windowed_metrics(spans: DataFrame, watermark: str = "1 hour", window: str = "1 hour",
                     slide: str = "5 minutes") -> DataFrame:
    """Calls, success rate and approximate percentiles per daemon, span and window.

    Percentile sketches keep the state of a window small; the batch operator
    gives exact ones.
    """
    rate = F.count_if("ok") / F.count(F.lit(1))
    tails = F.percentile_approx("elapsed_ms", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)), 10000)
    grouped = (
        spans.withWatermark("ts", watermark)
        .groupBy("daemon", "span", F.window("ts", window, slide))
        .agg(F.count(F.lit(1)).alias("total_calls"), rate.alias("success_rate"), tails.alias("p"))
    )
    return grouped.select(
        "daemon", "span", F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"), "total_calls", "success_rate",
        *[F.get("p", F.lit(i)).alias(f"p{n}_ms") for i, n in enumerate((50, 95, 99))])


def upsert_windows(metrics: DataFrame, out: str, checkpoint: str, interval: str | None = None):
    """Log every change of a window as it happens: rows of micro-batch ``n`` in ``batch=n``.

    Windows need not close first; ``newest_windows`` reads the state of each.
    """
    def log(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    writer = metrics.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(log)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def newest_windows(log: DataFrame) -> DataFrame:
    """The last logged state of every window."""
    keys = ["daemon", "span", "window_start"]
    values = [c for c in log.columns if c not in (*keys, "batch")]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v"))
    return newest.select(*keys, "v.*")


def append_events(events: DataFrame, out: str, checkpoint: str, interval: str | None = None):
    """Append telemetry rows to a table."""
    writer = (events.writeStream.format("parquet").outputMode("append")
              .option("path", out).option("checkpointLocation", checkpoint))
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
