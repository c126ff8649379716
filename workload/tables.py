"""Readers for the driver's tables and the input shapes built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from headway.functions import epoch_seconds, to_instant
from headway.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows in partitions of even size before costly parsing, whatever the files' splits."""
    return df.hint("rebalance")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", to_instant(F.col("ts")))


def newest(df: DataFrame, ts: str = "ts") -> Column:
    """The table's own newest instant as "now": a scalar subquery in the plan."""
    return df.select(F.max(ts)).scalar()


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dataset per user, one collector run per UTC day."""
    return events(spark, sf_dir).select(
        F.col("user_id").alias("dataset"), F.col("ts").alias("poll_ts"),
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"), "event_type", "value")


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        (F.col("user_id") % 3).alias("daemon"), F.col("event_type").alias("span"), "ts",
        (F.col("event_type") != "error").alias("ok"), F.col("value").alias("elapsed_ms"))


def telemetry_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records; every second error is recorded by name instead of kind."""
    is_error = F.col("event_type") == "error"
    by_name = is_error & (F.col("event_id") % 2 == 1)
    return events(spark, sf_dir).select(
        epoch_seconds(F.col("ts")).alias("ts"),
        F.when(is_error & ~by_name, "error").otherwise("span").alias("kind"),
        (F.col("user_id") % 3).cast("string").alias("daemon_class"),
        F.when(by_name, F.concat(F.lit("call"), F.col("event_id").cast("string"), F.lit(".error")))
        .otherwise(F.concat(F.lit("call"), F.col("event_id").cast("string"))).alias("name"),
        F.when(is_error, F.when(F.col("value") < 20, "ReadTimeout")
               .when(F.col("value") < 60, "HTTPStatusError")
               .otherwise("ValueError")).alias("error_type"),
        F.when(is_error, F.col("props")).alias("error_message"),
        F.when(is_error & F.col("value").between(20, 59.99),
               (F.lit(400) + F.floor(F.col("value"))).cast("int")).alias("http_status"),
        F.col("event_id"), F.col("value"))
