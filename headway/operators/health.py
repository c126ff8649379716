"""Liveness of collectors from their state and heartbeat records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from headway.functions.clock import epoch_seconds
from headway.functions.numeric import py_round
from headway.functions.status import duration_text, staleness

# Seconds after which a collector counts as stale.
STATUS_STALE_S = 300
HEARTBEAT_STALE_S = 600


def collector_status(state: DataFrame, as_of: Column, stale_s: float = STATUS_STALE_S) -> DataFrame:
    """Status per collector from its last poll (or last collection) time."""
    age = epoch_seconds(as_of) - F.coalesce("last_poll_timestamp", "last_collection_timestamp")
    return state.withColumn("age_seconds", age).select(
        "daemon",
        staleness(F.col("age_seconds"), stale_s).alias("status"),
        "age_seconds",
        F.concat(duration_text(F.col("age_seconds")), F.lit(" ago")).alias("last_poll"),
        F.col("total_records_collected").alias("records"))


def heartbeat_status(heartbeats: DataFrame, as_of: Column,
                     stale_s: float = HEARTBEAT_STALE_S) -> DataFrame:
    """Status per heartbeat; records without a numeric timestamp are left out."""
    age = epoch_seconds(as_of) - F.col("timestamp").try_cast("double")
    return (
        heartbeats.withColumn("__age", age).filter(F.col("__age").isNotNull())
        .select("daemon",
                staleness(F.col("__age"), stale_s, fresh="healthy").alias("status"),
                py_round(F.col("__age"), 0).cast("long").alias("age_seconds"),
                "pid"))


def overall_health(status: DataFrame) -> DataFrame:
    """One row: degraded if any is stale, unknown if any (or all) is unknown."""
    stale, unknown = (F.count_if(F.col("status") == s) for s in ("stale", "unknown"))
    return status.agg(
        F.when(stale > 0, "degraded")
        .when((unknown > 0) | (F.count(F.lit(1)) == 0), "unknown")
        .otherwise("healthy").alias("overall_status"),
        stale.alias("stale"), unknown.alias("unknown"))


def overall_heartbeat(status: DataFrame) -> DataFrame:
    """Heartbeats know two states only: no stale one (or none at all) is healthy."""
    return status.agg(
        F.when(F.count_if(F.col("status") == "stale") > 0, "degraded")
        .otherwise("healthy").alias("overall_status"))
