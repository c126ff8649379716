"""Learned key-to-value mappings kept as a change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from headway.functions.clock import epoch_seconds
from headway.operators.ordered import latest_per_key


def latest_mapping(changes: DataFrame, keys: Sequence[str],
                   order: Sequence[str] = ("updated_at",)) -> DataFrame:
    """Current value per key; a row with ``deleted`` true is a tombstone, NULL is not."""
    return latest_per_key(changes, keys, order).filter(~F.coalesce(F.col("deleted"), F.lit(False))).drop("deleted")


def fresh(mapping: DataFrame, ttl_s: float | None, as_of: Column) -> DataFrame:
    """Entries whose age does not exceed the TTL; without a TTL nothing expires.

    Entries without a usable ``updated_at`` (epoch seconds) are dropped.
    """
    updated = F.col("updated_at").try_cast("double")
    kept = mapping.filter(updated.isNotNull())
    if ttl_s is None:
        return kept
    return kept.filter(epoch_seconds(as_of) - updated <= F.lit(float(ttl_s)))


def expired(mapping: DataFrame, ttl_s: float, as_of: Column) -> DataFrame:
    """The complement: entries a prune would drop."""
    updated = F.col("updated_at").try_cast("double")
    return mapping.filter(
        updated.isNull() | (epoch_seconds(as_of) - updated > F.lit(float(ttl_s))))
