"""Driver-table queries: each module pairs Spark queries with their SQL check.

The driver's tables are not telemetry, so every query maps a base table onto an
operator's input and the SQL applies the same mapping.
"""

from __future__ import annotations

from importlib import import_module

MODULES = ("gaps", "telemetry", "health", "payloads", "weather", "drift", "compaction", "streams", "journeys", "landed")


def load(attribute: str) -> dict:
    merged: dict = {}
    for name in MODULES:
        part = getattr(import_module(f"workload.{name}"), attribute)
        overlap = merged.keys() & part.keys()
        if overlap:
            raise ValueError(f"registered twice: {sorted(overlap)}")
        merged.update(part)
    return merged
