"""Keyed state machines over streams: gap detection and alert cooldown.

State is one timestamp per key, kept in RocksDB and restored from the query's
checkpoint.  Within a micro-batch a key's distinct instants are taken in order;
the source limits how much a batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (
    BooleanType, LongType, StringType, StructField, StructType,
)

from headway.operators.gaps import check_gap_parameters, gap_fields

_LAST = StructType([StructField("us", LongType())])
_LINK = StructType([StructField("us", LongType()), StructField("run", StringType()), StructField("quota_us", LongType())])


class _LastInstant(StatefulProcessor):
    """Holds the last instant of a key, in microseconds."""

    def __init__(self, keys: Sequence[str]):
        self._keys = list(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState("last", _LAST)

    def _get(self) -> int | None:
        return self._last.get()[0] if self._last.exists() else None

    def _row(self, key, **values) -> Row:
        return Row(**dict(zip(self._keys, key)), **values)

    def close(self) -> None:
        pass


class PreviousPoll(_LastInstant):
    """Emits every distinct new poll with the one before it, both runs and the last quota error.

    Rows are polls, or quota errors (``is_poll`` false), which sort before a poll at the
    same instant.  Polls older than the last one are emitted as late, without moving it;
    repeats of the last one emit nothing.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState("last", _LINK)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last, run, quota = self._last.get() if self._last.exists() else (None, None, None)
        marks: dict[tuple[int, bool], str | None] = {}
        for r in rows:
            at = (r.us, r.is_poll)
            marks[at] = max(filter(None, (marks.get(at), r.run)), default=None)
        for (us, is_poll), own in sorted(marks.items(), key=lambda m: m[0]):
            if not is_poll:
                quota = us if quota is None else max(quota, us)
            elif last is None or us > last:
                yield self._row(key, prev_us=last, us=us, prev_run=run, run=own, quota_us=quota, is_late=False)
                last, run = us, own
            elif us < last:
                yield self._row(key, prev_us=last, us=us, prev_run=run, run=own, quota_us=quota, is_late=True)
        self._last.update((last, run, quota))


class Cooldown(_LastInstant):
    """Marks candidates as sent, strictly more than the pause after the last send."""

    def __init__(self, keys: Sequence[str], pause_us: int):
        super().__init__(keys)
        self._pause_us = pause_us

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last = self._get()
        asked: dict[int, bool] = {}
        for r in rows:
            asked[r.us] = asked.get(r.us, False) or bool(r.should_alert)
        for us in sorted(asked):
            send = asked[us] and (last is None or us - last > self._pause_us)
            if send:
                last = us
            yield self._row(key, us=us, send=send)
        if last is not None:
            self._last.update((last,))


def _keyed(stream: DataFrame, keys: Sequence[str], columns: list[StructField]) -> StructType:
    return StructType([*[stream.schema[k] for k in keys], *columns])


def detect_gaps_stream(polls: DataFrame, ts: str, keys: Sequence[str], poll_interval_s: float,
                       threshold_multiplier: float = 2.0, downtime_s: float = 600.0,
                       restart_reason: str = "duration", run_id: str | None = None,
                       quota_errors: DataFrame | None = None, with_late: bool = False) -> DataFrame:
    """Gap rows of a poll stream, equal to the batch operator's on ordered input.

    ``restart_reason``, ``run_id`` and ``quota_errors`` (a stream with the same keys and
    ``ts``) are as in the batch operator.  A poll older than the last one of its key is late:
    the gap over its time is already told.  ``with_late`` adds a row, and the column
    ``is_late``, for each of them, so that they can be counted.
    """
    check_gap_parameters(poll_interval_s, threshold_multiplier)
    if restart_reason not in ("duration", "downtime"):
        raise ValueError("restart_reason must be 'duration' or 'downtime'")
    if restart_reason == "downtime" and run_id is None:
        raise ValueError("restart_reason='downtime' needs run_id")
    keys = list(keys)
    schema = _keyed(polls, keys, [
        StructField("prev_us", LongType()), StructField("us", LongType()), StructField("prev_run", StringType()),
        StructField("run", StringType()), StructField("quota_us", LongType()), StructField("is_late", BooleanType())])
    run = F.lit(None).cast("string") if run_id is None else F.col(run_id).cast("string")
    marks = polls.select(*keys, F.unix_micros(ts).alias("us"), F.lit(True).alias("is_poll"), run.alias("run"))
    if quota_errors is not None:
        marks = marks.union(quota_errors.select(
            *keys, F.unix_micros(ts).alias("us"), F.lit(False).alias("is_poll"), F.lit(None).cast("string").alias("run")))
    linked = marks.groupBy(*keys).transformWithState(
        PreviousPoll(keys), schema, outputMode="Append", timeMode="None")
    reason = None
    if restart_reason == "downtime":
        reason = F.when(~F.col("prev_run").eqNullSafe(F.col("run")), "downtime")
    if quota_errors is not None:
        quota = F.when(F.col("quota_us") > F.col("prev_us"), "daily_quota")
        reason = quota if reason is None else F.coalesce(quota, reason)
    at = {"prev": F.timestamp_micros("prev_us"), "now": F.timestamp_micros("us")}
    fields = gap_fields(at["prev"], at["now"], poll_interval_s, threshold_multiplier, downtime_s, reason)
    # A late poll lies before the last one: no gap.
    told = linked.select(*keys, at["now"].alias(ts), *[c.alias(n) for n, c in fields.items()], "is_late")
    return told.filter("is_gap OR is_late") if with_late else told.filter("is_gap").drop("is_late")


def alerts_to_send_stream(candidates: DataFrame, keys: Sequence[str], ts: str,
                          cooldown_s: float) -> DataFrame:
    """``keys, ts, send`` for a stream of alert candidates."""
    if cooldown_s < 0:
        raise ValueError("cooldown must be >= 0")
    keys = list(keys)
    schema = _keyed(candidates, keys, [StructField("us", LongType()),
                                       StructField("send", BooleanType())])
    marked = candidates.select(
        *keys, F.unix_micros(ts).alias("us"), F.coalesce("should_alert", F.lit(False))
        .alias("should_alert"),
    ).groupBy(*keys).transformWithState(
        Cooldown(keys, round(cooldown_s * 1e6)), schema, outputMode="Append", timeMode="None")
    return marked.select(*keys, F.timestamp_micros("us").alias(ts), "send")
