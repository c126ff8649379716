"""Time functions: instants, service days and text dates.

A service day is the local calendar day that rolls over at ``partition_hour``.
All functions assume a UTC session (see ``headway.session``).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LOCAL_TZ = "America/Chicago"
PARTITION_HOUR = 3


def to_instant(ts: Column) -> Column:
    """Zone-less timestamps are UTC wall time; make them instants."""
    return ts.cast("timestamp")


def from_epoch(seconds: Column) -> Column:
    """Epoch seconds (double) to an instant, to the microsecond."""
    return F.timestamp_micros(F.round(seconds * F.lit(1e6)).cast("long"))


def epoch_seconds(ts: Column) -> Column:
    """Instant to epoch seconds (double)."""
    return F.unix_micros(ts) / F.lit(1e6)


def _local(ts: Column, tz: str) -> Column:
    return F.from_utc_timestamp(ts, tz)


def service_date(ts: Column, tz: str = LOCAL_TZ, partition_hour: int = PARTITION_HOUR) -> Column:
    """Service day of an instant: before ``partition_hour`` it is still yesterday."""
    return F.to_date(
        _local(ts, tz) - F.make_dt_interval(hours=F.lit(partition_hour))
    )


def next_local_midnight(ts: Column, tz: str = LOCAL_TZ) -> Column:
    """The first local midnight strictly after the instant's local day began."""
    tomorrow = F.date_add(F.to_date(_local(ts, tz)), 1)
    return F.to_utc_timestamp(tomorrow.cast("timestamp"), tz)


def iso_timestamp(text: Column) -> Column:
    """ISO text to an instant; NULL when it does not parse, naive text is UTC."""
    return F.try_to_timestamp(text)


def iso_date(text: Column) -> Column:
    """``YYYY-MM-DD`` text to a date; NULL for any other form."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))
