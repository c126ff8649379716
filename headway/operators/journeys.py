"""Labels and features of train runs: arrivals, time to arrival, dwell, travel and speed.

A run's rows are ordered by poll instant.  All of it works on (run, time slice), so a run
with very many rows, or one whose events fall into other slices, is no task's burden.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from headway.operators.ordered import (
    DEFAULT_BUCKET_SECONDS, islands, with_earliest_within, with_neighbours, with_next_known, with_running_sum,
)


def _seconds(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def _linked(positions: DataFrame, run: Sequence[str], ts: str, station: str, gone_seconds: float,
            as_of: Column, **how) -> DataFrame:
    """Rows with their neighbours; ``appears`` and ``vanishes`` mark the ends of a run.

    A run vanishes where nothing follows for longer than ``gone_seconds``, as far as
    polls up to ``as_of`` can tell: the end of the data is no end of a run.
    """
    linked = with_neighbours(positions, run, ts, {"__prev_ts": ts, "__prev_station": station},
                             {"__next_ts": ts, "__next_station": station}, **how)
    gone = F.lit(gone_seconds)
    return linked.withColumns({
        "appears": F.coalesce(_seconds(F.col(ts), F.col("__prev_ts")) > gone, F.lit(True)),
        "vanishes": _seconds(F.coalesce("__next_ts", as_of), F.col(ts)) > gone})


def arrivals(positions: DataFrame, run: Sequence[str], ts: str, station: str, gone_seconds: float,
             as_of: Column, ties: Sequence[str] = (), bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
             most_rows: int | None = None) -> DataFrame:
    """Events of runs: (run, ts, kind, station).

    ``changed``: the next station differs from the poll before, so the run has arrived at
    the station it headed for.  ``vanished``: the last poll of a run, which has reached
    the station it headed for.  ``appeared``: its first poll, with the station ahead.  A
    NULL station is unknown: no change from or to it is an arrival.
    """
    linked = _linked(positions, run, ts, station, gone_seconds, as_of, ties=ties,
                     bucket_seconds=bucket_seconds, most_rows=most_rows)
    changed = ~F.col("appears") & (F.col("__prev_station") != F.col(station))

    def event(when: Column, kind: str, which: str) -> Column:
        return F.when(when, F.struct(F.lit(kind).alias("kind"), F.col(which).alias("station")))

    found = F.array_compact(F.array(
        event(F.col("appears"), "appeared", station), event(changed, "changed", "__prev_station"),
        event(F.col("vanishes"), "vanished", station)))
    return linked.select(*run, ts, F.explode(found).alias("event")).select(*run, ts, "event.*")


def time_to_arrival(positions: DataFrame, run: Sequence[str], ts: str, station: str,
                    gone_seconds: float, as_of: Column, ties: Sequence[str] = (),
                    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
                    most_rows: int | None = None) -> DataFrame:
    """Every position with ``arrival_ts`` and ``seconds_to_arrival`` at the station ahead.

    The arrival is the next change of the station of the run, or its last poll before it
    vanishes, whichever comes first; NULL where the data ends before either.  It is
    carried backwards over time slices.
    """
    linked = _linked(positions, run, ts, station, gone_seconds, as_of, ties=ties,
                     bucket_seconds=bucket_seconds, most_rows=most_rows)
    arrival = F.when(F.col("vanishes"), F.col(ts)).when(F.col("__next_station") != F.col(station), F.col("__next_ts"))
    marked = linked.select(*positions.columns, arrival.alias("__arrival"))
    known = with_next_known(marked, run, ts, "__arrival", "arrival_ts", ties=ties,
                            bucket_seconds=bucket_seconds, most_rows=most_rows)
    return known.drop("__arrival").withColumn("seconds_to_arrival", _seconds(F.col("arrival_ts"), F.col(ts)))


def dwell_times(positions: DataFrame, run: Sequence[str], ts: str, place: str, ties: Sequence[str] = (),
                bucket_seconds: int = DEFAULT_BUCKET_SECONDS, most_rows: int | None = None) -> DataFrame:
    """How long a run stayed at each place: (run, place, first_ts, last_ts, rows, dwell_seconds).

    Successive rows with one place are one stay, over any number of time slices; a NULL
    place is between places and no stay.
    """
    stays = islands(positions, run, ts, place, ties, bucket_seconds, most_rows).filter(F.col(place).isNotNull())
    return stays.withColumn("dwell_seconds", _seconds(F.col("last_ts"), F.col("first_ts")))


def travelled(positions: DataFrame, run: Sequence[str], ts: str, segment: str, along_m: str, total_m: str,
              ties: Sequence[str] = (), bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
              most_rows: int | None = None) -> DataFrame:
    """``moved_mm`` since the poll before and ``odometer_mm`` of the run, in whole millimetres.

    Distance is along the track: on one segment the difference of ``along_m``, on another
    one the rest of the segment before and the part of this one (``along_m`` and ``total_m``
    count in the direction of travel).  Unknown places and first polls add nothing.
    """
    before = {"__segment": segment, "__along": along_m, "__total": total_m}
    linked = with_neighbours(positions, run, ts, before, {}, ties=ties, bucket_seconds=bucket_seconds, most_rows=most_rows)
    same = F.col("__segment") == F.col(segment)
    moved = F.when(same, F.abs(F.col(along_m) - F.col("__along"))).otherwise(
        F.col("__total") - F.col("__along") + F.col(along_m))
    rows = linked.withColumn("moved_mm", F.coalesce(F.round(moved * 1000), F.lit(0)).cast("long"))
    return with_running_sum(rows.select(*positions.columns, "moved_mm"), run, ts, {"odometer_mm": F.col("moved_mm")},
                            ties=ties, bucket_seconds=bucket_seconds, most_rows=most_rows)


def speeds(positions: DataFrame, run: Sequence[str], ts: str, odometer_mm: str,
           minutes: Mapping[str, int] | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """Speed in metres a second over the last one, three and five minutes, by the odometer.

    Over a window it is the way since the earliest poll in it, by the time since; NULL where
    that is the row itself.
    """
    out = positions
    for name, length in (minutes or {"speed_1m": 1, "speed_3m": 3, "speed_5m": 5}).items():
        out = with_earliest_within(out, run, ts, {"__from": odometer_mm, "__since": ts}, length * 60, ties=ties)
        passed = F.unix_micros(F.col(ts)) - F.unix_micros(F.col("__since"))
        speed = F.when(passed > 0, (F.col(odometer_mm) - F.col("__from")) * F.lit(1000.0) / passed)
        out = out.withColumn(name, speed).drop("__from", "__since")
    return out
