"""Run features against plain Python over whole runs, with slices that cut busy hours."""

import math
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from headway.operators import journeys, ordered, tracks

T0 = datetime(2026, 2, 17, 6, tzinfo=timezone.utc)
ROWS = "run string, ts timestamp, n long, station string, v double"


def polls(spark, seed, busy=400, quiet=40):
    """A busy run with ties and jumps over hours, quiet runs, a NULL run and NULL stations."""
    rng, rows = random.Random(seed), []
    for run, count, step in (("busy", busy, 40), ("a", quiet, 900), ("b", quiet, 4000), (None, 5, 60), ("one", 1, 1)):
        at = 0
        for _ in range(count):
            at += rng.choice((0, 1, step, step, 7 * step if rng.random() < 0.1 else step))
            rows.append((run, T0 + timedelta(seconds=at, microseconds=rng.choice((0, 5))), len(rows),
                         rng.choice(("s1", "s1", "s2", None)), float(rng.randrange(100))))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, ROWS)


def by_run(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        out.setdefault(r[0], []).append(r)
    return out


def secs(a, b):
    return (a - b).total_seconds()


@pytest.mark.parametrize("most_rows", [None, 7])
def test_slices_keep_order_and_cut_busy_hours(spark, most_rows):
    rows, df = polls(spark, 1)
    got = ordered.with_slices(df, ["run"], "ts", 3600, most_rows)
    assert got.count() == len(rows) and got.columns == [*df.columns, "__bucket"]
    each = {}
    for r in got.collect():
        each.setdefault(r.run, []).append((r.ts, r["__bucket"]))
    for run in each.values():
        run.sort()
        assert [b for _, b in run] == sorted(b for _, b in run)
        assert len({(t, b) for t, b in run}) == len({t for t, _ in run})  # an instant is in one slice
    most = got.groupBy("run", "__bucket").count().agg(F.max("count")).first()[0]
    assert most <= 21 if most_rows else most > 60


@pytest.mark.parametrize("most_rows", [None, 7])
def test_neighbours_and_next_known(spark, most_rows):
    rows, df = polls(spark, 2)
    how = dict(ties=["n"], most_rows=most_rows)
    got = ordered.with_neighbours(df, ["run"], "ts", {"p": "station", "pt": "n"}, {"q": "v", "qt": "n"}, **how)
    seen = {r.n: (r.p, r.pt, r.q, r.qt) for r in got.collect()}
    known = {r.n: r.k for r in ordered.with_next_known(df, ["run"], "ts", "station", "k", **how).collect()}
    assert len(seen) == len(known) == len(rows)
    for run in by_run(rows).values():
        for i, r in enumerate(run):
            p, q = (run[i - 1] if i else None), (run[i + 1] if i + 1 < len(run) else None)
            assert seen[r[2]] == (p and p[3], p and p[2], q and q[4], q and q[2])
            assert known[r[2]] == next((x[3] for x in run[i:] if x[3] is not None), None)


@pytest.mark.parametrize("most_rows", [None, 7])
@pytest.mark.parametrize("tolerance", [None, 300])
def test_as_of_join(spark, most_rows, tolerance):
    rows, left = polls(spark, 3)
    marks, right = polls(spark, 4, busy=60)
    right = right.select("run", F.col("ts").alias("seen"), "v", F.col("n").alias("m"))
    left = left.select("run", "ts", "n", F.lit("mine").alias("station"))
    got = ordered.as_of_join(left, right, ["run"], "ts", ["v", "m"], tolerance, right_ts="seen", ties=["m"], most_rows=most_rows)
    assert got.columns == [*left.columns, "matched_ts", "v", "m"]
    found = {r.n: (r.m, r.v) for r in got.collect()}
    assert len(found) == len(rows)
    for run, ts, n, _, _ in rows:
        best = max(((t, m, v) for r, t, m, _, v in marks if r == run and run is not None and t <= ts), default=None)
        if best and tolerance is not None and secs(ts, best[0]) > tolerance:
            best = None
        assert found[n] == ((best[1], best[2]) if best else (None, None))
    nothing = ordered.as_of_join(left, right.limit(0), ["run"], "ts", ["v"], right_ts="seen")
    assert nothing.filter("v is null and matched_ts is null").count() == len(rows)


@pytest.mark.parametrize("most_rows", [None, 7])
def test_islands_and_dwell(spark, most_rows):
    rows, df = polls(spark, 5)
    # One state for the whole busy run but for its middle: islands over many slices.
    long = df.withColumn("station", F.when((F.col("run") == "busy") & (F.col("n") != 200), "same").otherwise(F.col("station")))
    for frame in (df, long):
        given = [tuple(r) for r in frame.collect()]
        want = []
        for run, polled in by_run(given).items():
            for i, r in enumerate(polled):
                if i and polled[i - 1][3] == r[3]:
                    want[-1][3:] = [r[1], want[-1][4] + 1]
                else:
                    want.append([run, r[3], r[1], r[1], 1])
        got = ordered.islands(frame, ["run"], "ts", "station", ["n"], most_rows=most_rows)
        key = lambda x: (str(x[0]), x[2], str(x[1]), x[4])
        shown = [list(r) for r in got.select("run", "station", "first_ts", "last_ts", "rows").collect()]
        assert sorted(shown, key=key) == sorted(want, key=key)
        stays = journeys.dwell_times(frame, ["run"], "ts", "station", ["n"], most_rows=most_rows)
        assert stays.count() == sum(w[1] is not None for w in want)
        assert stays.agg(F.sum("dwell_seconds")).first()[0] == pytest.approx(sum(secs(w[3], w[2]) for w in want if w[1]))


@pytest.mark.parametrize("most_rows", [None, 7])
def test_arrivals_and_time_to_arrival(spark, most_rows):
    rows, df = polls(spark, 6)
    gone, as_of = 3000, max(r[1] for r in rows)
    how = dict(ties=["n"], most_rows=most_rows)
    events, times = [], {}
    for run, polled in by_run(rows).items():
        arrival = None
        for i in range(len(polled) - 1, -1, -1):
            r, q = polled[i], polled[i + 1] if i + 1 < len(polled) else None
            if secs(q[1] if q else as_of, r[1]) > gone:
                events.append((run, r[2], "vanished", r[3]))
                arrival = r[1]
            elif q and None not in (q[3], r[3]) and q[3] != r[3]:
                arrival = q[1]
            times[r[2]] = arrival and secs(arrival, r[1])
            p = polled[i - 1] if i else None
            if p is None or secs(r[1], p[1]) > gone:
                events.append((run, r[2], "appeared", r[3]))
            elif None not in (p[3], r[3]) and p[3] != r[3]:
                events.append((run, r[2], "changed", p[3]))
    numbered = {(r[0], r[1], r[2]) for r in rows}
    got = journeys.arrivals(df, ["run"], "ts", "station", gone, F.lit(as_of), **how).collect()
    shown = sorted((str(r.run), r.ts.astimezone(timezone.utc), r.kind, str(r.station)) for r in got)
    at = {n: (run, ts) for run, ts, n in numbered}
    assert shown == sorted((str(run), at[n][1], kind, str(station)) for run, n, kind, station in events)
    known = journeys.time_to_arrival(df, ["run"], "ts", "station", gone, F.lit(as_of), **how)
    assert {r.n: r.seconds_to_arrival for r in known.collect()} == times
    assert any(t is None for t in times.values()) and any(t and t > 3600 for t in times.values())


def test_travel_and_speeds(spark):
    rows, df = polls(spark, 7, busy=300)
    places = df.select("run", "ts", "n", F.col("station").alias("segment"), (F.col("v") * 10).alias("along"), F.lit(2000.0).alias("total"))
    moved = journeys.travelled(places, ["run"], "ts", "segment", "along", "total", ties=["n"], most_rows=9)
    got = {r.n: r for r in journeys.speeds(moved, ["run"], "ts", "odometer_mm", ties=["n"]).collect()}
    for polled in by_run(rows).values():
        odo, told = 0, []
        for i, r in enumerate(polled):
            p = polled[i - 1] if i else None
            if p is not None:
                same = p[3] is not None and p[3] == r[3]
                odo += round((abs(r[4] - p[4]) * 10 if same else 2000 - p[4] * 10 + r[4] * 10) * 1000)
            told.append((r[1], r[2], odo))
            assert got[r[2]].odometer_mm == odo
            for name, minutes in (("speed_1m", 1), ("speed_3m", 3), ("speed_5m", 5)):
                first = min(t for t in told if secs(r[1], t[0]) <= 60 * minutes)
                # Rows at one instant see each other in a range frame; the earliest counts.
                way = secs(r[1], first[0])
                want = (odo - first[2]) / 1000 / way if way else None
                assert getattr(got[r[2]], name) == (pytest.approx(want) if want is not None else None)


def test_metres(spark):
    row = spark.range(1).select(
        tracks.ground_distance_m(F.lit(41.8), F.lit(-87.6), F.lit(41.9), F.lit(-87.6)).alias("north"),
        tracks.ground_distance_m(F.lit(41.8), F.lit(-87.6), F.lit(41.8), F.lit(-87.5)).alias("east")).first()
    north, east = tracks.metres_per_degree(41.85)
    assert row.north == pytest.approx(north / 10, abs=0.01) and 11_100 < row.north < 11_110
    assert row.east == pytest.approx(tracks.metres_per_degree(41.8)[1] / 10, abs=0.01) and 8_300 < row.east < 8_320
    assert tracks.metres_per_degree(0)[1] == pytest.approx(math.pi * tracks.SEMI_MAJOR_M / 180)


@pytest.mark.parametrize("grid_m, levels", [(30.0, 8), (400.0, 2), (1e6, 1)])
def test_snap_against_all_legs(spark, grid_m, levels):
    rng = random.Random(8)
    north, east = tracks.metres_per_degree(41.8)
    xy = lambda x, y: [x / east, y / north]
    lines = {}
    for segment in range(12):
        x, y, points = rng.uniform(0, 5000), rng.uniform(0, 5000), []
        for _ in range(rng.choice((2, 3, 6))):
            points.append(xy(x, y))
            x, y = x + rng.uniform(-900, 900), y + rng.uniform(-900, 900)
        lines[segment] = (segment % 3, [points[:3], points[3:]])
    lines[12] = (0, [[xy(100, 100)], [xy(200, 200), xy(200, 200), xy(300, 200)], [[None, 1.0]]])
    lines[13] = (0, lines[12][1])  # a tie: the smaller segment counts
    given = [(s, line, c) for s, (line, c) in lines.items()]
    legs = tracks.legs(spark.createDataFrame(given, "segment_id long, line long, coordinates array<array<array<double>>>"), 41.8)
    points = [(i, i % 4, *reversed(xy(rng.uniform(-500, 5500), rng.uniform(-500, 5500))), rng.randrange(360)) for i in range(120)]
    points += [(900, 0, None, 1.0, 0), (901, 0, float("nan"), 1.0, 0), (902, 0, *reversed(xy(90000, 90000)), None), (903, None, 41.8, -87.0, 0)]
    df = spark.createDataFrame(points, "id long, line long, lat double, lon double, heading int")
    got = {r.id: r for r in tracks.snap(df, legs, ["id"], 41.8, heading="heading", grid_m=grid_m, levels=levels).collect()}
    assert len(got) == len(points)
    each = legs.collect()
    for i, line, lat, lon, heading in points:
        if lat is None or lat != lat or line in (3, None):
            assert got[i].segment_id is None and got[i].off_m is None
            continue
        px, py, best = lon * east, lat * north, None
        for leg in (x for x in each if x.line == line):
            dx, dy = leg.bx - leg.ax, leg.by - leg.ay
            square = dx * dx + dy * dy
            t = min(max(((px - leg.ax) * dx + (py - leg.ay) * dy) / square, 0), 1) if square else 0
            off = (px - leg.ax - t * dx) ** 2 + (py - leg.ay - t * dy) ** 2
            best = min(best or (math.inf,), (off, leg.segment_id, leg.leg, leg.from_m + t * leg.length_m, leg.total_m, dx, dy))
        r = got[i]
        assert (r.segment_id, r.leg) == best[1:3] and r.off_m == pytest.approx(math.sqrt(best[0]))
        assert r.along_m == pytest.approx(best[3]) and 0 <= r.along_m <= r.total_m + 1e-6
        if heading is not None and best[4]:
            forward = best[5] * math.sin(math.radians(heading)) + best[6] * math.cos(math.radians(heading)) >= 0
            assert r.forward == forward
            assert r.share == pytest.approx((best[3] if forward else best[4] - best[3]) / best[4])
    assert tracks.snap(df.limit(0), legs, ["id"], 41.8).count() == 0
    assert tracks.snap(df, legs.limit(0), ["id"], 41.8).filter("segment_id is null").count() == len(points)


def test_snap_plan_has_no_cross_join(spark):
    legs = tracks.legs(spark.createDataFrame([(1, 1, [[[-87.0, 41.8], [-87.1, 41.8]]])],
                                             "segment_id long, line long, coordinates array<array<array<double>>>"), 41.8)
    points = spark.createDataFrame([(1, 1, 41.8, -87.05)], "id long, line long, lat double, lon double")
    plan = tracks.snap(points, legs, ["id"], 41.8)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def _dense(spark, n=400, size=3000, length=500):
    rng = random.Random(9)
    north, east = tracks.metres_per_degree(41.8)
    given = []
    for segment in range(n):
        x, y = rng.uniform(0, size), rng.uniform(0, size)
        to = x + rng.uniform(-length, length), y + rng.uniform(-length, length)
        given.append((segment, 1, [[[x / east, y / north], [to[0] / east, to[1] / north]]]))
    legs = tracks.legs(spark.createDataFrame(given, "segment_id long, line long, coordinates array<array<array<double>>>"), 41.8)
    points = spark.createDataFrame([(i, 1, rng.uniform(0, size) / north, rng.uniform(0, size) / east) for i in range(500)],
                                   "id long, line long, lat double, lon double")
    return points, legs


def test_snap_broadcasts_no_legs(spark, monkeypatch):
    points, legs = _dense(spark)
    plans, kept = [], tracks.written

    def seen(df, purpose):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, purpose)

    monkeypatch.setattr(tracks, "written", seen)
    assert tracks.snap(points, legs, ["id"], 41.8).filter("segment_id is null").count() == 0
    assert plans and not any("Broadcast" in plan for plan in plans)


def test_dense_legs_have_a_finer_grid(spark):
    points, legs = _dense(spark)
    north, east = tracks.metres_per_degree(41.8)
    left = points.select("id", "line", (F.col("lon") * east).alias("__x"), (F.col("lat") * north).alias("__y"))
    assert tracks._first_level(left, legs, "line", 1000.0) < 0
    assert tracks._first_level(left.limit(0), legs, "line", 1000.0) == 0
    got = tracks.snap(points, legs, ["id"], 41.8, grid_m=1000.0)
    want = tracks.snap(points, legs, ["id"], 41.8, grid_m=1e6)
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.mark.parametrize("reach", [15.0, 90.0, 700.0])
def test_cells_hold_all_legs_within_reach(spark, reach):
    points, legs = _dense(spark, n=40)
    cells = [(r.segment_id, r["__cx"], r["__cy"]) for r in tracks._cells(legs, reach).collect()]
    assert len(cells) == len(set(cells))
    rng, held = random.Random(10), set(cells)
    for leg in legs.collect():
        for _ in range(100):  # points as far from the leg as it reaches
            t, turn = rng.random(), rng.uniform(0, 2 * math.pi)
            x = leg.ax + t * (leg.bx - leg.ax) + 0.999 * reach * math.cos(turn)
            y = leg.ay + t * (leg.by - leg.ay) + 0.999 * reach * math.sin(turn)
            assert (leg.segment_id, math.floor(x / (2 * reach)), math.floor(y / (2 * reach))) in held


@pytest.mark.parametrize("seconds, bucket", [(60, None), (300, 900)])
def test_earliest_within_scans_once(spark, seconds, bucket):
    rng = random.Random(11)
    rows = [(rng.choice(("a", "a", "b", None)), T0 + timedelta(seconds=rng.randrange(0, 2400, 20)), n, None, rng.choice((None, 1.0, 2.0)))
            for n in range(600)] + [("a", None, 600, None, 1.0), ("a", None, 601, None, None)]
    got = ordered.with_earliest_within(spark.createDataFrame(rows, ROWS), ["run"], "ts", {"first": "v", "since": "ts"},
                                       seconds, bucket_seconds=bucket)
    assert got.columns == ["run", "ts", "n", "station", "v", "first", "since"]
    # A frame by range would visit the rows in the window of every row.
    assert "RangeFrame" not in got._jdf.queryExecution().executedPlan().toString()
    shown = {r.n: (r.since, r.first) for r in got.collect()}
    assert len(shown) == len(rows)
    order = lambda r: (r[1] or T0, r[4] is not None, r[4] or 0)
    for run, ts, n, _, _ in rows:
        inside = [r for r in rows if r[0] == run and (r[1] is None if ts is None else r[1] is not None and 0 <= secs(ts, r[1]) <= seconds)]
        least = min(inside, key=order)
        assert shown[n][1] == least[4] and (shown[n][0] and shown[n][0].astimezone(timezone.utc)) == least[1]
