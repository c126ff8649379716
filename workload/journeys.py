"""Labels and features of train runs: events as polls of runs, parts as track vertices."""

from __future__ import annotations

from pyspark.sql import functions as F

from headway.functions import epoch_seconds
from headway.operators import journeys, tracks
from headway.operators.ordered import as_of_join
from workload.tables import events, newest, table

C = F.col
#: Rows of a (key, hour) in one task: small, so that busy hours of the tables are cut.
MOST_ROWS = 64
#: A run is gone when it is not polled for eight hours.
GONE_S = 8 * 3600
#: Weather is matched up to six hours back.
TOLERANCE_S = 6 * 3600
#: Latitude of the plane on which tracks are measured.
LATITUDE = 41.8


def _routes(spark, sf_dir):
    """A third of all users is on route 0."""
    return events(spark, sf_dir).withColumn("route", F.when(C("user_id") % 3 == 0, 0).otherwise(C("user_id") % 12))


def weather_asof(spark, sf_dir):
    """Positions (all but errors) with the weather (errors' values) of their route."""
    rows = _routes(spark, sf_dir)
    trains = rows.filter("event_type <> 'error'").select("route", "ts", "event_id")
    weather = rows.filter("event_type = 'error'").select("route", "ts", C("value").alias("temperature"), C("event_id").alias("observation"))
    joined = as_of_join(trains, weather, ["route"], "ts", ["temperature", "observation"], TOLERANCE_S,
                        ties=["observation"], most_rows=MOST_ROWS)
    return joined.select("event_id", "route", "temperature", "observation", epoch_seconds(C("matched_ts")).alias("matched_ts"))


def _runs(spark, sf_dir):
    """One run per user; the station ahead changes with the value's size, sometimes unknown."""
    station = F.when(C("event_type") != "error", F.floor(C("value") / 40).cast("int"))
    return events(spark, sf_dir).select(C("user_id").alias("run"), "ts", "event_id", station.alias("station"))


_HOW = dict(ties=["event_id"], most_rows=MOST_ROWS)


def arrivals(spark, sf_dir):
    runs = _runs(spark, sf_dir)
    found = journeys.arrivals(runs.select("run", "ts", "event_id", "station"), ["run"], "ts", "station", GONE_S, newest(runs), **_HOW)
    return found.select("run", epoch_seconds(C("ts")).alias("ts"), "kind", "station")


def time_to_arrival(spark, sf_dir):
    runs = _runs(spark, sf_dir)
    known = journeys.time_to_arrival(runs, ["run"], "ts", "station", GONE_S, newest(runs), **_HOW)
    return known.select("event_id", "run", epoch_seconds(C("arrival_ts")).alias("arrival_ts"), "seconds_to_arrival")


def dwell_time(spark, sf_dir):
    """Stays of routes, the busy one included; users give the place."""
    rows = _routes(spark, sf_dir).withColumn("place", F.when(C("event_type") != "error", (C("value") > 60).cast("int")))
    stays = journeys.dwell_times(rows, ["route"], "ts", "place", **_HOW)
    return stays.select("route", "place", epoch_seconds(C("first_ts")).alias("first_ts"),
                        epoch_seconds(C("last_ts")).alias("last_ts"), C("rows").alias("polls"), "dwell_seconds")


def speeds(spark, sf_dir):
    """Fifteen runs with an hour of the table's time as a minute."""
    at = F.timestamp_micros(F.floor(F.unix_micros("ts") / 60).cast("long"))
    rows = events(spark, sf_dir).select(
        (C("user_id") % 15).alias("run"), at.alias("ts"), "event_id", F.floor(C("value") / 40).cast("int").alias("segment"),
        (C("value") * 10).alias("along"), F.lit(5000.0).alias("total"))
    moved = journeys.travelled(rows, ["run"], "ts", "segment", "along", "total", ties=["event_id"])
    return journeys.speeds(moved, ["run"], "ts", "odometer_mm", ties=["event_id"]).select(
        "event_id", "run", "moved_mm", "odometer_mm", "speed_1m", "speed_3m", "speed_5m")


def _legs(spark, sf_dir):
    """Eight parts are the points of a segment of two lines: five and three points."""
    key = C("p_partkey")
    segment = F.floor(key / 8).cast("long")
    turn = F.when(segment % 2 == 0, 1.0).otherwise(-1.0)
    lat = 41.6 + (segment * 104729) % 10007 / 10007.0 * 0.4 + key % 8 * 0.004 * turn + C("p_size") / 50.0 * 0.003
    lon = -87.9 + (segment * 15485863) % 10007 / 10007.0 * 0.4 + key % 8 * 0.003 + (C("p_retailprice") - F.floor("p_retailprice")) * 0.002
    points = table(spark, sf_dir, "part").select(segment.alias("segment_id"), (key % 8).alias("i"), F.array(lon, lat).alias("xy"))
    whole = points.groupBy("segment_id").agg(F.array_sort(F.collect_list(F.struct("i", "xy"))).alias("p"))
    lines = F.array(F.slice("p.xy", 1, 5), F.slice("p.xy", 6, 3))
    return tracks.legs(whole.select("segment_id", (C("segment_id") % 25).alias("line"), lines.alias("coordinates")), LATITUDE)


def snap_to_track(spark, sf_dir):
    """Customers on the nearest track of their line."""
    points = table(spark, sf_dir, "customer").select(
        "c_custkey", (C("c_custkey") % 25).alias("line"), (41.6 + (C("c_custkey") * 7919) % 10007 / 10007.0 * 0.4).alias("lat"),
        (-87.9 + (C("c_acctbal") + 1000.0) / 11000.0 * 0.4).alias("lon"))
    on = tracks.snap(points, _legs(spark, sf_dir), ["c_custkey"], LATITUDE)
    return on.select("c_custkey", "segment_id", "leg", F.round("off_m", 3).alias("off_m"),
                     F.round("snapped_lat", 7).alias("snapped_lat"), F.round("snapped_lon", 7).alias("snapped_lon"))


def distance_along(spark, sf_dir):
    """Events as positions with a heading: distance along the track and share of the segment."""
    points = events(spark, sf_dir).select(
        "event_id", (C("user_id") % 25).alias("line"), (41.6 + (C("event_id") * 7919) % 10007 / 10007.0 * 0.4).alias("lat"),
        (-87.9 + C("value") / 500.0 * 0.4).alias("lon"), (C("event_id") * 37 % 360).alias("heading"))
    on = tracks.snap(points, _legs(spark, sf_dir), ["event_id"], LATITUDE, heading="heading", grid_m=1000.0)
    return on.select("event_id", "segment_id", F.round("along_m", 3).alias("along_m"), "forward", F.round("share", 6).alias("share"))


def station_spacing(spark, sf_dir):
    """Distance on the ellipsoid between customers whose keys follow each other."""
    at = table(spark, sf_dir, "customer").select(
        "c_custkey", (41.6 + C("c_nationkey") * 0.01).alias("lat"), (-87.9 + C("c_acctbal") / 100000.0).alias("lon"))
    to = at.select((C("c_custkey") - 1).alias("c_custkey"), C("lat").alias("lat2"), C("lon").alias("lon2"))
    off = tracks.ground_distance_m(C("lat"), C("lon"), C("lat2"), C("lon2"))
    return at.join(to, "c_custkey").select("c_custkey", F.round(off, 4).alias("metres"))


QUERIES = {
    "weather_asof": weather_asof,
    "arrivals": arrivals,
    "time_to_arrival": time_to_arrival,
    "dwell_time": dwell_time,
    "speeds": speeds,
    "snap_to_track": snap_to_track,
    "distance_along": distance_along,
    "station_spacing": station_spacing,
}

_ROUTE = "CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id % 12 END AS route"
_RUNS = """polls AS (SELECT user_id AS run, ts, event_id,
    CASE WHEN event_type <> 'error' THEN floor(value / 40)::INTEGER END AS station FROM events),
ends AS (SELECT *, lag(ts) OVER w AS prev_ts, lag(station) OVER w AS prev_station, lead(ts) OVER w AS next_ts,
    lead(station) OVER w AS next_station, (SELECT max(ts) FROM events) AS as_of
    FROM polls WINDOW w AS (PARTITION BY run ORDER BY ts, event_id)),
linked AS (SELECT *, coalesce(epoch_us(ts) - epoch_us(prev_ts) > 28800000000, true) AS appears,
    epoch_us(coalesce(next_ts, as_of)) - epoch_us(ts) > 28800000000 AS vanishes FROM ends)"""

_NORTH, _EAST = tracks.metres_per_degree(LATITUDE)
_LEGS = f"""points AS (SELECT p_partkey // 8 AS segment_id, p_partkey % 8 AS i,
    (-87.9::DOUBLE + (p_partkey // 8 * 15485863) % 10007 / 10007e0 * 0.4::DOUBLE + p_partkey % 8 * 0.003::DOUBLE
      + (p_retailprice - floor(p_retailprice)) * 0.002::DOUBLE) * {_EAST!r}::DOUBLE AS x,
    (41.6::DOUBLE + (p_partkey // 8 * 104729) % 10007 / 10007e0 * 0.4::DOUBLE
      + p_partkey % 8 * 0.004::DOUBLE * (CASE WHEN p_partkey // 8 % 2 = 0 THEN 1 ELSE -1 END)::DOUBLE
      + p_size / 5e1 * 0.003::DOUBLE) * {_NORTH!r}::DOUBLE AS y FROM part),
pairs AS (SELECT a.segment_id, a.segment_id % 25 AS line, a.i, a.x AS ax, a.y AS ay, b.x AS ex, b.y AS ey,
    sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) AS length_m
    FROM points a JOIN points b ON a.segment_id = b.segment_id AND b.i = a.i + 1 AND a.i <> 4),
legs AS (SELECT *, (row_number() OVER w)::INTEGER AS leg, sum(length_m) OVER w - length_m AS from_m,
    sum(length_m) OVER (PARTITION BY segment_id) AS total_m FROM pairs WINDOW w AS (PARTITION BY segment_id ORDER BY i)),
shares AS (SELECT *, ex - ax AS dx, ey - ay AS dy, (ex - ax) * (ex - ax) + (ey - ay) * (ey - ay) AS sq FROM legs),
tried AS (SELECT *, CASE WHEN sq > 0 THEN least(greatest(((px - ax) * dx + (py - ay) * dy) / sq, 0e0), 1e0) ELSE 0 END AS t
    FROM here JOIN shares USING (line)),
placed AS (SELECT *, (px - (ax + t * dx)) * (px - (ax + t * dx)) + (py - (ay + t * dy)) * (py - (ay + t * dy)) AS d2 FROM tried),
best AS (SELECT * FROM placed QUALIFY row_number() OVER (PARTITION BY id ORDER BY d2, segment_id, leg) = 1)"""

ORACLE = {
    "weather_asof": f"""WITH rows AS (SELECT *, {_ROUTE} FROM events),
        weather AS (SELECT route, ts, value, event_id FROM rows WHERE event_type = 'error'
                    QUALIFY row_number() OVER (PARTITION BY route, ts ORDER BY event_id DESC) = 1),
        found AS (SELECT t.event_id, t.route, w.value, w.event_id AS observation, w.ts AS matched,
                  epoch_us(t.ts) - epoch_us(w.ts) <= 21600000000 AS fits
                  FROM (SELECT * FROM rows WHERE event_type <> 'error') t
                  ASOF LEFT JOIN weather w ON t.route = w.route AND t.ts >= w.ts)
        SELECT event_id, route, CASE WHEN fits THEN value END AS temperature, CASE WHEN fits THEN observation END AS observation,
               CASE WHEN fits THEN epoch_us(matched) / 1e6 END AS matched_ts FROM found""",
    "arrivals": f"""WITH {_RUNS}
        SELECT run, epoch_us(ts) / 1e6 AS ts, 'appeared' AS kind, station FROM linked WHERE appears
        UNION ALL SELECT run, epoch_us(ts) / 1e6, 'changed', prev_station FROM linked WHERE NOT appears AND prev_station <> station
        UNION ALL SELECT run, epoch_us(ts) / 1e6, 'vanished', station FROM linked WHERE vanishes""",
    "time_to_arrival": f"""WITH {_RUNS}, marked AS (SELECT *, CASE WHEN vanishes THEN ts WHEN next_station <> station THEN next_ts END AS m FROM linked),
        known AS (SELECT *, min(m) OVER (PARTITION BY run ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS arrival FROM marked)
        SELECT event_id, run, epoch_us(arrival) / 1e6 AS arrival_ts, (epoch_us(arrival) - epoch_us(ts)) / 1e6 AS seconds_to_arrival FROM known""",
    "dwell_time": f"""WITH rows AS (SELECT *, {_ROUTE}, CASE WHEN event_type <> 'error' THEN (value > 60)::INTEGER END AS place FROM events),
        numbered AS (SELECT *, row_number() OVER (PARTITION BY route ORDER BY ts, event_id)
                     - row_number() OVER (PARTITION BY route, place ORDER BY ts, event_id) AS island FROM rows)
        SELECT route, place, epoch_us(min(ts)) / 1e6 AS first_ts, epoch_us(max(ts)) / 1e6 AS last_ts, count(*) AS polls,
               (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS dwell_seconds
        FROM numbered WHERE place IS NOT NULL GROUP BY route, place, island""",
    "speeds": """WITH rows AS (SELECT user_id % 15 AS run, make_timestamp(epoch_us(ts) // 60) AS t, event_id,
            floor(value / 40)::INTEGER AS segment, value * 10 AS along FROM events),
        linked AS (SELECT *, lag(segment) OVER w AS s, lag(along) OVER w AS a FROM rows WINDOW w AS (PARTITION BY run ORDER BY t, event_id)),
        moves AS (SELECT *, coalesce(round((CASE WHEN s = segment THEN abs(along - a) ELSE 5000 - a + along END) * 1000), 0)::BIGINT AS moved_mm
                  FROM linked),
        odo AS (SELECT *, (sum(moved_mm) OVER (PARTITION BY run ORDER BY t, event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS odometer_mm FROM moves),
        back AS (SELECT *, """ + ", ".join(
            f"""min({{'t': t, 'e': event_id, 'o': odometer_mm}}) OVER (PARTITION BY run ORDER BY t
                RANGE BETWEEN INTERVAL {m} MINUTE PRECEDING AND CURRENT ROW) AS b{m}""" for m in (1, 3, 5)) + """ FROM odo)
        SELECT event_id, run, moved_mm, odometer_mm, """ + ", ".join(
            f"""CASE WHEN t > b{m}.t THEN (odometer_mm - b{m}.o) * 1000e0 / (epoch_us(t) - epoch_us(b{m}.t)) END AS speed_{m}m"""
            for m in (1, 3, 5)) + " FROM back",
    "snap_to_track": f"""WITH here AS (SELECT c_custkey AS id, c_custkey % 25 AS line,
            (41.6::DOUBLE + (c_custkey * 7919) % 10007 / 10007e0 * 0.4::DOUBLE) * {_NORTH!r}::DOUBLE AS py,
            (-87.9::DOUBLE + (c_acctbal + 1000e0) / 11000e0 * 0.4::DOUBLE) * {_EAST!r}::DOUBLE AS px FROM customer), {_LEGS}
        SELECT id AS c_custkey, segment_id, leg, round(sqrt(d2), 3) AS off_m, round((ay + t * dy) / {_NORTH!r}::DOUBLE, 7) AS snapped_lat,
               round((ax + t * dx) / {_EAST!r}::DOUBLE, 7) AS snapped_lon FROM here LEFT JOIN best USING (id)""",
    "distance_along": f"""WITH here AS (SELECT event_id AS id, user_id % 25 AS line, event_id * 37 % 360 AS heading,
            (41.6::DOUBLE + (event_id * 7919) % 10007 / 10007e0 * 0.4::DOUBLE) * {_NORTH!r}::DOUBLE AS py,
            (-87.9::DOUBLE + value / 500e0 * 0.4::DOUBLE) * {_EAST!r}::DOUBLE AS px FROM events), {_LEGS},
        told AS (SELECT *, from_m + t * length_m AS along, dx * sin(radians(b.heading)) + dy * cos(radians(b.heading)) >= 0 AS forward
                 FROM best b)
        SELECT id AS event_id, segment_id, round(along, 3) AS along_m, forward,
               round(CASE WHEN forward THEN along ELSE total_m - along END / total_m, 6) AS share
        FROM here LEFT JOIN told USING (id)""",
    "station_spacing": f"""WITH places AS (SELECT c_custkey, 41.6::DOUBLE + c_nationkey * 0.01::DOUBLE AS lat,
            -87.9::DOUBLE + c_acctbal / 100000e0 AS lon FROM customer),
        pairs AS (SELECT a.c_custkey, a.lat, a.lon, b.lat AS lat2, b.lon AS lon2, radians((a.lat + b.lat) / 2) AS phi
                  FROM places a JOIN places b ON b.c_custkey = a.c_custkey + 1),
        e AS (SELECT *, {tracks.FLATTENING * (2 - tracks.FLATTENING)!r}::DOUBLE AS sq FROM pairs),
        r AS (SELECT *, {tracks.SEMI_MAJOR_M!r}::DOUBLE * (1 - sq) / pow(1 - sq * sin(phi) ** 2, 1.5) * radians(lat2 - lat) AS north,
              {tracks.SEMI_MAJOR_M!r}::DOUBLE / sqrt(1 - sq * sin(phi) ** 2) * cos(phi) * radians(lon2 - lon) AS east FROM e)
        SELECT c_custkey, round(sqrt(north * north + east * east), 4) AS metres FROM r""",
}
