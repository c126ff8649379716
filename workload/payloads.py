"""Payload normalisation: JSON built row by row from the tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from headway.functions import epoch_seconds, grid_coordinates, iso_date, iso_timestamp, nws_grid_id
from headway.functions import payload as p
from headway.operators import network, trains
from workload.tables import events, spread, table


def num(value: Column) -> Column:
    return value.cast("string")


def txt(value: Column | str) -> Column:
    value = F.lit(value) if isinstance(value, str) else value.cast("string")
    return F.concat(F.lit('"'), value, F.lit('"'))


def obj(**fields: Column) -> Column:
    """JSON object from JSON fragments; a NULL fragment leaves its key out."""
    parts = [F.concat(F.lit(f'"{k.lstrip("_")}":'), v) for k, v in fields.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def arr(*fragments: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *fragments), F.lit("]"))


def snapshots(spark, sf_dir):
    return snapshots_of(spread(table(spark, sf_dir, "lineitem")))


def snapshots_of(lineitem):
    """One poll per line item: odd line numbers hold a single train as an object, even
    ones a list of two trains (the second with swapped flags and numbers unquoted)."""
    c = F.col
    run = F.concat_ws("-", c("l_orderkey"), c("l_linenumber"), c("l_partkey"))
    lat, lon = c("l_quantity") * 2, -(c("l_extendedprice") / 500)
    app = F.when(c("l_returnflag") != "N", F.when(c("l_linestatus") == "O", txt("1")).otherwise(txt("0")))
    dly = F.when(c("l_tax") == 0.08, txt("late")).when(c("l_tax") == 0.07, F.lit("null")).when(
        c("l_tax") > 0.03, txt("1"))
    names = {"nextStaId": txt(c("l_suppkey")), "nextStaNm": txt(F.concat(F.lit("S"), c("l_suppkey"))),
             "destSt": txt(c("l_partkey")), "prdt": txt("p"), "arrT": txt("a")}
    single = obj(rn=txt(run), lat=txt(lat), lon=txt(lon), heading=txt(c("l_linenumber") * 45),
                 isApp=app, isDly=dly, **names)
    second = obj(rn=txt(F.concat(run, F.lit("b"))), lat=num(lat), lon=num(lon), isApp=txt("0"), isDly=app)
    found = F.when(c("l_linenumber") % 2 == 1, single).otherwise(arr(single, second))
    code = F.when(c("l_discount") == 0.1, txt("102")).when(c("l_discount") > 0, txt("0"))
    routes = F.when(c("l_discount") != 0.09, arr(F.concat(
        F.lit('{"@name":'), txt(c("l_returnflag")), F.lit(',"train":'), found, F.lit("}"))))
    body = obj(tmst=txt(F.date_format("l_shipdate", "yyyy-MM-dd")), errCd=code,
               errNm=F.when(c("l_discount") == 0.1, txt("quota")), route=routes)
    return lineitem.select(
        obj(ctatt=body).alias("payload"), c("l_shipdate").cast("timestamp").alias("poll_timestamp"))


def _shown(good):
    return good.withColumn("poll_timestamp", epoch_seconds(F.col("poll_timestamp")))


def normalize_positions(spark, sf_dir):
    return _shown(trains.train_positions(snapshots(spark, sf_dir))[0])


def strict_positions(spark, sf_dir):
    good = trains.train_positions(snapshots(spark, sf_dir), strict_poll=True)[0]
    return good.groupBy("route").agg(F.count(F.lit(1)).alias("trains"))


def rejected_positions(spark, sf_dir):
    bad = trains.train_positions(snapshots(spark, sf_dir))[1]
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("rejected"))


def api_errors(spark, sf_dir):
    return _shown(trains.api_errors(snapshots(spark, sf_dir)))


def station_payloads(spark, sf_dir):
    c = F.col
    x, y = c("c_acctbal") / 100, c("c_custkey") % 90
    xy = (F.when(c("c_nationkey") == 1, arr(num(x))).when(c("c_nationkey") == 2, arr(txt(x), txt(y)))
          .when(c("c_nationkey") == 3, arr(txt("east"), num(y))).otherwise(arr(num(x), num(y), num(x))))
    geometry = F.when(c("c_nationkey") != 0, obj(type=txt("Point"), coordinates=xy))
    return table(spark, sf_dir, "customer").select(obj(
        station_id=txt(c("c_custkey")), longname=txt(c("c_name")),
        address=F.when(c("c_nationkey") % 2 == 0, txt(c("c_mktsegment"))), lines=txt("Red, Blue"),
        the_geom=geometry).alias("payload"))


def normalize_stations(spark, sf_dir):
    return network.stations(station_payloads(spark, sf_dir))[0]


def rejected_stations(spark, sf_dir):
    return network.stations(station_payloads(spark, sf_dir))[1].groupBy("reason").agg(
        F.count(F.lit(1)).alias("rejected"))


def track_payloads(spark, sf_dir):
    """Four geometry shapes by line number: one line; an empty, a 3-D and a non-list line;
    bad points among good ones; text-only points (nothing left)."""
    c = F.col
    lon, lat = num(c("l_quantity") * -4), num(c("l_discount") * 100)
    lon2, lat2 = num(c("l_tax") * 10), num(c("l_linenumber") * 1.5)
    shape = c("l_linenumber") % 4
    start, end = arr(lon, lat), arr(lon2, lat2)
    coordinates = (
        F.when(shape == 0, arr(arr(start, end)))
        .when(shape == 1, arr(F.lit("[]"), arr(arr(lon, lat, F.lit("5"))), txt("x"), arr(end)))
        .when(shape == 2, arr(arr(F.lit('["a",1]'), start, F.lit("[3]")), arr(end, arr(lon, lat2))))
        .otherwise(F.lit('[[["1","2"]]]')))
    description = (
        F.when(c("l_returnflag") == "A", txt(F.concat(
            F.lit("  P"), c("l_partkey"), F.lit(" to S"), c("l_suppkey"), F.lit(" to end "))))
        .when(c("l_returnflag") == "N", txt("NoDelimiterHere"))
        .when(c("l_linestatus") == "O", txt(" to B")))
    return spread(table(spark, sf_dir, "lineitem")).select(obj(
        lines=txt(F.concat(F.lit(" Red, ,"), c("l_linestatus"))), description=description,
        type=txt("Subway"), legend=F.when(c("l_tax") > 0.04, txt(" L1 ")).otherwise(txt("")),
        shape_len=F.when(c("l_returnflag") == "A", txt(c("l_extendedprice"))).when(
            c("l_returnflag") == "N", txt("long")),
        the_geom=obj(type=txt("MultiLineString"), coordinates=coordinates)).alias("payload"))


def _segments(spark, sf_dir, digest="sha256"):
    return network.track_segments(track_payloads(spark, sf_dir), digest)[0]


def track_endpoints(spark, sf_dir):
    return _segments(spark, sf_dir).select(
        "description", "endpoint_a", "endpoint_b", "legend", "shape_len",
        F.array_join("lines", "+").alias("line_names"),
        "start_lat", "start_lon", "end_lat", "end_lon")


def track_bbox(spark, sf_dir):
    return _segments(spark, sf_dir).select(
        "start_lon", "bbox.*", F.size("geometry.coordinates").alias("n_lines"),
        F.size(F.flatten("geometry.coordinates")).alias("n_points"))


def segment_ids(spark, sf_dir):
    return _segments(spark, sf_dir).groupBy("segment_id").agg(F.count(F.lit(1)).alias("segments"))


def segment_ids_blake2s(spark, sf_dir):
    return _segments(spark, sf_dir, "blake2s").groupBy("segment_id").agg(
        F.count(F.lit(1)).alias("segments"))


def grid_parse(spark, sf_dir):
    """Forecast URLs and "lat,lon" ids per customer."""
    c = F.col
    office = F.when(c("c_nationkey") % 4 == 0, F.lower(c("c_mktsegment"))).otherwise(c("c_mktsegment"))
    url = F.concat(F.lit("https://w/gridpoints/"), office, F.lit("/"), c("c_nationkey"), F.lit(","),
                   c("c_custkey"), F.when(c("c_nationkey") == 5, F.lit("")).otherwise(F.lit("/forecast")))
    text = F.concat(c("c_nationkey") * 5, F.lit(","), c("c_acctbal") / 50,
                    F.when(c("c_nationkey") == 7, F.lit(",1")).otherwise(F.lit("")))
    at = grid_coordinates(text)
    return table(spark, sf_dir, "customer").select(
        "c_custkey", nws_grid_id(url).alias("nws_grid_id"), at.lat.alias("lat"), at.lon.alias("lon"))


def required_path(spark, sf_dir):
    doc = (F.when(F.col("event_type") == "view", F.lit('{"a":{}}'))
           .when(F.col("event_type") == "click", F.lit('{"a":3}'))
           .when(F.col("event_type") == "signup", F.lit('{"a":{"b":null}}'))
           .otherwise(F.concat(F.lit('{"a":{"b":'), F.col("props"), F.lit("}}"))))
    return events(spark, sf_dir).select(
        "event_id", p.required_path(p.parse(doc), "a.b").alias("reason"))


def json_extract(spark, sf_dir):
    doc = p.parse(F.col("props"))
    return events(spark, sf_dir).select(
        "event_id", p.whole(doc, "k").alias("k"), p.at(doc, "z").isNull().alias("no_z"),
        F.to_json(F.struct("user_id", "event_type")).alias("encoded"))


def parse_dates(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("date="), day)).otherwise(day)
    stamp = F.when(F.col("o_orderstatus") == "F", F.lit("later")).otherwise(
        F.concat(day, F.lit("T10:20:30+00:00")))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", iso_date(text).cast("string").alias("day"),
        epoch_seconds(iso_timestamp(stamp)).alias("at"))


QUERIES = {
    "normalize_positions": normalize_positions,
    "strict_positions": strict_positions,
    "rejected_positions": rejected_positions,
    "api_errors": api_errors,
    "normalize_stations": normalize_stations,
    "rejected_stations": rejected_stations,
    "track_endpoints": track_endpoints,
    "track_bbox": track_bbox,
    "segment_id": segment_ids,
    "segment_id_blake2s": segment_ids_blake2s,
    "grid_parse": grid_parse,
    "required_path": required_path,
    "json_extract": json_extract,
    "parse_dates": parse_dates,
}

_SNAPSHOTS = """polls AS (SELECT *, row_number() OVER () AS poll, l_quantity * 2 AS lat,
        -(l_extendedprice / 500) AS lon,
        concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS run,
        l_returnflag <> 'N' AND l_linestatus = 'O' AS app FROM lineitem),
    usable AS (SELECT * FROM polls WHERE l_discount NOT IN (0.1, 0.09)),
    trains AS (
        SELECT poll, l_shipdate, l_returnflag, run AS train_id, lat, lon,
            (l_linenumber * 45)::BIGINT AS heading, l_suppkey::VARCHAR AS next_station_id,
            'S' || l_suppkey AS next_station_name, l_partkey::VARCHAR AS destination_id,
            'p' AS prediction_time, 'a' AS predicted_arrival_time, app AS is_approaching,
            l_tax > 0.03 AS is_delayed, l_tax IN (0.07, 0.08) AS bad_flag FROM usable
        UNION ALL
        SELECT poll, l_shipdate, l_returnflag, run || 'b', lat, lon, NULL, NULL, NULL, NULL, NULL,
            NULL, false, app, false FROM usable WHERE l_linenumber % 2 = 0),
    judged AS (SELECT *, CASE WHEN lat > 90 OR lon < -180 THEN 'invalid coordinates'
        WHEN bad_flag THEN 'invalid isDly flag' END AS reason FROM trains)"""
_TRACKS = """shaped AS (SELECT *, l_linenumber % 4 AS shape, l_quantity * -4 AS lon,
        l_discount * 100 AS lat, l_tax * 10 AS lon2, l_linenumber * 1.5::DOUBLE AS lat2,
        CASE WHEN l_returnflag = 'A' THEN 'P' || l_partkey || ' to S' || l_suppkey || ' to end'
             WHEN l_returnflag = 'N' THEN 'NoDelimiterHere'
             WHEN l_linestatus = 'O' THEN 'to B' END AS description,
        CASE WHEN l_tax > 0.04 THEN 'L1' END AS legend,
        CASE WHEN l_returnflag = 'A' THEN l_extendedprice END AS shape_len FROM lineitem),
    segments AS (SELECT *, CASE WHEN shape = 2 THEN lon ELSE lon2 END AS end_lon,
        CASE WHEN l_returnflag = 'A' THEN 'P' || l_partkey ELSE description END AS endpoint_a,
        CASE WHEN l_returnflag = 'A' THEN 'S' || l_suppkey || ' to end' ELSE description END
            AS endpoint_b FROM shaped WHERE shape < 3 AND lon >= -180)"""

ORACLE = {
    "normalize_positions": f"""WITH {_SNAPSHOTS} SELECT epoch_us(l_shipdate) / 1e6 AS poll_timestamp,
        strftime(l_shipdate, '%Y-%m-%d') AS api_timestamp, l_returnflag AS route, train_id, lat, lon,
        heading, next_station_id, next_station_name, destination_id, NULL::VARCHAR AS destination_name,
        prediction_time, predicted_arrival_time, is_approaching, is_delayed
        FROM judged WHERE reason IS NULL""",
    "strict_positions": f"""WITH {_SNAPSHOTS}, ok AS (SELECT poll, any_value(l_returnflag) AS route,
        count(*) AS n FROM judged GROUP BY poll HAVING count(reason) = 0)
        SELECT route, sum(n)::BIGINT AS trains FROM ok GROUP BY 1""",
    "rejected_positions": f"""WITH {_SNAPSHOTS} SELECT reason, count(*) AS rejected FROM (
        SELECT reason FROM judged WHERE reason IS NOT NULL
        UNION ALL SELECT 'API error' FROM polls WHERE l_discount = 0.1) GROUP BY 1""",
    "api_errors": """SELECT epoch_us(l_shipdate) / 1e6 AS poll_timestamp, '102' AS err_cd,
        'quota' AS err_nm FROM lineitem WHERE l_discount = 0.1""",
    "normalize_stations": """SELECT c_custkey::VARCHAR AS id, c_name AS name,
        CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment ELSE '' END AS address,
        'Red, Blue' AS lines, (c_custkey % 90)::DOUBLE AS latitude, c_acctbal / 100 AS longitude
        FROM customer WHERE c_nationkey NOT IN (0, 1, 3)""",
    "rejected_stations": """SELECT CASE c_nationkey WHEN 0 THEN 'no geometry'
        WHEN 1 THEN 'fewer than two coordinates' ELSE 'coordinate is not a number' END AS reason,
        count(*) AS rejected FROM customer WHERE c_nationkey IN (0, 1, 3) GROUP BY 1""",
    "track_endpoints": f"""WITH {_TRACKS} SELECT description, endpoint_a, endpoint_b, legend, shape_len,
        'Red+' || l_linestatus AS line_names, lat AS start_lat, lon AS start_lon, lat2 AS end_lat,
        end_lon FROM segments""",
    "track_bbox": f"""WITH {_TRACKS} SELECT lon AS start_lon, least(lon, lon2) AS min_lon,
        least(lat, lat2) AS min_lat, greatest(lon, lon2) AS max_lon, greatest(lat, lat2) AS max_lat,
        CASE WHEN shape = 0 THEN 1 ELSE 2 END::INTEGER AS n_lines,
        CASE WHEN shape = 2 THEN 3 ELSE 2 END::INTEGER AS n_points FROM segments""",
    "segment_id": f"""WITH {_TRACKS}, texts AS (SELECT concat_ws('|', 'Red,' || l_linestatus,
        coalesce(description, ''), 'Subway', coalesce(legend, ''),
        coalesce(printf('%.6f', shape_len), ''), printf('%.6f,%.6f', lon, lat),
        printf('%.6f,%.6f', end_lon, lat2)) AS t FROM segments)
        SELECT left(sha256(t), 16) AS segment_id, count(*) AS segments FROM texts GROUP BY 1""",
    "grid_parse": """SELECT c_custkey, CASE WHEN c_nationkey % 4 <> 0 AND c_nationkey <> 5
        THEN c_mktsegment || '/' || c_nationkey || ',' || c_custkey END AS nws_grid_id,
        CASE WHEN ok THEN (c_nationkey * 5)::DOUBLE END AS lat,
        CASE WHEN ok THEN c_acctbal / 50 END AS lon
        FROM (SELECT *, c_nationkey * 5 <= 90 AND abs(c_acctbal / 50) <= 180 AND c_nationkey <> 7
              AS ok FROM customer)""",
    "required_path": """SELECT event_id, CASE event_type
        WHEN 'view' THEN 'missing required field ''a.b'''
        WHEN 'click' THEN 'expected object at ''a''' END AS reason FROM events""",
    "json_extract": """SELECT event_id, json_extract(props, '$.k')::BIGINT AS k,
        json_extract(props, '$.z') IS NULL AS no_z,
        json_object('user_id', user_id, 'event_type', event_type)::VARCHAR AS encoded FROM events""",
    "parse_dates": """SELECT o_orderkey,
        CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
        CASE WHEN o_orderstatus <> 'F' THEN
            epoch_us(o_orderdate + INTERVAL 37230 SECOND) / 1e6 END AS at FROM orders""",
}
