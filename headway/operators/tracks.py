"""Positions on the track: nearest track of the line, distance along it, share of a segment."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from headway.session import written

# The WGS-84 ellipsoid (semi-major axis in metres, flattening).
SEMI_MAJOR_M = 6378137.0
FLATTENING = 1 / 298.257223563
#: How often the first reach of a search may be halved.
FINEST = 16


def metres_per_degree(latitude: float) -> tuple[float, float]:
    """Length of a degree of latitude and of longitude on the ellipsoid at a latitude."""
    square = FLATTENING * (2 - FLATTENING)
    phi = math.radians(latitude)
    inner = 1 - square * math.sin(phi) ** 2
    meridian = SEMI_MAJOR_M * (1 - square) / inner ** 1.5
    normal = SEMI_MAJOR_M / math.sqrt(inner)
    return math.radians(meridian), math.radians(normal * math.cos(phi))


def ground_distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance on the ellipsoid, by its radii of curvature at the middle latitude.

    Right to some millimetres a kilometre over the extent of a city.
    """
    square = FLATTENING * (2 - FLATTENING)
    phi = F.radians((lat1 + lat2) / 2)
    inner = F.lit(1.0) - F.lit(square) * F.sin(phi) * F.sin(phi)
    meridian = F.lit(SEMI_MAJOR_M * (1 - square)) / (inner * F.sqrt(inner))
    normal = F.lit(SEMI_MAJOR_M) / F.sqrt(inner)
    north, east = meridian * F.radians(lat2 - lat1), normal * F.cos(phi) * F.radians(lon2 - lon1)
    return F.sqrt(north * north + east * east)


def legs(tracks: DataFrame, latitude: float, segment: str = "segment_id", line: str = "line",
         lines: str = "coordinates") -> DataFrame:
    """Straight legs of the tracks' lines of [lon, lat] points, with linear references.

    Returns segment, line, leg (from 1 along the segment), ax, ay, bx, by (metres on the
    plane of ``latitude``), from_m (distance from the segment's start to the leg), length_m and
    total_m.  Lines of a segment follow each other; the way between them does not count.
    A point without two numbers is left out; a line with one point is a leg of no length.
    """
    north, east = metres_per_degree(latitude)
    points = tracks.select(segment, line, F.posexplode(lines).alias("part", "points")).select(
        segment, line, "part", F.filter("points", lambda p: (F.get(p, F.lit(0)).isNotNull()) & (F.get(p, F.lit(1)).isNotNull())).alias("points"))
    # A leg from each point to the next; from a lone point to itself.
    to = F.when(F.size("points") > 1, F.slice("points", 2, F.size("points") - 1)).otherwise(F.col("points"))
    pairs = F.zip_with(F.slice("points", 1, F.size(to)), to, lambda a, b: F.struct(
        (F.get(a, F.lit(0)) * east).alias("ax"), (F.get(a, F.lit(1)) * north).alias("ay"),
        (F.get(b, F.lit(0)) * east).alias("bx"), (F.get(b, F.lit(1)) * north).alias("by")))
    each = points.filter(F.size("points") > 0).select(segment, line, "part", F.posexplode(pairs).alias("at", "leg")).select(
        segment, line, "part", "at", "leg.*")
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    own = Window.partitionBy(segment, line)
    upto = own.orderBy("part", "at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (each.withColumn("length_m", F.sqrt(dx * dx + dy * dy))
            .withColumns({"leg": F.row_number().over(own.orderBy("part", "at")),
                          "from_m": F.sum("length_m").over(upto) - F.col("length_m"),
                          "total_m": F.sum("length_m").over(own)})
            .select(segment, line, "leg", "ax", "ay", "bx", "by", "from_m", "length_m", "total_m"))


def _nearest(on_leg: DataFrame, keys: Sequence[str], segment: str) -> DataFrame:
    """The nearest leg of each point among the joined ones; ties by segment and leg."""
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    square = dx * dx + dy * dy
    along = ((F.col("__x") - F.col("ax")) * dx + (F.col("__y") - F.col("ay")) * dy) / square
    t = F.when(square > 0, F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(0.0))
    placed = on_leg.withColumn("__t", t).withColumns({"__px": F.col("ax") + F.col("__t") * dx, "__py": F.col("ay") + F.col("__t") * dy})
    offx, offy = F.col("__x") - F.col("__px"), F.col("__y") - F.col("__py")
    best = F.min(F.struct((offx * offx + offy * offy).alias("d2"), F.col(segment), F.col("leg"), F.col("__t").alias("t"),
                          F.col("__px").alias("px"), F.col("__py").alias("py"), "from_m", "length_m", "total_m",
                          dx.alias("dx"), dy.alias("dy")))
    return placed.groupBy(*keys, "__x", "__y").agg(best.alias("__best"))


def snap(points: DataFrame, track_legs: DataFrame, keys: Sequence[str], latitude: float, line: str = "line",
         segment: str = "segment_id", lat: str = "lat", lon: str = "lon", heading: str | None = None,
         grid_m: float = 250.0, levels: int = 8) -> DataFrame:
    """Every point on the nearest track of its own line, exactly, with its linear reference.

    ``keys`` tell points apart (the line is one of them or follows from them).  Legs lie
    in the cells of a grid that they reach into, so a point meets the legs near it by an
    equi-join on (line, cell).  A leg found within the reach is the nearest of all; the other
    points look again with twice the reach, and what is further away than ``grid_m`` *
    2^(levels - 1) meets all legs of its line.  The first reach is ``grid_m``, or a finer one
    where so many legs lie that points and legs meet more cheaply there.  Neither table is
    broadcast.  Ties go to the least segment and leg.  Returns the columns of ``points`` and segment, leg, snapped_lat,
    snapped_lon, off_m, along_m, total_m; with ``heading`` (degrees clockwise from north)
    also forward (runs from the start of the segment) and share (of the segment travelled
    in that direction).  Points without coordinates or on a line without legs have NULLs.
    """
    north, east = metres_per_degree(latitude)
    own = [*keys, *([] if line in keys else [line])]
    left = points.select(*own, (F.col(lon) * east).alias("__x"), (F.col(lat) * north).alias("__y")).filter(
        "__x IS NOT NULL AND __y IS NOT NULL AND NOT isnan(__x) AND NOT isnan(__y)")
    # Of legs that lie alike the least is nearest whenever they are.
    place = [line, "ax", "ay", "bx", "by"]
    rest = [segment, "leg", "from_m", "length_m", "total_m"]
    track_legs = written(track_legs.groupBy(*place).agg(F.min(F.struct(*rest)).alias("__least")).select(*place, "__least.*"), "legs")
    sure = []
    for level in range(_first_level(left, track_legs, line, grid_m), levels):
        reach = grid_m * 2.0 ** level
        cells = _cells(track_legs, reach).hint("merge")
        near = written(_nearest(_in_cells(left, reach).join(cells, [line, "__cx", "__cy"], "left"), own, segment), "snapped")
        is_sure = F.coalesce(F.col("__best.d2") <= F.lit(reach * reach), F.lit(False))
        sure.append(near.filter(is_sure).select(*own, "__best"))
        left = near.filter(~is_sure).select(*own, "__x", "__y")
        if left.isEmpty():
            break
    else:
        sure.append(_nearest(left.join(track_legs.hint("merge"), line), own, segment).select(*own, "__best"))
    found = reduce(DataFrame.unionByName, sure)
    b = F.col("__best")
    along = b["from_m"] + b["t"] * b["length_m"]
    shown = {segment: b[segment], "leg": b["leg"], "snapped_lat": b["py"] / north, "snapped_lon": b["px"] / east,
             "off_m": F.sqrt(b["d2"]), "along_m": along, "total_m": b["total_m"]}
    if heading is not None:
        turned = F.radians(F.col(heading).cast("double"))
        # The part of the leg's direction in that of the heading.
        forward = b["dx"] * F.sin(turned) + b["dy"] * F.cos(turned) >= 0
        shown["forward"] = forward
        shown["share"] = F.when(b["total_m"] > 0, F.when(forward, along).otherwise(b["total_m"] - along) / b["total_m"])
    return points.join(found, own, "left").withColumns(shown).drop("__best")


def _in_cells(points: DataFrame, reach: float) -> DataFrame:
    """Points with their cell; cells are twice the reach wide."""
    return points.withColumns({c: F.floor(F.col(x) / F.lit(2 * reach)) for c, x in (("__cx", "__x"), ("__cy", "__y"))})


def _first_level(points: DataFrame, track_legs: DataFrame, line: str, grid_m: float) -> int:
    """0, or less by one for each halving of the reach that leaves fewer rows to join.

    These are the legs' rows, one per cell, and the pairs of a point and a leg in its cell.
    """
    def rows(level: int) -> int:
        reach, at = grid_m * 2.0 ** level, [line, "__cx", "__cy"]
        legs_in = _cells(track_legs, reach).groupBy(*at).agg(F.count("*").alias("__legs"))
        points_in = _in_cells(points, reach).groupBy(*at).agg(F.count("*").alias("__points"))
        each = legs_in.join(points_in.hint("merge"), at, "left")
        return each.agg(F.sum(F.col("__legs") * (F.coalesce("__points", F.lit(0)) + 1))).first()[0] or 0

    level, now = 0, rows(0)
    while level > -FINEST:
        finer = rows(level - 1)
        if finer >= now:
            break
        level, now = level - 1, finer
    return level


def _cells(track_legs: DataFrame, reach: float) -> DataFrame:
    """Legs by the cells that hold points within their reach, and a few more cells.

    Cells are twice the reach wide.  A leg's cells are those with their middle within the
    reach and half a diagonal.  A long leg is cut into pieces of two cells, so that the boxes in which its
    cells are sought stay narrow; the piece nearest to the middle has the cell.
    """
    width = 2 * reach
    # A hair wider, for the rounding of the cut.
    apart = F.lit((reach + width * math.sqrt(0.5)) * (1 + 1e-6))
    pieces = F.greatest(F.ceil(F.col("length_m") / (2 * width)), F.lit(1)).cast("int")
    cut = track_legs.withColumn("__n", pieces).withColumn("__i", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))

    def at(a: str, b: str, i: Column) -> Column:
        return F.col(a) + (F.col(b) - F.col(a)) * (i / F.col("__n"))

    def cells(a: str, b: str) -> Column:
        ends = at(a, b, F.col("__i")), at(a, b, F.col("__i") + 1)
        return F.sequence(F.floor((F.least(*ends) - apart) / width), F.floor((F.greatest(*ends) + apart) / width))

    spread = cut.withColumn("__cx", F.explode(cells("ax", "bx"))).withColumn("__cy", F.explode(cells("ay", "by")))
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    offx, offy = (F.col("__cx") + 0.5) * width - F.col("ax"), (F.col("__cy") + 0.5) * width - F.col("ay")
    square = dx * dx + dy * dy
    t = F.when(square > 0, F.least(F.greatest((offx * dx + offy * dy) / square, F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(0.0))
    told = spread.withColumns({"__t": t, "__offx": offx - t * dx, "__offy": offy - t * dy})
    near = F.col("__offx") * F.col("__offx") + F.col("__offy") * F.col("__offy") <= apart * apart
    mine = F.least(F.floor(F.col("__t") * F.col("__n")), F.col("__n") - 1) == F.col("__i")
    return told.filter(near & mine).drop("__n", "__i", "__t", "__offx", "__offy")
