"""Stations and track segments of the network."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from headway.functions import payload as p
from headway.functions.geo import valid_lat_lon
from headway.functions.numeric import py_round
from headway.functions.text import strip, text_or_empty
from headway.schemas import STATIONS


def station_rows(raw: DataFrame) -> DataFrame:
    """Station list bodies (``payload`` holds a JSON list) to one payload per station.

    A body that is no list yields one row with a NULL payload.
    """
    doc = p.parse(F.col("payload"))
    return raw.select(F.explode_outer(p.elements(doc)).alias("v")).select(
        F.to_json("v").alias("payload"))


def stations(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)`` from one GeoJSON point payload per station."""
    v = F.col("v")
    xy = p.elements(p.at(v, "the_geom.coordinates"))
    lon, lat = (p.number_or_text(F.get(xy, F.lit(i)), "") for i in (0, 1))
    checked = p.extract(
        p.with_document(raw.select("payload"), "v", p.parse(F.col("payload"))), ["payload"],
        reason=p.first_problem(
            (v.isNull(), "payload is not JSON"),
            (~p.is_object(p.at(v, "the_geom")), "no geometry"),
            (F.coalesce(F.size(xy), F.lit(0)) < 2, "fewer than two coordinates"),
            (lon.isNull() | lat.isNull(), "coordinate is not a number")),
        id=text_or_empty(p.text(v, "station_id")),
        name=text_or_empty(p.text(v, "longname")),
        address=text_or_empty(p.text(v, "address")),
        lines=text_or_empty(p.text(v, "lines")),
        latitude=lat, longitude=lon)
    good = checked.filter(F.col("reason").isNull()).select(*STATIONS.names)
    return good, checked.filter(F.col("reason").isNotNull()).select("payload", "reason")


def multiline(geometry: Column) -> Column:
    """Lines of [lon, lat] points of a GeoJSON MultiLineString.

    Points need two numbers (further ones are cut), lines need a point; NULL when
    the type differs or nothing is left.
    """
    def point(value: Column) -> Column:
        xy = p.elements(value)
        lon, lat = F.get(xy, F.lit(0)), F.get(xy, F.lit(1))
        return F.when(p.is_number(lon) & p.is_number(lat),
                      F.array(p.number_or_text(lon, ""), p.number_or_text(lat, "")))

    coordinates = p.at(geometry, "coordinates")
    by_element = F.transform(
        p.elements(coordinates),
        lambda line: F.array_compact(F.transform(p.elements(line), point)))
    # Well-formed numbers convert in one go; text in them would convert as well,
    # so anything quoted is checked element by element.
    at_once = F.transform(
        F.when(~F.try_variant_get(coordinates, "$", "string").contains('"'),
               F.try_variant_get(coordinates, "$", "array<array<array<double>>>")),
        lambda line: F.transform(
            F.filter(line, lambda xy: F.get(xy, F.lit(0)).isNotNull()
                     & F.get(xy, F.lit(1)).isNotNull()),
            lambda xy: F.slice(xy, 1, 2)))
    lines = F.filter(F.coalesce(at_once, by_element), lambda points: F.size(points) > 0)
    usable = F.nullif(lines, F.array().cast("array<array<array<double>>>"))
    return F.when(p.text(geometry, "type") == "MultiLineString", usable)


def segment_ends(lines: Column) -> dict[str, Column]:
    """First point of the first line and last point of the last one."""
    start, end = F.get(F.get(lines, F.lit(0)), F.lit(0)), F.element_at(F.element_at(lines, -1), -1)
    return {"start_lat": F.get(start, F.lit(1)), "start_lon": F.get(start, F.lit(0)),
            "end_lat": F.get(end, F.lit(1)), "end_lon": F.get(end, F.lit(0))}


def bounding_box(lines: Column) -> Column:
    """``struct<min_lon, min_lat, max_lon, max_lat>`` over all points."""
    lon = F.transform(F.flatten(lines), lambda xy: F.get(xy, F.lit(0)))
    lat = F.transform(F.flatten(lines), lambda xy: F.get(xy, F.lit(1)))
    return F.struct(F.array_min(lon).alias("min_lon"), F.array_min(lat).alias("min_lat"),
                    F.array_max(lon).alias("max_lon"), F.array_max(lat).alias("max_lat"))


def description_ends(description: Column) -> Column:
    """``"A to B"`` to ``struct<a, b>``; without two sides both are the whole text."""
    whole = strip(description)
    cut = F.instr(whole, " to ")
    left = strip(F.substring(whole, F.lit(1), cut - 1))
    right = strip(F.substring(whole, cut + 4, F.length(whole)))
    split = (cut > 0) & (left != "") & (right != "")
    return F.struct(F.when(split, left).otherwise(whole).alias("a"),
                    F.when(split, right).otherwise(whole).alias("b"))


def line_names(text: Column) -> Column:
    """Comma-separated names, trimmed, blanks dropped."""
    tight = F.regexp_replace(strip(F.coalesce(text, F.lit(""))), r"\s*,\s*", ",")
    return F.array_remove(F.split(tight, ","), "")


def fingerprint(lines: Column, description: Column, track_type: Column, legend: Column,
                shape_len: Column, ends: dict[str, Column]) -> Column:
    """Pipe-joined stable fields of a segment, numbers at six decimals."""
    number = lambda x: F.format_string("%.6f", py_round(x, 6))
    return F.concat_ws(
        "|", F.array_join(lines, ","), text_or_empty(description), text_or_empty(track_type),
        text_or_empty(legend), F.when(shape_len.isNull(), "").otherwise(number(shape_len)),
        F.concat(number(ends["start_lon"]), F.lit(","), number(ends["start_lat"])),
        F.concat(number(ends["end_lon"]), F.lit(","), number(ends["end_lat"])))


@F.pandas_udf(StringType())
def _blake2s_64(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    from hashlib import blake2s

    for batch in texts:
        yield batch.map(lambda s: blake2s(s.encode("utf-8"), digest_size=8).hexdigest())


def segment_id(text: Column, digest: str = "blake2s") -> Column:
    """16 hex digits of the fingerprint: BLAKE2s (Arrow UDF) or SHA-256 (in the JVM)."""
    if digest == "blake2s":
        return _blake2s_64(text)
    if digest == "sha256":
        return F.substring(F.sha2(text, 256), 1, 16)
    raise ValueError("digest must be 'blake2s' or 'sha256'")


def track_segments(raw: DataFrame, digest: str = "blake2s") -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)`` from one GeoJSON line payload per segment."""
    v = F.col("v")

    def trimmed(key: str) -> Column:
        found = p.text(v, key)
        return F.when(found != "", strip(found))

    shaped = p.extract(
        p.with_document(raw.select("payload"), "v", p.parse(F.col("payload"))), ["payload"],
        is_json=v.isNotNull(),
        lines=line_names(p.text(v, "lines")),
        description=trimmed("description"),
        track_type=trimmed("type"),
        legend=trimmed("legend"),
        shape_len=p.number_or_text(v, "shape_len"),
        geometry=p.at(v, "the_geom"))
    # Lambdas run interpreted and take their whole operator along: keep them apart.
    shaped = p.with_document(shaped, "coords", multiline(F.col("geometry")))
    shaped = p.with_document(shaped, "bbox", bounding_box(F.col("coords")))
    coords, description = F.col("coords"), F.col("description")
    kept = ["payload", "is_json", "lines", "description", "track_type", "legend", "shape_len",
            "coords", "bbox"]
    ends = segment_ends(coords)
    fields = p.extract(shaped, kept, both=description_ends(description), **ends)
    text = fingerprint(F.col("lines"), description, F.col("track_type"), F.col("legend"),
                       F.col("shape_len"), {n: F.col(n) for n in ends})
    box = F.col("bbox")
    checked = fields.withColumn("reason", p.first_problem(
        (~F.col("is_json"), "payload is not JSON"),
        (F.col("coords").isNull(), "no usable geometry"),
        (~valid_lat_lon(box.min_lat, box.min_lon) | ~valid_lat_lon(box.max_lat, box.max_lon),
         "coordinates out of range")))
    named = description != ""
    good = checked.filter(F.col("reason").isNull()).select(
        segment_id(text, digest).alias("segment_id"), "lines", "description",
        F.when(named, F.col("both.a")).alias("endpoint_a"),
        F.when(named, F.col("both.b")).alias("endpoint_b"),
        "track_type", "legend", "shape_len",
        F.struct(F.lit("MultiLineString").alias("type"), coords.alias("coordinates"))
        .alias("geometry"),
        "bbox", *ends)
    return good, checked.filter(F.col("reason").isNotNull()).select("payload", "reason")
