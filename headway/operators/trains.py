"""Vehicle snapshots: one payload per poll to one row per train."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from headway.functions import payload as p
from headway.functions.geo import valid_lat_lon
from headway.functions.text import flag
from headway.schemas import TRAIN_POSITIONS


def _api_code(doc: Column) -> Column:
    return p.text(doc, "ctatt.errCd")


def is_api_error(doc: Column) -> Column:
    """The body reports an error code other than 0."""
    return F.coalesce(_api_code(doc) != "0", F.lit(False))


def _documents(raw: DataFrame) -> DataFrame:
    return p.with_document(raw.select("payload", "poll_timestamp"), "doc", p.parse(F.col("payload")))


def api_errors(raw: DataFrame) -> DataFrame:
    """Polls answered with an error code in the body."""
    doc = F.col("doc")
    found = p.extract(_documents(raw), ["poll_timestamp"],
                      err_cd=_api_code(doc), err_nm=p.text(doc, "ctatt.errNm"))
    return found.filter(F.col("err_cd") != "0")


def _flag(train: Column, key: str) -> Column:
    """False when the key is missing, NULL when its value is no integer."""
    return F.coalesce(flag(p.text(train, key)),
                      F.when(p.at(train, key).isNull(), F.lit(False)))


def _train_fields(train: Column) -> dict[str, Column]:
    """Every field of a train, and what is needed to judge it."""
    lat, heading = p.number_or_text(train, "lat"), p.whole(train, "heading")
    return {
        "train_id": p.text(train, "rn"),
        "lat": lat,
        "lon": p.number_or_text(train, "lon"),
        "heading": heading,
        "next_station_id": p.text(train, "nextStaId"),
        "next_station_name": p.text(train, "nextStaNm"),
        "destination_id": p.text(train, "destSt"),
        "destination_name": p.text(train, "destNm"),
        "prediction_time": p.text(train, "prdt"),
        "predicted_arrival_time": p.text(train, "arrT"),
        "is_approaching": _flag(train, "isApp"),
        "is_delayed": _flag(train, "isDly"),
        "bad_heading": heading.isNull() & ~p.is_absent(p.at(train, "heading")),
        "no_object": F.when(lat.isNull(), ~p.is_object(train)),
    }


def _train_problem(field) -> Column:
    """Why a train is unusable; ``field`` gives one of its extracted fields."""
    return p.first_problem(
        (F.coalesce(field("no_object"), F.lit(False)), "train is not an object"),
        (~valid_lat_lon(field("lat"), field("lon")), "invalid coordinates"),
        (field("bad_heading"), "invalid heading"),
        (field("is_approaching").isNull(), "invalid isApp flag"),
        (field("is_delayed").isNull(), "invalid isDly flag"),
    )


def _document_problem(payload: Column, doc: Column, routes: Column) -> Column:
    """Walks into the document only where it has no list of routes."""
    body, found = p.at(doc, "ctatt"), p.at(doc, "ctatt.route")
    return p.first_problem(
        (doc.isNull(), "payload is not JSON"),
        (~payload.rlike(r"^\s*\{"), "payload is not an object"),
        (is_api_error(doc), "API error"),
        (routes.isNull() & found.isNotNull(), "route is not a list"),
        (routes.isNull() & body.isNotNull() & ~p.is_object(body), "ctatt is not an object"),
    )


def _trains_of(route: Column) -> Column:
    """A route's trains; a single train comes as an object instead of a list."""
    trains = p.at(route, "train")
    return (
        F.when(trains.isNull(), F.array().cast("array<variant>"))
        .when(p.is_array(trains), p.elements(trains))
        .otherwise(F.array(trains))
    )


def train_positions(raw: DataFrame, strict_poll: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)`` from ``payload string, poll_timestamp timestamp``.

    A bad train is set aside alone; with ``strict_poll`` it takes its whole poll
    along.  Everything happens inside the payload's own row, without a shuffle.
    """
    doc, route, t = F.col("doc"), F.col("route"), F.col("t")
    docs = p.with_document(_documents(raw), "routes", p.elements(p.at(doc, "ctatt.route")))
    docs = p.extract(
        docs, ["payload", "poll_timestamp", "routes"],
        reason=_document_problem(F.col("payload"), doc, F.col("routes")),
        api_timestamp=p.text(doc, "ctatt.tmst"))
    bad_docs = docs.filter(F.col("reason").isNotNull()).select("payload", "reason")
    fails = F.lit(False)
    if strict_poll:
        def unusable(train: Column) -> Column:
            fields = F.struct(*[c.alias(n) for n, c in _train_fields(train).items()])
            return F.exists(F.array(fields), lambda f: _train_problem(f.getField).isNotNull())

        fails = F.exists("routes", lambda r: ~p.is_object(r) | F.exists(_trains_of(r), unusable))
    passed = ["payload", "poll_timestamp", "api_timestamp", "poll_fails"]
    per_route = (
        docs.filter(F.col("reason").isNull()).withColumn("poll_fails", fails)
        .select(*passed, F.explode("routes").alias("route"))
    )
    per_route = p.with_document(p.extract(
        p.with_document(per_route, "is_route", p.is_object(route)), [*passed, "route", "is_route"],
        route_name=p.text(route, "@name")), "trains", _trains_of(route))
    bad_routes = per_route.filter(~F.col("is_route")).select(
        "payload", F.lit("route is not an object").alias("reason"))
    in_poll = F.when(F.col("poll_fails"), "another train of the poll is invalid")
    trains = p.extract(
        per_route.filter("is_route")
        .select(*passed, "route_name", F.explode("trains").alias("t")),
        ["payload", "poll_timestamp", "api_timestamp", F.col("route_name").alias("route")],
        **_train_fields(t), in_poll=in_poll,
    ).withColumn("reason", F.coalesce(_train_problem(F.col), "in_poll"))
    good = trains.filter(F.col("reason").isNull()).select(*TRAIN_POSITIONS.names)
    bad_trains = trains.filter(F.col("reason").isNotNull()).select("payload", "reason")
    return good, bad_docs.unionByName(bad_routes).unionByName(bad_trains)
