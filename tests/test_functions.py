"""Scalar functions at their boundaries."""

import random

import pytest
from pyspark.sql import functions as F

from headway import functions as fn


def values(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_py_round_matches_python_on_ties_and_noise(spark):
    rng = random.Random(7)
    xs = [rng.randrange(-10**6, 10**6) / 1000 for _ in range(4000)]
    xs += [rng.uniform(-1e7, 1e7) for _ in range(2000)] + [1.015, 2.675, 0.125, 0.375, -0.125, 0.0, 1e17]
    for digits in (1, 2, 3):
        got = values(spark, fn.py_round(F.col("x"), digits), [(x,) for x in xs], "x double")
        assert got == [round(x, digits) for x in xs]


def test_service_date_rolls_at_three_and_survives_dst(spark):
    cases = [
        ("2026-01-15 07:59:59", "2026-01-14"),   # 01:59:59 local
        ("2026-01-15 08:59:59", "2026-01-14"),   # 02:59:59
        ("2026-01-15 09:00:00", "2026-01-15"),   # 03:00
        ("2026-01-15 06:00:00", "2026-01-14"),   # midnight
        ("2026-03-08 07:59:59", "2026-03-07"),   # 01:59:59 before the jump to 03:00
        ("2026-03-08 08:00:00", "2026-03-08"),   # 03:00 CDT
        ("2026-11-01 07:30:00", "2026-10-31"),   # second 01:30
        ("2026-11-01 08:59:59", "2026-10-31"),
        ("2026-11-01 09:00:00", "2026-11-01"),
    ]
    got = values(spark, fn.service_date(F.col("t").cast("timestamp")).cast("string"),
                 [(t,) for t, _ in cases], "t string")
    assert got == [d for _, d in cases]
    five = values(spark, fn.service_date(F.lit("2026-01-15 10:59:00").cast("timestamp"),
                                         partition_hour=5).cast("string"), [(1,)], "i int")
    assert five == ["2026-01-14"]


def test_valid_lat_lon(spark):
    rows = [("41.8", "-87.6", True), ("90", "180", True), ("-90", "-180", True),
            ("90.1", "0", False), ("0", "180.01", False), ("nan", "0", False),
            (None, "0", False), ("x", "0", False), ("0", None, False)]
    got = values(spark, fn.valid_lat_lon(F.col("a"), F.col("b")),
                 [(a, b) for a, b, _ in rows], "a string, b string")
    assert got == [r[2] for r in rows]


def test_text_and_units(spark):
    assert values(spark, fn.leading_number(F.col("s")),
                  [("20 mph",), ("5 to 10 mph",), ("calm",), ("",), (None,)],
                  "s string") == [20.0, 5.0, None, None, None]
    assert values(spark, fn.flag(F.col("s")), [("1",), ("0",), ("2",), ("no",), (None,)],
                  "s string") == [True, False, True, None, None]
    assert values(spark, fn.c_to_f(F.col("c")), [(0.0,), (100.0,), (-40.0,)],
                  "c double") == [32.0, 212.0, -40.0]


def test_duration_text(spark):
    cases = {0.0: "0s", 59.9: "59s", 60.0: "1m", 135.0: "2m 15s", 3600.0: "1h",
             9060.0: "2h 31m", 86400.0: "1d", 277200.0: "3d 5h", 3659.0: "1h"}
    got = values(spark, fn.duration_text(F.col("x")), [(x,) for x in cases], "x double")
    assert got == list(cases.values())


def test_float_text_is_plain_like_grid_keys(spark):
    xs = [41.0, -87.63, 0.0, 0.001, 0.0005, -0.00025, 0.00001, -0.000025, 180.0]
    assert values(spark, fn.float_text(F.col("x")), [(x,) for x in xs],
                  "x double") == [str(x) for x in xs]


def test_grid_ids(spark):
    urls = ["https://x/gridpoints/LOT/76,73/forecast/hourly", "https://x/gridpoints/LOT/76/",
            "https://x/gridpoints/lot/1,2/f"]
    assert values(spark, fn.nws_grid_id(F.col("u")), [(u,) for u in urls],
                  "u string") == ["LOT/76,73", None, None]
    ids = ["41.88,-87.63", "41.88", "1,2,3", "x,1", "91,0", ""]
    got = values(spark, fn.grid_coordinates(F.col("g")), [(g,) for g in ids], "g string")
    assert got[0] == (41.88, -87.63) and got[1:] == [None] * 5


def test_staleness_is_strict(spark):
    assert values(spark, fn.staleness(F.col("a"), 300), [(300.0,), (300.5,), (None,)],
                  "a double") == ["active", "stale", "unknown"]


@pytest.mark.parametrize("row, expected", [
    (("BodyCodeError", "x", None, "102"), "daily_quota"),
    (("BodyCodeError", "x", None, "999"), "configuration"),
    (("ConfigurationError", "x", None, None), "configuration"),
    (("APIResponseError", "x", None, None), "transient"),
    (("ValueError", "key is Missing", None, None), "configuration"),
    (("ValueError", "boom", None, None), "unknown"),
    (("HTTPStatusError", "", 429, "102"), "rate_limit"),
    (("HTTPStatusError", "", 400, "102"), "daily_quota"),
    (("HTTPStatusError", "", 500, "106"), "configuration"),
    (("HTTPStatusError", "", 404, "0"), "configuration"),
    (("HTTPStatusError", "", 501, "77"), "transient"),
    (("HTTPStatusError", "", 502, None), "unknown"),
    (("ReadTimeout", "", None, None), "transient"),
    ((None, None, None, None), "unknown"),
])
def test_error_category(spark, row, expected):
    got = values(spark, fn.error_category(*map(F.col, "tmsc"), body_code_types=("BodyCodeError",)), [row],
                 "t string, m string, s int, c string")
    assert got == [expected]


def test_next_local_midnight(spark):
    got = values(spark, fn.next_local_midnight(F.col("t").cast("timestamp")).cast("string"),
                 [("2026-01-15 05:59:59",), ("2026-01-15 06:00:00",), ("2026-03-08 12:00:00",)],
                 "t string")
    assert got == ["2026-01-15 06:00:00", "2026-01-16 06:00:00", "2026-03-09 05:00:00"]


def test_iso_date_and_timestamp(spark):
    assert [str(x) for x in values(spark, fn.iso_date(F.col("s")),
            [("2026-02-17",), ("2026-2-17",), ("2026-02-30",), ("x",)], "s string")] == [
        "2026-02-17", "None", "None", "None"]
    got = values(spark, fn.iso_timestamp(F.col("s")).cast("string"),
                 [("2026-02-17T10:00:00+00:00",), ("2026-02-17T10:00:00",), ("soon",)], "s string")
    assert got == ["2026-02-17 10:00:00", "2026-02-17 10:00:00", None]
