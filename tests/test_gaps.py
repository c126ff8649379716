"""Gap rules at their boundaries, and the bucketed operators against plain windows."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from headway.operators.gaps import detect_gaps, gap_report, gap_summary
from headway.operators.ordered import (
    latest_per_key, newest_per_key, with_last_known, with_previous, with_running_sum,
)

T0 = 1_700_000_000.0


def polls(spark, offsets, run=None):
    rows = [("d", dt.datetime.fromtimestamp(T0 + o, dt.UTC), (run or (lambda o: "r"))(o))
            for o in offsets]
    return spark.createDataFrame(rows, "dataset string, ts timestamp, run string")


def found(gaps):
    return [(r.gap_duration_seconds, r.gap_reason, r.missed_poll_cycles)
            for r in gaps.filter("is_gap").orderBy("ts").collect()]


def test_threshold_is_strict_and_ten_minutes_is_downtime(spark):
    gaps = detect_gaps(polls(spark, [0, 30, 60.5, 659.5, 1259.5, 1259.5]), "ts", ["dataset"], 15)
    assert found(gaps) == [(30.5, "retry_exhausted", 2), (599.0, "retry_exhausted", 39),
                           (600.0, "downtime", 40)]
    assert gaps.count() == 5  # rows of one poll count once


def test_first_poll_and_epoch_are_no_gap(spark):
    epoch = spark.createDataFrame(
        [("d", dt.datetime(1970, 1, 1, tzinfo=dt.UTC)), ("d", dt.datetime(2024, 1, 1, tzinfo=dt.UTC))],
        "dataset string, ts timestamp")
    assert found(detect_gaps(epoch, "ts", ["dataset"], 15)) == []


@pytest.mark.parametrize("args", [dict(poll_interval_s=0), dict(poll_interval_s=15, threshold_multiplier=0),
                                  dict(poll_interval_s=15, restart_reason="other")])
def test_bad_parameters(spark, args):
    with pytest.raises(ValueError):
        detect_gaps(polls(spark, [0]), "ts", ["dataset"], **args)


def test_restart_and_quota_reasons(spark):
    source = polls(spark, [0, 100, 200, 300], run=lambda o: "a" if o < 200 else "b")
    by_run = detect_gaps(source, "ts", ["dataset"], 15, restart_reason="downtime", run_id="run")
    assert [g[1] for g in found(by_run)] == ["retry_exhausted", "downtime", "retry_exhausted"]
    quota = polls(spark, [150, 200]).select("dataset", "ts")
    with_quota = detect_gaps(source, "ts", ["dataset"], 15, quota_errors=quota)
    assert [g[1] for g in found(with_quota)] == ["retry_exhausted", "daily_quota", "retry_exhausted"]


def test_report_keeps_the_cutoff(spark):
    gaps = detect_gaps(polls(spark, [0, 1000, 86400 * 2]), "ts", ["dataset"], 15)
    as_of = F.timestamp_seconds(F.lit(T0 + 1000 + 86400))
    assert gap_report(gaps, 1, as_of).count() == 2
    total = gap_summary(gaps).first()
    assert (total.gaps, total.total_seconds) == (2, 172800.0)
    assert gap_summary(gaps.filter("false")).first().gaps == 0


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows belong to one key, spread over days; keys may be NULL."""
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        key = "hot" if i % 2 else rng.choice(["a", "b", None])
        at = dt.datetime.fromtimestamp(T0 + rng.randrange(0, 5 * 86400 * 1000) / 1000, dt.UTC)
        rows.append((i, key, at, rng.choice([None, i])))
    return spark.createDataFrame(rows, "id long, k string, ts timestamp, v long").cache()


@pytest.mark.parametrize("bucket", [60, 3600, 86400 * 30])
def test_bucketed_operators_equal_plain_windows(skewed, bucket):
    w = Window.partitionBy("k").orderBy("ts", "id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.select(
        "id", F.lag("id").over(w).alias("prev"), F.last("v", True).over(upto).alias("known"),
        F.sum("id").over(upto).alias("total"))
    got = with_previous(skewed, ["k"], "ts", {"prev": "id"}, ["id"], bucket)
    got = with_last_known(got, ["k"], "ts", "v", "known", ["id"], bucket)
    got = with_running_sum(got, ["k"], "ts", {"total": F.col("id")}, ["id"], bucket)
    assert sorted(map(tuple, got.select("id", "prev", "known", "total").collect())) == sorted(
        map(tuple, want.collect()))


def test_newest_and_latest(skewed):
    w = Window.partitionBy("k").orderBy(F.desc("ts"), F.desc("id"))
    want = skewed.withColumn("recency", F.row_number().over(w)).filter("recency <= 7")
    got = newest_per_key(skewed, ["k"], ["ts", "id"], 7, salts=4)
    assert set(map(tuple, got.select("id", "recency").collect())) == set(
        map(tuple, want.select("id", "recency").collect()))
    last = latest_per_key(skewed, ["k"], ["ts", "id"])
    assert {r.id for r in last.collect()} == {r.id for r in want.filter("recency = 1").collect()}
