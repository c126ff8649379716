"""Exact percentiles without holding a group's values in one task.

Values are first reduced to (group, value, count).  A monotone bucket of the
value (1024 per factor of two) gives a small histogram per group; scanning it
locates the bucket of every wanted rank, and only those buckets are ranked value
by value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from headway.functions.numeric import py_round

_PER_OCTAVE = 1024
_OCTAVE_OFFSET = 1075 * _PER_OCTAVE  # lifts the smallest double's bucket above 0


def value_bucket(x: Column) -> Column:
    """Monotone integer bucket of a double; zero is bucket 0, infinities and NaN have the ends."""
    size = F.floor(F.log2(F.abs(x)) * _PER_OCTAVE) + F.lit(_OCTAVE_OFFSET)
    last = F.lit(2 * _OCTAVE_OFFSET)
    return (F.when(F.isnan(x), last + 1).when(x == 0, F.lit(0).cast("long"))
            .when(F.abs(x) == float("inf"), F.when(x > 0, last).otherwise(-last))
            .when(x > 0, size).otherwise(-size))


def histogram(df: DataFrame, keys: Sequence[str], value: str, *extra: Column) -> DataFrame:
    """``keys, value, n`` (plus extra aggregates), combined before the shuffle."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"), *extra)


def exact_percentiles(hist: DataFrame, keys: Sequence[str], value: str,
                      percents: Sequence[int]) -> DataFrame:
    """One row per key with ``p<percent>`` columns, rounded to 2 decimals.

    Linear interpolation between the ranks around ``(n - 1) * percent / 100``.
    Groups without a non-NULL value yield no row (callers coalesce to 0.0).
    """
    keys = list(keys)
    hist = (
        hist.select(*keys, F.col(value).cast("double").alias("__v"), "n")
        .filter(F.col("__v").isNotNull())
        .withColumn("__b", value_bucket(F.col("__v")))
        # Never NULL; stated so that both uses below share one scan and shuffle.
        .filter(F.col("__b").isNotNull())
    )
    by_key = Window.partitionBy(*keys)
    up_to_bucket = by_key.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        hist.groupBy(*keys, "__b").agg(F.sum("n").alias("__bn"))
        .withColumns({
            "__before": F.coalesce(F.sum("__bn").over(up_to_bucket), F.lit(0)),
            "__total": F.sum("__bn").over(by_key),
        })
    )
    # Entry 2i is the rank below percents[i]'s position, entry 2i + 1 the one above.
    wanted = F.array(*[
        F.struct(F.lit(2 * i + up).alias("slot"),
                 _rank(F.col("__total"), pct, bool(up)).alias("rank"))
        for i, pct in enumerate(percents) for up in (0, 1)
    ])
    targets = (
        buckets.withColumn("__want", wanted)
        .withColumn("__want", F.filter("__want", lambda r: (
            r.rank >= F.col("__before")) & (r.rank < F.col("__before") + F.col("__bn"))))
        .filter(F.size("__want") > 0)
        .select(*[F.col(k).alias(f"__t_{k}") for k in keys], F.col("__b").alias("__tb"),
                "__before", "__total", "__want")
    )
    same = F.col("__b") == F.col("__tb")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__t_{k}"))
    up_to_value = (
        Window.partitionBy(*keys, "__b").orderBy("__v")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    hits = (
        hist.join(targets, same)
        .withColumn("__low", F.col("__before")
                    + F.coalesce(F.sum("n").over(up_to_value), F.lit(0)))
        .select(*keys, "__v", "__low", "n", "__total", F.explode("__want").alias("__w"))
        .filter((F.col("__w.rank") >= F.col("__low"))
                & (F.col("__w.rank") < F.col("__low") + F.col("n")))
    )
    ends = hits.groupBy(*keys).agg(F.max("__total").alias("__total"), *[
        F.max(F.when(F.col("__w.slot") == slot, F.col("__v"))).alias(f"__s{slot}")
        for slot in range(2 * len(percents))])
    mixed = ends.select(*keys, *[
        _interpolate(F.col(f"__s{2 * i}"), F.col(f"__s{2 * i + 1}"), F.col("__total"), pct)
        .alias(f"p{pct}") for i, pct in enumerate(percents)])
    return mixed.select(*keys, *[py_round(F.col(f"p{p}"), 2).alias(f"p{p}") for p in percents])


def _position(total: Column, pct: int) -> Column:
    share = min(max(pct, 0), 100) / 100.0
    return (total - 1).cast("double") * F.lit(share)


def _rank(total: Column, pct: int, upper: bool) -> Column:
    """Zero-based rank just below or just above the position."""
    low = F.floor(_position(total, pct))
    return F.least(low + 1, total - 1) if upper else low


def _interpolate(low: Column, high: Column, total: Column, pct: int) -> Column:
    at = _position(total, pct)
    below, above = _rank(total, pct, False), _rank(total, pct, True)
    # A position on a rank is that rank's value, also beside an infinite neighbour.
    return F.when((below == above) | (at == below), low).otherwise(low * (above - at) + high * (at - below))


def approximate_percentiles(rows: DataFrame, keys: Sequence[str], value: str,
                            percents: Sequence[int], accuracy: int = 10000) -> DataFrame:
    """Sketch-based alternative with bounded state, over raw rows: repeated values count.

    The rank of the result is within ``1 / accuracy`` of the group's size of the wanted one;
    like the exact form, groups without a non-NULL value yield no row.
    """
    sketches = F.percentile_approx(value, F.array(*(F.lit(p / 100.0) for p in percents)), accuracy)
    found = rows.filter(F.col(value).isNotNull()).groupBy(*keys).agg(sketches.alias("__p"))
    return found.select(*keys, *[
        py_round(F.get("__p", F.lit(i)).cast("double"), 2).alias(f"p{p}") for i, p in enumerate(percents)])
