"""Time-ordered operators that never put a whole key into one task.

A plain ``lag`` or running ``sum`` partitioned by key sorts every row of a key
in a single task, so one busy key stalls the job.  Here the window is
partitioned by (key, time bucket).  Each bucket is summarised with an ordinary
aggregation, the summaries of a key (one row per non-empty bucket) are scanned
in order, and the result enters the next bucket as one *seed* row placed before
its first row.  Rows of the busy key therefore spread over as many tasks as it
has buckets, and the data is shuffled once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

DEFAULT_BUCKET_SECONDS = 3600
#: Parts into which a busy bucket may be cut.
SLICES = 256

_BUCKET, _SEED, _VALUE = "__bucket", "__is_row", "__value"


def time_bucket(ts: Column, seconds: int) -> Column:
    """Index of the fixed-width time bucket an instant falls into."""
    if seconds <= 0:
        raise ValueError("bucket_seconds must be > 0")
    return F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000))


def with_slices(df: DataFrame, keys: Sequence[str], ts: str, bucket_seconds: int,
                most_rows: int | None = None) -> DataFrame:
    """``__bucket``: the time bucket of a row, cut further where it is busy.

    Buckets of a key that hold more than ``most_rows`` rows are found by counting; for
    them alone rows are counted in ``SLICES`` slots of equal time, and neighbouring slots
    join to slices of about ``most_rows`` rows, so that a slice is larger only if one slot
    is.  Both lists have at most a row per ``most_rows`` / ``SLICES`` rows.
    """
    whole = time_bucket(F.col(ts), bucket_seconds)
    if most_rows is None:
        return df.withColumn(_BUCKET, whole)
    width = bucket_seconds * 1_000_000
    inside = F.unix_micros(F.col(ts)) - F.col(_BUCKET) * F.lit(width)
    rows = df.withColumn(_BUCKET, whole).withColumn("__slot", F.floor(inside * F.lit(SLICES) / F.lit(width)))
    at = [*keys, _BUCKET, "__slot"]
    names = {c: f"__busy_{i}" for i, c in enumerate(at)}

    def same(other: DataFrame, columns: Sequence[str]) -> list[Column]:
        return [rows[c].eqNullSafe(other[names[c]]) for c in columns]

    busy = (rows.groupBy(*keys, _BUCKET).agg(F.count(F.lit(1)).alias("__rows"))
            .filter(F.col("__rows") > most_rows).withColumnsRenamed(names))
    slots = rows.join(busy, same(busy, at[:-1]), "left_semi").groupBy(*at).agg(F.count(F.lit(1)).alias("__rows"))
    before = (Window.partitionBy(*keys, _BUCKET).orderBy("__slot")
              .rowsBetween(Window.unboundedPreceding, -1))
    place = F.floor(F.coalesce(F.sum("__rows").over(before), F.lit(0)) / F.lit(most_rows))
    # Places can skip numbers; the least slot of a place names it within ``SLICES``.
    first = Window.partitionBy(*keys, _BUCKET, "__place")
    slices = (slots.withColumn("__place", place).withColumn("__slice", F.min("__slot").over(first))
              .drop("__rows", "__place").withColumnsRenamed(names))
    return (rows.join(slices, same(slices, at), "left")
            .withColumn(_BUCKET, F.col(_BUCKET) * SLICES + F.coalesce("__slice", F.lit(0)))
            .drop("__slot", "__slice", *names.values()))


def _order_key(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def _bucketed(df: DataFrame, keys: Sequence[str], value: Column, ts: str, bucket_seconds: int,
              most_rows: int | None = None) -> DataFrame:
    return with_slices(df, keys, ts, bucket_seconds, most_rows).withColumns(
        {_SEED: F.lit(1), _VALUE: value})


def _seeded(rows: DataFrame, seeds: DataFrame) -> DataFrame:
    return rows.unionByName(seeds.withColumn(_SEED, F.lit(0)), allowMissingColumns=True)


def _finish(df: DataFrame) -> DataFrame:
    return df.filter(F.col(_SEED) == 1).drop(_BUCKET, _SEED, _VALUE)


def with_previous(df: DataFrame, keys: Sequence[str], ts: str, previous: Mapping[str, str],
                  ties: Sequence[str] = (),
                  bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
                  most_rows: int | None = None) -> DataFrame:
    """Add columns of the preceding row per key; ``previous`` maps new name to column."""
    keys, order = list(keys), [ts, *ties]
    value = F.struct(*[F.col(c).alias(name) for name, c in previous.items()])
    rows = _bucketed(df, keys, value, ts, bucket_seconds, most_rows)
    seeds = (
        rows.groupBy(*keys, _BUCKET)
        .agg(F.max_by(_VALUE, _order_key(order)).alias("__last"))
        .select(*keys, _BUCKET,
                F.lag("__last").over(Window.partitionBy(*keys).orderBy(_BUCKET)).alias(_VALUE))
    )
    within = Window.partitionBy(*keys, _BUCKET).orderBy(_SEED, *order)
    out = _seeded(rows, seeds).withColumn("__prev", F.lag(_VALUE).over(within))
    for name in previous:
        out = out.withColumn(name, F.col("__prev").getField(name))
    return _finish(out.drop("__prev"))


def with_last_known(df: DataFrame, keys: Sequence[str], ts: str, value: str, name: str,
                    ties: Sequence[str] = (),
                    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
                    most_rows: int | None = None) -> DataFrame:
    """Add the latest non-NULL ``value`` of the key up to and including each row."""
    keys, order = list(keys), [ts, *ties]
    rows = _bucketed(df, keys, F.col(value), ts, bucket_seconds, most_rows)
    earlier = (
        Window.partitionBy(*keys).orderBy(_BUCKET)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    seeds = (
        rows.groupBy(*keys, _BUCKET)
        .agg(F.max_by(_VALUE, F.when(F.col(_VALUE).isNotNull(), _order_key(order)))
             .alias("__last"))
        .select(*keys, _BUCKET, F.last("__last", ignorenulls=True).over(earlier).alias(_VALUE))
    )
    within = (
        Window.partitionBy(*keys, _BUCKET).orderBy(_SEED, *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return _finish(
        _seeded(rows, seeds).withColumn(name, F.last(_VALUE, ignorenulls=True).over(within)))


def with_running_sum(df: DataFrame, keys: Sequence[str], ts: str, sums: Mapping[str, Column],
                     ties: Sequence[str] = (),
                     bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
                     most_rows: int | None = None) -> DataFrame:
    """Add running totals per key in time order; ``sums`` maps new name to expression."""
    keys, order = list(keys), [ts, *ties]
    rows = _bucketed(df, keys, F.struct(*[c.alias(n) for n, c in sums.items()]), ts, bucket_seconds, most_rows)
    earlier = (
        Window.partitionBy(*keys).orderBy(_BUCKET)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = rows.groupBy(*keys, _BUCKET).agg(
        *[F.sum(F.col(_VALUE).getField(n)).alias(n) for n in sums])
    seeds = totals.select(
        *keys, _BUCKET,
        F.struct(*[F.sum(n).over(earlier).alias(n) for n in sums]).alias(_VALUE))
    within = (
        Window.partitionBy(*keys, _BUCKET).orderBy(_SEED, *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = _seeded(rows, seeds)
    return _finish(out.withColumns(
        {n: F.sum(F.col(_VALUE).getField(n)).over(within) for n in sums}))


def with_neighbours(df: DataFrame, keys: Sequence[str], ts: str, previous: Mapping[str, str],
                    following: Mapping[str, str], ties: Sequence[str] = (),
                    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
                    most_rows: int | None = None) -> DataFrame:
    """Columns of the rows before and after each row of a key, in one shuffle of the rows.

    A bucket gets a seed from the last row of the bucket before it and one, behind its
    own rows, from the first row of the next.
    """
    keys, order = list(keys), [ts, *ties]
    taken = sorted({*previous.values(), *following.values()})
    rows = _bucketed(df, keys, F.struct(*taken), ts, bucket_seconds, most_rows)
    ends = rows.groupBy(*keys, _BUCKET).agg(
        F.max_by(_VALUE, _order_key(order)).alias("__last"),
        F.min_by(_VALUE, _order_key(order)).alias("__first"))
    scan = Window.partitionBy(*keys).orderBy(_BUCKET)
    both = ends.select(*keys, _BUCKET, F.array(
        F.struct(F.lit(0).alias(_SEED), F.lag("__last").over(scan).alias(_VALUE)),
        F.struct(F.lit(2).alias(_SEED), F.lead("__first").over(scan).alias(_VALUE))).alias("__both"))
    seeds = both.select(*keys, _BUCKET, F.explode("__both").alias("__s")).select(*keys, _BUCKET, "__s.*")
    within = Window.partitionBy(*keys, _BUCKET).orderBy(_SEED, *order)
    out = rows.unionByName(seeds, allowMissingColumns=True).withColumns(
        {"__prev": F.lag(_VALUE).over(within), "__next": F.lead(_VALUE).over(within)})
    out = out.withColumns({
        **{n: F.col("__prev").getField(c) for n, c in previous.items()},
        **{n: F.col("__next").getField(c) for n, c in following.items()}})
    return _finish(out.drop("__prev", "__next"))


def with_next_known(df: DataFrame, keys: Sequence[str], ts: str, value: str, name: str,
                    ties: Sequence[str] = (),
                    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
                    most_rows: int | None = None) -> DataFrame:
    """Add the earliest non-NULL ``value`` of the key from each row on: a scan backwards in time."""
    keys, order = list(keys), [ts, *ties]
    rows = _bucketed(df, keys, F.col(value), ts, bucket_seconds, most_rows)
    later = (
        Window.partitionBy(*keys).orderBy(F.desc(_BUCKET))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    seeds = (
        rows.groupBy(*keys, _BUCKET)
        .agg(F.min_by(_VALUE, F.when(F.col(_VALUE).isNotNull(), _order_key(order)))
             .alias("__first"))
        .select(*keys, _BUCKET, F.last("__first", ignorenulls=True).over(later).alias(_VALUE))
    )
    within = (
        Window.partitionBy(*keys, _BUCKET).orderBy(_SEED, *[F.desc(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return _finish(
        _seeded(rows, seeds).withColumn(name, F.last(_VALUE, ignorenulls=True).over(within)))


def as_of_join(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str,
               values: Sequence[str], tolerance_seconds: float | None = None,
               right_ts: str | None = None, matched_ts: str = "matched_ts",
               ties: Sequence[str] = (), bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
               most_rows: int | None = None) -> DataFrame:
    """Each row of ``left`` with ``values`` of the newest row of ``right`` at or before it.

    Rows match on ``keys``; among rows of ``right`` at one instant the greatest by
    ``ties`` counts.  ``matched_ts`` tells the instant; a match older than the tolerance
    is none.  Both tables are dealt by (key, time slice), a busy slice is cut by counted
    rows, and a slice without a row of ``right`` before a row of ``left`` is seeded from
    the slices before it.  NULL keys match nothing.
    """
    keys, mine = list(keys), list(left.columns)
    right_ts = right_ts or ts
    found = F.struct(F.col(right_ts).alias(matched_ts), *values)
    marks = right.select(*keys, F.col(right_ts).alias(ts), F.struct(F.col(right_ts).alias("__at"), *ties).alias("__tie"),
                         found.alias(_VALUE)).withColumn("__side", F.lit(0))
    marks = marks.filter(F.col(ts).isNotNull()).dropna(subset=keys)
    both = left.withColumn("__side", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    rows = with_slices(both, keys, ts, bucket_seconds, most_rows).withColumn(_SEED, F.lit(1))
    earlier = (
        Window.partitionBy(*keys).orderBy(_BUCKET)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    seeds = (
        rows.groupBy(*keys, _BUCKET)
        .agg(F.max_by(_VALUE, "__tie").alias("__last"), F.max("__side").alias("__asks"))
        .select(*keys, _BUCKET, "__asks", F.last("__last", ignorenulls=True).over(earlier).alias(_VALUE))
        .filter((F.col("__asks") == 1) & F.col(_VALUE).isNotNull()).drop("__asks")
    )
    within = (
        Window.partitionBy(*keys, _BUCKET).orderBy(_SEED, ts, "__side", "__tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    last = _seeded(rows, seeds).withColumn("__found", F.last(_VALUE, ignorenulls=True).over(within))
    last = _finish(last.filter((F.col("__side") == 1)))
    fits = F.lit(True)
    if tolerance_seconds is not None:
        age = F.unix_micros(F.col(ts)) - F.unix_micros(F.col("__found").getField(matched_ts))
        fits = age <= F.lit(round(tolerance_seconds * 1e6))
    return last.select(*mine, *[F.when(fits, F.col("__found").getField(c)).alias(c) for c in (matched_ts, *values)])


def islands(df: DataFrame, keys: Sequence[str], ts: str, state: str, ties: Sequence[str] = (),
            bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
            most_rows: int | None = None) -> DataFrame:
    """Runs of successive rows of a key with one ``state``: first_ts, last_ts, rows.

    Islands are found within (key, time slice).  Those that touch neither end of their
    slice are whole; of the others, at most two per slice, the last one of a slice is
    merged with the first one of the next if the state is the same.  NULL is a state.
    """
    keys, order = list(keys), [ts, *ties]
    rows = with_slices(df.select(*keys, *order, *({state} - {*keys, *order})), keys, ts, bucket_seconds, most_rows)
    part = Window.partitionBy(*keys, _BUCKET)
    within = part.orderBy(*order)
    begins = F.lag(F.lit(1)).over(within).isNull() | ~F.lag(state).over(within).eqNullSafe(F.col(state))
    numbered = rows.withColumn("__begins", begins.cast("int")).withColumn(
        "__n", F.sum("__begins").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    parts = numbered.groupBy(*keys, _BUCKET, "__n").agg(
        F.first(state).alias("__state"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        F.count(F.lit(1)).alias("rows"))
    parts = parts.withColumn("__most", F.max("__n").over(part))
    inner = (F.col("__n") > 1) & (F.col("__n") < F.col("__most"))
    shown = [*keys, F.col("__state").alias(state), "first_ts", "last_ts", "rows"]
    scan = Window.partitionBy(*keys).orderBy(_BUCKET, "__n")
    goes_on = (F.col("__n") == 1) & F.lag(F.lit(1)).over(scan).isNotNull() & F.lag("__state").over(scan).eqNullSafe(F.col("__state"))
    edges = parts.filter(~inner).withColumn("__new", (~goes_on).cast("int")).withColumn(
        "__island", F.sum("__new").over(scan.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = edges.groupBy(*keys, "__island").agg(
        F.first("__state").alias("__state"), F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"), F.sum("rows").alias("rows"))
    return parts.filter(inner).select(*shown).unionByName(merged.select(*shown))


def with_earliest_within(df: DataFrame, keys: Sequence[str], ts: str, values: Mapping[str, str],
                         seconds: int, ties: Sequence[str] = (), bucket_seconds: int | None = None) -> DataFrame:
    """Columns of the earliest row of the key in the ``seconds`` before each row, itself included.

    Buckets are at least as long as the window, so a copy of the rows at the end of the
    bucket before is all that a bucket needs.  Each row asks at the start of its window; one
    scan of the bucket backwards in time carries the earliest row seen so far to the asks, so
    that the work grows with the rows and not with those in a window.
    """
    keys, width = list(keys), max(bucket_seconds or 0, seconds)
    us = F.unix_micros(F.col(ts))
    row = F.struct(us.alias("__at"), *ties, *[F.col(c).alias(f"__v_{n}") for n, c in values.items()])
    rows = df.withColumns({_BUCKET: time_bucket(F.col(ts), width), "__us": us})
    seen = rows.select(*keys, _BUCKET, "__us", row.alias(_VALUE))
    left = F.col("__us") - F.col(_BUCKET) * F.lit(width * 1_000_000)
    copies = (seen.filter(left >= F.lit((width - seconds) * 1_000_000))
              .withColumn(_BUCKET, F.col(_BUCKET) + 1))
    asks = rows.withColumns({"__us": F.col("__us") - seconds * 1_000_000, _SEED: F.lit(1)})
    # At one instant rows come before asks, the least of them last.
    back = (Window.partitionBy(*keys, _BUCKET).orderBy(F.desc("__us"), _SEED, F.desc(_VALUE))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = (_seeded(asks, seen.unionByName(copies))
           .withColumn("__earliest", F.last(_VALUE, ignorenulls=True).over(back)))
    out = out.withColumns({n: F.col("__earliest").getField(f"__v_{n}") for n in values})
    return _finish(out.drop("__earliest", "__us"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key by ``order``; partial aggregation keeps one row per task and key."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), _order_key(order)).alias("__row")
    return df.groupBy(*keys).agg(newest).select(*keys, "__row.*").select(*df.columns)


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int,
                   salts: int = 32) -> DataFrame:
    """The ``n`` newest rows per key, numbered in ``recency`` (1 is newest).

    Every task first keeps its own best ``n`` (Spark's window group limit), the
    survivors of a key meet in ``salts`` tasks, and only ``salts * n`` rows of a
    key reach the final ranking.
    """
    if n <= 0:
        raise ValueError("n must be > 0")
    newest = [F.col(c).desc() for c in order]
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    for part in ([*keys, "__salt"], list(keys)):
        salted = salted.withColumn(
            "recency", F.row_number().over(Window.partitionBy(*part).orderBy(*newest))
        ).filter(F.col("recency") <= n)
    return salted.drop("__salt")
