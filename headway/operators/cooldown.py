"""Alert cooldown: which candidates are sent, given that each send opens a pause.

Whether a candidate is sent depends on the previous send, so a plain solution
walks each key's candidates in one task.  Here a key's time is cut into blocks
of ``block_cooldowns`` cooldowns, and the walk is split in three:

1. per (key, block): for every candidate at which a walk can enter the block,
   the last send of that walk inside the block (pointer doubling on arrays);
2. per key: step from block to block through those entries only.  A walk enters
   a block within one cooldown of its start, or at the first candidate after
   that, so a key contributes one cooldown's worth of candidates per block;
3. per (key, block): replay from the known last send and mark the sends.

Blocks are bounded in time, so a busy key spreads over its blocks.  The walks
take a whole Arrow batch of blocks per call; Spark groups, sorts and joins.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

_NEVER = -(2 ** 62)


def _entries(times: np.ndarray, start: int, pause: int) -> tuple[np.ndarray, np.ndarray]:
    """Possible entry times of a block and the last send of the walk from each."""
    n = len(times)
    after = np.searchsorted(times, times + pause, side="right")
    jump = np.where(after < n, np.minimum(after, n - 1), np.arange(n))
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            break
        jump = further
    upto = min(int(np.searchsorted(times, start + pause, side="left")) + 1, n)
    return times[:upto], times[jump[:upto]]


def _walk(times: np.ndarray, last: int, pause: int) -> np.ndarray:
    """Sent flags of one block, entered with the previous send at ``last``."""
    sent = np.zeros(len(times), dtype=bool)
    at = int(np.searchsorted(times, last + pause, side="right"))
    while at < len(times):
        sent[at] = True
        at = int(np.searchsorted(times, times[at] + pause, side="right"))
    return sent


def _chain(enter: np.ndarray, leave: np.ndarray, pause: int) -> np.ndarray:
    """Last send before each block of a key, stepping through the blocks' entries."""
    known = np.empty(len(enter), dtype="int64")
    last = _NEVER
    for block, (starts, ends) in enumerate(zip(enter, leave)):
        known[block] = last
        at = int(np.searchsorted(starts, last + pause, side="right"))
        if at < len(starts):
            last = int(ends[at])
    return known


def alerts_to_send(candidates: DataFrame, keys: Sequence[str], ts: str, cooldown_s: float,
                   block_cooldowns: int = 64) -> DataFrame:
    """``keys, ts, send`` for every distinct candidate instant.

    Sent iff it asks for an alert and either none was sent before for the key or
    strictly more than the cooldown has passed since the last send.
    """
    if cooldown_s < 0:
        raise ValueError("cooldown must be >= 0")
    keys = list(keys)
    pause = round(cooldown_s * 1e6)
    width = max(pause, 1) * block_cooldowns
    asked = (
        candidates.groupBy(*keys, ts)
        .agg(F.bool_or(F.coalesce("should_alert", F.lit(False))).alias("__ask"))
        .withColumn("__us", F.unix_micros(ts))
        .withColumn("__block", (F.col("__us") - F.pmod("__us", F.lit(width))) / F.lit(width))
        .withColumn("__block", F.col("__block").cast("long"))
    )
    blocks = asked.filter("__ask").groupBy(*keys, "__block").agg(
        F.sort_array(F.collect_list("__us")).alias("__times"))

    @F.pandas_udf("in array<bigint>, out array<bigint>")
    def entries(times: pd.Series, block: pd.Series) -> pd.DataFrame:
        pairs = [_entries(t, int(b) * width, pause) for t, b in zip(times, block)]
        return pd.DataFrame({"in": [p[0] for p in pairs], "out": [p[1] for p in pairs]})

    @F.pandas_udf("array<bigint>")
    def chain(enter: pd.Series, leave: pd.Series) -> pd.Series:
        return pd.Series([_chain(i, o, pause) for i, o in zip(enter, leave)])

    @F.pandas_udf("array<boolean>")
    def mark(times: pd.Series, last: pd.Series) -> pd.Series:
        return pd.Series([_walk(t, int(s), pause) for t, s in zip(times, last)])

    lasts = (
        blocks.withColumn("__e", entries("__times", "__block"))
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(
            F.struct("__block", F.col("__e.in").alias("i"), F.col("__e.out").alias("o"))))
            .alias("__path"))
        .withColumn("__known", chain(F.col("__path.i"), F.col("__path.o")))
        .select(*[F.col(k).alias(f"__l_{k}") for k in keys],
                F.explode(F.arrays_zip(F.col("__path.__block").alias("b"), "__known")).alias("__z"))
        .select(*[f"__l_{k}" for k in keys], F.col("__z.b").alias("__lb"),
                F.col("__z.__known").alias("__last"))
    )
    same = F.col("__block") == F.col("__lb")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__l_{k}"))
    asking = (
        blocks.join(lasts, same)
        .select(*keys, F.explode(F.arrays_zip("__times", mark("__times", "__last").alias("s")))
                .alias("__m"))
        .select(*keys, F.timestamp_micros("__m.__times").alias(ts), F.col("__m.s").alias("send"))
    )
    silent = asked.filter(~F.col("__ask")).select(*keys, ts, F.lit(False).alias("send"))
    return asking.unionByName(silent)
