"""Candidates for exact repeats: sampled anchors matched block by block.

A window (so many words or bytes in a row) is represented by its anchor, the
leftmost of its short grams with the least hash.  Equal windows have equal
anchors, so anchors, a few in a hundred units, are all that is shuffled.  Every
hash partition is one block of the index over the whole corpus and matches the
runs of windows that share an anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from headway.llm.frames import written
from headway.llm.vectors import BYTE_HASH, anchors, byte_grams, mix, slices, window_hashes, word_hashes, words

RUNS = "key long, whole long, doc_id long, start long, size int, kind byte"
MATCHED = "doc_id long, start long, size int, key long, kind byte"
#: What is known of a run of windows: nothing yet; the same run is elsewhere in
#: its slice too; it repeats an earlier equal run, which stays.
NEW, SHARED, REPEAT = 0, 1, 2
#: What a block says: the run repeats an earlier one; it has equal runs elsewhere;
#: its anchor is in other surroundings too, so that its windows must be compared.
EDGE = 3


def word_anchors(window: int, gram: int) -> Callable:
    def of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, Iterator]:
        starts, ends, first = words(raw, offsets)
        unit = word_hashes(raw, starts, ends)
        return first, anchors(unit, lambda x: window_hashes(x, gram), gram, window, first)
    return of


def byte_anchors(window: int) -> Callable:
    if window < 33:
        raise ValueError(f"a window of {window} bytes is shorter than an anchor's 32")

    def of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, Iterator]:
        return offsets, anchors(raw, byte_grams, 32, window, offsets, lambda x: BYTE_HASH[x])
    return of


def _runs(anchors_of: Callable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw, offsets in slices(batch, "text"):
                # Null ids become one key; see the operators' docstrings.
                ids = rows.column("doc_id").fill_null(-1 << 63).to_numpy()
                first, found = anchors_of(raw, offsets)
                for text, start, size, anchor, whole in found:
                    yield _combined(anchor, whole, ids[text], start - first[text], size)
    return run


def _combined(anchor, whole, doc, start, size) -> pa.RecordBatch:
    """Equal runs of one slice: the first goes on, the others are settled here and need no block.

    A group of copies with a third of all rows so sends one row per slice to its block;
    settled rows go to partitions at random.
    """
    order = np.lexsort((start, doc, whole, anchor))
    anchor, whole, doc, start, size = (x[order] for x in (anchor, whole, doc, start, size))
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = (anchor[1:] == anchor[:-1]) & (whole[1:] == whole[:-1])
    twice = same[1:-1] & (doc[1:] == doc[:-1]) & (start[1:] == start[:-1])  # one document's row, repeated
    kind = np.where(same[:-1], REPEAT, np.where(same[1:], SHARED, NEW)).astype(np.int8)
    keep = np.ones(len(order), bool)
    keep[1:] = ~twice
    if twice.any():  # a run that only its own repeated row shares is new
        real = np.add.reduceat(keep, np.flatnonzero(~same[:-1]))
        kind[np.flatnonzero(~same[:-1])[real == 1]] = NEW
    key = np.where(kind == REPEAT, mix(whole + start.astype(np.uint64) + doc.view(np.uint64)), anchor)
    return pa.record_batch([pa.array(x[keep]) for x in (
        key.view(np.int64), whole.view(np.int64), doc, start.astype(np.int64), size.astype(np.int32), kind)],
        ["key", "whole", "doc_id", "start", "size", "kind"])


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One block, sorted by (key, whole, doc_id, start): what is known of each run afterwards.

    Only neighbours are compared, and one run is kept back until the next different one is
    seen, so that no group is held in memory.
    """
    held = None  # the first of the current equal runs: key, whole, doc, start, size, shared, key seen before
    before = None
    out: list[tuple] = []

    def close(next_key):
        key, whole, doc, start, size, shared, seen = held
        if shared:
            out.append((doc, start, size, whole, SHARED))
        if seen or next_key == key:
            out.append((doc, start, size, key, EDGE))

    def table(rows):
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int8()))],
                               ["doc_id", "start", "size", "key", "kind"])

    for batch in batches:
        key, whole, doc, start, size, kind = (batch.column(i).to_numpy() for i in range(6))
        n = len(key)
        if not n:
            continue
        settled = kind == REPEAT
        if settled.any():
            yield pa.record_batch([pa.array(x[settled]) for x in (doc, start, size, whole, kind)],
                                  ["doc_id", "start", "size", "key", "kind"])
            key, whole, doc, start, size, kind = (x[~settled] for x in (key, whole, doc, start, size, kind))
            n = len(key)
            if not n:
                continue
        # Runs without any neighbour of their key are the great majority: dropped at once.
        near = np.zeros(n, bool)
        near[1:] |= key[1:] == key[:-1]
        near[:-1] |= key[1:] == key[:-1]
        near[[0, -1]] = True
        near |= kind == SHARED
        i = np.flatnonzero(near)
        for k, w, d, s, z, f in zip(*(x[i].tolist() for x in (key, whole, doc, start, size, kind))):
            if held is not None and held[0] == k and held[1] == w:
                if before != (d, s):  # not the same row once more
                    out.append((d, s, z, w, REPEAT))
                    held = (*held[:5], True, held[6])
                elif f == SHARED:
                    held = (*held[:5], True, held[6])
            else:
                seen = held is not None and held[0] == k
                if held is not None:
                    close(k)
                held = (k, w, d, s, z, f == SHARED, seen)
            before = (d, s)
        if len(out) > 50_000:
            yield table(out)
            out.clear()
    if held is not None:
        close(None)
    if out:
        yield table(out)


def _blocks(runs: DataFrame) -> DataFrame:
    n = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (runs.repartition(n, "key").sortWithinPartitions("key", "whole", "doc_id", "start")
            .mapInArrow(_match, MATCHED))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def matched_runs(docs: DataFrame, anchors_of: Callable) -> DataFrame:
    """Runs of windows that occur, or whose anchor occurs, more than once, as a written table.

    (doc_id, start, size, key, kind).  REPEAT and SHARED: every window of the run is
    elsewhere too, earlier for REPEAT; ``key`` names the group of equal runs.  EDGE: the
    windows have to be compared with those of the other EDGE runs of the same ``key``.
    """
    return written(_blocks(_keyed(docs).mapInArrow(_runs(anchors_of), RUNS)), "runs")


def with_spans(docs: DataFrame, spans: DataFrame, *more: str) -> DataFrame:
    """(doc_id, text, starts, sizes, more...) of all documents; arrays are bounded by the document."""
    names = ("start", "size", *more)
    of = spans.groupBy(F.col("doc_id").alias("of")).agg(F.collect_list(F.struct(*names)).alias("s"))
    of = of.select("of", *(F.col(f"s.{name}").alias(f"{name}s") for name in names))
    keyed = _keyed(docs)
    return (keyed.join(of, F.coalesce(keyed.doc_id, F.lit(-1 << 63)) == of["of"], "left")
            .select("doc_id", "text", *(f"{name}s" for name in names)))


def ranges_of(rows: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    """Row number and values of all list elements of a batch."""
    lists = rows.column(names[0])
    sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.empty(0, np.int64)
    if lists.null_count:
        sizes = np.where(lists.is_null().to_numpy(zero_copy_only=False), 0, sizes)
    return [np.repeat(np.arange(len(lists)), sizes), *(rows.column(n).flatten().to_numpy().astype(np.int64) for n in names)]


def windows_matched(windows: DataFrame) -> DataFrame:
    """Single windows, given as runs of size one, matched by two independent hashes."""
    return _blocks(windows).filter(F.col("kind") != EDGE)
