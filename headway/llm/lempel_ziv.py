"""Substring dedup of words by relative Lempel-Ziv parsing.

Every document is parsed greedily against an index of the whole corpus, kept in
hash partitions (the reference blocks): each sampled phrase is looked up in the
block that holds its anchor.  Phrases whose whole surroundings are elsewhere too
join to factors.  Where a factor begins or ends, the surroundings differ; there
every window is compared exactly, so that no repeat across a boundary is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from headway.llm.repeats import (EDGE, RUNS, _combined, matched_runs, ranges_of, windows_matched, with_spans, word_anchors)
from headway.llm.vectors import covered, joined, mix, range_hashes, runs, slices, word_hashes, words

#: Words of the grams that anchors are chosen from, for windows of three times as many at least.
GRAM = 12


def _boundary_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw, offsets in slices(batch, "text"):
                ids = rows.column("doc_id").fill_null(-1 << 63).to_numpy()
                starts, ends, first = words(raw, offsets)
                unit = word_hashes(raw, starts, ends)
                row, at, size = ranges_of(rows, "starts", "sizes")
                where = np.repeat(row, size)
                start = runs(at, size)
                inside = first[where] + start + window <= first[where + 1]
                where, start = where[inside], start[inside]
                here = first[where] + start
                sizes = np.full(len(here), window)
                for lo in range(0, len(here), 1 << 18):
                    part = slice(lo, lo + (1 << 18))
                    one = range_hashes(unit, here[part], sizes[part])
                    two = range_hashes(mix(unit + np.uint64(1)), here[part], sizes[part])
                    yield _combined(one, two, ids[where[part]], start[part], np.ones(len(one), np.int64))
    return run


def factors(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Greedy parse: from left to right the longest factors, (first unit, units), none shorter than ``window``.

    ``starts``: for each window of a document whether the index holds it elsewhere.
    """
    at = np.flatnonzero(np.diff(np.concatenate(([0], starts.astype(np.int8), [0]))))
    return [(int(a), int(b - a) + window - 1) for a, b in zip(at[::2], at[1::2])]


def _kept(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw, offsets in slices(batch, "text"):
                starts, ends, first = words(raw, offsets)
                row, at, size = ranges_of(rows, "starts", "sizes")
                # Spans of a repeated doc_id's other text are cut at this text's end.
                last = np.maximum(first[row + 1] - first[row] - window + 1, 0)
                at, to = np.minimum(at, last), np.minimum(at + size, last)
                repeated = covered(first[row] + at, to - at, len(starts))
                where = first[row[to > at]] + at[to > at]
                removed = covered(where, (to - at)[to > at] + window - 1, len(starts))
                keep = np.flatnonzero(~removed)
                line, begin, sizes = joined(raw, starts[keep], ends[keep])
                count = np.diff(np.searchsorted(keep, first))
                bound = np.append(begin, len(line))[np.searchsorted(keep, first)]
                text = line.tobytes()
                new = np.zeros(len(starts) + 1, bool)
                new[:-1] = repeated
                new[1:-1] &= ~repeated[:-1] if len(starts) else True
                yield pa.record_batch([
                    rows.column("doc_id"),
                    pa.array([text[a:max(a, b - 1)] for a, b in zip(bound.tolist(), bound[1:].tolist())], pa.binary()).cast(pa.string()),
                    pa.array(np.diff(first)), pa.array(np.diff(first) - count),
                    pa.array(np.add.reduceat(np.append(new, False), first[:-1]) * (np.diff(first) > 0) if rows.num_rows else [], pa.int64()),
                ], ["doc_id", "text", "n_words", "n_removed", "n_factors"])
    return run


def without_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """Documents without the words of any ``window`` consecutive words that are also elsewhere.

    (doc_id, text: kept words joined by one space, n_words, n_removed, n_factors).  All
    copies go, in other documents and in the same one; a window is judged on the input.
    A null or empty text has no words and gives an empty text.  doc_id is the key: rows
    that repeat one with the same text are one document, reported for each row; so are
    null ids; texts that differ under one id share their removed places.  Texts of fewer
    than ``window`` words stay whole (but for white space).  Further columns are ignored.
    """
    matched = matched_runs(docs, word_anchors(window, min(GRAM, max(1, window // 3))))
    edges = with_spans(docs, matched.filter(F.col("kind") == EDGE)).filter("starts is not null")
    compared = windows_matched(edges.mapInArrow(_boundary_windows(window), RUNS))
    spans = matched.filter(F.col("kind") != EDGE).union(compared).select("doc_id", "start", "size")
    return with_spans(docs, spans).mapInArrow(
        _kept(window), "doc_id long, text string, n_words long, n_removed long, n_factors long")
