"""Exact repeats of bytes by enhanced suffix arrays over blocks of the corpus.

Only surroundings that share an anchor can hold a repeat, so each block is the set
of snippets with the same anchors.  A block's suffix array with its common-prefix
table is scanned once with a stack; the intervals of the common-prefix tree whose
occurrences differ in the byte before them are the maximal repeats, each given with
all its occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from headway.llm.repeats import (EDGE, REPEAT, RUNS, _combined, byte_anchors, matched_runs, ranges_of, windows_matched, with_spans)
from headway.llm.vectors import BYTE_HASH, covered, lanes, mix, range_hashes, runs, slices

#: Suffixes sorted together; a block takes whole anchors until it has so many.
BLOCK = 1 << 17
#: Snippets with one anchor beyond which its windows are matched one by one, in all tasks.
LARGEST = 8192

SNIPPET = "key long, doc_id long, start long, size int, bytes binary"


def _snippets(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw, offsets in slices(batch, "text"):
                ids = rows.column("doc_id").fill_null(-1 << 63).to_numpy()
                row, at, size, key = ranges_of(rows, "starts", "sizes", "keys")
                inside = offsets[row] + at + size + window - 1 <= offsets[row + 1]
                row, at, size, key = (x[inside] for x in (row, at, size, key))
                begin = offsets[row] + at
                length = size + window - 1
                for lo in range(0, len(row), 1 << 14):
                    part = slice(lo, lo + (1 << 14))
                    ends = np.concatenate(([0], np.cumsum(length[part]))).astype(np.int32)
                    data = raw[runs(begin[part], length[part])]
                    text = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])
                    yield pa.record_batch([pa.array(key[part]), pa.array(ids[row[part]]), pa.array(at[part]),
                                           pa.array(size[part].astype(np.int32)), text],
                                          ["key", "doc_id", "start", "size", "bytes"])
    return run


def suffix_array(raw: np.ndarray, at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes raw[at[i]:ends[i]] and the common prefix of each with the one before it."""
    lane, size = lanes(raw), ends - at
    most = int(size.max(initial=0))
    columns = []
    for k in range(0, most, 8):
        rest = np.clip(size - k, 0, 8)
        mask = np.where(rest >= 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (rest * 8).astype(np.uint64)) - np.uint64(1))
        columns.append(lane[np.minimum(at + k, len(raw))] & mask)
    order = np.lexsort([size, *(c.byteswap() for c in reversed(columns))])
    common = np.zeros(len(order), np.int64)
    going = np.ones(len(order), bool)
    going[:1] = False
    for c in columns:
        c = c[order]
        differ = np.zeros(len(c), np.uint64)
        differ[1:] = c[1:] ^ c[:-1]
        low = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)).astype(np.int64) // 8
        common += np.where(going, np.where(differ == 0, 8, low), 0)
        going &= differ == 0
    size = size[order]
    common[1:] = np.minimum(common[1:], np.minimum(size[1:], size[:-1]))
    return order, common


def maximal_repeats(common: np.ndarray, before: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(length, first, last) of the common-prefix intervals of at least ``least`` that are left-diverse.

    ``before``: the byte before each suffix in suffix-array order, -1 where there is none
    (which differs from everything).  One scan with a stack: an interval opens where the
    common prefix grows, closes where it falls, and hands its left bytes to its parent.
    """
    found, n = [], len(common)
    values, left = common.tolist(), before.tolist()
    stack: list[list] = []  # length, first, the one left byte so far, or -1 once there are several
    i = 1
    while i <= n:
        here = values[i] if i < n else 0
        if here < least:
            here = 0
        first, byte = i - 1, left[i - 1]
        while stack and stack[-1][0] > here:
            length, begin, seen = stack.pop()
            seen = seen if seen == byte else -1
            if seen < 0:
                found.append((length, begin, i - 1))
            first, byte = begin, seen
        if here:
            if stack and stack[-1][0] == here:
                stack[-1][2] = stack[-1][2] if stack[-1][2] == byte else -1
            else:
                stack.append([here, first, byte])
        i += 1
    return found


def _groups(window: int):
    """Maximal repeats of each block of snippets, sorted by (key, doc_id, start)."""
    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        text = rows.column("bytes")
        offsets = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1, text.offset * 4).astype(np.int64)
        raw = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        offsets -= offsets[0]
        doc, start, size = (rows.column(c).to_numpy().astype(np.int64) for c in ("doc_id", "start", "size"))
        snippet = np.repeat(np.arange(len(size)), size)
        at = runs(offsets[:-1], size)
        # Suffixes whose first window is nowhere else in the block belong to no interval.
        h = range_hashes(BYTE_HASH[raw], at, np.full(len(at), window))
        _, which, times = np.unique(h, return_inverse=True, return_counts=True)
        shared = times[which] > 1
        at, snippet = at[shared], snippet[shared]
        order, common = suffix_array(raw, at, offsets[snippet + 1])
        at, snippet = at[order], snippet[order]
        before = np.where(at > offsets[snippet], raw[at - 1].astype(np.int64), -1)
        found = maximal_repeats(common, before, window)
        length, first, last = (np.array(x, np.int64) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3
        count = last - first + 1
        member = runs(first, count)
        place = start[snippet] + at - offsets[snippet]
        group = np.repeat(np.arange(len(first)), count)
        name = mix(range_hashes(BYTE_HASH[raw], at[first], length)).view(np.int64)[group] if len(first) else np.empty(0, np.int64)
        docs, places = doc[snippet[member]], place[member]
        # The earliest occurrence of each group.
        by = np.lexsort((places, docs, group))
        earliest = np.zeros(len(by), bool)
        earliest[by[np.flatnonzero(np.diff(group[by], prepend=-1))]] = True
        return pa.record_batch([pa.array(name), pa.array(length[group]), pa.array(docs), pa.array(places), pa.array(earliest)],
                               ["repeat", "length", "doc_id", "start", "earliest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        have, last = 0, None
        for batch in batches:
            key = batch.column("key").to_numpy()
            cuts = np.flatnonzero(np.diff(key)) + 1
            total = np.cumsum(batch.column("size").to_numpy().astype(np.int64))
            lo = 0
            if held and len(key) and key[0] != last and have >= BLOCK:
                yield block(held)
                held, have = [], 0
            for cut in cuts.tolist():
                if have + total[cut - 1] - (total[lo - 1] if lo else 0) >= BLOCK:
                    yield block([*held, batch.slice(lo, cut - lo)])
                    held, have, lo = [], 0, cut
            if lo < len(key):
                held.append(batch.slice(lo))
                have += int(total[-1] - (total[lo - 1] if lo else 0))
                last = key[-1]
        if held:
            yield block(held)
    return run


def _windows(window: int):
    """The single windows of snippets whose anchor is too frequent for one block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                rows = batch.slice(lo, 4096)
                text = rows.column("bytes")
                offsets = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1, text.offset * 4).astype(np.int64)
                raw = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
                size = rows.column("size").to_numpy().astype(np.int64)
                at, row = runs(offsets[:-1] - offsets[0], size), np.repeat(np.arange(len(size)), size)
                sizes, unit = np.full(len(at), window), BYTE_HASH[raw]
                start = rows.column("start").to_numpy()[row] + at - (offsets[:-1] - offsets[0])[row]
                yield _combined(range_hashes(unit, at, sizes), range_hashes(mix(unit + np.uint64(1)), at, sizes),
                                rows.column("doc_id").to_numpy()[row], start, np.ones(len(at), np.int64))
    return run


def repeats(docs: DataFrame, window: int = 100, largest: int = LARGEST) -> DataFrame:
    """Groups of repeats of at least ``window`` bytes with all their occurrences.

    (repeat: name of the group, length in bytes, doc_id, start, earliest).  A repeat is
    maximal within what surrounds its anchor; longer common passages are given by several
    overlapping groups, and every string of ``window`` bytes that is found more than once
    lies in groups with all its occurrences.  ``earliest`` marks the first occurrence, by
    doc_id and then by start.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    matched = matched_runs(docs, byte_anchors(window))
    whole = matched.filter(F.col("kind") != EDGE).select(
        F.col("key").alias("repeat"), (F.col("size") + F.lit(window - 1)).cast("long").alias("length"),
        "doc_id", "start", (F.col("kind") != REPEAT).alias("earliest"))
    edges = matched.filter(F.col("kind") == EDGE)
    busy = edges.groupBy("key").count().filter(F.col("count") > largest).select("key")
    found = []
    for how, turn in (("left_anti", True), ("left_semi", False)):
        snippets = with_spans(docs, edges.join(busy, "key", how), "key").filter("starts is not null").mapInArrow(_snippets(window), SNIPPET)
        if turn:
            found.append(snippets.repartition(n, "key").sortWithinPartitions("key", "doc_id", "start")
                         .mapInArrow(_groups(window), "repeat long, length long, doc_id long, start long, earliest boolean"))
        elif not busy.isEmpty():
            found.append(windows_matched(snippets.mapInArrow(_windows(window), RUNS)).select(
                F.col("key").alias("repeat"), F.lit(window).cast("long").alias("length"), "doc_id", "start",
                (F.col("kind") != REPEAT).alias("earliest")))
    for more in found:
        whole = whole.union(more)
    return whole


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, raw, offsets in slices(batch, "text"):
            row, at, size = ranges_of(rows, "starts", "sizes")
            length = np.diff(offsets)
            at = np.minimum(at, length[row])
            removed = covered(offsets[row] + at, np.minimum(size, length[row] - at), len(raw))
            kept = raw[~removed].tobytes()
            many = np.concatenate(([0], np.cumsum(~removed)))[offsets]
            first = removed.copy()
            first[1:] &= ~removed[:-1]
            inside = offsets[:-1][offsets[:-1] < len(raw)]
            first[inside] = removed[inside]  # a span that begins a text is its own
            spans = np.concatenate(([0], np.cumsum(first)))[offsets]
            yield pa.record_batch([
                rows.column("doc_id"), pa.array([kept[a:b] for a, b in zip(many.tolist(), many[1:].tolist())], pa.binary()),
                pa.array(length), pa.array(length - np.diff(many)), pa.array(np.diff(spans))],
                ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])


def without_later_repeats(docs: DataFrame, window: int = 100, largest: int = LARGEST) -> DataFrame:
    """Documents without the bytes of any ``window``-byte string that also starts earlier.

    (doc_id, kept: binary, n_bytes, n_removed, n_spans).  Earlier: in a smaller doc_id, or
    before in the same document.  Strings are judged on the input and may overlap; they
    never cross documents.  What is kept may cut a character in two and is therefore
    binary.  A null or empty text has no bytes.  doc_id is the key: rows that repeat one
    with the same text are one document, reported for each row; null ids are one key,
    before all others.  Further columns are ignored.
    """
    later = repeats(docs, window, largest).filter(~F.col("earliest")).select("doc_id", "start", F.col("length").alias("size"))
    return with_spans(docs, later).mapInArrow(
        _kept, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")
