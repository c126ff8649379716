"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Only the histogram of piece lengths (at most ``capacity`` numbers) is solved on the
driver; its size does not grow with the data.  Pieces find their places by joining
their rank among the pieces of their length with the solved slots.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from headway.llm.frames import written
from headway.llm.vectors import slices

CAPACITY = 2048
#: Groups of one length are ranked in so many parts, so that no length is one task's.
PARTS = 256
#: Pieces whose ids a task keeps; beyond, it starts afresh.
KEPT_PIECES = 1_000_000

#: Fixed: how the tokenizer file splits lower-case text into pieces, for the characters of _SAFE.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
#: Characters for which that pattern and lower() agree with the tokenizer's own steps.
_SAFE = "\t-\r -~\u00bf\u00a1\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff\u2010-\u2026\u20ac"
_UNSAFE = re.compile(f"[^{_SAFE}]|<\\|")
_SPACES = re.compile("[\\x20\\x09-\\x0D]+")


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level BPE writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(other)}}


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class TextIds:
    """Token ids of texts, as little-endian 32-bit bytes.

    The tokenizer drops white space and never joins pieces, so a text's ids are its
    pieces' ids, and each new piece is encoded once by the tokenizer's model.  Words with
    unusual characters, or with what may be a special token, go through all its steps.
    """

    def __init__(self, path: str, kept: int = KEPT_PIECES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.kept = self.tokenizer.model, kept
        self.letters = _byte_letters()
        self.pieces: dict[str, bytes] = {}

    def _new(self, piece: str) -> bytes:
        if len(self.pieces) >= self.kept:
            self.pieces.clear()
        shown = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
        ids = self.pieces[piece] = np.array([t.id for t in self.model.tokenize(shown)], "<u4").tobytes()
        return ids

    def of(self, text: str) -> bytes:
        if _UNSAFE.search(text):
            return b"".join([self._word(w) for w in _SPACES.split(text) if w])
        known = self.pieces.get
        return b"".join([known(p) or self._new(p) for p in _PIECES.findall(text.lower())])

    def _word(self, word: str) -> bytes:
        if _UNSAFE.search(word):
            return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        return self.of(word)


@cache
def _ids_of(path: str) -> TextIds:
    return TextIds(path)


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _ids_of(path).of
        for batch in batches:
            for rows, raw, offsets in slices(batch, "text"):
                out = []
                whole = raw.tobytes()
                for doc, lo, hi in zip(rows.column("doc_id").to_pylist(), offsets.tolist(), offsets[1:].tolist()):
                    ids = ids_of(whole[lo:hi].decode()) + b"\0\0\0\0"
                    for k in range(0, len(ids), capacity * 4):
                        part = ids[k:k + capacity * 4]
                        out.append((doc, k // (capacity * 4), k // 4, len(part) // 4, zlib.crc32(part)))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(
                    zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids, a closing 0 included."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _pieces(tokenizer, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long")


def solve(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Bins for ``counts[length]`` pieces of each length: (lengths in a bin, how many such bins).

    First the Martello-Toth reduction: from the longest on, a length is fixed in a bin with
    at most one other if that provably dominates every other way to fill this bin, because
    what another way holds beside it could be exchanged for the one.  With ``room`` beside it:
    - nothing fits: it stays alone;
    - a piece of length ``room`` is left: an exact fill dominates;
    - the longest that fits is at least as long as any two that fit together, and three
      never fit: it dominates.
    What is left then goes to best fit decreasing.  Both work on counts, so that equal
    bins are made at once.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    fixed: list[tuple[list[int], int]] = []
    for big in sorted(left, reverse=True):
        while left.get(big):
            others = sorted(n for n in left if n <= capacity - big and (n != big or left[big] > 1))
            partner = _dominant(others, left, big, capacity - big)
            if partner is None:
                break
            bin_ = [big, *partner]
            many = left[big] // 2 if partner == [big] else min(left[n] for n in bin_)
            for n in bin_:
                left[n] -= many
            left = {n: c for n, c in left.items() if c}
            fixed.append((bin_, many))
    return fixed + best_fit(left, capacity)


def _dominant(fit: list[int], left: dict[int, int], big: int, room: int) -> list[int] | None:
    """What to put beside ``big`` in the dominating bin; None if no bin dominates."""
    if not fit:
        return []
    longest = fit[-1]
    if longest == room:
        return [longest]
    if fit[0] * 3 <= room:
        return None
    lo, hi = 0, len(fit) - 1
    while lo <= hi:
        pair = fit[lo] + fit[hi]
        if pair > room or (lo == hi and left[fit[lo]] - (fit[lo] == big) < 2):
            hi -= 1
        elif pair > longest:
            return None
        else:
            lo += 1
    return [longest]


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Best fit decreasing on counts: a length goes to the fullest open bins that it fits in."""
    open_: dict[int, list[tuple[tuple, int]]] = {}  # room -> (contents, how many bins)
    rooms: list[int] = []
    def put(room: int, contents: tuple, many: int) -> None:
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append((contents, many))

    for n in sorted(counts, reverse=True):
        many = counts[n]
        while many:
            i = bisect_left(rooms, n)
            if i == len(rooms):
                # New bins: each takes as many of this length as it holds.
                each = capacity // n
                bins, rest = divmod(many, each)
                if bins:
                    put(capacity - each * n, ((n, each),), bins)
                if rest:
                    put(capacity - rest * n, ((n, rest),), 1)
                break
            room = rooms[i]
            contents, bins = open_[room].pop()
            if not open_[room]:
                del open_[room], rooms[i]
            # The fullest bin is filled on with this length while it still fits.
            each = min(room // n, many)
            used = min(bins, many // each)
            put(room - each * n, (*contents, (n, each)), used)
            if bins > used:
                put(room, contents, bins - used)
            many -= used * each
    return [([n for n, k in contents for _ in range(k)], many) for at in open_.values() for contents, many in at]


def slots(bins: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Where pieces go by length and rank: (length, first rank, ranks, first sequence, sequences, offset).

    The pieces of ranks first .. first + ranks - 1 of a length go to consecutive sequences,
    at ``offset``.
    """
    out, rank, sequence = [], {}, 0
    for lengths, many in bins:
        offset = 0
        for n in lengths:
            out.append((n, rank.get(n, 0), many, sequence, offset))
            rank[n] = rank.get(n, 0) + many
            offset += n
        sequence += many
    return out


def ranked(found: DataFrame) -> DataFrame:
    """Pieces with a rank, from 0, among those of their length.

    Ranks are given within (length, part) and moved by the counts of the parts before: a
    length with a third of all pieces is spread over ``PARTS`` groups, each cut once more
    by the sort that a window needs, never collected.
    """
    parted = found.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(PARTS)))
    sizes = parted.groupBy("length", "part").count()
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    shift = sizes.withColumn("shift", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    own = W.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    return (parted.withColumn("own", F.row_number().over(own) - 1).join(shift, ["length", "part"])
            .withColumn("rank", F.col("own") + F.col("shift")).drop("own", "shift", "part"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Sequences of at most ``capacity`` tokens that hold all documents, cut only where longer.

    (doc_id, piece, start, length, ids_crc32, sequence_id, offset).  A document is its ids
    and a closing 0; a null or empty text is that 0 alone.  Offsets of a sequence are
    gapless from 0.  Repeated rows and null ids are pieces of their own.  An empty table
    gives an empty result.  Further columns are ignored.
    """
    spark = docs.sparkSession
    found = written(pieces(docs, tokenizer, capacity), "pieces")
    counts = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}
    places = slots(solve(counts, capacity))
    table = spark.createDataFrame(places, "length long, first long, ranks long, sequence long, offset long")
    # A length's slots by first rank, in one array: at most the number of distinct bins.
    by_length = table.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("first", "ranks", "sequence", "offset"))).alias("s"))
    return _placed(ranked(found), by_length)


def _placed(found: DataFrame, by_length: DataFrame) -> DataFrame:
    step = F.expr("filter(s, x -> x.first <= rank and rank < x.first + x.ranks)[0]")
    return found.join(F.broadcast(by_length), "length").withColumn("slot", step).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("slot.sequence") + F.col("rank") - F.col("slot.first")).alias("sequence_id"),
        F.col("slot.offset").alias("offset"))
