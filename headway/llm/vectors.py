"""Vectorised text primitives shared by the operators: words, hashes, sampled anchors.

Everything works on one bounded slice of an Arrow batch: the UTF-8 bytes of its
texts, one after the other, and the byte offset at which each text begins.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
#: Word separators: space and the controls tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_C = np.uint64(0xD6E8FEB86659FD93)
_S = tuple(np.uint64(x) for x in (27, 31, 33))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit word."""
    h = (h ^ (h >> _S[2])) * _M2
    h = (h ^ (h >> _S[0])) * _M3
    return h ^ (h >> _S[1])


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch where its texts pass ``most`` bytes: (rows, bytes, offsets); a null text is empty."""
    text = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        part = text.slice(at, to - at)
        data = part.buffers()[2]
        first = np.frombuffer(part.buffers()[1], np.int64, to - at + 1, part.offset * 8)
        raw = np.frombuffer(data, np.uint8)[first[0]:first[-1]] if data is not None else np.empty(0, np.uint8)
        yield batch.slice(at, to - at), raw, first - first[0]
        at = to


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the number of the first word of each text (one more at the end)."""
    edge = np.ones(len(raw) + 1, bool)
    word = np.zeros(len(raw) + 1, bool)
    word[:-1] = ~SPACE[raw]
    edge[1:] = word[1:] != word[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    begins = word[at]
    starts, ends = at[begins], np.append(at[1:], len(raw))[begins]
    return starts, ends, np.searchsorted(starts, offsets)


def lanes(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number; zeros follow the end."""
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[:len(raw)] = raw
    return np.ndarray(len(raw) + 1, "<u8", padded.data, strides=(1,))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    lane, size = lanes(raw), ends - starts
    h = mix(size.astype(np.uint64) * _M1)
    left, at = np.arange(len(starts)), 0
    while len(left):
        rest = size[left] - at
        x = lane[starts[left] + at]
        short = rest < 8
        x = np.where(short, x & ((np.uint64(1) << (np.minimum(rest, 7) * 8).astype(np.uint64)) - np.uint64(1)), x)
        h[left] = mix((h[left] ^ x) * _M1 + _M3)
        at += 8
        left = left[rest > 8]
    return h


def join_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of an ordered pair of hashes."""
    return mix(a * _M1 + ((b << _S[1]) | (b >> _S[2])))


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of ``size`` neighbours from each position on (``size`` - 1 positions fewer)."""
    if len(h) < size:
        return h[:0]
    width = 1
    while width * 2 <= size:
        h = join_hash(h[:-width], h[width:])
        width *= 2
    return join_hash(h[:len(h) - (size - width)], h[size - width:]) if size > width else h


def byte_grams(raw: np.ndarray) -> np.ndarray:
    """A hash of the 32 bytes from each position on (31 positions fewer)."""
    x, n = lanes(raw), max(len(raw) - 31, 0)
    h = x[:n] * _M1 + x[8:n + 8] * _M2
    h += x[16:n + 16] * _M3
    h += x[24:n + 24] * _C
    h ^= h >> _S[2]
    h *= _M2
    h ^= h >> _S[0]
    return h


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_M2), -1, 1 << 64))
    return tuple(np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, b, np.uint64)))) for b in (_M2, inverse))


def range_hashes(unit: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of the ``sizes[i]`` units from ``starts[i]`` on: differences of one running polynomial."""
    up, down = _powers(1 << max(len(unit), 1).bit_length())
    total = np.zeros(len(unit) + 1, np.uint64)
    np.cumsum(unit * up[:len(unit)], out=total[1:])
    return mix((total[starts + sizes] - total[starts]) * down[starts] + sizes.astype(np.uint64))


def leftmost_minima(values: np.ndarray, size: int) -> np.ndarray:
    """Position of the leftmost minimum among ``size`` neighbours from each position on."""
    at = np.arange(len(values), dtype=np.int32)
    if len(values) < size:
        return at[:0]
    width = 1
    while width < size:
        step = min(width, size - width)
        second = values[step:]
        values = values[:len(values) - step]
        at = np.where(second < values, at[step:], at[:len(at) - step])
        values = np.minimum(values, second)
        width += step
    return at


#: Windows handled at once by ``anchors``: bounds its memory for any length of text.
CHUNK = 1 << 19


def anchors(raw_units: np.ndarray, grams_of: Callable[[np.ndarray], np.ndarray], gram: int, window: int,
            begins: np.ndarray, unit_hash: Callable[[np.ndarray], np.ndarray] = lambda x: x,
            ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Anchors of all windows of ``window`` units (words or bytes) that lie in one text.

    A window's anchor is the leftmost of its ``gram``-unit grams with the least hash, so
    that equal windows have equal anchors at equal places; about two windows in
    ``window - gram + 2`` have an anchor of their own.  ``begins``: the first unit of each
    text, one more at the end.  Yields, per run of windows with one anchor: the text's
    number, the first window, the number of windows, the anchor's hash, and a hash of all
    units under these windows together with the anchor's place among them.
    """
    for lo in range(0, max(len(raw_units) - window + 1, 0), CHUNK):
        part = raw_units[lo:lo + CHUNK + window - 1]
        grams = grams_of(part)
        least = leftmost_minima(grams, window - gram + 1)
        start = np.arange(lo, lo + len(least))
        text = np.searchsorted(begins, start, "right") - 1
        inside = start + window <= begins[text + 1]
        start, text, at = start[inside], text[inside], least[inside]
        if not len(start):
            continue
        new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (text[1:] != text[:-1]))))
        size = np.diff(np.append(new, len(at)))
        where, place = start[new] - lo, at[new].astype(np.int64)
        whole = range_hashes(unit_hash(part), where, size + window - 1)
        yield text[new], start[new], size, mix(grams[place]), join_hash(whole, (place - where).astype(np.uint64))


#: A random 64-bit number per byte value.
BYTE_HASH = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _M1)


def covered(starts: np.ndarray, sizes: np.ndarray, length: int) -> np.ndarray:
    """Which of ``length`` positions lie in a range; ranges are clipped."""
    step = np.zeros(length + 1, np.int64)
    np.add.at(step, np.clip(starts, 0, length), 1)
    np.add.at(step, np.clip(starts + sizes, 0, length), -1)
    return np.cumsum(step[:-1]) > 0


def runs(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """at[i], at[i] + 1 ... of each of the runs, one after the other."""
    return np.arange(int(size.sum())) + np.repeat(at - (np.cumsum(size) - size), size)


def joined(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words with a space after each: (bytes, where each word begins, its size)."""
    size = ends - starts
    at = np.cumsum(size + 1) - size - 1
    out = np.full(int((size + 1).sum()), 32, np.uint8)
    out[runs(at, size)] = raw[runs(starts, size)]
    return out, at, size
