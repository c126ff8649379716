"""Plain versions of the operators' contracts, for small tables."""

import collections
import hashlib
import math
import re
import zlib

import xxhash

WORD = re.compile("[^\\x20\\x09-\\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


def without_repeats(docs, window):
    times = collections.Counter()
    for text in docs.values():
        w = words(text)
        times.update(tuple(w[i:i + window]) for i in range(len(w) - window + 1))
    out = {}
    for doc, text in docs.items():
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if times[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out[doc] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def without_later_repeats(docs, window):
    seen, out = set(), {}
    for doc in sorted(docs, key=lambda d: (d is not None, d or 0)):
        raw = (docs[doc] or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - window + 1):
            part = raw[i:i + window]
            if part in seen:
                gone[i:i + window] = b"\1" * window
            seen.add(part)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g))
    return out


def fingerprint(text, shingle):
    w = words((text or "").translate(LOWER))
    if not w:
        return 0
    k = min(shingle, len(w))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_linked(nodes, linked):
    """The least node that each can reach."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def shingles(text, k=5):
    w = words((text or "").translate(LOWER))
    return frozenset(" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def quality_counts(text):
    w = words(text)
    text = text or ""
    times = collections.Counter(zip(w, w[1:], w[2:]))
    covered, seen, again = set(), set(), 0
    for i in range(len(w) - 2):
        if times[tuple(w[i:i + 3])] > 1:
            covered.update((i, i + 1, i + 2))
    for line in text.split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), again, len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def unigrams(docs):
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d in docs}
    token = {d: [*words((t or "").translate(LOWER)), None] for d, t in docs.items()}
    count = collections.Counter(x for d in docs if not held[d] for x in token[d])
    total, types = sum(count.values()), len(count)
    return {d: (held[d], len(token[d]), sum(x in count for x in token[d]), total,
                sum(math.log10((count.get(x, 0) + 1) / (total + types + 1)) for x in token[d])) for d in docs}


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()
