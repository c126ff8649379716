"""SimHash near-duplicates, linked by vantage-point trees over Hamming distance.

Documents are reduced to 64-bit fingerprints, equal fingerprints to one point.
Vantage points cut the space of fingerprints into shards: at each level a point
goes to the inner or outer side of a vantage point's radius, and whoever lies
within ``distance`` of the boundary also visits the other side, because by the
triangle bound only there a neighbour can be.  Each shard builds a vantage-point
tree of its residents and answers its residents and visitors exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from headway.llm.frames import components, written
from headway.llm.vectors import joined, mix, slices, words

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
SEED = 42
#: Points that a shard's tree is planned for; more levels are cut for more points.
SHARD_POINTS = 1 << 15
#: Points used to choose the radii; results do not depend on it.
RADIUS_SAMPLE = 4096
LEAF = 256


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash64 = xxhash.xxh64_intdigest
        for batch in batches:
            for rows, raw, offsets in slices(batch, "text"):
                starts, ends, first = words(raw, offsets)
                # Words joined by one space: each shingle is then one run of bytes.
                line, at, size = joined(raw, starts, ends)
                text = line.tobytes().translate(LOWER)
                out = np.zeros(rows.num_rows, np.uint64)
                for i in range(rows.num_rows):
                    lo, hi = int(first[i]), int(first[i + 1])
                    if lo == hi:
                        continue
                    k = min(shingle, hi - lo)
                    begin = at[lo:hi - k + 1].tolist()
                    end = (at[lo + k - 1:hi] + size[lo + k - 1:hi]).tolist()
                    h = np.fromiter((hash64(text[s:e], SEED) for s, e in zip(begin, end)), np.uint64, len(begin))
                    out[i] = _majority(h)
                yield pa.record_batch([rows.column("doc_id"), pa.array(out.view(np.int64))], ["doc_id", "fingerprint"])
    return run


def _majority(h: np.ndarray) -> np.uint64:
    """Bits that are set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(h), 1 << 15):
        bits = np.unpackbits(h[lo:lo + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(h), bitorder="little").view(np.uint64)[0]


def fingerprints(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """(doc_id, fingerprint: long) of every document; see ``near_duplicates``."""
    return docs.select("doc_id", "text").mapInArrow(_fingerprints(shingle), "doc_id long, fingerprint long")


def _distances(points: np.ndarray, to: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ to)


def vantage_points(levels: int) -> np.ndarray:
    """One fixed pseudo-random vantage point per level."""
    return mix(np.arange(1, levels + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _place(vantages: np.ndarray, radii: list[int], distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column("fingerprint").to_numpy().view(np.uint64)
            which, home, shard = np.arange(len(points)), np.ones(len(points), bool), np.zeros(len(points), np.int64)
            for vantage, radius in zip(vantages, radii):
                d = _distances(points[which], vantage).astype(np.int64)
                outer = d > radius
                visits = np.abs(d - radius - 0.5) < distance
                shard = shard * 2 + outer
                also = np.flatnonzero(visits)
                shard = np.concatenate((shard, shard[also] ^ 1))
                home = np.concatenate((home, np.zeros(len(also), bool)))
                which = np.concatenate((which, which[also]))
            yield pa.record_batch([pa.array(shard), pa.array(points[which].view(np.int64)), pa.array(home)],
                                  ["shard", "fingerprint", "home"])
    return run


def pairs_within(residents: np.ndarray, asked: np.ndarray, distance: int, seed: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All (asked index, resident index) within ``distance``, by a vantage-point tree of the residents.

    The tree is walked with sets of queries: a branch receives the queries whose
    triangle bound allows a neighbour in it, and a leaf compares them with its points.
    """
    stack = [(np.arange(len(residents)), np.arange(len(asked)), 0)]
    while stack:
        own, queries, depth = stack.pop()
        if not len(queries) or not len(own):
            continue
        points = residents[own]
        if len(own) > LEAF:
            vantage = points[(depth * 7919 + seed) % len(points)]
            d = _distances(points, vantage)
            radius = int(np.partition(d, len(d) // 2)[len(d) // 2])
            inner = d <= radius
            if inner.all() and radius:
                radius -= 1
                inner = d <= radius
            if inner.any() and not inner.all():
                q = _distances(asked[queries], vantage).astype(np.int64)
                stack.append((own[inner], queries[q <= radius + distance], depth + 1))
                stack.append((own[~inner], queries[q > radius - distance], depth + 1))
                continue
        for lo in range(0, len(queries), 2048):
            part = queries[lo:lo + 2048]
            for at in range(0, len(own), 2048):
                a, b = np.nonzero(np.bitwise_count(asked[part][:, None] ^ points[None, at:at + 2048]) <= distance)
                if len(a):
                    yield part[a], own[at + b]


def _links(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            points = shard.column("fingerprint").to_numpy().view(np.uint64)
            home = shard.column("home").to_numpy(zero_copy_only=False)
            residents = points[home]
            # A spanning forest of the shard's links keeps what is connected connected.
            parent = np.arange(len(points))
            own = np.flatnonzero(home)
            for a, b in pairs_within(residents, points, distance):
                _unite(parent, a, own[b])
            root = _flat(parent)
            linked = np.flatnonzero(root != np.arange(len(points)))
            yield pa.record_batch([pa.array(points[linked].view(np.int64)), pa.array(points[root[linked]].view(np.int64))], ["u", "v"])
    return run


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each shard; input is sorted by shard."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            if held and held[0].column("shard")[0].as_py() != shard[lo]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _flat(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of all pairs: hang larger roots below smaller ones until none differ."""
    while len(a):
        flat = _flat(parent)
        parent[:] = flat
        x, y = flat[a], flat[b]
        differ = x != y
        a, b = a[differ], b[differ]
        np.minimum.at(parent, np.maximum(x, y)[differ], np.minimum(x, y)[differ])


def near_duplicates(docs: DataFrame, shingle: int = 5, distance: int = 2,
                    shard_points: int = SHARD_POINTS) -> DataFrame:
    """Components of documents whose fingerprints differ in ``distance`` bits at most.

    Returns (doc_id, fingerprint: 16 hex digits, component_id).  Texts are lower-cased
    in A-Z; words are runs between white space (space, tab to carriage return); a text
    of fewer than ``shingle`` words is one shingle; a text without words, or null, has
    fingerprint zero and is linked like any other.  Rows that repeat a doc_id are each
    reported; a null doc_id is in its component but never names one unless it is alone
    there.  Further columns are ignored.  An empty table gives an empty result.
    """
    prints = written(fingerprints(docs, shingle), "fingerprints")
    points = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")), "points")
    levels, n = 0, points.count()
    while n > shard_points << levels:
        levels += 1
    vantages, radii = vantage_points(levels), []
    if levels:
        sample = points.select("fingerprint").orderBy(F.xxhash64("fingerprint")).limit(RADIUS_SAMPLE).toPandas()
        sampled = sample["fingerprint"].to_numpy(np.int64).view(np.uint64)
        radii = [int(np.median(_distances(sampled, v))) for v in vantages]
    placed = points.select("fingerprint").mapInArrow(
        _place(vantages, radii, distance), "shard long, fingerprint long, home boolean")
    links = (placed.repartition(max(1 << levels, 1), "shard").sortWithinPartitions("shard")
             .mapInArrow(_links(distance), "u long, v long"))
    root = components(links)
    named = points.join(root, points.fingerprint == root.node, "left").select(
        points.fingerprint, "doc_id", F.coalesce("root", points.fingerprint).alias("root"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    names = named.join(least, "root").select("fingerprint", "component_id")
    return prints.join(names, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 5, distance: int = 2) -> DataFrame:
    """All columns of one document of each component: the one with the least doc_id.

    Components are those of ``near_duplicates``, over rows: a row is known by the hash of
    all its columns, so rows that repeat a doc_id with another text are documents of their
    own, and rows that repeat each other whole are one.  A null id comes last, equal ids
    are told apart by their rows' hashes.  An empty table gives an empty result.
    """
    rows = docs.withColumn("__row", F.xxhash64(*docs.columns))
    found = near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text"), shingle, distance)
    of = written(found.groupBy(F.col("doc_id").alias("__row"), "component_id").agg(F.count(F.lit(1)).alias("__times")), "components")
    ids = rows.select("__row", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row").alias("order")).distinct()
    first = F.min_by(F.struct("__row", "__times"), "order").alias("first")
    stays = of.join(ids, "__row").groupBy("component_id").agg(first).select("first.*")
    # Most rows stay, so the list of those that go is the short one; as a written table
    # Spark knows its size.  Rows that repeat each other whole are on it and come back once.
    listed = of.join(stays.filter("__times = 1"), "__row", "left_anti").select("__row")
    listed = written(listed.join(stays.select("__row", F.lit(True).alias("__once")), "__row", "left"), "listed")
    alone = rows.join(listed.select("__row"), "__row", "left_anti")
    repeated = rows.join(listed.filter("__once").select("__row"), "__row", "left_semi").dropDuplicates(["__row"])
    return alone.union(repeated).drop("__row")
