"""Hard negatives by a multiway hyperplane tree with distance ranges (GNAT).

A node has several split points, and a vector belongs to the nearest one (the
hyperplanes between split points bound their parts).  Each split point stores, for the
subtree of every sibling and its own, the least and greatest distance to the vectors
there.  A query asks for scores in a window; with the vectors lifted by one component to
equal length, an inner product s is a distance: d^2 = |a|^2 + M^2 - 2s, so a window of
scores is an annulus around the query.  A subtree is left out as soon as the range of one
split point misses what the annulus and the query's distance to that point allow.
Leaves are compared exactly, in whole numbers.

The split points are fit on a bounded sample; every vector is in a leaf, the ranges are
measured over all vectors, and leaves are cut into blocks, so that neither a busy leaf
nor a vector that a third of all rows share is one task's work.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from headway.llm.frames import written
from headway.llm.vectors import mix
from headway.llm.whole_vectors import matrix, whole_vectors

#: Rows on which split points are fit and windows are narrowed; the sample of the least hashes.
SAMPLE = 4096
#: Split points of a node, and rows of the sample that a leaf may hold.
SPLITS, LEAF_SAMPLE = 8, 64
#: Rows of a block, and of the part of a leaf that one task packs into blocks.
BLOCK, PART = 2048, 16384
#: Queries scored at once against a block.
QUERIES = 512
#: Distances are widened by this share of their scale: far above the error of their square roots.
SLACK = 4e-7
#: Scores beyond any that occur.
FAR = 1 << 62


@dataclass
class Node:
    points: np.ndarray
    lifted: np.ndarray
    #: Numbers of child nodes; a leaf is -1 - its number.
    children: list[int] = field(default_factory=list)
    #: [child, split point]: least and greatest distance to the vectors of the child.
    least: np.ndarray | None = None
    greatest: np.ndarray | None = None


@dataclass
class Tree:
    #: Greatest squared length of all vectors, and their common size.
    longest: int
    width: int
    nodes: list[Node] = field(default_factory=list)
    #: Per leaf the (node, child) pairs from the root on.
    paths: list[list[tuple[int, int]]] = field(default_factory=list)

    def lift(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.longest - (x.astype(float) ** 2).sum(axis=1), 0.0))

    def distances(self, node: int, x: np.ndarray, lifted: np.ndarray) -> np.ndarray:
        """Distances of lifted rows to the node's split points."""
        here = self.nodes[node]
        square = ((x.astype(float) ** 2).sum(axis=1)[:, None] + (here.points.astype(float) ** 2).sum(axis=1)[None]
                  - 2.0 * (x.astype(float) @ here.points.T.astype(float)) + (lifted[:, None] - here.lifted[None]) ** 2)
        return np.sqrt(np.maximum(square, 0.0))

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: that of the nearest split point at every node."""
        out, lifted = np.zeros(len(x), np.int64), self.lift(x)
        stack = [(0, np.arange(len(x)))] if self.nodes else []
        while stack:
            node, rows = stack.pop()
            side = self.distances(node, x[rows], lifted[rows]).argmin(axis=1)
            for j, child in enumerate(self.nodes[node].children):
                part = rows[side == j]
                if len(part) and child < 0:
                    out[part] = -1 - child
                elif len(part):
                    stack.append((child, part))
        return out

    def ranges_of(self, leaf: int, x: np.ndarray) -> np.ndarray:
        """Least and greatest distances of a block of the leaf to all split points on its path."""
        lifted, found = self.lift(x), []
        for node, _ in self.paths[leaf]:
            d = self.distances(node, x, lifted)
            found.append(np.concatenate((d.min(axis=0), d.max(axis=0))))
        return np.concatenate(found) if found else np.zeros(0)

    def set_ranges(self, leaf: int, at: int, least: float, greatest: float) -> None:
        """Widen the ranges of the path of a leaf by entry ``at`` of ``ranges_of``."""
        for node, child in self.paths[leaf]:
            here = self.nodes[node]
            m = len(here.points)
            if at < m:
                here.least[child, at] = min(here.least[child, at], least)
            elif at < 2 * m:
                here.greatest[child, at - m] = max(here.greatest[child, at - m], greatest)
            at -= 2 * m
            if at < 0:
                return

    def reached(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, queries) that the ranges do not rule out for scores in any window lo..hi (queries x windows)."""
        if not self.nodes:
            yield 0, np.arange(len(x))
            return
        square = (x.astype(float) ** 2).sum(axis=1)[:, None] + float(self.longest)
        inner = np.sqrt(np.maximum(square - 2.0 * hi, 0.0))
        outer = np.where(lo <= -FAR, np.inf, np.sqrt(np.maximum(square - 2.0 * lo, 0.0)))
        wanted = (lo <= hi) & (square - 2.0 * lo >= -SLACK * square)
        slack = SLACK * np.sqrt(square) * 2
        # The lifted component of a query is zero.
        stack = [(0, np.arange(len(x)))]
        while stack:
            node, rows = stack.pop()
            here, d = self.nodes[node], self.distances(node, x[rows], np.zeros(len(rows)))
            far = (d[:, None, :] + outer[rows][:, :, None]) + slack[rows][:, :, None]
            near = np.maximum(d[:, None, :] - outer[rows][:, :, None], inner[rows][:, :, None] - d[:, None, :]) - slack[rows][:, :, None]
            for j, child in enumerate(here.children):
                meets = ((here.least[j] <= far) & (here.greatest[j] >= near)).all(axis=2) & wanted[rows]
                part = rows[meets.any(axis=1)]
                if len(part) and child < 0:
                    yield -1 - child, part
                elif len(part):
                    stack.append((child, part))


def fit(sample: np.ndarray, longest: int, width: int) -> Tree:
    """A tree over distinct rows; ranges are empty until measured."""
    tree = Tree(longest, width)

    def grow(rows: np.ndarray, path: list[tuple[int, int]]) -> int:
        if len(rows) <= LEAF_SAMPLE:
            tree.paths.append(path)
            return -len(tree.paths)
        # Of some candidates, those far from each other.
        tried, chosen = sample[rows[:3 * SPLITS]].astype(float), [0]
        far = ((tried - tried[0]) ** 2).sum(axis=1)
        while len(chosen) < SPLITS:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, ((tried - tried[chosen[-1]]) ** 2).sum(axis=1))
        points = sample[rows[chosen]]
        at, m = len(tree.nodes), len(points)
        tree.nodes.append(Node(points, tree.lift(points), least=np.full((m, m), np.inf), greatest=np.full((m, m), -np.inf)))
        side = tree.distances(at, sample[rows], tree.lift(sample[rows])).argmin(axis=1)
        for j in range(m):
            tree.nodes[at].children.append(grow(rows[side == j], [*path, (at, j)]))
        return at

    grow(np.arange(len(sample)), [])
    return tree


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows; by doubles only where these hold every sum exactly."""
    if not a.size or not b.size or float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0 ** 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


def best(scores: np.ndarray, good: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``most`` greatest good scores of each row, ties by smaller id."""
    rows, columns = np.nonzero(good)
    order = np.lexsort((ids[columns], -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    first = np.searchsorted(rows, rows)
    kept = np.arange(len(rows)) - first < most
    return rows[kept], columns[kept]


def _placed(tree: Tree, parts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.leaves_of(matrix(batch.column("v"), tree.width))
            spread = mix(batch.column("vec_id").to_numpy().astype(np.uint64)) % parts[leaf].astype(np.uint64)
            yield pa.record_batch([pa.array(leaf, pa.int32()), pa.array(spread.astype(np.int32)), *batch.columns],
                                  ["leaf", "part", *batch.schema.names])
    return run


_BLOCKS = "leaf int, block long, ids array<long>, labels array<int>, flat array<int>, ranges array<double>"


def _packed(tree: Tree):
    """Sorted rows to blocks of at most ``BLOCK``; rows that repeat the one before are left out."""
    def row(key: tuple[int, int], piece: int, ids, labels, x) -> pa.RecordBatch:
        one = [pa.array([key[0]], pa.int32()), pa.array([key[1] << 32 | piece], pa.int64()), pa.array([ids.tolist()], pa.list_(pa.int64())),
               pa.array([labels.tolist()], pa.list_(pa.int32())), pa.ListArray.from_arrays(pa.array([0, x.size], pa.int32()), pa.array(x.ravel(), pa.int32())),
               pa.array([tree.ranges_of(key[0], x).tolist()], pa.list_(pa.float64()))]
        return pa.record_batch(one, ["leaf", "block", "ids", "labels", "flat", "ranges"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, piece, last = None, 0, None
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, tree.width), np.int64))
        for batch in batches:
            leaf, part, ids, labels = (batch.column(c).to_numpy() for c in ("leaf", "part", "vec_id", "label"))
            x = matrix(batch.column("v"), tree.width)
            cuts = [0, *(np.flatnonzero((leaf[1:] != leaf[:-1]) | (part[1:] != part[:-1])) + 1).tolist(), len(leaf)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if key != (int(leaf[lo]), int(part[lo])):
                    if len(held[0]):
                        yield row(key, piece, *held)
                    key, piece, last, held = (int(leaf[lo]), int(part[lo])), 0, None, tuple(h[:0] for h in held)
                new = np.ones(hi - lo, bool)
                new[1:] = (ids[lo + 1:hi] != ids[lo:hi - 1]) | (labels[lo + 1:hi] != labels[lo:hi - 1]) | (x[lo + 1:hi] != x[lo:hi - 1]).any(axis=1)
                new[0] = last is None or last[:2] != (ids[lo], labels[lo]) or (last[2] != x[lo]).any()
                last = (ids[hi - 1], labels[hi - 1], x[hi - 1])
                held = tuple(np.concatenate((h, c[lo:hi][new])) for h, c in zip(held, (ids, labels, x)))
                while len(held[0]) >= BLOCK:
                    yield row(key, piece, *(h[:BLOCK] for h in held))
                    piece, held = piece + 1, tuple(h[BLOCK:] for h in held)
        if len(held[0]):
            yield row(key, piece, *held)
    return run


_QUERY = "anchor_id long, anchor long, label int, v array<int>, lo array<long>, hi array<long>"


def _good(same: bool, labels: np.ndarray, ids: np.ndarray, q_labels: np.ndarray, q_ids: np.ndarray) -> np.ndarray:
    if same:
        return (labels[None] == q_labels[:, None]) & (ids[None] != q_ids[:, None])
    return labels[None] != q_labels[:, None]


def _query(rows: pa.RecordBatch, width: int):
    windows = max((len(x) for x in rows.column("lo").to_pylist()), default=0)
    lo, hi = matrix(rows.column("lo"), windows), matrix(rows.column("hi"), windows)
    size = rows.column("lo").value_lengths().to_numpy(zero_copy_only=False)
    hi[np.arange(windows) >= size[:, None]] = -FAR  # no such window
    return rows.column("anchor_id").to_numpy(), rows.column("label").to_numpy(), matrix(rows.column("v"), width), lo, hi


def _reaching(tree: Tree, sample: tuple, same: bool, most: int):
    """Each query to the leaves it must visit, its windows cut where the sample already fills them."""
    s_ids, s_labels, s_x = sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERIES):
                rows = batch.slice(at, QUERIES)
                ids, labels, x, lo, hi = _query(rows, tree.width)
                scores, good = products(x, s_x), _good(same, s_labels, s_ids, labels, ids)
                for w in range(lo.shape[1]):
                    q, found = best(scores, good & (scores >= lo[:, w, None]) & (scores <= hi[:, w, None]), s_ids, most)
                    full = np.flatnonzero(np.bincount(q, minlength=len(x)) == most)
                    # The last of the best ones is where the window may begin.
                    lo[full, w] = scores[full, found[np.searchsorted(q, full, "right") - 1]]
                size = rows.column("lo").value_lengths().to_numpy(zero_copy_only=False)
                narrowed = pa.array([r[:n] for r, n in zip(lo.tolist(), size.tolist())], pa.list_(pa.int64()))
                for leaf, part in tree.reached(x, lo, hi):
                    asked, take = pa.array(np.full(len(part), leaf), pa.int32()), pa.array(part)
                    yield pa.record_batch([asked, *(rows.column(c).take(take) for c in ("anchor_id", "anchor", "label", "v")),
                                           narrowed.take(take), rows.column("hi").take(take)],
                                          ["leaf", "anchor_id", "anchor", "label", "v", "lo", "hi"])
    return run


_FOUND = "anchor_id long, anchor long, window int, vec_id long, score long"


def _searched(width: int, same: bool, most: int):
    """Blocks, each followed by the queries that visit it, to the best rows per query and window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            is_block = np.flatnonzero(batch.column("ids").is_valid().to_numpy(zero_copy_only=False)).tolist()
            for lo, hi in zip([-1, *is_block], [*is_block, batch.num_rows]):
                if lo >= 0:
                    ids, labels = (batch.column(c)[lo].values.to_numpy() for c in ("ids", "labels"))
                    block = ids, labels, batch.column("flat")[lo].values.to_numpy().astype(np.int64).reshape(len(ids), width)
                for at in range(lo + 1, hi, QUERIES):
                    yield from answers(block, batch.slice(at, min(QUERIES, hi - at)))

    def answers(block, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, labels, x = block
        q_ids, q_labels, q_x, lo, hi = _query(rows, width)
        scores, good = products(q_x, x), _good(same, labels, ids, q_labels, q_ids)
        for w in range(lo.shape[1]):
            q, c = best(scores, good & (scores >= lo[:, w, None]) & (scores <= hi[:, w, None]), ids, most)
            if len(q):
                yield pa.record_batch([rows.column("anchor_id").take(pa.array(q)), rows.column("anchor").take(pa.array(q)),
                                       pa.array(np.full(len(q), w), pa.int32()), pa.array(ids[c]), pa.array(scores[q, c])],
                                      ["anchor_id", "anchor", "window", "vec_id", "score"])
    return run


class Index:
    """Labelled whole vectors (vec_id, label, v) in the leaves of a tree."""

    def __init__(self, vectors: DataFrame):
        self.spark = vectors.sparkSession
        square = F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x.cast("long"))
        n, longest, self.width = vectors.agg(F.count("*"), F.max(square), F.max(F.size("v"))).first()
        self.width = max(self.width or 0, 1)
        least = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "label", "v").limit(SAMPLE).collect()
        rows = sorted({(r.vec_id, r.label, tuple(r.v)) for r in least}, key=lambda r: mix(np.array([r[0]], np.int64).view(np.uint64))[0])
        x = np.zeros((len(rows), self.width), np.int64)
        for i, (_, _, v) in enumerate(rows):
            x[i, :len(v)] = v
        self.sample = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), x
        _, first = np.unique(x, axis=0, return_index=True)
        self.tree = tree = fit(x[np.sort(first)], int(longest or 0), self.width)
        share = np.bincount(tree.leaves_of(x), minlength=len(tree.paths)) / max(len(x), 1)
        parts = np.ceil(np.maximum(share * n, 1) / PART).astype(np.int64)
        placed = vectors.mapInArrow(_placed(tree, parts), "leaf int, part int, vec_id long, label int, v array<int>")
        packed = (placed.repartition(self._partitions(), "leaf", "part").sortWithinPartitions("leaf", "part", "vec_id", "label", "v")
                  .mapInArrow(_packed(tree), _BLOCKS))
        self.blocks = written(packed, "blocks")
        # As many rows as the tree has leaves and split points on their paths.
        for r in (self.blocks.select("leaf", F.posexplode("ranges").alias("at", "d")).groupBy("leaf", "at")
                  .agg(F.min("d").alias("least"), F.max("d").alias("greatest")).collect()):
            tree.set_ranges(r.leaf, r.at, r.least, r.greatest)

    def _partitions(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def search(self, queries: DataFrame, same: bool, most: int) -> DataFrame:
        """The ``most`` best rows of each query's windows: (anchor_id, anchor, window, vec_id, score, place).

        ``queries``: (anchor_id, anchor, label, v, lo, hi), windows as parallel arrays of
        least and greatest scores; ``same``: rows of the query's label but not its id,
        else rows of other labels.  Higher scores come first, then smaller ids.
        """
        visits = queries.mapInArrow(_reaching(self.tree, self.sample, same, most), f"leaf int, {_QUERY}")
        asked = visits.join(self.blocks.select("leaf", "block"), "leaf")
        both = self.blocks.drop("ranges").unionByName(asked, allowMissingColumns=True)
        found = (both.repartition(self._partitions(), "leaf", "block").sortWithinPartitions("leaf", "block", F.col("ids").isNull())
                 .mapInArrow(_searched(self.width, same, most), _FOUND))
        order = Window.partitionBy("anchor_id", "anchor", "window").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)


def mined(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
          scale: int = 256, label: Column | None = None) -> DataFrame:
    """Hard negatives of every anchor and positive; anchors have a vec_id divisible by ``every``.

    ``rows``: (vec_id, embedding, label); a component x counts as floor(scale * x), scores
    are whole inner products, and ``label`` may replace the label.  The positives of an
    anchor are its ``positives`` best other rows of its label; the negatives of both are
    the ``negatives`` best rows of other labels with a score from ``least`` to ``most``
    hundredths of the positive's.  Returns anchor_id, positive_id, rank (from 1),
    negative_id, positive_score, negative_score.

    A null vec_id names no row and takes no part, nor does a null label, a null vector or
    one with a null, non-finite or huge component (2^24 or more once scaled).  Equal rows
    count once; different rows of one vec_id are rows each, and "other rows" are those of
    another vec_id.  A shorter vector is filled up with zeros.  Positives with a score
    below zero have no negatives.  Further columns are ignored; an empty table gives an
    empty result.
    """
    given = rows.filter("vec_id is not null").withColumn("label", (F.col("label") if label is None else label).cast("int"))
    vectors = written(whole_vectors(given.filter("label is not null"), scale, columns=("label",)).select("vec_id", "label", "v"), "vectors")
    index = Index(vectors)
    anchors = (vectors.filter(F.col("vec_id") % every == 0).distinct()
               .select(F.col("vec_id").alias("anchor_id"), F.xxhash64("label", "v").alias("anchor"), "label", "v"))
    everything = anchors.withColumns({"lo": F.array(F.lit(-FAR)), "hi": F.array(F.lit(FAR))})
    found = index.search(everything, True, positives).select(
        "anchor_id", "anchor", F.col("place").alias("positive"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = written(found, "positives")
    up = F.expr(f"-((-{least}L * positive_score - pmod(-{least}L * positive_score, 100L)) div 100L)")
    down = F.expr(f"({most}L * positive_score - pmod({most}L * positive_score, 100L)) div 100L")
    # At most ``positives`` windows of an anchor, in their order.
    windows = found.groupBy("anchor_id", "anchor").agg(F.array_sort(F.collect_list(F.struct("positive", up.alias("lo"), down.alias("hi")))).alias("w"))
    narrow = anchors.join(windows, ["anchor_id", "anchor"]).select("anchor_id", "anchor", "label", "v", F.col("w.lo").alias("lo"), F.col("w.hi").alias("hi"))
    hard = index.search(narrow, False, negatives).withColumn("positive", F.col("window") + 1)
    return hard.join(found, ["anchor_id", "anchor", "positive"]).select(
        "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
