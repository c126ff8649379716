"""Hard negatives, centroids and the Jaccard join against plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from headway.llm import centroids, hard_negatives, jaccard_join
from headway.llm.whole_vectors import LIMIT, whole_vectors

VECTORS = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def vectors(seed, n, width=8, copies=0, labels=4):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    rows = [(i, [float(np.float32(m + rng.gauss(0, 0.4))) for m in rng.choice(middle)], rng.randrange(labels)) for i in range(n)]
    return rows + [(n + i, rows[3][1], rows[3][2] if i % 2 else rng.randrange(labels)) for i in range(copies)]


def odd_vectors(width=8):
    """Null and unusable rows, repeated rows, one id with two vectors, huge components."""
    one = [0.5] * width
    return [(None, one, 1), (5000, None, 1), (5001, one, None), (5002, [None, *one[1:]], 1), (5003, [NAN, *one[1:]], 1),
            (5004, [INF, *one[1:]], 1), (5005, [-INF, *one[1:]], 1), (5006, [1e30, *one[1:]], 1), (5100, one, 1), (5100, one, 1),
            (5200, one, 2), (5200, [-0.25] * width, 2), (5300, [0.0] * width, 1), (5301, one[:3], 1), (5302, [], 0)]


def whole(embedding, scale):
    if embedding is None or any(x is None or not math.isfinite(x) or abs(x) * scale >= LIMIT for x in embedding):
        return None
    return [math.floor(scale * x) for x in embedding]


def clashing(df):
    names = "v w leaf part block lo hi anchor window cluster distance far node n rank shard place ids h".split()
    return df.withColumns({x: F.lit("clash") for x in names})


def plain_negatives(rows):
    width = max((len(e) for _, e, _ in rows if e is not None), default=0)
    kept = {(i, lab, tuple(w + [0] * (width - len(w)))) for i, e, lab in rows
            if i is not None and lab is not None and (w := whole(e, 256)) is not None}
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = set()
    for a in kept:
        if a[0] % 100:
            continue
        others = sorted((-score(a[2], b[2]), b[0], b[1]) for b in kept if b[0] != a[0] and b[1] == a[1])[:5]
        for s, positive, _ in others:
            near = sorted((-score(a[2], b[2]), b[0]) for b in kept if b[1] != a[1])
            good = [(t, i) for t, i in near if -30 * s <= -100 * t <= -90 * s][:10]
            out |= {(a[0], positive, rank, i, -s, -t) for rank, (t, i) in enumerate(good, 1)}
    return out


@pytest.mark.parametrize("sizes", [None, (64, 8, 32, 4)])
def test_hard_negatives_against_brute_force(spark, monkeypatch, sizes):
    if sizes:  # a deep tree over a small sample, small blocks and parts
        for name, value in zip(("SAMPLE", "LEAF_SAMPLE", "PART", "BLOCK"), sizes):
            monkeypatch.setattr(hard_negatives, name, value)
        monkeypatch.setattr(hard_negatives, "SPLITS", 2)
    rows = vectors(1, 420, copies=150) + odd_vectors()
    got = hard_negatives.mined(clashing(spark.createDataFrame(rows, VECTORS)))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == plain_negatives(rows)
    empty = spark.createDataFrame([], VECTORS)
    assert hard_negatives.mined(empty).count() == 0
    assert hard_negatives.mined(spark.createDataFrame([(100, [1.0], 1)], VECTORS)).count() == 0


def test_the_tree_leaves_out_and_loses_nothing():
    rng = np.random.default_rng(2)
    middle = rng.integers(-300, 300, (40, 16))
    x = (middle[rng.integers(0, 40, 6000)] + rng.integers(-15, 15, (6000, 16))).astype(np.int64)
    tree = hard_negatives.fit(np.unique(x[:2000], axis=0), int((x ** 2).sum(axis=1).max()), 16)
    leaf = tree.leaves_of(x)
    for of in np.unique(leaf).tolist():
        ranges = tree.ranges_of(of, x[leaf == of])
        for at, d in enumerate(ranges.tolist()):
            tree.set_ranges(of, at, d, d)
    q = x[::100]
    scores = hard_negatives.products(q, x)
    top = np.sort(scores, axis=1)[:, -20]
    # Windows: the best scores, a narrow middle, an empty one.
    lo = np.stack([top, scores.max(axis=1) // 2, top], axis=1)
    hi = np.stack([np.full(len(q), hard_negatives.FAR), scores.max(axis=1) // 2 + 50, top - 1], axis=1)
    for w in range(3):
        visits = {(i, of) for of, part in tree.reached(q, lo[:, w:w + 1], hi[:, w:w + 1]) for i in part.tolist()}
        inside = (scores >= lo[:, w, None]) & (scores <= hi[:, w, None])
        assert {(i, int(leaf[j])) for i, j in zip(*np.nonzero(inside))} <= visits
        share = len(visits) / (len(q) * len(tree.paths))
        assert share < (0.5 if w == 0 else 1 if w == 1 else 1e-9)


def test_products_stay_exact():
    big = np.array([[(1 << 24) - 1] * 8, [-(1 << 24) + 1] * 8], np.int64)
    assert hard_negatives.products(big, big).tolist() == [[8 * ((1 << 24) - 1) ** 2, -8 * ((1 << 24) - 1) ** 2]] * 1 + [
        [-8 * ((1 << 24) - 1) ** 2, 8 * ((1 << 24) - 1) ** 2]]


def plain_clusters(rows, k, rounds, width):
    kept = [(i, w) for i, e, _ in rows if e is not None and len(e) == width and (w := whole(e, 64)) is not None]
    name = lambda i: (i is None, "" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest())
    middle = [w for _, w in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def assign():
        far = [[sum((x - y) ** 2 for x, y in zip(w, c)) for c in middle] for _, w in kept]
        return [(min(d), d.index(min(d))) for d in far]

    for _ in range(rounds):
        at = assign()
        for c in range(len(middle)):
            own = [w for (_, w), (_, a) in zip(kept, at) if a == c]
            if own:
                middle[c] = [sum(x) // len(own) for x in zip(*own)]
    at = assign()
    sums = [sum(d for d, a in at if a == c) for c in range(len(middle))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted(((i, a, d, sums[a], sum(sums), sha[a]) for (i, _), (d, a) in zip(kept, at)), key=str)


@pytest.mark.parametrize("rows, k", [(vectors(3, 500, copies=120) + odd_vectors(), 16), (vectors(4, 9), 16), (odd_vectors(), 3)])
def test_clusters_against_plain_python(spark, rows, k):
    got = centroids.clustered(clashing(spark.createDataFrame(rows, VECTORS)), clusters=k, dimensions=8)
    assert sorted((tuple(r) for r in got.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=str) == plain_clusters(rows, k, 3, 8)


def test_clusters_of_no_vectors(spark):
    assert centroids.clustered(spark.createDataFrame([], VECTORS)).count() == 0
    assert centroids.clustered(spark.createDataFrame(odd_vectors(), VECTORS)).count() == 0  # none has 64 components


def test_ptolemaic_bounds_hold_and_prune():
    rng = np.random.default_rng(5)
    middle = rng.integers(-3000, 3000, (16, 12))
    x = (middle[rng.integers(0, 16, 3000)] + rng.integers(-40, 40, (3000, 12))).astype(np.int64)
    pivots = centroids.choose_pivots(x[:500])
    assert len(np.unique(pivots, axis=0)) == len(pivots) == centroids.PIVOTS
    far = centroids.squared(x, pivots)
    bounds = centroids.ptolemaic_bounds(np.sqrt(far), np.sqrt(centroids.squared(middle, pivots)), np.sqrt(centroids.squared(pivots, pivots)))
    exact = centroids.squared(x, middle)
    assert (bounds <= exact).all()
    which, best, checked = centroids.nearest(x, far, middle, pivots)
    assert (which == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
    assert checked < 0.3 * exact.size
    # A vector on a pivot, and equal pivots only: bounds of zero, all checked.
    same = np.repeat(x[:1], 5, axis=0)
    assert len(centroids.choose_pivots(same)) == 1
    assert centroids.nearest(x, centroids.squared(x, same[:1]), middle, same[:1])[2] == exact.size


def test_whole_vectors(spark):
    rows = [(i, e, 0) for i, (_, e, _) in enumerate(odd_vectors())] + [(99, [-0.001, 0.999, 1.0], 0)]
    got = {r.vec_id: list(r.v) for r in whole_vectors(spark.createDataFrame(rows, VECTORS), 64).collect()}
    assert got == {i: w for i, e, _ in rows if (w := whole(e, 64)) is not None}


def sets_of(rows):
    def shingles(text):
        w = brute.words((text or "").translate(brute.LOWER))
        return frozenset(" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset()
    return [shingles(t) for _, t in rows]


def plain_join(rows, similarity):
    each = sets_of(rows)
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(each):
        for j in range(i):
            b = each[j]
            if a and b and 100 * len(a & b) >= similarity * len(a | b):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(least.get(top(i), doc), doc)
    return sorted(((doc, len(s), least.get(top(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, each))), key=str)


def edited(rng, words, times):
    out = list(words)
    for _ in range(times):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(out)


def corpus(seed, n=90):
    """Copies edited by and by, chains, hubs, common passages, and sizes at the bound."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(30)]
    rows, groups = [], [[word() for _ in range(rng.choice((12, 40, 150)))] for _ in range(8)]
    for _ in range(n):
        base = rng.choice(groups)
        text = edited(rng, base, rng.randrange(max(2, len(base) // 20)))
        rows.append(text if rng.random() < 0.7 else " ".join([*passage, *(word() for _ in range(rng.choice((3, 10, 60))))]))
    hub = [word() for _ in range(200)]
    rows += [" ".join(hub)] + [edited(rng, hub, 4) for _ in range(25)]
    chain = [word() for _ in range(60)]
    for _ in range(12):
        chain[rng.randrange(60)] = word()
        rows.append(" ".join(chain))
    rows += [rows[0], rows[0].upper(), "a b c", "A  B\tc", "a b", "a", "", None, " \t\n", "é é é é é", " ".join(["tick tock"] * 300)]
    rows += [" ".join(f"k{i}" for i in range(lo, lo + 103)) for lo in (0, 7, 8, 9, 16)]
    order = list(range(len(rows)))
    rng.shuffle(order)
    out = [(order[i], t) for i, t in enumerate(rows)]
    return out + [(None, rows[2]), (None, "nothing like it in any other text here"), (out[5][0], "another text of an id that is there"), out[4], out[4]]


@pytest.mark.parametrize("block", [None, 5])
@pytest.mark.parametrize("seed", [1, 2])
def test_join_against_brute_force(spark, monkeypatch, block, seed):
    if block:
        monkeypatch.setattr(jaccard_join, "BLOCK_SETS", block)
        monkeypatch.setattr(jaccard_join, "HEADS", 1)
    rows = corpus(seed)
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = jaccard_join.joined(df.withColumns({c: F.lit(0) for c in ("body", "prefix", "shingle", "sets", "u", "alone")}))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_join(rows, 85)


def test_join_of_odd_tables(spark, odd, empty):
    assert jaccard_join.joined(empty).count() == 0
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in jaccard_join.joined(odd).collect()), key=str) == plain_join(rows, 85)


def test_divide_skip_against_counting():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2 ** 63, 400, dtype=np.int64)
    sets = []
    for i in range(150):
        keep = base[rng.random(400) < (0.95 if i % 3 else 0.5)]
        sets.append(np.unique(np.concatenate((keep, rng.integers(0, 2 ** 63, rng.integers(0, 40), dtype=np.int64)))))
    lists = jaccard_join.InvertedLists(np.array([len(s) for s in sets]), np.concatenate(sets))
    wanted = np.ones(len(sets), bool)
    wanted[::7] = False
    pairs = 0
    for similarity in (50, 85, 100):
        for i, a in enumerate(sets):
            want = [j for j, b in enumerate(sets) if wanted[j]
                    and 100 * len(np.intersect1d(a, b)) >= similarity * len(np.union1d(a, b))]
            assert sorted(lists.search(i, similarity, wanted).tolist()) == want
            pairs += len(want)
    assert pairs > 1000
