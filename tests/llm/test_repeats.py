import numpy as np
import pytest

import brute
from headway.llm import lempel_ziv, simhash, suffixes
from headway.llm.vectors import leftmost_minima, range_hashes, window_hashes


def texts(frame):
    return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}


@pytest.mark.parametrize("table, window", [("odd", 10), ("small", 35)])
def test_word_repeats_against_brute_force(request, table, window):
    frame = request.getfixturevalue(table)
    got = lempel_ziv.without_repeats(frame, window=window).collect()
    want = brute.without_repeats(texts(frame), window)
    assert len(got) == frame.count()
    assert {r.doc_id: (r.n_words, r.n_removed, r.text) for r in got} == want


@pytest.mark.parametrize("largest", [8192, 1])
@pytest.mark.parametrize("table", ["odd", "small"])
def test_byte_repeats_against_brute_force(request, table, largest):
    frame = request.getfixturevalue(table)
    got = suffixes.without_later_repeats(frame, window=100, largest=largest).collect()
    want = brute.without_later_repeats(texts(frame), 100)
    assert len(got) == frame.count()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == want


def test_repeat_groups_hold_all_occurrences(spark):
    same = "".join(chr(97 + i * i * i // 7 % 26) for i in range(150))
    frame = spark.createDataFrame([(i, f"{i}a{same}{i * 7}b") for i in range(5)], "doc_id long, text string")
    found = suffixes.repeats(frame, 100).collect()
    assert {r.doc_id for r in found} == {0, 1, 2, 3, 4}
    groups = {}
    for r in found:
        groups.setdefault((r.repeat, r.length), set()).add((r.doc_id, r.earliest))
    assert {(0, True), (1, False), (2, False), (3, False), (4, False)} in groups.values()
    assert all(min(g) in {x for x in g if x[1]} and sum(e for _, e in g) == 1 for g in groups.values())


@pytest.mark.parametrize("table", ["odd", "small"])
def test_fingerprints_and_components(request, table):
    frame = request.getfixturevalue(table)
    prints = {d: brute.fingerprint(t, 3) for d, t in texts(frame).items()}
    ids = [d for d in prints if d is not None]
    root = brute.least_linked(ids, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    got = simhash.near_duplicates(frame, shingle=3, distance=2, shard_points=16).collect()
    assert len(got) == frame.count()
    assert {r.doc_id: r.fingerprint for r in got} == {d: f"{p:016x}" for d, p in prints.items()}
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == root


def test_tree_finds_exactly_the_close_pairs():
    rng = np.random.default_rng(7)
    points = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    points[1500:] = points[:1500] ^ (np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64))
    want = {(i, j) for i in range(3000) for j in np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 2).tolist()}
    got = {(int(a), int(b)) for x, y in simhash.pairs_within(points, points, 2) for a, b in zip(x, y)}
    assert got == want


def kept_by_brute_force(rows, shingle, distance):
    """Row numbers: of each component the row of the least id, a null one last."""
    prints = [brute.fingerprint(t, shingle) for _, t in rows]
    root = brute.least_linked(set(prints), lambda a, b: (a ^ b).bit_count() <= distance)
    best = {}
    for i, (doc, _) in enumerate(rows):
        order = (doc is None, doc or 0)
        if root[prints[i]] not in best or order < best[root[prints[i]]][0]:
            best[root[prints[i]]] = (order, i)
    return sorted(i for _, i in best.values())


def test_one_of_each_against_brute_force(spark, small, odd):
    for frame in (small, odd):
        rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
        kept = simhash.one_of_each(frame, shingle=3, distance=2)
        assert kept.columns == frame.columns
        want = [rows[i] for i in kept_by_brute_force(rows, 3, 2)]
        assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)


def test_one_of_each_goes_by_rows(spark):
    from conftest import prose

    t, u = prose(1, 60), prose(2, 60)
    rows = [(1, t, "a"), (1, u, "a"), (2, u, "b"), (3, t, "c"), (None, prose(3, 60), "d"), (None, t, "e"), (4, "x y", "f"), (4, "x y", "f")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, row string"), shingle=3)
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted([rows[0], rows[1], rows[4], rows[6]], key=str)


def test_empty_tables(empty):
    assert lempel_ziv.without_repeats(empty, 10).count() == 0
    assert suffixes.without_later_repeats(empty, 100).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.one_of_each(empty).count() == 0


def test_vector_primitives():
    h = np.arange(50, dtype=np.uint64) % np.uint64(7)
    windows = window_hashes(h, 13)
    assert all((windows[i] == windows[j]) == (h[i:i + 13].tolist() == h[j:j + 13].tolist())
               for i in range(len(windows)) for j in range(len(windows)))
    at = leftmost_minima(h, 5)
    assert at.tolist() == [i + int(np.argmin(h[i:i + 5])) for i in range(46)]
    a = range_hashes(h, np.array([0, 7, 1]), np.array([9, 9, 9]))
    assert a[0] == a[1] != a[2]


def test_maximal_repeats_of_a_suffix_array():
    raw = np.frombuffer(b"xabcdyabcdzabce", np.uint8)
    at = np.arange(len(raw))
    order, common = suffixes.suffix_array(raw, at, np.full(len(raw), len(raw)))
    assert [bytes(raw[i:]) for i in order] == sorted(bytes(raw[i:]) for i in range(len(raw)))
    before = np.where(order > 0, raw[order - 1].astype(np.int64), -1)
    found = {(length, tuple(sorted(order[a:b + 1].tolist()))) for length, a, b in suffixes.maximal_repeats(common, before, 3)}
    assert found == {(4, (1, 6)), (3, (1, 6, 11))}
