"""Language-model scoring with a hashed maximum-entropy model.

The probability of a token is that of its class, given the tokens before it, times
its own within the class, given the same tokens.  Classes are hashes of word endings.
Both factors are log-linear models over hashed context features (last token, last two,
and the one before the last, skipping); their weights are moved by gradients that all
tasks sum over the whole training part.  The first is one softmax over all classes.
The second splits a class in two, again and again, down to its words; each split is a
softmax over features of a context and the split, so that the words of a class sum to
one in every context.  At zero weights it gives add-one counts.
"""

from __future__ import annotations

import collections
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from headway.llm.frames import written
from headway.llm.vectors import join_hash, lanes, mix, slices, word_hashes, words

#: Classes; the last one is the end token's own.
CLASSES = 32
#: Buckets of each kind of context feature.
BUCKETS = 4096
KINDS = 3
#: Gradient rounds over the training part, after the closed first step from zero weights.
ROUNDS = 2
RATE = 0.5
#: Weight of the class prior against a context's counts.
PRIOR = 20.0
#: Words whose counts every task holds; the others' counts are joined.
FREQUENT = 1 << 17
CHUNK = 1 << 14
#: Bytes of text whose words are cut and hashed at once.
CACHED = 1 << 18
#: Distinct contexts that a task gathers before it works them off.
GATHERED = 1 << 20
#: Hash groups that the other words of a class form; each is a leaf of its tree.
GROUPS = 1 << 10
#: Bits of the number of cells that each class has for each kind of feature of a context and a split.
CELL_BITS = 12
CELLS = CLASSES << CELL_BITS
#: Inverse variance of a split's weights.
SPLIT_PRIOR = 20.0

#: The low bits of a token are its class.
_CLASS = np.uint64(CLASSES - 1)
END = mix(np.array([0x0E4D], np.uint64))[0] | _CLASS
_G = tuple(f"g{k}" for k in range(CLASSES))
_SLOT = np.uint64(44)
_SPREAD = np.uint32(0x9E3779B1)


def held_out(doc_id) -> bool:
    """Whether a document is kept from training; a null id never is."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and class of every token, and the first token of each text; each text ends with an end token."""
    at, parts = 0, [(np.empty(0, np.uint64), np.zeros(1, np.int64))]
    while at < len(offsets) - 1:  # some texts at a time, which the processor's cache can hold
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CACHED, "right")) - 1)
        parts.append(_tokens(raw[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]))
        at = to
    token = np.concatenate([t for t, _ in parts])
    before = np.cumsum([0, *(len(t) for t, _ in parts)])
    return token, (token & _CLASS).astype(np.int64), np.concatenate([parts[0][1], *(f[1:] + n for (_, f), n in zip(parts[1:], before[1:], strict=False))])


def _tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = raw + (((raw - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5))
    starts, ends, first = words(low, offsets)
    n, texts = len(starts), len(offsets) - 1
    size = ends - starts
    # The last four bytes, shorter words as a whole.
    tail = lanes(low)[np.maximum(ends - 4, starts)] & (
        (np.uint64(1) << (np.minimum(size, 4) * 8).astype(np.uint64)) - np.uint64(1))
    at = np.arange(n) + np.repeat(np.arange(texts), np.diff(first))
    token = np.full(n + texts, END)
    token[at] = word_hashes(low, starts, ends) & ~_CLASS | mix(tail) % np.uint64(CLASSES - 1)
    return token, first + np.arange(texts + 1)


def before(token: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A hash of what is before each token, one array per kind of feature."""
    back = []
    for k in (1, 2):
        last = np.zeros(len(token), np.uint64)
        last[k:] = token[:-k]
        for j in range(k):  # nothing is before a text
            at = first[:-1] + j
            last[at[at < first[1:]]] = np.uint64(j + 1)
        back.append(last)
    return mix(back[0]), join_hash(back[0], back[1]), mix(back[1] + np.uint64(7))


def _buckets(context: tuple[np.ndarray, ...]) -> np.ndarray:
    mask = np.uint64(BUCKETS - 1)
    return np.stack([(x & mask).astype(np.int32) + np.int32(BUCKETS * k) for k, x in enumerate(context)])


def features(token: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Numbers of the active features of each token's class, one row per kind."""
    return _buckets(before(token, first))


def groups(token: np.ndarray) -> np.ndarray:
    """The number of each token's group, class by class."""
    return ((token & _CLASS) * np.uint64(GROUPS) + (token >> np.uint64(8)) % np.uint64(GROUPS)).astype(np.int64)


class Tree:
    """The splits of every class: a Huffman code of its frequent words, its groups of other words, and the unknown.

    ``word`` and ``n``: the frequent words and their counts; ``mass``: counts and add-one of the
    other words, by class and group; an unknown word has mass one in its class.  Leaves are
    the words in ascending order, the groups, the unknowns; a group without words is none.
    """

    def __init__(self, word: np.ndarray, n: np.ndarray, mass: np.ndarray):
        order = np.argsort(word)
        self.word, self.log_count = word[order], np.log10(n[order] + 1.0)
        of_leaf = np.concatenate((n[order] + 1.0, mass.ravel(), np.ones(CLASSES)))
        kind = np.concatenate(((self.word & _CLASS).astype(np.int64), np.repeat(np.arange(CLASSES), GROUPS), np.arange(CLASSES)))
        self.log_mass = np.log10(np.maximum(mass.ravel(), 1.0))
        # Words begin at a slot by their high bits; a last one is larger than all tokens.
        self.slot = np.searchsorted(self.word >> _SLOT, np.arange(1 << 20, dtype=np.uint64)).astype(np.int32)
        self.ascending = np.append(self.word, ~np.uint64(0))
        up, side, sizes = self._codes(of_leaf, kind)
        # From every leaf up to the root of its class, all leaves at a time.
        leaf, at, steps = np.arange(len(of_leaf)), np.arange(len(of_leaf)), []
        while len(leaf):
            inside = up[at] >= 0
            leaf, at = leaf[inside], at[inside]
            steps.append((leaf, up[at], side[at]))
            at = up[at]
        leaf, node, taken = (np.concatenate(x) for x in zip(*steps, strict=True))
        self.size = np.bincount(leaf, minlength=len(of_leaf))
        self.begin = np.cumsum(self.size) - self.size
        # Leaves by class, those with long paths first.
        self.place = (kind * 64 + 63 - self.size).astype(np.uint16)
        order = np.argsort(leaf, kind="stable")
        # The splits above every leaf: an even key with the side taken as its last bit, and the log odds of the second side.
        key = (mix(node[order].astype(np.uint64)) >> np.uint64(32)).astype(np.uint32) & ~np.uint32(1) | taken[order].astype(np.uint32)
        bias = np.log(sizes[node[order], 1] / sizes[node[order], 0]).astype(np.float32)
        self.path = np.stack((key, bias.view(np.uint32)), axis=1).view(np.uint64)[:, 0]

    @staticmethod
    def _codes(mass: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(parent, side) of every leaf and split, and the masses of both sides of every split."""
        most = 2 * len(mass)
        up, side, sizes, free = np.full(most, -1), np.zeros(most, np.int8), np.ones((most, 2)), len(mass)
        order = np.lexsort((mass, kind))
        order = order[mass[order] > 0]
        ends = np.searchsorted(kind[order], np.arange(CLASSES + 1))
        for lo, hi in zip(ends[:-1], ends[1:], strict=True):
            leaves, at, made = [*zip(mass[order[lo:hi]].tolist(), order[lo:hi].tolist(), strict=True)], 0, collections.deque()
            for _ in range(len(leaves) - 1):
                pair = []
                for _ in range(2):
                    if at < len(leaves) and (not made or leaves[at][0] <= made[0][0]):
                        pair.append(leaves[at])
                        at += 1
                    else:
                        pair.append(made.popleft())
                for k, (m, x) in enumerate(pair):
                    up[x], side[x], sizes[free, k] = free, k, m
                made.append((pair[0][0] + pair[1][0], free))
                free += 1
        return up, side, sizes

    def find(self, token: np.ndarray) -> np.ndarray:
        """The place of each token among the frequent words, or -1."""
        at = self.slot.take((token >> _SLOT).astype(np.int64))
        word = self.ascending.take(at)
        out, left = np.where(word == token, at, -1), np.flatnonzero(word < token)
        while len(left):
            at[left] += 1
            word = self.ascending[at[left]]
            out[left[word == token[left]]] = at[left[word == token[left]]]
            left = left[word < token[left]]
        return out

    def known(self, token: np.ndarray) -> np.ndarray:
        """The leaf of each token, which must be of the training part."""
        leaf = self.find(token)
        rare = np.flatnonzero(leaf < 0)
        leaf[rare] = len(self.word) + groups(token[rare])
        return leaf

    def unknown(self, kind: np.ndarray) -> np.ndarray:
        return len(self.word) + CLASSES * GROUPS + kind

    def splits(self, leaf: np.ndarray, context: tuple[np.ndarray, ...]):
        """The order of the leaves in which those with another split are next to each other, and an iterator over
        (where they begin and end in it, class, cell per kind, side, log odds), a class and a level at a time."""
        place = self.place.take(leaf)
        order = np.argsort(place, kind="stable")
        at = self.begin.take(leaf.take(order))
        part = [(x >> np.uint64(32)).astype(np.uint32).take(order) for x in context]
        ends = np.cumsum(np.bincount(place, minlength=CLASSES * 64)).reshape(CLASSES, 64)

        def levels():
            for kind in range(CLASSES):
                lo = ends[kind - 1, 63] if kind else 0
                for level in range(63):
                    hi = ends[kind, 62 - level]  # of the longer paths
                    if hi <= lo:
                        break
                    key, bias = self.path.take(at[lo:hi]).view(np.uint32).reshape(-1, 2).T
                    side = (key & np.uint32(1)).astype(np.float32)
                    key = key & ~np.uint32(1)
                    cells = []
                    for x in part:
                        cell = x[lo:hi] ^ key
                        cell *= _SPREAD
                        cell >>= np.uint32(32 - CELL_BITS)
                        cells.append(cell.astype(np.int64))
                    yield lo, hi, kind, cells, side, bias.view(np.float32)
                    at[lo:hi] += 1

        return order, levels()


def _sides(weights: np.ndarray | None, kind: int, cells: list[np.ndarray], bias: np.ndarray) -> np.ndarray:
    """Log odds of the second side of each split."""
    if weights is None:
        return bias.copy()
    z = weights[0, kind].take(cells[0], mode="clip")
    z += weights[1, kind].take(cells[1], mode="clip")
    z += weights[2, kind].take(cells[2], mode="clip")
    z += bias
    return z


def _within(tree: Tree, weights: np.ndarray, leaf: np.ndarray, context: tuple[np.ndarray, ...]) -> np.ndarray:
    """Natural log probability of each leaf within its class."""
    odds, out = np.ones(len(leaf)), np.empty(len(leaf))
    order, levels = tree.splits(leaf, context)
    for lo, hi, kind, cells, side, bias in levels:
        z = _sides(weights, kind, cells, bias)
        z *= 1 - 2 * side
        np.exp(z, out=z)
        z += 1
        odds[lo:hi] *= z
    out[order] = -np.log(odds)
    return out


def _missed(tree: Tree, weights: np.ndarray | None, token: np.ndarray, context: tuple[np.ndarray, ...], total: np.ndarray) -> None:
    """Add what is observed less what is expected of each cell to ``total[0]``; without weights also its variance to ``total[1]``."""
    for _, _, kind, cells, side, bias in tree.splits(tree.known(token), context)[1]:
        z = _sides(weights, kind, cells, bias)
        np.negative(z, out=z)
        np.exp(z, out=z)
        z += 1
        np.reciprocal(z, out=z)
        for sums, values in zip(total, (side - z, z * (1 - z)) if weights is None else (side - z,), strict=True):
            values = values.astype(np.float64)
            for k, cell in enumerate(cells):
                sums[k, kind] += np.bincount(cell, weights=values, minlength=1 << CELL_BITS)


def _training(rows: pa.RecordBatch) -> pa.RecordBatch:
    return rows.filter(pa.array([not held_out(d) for d in rows.column("doc_id").to_pylist()], pa.bool_()))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, raw, offsets in slices(_training(batch), "text"):
            token, _, _ = tokens(raw, offsets)
            own, n = np.unique(token, return_counts=True)
            yield pa.record_batch([pa.array(own.view(np.int64)), pa.array(n)], ["word", "n"])


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each class follows each feature."""
    total = np.zeros(KINDS * BUCKETS * CLASSES, np.int64)
    for batch in batches:
        for _, raw, offsets in slices(_training(batch), "text"):
            token, kind, first = tokens(raw, offsets)
            for f in features(token, first):
                total += np.bincount(f.astype(np.int64) * CLASSES + kind, minlength=len(total))
    yield _rows(total.reshape(-1, CLASSES).astype(np.float64))


def _rows(values: np.ndarray) -> pa.RecordBatch:
    seen = np.flatnonzero(values.any(axis=1))
    return pa.record_batch([pa.array(seen.astype(np.int32)), *(pa.array(values[seen, k]) for k in range(CLASSES))], ["feature", *_G])


def _logits(weights: np.ndarray, bias: np.ndarray, f: np.ndarray) -> np.ndarray:
    z = weights.take(f[0], axis=0)
    z += weights.take(f[1], axis=0)
    z += weights.take(f[2], axis=0)
    z += bias
    return z


def _keys(of: np.ndarray) -> np.ndarray:
    key = np.zeros(of.shape[1], np.int64)
    for k, row in enumerate(of):
        key = key * BUCKETS + (row - BUCKETS * k)
    return key


def contexts(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct sets of active features, one row per kind, and how often each occurs."""
    return _apart(*np.unique(_keys(of), return_counts=True))


def _apart(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.stack([key // BUCKETS ** (KINDS - 1 - k) % BUCKETS + BUCKETS * k for k in range(KINDS)]), n


def _merged(gathered: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often each occurs, of several such tables."""
    key, n = (np.concatenate(x) for x in zip(*gathered, strict=True))
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[at], np.add.reduceat(n[order], at)


def _expected(tree, model):
    """How often the model expects each class after each feature, once per distinct context, and what its splits miss."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, split = model.value
        # Odds of the classes, in every row against its likeliest.
        odds = np.exp(weights - weights.max(axis=1, keepdims=True)), np.exp(bias)
        total, missed = np.zeros((CLASSES, KINDS * BUCKETS)), np.zeros((2 if split is None else 1, KINDS, CLASSES, 1 << CELL_BITS))
        gathered = []
        for batch in batches:
            for _, raw, offsets in slices(_training(batch), "text"):
                token, _, first = tokens(raw, offsets)
                context = before(token, first)
                _missed(tree.value, split, token, context, missed)
                gathered.append(np.unique(_keys(_buckets(context)), return_counts=True))
                if sum(len(key) for key, _ in gathered) > GATHERED:
                    _expect(*odds, *_merged(gathered), total)
                    gathered = []
        if gathered:
            _expect(*odds, *_merged(gathered), total)
        yield _rows(np.concatenate((total.T, missed.reshape(-1, CLASSES))))
    return run


def _expect(odds: np.ndarray, prior: np.ndarray, key: np.ndarray, n: np.ndarray, total: np.ndarray) -> None:
    """Add the classes that are expected after the contexts ``key``, each ``n`` times, to ``total``."""
    for lo in range(0, len(n), CHUNK):
        f, often = _apart(key[lo:lo + CHUNK], n[lo:lo + CHUNK])
        p = odds.take(f[0], axis=0)
        p *= odds.take(f[1], axis=0)
        p *= odds.take(f[2], axis=0)
        p *= prior
        p *= (often / p.sum(axis=1))[:, None]
        p = np.ascontiguousarray(p.T, dtype=np.float64)
        for k, row in enumerate(f - BUCKETS * np.arange(KINDS)[:, None]):
            for sums, weight in zip(total[:, BUCKETS * k:BUCKETS * (k + 1)], p):
                sums += np.bincount(row, weights=weight, minlength=BUCKETS)


def _summed(docs: DataFrame, run, tables: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Sum of all tasks' tables, of the classes and of the splits' cells; their size is fixed."""
    schema = ", ".join(["feature int", *(f"{g} double" for g in _G)])
    table = docs.mapInArrow(run, schema).groupBy("feature").agg(*(F.sum(g).alias(g) for g in _G)).toArrow()
    out = np.zeros((KINDS * (BUCKETS + tables * CELLS // CLASSES), CLASSES))
    if table.num_rows:
        out[table.column("feature").to_numpy()] = np.stack([table.column(g).to_numpy() for g in _G], axis=1)
    return out[:KINDS * BUCKETS], out[KINDS * BUCKETS:].reshape(tables, KINDS, CLASSES, 1 << CELL_BITS)


def fit(docs: DataFrame, tree, rounds: int = ROUNDS, rate: float = RATE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, bias) of the class model and the weights of the splits, from all documents that are not held out.

    ``tree``: a broadcast Tree.  The class model starts at the classes' frequencies.  There the expected counts are known, so
    that the first step needs no pass; every further one is a pass over the training part
    in which tasks sum what the model expects.  A step is the gradient, observed less
    expected, in proportion to the larger of both.  Splits start at their masses; a step is the
    gradient with a Gaussian prior, in proportion to the variance at the start.
    """
    spark = docs.sparkSession
    observed, _ = _summed(docs, _observed)
    classes = observed[:BUCKETS].sum(axis=0)
    prior = (classes + 1) / (classes.sum() + CLASSES)
    bias = np.log(prior)
    smooth = PRIOR * prior
    of_feature = observed.sum(axis=1, keepdims=True)
    weights = np.log((observed + smooth) / (of_feature * prior + smooth)) * rate
    split, variance = np.zeros((KINDS, CLASSES, 1 << CELL_BITS)), None
    for n in range(rounds):
        model = spark.sparkContext.broadcast((weights.astype(np.float32), bias.astype(np.float32), split.astype(np.float32) if n else None))
        expected, (missed, *first) = _summed(docs, _expected(tree, model), 1 if n else 2)
        variance = variance if n else first[0]
        weights += rate * (observed - expected) / (np.maximum(observed, expected) + smooth)
        split += rate * (missed - SPLIT_PRIOR * split) / (variance + SPLIT_PRIOR)
        model.unpersist()
    return weights, bias, split


def _scores(tree, model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (weights, bias, split), words_of = model.value, tree.value
        task, n = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            for rows, raw, offsets in slices(batch, "text"):
                token, kind, first = tokens(raw, offsets)
                context = before(token, first)
                of = _buckets(context)
                score = np.empty(len(token))
                for lo in range(0, len(token), CHUNK):
                    z = _logits(weights, bias, of[:, lo:lo + CHUNK])
                    own = z[np.arange(len(z)), kind[lo:lo + CHUNK]].astype(np.float64)
                    score[lo:lo + CHUNK] = own - np.log(np.exp(z, out=z).sum(axis=1))
                place = words_of.find(token)
                known = place >= 0
                rare = np.flatnonzero(~known)
                counted = np.zeros(len(token))
                counted[known] = words_of.log_count[place[known]]
                # A rare word is unknown, unless the join finds it: then it is one of its group.
                place[rare] = words_of.unknown(kind[rare])
                group = groups(token[rare])
                inner = _within(words_of, split, np.concatenate((place, len(words_of.word) + group)), tuple(np.concatenate((x, x[rare])) for x in context))
                score = (score + inner[:len(token)]) / np.log(10)
                gain = (inner[len(token):] - inner[rare]) / np.log(10) - words_of.log_mass[group]
                bounds = np.searchsorted(rare, first).astype(np.int32)
                ids = rows.column("doc_id")
                yield pa.record_batch([
                    pa.array(np.arange(task + n, task + n + rows.num_rows)), ids,
                    pa.array([held_out(d) for d in ids.to_pylist()], pa.bool_()), pa.array(np.diff(first)),
                    pa.array(np.add.reduceat(known, first[:-1], dtype=np.int64)), pa.array(np.add.reduceat(counted, first[:-1])),
                    pa.array(np.add.reduceat(score, first[:-1])), pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(
                        [pa.array(token[rare].view(np.int64)), pa.array(gain.astype(np.float32))], ["word", "gain"]))],
                    ["row", "doc_id", "held_out", "n_tokens", "known", "counted", "model", "rare"])
                n += rows.num_rows
    return run


def scored(docs: DataFrame, rounds: int = ROUNDS, frequent: int = FREQUENT) -> DataFrame:
    """Log10 probabilities of all documents, learnt from those that are not held out.

    (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).  Tokens are
    words, lower-cased in A-Z, and one end per document; a null or empty text is the end
    alone.  ``base_score`` is the sum of add-one unigrams over the training part's types
    and one unknown type; ``score`` is the model's.  Unknown words are one event of their
    class.  Counts of the ``frequent`` most frequent words are held by every task, a fixed
    number; those of all others are joined, word by word.  Contexts tell frequent words from
    each other, and groups of other words; a group's words share its probability by counts.  Repeated rows are rows of their
    own, also in training; null ids are trained on.  An empty table gives an empty result;
    without training documents everything is unknown.  Further columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = written(docs.mapInArrow(_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("types")).first()
    total, types = sums["n"] or 0, sums["types"]
    top = counts.orderBy(F.desc("n"), "word").limit(frequent).toArrow()
    word, n = top.column("word").to_numpy().view(np.uint64), top.column("n").to_numpy()
    # The other words' mass is that of all less that of the frequent ones; its size is fixed.
    group = F.col("word").bitwiseAND(CLASSES - 1) * GROUPS + F.shiftright("word", 8).bitwiseAND(GROUPS - 1)
    sums = counts.groupBy(group.alias("group")).agg(F.sum(F.col("n") + 1).alias("n")).toArrow()
    mass = np.zeros(CLASSES * GROUPS, np.int64)
    mass[sums.column("group").to_numpy()] = sums.column("n").to_numpy()
    np.subtract.at(mass, groups(word), n + 1)
    tree = spark.sparkContext.broadcast(Tree(word, n, mass))
    model = spark.sparkContext.broadcast(tuple(x.astype(np.float32) for x in fit(docs, tree, rounds)))
    rows = written(docs.mapInArrow(_scores(tree, model), "row long, doc_id long, held_out boolean, n_tokens long, known long, "
                                   "counted double, model double, rare array<struct<word: long, gain: float>>"), "scores")
    asked = rows.select("row", F.explode_outer("rare").alias("rare")).select("row", "rare.*").filter("word is not null")
    found = (asked.join(counts.select("word", "n"), "word").groupBy(F.col("row").alias("of"))
             .agg(F.sum(F.log10(F.col("n") + 1)).alias("more"), F.sum("gain").alias("gain"), F.count("*").alias("also")))
    each = rows.drop("rare").join(found, F.col("row") == F.col("of"), "left")
    more = F.coalesce("more", F.lit(0.0))
    return each.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("counted") + more - F.col("n_tokens") * F.log10(F.lit(float(total + types + 1)))).alias("base_score"),
        (F.col("model") + more + F.coalesce("gain", F.lit(0.0))).alias("score"))
