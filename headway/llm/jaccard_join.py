"""Similarity join of documents on word shingles by T-occurrence search (DivideSkip).

Two sets x, y have a Jaccard similarity of s or more only if they share at least
T = s * |x| elements.  So a set with |x| - T + 1 elements that no other set has links with
nothing; a fixed share of all possible shingles, picked by their hash, is counted over
all documents and settles that for most of them.  The others' sets are counted whole.  Of
any |x| - T + 1 elements of x one is in y, if both are taken in one global order, the
rarest first; sets that share such an element, also over others, are a loose group, and
only its sets are searched: in blocks of bounded size, a query merges the short inverted
lists of its shingles, which leaves sets that occur often enough to reach T even if all
long lists had them, and looks these up in the long lists by binary probes.  Equal sets
are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from headway.llm.frames import components, written
from headway.llm.vectors import mix, slices, window_hashes, word_hashes, words

#: Bytes with A-Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Share of all possible shingles that is counted first, as a multiple of the share in which sets may differ.
COUNTED = 5 / 3
#: Sets and shingles of a block: bounds the memory of a search.
BLOCK_SETS, BLOCK_SHINGLES = 2048, 1 << 20
#: Sets of a group of several blocks that all its blocks share in the first round.
HEADS = 16
#: Weight of a merged list against a probed one: T / (MU * log2(longest) + 1) lists are long.
MU = 0.03


def least_overlap(size, similarity: int):
    """Elements that a set of this size must share with any set of the similarity (in hundredths)."""
    return (similarity * size + 99) // 100


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of all distinct shingles, sorted; fewer words are one shingle."""
    starts, ends, first = words(raw, offsets)
    word, count = word_hashes(LOWER[raw], starts, ends), np.diff(first)
    hashes = window_hashes(word, shingle)
    text = np.repeat(np.arange(len(count)), count)[:len(hashes)]
    inside = np.arange(len(hashes)) + shingle <= first[text + 1] if len(hashes) else np.zeros(0, bool)
    hashes, text = hashes[inside], text[inside]
    short = np.flatnonzero((count > 0) & (count < shingle))
    if len(short):
        whole = [window_hashes(word[first[i]:first[i + 1]], int(count[i]))[0] for i in short.tolist()]
        hashes, text = np.concatenate((hashes, np.array(whole, np.uint64))), np.concatenate((text, short))
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return text[new], hashes[new]


_MEASURED = "doc_id long, body long, n long, node long, some array<long>"


def _measured(shingle: int, share: float):
    most = np.uint64(min(int(share * 2 ** 64), 2 ** 64 - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw, offsets in slices(batch, "text"):
                text, hashes = shingle_sets(raw, offsets, shingle)
                n = np.bincount(text, minlength=rows.num_rows)
                first = np.cumsum(n) - n
                # A set's name: a sum that does not depend on the order.
                added = np.concatenate(([np.uint64(0)], np.cumsum(mix(hashes ^ np.uint64(shingle)), dtype=np.uint64)))
                node = mix((added[first + n] - added[first]) + n.astype(np.uint64))
                yield pa.record_batch([rows.column("doc_id"), rows.column("body"), pa.array(n), pa.array(node.view(np.int64)),
                                       _lists(text, hashes, hashes < most, rows.num_rows)], ["doc_id", "body", "n", "node", "some"])
    return run


def _lists(text: np.ndarray, hashes: np.ndarray, taken: np.ndarray, rows: int) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(np.bincount(text[taken], minlength=rows)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[taken].view(np.int64)))


def _postings(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw, offsets in slices(batch, "text"):
                text, hashes = shingle_sets(raw, offsets, shingle)
                yield pa.record_batch([pa.array(hashes.view(np.int64)), rows.column("node").take(pa.array(text))], ["shingle", "node"])
    return run


class InvertedLists:
    """The inverted lists of some sets: per shingle the ascending numbers of the sets that hold it."""

    def __init__(self, sizes: np.ndarray, shingles: np.ndarray):
        self.sizes, self.at = sizes, np.cumsum(sizes) - sizes
        _, self.own = np.unique(shingles, return_inverse=True)
        holder = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(self.own, kind="stable")
        self.holders, self.length = holder[order], np.bincount(self.own)
        self.first = np.cumsum(self.length) - self.length
        #: (shingle, set) as one ascending number each: where lists are probed.
        self.keys = self.own[order].astype(np.int64) * len(sizes) + self.holders

    def search(self, i: int, similarity: int, wanted: np.ndarray) -> np.ndarray:
        """Sets among ``wanted`` (a mask) that reach the similarity (in hundredths) with set ``i``, by DivideSkip."""
        size = int(self.sizes[i])
        mine, least = self.own[self.at[i]:self.at[i] + size], least_overlap(size, similarity)
        mine = mine[np.argsort(self.length[mine], kind="stable")]
        longest = max(int(self.length[mine[-1]]), 2)
        n_long = min(least - 1, int(least / (MU * np.log2(longest) + 1)))
        short, long = mine[:size - n_long], mine[size - n_long:]
        # The short lists are sorted runs, which a stable sort merges.
        steps = np.repeat(self.first[short] - (np.cumsum(self.length[short]) - self.length[short]), self.length[short])
        merged = np.sort(self.holders[steps + np.arange(len(steps))], kind="stable")
        edge = np.flatnonzero(np.concatenate(([True], merged[1:] != merged[:-1])))
        found, times = merged[edge], np.diff(np.append(edge, len(merged)))
        good = (times >= least - n_long) & wanted[found]
        found, times = found[good], times[good]
        other = self.sizes[found]
        # 100 * common >= similarity * union, as a least overlap of this pair.
        needed = -(-similarity * (size + other) // (100 + similarity))
        good = (times + n_long >= needed) & (np.minimum(other, size) >= needed)
        found, times, needed = found[good], times[good], needed[good]
        # Long lists are probed in portions; who cannot reach the overlap any more is skipped.
        for lo in range(0, n_long, 64):
            if not len(found):
                break
            probe = long[lo:lo + 64].astype(np.int64)[:, None] * len(self.sizes) + found[None]
            hit = np.searchsorted(self.keys, probe)
            times = times + (self.keys[np.minimum(hit, len(self.keys) - 1)] == probe).sum(axis=0)
            alive = times + max(n_long - lo - 64, 0) >= needed
            found, times, needed = found[alive], times[alive], needed[alive]
        return found[times >= needed]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each shard, one per node; input is sorted by shard and node."""
    held: list[pa.RecordBatch] = []
    at = last = None
    for batch in batches:
        shard, node = (batch.column(c).to_numpy() for c in ("shard", "node"))
        cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            if held and at != shard[lo]:
                yield pa.Table.from_batches(held)
                held, last = [], None
            new = np.concatenate(([last is None or node[lo] != last], node[lo + 1:hi] != node[lo:hi - 1]))
            held.append(batch.slice(lo, hi - lo).filter(pa.array(new)))
            at, last = shard[lo], node[hi - 1]
    if held:
        yield pa.Table.from_batches(held)


def _linked(shingle: int, similarity: int):
    """Links of a shard between sets of different parts, as far as they join parts."""
    def lists_of(shard: pa.Table) -> InvertedLists:
        sizes, hashes = [], []
        for batch in shard.select(["text"]).to_batches():
            for rows, raw, offsets in slices(batch, "text"):
                text, found = shingle_sets(raw, offsets, shingle)
                sizes.append(np.bincount(text, minlength=rows.num_rows))
                hashes.append(found)
        return InvertedLists(np.concatenate(sizes), np.concatenate(hashes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            if shard.num_rows < 2:
                continue
            node, part, asks = (shard.column(c).to_numpy() for c in ("node", "part", "asks"))
            part, lists, found = part.copy(), lists_of(shard), []
            for i in np.flatnonzero(asks).tolist():
                apart = part != part[i]
                if not apart.any():
                    break
                linked = lists.search(i, similarity, apart)
                if len(linked):
                    parts, which = np.unique(part[linked], return_index=True)
                    found += [(int(node[i]), int(node[j])) for j in linked[which].tolist()]
                    part[np.isin(part, parts)] = part[i]
            if found:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found)], ["u", "v"])
    return run


def _search(rows: DataFrame, texts: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """Links (u, v) within the shards of ``rows`` (shard, node, part, asks); ``texts``: (node, text)."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(rows.join(texts, "node").repartition(n, "shard").sortWithinPartitions("shard", "node")
                   .mapInArrow(_linked(shingle, similarity), "u long, v long"), "links")


def _blocks(n, shingles):
    return F.greatest(F.ceil(n / BLOCK_SETS), F.ceil(shingles / BLOCK_SHINGLES), F.lit(1)).cast("int")


def _links(loose: DataFrame, texts: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """Enough links to connect what the similarity connects; ``loose``: (node, loose, n).

    First every block of a loose group is searched by itself, together with some sets that
    all blocks of the group share.  Where a group of several blocks is still in parts, all
    its sets outside the largest part ask all sets of other parts: both are cut into
    blocks, and each pair of blocks is a shard.
    """
    groups = loose.groupBy("loose").agg(_blocks(F.count("*"), F.sum("n")).alias("blocks"))
    dealt = written(loose.join(groups, "loose").withColumn("h", F.xxhash64("node")), "dealt")
    several = dealt.filter("blocks > 1")
    heads = several.withColumn("r", F.row_number().over(Window.partitionBy("loose").orderBy("h", "node"))).filter(F.col("r") <= HEADS)
    own = F.pmod("h", "blocks").cast("int")
    shared = heads.select("loose", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"), "node").filter("own <> b")
    placed = dealt.select("loose", own.alias("b"), "node").union(shared.select("loose", "b", "node"))
    first = _search(placed.select(F.xxhash64("loose", "b").alias("shard"), F.col("node").alias("part"), F.lit(True).alias("asks"), "node"),
                    texts, shingle, similarity)
    if several.isEmpty():
        return first
    known = (several.join(components(first).withColumnRenamed("root", "part"), "node", "left")
             .withColumn("part", F.coalesce("part", "node")))
    parts = known.groupBy("loose", "part").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    sizes = parts.groupBy("loose").agg(F.sum("sets").alias("sets"), F.sum("shingles").alias("shingles"), F.count("*").alias("parts"),
                                       F.max(F.struct("sets", "part", "shingles")).alias("big")).filter("parts > 1")
    sizes = sizes.select("loose", F.col("big.part").alias("big"), _blocks(F.col("sets"), F.col("shingles")).alias("all"),
                         _blocks(F.col("sets") - F.col("big.sets"), F.col("shingles") - F.col("big.shingles")).alias("asking"))
    mine = written(known.join(sizes, "loose"), "apart")

    def each(asks: bool, here: str, there: str) -> DataFrame:
        pair = ("here", "there") if asks else ("there", "here")
        rows = mine.filter("part <> big" if asks else "true").select(
            "loose", "part", F.pmod("h", here).cast("long").alias("here"), F.explode(F.sequence(F.lit(0), F.col(there) - 1)).alias("there"), "node")
        return rows.select(F.xxhash64("loose", *(F.col(c).cast("long") for c in pair)).alias("shard"), "part", F.lit(asks).alias("asks"), "node")

    # A set that asks and is asked in one shard is there once.
    pairs = each(True, "asking", "all").union(each(False, "all", "asking")).groupBy("shard", "part", "node").agg(F.max("asks").alias("asks"))
    return first.union(_search(pairs, texts, shingle, similarity))


@contextmanager
def _filtered_joins(spark: SparkSession, rows: int) -> Iterator[None]:
    """Joins in which Spark drops rows of the large side by a Bloom filter of the other's keys.

    The filter is sized for ``rows`` keys and never above Spark's bound of eight megabytes;
    what it lets through is joined all the same, so it only saves shuffling.
    """
    name = "spark.sql.optimizer.runtime.bloomFilter."
    wanted = {"applicationSideScanSizeThreshold": "1m", "creationSideThreshold": "1t", "expectedNumItems": str(max(rows, 1))}
    before = {key: spark.conf.get(name + key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(name + key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(name + key, value)


def joined(docs: DataFrame, shingle: int = 4, similarity: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document of ``docs`` (doc_id, text).

    Two documents link when 100 * common >= ``similarity`` * union, counted on their sets
    of distinct ``shingle``-word shingles: words are runs between white space (space, tab
    to carriage return), lower-cased in A-Z; a text of fewer words is one shingle.
    ``component_id`` is the least doc_id reachable by links, its own included.  A document
    without words, or with a null text, has an empty set, links with nothing and keeps its
    own id.  Rows that repeat a doc_id are each reported, with the links of their own
    text; a null id is in its component but never names one unless it is alone there
    (then it is null).  Shingles and sets are told apart by 64-bit hashes.  Further
    columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("body"))
    found = written(docs.mapInArrow(_measured(shingle, COUNTED * (100 - similarity) / 100), _MEASURED), "measured")
    sets = found.filter("n > 0")
    distinct = written(sets.groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.struct("doc_id", "body")).alias("text"), F.max("n").alias("n")), "distinct")
    held = sets.select(F.explode("some").alias("shingle"), "node").groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("last"))
    alone = held.filter("node = last").groupBy("node").agg(F.count("*").alias("alone"))
    # How many elements of a set hold one of any set that it links with.
    reach = F.col("n") - F.floor((F.col("n") * similarity + 99) / 100) + 1
    asked = distinct.join(alone, "node", "left").filter(F.coalesce("alone", F.lit(0)) < reach)
    asked = written(asked.select("node", "n", F.col("text.doc_id").alias("doc"), "text.body"), "asked")
    same = docs["doc_id"].eqNullSafe(asked["doc"]) & (docs["body"] == asked["body"])
    with _filtered_joins(docs.sparkSession, asked.count()):
        texts = written(docs.join(asked.filter("n > 0"), same).select("node", "text").dropDuplicates(["node"]), "texts")

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # One exchange serves the count and the join.
    postings = texts.mapInArrow(_postings(shingle), "shingle long, node long").repartition(n, "shingle")
    often = postings.groupBy("shingle").agg(F.count("*").alias("sets")).filter("sets > 1")
    shared = postings.join(often, "shingle").join(asked.select("node", "n"), "node")
    own = Window.partitionBy("node")
    # Elements that only one set has come first; those are not listed here.
    rare = (shared.withColumn("place", F.row_number().over(own.orderBy("sets", "shingle")) + F.col("n") - F.count("*").over(own))
            .filter(F.col("place") <= reach).select("shingle", "node"))
    rare = written(rare, "rare")
    first = rare.groupBy("shingle").agg(F.min("node").alias("u"), F.max("node").alias("last")).filter("u <> last").select("shingle", "u")
    stars = rare.join(first, "shingle").filter("node <> u").select("u", F.col("node").alias("v")).distinct()
    loose = components(stars).withColumnRenamed("root", "loose").join(asked, "node").select("node", "loose", "n")
    root = components(_links(loose, texts, shingle, similarity))
    of = distinct.join(root, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    names = of.join(of.groupBy("root").agg(F.min("doc_id").alias("component_id")), "root").select("node", "component_id")
    return found.join(names, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
