"""Benchmark decontamination by templates: re-parameterised questions are found too.

Words become a template: numbers, units after numbers and names (capitalised words
within a sentence) turn into typed placeholders, other words lose case and outer
punctuation.  A capital that opens a text, line or sentence tells no name from another
word, so there are two readings, with openers as words and as names.  Windows of the
benchmark's templates are looked up in all documents.  Matches of one alignment, or of
near ones that ascend together where words were put in or left out, form a chain, and the
concrete values behind its placeholders must map one to one; windows with little but
placeholders are looked up by their literal words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from headway.llm.frames import written
from headway.llm.vectors import mix, slices, window_hashes, word_hashes, words

#: Words per template window.
WINDOW = 8
#: Least part of an item's windows that a document must hold.
SHARE = 0.5
#: Words by which the alignments of one chain may lie apart from its middle: words put in or left out.
BAND = 16
#: Benchmark windows looked up at once: more are looked up block after block.
BLOCK = 1 << 20
#: Names of units, as fixed values.
UNITS = ("mm cm m km in ft yd mi mg g kg t lb lbs oz ml l hl s sec min h hr hrs day days week weeks month months year years "
         "hour hours minute minutes second seconds meter meters metre metres kilometer kilometers kilometre kilometres mile miles "
         "foot feet inch inches gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres % percent "
         "dollar dollars cent cents euro euros usd eur gbp mph kph km/h m/s w kw kwh v a hz khz mhz ghz kb mb gb tb °c °f").split()

_OUTER = np.zeros(256, bool)
_OUTER[[ord(c) for c in ".,;:!?\"'()[]{}<>*_-"]] = True
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?:\n"]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_NUMBER = re.compile(rb"[-+]?[$]?[0-9][0-9.,:/]*%?")
_GLUED = re.compile(rb"([-+]?[$]?[0-9][0-9.,:/]*)([^0-9.,:/].*)", re.S)
#: Readings of a window: openers as words, openers as names, all words as they are.
WORDS_OPEN, NAMES_OPEN, LITERAL = range(3)


def _typed(kind: int) -> np.uint64:
    return mix(np.array([kind], np.uint64))[0]


NUMBER, UNIT, NAME = (_typed(k) for k in (1, 2, 3))
_ONE = np.array([0])


def _hash_of(word: bytes) -> np.uint64:
    return word_hashes(np.frombuffer(word, np.uint8), _ONE, np.array([len(word)]))[0]


_UNIT_NAMES = frozenset(u.encode() for u in UNITS)
_UNIT_HASHES = np.sort(np.array([_hash_of(u.encode()) for u in UNITS], np.uint64))


def _maybe_numbers(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Words that begin like a number."""
    if not len(begin):
        return np.zeros(0, np.int64)
    digit = (raw[begin] >= 48) & (raw[begin] <= 57)
    lead = np.isin(raw[begin], [ord(c) for c in "$+-"]) & (end - begin > 1)
    nextbyte = raw[np.minimum(begin + 1, len(raw) - 1)]
    return np.flatnonzero(digit | (lead & (((nextbyte >= 48) & (nextbyte <= 57)) | (nextbyte == 36))))


def templates(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per word: template hash, is it a slot, hash of its concrete value; first word of each text; may it be a name that opens.

    A number with a unit glued to it is two words.
    """
    starts, ends, first = words(raw, offsets)
    n = len(starts)
    begin, end = starts.copy(), ends.copy()
    # Outer punctuation goes; what is nothing else stays as it is.
    for _ in range(4):
        more = (begin < end - 1) & _OUTER[raw[np.minimum(begin, len(raw) - 1)]] if n else np.zeros(0, bool)
        begin = begin + more
        more = (end - 1 > begin) & _OUTER[raw[np.maximum(end - 1, 0)]] if n else more
        end = end - more
    low = _LOWER[raw]
    # Upper case of two bytes (Latin-1 letters) to lower case.
    wide = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)) if len(raw) else np.empty(0, np.int64)
    low[wide + 1] += 0x20
    maybe = _maybe_numbers(raw, begin, end)
    glued = {}
    for i in maybe.tolist():
        told = _GLUED.fullmatch(raw[begin[i]:end[i]].tobytes())
        if told and told[2].lower() in _UNIT_NAMES and not _NUMBER.fullmatch(told[0]):
            glued[i] = begin[i] + len(told[1])
    if glued:
        at, cut = np.array(list(glued)), np.array(list(glued.values()))
        starts, begin = (np.insert(x, at + 1, cut) for x in (starts, begin))
        ends, end = (np.insert(x, at, cut) for x in (ends, end))
        first = first + np.searchsorted(at, first)
        n, maybe = len(starts), _maybe_numbers(raw, begin, end)
    value = word_hashes(low, begin, end)
    template = value.copy()
    if not n:
        return template, np.zeros(0, bool), value, first, np.zeros(0, bool)
    nextbyte = raw[np.minimum(begin + 1, len(raw) - 1)]
    number = np.zeros(n, bool)
    for i in maybe.tolist():
        number[i] = _NUMBER.fullmatch(raw[begin[i]:end[i]].tobytes()) is not None
    after = np.zeros(n, bool)
    after[1:] = number[:-1]
    after[first[:-1][first[:-1] < n]] = False
    unit = after & np.isin(value, _UNIT_HASHES)
    # A name: a capital not at the beginning of a text, line or sentence.
    capital = ((raw[begin] >= 65) & (raw[begin] <= 90))
    capital |= (raw[begin] == 0xC3) & (nextbyte >= 0x80) & (nextbyte <= 0x9E) & (nextbyte != 0x97) & (end - begin > 1)
    opens = np.ones(n, bool)
    opens[1:] = _ENDS[raw[ends[:-1] - 1]] | _ENDS[raw[ends[:-1]]] | _ENDS[raw[starts[1:] - 1]]
    opens[first[:-1][first[:-1] < n]] = True
    capital &= (end - begin > 1) & ~number
    name = capital & ~opens
    template[number], template[unit], template[name] = NUMBER, UNIT, NAME
    return template, number | unit | name, value, first, capital & opens & ~unit


def readings(raw: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
    """Word hashes and slots in each reading, hashes of the concrete values, first word of each text."""
    template, slot, value, first, opener = templates(raw, offsets)
    return [template, np.where(opener, NAME, template), value], [slot, slot | opener, np.zeros(len(slot), bool)], value, first


def _reading_hashes(words: np.ndarray, size: int, reading: int) -> np.ndarray:
    h = window_hashes(words, size)
    return mix(h + np.uint64(reading)) if reading else h


def _spread(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts and first words of all windows of ``size`` words."""
    count = np.maximum(np.diff(first) - size + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    return text, np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count) + first[:-1][text]


def window_sums(values: np.ndarray, size: int) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[size:] - total[:-size]


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(hash, size, item_id, at, reading, windows, total, values) of every window of every item, per reading.

    An item of fewer words than ``window`` is one window of all its words; ``size`` says how
    many.  Of windows of which more than half are slots a template says nothing: they are
    there by their literal words.  Openers are read as names where ``window`` / 2 words
    are left.  ``windows`` counts the item's windows in this reading, ``total`` all of them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw, offsets in slices(batch, "text"):
                read, slots, value, first = readings(raw, offsets)
                out = []
                for i, item in enumerate(rows.column("item_id").to_pylist()):
                    own = slice(first[i], first[i + 1])
                    v, size = value[own], min(window, first[i + 1] - first[i])
                    if not size:
                        continue
                    known = [window_sums(~x[own], size) for x in slots]
                    plain = known[WORDS_OPEN] * 2 >= size
                    for reading, told in ((WORDS_OPEN, plain), (NAMES_OPEN, known[NAMES_OPEN] * 2 >= window), (LITERAL, ~plain)):
                        if not told.any():
                            continue
                        h = _reading_hashes(read[reading][own], size, reading).view(np.int64).tolist()
                        shown = np.where(slots[reading][own], v, np.uint64(0)).view(np.int64)
                        for at in np.flatnonzero(told).tolist():
                            out.append((h[at], size, item, at, reading, int(told.sum()), len(plain), shown[at:at + size].tolist()))
                if out:
                    yield pa.record_batch([pa.array(c) for c in zip(*out)], ["hash", "size", "item_id", "at", "reading", "windows", "total", "values"])

    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        run, "hash long, size long, item_id long, at long, reading long, windows long, total long, values array<long>")


def _hits(hashes: np.ndarray, kinds: list[tuple[int, int]]):
    """Windows of documents whose hash in a reading and size of ``kinds`` is one of ``hashes`` (sorted)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = np.zeros(1 << 16, bool)
        tail[(hashes.view(np.uint64) >> np.uint64(48)).astype(np.int64)] = True
        for batch in batches:
            for rows, raw, offsets in slices(batch, "text"):
                ids = rows.column("doc_id")
                read, slots, value, first = readings(raw, offsets)
                for reading, size in kinds:
                    shown = np.where(slots[reading], value, np.uint64(0))
                    text, at = _spread(first, size)
                    if not len(at):
                        continue
                    h = _reading_hashes(read[reading], size, reading)[at]
                    maybe = np.flatnonzero(tail[(h >> np.uint64(48)).astype(np.int64)])
                    h = h[maybe].view(np.int64)
                    place = np.searchsorted(hashes, h)
                    found = hashes[np.minimum(place, len(hashes) - 1)] == h
                    hit = maybe[found]
                    if not len(hit):
                        continue
                    values = shown[at[hit][:, None] + np.arange(size)].view(np.int64)
                    yield pa.record_batch([
                        ids.take(pa.array(text[hit])), pa.array(at[hit] - first[text[hit]]), pa.array(h[found]),
                        pa.array(np.full(len(hit), size)),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, len(hit) * size + 1, size, np.int32)), pa.array(values.ravel()))],
                        ["doc_id", "place", "hash", "size", "shown"])
    return run


HIT = "doc_id long, place long, hash long, size long, shown array<long>"


def _chains(aligned: DataFrame, share: float, band: int) -> DataFrame:
    """(doc_id, item_id, n_windows, windows, slots) of chains over several alignments of a pair.

    Around each alignment those up to ``band`` words away are followed together: from window
    to window of the item, the match nearest to the middle that lies behind the last one is
    taken.  Only pairs whose alignments could reach the share together are looked at.
    """
    pair = Window.partitionBy("doc_id", "item_id", "way")
    possible = (aligned.withColumns({"all": F.sum("n_windows").over(pair), "alignments": F.count("*").over(pair)})
                .filter((F.col("alignments") > 1) & (F.col("all") >= F.col("windows") * F.lit(share))))
    near = possible.withColumn("near", F.collect_list(F.struct("shift", "hits")).over(pair.orderBy("shift").rangeBetween(-band, band)))
    hits = F.flatten(F.transform("near", lambda a: F.transform(a["hits"], lambda h: F.struct(
        h["at"].alias("at"), F.abs(a["shift"] - F.col("shift")).alias("off"), (h["at"] + a["shift"]).alias("place"), h["slots"].alias("slots")))))
    least = F.lit(-1 << 62)

    def step(acc, h):
        follows = (h["at"] > acc["at"]) & (h["place"] > acc["place"])
        return F.when(follows, F.struct(
            h["at"].alias("at"), h["place"].alias("place"), (acc["n"] + 1).alias("n"),
            F.array_union(acc["slots"], h["slots"]).alias("slots"))).otherwise(acc)

    start = F.struct(least.alias("at"), least.alias("place"), F.lit(0).cast("long").alias("n"),
                     F.array().cast("array<struct<item:bigint,doc:bigint>>").alias("slots"))
    chained = near.filter(F.size("near") > 1).withColumn("chain", F.aggregate(F.array_sort(hits), start, step))
    return chained.select("doc_id", "item_id", F.col("chain.n").alias("n_windows"), "windows", F.col("chain.slots").alias("slots"))


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE, block: int = BLOCK,
          band: int = BAND) -> DataFrame:
    """Documents that hold a benchmark item, literally or with other numbers, names and units.

    (doc_id, item_id, n_windows: matching windows of the item, share: of its windows,
    literal: no slot has another value).  A pair counts if, in one reading, at least ``share``
    of the item's template windows match and the slots are consistent: each value of the item
    stands for one value of the document and back.  The windows match at one alignment
    (document place minus item place), or in a chain over alignments up to ``band`` words to
    either side of one, along which item and document places both ascend; so items with words
    put in or left out are found.  Words that open a text, line or sentence with a
    capital are words in one reading and names in another; in a third, windows of more
    than half slots count too and match by their literal words.  An item shorter than
    ``window`` is one window; an item without words, or a null text, never matches.  Repeated
    rows of the benchmark or of the documents count once; null ids are kept as an id of their
    own.  Further columns are ignored.  The benchmark's windows are looked up in blocks of
    ``block`` windows, so that what tasks receive is bounded for any benchmark.
    """
    spark = docs.sparkSession
    asked = written(benchmark_windows(benchmark.select("item_id", "text").distinct(), window), "benchmark")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = asked.select("hash").distinct().count()
    parts = max(1, -(-total // block))
    hit = None
    for k in range(parts):
        mine = asked.filter(F.pmod("hash", F.lit(parts)) == k).select("hash", "size", "reading").distinct().toArrow()
        if not mine.num_rows:
            continue
        hashes = np.unique(mine.column("hash").to_numpy())
        kinds = sorted(set(zip(mine.column("reading").to_pylist(), mine.column("size").to_pylist())))
        more = keyed.mapInArrow(_hits(hashes, kinds), HIT)
        hit = more if hit is None else hit.union(more)
    if hit is None:
        return spark.createDataFrame([], "doc_id long, item_id long, n_windows long, share double, literal boolean")
    pairs = (hit.join(asked, ["hash", "size"])
             .withColumn("shift", F.col("place") - F.col("at"))
             .withColumn("slots", F.filter(F.arrays_zip(F.col("values").alias("item"), F.col("shown").alias("doc")), lambda s: s["item"] != 0)))
    # What each way to read an alignment counts: windows with their slots, out of how many.
    ways = []
    for name, of, out_of in (("words", [WORDS_OPEN], "windows"), ("names", [NAMES_OPEN], "windows"), ("all", [WORDS_OPEN, LITERAL], "total")):
        here = F.col("reading").isin(of)
        ways.append((F.collect_set(F.when(here, F.struct("at", "slots"))).alias(f"{name}_hits"), F.max(F.when(here, F.col(out_of))).alias(f"{name}_of")))
    read = F.array(*(F.struct(F.lit(n).alias("way"), F.col(f"{n}_hits").alias("hits"), F.col(f"{n}_of").alias("windows")) for n in ("words", "names", "all")))
    aligned = (pairs.groupBy("doc_id", "item_id", "shift").agg(*(c for way in ways for c in way))
               .select("doc_id", "item_id", "shift", F.explode(read).alias("read")).select("doc_id", "item_id", "shift", "read.*")
               .filter(F.size("hits") > 0).withColumn("n_windows", F.size(F.array_distinct("hits.at")).cast("long")))
    single = aligned.select("doc_id", "item_id", "n_windows", "windows", F.array_distinct(F.flatten("hits.slots")).alias("slots"))
    # Consistency: as many distinct pairs as item values and as document values.
    return (single.unionByName(_chains(aligned, share, band))
            .filter(F.col("n_windows") >= F.col("windows") * F.lit(share))
            .filter((F.size(F.array_distinct("slots.item")) == F.size("slots")) & (F.size(F.array_distinct("slots.doc")) == F.size("slots")))
            .withColumn("literal", F.forall("slots", lambda s: s["item"] == s["doc"]))
            .groupBy("doc_id", "item_id")
            .agg(F.max("n_windows").alias("n_windows"), F.max(F.col("n_windows") / F.col("windows")).alias("share"), F.max("literal").alias("literal")))


def without_leaks(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """All columns of the documents that hold no benchmark item.

    A row is known by the hash of all its columns: each is judged by its own text, whether
    its doc_id is null or repeats another's.
    """
    rows = docs.withColumn("__row", F.xxhash64(*docs.columns))
    found = leaks(rows.select(F.col("__row").alias("doc_id"), "text"), benchmark, **how).select(F.col("doc_id").alias("__leak")).distinct()
    # As a written table Spark knows how large it is before it joins the texts.
    found = written(found, "leaks")
    return rows.join(found, rows["__row"] == found["__leak"], "left_anti").drop("__row")
