"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Counts of every text give a few badness features.  A fixed chain of levels, each with a
cutoff per feature and sharper than the one before, is tested per stratum on the labelled
good documents from the loosest level on: a level is accepted if an exact binomial test
rejects that it drops more than the allowed share of good documents.  Levels are nested,
so the first that fails ends the chain and no correction is needed inside it; strata share
the chance of an error by their numbers of labels (weighted Bonferroni).  The sharpest
accepted level then applies to every document of the stratum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WORDS = "[ \\t-\\r]+"
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
#: Largest share of good documents that all of a stratum's rules together may drop.
RISK = 0.02
#: Chance that any stratum's accepted rules break that promise.
DELTA = 0.05
#: The chain, as fixed values: reject above, loosest level first; the same for any input.
GRID = {
    "symbols_per_word": [1.2, 0.8, 0.5, 0.3, 0.2, 0.1, 0.05, 0.02],
    "dup_line_share": [0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1],
    "repeat_share": [0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1],
    "long_words": [12.0, 11.0, 10.0, 9.0, 8.0, 7.5, 7.0, 6.5],
    "short_words": [-2.5, -3.0, -3.25, -3.5, -3.75, -4.0, -4.5, -5.0],
}


def let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once, wherever the optimizer moves the expression."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words that lie in three-word windows found twice or more.

    The windows' hashes are sorted with their places inside the row, equal neighbours are
    the repeated ones, and the words they cover are summed in order: linear but for the
    sort, without a row per word.  Texts that repeat nothing skip the sort.
    """
    def of_windows(tri: Column) -> Column:
        placed = F.array_sort(F.transform(tri, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(tri)) == F.size(tri), 0).otherwise(let(placed, of_sorted)).cast("long")

    def of_sorted(placed: Column) -> Column:
        again = F.filter(placed, lambda x, k: (
            F.coalesce(F.get(placed, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(placed, k + 1)["h"] == x["h"], F.lit(False))))
        return F.aggregate(
            F.array_sort(F.transform(again, lambda x: x["i"])), F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")),
            lambda acc: acc["n"])

    return F.when(F.size(words) < 3, F.lit(0).cast("long")).otherwise(let(
        F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                    lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))), of_windows))


def counts(text: Column) -> Column:
    """A text's counts as one struct; a null text has none of anything."""
    body = F.coalesce(text, F.lit(""))
    spaceless = F.translate(body, SPACES, "")
    lines = F.filter(F.split(body, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    words = F.filter(F.split(body, WORDS), lambda x: x != "")
    of_words = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("again")))
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("kinds")))
    return let(F.struct(of_words.alias("w"), of_lines.alias("l")), lambda m: F.struct(
        m["w"]["n"].alias("n_words"), F.length(spaceless).cast("long").alias("word_chars"),
        (F.length(spaceless) - F.length(F.translate(spaceless, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (m["l"]["n"] - m["l"]["kinds"]).alias("n_dup_lines"), m["l"]["n"].alias("n_lines"),
        m["w"]["again"].alias("n_repeat_words")))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")


def measured(docs: DataFrame) -> DataFrame:
    """The documents with their counts."""
    return docs.withColumn("__m", counts(F.col("text"))).withColumns({c: F.col(f"__m.{c}") for c in COUNTS}).drop("__m")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def features() -> dict[str, Column]:
    """Badness features; a document without words has none (0)."""
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "dup_line_share": F.col("n_dup_lines") / lines,
        "repeat_share": F.col("n_repeat_words") / words,
        "long_words": F.col("word_chars") / words,
        "short_words": -F.col("word_chars") / words,
    }


def log_gamma(x: Column) -> Column:
    """ln Gamma(x), x >= 1: Stirling's series eight steps up."""
    y = x + 8
    steps = F.ln(x * (x + 1) * (x + 2) * (x + 3)) + F.ln((x + 4) * (x + 5) * (x + 6) * (x + 7))
    r = 1 / y
    series = r / 12 - r * r * r / 360 + r * r * r * r * r / 1260 - r * r * r * r * r * r * r / 1680
    return (y - 0.5) * F.ln(y) - y + 0.9189385332046727 + series - steps


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(at most k of n) under chance ``p``, exactly: the terms down from k, as far as they count.

    Terms fall geometrically below the mean, where the test is decided; above it the
    probability is over a third and no cutoff is accepted, so 1 is given.
    """
    top = (log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1)
           + k * F.ln(F.lit(p)) + (n - k) * F.ln(F.lit(1 - p)))
    steps = F.sequence(F.lit(0), F.least(k, F.ceil(40 * F.sqrt(n) + 40)).cast("long"))
    total = F.aggregate(steps, F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
                        lambda acc, j: F.struct((acc["term"] * (k - j) / (n - k + j + 1) * ((1 - p) / p)).alias("term"),
                                                (acc["sum"] + acc["term"]).alias("sum")),
                        lambda acc: acc["sum"])
    return F.when(k >= n * F.lit(p), 1.0).otherwise(F.exp(top) * total)


def accepted(labelled: DataFrame, stratum: str, risk: float = RISK, delta: float = DELTA,
             grid: dict[str, list[float]] | None = None) -> DataFrame:
    """(stratum, level): the sharpest accepted level, from 0, of the strata that have one.

    ``labelled``: measured good documents; those that fail the base rules are not counted.
    With chance 1 - ``delta`` no stratum's level drops more than ``risk`` of its good
    documents.  A stratum with n of all N labels has ``delta`` * n / N of the chance and needs
    ln(delta * n / N) / ln(1 - risk) labels at least: about 220 with four equal strata.
    """
    grid = grid or GRID
    levels = range(len(next(iter(grid.values()))))
    good = labelled.filter(~base_failed()).select(stratum, *(c.alias(f) for f, c in features().items()))

    def exceeds(level: int) -> Column:
        over = F.lit(False)
        for name, cuts in grid.items():
            over = over | (F.col(name) > cuts[level])
        return over

    counted = good.groupBy(stratum).agg(F.count("*").alias("n"), *(F.count_if(exceeds(i)).alias(f"k{i}") for i in levels))
    total = counted.select(F.sum("n")).scalar()
    tests = F.array(*(F.struct(F.lit(i).alias("level"), F.col(f"k{i}").alias("k")) for i in levels))
    # Fewer dropped never has the larger tail, so the accepted levels are the first ones of the chain.
    return (counted.select(stratum, "n", F.explode(tests).alias("t"))
            .filter(binomial_tail(F.col("t.k").cast("double"), F.col("n").cast("double"), risk) <= F.lit(delta) * F.col("n") / total)
            .groupBy(stratum).agg(F.max("t.level").alias("level")))


def learned(measures: DataFrame, labels: DataFrame, stratum: str = "lang", **how) -> DataFrame:
    """Accepted cutoffs, one row per stratum and one column per feature.

    ``measures``: measured documents with their doc_id and stratum; texts are not needed.
    Null or contradicting labels count for nothing (a doc_id labelled both ways is left
    out), repeated ones once; null ids have no label.
    """
    clear = (labels.filter("doc_id is not null and quality is not null").groupBy("doc_id")
             .agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).filter("quality = 1 and other = 1").select("doc_id"))
    good = measures.withColumn("stratum", _stratum(stratum)).join(clear, "doc_id")
    grid = how.get("grid") or GRID
    return accepted(good, "stratum", **how).select(
        "stratum", *(F.get(F.array(*map(F.lit, cuts)), F.col("level")).alias(f) for f, cuts in grid.items()))


def _stratum(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def judged(measures: DataFrame, rules: DataFrame, stratum: str = "lang") -> DataFrame:
    """Measured documents with ``base_failed`` and ``kept``.

    A document is dropped if it fails the base rules (under 50 words, or over half of them
    in repeated three-word windows) or exceeds a cutoff of its stratum's accepted level.  Strata
    without enough labelled good documents have no rules and drop nothing more.  A null
    text has no words and fails; a null stratum is the stratum of the empty text.  Empty
    tables give empty results.  Rows are judged one by one, never merged.
    """
    of = rules.select(F.col("stratum").alias("__stratum"), *(F.col(f).alias(f"__{f}") for f in GRID))
    known = measures.withColumns({"base_failed": base_failed(), "__s": _stratum(stratum)}).join(
        of, F.col("__s") == F.col("__stratum"), "left")
    exceeds = F.lit(False)
    for name, value in features().items():
        exceeds = exceeds | F.coalesce(value > F.col(f"__{name}"), F.lit(False))
    # A sum, which a filter on it cannot take apart and so evaluate twice.
    kept = F.col("base_failed").cast("int") + exceeds.cast("int") == 0
    return known.withColumn("kept", kept).drop("__s", "__stratum", *(f"__{f}" for f in GRID))
